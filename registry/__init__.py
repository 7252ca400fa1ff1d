"""Named queries over the stored tables, and the SQL that must give the same rows."""
