"""Order-event analytics on PySpark: the same DataFrame code for tables and for streams."""
