"""Scalar functions as column expressions: built-in functions only, so all of them stay in codegen.

Times are BIGINT epoch values. No expression here depends on the session time zone: a zone is
always an argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_TZ = "Asia/Singapore"
COUNTRY_BY_CURRENCY = {"IDR": "ID", "PHP": "PH", "MYR": "MY", "SGD": "SG"}
MAX_EPOCH_SECONDS = 4294967295
MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DATE_FORMAT = "yyyy-MM-dd"

# 0001-01-01 to 9999-12-31 in UTC, less a day on each side for zone offsets.
_MIN_MS = -62135510400000
_MAX_MS = 253402214399999


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def currency_to_country(currency) -> Column:
    """Country code of a currency; empty for any other text and for null."""
    currency = _col(currency)
    known = [F.when(currency == code, F.lit(country)) for code, country in COUNTRY_BY_CURRENCY.items()]
    return F.coalesce(*known, F.lit(""))


def to_millis(t: int) -> int:
    """``second_to_millisecond`` for a driver-side argument."""
    return t * 1000 if 0 <= t <= MAX_EPOCH_SECONDS else t


def second_to_millisecond(t) -> Column:
    """Epoch seconds (0 to 4294967295) become milliseconds; all other values stay as they are."""
    t = _col(t).cast("bigint")
    return F.when(t.between(0, MAX_EPOCH_SECONDS), t * F.lit(1000)).otherwise(t)


def salted_key(key, digits: int = 2) -> Column:
    """``<last hex digits of md5(key)>:<key>``."""
    key = _col(key).cast("string")
    return F.concat(F.right(F.md5(key), F.lit(digits)), F.lit(":"), key)


def business_key(*columns) -> Column:
    """The columns' text joined without a separator, in the order given (for display)."""
    return F.concat_ws("", *[_col(c).cast("string") for c in columns])


def date_shift(date, days: int) -> Column:
    """A ``yyyy-MM-dd`` text moved by whole days; null when the text is no date."""
    day = F.try_to_timestamp(_col(date), F.lit(DATE_FORMAT)).cast("date")
    return F.date_format(F.date_add(day, days), DATE_FORMAT)


def ntz_literal(value) -> Column:
    """A datetime without zone, or its text, as a UTC wall-clock literal; columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def ntz_from_millis(ms) -> Column:
    """UTC wall-clock timestamp (without zone) of epoch milliseconds; null outside the years 1 to 9999."""
    ms = _col(ms)
    return F.when(is_calendar_time(ms), F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def is_calendar_time(ms) -> Column:
    """Whether epoch milliseconds fall into the years 1 to 9999; null for null."""
    return _col(ms).between(_MIN_MS, _MAX_MS)


def ntz_to_millis(ts) -> Column:
    """Epoch milliseconds of a UTC wall-clock timestamp (without zone), from its own date and time parts."""
    ts = _col(ts)
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("long")


def truncate_ntz_hour(ts) -> Column:
    """The hour of a UTC wall-clock timestamp (without zone). ``date_trunc`` would pass through the session's zone."""
    ts = _col(ts)
    parts = [F.date_format(ts.cast("date"), "yyyy-MM-dd"), F.lpad(F.hour(ts).cast("string"), 2, "0")]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(":00:00")).cast("timestamp_ntz")


def timestamp_from_millis(ms) -> Column:
    """Event-time TIMESTAMP of epoch milliseconds; null outside the years 1 to 9999."""
    ms = _col(ms)
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_millis(ms))


def _local_ntz(ms: Column, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz_from_millis(ms))


def event_date(ms, tz: str = DEFAULT_TZ) -> Column:
    """Calendar day of epoch milliseconds in ``tz`` as ``yyyy-MM-dd``; null outside years 1 to 9999."""
    ms = _col(ms)
    return F.when(ms.between(_MIN_MS, _MAX_MS), _local_ntz(ms, tz).cast("date").cast("string"))


def format_millis(ms, tz: str = DEFAULT_TZ) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in ``tz``."""
    ms = _col(ms)
    return F.when(
        ms.between(_MIN_MS, _MAX_MS), F.date_format(_local_ntz(ms, tz), "yyyy-MM-dd HH:mm:ss")
    )


def truncate_millis(ms, unit_ms: int) -> Column:
    """Start of the ``unit_ms`` bucket that holds ``ms`` (also right before 1970)."""
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(unit_ms).cast("bigint"))


def now_millis(as_of: int | None = None) -> Column:
    """The job's clock: a fixed epoch-ms value, or the current time (one value per micro-batch)."""
    if as_of is None:
        return F.unix_millis(F.current_timestamp())
    return F.lit(as_of).cast("bigint")


def processing_millis(as_of: int | None = None) -> Column:
    """Processing time in milliseconds, cut to whole seconds."""
    return truncate_millis(now_millis(as_of), 1000)


def day_bounds(now_ms: Column, tz: str = DEFAULT_TZ) -> tuple[Column, Column]:
    """Epoch ms of local midnight and of the next one, for the day that holds ``now_ms``.

    Both fold to literals when ``now_ms`` is a literal or the current time.
    """
    today = _local_ntz(now_ms, tz).cast("date")

    def midnight(day: Column) -> Column:
        utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), day.cast("timestamp_ntz"))
        return ntz_to_millis(utc)

    return midnight(today), midnight(F.date_add(today, 1))
