from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import rows
from pyspark.sql import functions as F

from ordertide import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_currency_to_country(spark):
    df = spark.createDataFrame([("IDR",), ("PHP",), ("MYR",), ("SGD",), ("xxx",), ("idr",), (None,)], "c string")
    assert [r[0] for r in df.select(fn.currency_to_country("c")).collect()] == ["ID", "PH", "MY", "SG", "", "", ""]


def test_second_to_millisecond(spark):
    assert one(spark, fn.second_to_millisecond(F.lit(1642157787))) == 1642157787000
    assert one(spark, fn.second_to_millisecond(F.lit(1642157787238))) == 1642157787238
    assert one(spark, fn.second_to_millisecond(F.lit(-5))) == -5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(
    st.integers(-(2**62), 2**62), st.integers(2**32 - 3, 2**32 + 3), st.integers(-3, 3)), min_size=50, max_size=200))
def test_second_to_millisecond_equals_the_mask_rule(spark, values):
    mask = 0xFFFFFFFF00000000
    expected = [v if (v & mask) != 0 else v * 1000 for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t bigint")
    got = [r[1] for r in sorted(df.select("i", fn.second_to_millisecond("t")).collect())]
    assert got == expected
    assert [fn.to_millis(v) for v in values] == expected


def test_salted_key(spark):
    assert one(spark, fn.salted_key(F.lit("VN2021-08-04"))) == "3d:VN2021-08-04"
    assert one(spark, fn.salted_key(F.lit("ID2021-08-04"))) == "52:ID2021-08-04"
    assert one(spark, fn.salted_key(F.lit("ID2021-08-04"), 5)) == "36352:ID2021-08-04"


def test_dates(spark):
    assert one(spark, fn.event_date(F.lit(1641885053000))) == "2022-01-11"
    assert one(spark, fn.event_date(F.lit(1641916800000))) == "2022-01-12"
    assert one(spark, fn.event_date(F.lit(2**62))) is None
    assert one(spark, fn.timestamp_from_millis(F.lit(2**62))) is None
    assert one(spark, fn.date_shift(F.lit("2024-03-01"), -1)) == "2024-02-29"
    assert one(spark, fn.date_shift(F.lit("no date"), -1)) is None
    assert one(spark, fn.format_millis(F.lit(1641885053000))) == "2022-01-11 15:10:53"


def test_day_bounds_are_local_midnights(spark):
    start, end = fn.day_bounds(F.lit(1641885053000))
    assert (one(spark, start), one(spark, end)) == (1641830400000, 1641916800000)
    # A day of 23 hours, at the change to summer time.
    start, end = fn.day_bounds(F.lit(1710086400000), "America/New_York")
    assert one(spark, end) - one(spark, start) == 23 * 3_600_000


def test_truncation_before_1970(spark):
    assert one(spark, fn.truncate_millis(F.lit(-1).cast("bigint"), 60_000)) == -60_000


def test_registered_functions(spark):
    session = spark.newSession()
    fn.register_functions(session)
    got = session.sql(
        "SELECT currency_to_country('PHP'), currency_to_country(NULL), second_to_millisecond(1642157787), "
        "salted_key('VN2021-08-04'), salted_key_n('ID2021-08-04', 5), date_shift('2024-03-01', -1), "
        "event_day(1641885053000)"
    )
    assert rows(got) == [("PH", "", 1642157787000, "3d:VN2021-08-04", "36352:ID2021-08-04", "2024-02-29", "2022-01-11")]


def test_hours_do_not_pass_through_the_session_zone(spark):
    """The test session's zone skips 02:00 to 03:00 on this day; UTC hours must not."""
    from ordertide.functions.scalars import ntz_from_millis, ntz_to_millis, truncate_ntz_hour

    times = [1710037800000, 1710041400000, -1, 0, 1710041400123]  # the first two: 02:30 and 03:30 on 2024-03-10
    df = spark.createDataFrame([(t,) for t in times], "ms bigint").withColumn("ts", ntz_from_millis("ms"))
    got = df.select("ms", ntz_to_millis("ts"), ntz_to_millis(truncate_ntz_hour("ts"))).collect()
    assert [tuple(r) for r in got] == [(t, t, t - t % 3600000) for t in times]


def test_sql_day_of_far_times_is_null(spark):
    from ordertide.functions.sql import register_functions

    register_functions(spark)
    far = spark.sql("SELECT event_day(100000000000000000) a, event_day(-100000000000000000) b, event_day(NULL) c").head()
    assert tuple(far) == (None, None, None)
