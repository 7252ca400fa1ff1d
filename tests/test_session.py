import os

from ordertide.session import recorded_scratch, remove_scratch, settle


def test_recorded_scratch_is_removed_and_the_rest_stays(spark):
    before = settle(spark.range(3), "before")
    with recorded_scratch() as outer:
        settle(spark.range(4), "outer")
        with recorded_scratch() as inner:
            settle(spark.range(5), "inner")
    assert len(inner) == 1 and len(outer) == 2 and inner[0] in outer
    after = settle(spark.range(6), "after")
    remove_scratch(spark, outer)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in outer)
    assert before.count() == 3 and after.count() == 6
