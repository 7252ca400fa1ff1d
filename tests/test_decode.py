import json

import pytest
from helpers import GOLDEN, order, plan, record_table, rows

from ordertide.operators.decode import decode_fields, decode_orders, encode_json
from ordertide.operators.routing import route, tag_routes

FIELDS = ("create_time", "currency", "order_status", "user_id", "order_id", "gmv")
FALLBACK = (0, "MYR", "paid", 0, 0, 0.0)
FULL = tuple(GOLDEN[f] for f in FIELDS)


def with_field(name, value):
    return tuple(value if f == name else GOLDEN[f] for f in FIELDS)


def without(*names):
    return json.dumps({k: v for k, v in GOLDEN.items() if k not in names})


GOOD = [
    (order(), FULL),
    (order(extra={"deep": [1, 2]}), FULL),
    (without("gmv", "currency"), (GOLDEN["create_time"], "", "paid", GOLDEN["user_id"], GOLDEN["order_id"], 0.0)),
    (order(user_id="10"), with_field("user_id", 10)),
    (order(user_id=1.9), with_field("user_id", 1)),
    (order(gmv="3.5"), with_field("gmv", 3.5)),
    (order(user_id=None), with_field("user_id", 0)),
    (order(user_id=""), with_field("user_id", 0)),
    (order(gmv="  "), with_field("gmv", 0.0)),
    (order() + " trailing", FULL),
    (order()[:-1] + ', "user_id": 7}', with_field("user_id", 7)),
    (order(USER_ID=3), FULL),
    (order(event={"database": "order", "more": 1}), FULL),
]
BAD = [
    None,
    "",
    "plain text",
    '{"create_time": 1',
    "[1, 2]",
    "[" + order() + "]",
    order(event="order"),
    order(user_id="ten"),
    order(user_id=True),
    order(gmv={"a": 1}),
    order(user_id=1e300),
    order(gmv=float("nan")),
    order(gmv=float("inf")),
    order().replace('"', "'"),
]
NOT_ROUTED = [
    without("event"),
    order(event=None),
    order(event={}),
    order(event={"database": "user"}),
    order(event={"database": "user"}, gmv="abc"),
]


@pytest.mark.parametrize("policy", ["fallback", "drop", "fail"])
def test_good_records(spark, policy):
    df = decode_orders(record_table(spark, *[v for v, _ in GOOD]), policy, keep=("offset",))
    assert [r[1:] for r in sorted(rows(df))] == [want for _, want in GOOD]


def test_bad_records_fall_back(spark):
    df = decode_orders(record_table(spark, *BAD), "fallback", keep=("offset",))
    assert sorted(rows(df)) == [(i, *FALLBACK) for i in range(len(BAD))]


def test_bad_records_are_dropped(spark):
    assert rows(decode_orders(record_table(spark, *BAD, order()), "drop")) == [FULL]


@pytest.mark.parametrize("bad", BAD)
def test_bad_record_fails_the_job(spark, bad):
    with pytest.raises(Exception, match="malformed order record"):
        decode_orders(record_table(spark, order(), bad), "fail").collect()


@pytest.mark.parametrize("policy", ["fallback", "drop", "fail"])
def test_records_of_other_databases_are_left_out(spark, policy):
    assert rows(decode_orders(record_table(spark, *NOT_ROUTED), policy)) == []


def test_flag_keeps_every_record(spark):
    values = [order(), *BAD, *NOT_ROUTED]
    df = decode_orders(record_table(spark, *values), "flag", keep=("offset",))
    assert df.count() == len(values)
    assert df.where("is_bad").count() == len(BAD)


def test_observed_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("decode")
    decode_orders(record_table(spark, order(), *BAD), "drop", observe=seen).collect()
    assert seen.get == {"records": 1 + len(BAD), "malformed": len(BAD)}


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        decode_orders(record_table(spark, order()), "ignore")


def test_each_record_is_parsed_once(spark):
    df = decode_orders(record_table(spark, order()), "fallback").where("order_status = 'paid'")
    # Once with types, and once as text where that failed; filters above do not parse again.
    assert plan(df).count("from_json(") == 2


def test_decode_fields(spark):
    person = {"name": ("string", "NA"), "age": ("int", 0), "height": ("double", 0.0), "weight": ("double", 0.0)}
    values = (
        '{"name": "Tom", "age": "10", "height": 175, "weight": 65, "occupation": "x"}',
        '{"occupation": "x"}',
        "no json",
    )
    df = decode_fields(record_table(spark, *values), person, keep=("offset",))
    assert sorted(rows(df)) == [(0, "Tom", 10, 175.0, 65.0), (1, "NA", 0, 0.0, 0.0)]


def test_encode_json(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(encode_json(df)) == [('{"a":1}',)]
    assert rows(encode_json(df, keep_nulls=True, keep=("a",))) == [(1, '{"a":1,"b":null}')]


def test_routes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    tags = {"a": F.col("k") == "a", "low": F.col("id") < 3}
    assert {t: sorted(r[0] for r in d.collect()) for t, d in route(df, tags).items()} == {"a": [1], "low": [1, 2]}
    assert sorted(rows(tag_routes(df, tags).select("id", "route"))) == [(1, "a"), (1, "low"), (2, "low")]
