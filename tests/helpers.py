import json

GOLDEN = {
    "create_time": 1641885053, "currency": "PHP", "order_status": "paid", "user_id": 659334,
    "order_id": 7699329, "gmv": 3174.6346553637804, "event": {"database": "order"},
}
# 2022-01-11, the day of the golden order, at noon in Singapore.
GOLDEN_NOON = 1641873600000


def order(**changes):
    return json.dumps({**GOLDEN, **changes})


def record_table(spark, *values):
    rows = [(v, 1641885053, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, timestamp bigint, offset bigint")


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
