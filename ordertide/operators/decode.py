"""Decode JSON order events into typed columns, with explicit rules for malformed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_DATABASE = "order"
ON_ERROR = ("fallback", "drop", "fail", "flag")

# The order record: column -> (type, default when absent). Fixed values.
ORDER_FIELDS = {
    "create_time": ("bigint", 0),
    "currency": ("string", ""),
    "order_status": ("string", ""),
    "user_id": ("bigint", 0),
    "order_id": ("bigint", 0),
    "gmv": ("double", 0.0),
}

# What a malformed record turns into under on_error="fallback". Fixed values.
FALLBACK_ORDER = {
    "create_time": 0,
    "currency": "MYR",
    "order_status": "paid",
    "user_id": 0,
    "order_id": 0,
    "gmv": 0.0,
}

_CORRUPT = "_corrupt"
_EVENT = f"event STRUCT<database: STRING>, {_CORRUPT} STRING"
# Typed leaves are fast to parse but reject what is legal here, such as a number given as text.
_TYPED_SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in ORDER_FIELDS.items()) + f", {_EVENT}"
# Text leaves accept everything; the casts are then made by the rules of this module.
_TEXT_SCHEMA = ", ".join(f"{name} STRING" for name in ORDER_FIELDS) + f", {_EVENT}"

# The expressions below are SQL text: long ones are built far faster that way than column by column.


def _literal(value, kind: str = "string") -> str:
    if value is None:
        value = "NULL"
    elif isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        value = f"'{escaped}'"
    return f"CAST({value} AS {kind})"


def _parse(value: str, schema: str) -> str:
    # Strict JSON: bare NaN and Infinity and single quotes make a record malformed.
    options = f"'columnNameOfCorruptRecord', '{_CORRUPT}', 'allowNonNumericNumbers', 'false', 'allowSingleQuotes', 'false'"
    return f"from_json(`{value}`, '{schema}', map({options}))"


def _intact(record: str) -> str:
    return f"({record} IS NOT NULL AND {record}.{_CORRUPT} IS NULL)"


def _number(text: str, kind: str) -> tuple[str, str]:
    """(value, whether the text is no number). Blank text is absent; fractions are cut for integers."""
    text = f"CASE WHEN trim({text}) <> '' THEN trim({text}) END"
    value = f"try_cast({text} AS {kind})"
    if kind != "double":
        value = f"coalesce({value}, try_cast(try_cast({text} AS DOUBLE) AS {kind}))"
    return value, f"({text} IS NOT NULL AND {value} IS NULL)"


def _order(values: dict[str, str], routed: str, is_bad: str) -> str:
    fields = ", ".join(
        f"'{name}', CAST(coalesce({values[name]}, {_literal(default, kind)}) AS {kind})"
        for name, (kind, default) in ORDER_FIELDS.items()
    )
    return f"named_struct({fields}, 'routed', {routed}, 'is_bad', {is_bad})"


def _order_from_typed(database: str) -> str:
    routed = f"coalesce(t.event.database = {_literal(database)}, false)"
    return _order({name: f"t.{name}" for name in ORDER_FIELDS}, routed, "false")


def _order_from_text(database: str) -> str:
    values, bad_casts = {}, []
    for name, (kind, _) in ORDER_FIELDS.items():
        values[name] = f"x.{name}"
        if kind != "string":
            values[name], bad = _number(f"x.{name}", kind)
            bad_casts.append(bad)
    routed = f"({_intact('x')} AND coalesce(x.event.database = {_literal(database)}, false))"
    is_bad = f"(NOT {_intact('x')} OR ({routed} AND ({' OR '.join(bad_casts)})))"
    fallback = {name: _literal(value, ORDER_FIELDS[name][0]) for name, value in FALLBACK_ORDER.items()}
    return f"CASE WHEN {is_bad} THEN {_order(fallback, routed, 'true')} ELSE {_order(values, routed, 'false')} END"


def decode_orders(
    df: DataFrame,
    on_error: str = "fallback",
    value: str = "value",
    keep: Sequence[str] = (),
    database: str = ORDER_DATABASE,
    observe=None,
) -> DataFrame:
    """Decode ``value`` into the order columns, keeping only records routed to ``database``.

    A record is malformed when its text is no JSON object, or when it is routed and a numeric field
    is no number. ``on_error`` says what happens to it: ``fallback`` gives ``FALLBACK_ORDER``,
    ``drop`` leaves it out, ``fail`` stops the job, and ``flag`` keeps every record, adding ``routed``
    and ``is_bad``. Records of other databases are left out without a look at their fields. ``keep``
    lists transport columns to pass through. ``observe`` is an ``Observation``, or a name to look for
    in ``lastProgress``, that counts all records and the malformed ones while the job runs.

    Nearly all records have the declared types and are parsed once, without a cast. The others are
    read again as text. All of it stands in a generator of one order per record: in a projection
    the optimizer would copy the parsing into every filter and column above it.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    from_text = f"transform(array({_parse(value, _TEXT_SCHEMA)}), x -> {_order_from_text(database)})[0]"
    choose = f"CASE WHEN {_intact('t')} THEN {_order_from_typed(database)} ELSE {from_text} END"
    orders = F.expr(f"transform(array({_parse(value, _TYPED_SCHEMA)}), t -> {choose})")
    df = df.select(*keep, F.explode(orders).alias("o"))
    routed, is_bad = F.col("o.routed"), F.col("o.is_bad")
    if observe:
        df = df.observe(observe, F.count(F.lit(1)).alias("records"), F.count_if(is_bad).alias("malformed"))
    if on_error == "drop":
        df = df.where(routed & ~is_bad)
    elif on_error == "fallback":
        df = df.where(routed | is_bad)
    elif on_error == "fail":
        df = df.where(F.when(is_bad, F.raise_error(F.lit("malformed order record"))).otherwise(routed))
    flags = (routed, is_bad) if on_error == "flag" else ()
    return df.select(*keep, *[f"o.{name}" for name in ORDER_FIELDS], *flags)


def decode_fields(
    df: DataFrame, fields: dict[str, tuple[str, object]], value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Decode any flat JSON record by ``{column: (type, default)}``; malformed records are left out.

    Unknown fields are ignored, absent and null ones take their default, and numbers given as text
    are converted.
    """
    schema = ", ".join(f"{name} STRING" for name in fields) + f", {_CORRUPT} STRING"
    df = df.select(*keep, F.explode(F.array(F.expr(_parse(value, schema)))).alias("j"))
    ok, out = [_intact("j")], []
    for name, (kind, default) in fields.items():
        leaf = f"j.{name}"
        if kind in ("bigint", "int", "double"):
            leaf, bad = _number(leaf, kind)
            ok.append(f"NOT {bad}")
        elif kind != "string":
            leaf = f"try_cast({leaf} AS {kind})"
        out.append(F.expr(f"coalesce({leaf}, {_literal(default, kind)})").alias(name))
    return df.where(" AND ".join(ok)).select(*keep, *out)


def encode_json(df: DataFrame, *columns: str, keep_nulls: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """All columns (or those named) as one JSON text ``value``, beside the ``keep`` columns."""
    names = columns or tuple(df.columns)
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(*keep, F.to_json(F.struct(*names), options).alias("value"))
