"""De-duplicate bounded tables by business key: the first row of each key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence, largest: bool = False) -> DataFrame:
    """The row with the least (or, with ``largest``, the greatest) ``order_by`` of each key.

    Every map task passes on at most one row per key (a partial group limit, or a partial minimum),
    so a key with a large share of all rows costs no more to shuffle than any other.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys]
    if len(order_by) == 1 and isinstance(order_by[0], str) and rest == [order_by[0]]:
        # Nothing but the ordering column is left to carry: a hash aggregate does it without a sort.
        pick = F.max if largest else F.min
        return df.groupBy(*keys).agg(pick(order_by[0]).alias(order_by[0])).select(*df.columns)
    if largest:
        order = [c.desc() for c in order]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def not_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``seen`` (null keys match null keys; a key that is seen often counts once)."""
    seen = seen.select(*[F.col(k).alias(f"__s_{k}") for k in keys]).distinct()
    condition = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    return df.join(seen, condition, "left_anti")


def first_unseen(
    df: DataFrame, seen: DataFrame, keys: Sequence[str], order_by: Sequence
) -> tuple[DataFrame, DataFrame]:
    """(first row of every key that ``seen`` lacks, the keys that must be added to ``seen``).

    Rows are cut to one per key before they meet ``seen``, so the join has no hot key.
    """
    fresh = not_seen(first_per_key(df, keys, order_by), seen, keys)
    return fresh, fresh.select(*keys)
