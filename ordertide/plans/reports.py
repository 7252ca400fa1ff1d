"""Reports over job results: the roll-up and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordertide.operators.filters import reject_late
from ordertide.operators.rollup import (
    country_totals,
    country_user_totals,
    hourly_totals,
    rollup_minute,
)


def txn_rollup(txn: DataFrame, as_of: int | None = None, reject: bool = False) -> DataFrame:
    """Minute roll-up of transactions, optionally without rows that arrive too late."""
    return rollup_minute(reject_late(txn, as_of) if reject else txn)


def user_rollup(users: DataFrame, as_of: int | None = None, reject: bool = False) -> DataFrame:
    """Minute roll-up of users: counts only."""
    return rollup_minute(reject_late(users, as_of) if reject else users, metrics=())


def hourly_txn(rollup: DataFrame, start, end) -> DataFrame:
    return hourly_totals(rollup, start, end)


def hourly_users(rollup: DataFrame, start, end) -> DataFrame:
    return hourly_totals(rollup, start, end, metrics=())


totals_txn = country_totals
totals_users = country_user_totals
