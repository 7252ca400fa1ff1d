"""Rates for a long-running stream: a prepared snapshot that is renewed once it is too old."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from ordertide.operators.rates import prepare_rates
from ordertide.session import recorded_scratch, remove_scratch


class RateSnapshot:
    """Gives the rate table to each micro-batch, loading it anew every ``max_age_seconds``.

    A table read when the stream was planned keeps its file list for good, so rows added later
    would stay unseen. ``load`` must read the table (``spark.read...``) when called. Each snapshot
    holds the effective rates (``prepare_rates``), so batches in between only look them up. The one
    before the last is removed from the shared folder; a batch under way may still read the last.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        max_age_seconds: float = 3600.0,
        tolerance_days: int = 1,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load = load
        self._max_age = max_age_seconds
        self._tolerance_days = tolerance_days
        self._clock = clock
        self._loaded_at: float | None = None
        self._rates: DataFrame | None = None
        self._stored: list[list[str]] = []

    def current(self) -> DataFrame:
        now = self._clock()
        if self._loaded_at is None or now - self._loaded_at >= self._max_age:
            with recorded_scratch() as paths:
                self._rates = prepare_rates(self._load(), self._tolerance_days)
            self._stored.append(paths)
            if len(self._stored) > 2:
                remove_scratch(self._rates.sparkSession, self._stored.pop(0))
            self._loaded_at = now
        return self._rates
