"""The twelve views in dependency order, and reading them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata import session
from daystrata.operators import daily as parse, rollup, temporal
from daystrata.operators.merge import daily_metrics

# Fixed value: seconds that a loaded relation may serve reports.
LIFE_SPAN = 3600.0
VIEW_ORDER = (
    "v_steps_daily", "v_body_battery_daily", "v_heart_rate_daily", "v_stress_daily", "v_sleep_daily",
    "v_daily_metrics", "v_data_quality_summary", "v_dashboard_daily", "v_dashboard_weekly", "v_dashboard_monthly",
    "v_dashboard_correlations", "v_dashboard_trends",
)


def build_views(raw: DataFrame, *, keys: Sequence[str] = (), merged: DataFrame | None = None) -> dict[str, DataFrame]:
    """All relations over one raw table; the derived ones share one ``daily_metrics`` plan, or read ``merged``."""
    merged = daily_metrics(raw, keys=keys) if merged is None else merged
    return {
        "v_steps_daily": parse.steps_daily(raw, keys=keys),
        "v_body_battery_daily": parse.body_battery_daily(raw, keys=keys),
        "v_heart_rate_daily": parse.heart_rate_daily(raw, keys=keys),
        "v_stress_daily": parse.stress_daily(raw, keys=keys),
        "v_sleep_daily": parse.sleep_daily(raw, keys=keys),
        "v_daily_metrics": merged,
        "v_data_quality_summary": rollup.data_quality_summary(merged, keys=keys),
        "v_dashboard_daily": rollup.dashboard_daily(merged, keys=keys),
        "v_dashboard_weekly": rollup.dashboard_weekly(merged, keys=keys),
        "v_dashboard_monthly": rollup.dashboard_monthly(merged, keys=keys),
        "v_dashboard_correlations": temporal.dashboard_correlations(merged, keys=keys),
        "v_dashboard_trends": temporal.dashboard_trends(merged, keys=keys),
    }


def register_views(raw: DataFrame, *, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Create or replace the temporary views; the first failing view stops the run."""
    views = build_views(raw, keys=keys)
    for name in VIEW_ORDER:
        views[name].createOrReplaceTempView(name)
    return views


class SharedViews:
    """The twelve views over one stored base, which is derived again once it is older than ``seconds``.

    ``source`` gives the raw table.  The merged relation is written to the shared folder once, and the seven views above
    it read that table, so a lost executor or another report costs no second merge; the five relations of one metric
    read their part of the raw table.  Leaving the context drops the views and forgets the base.
    """

    def __init__(self, spark: SparkSession, source: Callable[[], DataFrame], *, keys: Sequence[str] = (), seconds: float = LIFE_SPAN,
                 clock: Callable[[], float] = time.monotonic) -> None:
        self.spark, self.source, self.keys, self.seconds, self.clock = spark, source, keys, seconds, clock
        self.made: float | None = None
        self.derived = 0
        self._views: dict[str, DataFrame] = {}

    def views(self) -> dict[str, DataFrame]:
        """The relations, registered as temporary views, of a base that isn't too old."""
        if self.made is None or self.clock() - self.made >= self.seconds:
            raw, path = self.source(), session.new_folder(self.spark, "daily")
            merged = daily_metrics(raw, keys=self.keys)
            merged.write.parquet(path)
            self._views = build_views(raw, keys=self.keys, merged=self.spark.read.schema(merged.schema).parquet(path))
            for name in VIEW_ORDER:
                self._views[name].createOrReplaceTempView(name)
            self.made, self.derived = self.clock(), self.derived + 1
        return self._views

    def release(self) -> None:
        for name in self._views:
            self.spark.catalog.dropTempView(name)
        self._views, self.made = {}, None

    def __enter__(self) -> SharedViews:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def ordered_view(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sorted read, NULL first."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order])


def cached(df: DataFrame) -> DataFrame:
    """Keep a relation that several reports read; spills to disk.  The caller unpersists."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
