"""Counters that a running job takes on the side.

A :class:`RunMetrics` hangs observations on frames of a plan; Spark fills them while the job's own action runs,
so rows per stage, score ranges and skipped lines cost no further pass.  The numbers reach the driver as a
handful of values for each stage, whatever the size of the input.

Observed totals count what tasks report.  If an executor is lost and a shuffle stage runs again, its rows can be
counted twice; the job's own output never depends on them.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("talentlens")

REPORT_SCHEMA = "stage string, metric string, value double"


def range_of(column: str) -> dict[str, Column]:
    """Mean, sample deviation, least and greatest of a numeric column."""
    c = F.col(column)
    return {f"{column}_mean": F.avg(c), f"{column}_std": F.stddev_samp(c), f"{column}_min": F.min(c), f"{column}_max": F.max(c)}


def count_of(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


class RunMetrics:
    """Observations of one run, by stage, and the time between the run's marks."""

    def __init__(self, budget_seconds: float | None = None):
        self.budget_seconds = budget_seconds
        self._observed: dict[str, Observation] = {}
        self._started = self._marked = time.monotonic()
        self.seconds: dict[str, float] = {}

    def watch(self, df: DataFrame, stage: str, numbers: Iterable[str] = (), **counts: Column) -> DataFrame:
        """``df``, whose next action also counts its rows, the ``counts`` and the range of each of the ``numbers``."""
        if stage in self._observed:
            raise ValueError(f"stage {stage!r} is watched already")
        self._observed[stage] = seen = Observation()
        wanted = {"rows": F.count(F.lit(1)), **counts}
        for n in numbers:
            wanted |= range_of(n)
        return df.observe(seen, *[c.alias(name) for name, c in wanted.items()])

    def of(self, stage: str) -> dict[str, float]:
        """What was observed; to be called after the action (it waits for it)."""
        return self._observed[stage].get

    def mark(self, phase: str) -> float:
        """End of a phase: its seconds are kept; once the whole run exceeds the budget, a warning is logged."""
        now = time.monotonic()
        self.seconds[phase], self._marked = now - self._marked, now
        if self.over_budget:
            log.warning("%.1f s have passed at the end of %s; the budget is %.1f s", self.elapsed, phase, self.budget_seconds)
        return self.seconds[phase]

    @property
    def elapsed(self) -> float:
        return self._marked - self._started

    @property
    def over_budget(self) -> bool:
        return self.budget_seconds is not None and self.elapsed > self.budget_seconds

    def report(self, spark: SparkSession) -> DataFrame:
        """(stage, metric, value) of all that was observed, and the seconds of each phase under stage ``seconds``."""
        rows = [(stage, k, None if v is None else float(v)) for stage in self._observed for k, v in self.of(stage).items()]
        rows += [("seconds", phase, s) for phase, s in self.seconds.items()]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def summaries(df: DataFrame, stages: dict[str, str]) -> DataFrame:
    """K9 as a table: (stage, rows, mean, std, min, max) of each stage's column, from one pass over ``df``."""
    facts = [F.struct(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                      F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")) for stage, c in stages.items()]
    return df.agg(F.array(*facts).alias("s")).select(F.explode("s").alias("s")).select("s.*")
