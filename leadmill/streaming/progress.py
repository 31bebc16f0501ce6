"""Progress of streams and stages as a table: counters that are observed while rows are written."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: A counter of one batch of a stream, or of one stage of a run (batch 0).
COUNTER = "run string, stage string, batch long, counter string, value long"


def _counts(conditions: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()]]


def noted(spark: SparkSession, path: str, run: str, stage: str, batch: int, counters: dict[str, int]) -> None:
    """Add counters to the table; a stage or batch that runs again replaces its own part."""
    rows = [(run, stage, batch, k, int(v)) for k, v in sorted(counters.items()) if v is not None]
    spark.createDataFrame(rows, COUNTER).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={run}-{stage}-{batch}")


def counted(stream: DataFrame, stage: str, **conditions: Column) -> DataFrame:
    """A stream whose batches count their rows, and those for which each condition holds, under the name of the stage."""
    return stream.observe(stage, *_counts(conditions))


class Progress(StreamingQueryListener):
    """Writes the observed counters of every batch to a table, as batches end.  `done` is set once a stream has ended and its last batch is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.done = spark, path, threading.Event()

    def onQueryStarted(self, event) -> None:
        self.done.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for stage, row in (p.observedMetrics or {}).items():
            if p.numInputRows:
                noted(self.spark, self.path, str(p.runId), stage, p.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.done.set()


class Stages:
    """Counters of the stages of a run: `watched` frames count as they are written, `written` puts what they have counted into the table."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run
        self.seen: dict[str, Observation] = {}

    def watched(self, rows: DataFrame, stage: str, **conditions: Column) -> DataFrame:
        self.seen[stage] = Observation(f"{self.run}-{stage}")
        return rows.observe(self.seen[stage], *_counts(conditions))

    def written(self, stage: str) -> dict[str, int]:
        """To be called once the frame of the stage has been written; waits for its counters."""
        counters = self.seen[stage].get
        noted(self.spark, self.path, self.run, stage, 0, counters)
        return counters


def totals(table: DataFrame) -> DataFrame:
    """(stage, counter, value) over all runs and batches."""
    return table.groupBy("stage", "counter").agg(F.sum("value").alias("value"))
