"""Listings as they arrive: first seen wins, checks that are due again after a time, checkpointed and restartable."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text


def landing(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_seen(stream: DataFrame, phone: str, stamp: str, delay: str = "7 days") -> DataFrame:
    """One row a phone within the watermark: the state holds the phones of that time only.  Rows without a phone pass by the state."""
    keyed = stream.withColumn("phone_key", text.phone_key(F.col(phone))).withWatermark(stamp, delay)
    once = keyed.where("phone_key is not null").dropDuplicatesWithinWatermark(["phone_key"])
    return once.unionByName(keyed.where("phone_key is null"))


def due_at(stamps: np.ndarray, last: int | None, ttl: int) -> list[int]:
    """Of the sorted times at which a key is asked for, those at which its answer is missing or `ttl` old, given when it was last found."""
    out: list[int] = []
    at = 0 if last is None else int(np.searchsorted(stamps, last + ttl))
    while at < len(stamps):
        out.append(int(stamps[at]))
        at = int(np.searchsorted(stamps, out[-1] + ttl))
    return out


def due(stream: DataFrame, key: str, stamp: str, ttl_seconds: float, delay: str = "1 hour") -> DataFrame:
    """(key, stamp): when each key has to be looked up, as it is asked for at the stamps of the stream.

    A key is due where it was never looked up, or `ttl_seconds` or more ago; in between its answer is fresh, and the row drops out.  The state
    of a key is the time of its last look-up.  It goes when the watermark has passed that time by the TTL, as whatever comes then is due
    anyway, so state is bounded by the keys of one TTL and delay.  Rows that come late within the delay count as fresh beside a later look-up;
    later ones, and null keys or stamps, drop out.  Only keys and stamps pass to Python, batch by batch.
    """
    ttl = int(ttl_seconds * 1_000_000)

    def one(k: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        stamps = np.unique(np.concatenate([c["at"].to_numpy(np.int64) for c in chunks]))
        last = state.get[0] if state.exists else None
        found = due_at(stamps, last, ttl)
        if found:
            last = found[-1]
            state.update((last,))
            yield pd.DataFrame({"key": [k[0]] * len(found), "at": found})
        # A time-out lies behind the watermark, by a millisecond at least.
        state.setTimeoutTimestamp(max((last + ttl) // 1000, state.getCurrentWatermarkMs() + 1))

    kind = stream.schema[key].dataType
    rows = stream.where(F.col(key).isNotNull() & F.col(stamp).isNotNull()).withWatermark(stamp, delay)
    rows = rows.select(F.col(key).alias("key"), F.unix_micros(F.col(stamp)).alias("at"), F.col(stamp).alias("stamp"))
    out = T.StructType([T.StructField("key", kind), T.StructField("at", T.LongType())])
    found = rows.groupBy("key").applyInPandasWithState(one, out, T.StructType([T.StructField("last", T.LongType())]), "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("key").alias(key), F.timestamp_micros("at").alias(stamp))


def event_counts(stream: DataFrame, stamp: str, kind: str, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    return stream.withWatermark(stamp, delay).groupBy(F.window(stamp, window), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to: when it began, and the id that the engine gave it."""
    meta = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/metadata").select(F.unix_millis("modificationTime").alias("began"), F.decode("content", "UTF-8").alias("said")).first()
    return f"{meta.began:015d}-{json.loads(meta.said)['id']}"


def into_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Every micro-batch as a part of a Parquet table, run=R/batch=N.  A batch that runs again after a failure replaces its
    own part and reads nothing of the others, so rows are neither lost nor repeated, whatever their keys.  Batches are counted
    anew by every checkpoint; R tells the runs apart, so a stream with a checkpoint of its own adds to the table."""
    run: list[str] = []

    def batch(df: DataFrame, n: int) -> None:
        if not run:
            run.append(run_of(df.sparkSession, checkpoint))
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run[0]}/batch={n}")

    return stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(table: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The last value of each key in a table of updates that `into_table` wrote: of the latest run, the latest batch."""
    return table.groupBy(*keys).agg(F.max_by(value, F.struct("run", "batch")).alias(value))
