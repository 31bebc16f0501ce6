"""What the training-data operators share: the shared folder, written tables, small tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Word separators and words as the digests define them: ASCII white space only.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch paths of the run that this thread or task is in, if it is in one.
_RUN: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder.  It stays until the `scratch_removed` around it ends, or its owner removes it."""
    path = f"{shared_dir(spark)}/leadmill/{name}-{uuid.uuid4().hex}"
    if (run := _RUN.get()) is not None:
        run.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """What is written as scratch inside goes at the end, also after an error; only for results that are written inside as well."""
    run: list[str] = []
    before = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(before)
        for path in run:
            removed(spark, path)


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it again: computed once, and it outlives lost executors.  Also its path, for those who remove it early."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    return written_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def local_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A small table from the driver, by Arrow: no Python on the executors."""
    return spark.createDataFrame(pa.table(columns))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an undirected edge list; root is the smallest node of its component.

    Alternating large-star and small-star rounds: each is a grouped minimum (combined map-side, so a hub costs
    one row a task) and a join back.  The minima of the large star are written first, so that join has no grouping
    right below it and a hub can be split.  The edges are written after each round; only their count and a checksum
    reach the driver.  Rounds grow with the logarithm of the component size.
    No edges: no rows.  Self-loops and repeated edges change nothing.
    """
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct()
    e = written(e, "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
        nxt = written(small.select("p.a", "p.b").where("a <> b").distinct(), "edges")
        now = nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        e = nxt
        if now == seen or not now[0]:
            break
        seen = now
    roots = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
