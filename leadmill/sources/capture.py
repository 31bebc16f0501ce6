"""Raw answers, kept by what they contain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed(raw: DataFrame, body: str = "body", kind: str = "kind") -> DataFrame:
    """raw with content_hash and file_name; equal contents have equal names."""
    digest = F.sha2(F.col(body), 256)
    return raw.withColumn("content_hash", digest).withColumn("file_name", F.concat(F.col(kind), F.lit("-"), F.substring(digest, 1, 16)))


def append(raw: DataFrame, path: str, body: str = "body", kind: str = "kind", day: str = "day") -> None:
    """Parquet by kind and day; the manifest is the table without its bodies."""
    keyed(raw, body, kind).write.mode("append").partitionBy(kind, day).parquet(path)
