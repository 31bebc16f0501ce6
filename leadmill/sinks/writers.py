"""Writers by name, flattening and exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions


def flattened(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON texts."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema])


def parquet(df: DataFrame, path: str) -> None:
    """Append; files of different columns are read as their union (`read_evolved`)."""
    df.write.mode("append").parquet(path)


def read_evolved(spark, path: str) -> DataFrame:
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.select(*sorted(df.columns))


def csv(df: DataFrame, path: str) -> None:
    """Append flat rows; readers (`versions.read`) see them under the sorted union of old and new columns, all of a call's rows or none."""
    versions.append(flattened(df), path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def jdbc(url: str, name: str, **options: str) -> Callable[[DataFrame, str], None]:
    return lambda df, _: flattened(df).write.mode("append").options(**options).jdbc(url, name)


def null(df: DataFrame, path: str = "") -> None:
    df.write.format("noop").mode("append").save()


def batched_post(post: Callable[[list[dict]], None], size: int = 100) -> Callable[[DataFrame, str], None]:
    """Rows in batches of `size` to a callable that posts them, from every partition by itself."""

    def send(rows: Iterable) -> None:
        batch = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                post(batch)
                batch = []
        if batch:
            post(batch)

    return lambda df, _: df.foreachPartition(send)


SINKS: dict[str, Callable[[DataFrame, str], None]] = {"parquet": parquet, "csv": csv, "json": json_lines, "table": table, "null": null}


def load(df: DataFrame, sinks: dict[str, str]) -> dict[str, str]:
    """Write to every sink (name -> path); one that fails doesn't stop the others.  Returns the errors by name."""
    if unknown := set(sinks) - set(SINKS):
        raise ValueError(f"unknown sinks: {sorted(unknown)}")
    errors = {}
    for name, path in sinks.items():
        try:
            SINKS[name](df, path)
        except Exception as e:  # noqa: BLE001 - reported by name
            errors[name] = str(e)[:500]
    return errors


def as_text(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """A `value` column with one labelled line a field, blanks left out."""
    lines = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))) for c, label in labels.items()]
    return df.select(F.concat_ws("\n", *lines).alias("value"))
