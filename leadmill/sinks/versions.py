"""File tables behind a record of their current version.

Rows lie in folders of their own, data-ID, that are never changed once a version names them.  A version is a small JSON record, _versions/NUMBER, of the
folders that make up the table, with their columns.  It is committed by creating the next number, which only one writer can do (the file
system's create-if-absent; nothing is renamed, so object stores will do).  Readers take the greatest number that holds a whole record: while a writer is
at work, or after it has failed on the way, they see the version before.

A writer that finds its number taken starts again from the version it has now.  A number whose record is not whole belongs to a writer that is
still writing it, or died: it is waited for, then passed over.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds that a half-written record is waited for, and versions whose folders `cleaned` leaves.
PATIENCE, LEFT = 10.0, 2
OPTIONS = {"csv": {"header": "true", "escape": '"', "multiLine": "true"}, "parquet": {}, "json": {}}


@dataclass(frozen=True)
class Version:
    """folders: (name, columns) in the order in which they came."""

    number: int
    format: str
    folders: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def columns(self) -> list[str]:
        return sorted({c for _, columns in self.folders for c in columns})


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, at = _fs(spark, f"{path.rstrip('/')}/_versions")
    if not fs.exists(at):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit())


def _record(spark: SparkSession, path: str, number: int) -> Version | None:
    """The version of that number; none while its record is not whole."""
    fs, at = _fs(spark, f"{path.rstrip('/')}/_versions/{number:012d}")
    stream = fs.open(at)
    try:
        said = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        d = json.loads(said)
    except ValueError:
        return None
    return Version(number, d["format"], tuple((n, tuple(c)) for n, c in d["folders"]))


def current(spark: SparkSession, path: str) -> Version | None:
    """What readers see: the greatest whole version; none before the first."""
    return next((v for n in reversed(_numbers(spark, path)) if (v := _record(spark, path, n))), None)


def _latest(spark: SparkSession, path: str) -> tuple[Version | None, int]:
    """What writers start from, and the number that is theirs to take."""
    until = time.monotonic() + PATIENCE
    while (numbers := _numbers(spark, path)) and _record(spark, path, numbers[-1]) is None and time.monotonic() < until:
        time.sleep(0.2)
    return current(spark, path), (numbers[-1] if numbers else 0) + 1


def committed(spark: SparkSession, path: str, number: int, kind: str, folders: list[tuple[str, list[str]]]) -> bool:
    """Whether this writer got the number."""
    fs, at = _fs(spark, f"{path.rstrip('/')}/_versions/{number:012d}")
    try:
        out = fs.create(at, False)
    except Exception as e:  # noqa: BLE001 - of the file system: the only one that is expected says that the file exists
        if "exist" in str(e).lower():
            return False
        raise
    out.write(bytearray(json.dumps({"format": kind, "folders": folders}).encode()))
    out.close()
    return True


def _folder(df: DataFrame, path: str, kind: str) -> tuple[str, list[str]]:
    name = f"data-{uuid.uuid4().hex}"
    df.write.format(kind).options(**OPTIONS[kind]).save(f"{path.rstrip('/')}/{name}")
    return name, df.columns


def append(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Rows behind those that are there; new columns need no rewriting, as every folder has its own."""
    spark = df.sparkSession
    own = _folder(df.select(*sorted(df.columns)), path, kind)
    while True:
        before, number = _latest(spark, path)
        if before and before.format != kind:
            raise ValueError(f"{path} holds {before.format}")
        if committed(spark, path, number, kind, [*(before.folders if before else ()), own]):
            return


def replaced(path: str, spark: SparkSession, change: Callable[[DataFrame | None], DataFrame], kind: str = "csv") -> None:
    """The table becomes what `change` makes of its rows (none: there is no table yet).  Should another writer come first, the change is made of its rows."""
    while True:
        before, number = _latest(spark, path)
        new = change(rows(spark, path, before) if before else None)
        own = _folder(new, path, kind)
        if committed(spark, path, number, kind, [own]):
            return


def rows(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The rows of a version under all its columns; the plan has a branch for each set of columns, not for each folder."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, columns in version.folders:
        groups.setdefault(columns, []).append(f"{path.rstrip('/')}/{name}")
    read = lambda columns, paths: spark.read.format(version.format).options(**OPTIONS[version.format]).load(paths)
    parts = [read(c, p).select(*[F.col(f"`{x}`") for x in c]) for c, p in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*[F.col(f"`{c}`") for c in version.columns])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now.  The frame stays with its version, whatever comes after, until `cleaned` removes that."""
    found = current(spark, path)
    if not found:
        raise FileNotFoundError(path)
    return rows(spark, path, found)


def compacted(spark: SparkSession, path: str) -> None:
    """The same rows in one folder."""
    kind = current(spark, path).format
    replaced(path, spark, lambda df: df, kind)


def cleaned(spark: SparkSession, path: str, left: int = LEFT) -> list[str]:
    """Remove folders that none of the last versions names; to be called when no writer is at work.  Returns their names."""
    numbers = [n for n in _numbers(spark, path) if _record(spark, path, n)]
    kept = {name for n in numbers[-left:] for name, _ in _record(spark, path, n).folders}
    fs, at = _fs(spark, path)
    gone = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("data-") and f.getPath().getName() not in kept]
    for p in gone:
        fs.delete(p, True)
    return [p.getName() for p in gone]
