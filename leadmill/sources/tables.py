"""Reference tables and listing files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("slug", T.StringType())])
METRO = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("seed_location", T.StringType())])
CITY = T.StructType([T.StructField("name", T.StringType()), T.StructField("state", T.StringType()), T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), T.StructField("population", T.IntegerType()), T.StructField("geoid", T.StringType())])


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON file that holds one array of records; a missing file is an empty table."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def categories(spark: SparkSession, path: str) -> DataFrame:
    return json_array(spark, path, CATEGORY)


def metros(spark: SparkSession, path: str) -> DataFrame:
    return json_array(spark, path, METRO)


def cities(spark: SparkSession, path: str) -> DataFrame:
    """City CSV with a header; rows that don't fit the schema are skipped."""
    return spark.read.csv(path, schema=CITY, header=True, mode="DROPMALFORMED").where("name is not null and geoid is not null")


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated Latin-1 places, columns by header; names of columns and values are trimmed."""
    raw = spark.read.option("sep", "|").option("encoding", "ISO-8859-1").csv(path, header=True)
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip().lower()) for c in raw.columns])


def listing_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Listings or masters as written by any run: all texts, blanks as nulls, columns by name across files.

    row_idx is a struct (file, line) that keeps file and row order for everything that lets the first row win: files
    by path, rows as they are in the file.  Files with the same header are read together, so the plan grows with the
    headers there are, not with the files; only one header a file reaches the driver.
    """
    first = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    headers: dict[str, list[str]] = {}
    for r in first.where("block = 0").groupBy("file").agg(F.min_by("value", "n").alias("header")).toLocalIterator():
        headers.setdefault(r.header, []).append(r.file)

    def one(files: list[str]) -> DataFrame:
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"').csv(sorted(files))
        row = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
        return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns], row.alias("row_idx"))

    if not headers:
        raise ValueError("no listing file has a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(headers[h]) for h in sorted(headers)])


def checkpoints(spark: SparkSession, folder: str, industry: str) -> DataFrame:
    """All finished list files `INDUSTRY--*.csv` of a folder, by name; columns are united by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{industry}--*.csv")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    paths = [str(f.getPath().toString()) for f in found or []]
    if not paths:
        raise FileNotFoundError(str(path))
    return listing_csv(spark, *paths)


def unfinished(lists: DataFrame, done: DataFrame, keys: list[str], again: bool = False) -> DataFrame:
    """Lists without a finished file; all of them if they are to run again."""
    return lists if again else lists.join(done.select(*keys).distinct(), keys, "left_anti")
