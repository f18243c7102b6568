"""An incrementally kept index of a JSON-lines tree: which files hold which log times.

A run over a date range reads only a part of a log, but the tree's folders say nothing about
dates, so without an index every file is opened and parsed.  The index has one row a file version
(path, size, modification time) with its number of lines and its first and last
``logtime``.  It is a Parquet folder that grows by appending; a file that was changed has another version, so its old row
no longer matches and it is read, until it is indexed again.

The folder listing comes from a ``binaryFile`` scan without the content, so no file is opened for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.functions import date_range
from arenaflow.operators.filters import in_log_window
from arenaflow.schemas import CORRUPT_COLUMN, UNCAST_COLUMN, scanned_schema
from arenaflow.session import hadoop_path
from arenaflow.sources.logs import read_json_log

VERSION = ("path", "size", "modified")
INDEX = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("lines", T.LongType()),
        T.StructField("dated", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ]
)


def list_files(spark: SparkSession, paths: str) -> DataFrame:
    """``path``, ``size``, ``modified``, ``uri`` of the files of a path or glob that are not empty; no file is opened."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("uri"))


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The index's rows, each file version once; no rows if there is no index yet."""
    fs, found = hadoop_path(spark, index)
    if not fs.exists(found):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(index).dropDuplicates(VERSION)


def update_index(spark: SparkSession, paths: str, index: str) -> int:
    """Indexes the files that are new or changed since the last update; returns how many.

    Only these are read, and of their lines only the log time is parsed.  A line without one (no
    JSON, or no ``logtime``) counts as undated.  Running it twice, or after a failure, does no harm.
    """
    files = list_files(spark, paths)
    new = files.join(read_index(spark, index), list(VERSION), "left_anti").collect()  # paths alone, which a reader needs on the driver
    if not new:
        return 0
    logtime = T.StructType([T.StructField("logtime", T.StringType())])
    lines = spark.read.schema(logtime).json([r["path"] for r in new]).select(F.col("_metadata.file_path").alias("uri"), "logtime")
    found = lines.groupBy("uri").agg(
        F.count(F.lit(1)).alias("lines"), F.count("logtime").alias("dated"), F.min("logtime").alias("first"), F.max("logtime").alias("last")
    )
    versions = spark.createDataFrame([tuple(r) for r in new], "path string, size long, modified timestamp, uri string")
    rows = versions.join(found, "uri", "left").fillna(0, ["lines", "dated"])  # a file without a line
    rows.select(*INDEX.names).write.mode("append").parquet(index)
    return len(new)


def files_in_range(spark: SparkSession, paths: str, index: str, start: str, end: str) -> DataFrame:
    """``path`` of the files that may hold log times in ``[start, end]``: those whose first and last log time
    enclose a part of the range, and those that the index doesn't know in their present version."""
    found = list_files(spark, paths).join(read_index(spark, index).withColumn("_known", F.lit(True)), list(VERSION), "left")
    # the range test holds for some time between first and last if neither lies outside it on its side
    after, before = date_range("last", start, "9999-12-31"), date_range("first", "0000-01-01", end)
    return found.where(F.col("_known").isNull() | (after & before)).select("path")


def read_json_log_range(spark: SparkSession, paths: str, schema: T.StructType, index: str, start: str, end: str) -> DataFrame:
    """The rows of a JSON log (as :func:`arenaflow.sources.logs.read_json_log` gives them) whose date key lies in
    ``[start, end]``; opens only the files of :func:`files_in_range`.

    Equals reading everything and filtering.  Broken and undated lines are in no range, so none is returned here.
    """
    chosen = [r["path"] for r in files_in_range(spark, paths, index, start, end).collect()]
    if not chosen:
        fields = [*scanned_schema(schema).fields, T.StructField(UNCAST_COLUMN, T.ArrayType(T.StringType())), T.StructField(CORRUPT_COLUMN, T.StringType())]
        return spark.createDataFrame([], T.StructType(fields))
    return in_log_window(read_json_log(spark, chosen, schema), start, end)
