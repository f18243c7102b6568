"""Keyed text export and its read-back.

Export layout: one directory per date key (``pt_dt=<yyyy-MM-dd>/``) holding
plain-text files, one record per line, no compression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.functions import FIELD_SEPARATOR
from arenaflow.session import hadoop_path


def rebalanced(records: DataFrame, key: str = "pt_dt", value: str = "battle_info") -> DataFrame:
    """``(key, value)`` rows with a rebalance on ``key``: adaptive execution sizes
    the write tasks (merging small dates, splitting a hot one)."""
    return records.select(key, value).hint("rebalance", key)


def write_keyed_text(
    records: DataFrame,
    path: str,
    key: str = "pt_dt",
    value: str = "battle_info",
    compression: str = "none",
    max_records_per_file: int | None = None,
    mode: str = "errorifexists",
    rebalance: bool = True,
) -> None:
    """Writes ``value`` lines into ``path/<key>=<k>/`` directories.

    The records are rebalanced on the key (adaptive execution then merges small
    dates into one task and splits a date that holds a large share of the rows
    into several, instead of sending a whole date to one task), and the writer
    sorts each task's rows by key so it keeps one file open at a time.  An export
    that is already there is an error unless ``mode="overwrite"`` asks for it to be replaced.

    Adaptive execution splits by compressed bytes, so a few dates of much alike records would still land in
    a task or two: for these ``rebalance=False`` writes every row where it lies, one file a task and date.
    """
    out = rebalanced(records, key, value) if rebalance else records.select(key, value)
    w = out.write.mode(mode).partitionBy(key).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.text(path)


def read_keyed_text(spark: SparkSession, path: str, key: str = "pt_dt", value: str = "battle_info", lineage: str | None = None) -> DataFrame:
    """Reads an export back as ``(key, value)`` rows, the key kept as text.

    ``lineage`` names a further column with the path of the file that a record comes from.
    Distributed: every file is a split; nothing is collected to the driver.  An export without any
    record reads as no rows.
    """
    fs, found = hadoop_path(spark, path)
    if fs.exists(found) and not any(status.getPath().getName().startswith(f"{key}=") for status in fs.listStatus(found)):
        names = (key, value, *([lineage] if lineage else []))
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(key, T.StringType())])
    origin = [F.col("_metadata.file_path").alias(lineage)] if lineage else []
    return spark.read.schema(schema).option("lineSep", "\n").text(path).select(key, F.col("value").alias(value), *origin)


def unpack(records: DataFrame, fields: Sequence[tuple[str, str]], value: str = "battle_info") -> DataFrame:
    """Splits U+0001 records into typed columns; an empty field, or one that is not of its type, reads as NULL.

    ``fields`` is ``[(name, spark_type), ...]`` in record order.  Every other
    column of ``records`` is kept in front.
    """
    parts = F.split(F.col(value), FIELD_SEPARATOR, -1)
    cols = []
    for i, (name, dtype) in enumerate(fields):
        raw = F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        cols.append((raw if dtype == "string" else raw.try_cast(dtype)).alias(name))
    keep = [c for c in records.columns if c != value]
    return records.select(*keep, *cols)
