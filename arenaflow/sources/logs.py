"""The three logs of a run, and JSON-lines scans of them.

A JSON scan reads every field as text and converts it, so a number of an
unexpected JSON form (``2.0``, ``"2"``, ``5.5``) costs at most that one value,
never the row: ids and small integers become integers when the value is
integral, measures become doubles.  A value that cannot be converted (an
infinite one too) is NULL and its field is named in ``_uncast``; a line that is no JSON object is kept
in ``_corrupt_record``.  :func:`log_quality` counts both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.schemas import ADMISSIONS, CORRUPT_COLUMN, MATCHES, PARTICIPANTS, UNCAST_COLUMN, scanned_schema


@dataclass(frozen=True)
class Logs:
    """The three logs of a run.

    ``date_partitioned`` marks logs landed by :mod:`arenaflow.streaming`, whose
    ``pt_dt`` column is the date key of ``logtime``; the jobs then add the run's
    date range on it so whole partitions are pruned.  ``co_partitioned`` marks logs in buckets
    of the match id (:mod:`arenaflow.sources.bucketed`), which the jobs must not deal anew.
    """

    participants: DataFrame
    matches: DataFrame
    admissions: DataFrame
    date_partitioned: bool = False
    co_partitioned: bool = False

    @property
    def partition_key(self) -> str | None:
        return "pt_dt" if self.date_partitioned else None

    @classmethod
    def from_tables(cls, spark: SparkSession, participants: str, matches: str, admissions: str) -> Logs:
        """Logs that are catalog tables (or views), by name."""
        names = ((participants, PARTICIPANTS), (matches, MATCHES), (admissions, ADMISSIONS))
        return cls(*(read_table_log(spark, name, schema) for name, schema in names))

    @classmethod
    def from_json(cls, spark: SparkSession, participants, matches, admissions) -> Logs:
        """Logs that are JSON-lines files, by path or glob."""
        paths = ((participants, PARTICIPANTS), (matches, MATCHES), (admissions, ADMISSIONS))
        return cls(*(split_corrupt(read_json_log(spark, path, schema))[0] for path, schema in paths))


def read_table_log(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The log's fields of a catalog table; a stored date ``pt_dt`` is kept if there is one."""
    table = spark.table(name)
    return table.select(*schema.names, *(["pt_dt"] if "pt_dt" in table.columns else []))


def _converted(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        number = text.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(dtype))
    if isinstance(dtype, T.DoubleType):
        number = text.try_cast(dtype)
        return F.when(F.abs(number) < F.lit(float("inf")), number)  # not for NaN either, which is greater than all
    return text


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Converts the text fields of a raw scan; adds ``_uncast`` and keeps ``_corrupt_record``.

    ``_uncast`` is NULL when every value could be converted.
    """
    fields = scanned_schema(schema).fields
    numbers = [f for f in fields if not isinstance(f.dataType, T.StringType)]
    lost = F.array_compact(
        F.array(*(F.when(F.col(f.name).isNotNull() & _converted(F.col(f.name), f.dataType).isNull(), F.lit(f.name)) for f in numbers))
    )
    return raw.select(
        *(_converted(F.col(f.name), f.dataType).alias(f.name) for f in fields),
        F.when(F.size(lost) > 0, lost).alias(UNCAST_COLUMN),
        CORRUPT_COLUMN,
    )


def raw_reader(reader, schema: T.StructType):
    """A batch or stream reader set up for :func:`typed`: all fields as text, bad lines kept."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*schema.names, CORRUPT_COLUMN)])
    return reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)


def read_json_log(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Reads JSON lines (paths or globs, e.g. ``root/*/*/*/*``) without an inference pass.

    Columns: those of ``scanned_schema(schema)``, ``_uncast``, ``_corrupt_record``.
    """
    return typed(raw_reader(spark.read, schema).json(list(paths) if not isinstance(paths, str) else paths), schema)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows of every line that is JSON, without the two report columns; the other lines)``.

    The corrupt rows keep every column: a raw JSON scan may not be queried for
    the corrupt-record column alone (the parser would skip it).
    """
    good = df.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN, UNCAST_COLUMN)
    bad = df.where(F.col(CORRUPT_COLUMN).isNotNull())
    return good, bad


def log_quality(df: DataFrame) -> DataFrame:
    """One row: ``lines``, ``corrupt_lines``, ``uncast_values`` of a scan."""
    return df.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(CORRUPT_COLUMN).alias("corrupt_lines"),
        F.coalesce(F.sum(F.size(UNCAST_COLUMN)), F.lit(0)).alias("uncast_values"),
    )


def write_json_tree(df: DataFrame, path: str, logtime: str = "logtime", line: Column | None = None, compression: str = "none") -> str:
    """Writes a log as JSON lines in a ``year/month/ten days/`` tree (three directory
    levels plus the files, the depth of the raw log layout) and returns the
    four-level file glob.

    The rows are rebalanced by folder, so adaptive execution sizes the write
    tasks by bytes: small folders share one, a hot one is split.  They are shuffled and sorted as
    columns, which are narrower than their JSON text; this is made where it is written.  ``line``
    replaces the JSON text of a row.  ``compression`` is that of the text files: ``none``
    or ``gzip``, which a scan reads as it does plain ones; a file holds at most a million rows then, as
    one task must read it whole.
    """
    if compression not in ("none", "gzip"):
        raise ValueError(f"compression must be 'none' or 'gzip', not {compression!r}")
    folders = {"_y": F.substring(F.col(logtime), 1, 4), "_m": F.substring(F.col(logtime), 6, 2), "_d": F.substring(F.col(logtime), 9, 1)}
    text = line if line is not None else F.to_json(F.struct(*df.columns))
    rows = df.select("*", *(c.alias(n) for n, c in folders.items())).hint("rebalance", *folders).sortWithinPartitions(*folders)
    out = rows.select(text.alias("value"), *folders).write.mode("overwrite").partitionBy(*folders).option("compression", compression)
    if compression == "gzip":
        out = out.option("maxRecordsPerFile", 1_000_000).option("zlib.compress.level", "BEST_SPEED")
    out.text(path)
    return f"{path.rstrip('/')}/*/*/*/*.txt{'.gz' if compression == 'gzip' else ''}"
