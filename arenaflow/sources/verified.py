"""Verified read-back of a keyed text export: fingerprints, file lineage, records of a wrong width.

The fingerprint of a date is independent of order, file layout and duplicates' places: the number of its records and
the sums of two 64-bit hashes of them (each with its date), in decimals that no sum passes.  A lost, added or
changed record changes it.

The sink takes the fingerprint of the whole export on the way to the files, reads the files once to take each
date's, and compares the two, so that a fault of the write shows at once.  The dates' fingerprints stay in
``<export>/_fingerprint``, which readers of the export don't see.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arenaflow.functions import FIELD_SEPARATOR
from arenaflow.sources.exports import read_keyed_text, rebalanced, unpack

FOLDER = "_fingerprint"
# What a check says of a date.
SAME, CHANGED, MISSING, UNEXPECTED = "same", "changed", "missing", "unexpected"


class ExportDamaged(RuntimeError):
    """The records of an export are not those that were written."""


def _sums(key: str, value: str) -> list[Column]:
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), F.col(key), F.col(value)).cast("decimal(38,0)"))

    return [F.count(F.lit(1)).alias("records"), total(1).alias("hash_1"), total(2).alias("hash_2")]


def fingerprints(records: DataFrame, key: str = "pt_dt", value: str = "battle_info") -> DataFrame:
    """``pt_dt``, ``records``, ``hash_1``, ``hash_2``: one row a date, combined map-side."""
    return records.groupBy(key).agg(*_sums(key, value))


def write_verified_text(records: DataFrame, path: str, key: str = "pt_dt", value: str = "battle_info", mode: str = "errorifexists") -> None:
    """:func:`arenaflow.sources.exports.write_keyed_text` with fingerprints; raises :class:`ExportDamaged` if the
    files do not hold the records that went into them."""
    spark = records.sparkSession
    seen = Observation()
    out = rebalanced(records, key, value).observe(seen, *_sums(key, value))
    out.write.mode(mode).partitionBy(key).option("compression", "none").text(path)
    written = fingerprints(read_keyed_text(spark, path, key, value), key, value)
    written.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{FOLDER}")
    total = spark.read.parquet(f"{path.rstrip('/')}/{FOLDER}").agg(*(F.sum(c).alias(c) for c in ("records", "hash_1", "hash_2"))).first()
    want = seen.get
    if (want["records"] or 0, want["hash_1"], want["hash_2"]) != (total["records"] or 0, total["hash_1"], total["hash_2"]):
        raise ExportDamaged(f"{path}: {want['records']} records went in, {total['records']} are there, or some differ")


def read_traced_text(spark: SparkSession, path: str, key: str = "pt_dt", value: str = "battle_info") -> DataFrame:
    """The export's records with the file that each comes from (``_file``)."""
    return read_keyed_text(spark, path, key, value, lineage="_file")


def check_export(spark: SparkSession, path: str, key: str = "pt_dt", value: str = "battle_info") -> DataFrame:
    """``pt_dt``, ``status``, ``records`` (now), ``written`` (then): one row a date, also for dates that are gone."""
    then = spark.read.parquet(f"{path.rstrip('/')}/{FOLDER}")
    then = then.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in ("records", "hash_1", "hash_2")))
    now = fingerprints(read_keyed_text(spark, path, key, value), key, value)
    same = (F.col("records") == F.col("_records")) & (F.col("hash_1") == F.col("_hash_1")) & (F.col("hash_2") == F.col("_hash_2"))
    status = F.when(F.col("_records").isNull(), UNEXPECTED).when(F.col("records").isNull(), MISSING).when(same, SAME).otherwise(CHANGED)
    return now.join(then, F.col(key).eqNullSafe(F.col("_key")), "full").select(
        F.coalesce(key, "_key").alias(key), status.alias("status"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("_records", F.lit(0)).alias("written")
    )


def split_by_width(records: DataFrame, width: int, value: str = "battle_info") -> tuple[DataFrame, DataFrame]:
    """``(records of that many fields, the others with their width in ``_width``)``."""
    found = F.size(F.split(F.col(value), FIELD_SEPARATOR, -1))
    return records.where(found == width), records.where(found != width).withColumn("_width", found)


def read_verified(spark: SparkSession, path: str, fields: Sequence[tuple[str, str]], key: str = "pt_dt") -> tuple[DataFrame, DataFrame]:
    """``(typed rows with their file, error rows)`` of an export whose fingerprints hold.

    Raises :class:`ExportDamaged`, naming the dates, if some do not.  A record with more or fewer than
    ``fields`` goes to the error rows, with its file and its width.
    """
    bad = check_export(spark, path, key).where(F.col("status") != SAME).orderBy(key).limit(20).collect()  # a report, not the data
    if bad:
        raise ExportDamaged(f"{path}: " + ", ".join(f"{r[key]} {r['status']} ({r['written']} written, {r['records']} there)" for r in bad))
    good, wrong = split_by_width(read_traced_text(spark, path, key), len(fields))
    return unpack(good, fields), wrong
