"""Intermediate results written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arenaflow.session import hadoop_path, scratch_dir


# For rows of a MB and more.  Parquet looks at the size of pages and row groups only after 100 rows by default, and
# compresses and decompresses a page in buffers of its size outside the heap; row groups bound what a reader holds.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "10000",
    "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20),
}


def materialize_at(df: DataFrame, purpose: str = "materialized", large_rows: bool = False) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet under the shared checkpoint folder; returns the
    read-back and the folder (see :func:`remove_folder`)."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.mode("overwrite").options(**LARGE_ROWS if large_rows else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, purpose: str = "materialized") -> DataFrame:
    """Writes ``df`` as Parquet under the shared checkpoint folder and returns
    the read-back.

    Cuts the lineage (a lost executor re-reads the files instead of re-running
    the upstream joins) and lets the result feed several consumers without
    recomputation.  One job, unlike an eager ``checkpoint()``, which computes
    its input once to count it and again to write it.  The folder goes with the
    application.
    """
    return materialize_at(df, purpose)[0]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a materialized folder through the Hadoop file system of its URI
    (local, HDFS or object store alike), once nothing reads it any more."""
    fs, found = hadoop_path(spark, path)
    fs.delete(found, True)
