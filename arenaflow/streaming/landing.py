"""Incremental landing of a JSON-lines log into Parquet partitioned by date.

The raw logs arrive as JSON files in a directory tree.  Scanning them for every
run re-parses all history row by row and cannot prune by date.  This stage
reads each new file exactly once (the file source tracks what it has read in
its checkpoint), puts lines that are no JSON into a quarantine table, together
with a note of every value that is not of its type (its row is landed with that
value NULL), and appends the parsed rows to Parquet partitioned by ``pt_dt`` (date key of ``logtime``), so
later runs read typed columns and prune partitions on the run's date range.

Run it with ``available_now=True`` as a scheduled batch (processes everything
new, then stops), or as a continuous stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arenaflow.functions import date_key
from arenaflow.schemas import CORRUPT_COLUMN, UNCAST_COLUMN, scanned_schema
from arenaflow.session import ensure_checkpoint_dir
from arenaflow.sources.logs import raw_reader, typed
from arenaflow.streaming.match_state import write_batch_states


def _write_batch(target: str, quarantine: str, fields: list[str], states: tuple[str, str] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is read twice (rows and bad lines); keep it for the two writes.
        batch = batch.persist()
        try:
            good = batch.where(F.col(CORRUPT_COLUMN).isNull()).select(*fields, date_key("logtime").alias("pt_dt"))
            bad = batch.where(F.col(CORRUPT_COLUMN).isNotNull() | F.col(UNCAST_COLUMN).isNotNull()).select(
                F.lit(batch_id).alias("batch_id"),
                F.coalesce(CORRUPT_COLUMN, F.to_json(F.struct(*fields))).alias("line"),
                F.col(UNCAST_COLUMN).alias("uncast"),
            )
            # Each micro-batch writes only its own (pt_dt, batch_id) partitions
            # with dynamic overwrite: a batch replayed after a failure between
            # the write and the offset commit replaces its earlier output
            # instead of duplicating it.
            (
                good.withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("pt_dt", "batch_id")
                .parquet(target)
            )
            bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
                quarantine
            )
            if states:  # last, so that a batch with states has its rows landed; replays replace them too
                log, root = states
                write_batch_states(batch.where(F.col(CORRUPT_COLUMN).isNull()).select(*fields), log, root, batch_id)
        finally:
            batch.unpersist()

    return write


def land_log(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    quarantine: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    states: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Starts the landing stream for one log; returns the running query.

    ``states=(log, root)`` also keeps the states of the consolidated match view of every batch
    (see :mod:`arenaflow.streaming.match_state`), for the log ``participants`` or ``matches``.

    ``source`` is a directory or glob of JSON-lines files.  ``checkpoint``
    defaults to a folder under ``spark.checkpoint.dir`` derived from ``target``.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = target.rstrip("/").replace("://", "_").replace("/", "_")
    checkpoint = checkpoint or f"{root}/arenaflow-landing/{name}"
    quarantine = quarantine or f"{target.rstrip('/')}_corrupt"
    reader = raw_reader(spark.readStream, schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    fields = schema.names
    stream = typed(reader.json(source), schema)
    writer = stream.writeStream.foreachBatch(_write_batch(target, quarantine, fields, states)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_landed(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    start: str | None = None,
    end: str | None = None,
    keep_partition: bool = False,
) -> DataFrame:
    """Reads a landed log with its declared schema; a date range prunes ``pt_dt``
    partitions.  ``keep_partition`` keeps the ``pt_dt`` column, so the job
    filters on the run's date range prune partitions too."""
    full = T.StructType(
        list(scanned_schema(schema).fields)
        + [T.StructField("pt_dt", T.StringType()), T.StructField("batch_id", T.LongType())]
    )
    df = spark.read.schema(full).parquet(target)
    if start is not None and end is not None:
        df = df.where((F.col("pt_dt") >= F.lit(start)) & (F.col("pt_dt") <= F.lit(end)))
    cols = [f.name for f in schema.fields] + (["pt_dt"] if keep_partition else [])
    return df.select(*cols)
