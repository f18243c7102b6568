"""Heavy hitters of a key: mergeable bounded summaries, an exact recount, and a join that spreads them.

A key that holds more than a share 1/k of the rows is one of at most k keys.  Each task keeps a Misra-Gries
summary of at most k keys of its rows; summaries merge into summaries of at most k keys, in rounds of a fixed fan-in, and
no key over the share is ever lost.  The few candidates are then counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.operators.sizing import materialize
from arenaflow.session import ship_package

SUMMARY = T.StructType([T.StructField("key", T.LongType()), T.StructField("weight", T.LongType())])
# Summaries that one merging task reads.
FAN_IN = 32


class Summary:
    """Misra-Gries summary of at most ``capacity`` keys: a key's weight is at most its count, and short of it
    by no more than (rows seen) / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.weights = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        found, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, np.concatenate([self.weights, weights]))
        if len(found) > self.capacity:
            # take the weight of the (capacity + 1)-th key from all: what is taken, is taken from capacity + 1 keys at once
            total = total - np.partition(total, len(total) - self.capacity - 1)[len(total) - self.capacity - 1]
        self.keys, self.weights = found[total > 0], total[total > 0]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.weights)], schema=schema)


def _summarise(rows: DataFrame, capacity: int) -> DataFrame:
    """One summary a partition, of ``(key, weight)`` rows."""
    ship_package(rows.sparkSession)
    schema = to_arrow_schema(SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            summary.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield summary.batch(schema)

    return rows.mapInArrow(run, SUMMARY)


def candidate_keys(rows: DataFrame, key: str, capacity: int, fan_in: int = FAN_IN) -> DataFrame:
    """``key``: at most ``capacity`` keys, among them every key with more than 1 / (capacity + 1) of the rows.

    The summaries are merged in rounds: a merging task reads ``fan_in`` summaries, however many tasks there were.
    """
    summaries = materialize(_summarise(rows.select(F.col(key).cast("long").alias("key"), F.lit(1).cast("long").alias("weight")), capacity), "summaries")
    parts = -(-summaries.count() // (capacity * fan_in))
    while parts > 1:
        dealt = summaries.repartition(parts)
        summaries = materialize(_summarise(dealt, capacity), "summaries")
        parts = -(-parts // fan_in)
    return _summarise(summaries.coalesce(1), capacity).select("key")


def heavy_hitters(rows: DataFrame, key: str, share: float) -> DataFrame:
    """``(key, row_count)`` of the integer keys that hold more than ``share`` of all rows, counted exactly.

    Rows with a NULL key count towards all rows and are no key.  At most ``1 / share`` rows come out.
    """
    if not 0 < share < 1:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    capacity = int(1 / share) + 1
    candidates = materialize(candidate_keys(rows, key, capacity).withColumnRenamed("key", "_candidate"), "candidates")  # at most ``capacity`` rows
    least = share * rows.count()
    known = rows.select(key).join(F.broadcast(candidates), F.col(key) == F.col("_candidate"), "left_semi")
    return known.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > least)


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame, salts: int = 32) -> DataFrame:
    """``left JOIN right`` (inner) on an integer key, with the rows of hot keys spread over ``salts`` tasks.

    ``hot``: keys in the first column of a table of bounded size, as :func:`heavy_hitters` gives it.  The left rows of a hot key
    are dealt over the salts, its right rows are repeated for each; all other keys have one salt.  Bag
    semantics and the columns of a plain join.
    """
    ids = hot.select(F.col(hot.columns[0]).cast("long").alias("_hot"))
    dealt = left.join(F.broadcast(ids), F.col(left_key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    )
    repeated = right.join(F.broadcast(ids), F.col(right_key) == F.col("_hot"), "left").withColumn(
        "_r_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    dealt, repeated = dealt.drop("_hot"), repeated.drop("_hot")
    joined = dealt.join(repeated, (dealt[left_key] == repeated[right_key]) & (F.col("_salt") == F.col("_r_salt")))
    return joined.drop("_salt", "_r_salt")
