"""The consolidated match view kept incrementally.

Aggregating the whole history of both logs for every run costs a scan that grows
without end.  Here each landed batch leaves the mergeable state of its matches (minima and
sums, see :func:`arenaflow.operators.aggregates.match_states`) beside the landed rows:

    <root>/<log>/states/batch_id=<n>/   states of one batch, at most one row per match
    <root>/<log>/base/upto=<n>/         merged states of all batches up to n

A reader takes the newest complete base and the batches after it and merges them in one
aggregation over at most one row per match and batch.  A batch that is written again
(replayed after a failure) replaces its own folder; a batch that a base holds already is not read.
A base counts once Spark's success marker is there, so a compaction that fails halfway is never seen.

A late row lands in a later batch and merges like any other; a repeated row counts again, as it does in the
view over the raw logs.  Batch ids of a log must grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arenaflow.operators.aggregates import match_states, merged_states, view_of_states
from arenaflow.session import hadoop_path

LOGS = ("participants", "matches")


def batch_states(rows: DataFrame, log: str) -> DataFrame:
    """States of the matches in a batch of one log (``participants`` or ``matches``)."""
    if log not in LOGS:
        raise ValueError(f"log must be one of {LOGS}, not {log!r}")
    return match_states(rows) if log == "participants" else match_states(None, rows, wide=True)


def write_batch_states(rows: DataFrame, log: str, root: str, batch_id: int) -> None:
    """Writes the states of a batch; writing the same batch again replaces them."""
    path = f"{root.rstrip('/')}/{log}/states/batch_id={int(batch_id)}"
    batch_states(rows, log).write.mode("overwrite").parquet(path)


def _numbered_folders(spark: SparkSession, path: str, key: str) -> dict[int, str]:
    """Complete ``<key>=<n>`` folders of a path, by their number."""
    fs, found = hadoop_path(spark, path)
    if not fs.exists(found):
        return {}
    out = {}
    for status in fs.listStatus(found):
        name = status.getPath().getName()
        if name.startswith(f"{key}=") and fs.exists(hadoop_path(spark, f"{path}/{name}/_SUCCESS")[1]):
            out[int(name.partition("=")[2])] = f"{path}/{name}"
    return out


def _log_states(spark: SparkSession, root: str, log: str, upto: int | None = None) -> tuple[DataFrame | None, int]:
    """States of one log, one row per match and folder, and the last batch among them (-1: none)."""
    path = f"{root.rstrip('/')}/{log}"
    bases = {n: p for n, p in _numbered_folders(spark, f"{path}/base", "upto").items() if upto is None or n <= upto}
    base = max(bases, default=-1)
    batches = {n: p for n, p in _numbered_folders(spark, f"{path}/states", "batch_id").items() if n > base and (upto is None or n <= upto)}
    folders = [*([bases[base]] if base >= 0 else []), *(batches[n] for n in sorted(batches))]
    if not folders:
        return None, -1
    return spark.read.parquet(*folders), max(base, *batches, -1)


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """One state per match over everything landed in ``root``."""
    parts = [states for log in LOGS if (states := _log_states(spark, root, log)[0]) is not None]
    if not parts:
        raise ValueError(f"no complete batch under {root}")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return merged_states(rows)


def landed_match_view(spark: SparkSession, root: str) -> DataFrame:
    """The consolidated view of everything landed so far; equals
    :func:`arenaflow.operators.aggregates.match_view` over the landed rows."""
    return view_of_states(read_states(spark, root))


def compact_states(spark: SparkSession, root: str, log: str, upto: int | None = None) -> int:
    """Merges the batches up to ``upto`` (default: all) into a base; returns its last batch, -1 if there is none.

    Readers use it once it is complete.  :func:`expire_states` then removes what it replaces.
    """
    states, last = _log_states(spark, root, log, upto)
    if states is not None:
        merged_states(states).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{log}/base/upto={last}")
    return last


def expire_states(spark: SparkSession, root: str, log: str) -> int:
    """Deletes the folders that the newest complete base replaces; returns how many.  Not while an older reader runs."""
    path = f"{root.rstrip('/')}/{log}"
    bases = _numbered_folders(spark, f"{path}/base", "upto")
    base = max(bases, default=-1)
    old = [p for n, p in bases.items() if n < base] + [p for n, p in _numbered_folders(spark, f"{path}/states", "batch_id").items() if n <= base]
    for folder in old:
        fs, found = hadoop_path(spark, folder)
        fs.delete(found, True)
    return len(old)
