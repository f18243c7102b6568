"""All-or-nothing publication of the exports of a run.

The match records and the participant detail belong together: a reader must never see the new one beside the
old other.  Each publication writes all its exports into a folder of its own that nobody reads yet, and then commits
one small manifest that names them:

    <root>/<export>/<hero>/<sdk>/<dates>/_version=<id>/   the data of one publication
    <root>/_manifests/<hero>/<sdk>/<dates>/<number>.json  {"version": ..., "exports": {name: folder}, "records": {...}}

The manifest is written under another name and renamed, which a file system does whole or not at all and never onto a
file that exists; the highest number is what readers follow.  A run that fails before that leaves the last publication as
it was; its folders are removed, and if that fails too they are unread leftovers for :func:`expire_publications`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from arenaflow.params import RunParams
from arenaflow.session import hadoop_path
from arenaflow.sources import exports


def _folder(p: RunParams, root: str, name: str, compact: bool = True) -> str:
    return p.export_path(root, name, compact).rstrip("/")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, found = hadoop_path(spark, path)
    stream = fs.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = hadoop_path(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, found = hadoop_path(spark, folder)
    if not fs.exists(found):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(found)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def _commit(spark: SparkSession, folder: str, manifest: dict, attempts: int = 20) -> int:
    """Adds a manifest behind the last one; two runs at once get two numbers."""
    fs, made = hadoop_path(spark, folder)
    fs.mkdirs(made)
    staged = f"{folder}/_staged-{uuid.uuid4().hex}"
    _write_text(spark, staged, json.dumps(manifest, sort_keys=True))
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(made).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    for _ in range(attempts):
        number = max(_numbers(spark, folder), default=0) + 1
        try:
            context.rename(hadoop_path(spark, staged)[1], hadoop_path(spark, f"{folder}/{number:08d}.json")[1], none)
            return number
        except Exception as taken:
            if "FileAlreadyExists" not in str(taken):
                raise
    raise RuntimeError(f"no free manifest number under {folder}")


def publish(
    spark: SparkSession, p: RunParams, root: str, records: Mapping[str, Callable[[], DataFrame]], compact: bool = True, **sink_options,
) -> dict:
    """Writes every export of ``records`` (name -> function that gives its ``(pt_dt, battle_info)`` rows) and commits them together.

    Returns the manifest.  If anything fails, what readers see does not change.
    """
    version = uuid.uuid4().hex
    folders = {name: f"{_folder(p, root, name, compact)}/_version={version}" for name in records}
    try:
        for name, rows in records.items():
            exports.write_keyed_text(rows(), folders[name], **sink_options)
        manifest = {"version": version, "exports": folders}
        manifest["number"] = _commit(spark, _folder(p, root, "_manifests", compact), manifest)
        return manifest
    except BaseException:
        for folder in folders.values():
            fs, found = hadoop_path(spark, folder)
            fs.delete(found, True)
        raise


def current_manifest(spark: SparkSession, p: RunParams, root: str, compact: bool = True) -> dict | None:
    """The manifest that readers follow, None before the first publication."""
    folder = _folder(p, root, "_manifests", compact)
    numbers = _numbers(spark, folder)
    if not numbers:
        return None
    return json.loads(_read_text(spark, f"{folder}/{numbers[-1]:08d}.json")) | {"number": numbers[-1]}


def read_published(spark: SparkSession, p: RunParams, root: str, compact: bool = True) -> dict[str, DataFrame]:
    """The exports of the last publication, as ``(pt_dt, battle_info)`` rows, all of one version."""
    manifest = current_manifest(spark, p, root, compact)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published for this run under {root}")
    return {name: exports.read_keyed_text(spark, folder) for name, folder in manifest["exports"].items()}


def expire_publications(spark: SparkSession, p: RunParams, root: str, names: tuple[str, ...], compact: bool = True) -> int:
    """Removes the versions of ``names`` that the last manifest doesn't name; returns how many folders went.

    Not while a publication or a reader of an older version runs.
    """
    manifest = current_manifest(spark, p, root, compact)
    kept = set(manifest["exports"].values()) if manifest else set()
    gone = 0
    for name in names:
        fs, found = hadoop_path(spark, _folder(p, root, name, compact))
        for status in fs.listStatus(found) if fs.exists(found) else ():
            folder = f"{_folder(p, root, name, compact)}/{status.getPath().getName()}"
            if status.getPath().getName().startswith("_version=") and folder not in kept:
                fs.delete(status.getPath(), True)
                gone += 1
    return gone
