"""One large framed file decoded by many tasks.

A gzip file may consist of several members, one behind the other; each can be inflated by itself.  An index of
the members, made by streaming through every file once, notes where each begins, how many of its bytes belong to a
frame that began before it, and the numbers of its first frame and section.  With it every
member is a unit of work: a task seeks to it and reads the frames that begin there (the last one may reach into the next
member).  The index is a small table to be kept beside the files: the writer of :mod:`arenaflow.sources.framed` cuts members
with ``member_frames``, and files of other writers are split wherever they have members.

Sections, markers and errors are those of :func:`arenaflow.sources.framed.decode_stream`: of several errors in a file the
first one counts.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaflow.session import ship_package
from arenaflow.sources.framed import BAD_GZIP, BAD_LENGTH, BAD_UTF8, MARKER, OK, TRUNCATED_HEADER, TRUNCATED_PAYLOAD, arrow_uri

# One row a member; ``status`` and ``markers`` are the file's.
INDEX = "path string, member int, start bigint, skip bigint, frames bigint, first_frame bigint, first_section bigint, markers bigint, status string"
FRAMES = "path string, section bigint, frame bigint, text string, bad boolean"
_CHUNK = 1 << 20


class Walker:
    """Walks over frames in pieces of any size, keeping only what is open."""

    def __init__(self):
        self.header, self.left = b"", 0
        self.frames = self.markers = 0
        self.error: str | None = None
        self.open_member(0)

    def open_member(self, start: int) -> None:
        self.member = {"start": start, "skip": 0, "frames": 0, "first_frame": self.frames, "first_section": self.markers}
        self.size = 0

    def feed(self, data: bytes) -> None:
        at = 0
        while at < len(data) and not self.error:
            if self.left:
                step = min(self.left, len(data) - at)
                self.left -= step
                at += step
                continue
            if not self.header and not self.member["frames"]:
                self.member |= {"skip": self.size + at, "first_frame": self.frames, "first_section": self.markers}
            if not self.header:
                self.member["frames"] += 1
                self.owner = self.member
            taken = data[at : at + 4 - len(self.header)]
            self.header += taken
            at += len(taken)
            if len(self.header) == 4:
                length = int.from_bytes(self.header, "little", signed=True)
                self.header = b""
                if length < MARKER:
                    self._fail(BAD_LENGTH)
                    return
                self.frames += 1
                if length == MARKER:
                    self.markers += 1
                else:
                    self.left = length
        self.size += len(data)

    def _fail(self, error: str) -> None:
        self.error = error
        self.owner["frames"] -= 1  # the frame at fault is not read again

    def end(self) -> None:
        if not self.error and self.header:
            self._fail(TRUNCATED_HEADER)
        elif not self.error and self.left:
            self._fail(TRUNCATED_PAYLOAD)


def walk_members(raw: BinaryIO) -> tuple[list[dict], int, str]:
    """``(members, markers, status)`` of a compressed stream."""
    walker, members, at = Walker(), [], 0
    inflater, pending = zlib.decompressobj(wbits=31), b""
    fresh, any_data = True, False
    try:
        while not walker.error:
            chunk = pending or raw.read(_CHUNK)
            if not chunk:
                if not fresh:
                    raise EOFError("a member without an end")
                break
            if fresh and members:
                rest = chunk.lstrip(b"\0")  # padding between members
                at += len(chunk) - len(rest)
                if not rest:
                    pending = b""
                    continue
                chunk = rest
                walker.open_member(at)
                inflater = zlib.decompressobj(wbits=31)
            fresh, any_data = False, True
            walker.feed(inflater.decompress(chunk, _CHUNK))
            while not walker.error and inflater.unconsumed_tail:
                walker.feed(inflater.decompress(inflater.unconsumed_tail, _CHUNK))
            at += len(chunk) - len(inflater.unused_data)
            pending = inflater.unused_data
            if inflater.eof or walker.error:
                members.append(walker.member)
                fresh = True
        walker.end()
    except (EOFError, zlib.error):
        if any_data and (not members or members[-1] is not walker.member):
            members.append(walker.member)
        return members, walker.markers, BAD_GZIP
    return members, walker.markers, walker.error or OK


def _index_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    columns = ["path", "member", "start", "skip", "frames", "first_frame", "first_section", "markers", "status"]
    for batch in batches:
        for path in batch["path"]:
            filesystem, found = fs.FileSystem.from_uri(arrow_uri(path))
            with filesystem.open_input_stream(found, compression=None) as raw:
                members, markers, status = walk_members(raw)
            members = members or [{"start": 0, "skip": 0, "frames": 0, "first_frame": 0, "first_section": 0}]
            yield pd.DataFrame([{"path": path, "member": k, **m, "markers": markers, "status": status} for k, m in enumerate(members)])[columns]


def index_members(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """The index of every framed file under ``path`` (see ``INDEX``); a file without a member has one row.

    Each file is streamed once in bounded memory, payloads are skipped.  Write the result and reuse it.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path").mapInPandas(_index_paths, INDEX)


def read_member(raw: BinaryIO, start: int, skip: int, frames: int, first_frame: int, section: int) -> Iterator[tuple[int, int, str | None, bool]]:
    """``(section, frame, text, bad)`` of the non-empty frames that begin in a member, from the first marker on."""
    raw.seek(start)
    with gzip.GzipFile(fileobj=raw, mode="rb") as gz:
        while skip:
            skip -= len(gz.read(min(skip, _CHUNK)))
        for frame in range(first_frame, first_frame + frames):
            length = int.from_bytes(gz.read(4), "little", signed=True)
            if length == MARKER:
                section += 1
                continue
            payload = gz.read(length) if length else b""
            if section and payload:
                try:
                    yield section, frame, payload.decode("utf-8"), False
                except UnicodeDecodeError:
                    yield section, frame, None, True


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    def table(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["path", "section", "frame", "text", "bad"])

    for batch in batches:
        for row in batch.itertuples(index=False):
            filesystem, found = fs.FileSystem.from_uri(arrow_uri(row.path))
            with filesystem.open_input_file(found) as raw:
                rows, size = [], 0
                buffered = io.BufferedReader(raw, _CHUNK)
                for section, frame, text, bad in read_member(buffered, row.start, row.skip, row.frames, row.first_frame, row.first_section):
                    rows.append((row.path, section, frame, text, bad))
                    size += len(text or "")
                    if size > _CHUNK or len(rows) >= 10_000:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)


def read_frames(index: DataFrame) -> DataFrame:
    """``path``, ``section``, ``frame``, ``text``, ``bad`` of every frame after a file's first marker, one
    member a unit of work."""
    ship_package(index.sparkSession)
    # a frame that reaches beyond a member that never ends can't be read again: such files give no frames
    units = index.where((F.col("frames") > 0) & (F.col("status") != BAD_GZIP))
    return units.repartition("path", "member").mapInPandas(_read_members, FRAMES)


def split_sections(index: DataFrame) -> DataFrame:
    """``path``, ``section_text``, ``frame_count``, ``status``: what :func:`arenaflow.sources.framed.read_sections` gives
    for the files of an index, each decoded by as many tasks as it has members.

    Only the frames of a file's last closed section are shuffled, and faults of other frames as one flag.
    """
    files = index.groupBy("path").agg(F.max("markers").alias("markers"), F.max("status").alias("status"))
    frames = read_frames(index).join(files.select(F.col("path").alias("_path"), F.col("markers").alias("_markers")), F.col("path") == F.col("_path"))
    last = F.col("section") == F.col("_markers") - 1
    found = frames.where(last | F.col("bad")).groupBy("path").agg(
        F.bool_or("bad").alias("bad"),
        F.count_if(last).alias("n"),
        F.array_sort(F.collect_list(F.when(last & ~F.col("bad"), F.struct("frame", F.concat("text", F.lit("\n")).alias("text"))))).alias("texts"),
    )
    status = F.when((F.col("status") != BAD_GZIP) & F.coalesce("bad", F.lit(False)), F.lit(BAD_UTF8)).otherwise(F.col("status"))
    joined = files.join(found, "path", "left").withColumn("status", status)
    text = F.coalesce(F.array_join(F.col("texts.text"), ""), F.lit(""))
    return joined.select(
        "path",
        F.when(F.col("status") == OK, text).alias("section_text"),
        F.when(F.col("status") == OK, F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("frame_count"),
        "status",
    )
