"""Length-framed binary records.

File format: gzip of a sequence of frames, each a little-endian signed int32
length followed by that many UTF-8 bytes.  A length of -1 is a section marker
without payload.  The extracted text of a file is the section closed by the
last marker: every marker publishes the text gathered since the previous
marker and starts a new one, frames before the first marker and after the
last one are dropped, every kept non-empty frame is followed by a newline.

Each file is one row of a ``binaryFile`` scan (gzip is not splittable), decoded
in ``mapInPandas`` and given out file by file; a malformed file yields
an error row instead of failing the job or silently truncating.
"""

from __future__ import annotations

import gzip
import io
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.session import hadoop_path, ship_package

# The section marker and the status texts of the decoder.
MARKER = -1
OK = "ok"
TRUNCATED_HEADER = "truncated_header"
TRUNCATED_PAYLOAD = "truncated_payload"
BAD_LENGTH = "bad_length"
BAD_UTF8 = "bad_utf8"
BAD_GZIP = "bad_gzip"

_HEADER = struct.Struct("<i")


def _header(length: int) -> bytes:
    """Little-endian int32 length word (module-level, so task closures pickle it by reference)."""
    return struct.pack("<i", length)

SECTION_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("section_text", T.StringType()),
        T.StructField("frame_count", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


def encode_frames(payloads: Iterable[bytes | str | None]) -> bytes:
    """Frames for ``payloads``; ``None`` writes a section marker."""
    out = bytearray()
    for item in payloads:
        if item is None:
            out += _HEADER.pack(MARKER)
            continue
        data = item.encode("utf-8") if isinstance(item, str) else bytes(item)
        out += _HEADER.pack(len(data)) + data
    return bytes(out)


def decode_stream(stream: BinaryIO) -> tuple[str | None, int, str]:
    """``(section_text, frame_count, status)`` of an uncompressed frame stream,
    read frame by frame: only the open section and the last closed one are held."""
    current: list[str] = []
    result: list[str] = []
    seen_marker = False
    while True:
        header = stream.read(4)
        if not header:
            break
        if len(header) < 4:
            return None, 0, TRUNCATED_HEADER
        (length,) = _HEADER.unpack(header)
        if length == MARKER:
            seen_marker = True
            result, current = current, []
            continue
        if length < 0:
            return None, 0, BAD_LENGTH
        payload = stream.read(length) if length else b""
        if len(payload) < length:
            return None, 0, TRUNCATED_PAYLOAD
        if seen_marker and length:
            try:
                current.append(payload.decode("utf-8"))
            except UnicodeDecodeError:
                return None, 0, BAD_UTF8
    return "".join(t + "\n" for t in result), len(result), OK


def decode_frames(data: bytes) -> tuple[str | None, int, str]:
    """:func:`decode_stream` over bytes in memory."""
    return decode_stream(io.BytesIO(data))


def decode_gzip_stream(raw: BinaryIO) -> tuple[str | None, int, str]:
    """Gunzip on the fly, then :func:`decode_stream`."""
    try:
        with gzip.GzipFile(fileobj=raw, mode="rb") as gz:
            return decode_stream(gz)
    except (OSError, EOFError, zlib.error):
        return None, 0, BAD_GZIP


def decode_file(content: bytes) -> tuple[str | None, int, str]:
    """Gunzip then :func:`decode_frames`."""
    return decode_gzip_stream(io.BytesIO(content))


def arrow_uri(path: str) -> str:
    """A path of Spark's as pyarrow wants it."""
    # Spark reports local files as file:/path, pyarrow wants file:///path; Hadoop's s3a is pyarrow's s3
    if path.startswith(("s3a://", "s3n://")):
        return "s3" + path[3:]
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return path if "://" in path else "file://" + path


def _decode_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for path in batch["path"]:
            filesystem, fpath = fs.FileSystem.from_uri(arrow_uri(path))
            with filesystem.open_input_stream(fpath, compression=None) as raw:
                yield _section_frame(path, decode_gzip_stream(raw))


def _decode_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            yield _section_frame(path, decode_file(content))


def _section_frame(path: str, decoded: tuple[str | None, int, str]) -> pd.DataFrame:
    """The result row of one file; one frame a file, so a task holds one section at a time."""
    return pd.DataFrame([(path, *decoded)], columns=SECTION_SCHEMA.names)


def read_sections(spark: SparkSession, path: str, glob: str = "*.gz", stream: bool = False) -> DataFrame:
    """One row per framed file under ``path``: ``(path, section_text, frame_count, status)``.

    The files come from a ``binaryFile`` scan, so any store that Spark reads will
    do; a task holds an Arrow batch of compressed files and one decoded section.
    With ``stream`` only the paths are read from the scan and each file is
    streamed through gzip frame by frame by pyarrow (local, HDFS and S3 paths),
    for files too large to be held whole.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    if stream:
        return files.select("path").mapInPandas(_decode_paths, SECTION_SCHEMA)
    return files.select("path", "content").mapInPandas(_decode_contents, SECTION_SCHEMA)


def _file_writer(out_dir: str, enclosed: bool, member_frames: int | None):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        state = {"key": None, "raw": None, "gz": None, "bytes": 0, "frames": 0}
        done: list[tuple[int, int]] = []

        def close():
            if state["gz"] is not None:
                if enclosed:
                    put(_header(MARKER))
                state["gz"].close()
                state["raw"].close()
                done.append((state["key"], state["bytes"]))
                state.update(key=None, raw=None, gz=None, bytes=0, frames=0)

        def open_(key: int):
            target = arrow_uri(f"{out_dir.rstrip('/')}/conv_{key}.gz")
            filesystem, fpath = fs.FileSystem.from_uri(target)
            raw = filesystem.open_output_stream(fpath, compression=None)
            state.update(key=key, raw=raw, gz=member(raw), bytes=0, frames=0)
            if enclosed:
                put(_header(MARKER))

        def member(raw) -> gzip.GzipFile:
            # fixed header fields: a retried task rewrites identical bytes
            return gzip.GzipFile(filename="", fileobj=raw, mode="wb", mtime=0)

        def put(data: bytes):
            state["gz"].write(data)
            state["bytes"] += len(data)

        for batch in batches:
            for key, kind, text in zip(batch["conv_id"], batch["kind"], batch["text"], strict=True):
                key = int(key)
                if key != state["key"]:
                    close()
                    open_(key)
                data = (text if isinstance(text, str) else "").encode("utf-8")
                if member_frames and state["frames"] == member_frames:
                    state["gz"].close()
                    state.update(gz=member(state["raw"]), frames=0)
                put(_header(MARKER) if kind == "marker" else data if kind == "raw" else _header(len(data)) + data)
                state["frames"] += 1
            if done:
                yield pd.DataFrame(done, columns=["conv_id", "file_bytes"])
                done.clear()
        close()
        if done:
            yield pd.DataFrame(done, columns=["conv_id", "file_bytes"])

    return write


def write_frame_files(items: DataFrame, out_dir: str, enclosed: bool = False, member_frames: int | None = None) -> int:
    """Writes one framed gzip file per ``conv_id`` from the rows ``conv_id``, ``turn``,
    ``kind``, ``text`` in turn order, and returns the number of files.

    ``kind``: ``frame`` (the text as a frame), ``marker``, or ``raw`` (the text's
    bytes as they are).  ``enclosed`` puts a marker before and after.  ``member_frames``
    begins a new gzip member after so many rows, so that :mod:`arenaflow.sources.framed_split` can
    decode one file by several tasks.

    Rows are hash-partitioned by conversation and sorted by (conversation, turn)
    within each task (an external, spilling sort); the writer then streams them
    into one open gzip file at a time, so a long conversation is never held in
    memory.  The only value returned to the driver is the file count.
    """
    ship_package(items.sparkSession)
    fs, path = hadoop_path(items.sparkSession, out_dir)
    out_dir = fs.makeQualified(path).toString()  # a path without a scheme means the default file system
    ordered = (
        items.select("conv_id", "turn", "kind", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn")
    )
    written = ordered.mapInPandas(_file_writer(out_dir, enclosed, member_frames), "conv_id long, file_bytes long")
    return written.agg(F.count(F.lit(1))).first()[0]


def write_conversation_files(conversations: DataFrame, out_dir: str) -> int:
    """One framed gzip file per conversation: marker, one frame per turn in turn order, marker."""
    return write_frame_files(conversations.withColumn("kind", F.lit("frame")), out_dir, enclosed=True)


def file_sections(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(conv_id, section_text, frame_count, status)`` of the files in ``out_dir``."""
    return read_sections(spark, out_dir).select(
        F.regexp_extract("path", r"conv_(-?\d+)\.gz$", 1).cast("bigint").alias("conv_id"),
        "section_text",
        "frame_count",
        "status",
    )


def conversation_sections(spark: SparkSession, conversations: DataFrame, out_dir: str) -> DataFrame:
    """Frames the conversations to files, then extracts each file's section."""
    write_conversation_files(conversations, out_dir)
    return file_sections(spark, out_dir)
