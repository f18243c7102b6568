import gzip

import pytest

from arenaflow.session import scratch_dir
from arenaflow.sources import framed
from arenaflow.sources.framed import (
    BAD_GZIP, BAD_LENGTH, BAD_UTF8, OK, TRUNCATED_HEADER, TRUNCATED_PAYLOAD, decode_file, decode_frames, encode_frames,
)

M = None  # section marker in encode_frames


@pytest.mark.parametrize(
    "payloads, expected",
    [
        (["a", "b"], ("", 0, OK)),  # no marker
        ([M, "a", "b"], ("", 0, OK)),  # one marker: nothing closed yet
        (["skip", M, "a", "", "b", M], ("a\nb\n", 2, OK)),  # zero-length frame adds nothing
        ([M, "one", M, "two", "three", M, "four"], ("two\nthree\n", 2, OK)),  # last closed section
        ([M, "x", M, M], ("", 0, OK)),  # empty last section
        ([M, "héllo wörld ✓", M], ("héllo wörld ✓\n", 1, OK)),  # multi-byte text
        ([], ("", 0, OK)),  # empty file
    ],
)
def test_decode_sections(payloads, expected):
    assert decode_frames(encode_frames(payloads)) == expected


def test_decode_errors():
    good = encode_frames([M, "abc", M])
    assert decode_frames(good + b"\x01\x00")[2] == TRUNCATED_HEADER
    assert decode_frames(good + (10).to_bytes(4, "little") + b"abc")[2] == TRUNCATED_PAYLOAD
    assert decode_frames(good + (-4).to_bytes(4, "little", signed=True))[2] == BAD_LENGTH
    assert decode_frames(encode_frames([M]) + (2).to_bytes(4, "little") + b"\xff\xfe" + encode_frames([M]))[2] == BAD_UTF8
    assert decode_file(b"not gzip")[2] == BAD_GZIP
    assert decode_file(gzip.compress(good)) == ("abc\n", 1, OK)


def test_conversation_files_round_trip(spark):
    conv = spark.createDataFrame(
        [(1, 2, "user", "second"), (1, 1, "user", "first"), (1, 3, "bot", ""), (2, 1, "bot", "only ✓")],
        "conv_id long, turn long, role string, text string",
    )
    out = framed.conversation_sections(spark, conv, scratch_dir(spark, "framed-test"))
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "first\nsecond\n", 2, OK), (2, "only ✓\n", 1, OK)]


@pytest.mark.parametrize("stream", [True, False])
def test_bad_file_gives_error_row(spark, tmp_path, stream):
    (tmp_path / "bad.gz").write_bytes(gzip.compress(encode_frames([M, "a"]) + b"\x05\x00\x00\x00ab"))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(encode_frames([M, "a", M]))[:-6])
    (tmp_path / "ok.gz").write_bytes(gzip.compress(encode_frames([M, "a", "é", M, "tail"])))
    out = framed.read_sections(spark, str(tmp_path), stream=stream).collect()
    got = {r["path"].rsplit("/", 1)[1]: (r["section_text"], r["status"]) for r in out}
    assert got == {"bad.gz": (None, TRUNCATED_PAYLOAD), "cut.gz": (None, BAD_GZIP), "ok.gz": ("a\né\n", OK)}


def test_long_conversation_streams_through_one_file(spark):
    from pyspark.sql import functions as F

    turns = spark.range(0, 5000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    out = framed.conversation_sections(spark, turns, scratch_dir(spark, "framed-long")).collect()
    assert len(out) == 1 and out[0]["frame_count"] == 5000 and out[0]["status"] == OK
    assert out[0]["section_text"] == "".join(f"t{i}\n" for i in range(5000))
