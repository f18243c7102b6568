"""One framed file decoded by several tasks: equal to the sequential decoder, wherever members and frames are cut."""

import gzip
import io
import os
import random

import pytest

from arenaflow.session import scratch_dir
from arenaflow.sources import framed, framed_split
from arenaflow.sources.framed import BAD_GZIP, BAD_LENGTH, BAD_UTF8, OK, TRUNCATED_HEADER, TRUNCATED_PAYLOAD, decode_file, encode_frames
from arenaflow.sources.framed_split import read_member, walk_members

M = None


def members_of(data, cuts):
    """The bytes as gzip members, cut anywhere."""
    bounds = [0, *sorted(cuts), len(data)]
    return b"".join(gzip.compress(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False))


def split_decode(content):
    """What the tasks give, put together."""
    members, markers, status = walk_members(io.BytesIO(content))
    rows = []
    for m in members if status != BAD_GZIP else []:
        if m["frames"]:
            rows += list(read_member(io.BytesIO(content), m["start"], m["skip"], m["frames"], m["first_frame"], m["first_section"]))
    assert [r[1] for r in rows] == sorted({r[1] for r in rows})  # each frame once
    if status != BAD_GZIP and any(bad for *_, bad in rows):
        return None, 0, BAD_UTF8
    if status != OK:
        return None, 0, status
    texts = [text for section, _, text, _ in rows if section == markers - 1]
    return "".join(t + "\n" for t in texts), len(texts), OK


def random_frames(rng):
    return [rng.choice([M, "", "x", "héllo ✓ " * rng.randint(1, 5), "y" * rng.randint(0, 300)]) for _ in range(rng.randint(0, 25))]


@pytest.mark.parametrize("seed", range(60))
def test_split_equals_sequential(seed):
    rng = random.Random(seed)
    data = encode_frames(random_frames(rng))
    if seed % 4 == 1:
        data = data[: rng.randint(0, len(data))]
    if seed % 4 == 2:
        data += rng.choice([b"\x02", (-3).to_bytes(4, "little", signed=True) + b"zz", encode_frames([M]) + (2).to_bytes(4, "little") + b"\xff\xfe" + encode_frames(["t", M]) + b"\x01"])
    content = members_of(data, [rng.randint(0, len(data)) for _ in range(rng.randint(0, 8))])
    assert split_decode(content) == decode_file(content)


def test_each_error_of_a_file():
    good = encode_frames([M, "abc", M])
    cases = {
        OK: members_of(good, [3, 6, 7]),
        TRUNCATED_HEADER: members_of(good + b"\x01\x00", [9]),
        TRUNCATED_PAYLOAD: members_of(good + (10).to_bytes(4, "little") + b"abc", [9, 17]),
        BAD_LENGTH: members_of(good + (-4).to_bytes(4, "little", signed=True), [12]),
        BAD_UTF8: members_of(encode_frames([M]) + (2).to_bytes(4, "little") + b"\xff\xfe" + encode_frames([M]) + b"\x00", [5]),
        BAD_GZIP: members_of(good, [5])[:-9],
    }
    for status, content in cases.items():
        assert split_decode(content) == decode_file(content) and decode_file(content)[2] == status
    for content in (b"", b"not gzip", members_of(good, [4]) + b"\0" * 20, members_of(good, [4]) + b"junk", gzip.compress(b"")):
        assert split_decode(content) == decode_file(content)


def test_split_files_on_spark(spark):
    out = scratch_dir(spark, "framed-split-test")
    rng = random.Random(5)
    folder = out.removeprefix("file:")
    for k in range(12):
        data = encode_frames([M, *random_frames(rng), M, *(f"frame {i} ✓" for i in range(40)), M, "tail"])
        with open(os.path.join(folder, f"f{k}.gz"), "wb") as fh:
            fh.write(members_of(data[:-2] if k % 5 == 4 else data, [rng.randint(0, len(data) - 6) for _ in range(6)]))
    with open(os.path.join(folder, "empty.gz"), "wb"):
        pass
    with open(os.path.join(folder, "bad.gz"), "wb") as fh:
        fh.write(b"not gzip")
    index = framed_split.index_members(spark, out)
    assert index.where("path like '%f0.gz'").count() == 7
    want = {r["path"]: tuple(r)[1:] for r in framed.read_sections(spark, out).collect()}
    found = {r["path"]: tuple(r)[1:] for r in framed_split.split_sections(index).collect()}
    assert found == want and {s for *_, s in want.values()} >= {OK, TRUNCATED_PAYLOAD, BAD_GZIP}


def test_one_file_is_read_by_many_tasks(spark):
    out = scratch_dir(spark, "framed-split-one")
    items = spark.range(200).selectExpr("1L as conv_id", "id as turn", "'frame' as kind", "concat('text ', id) as text")
    assert framed.write_frame_files(items, out, enclosed=True, member_frames=10) == 1
    index = framed_split.index_members(spark, out)
    assert index.count() == 20
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frames = framed_split.read_frames(index)
        assert frames.rdd.getNumPartitions() > 1
        tasks = frames.selectExpr("spark_partition_id() as p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 3 and frames.count() == 200
