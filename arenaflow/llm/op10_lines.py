"""Operator 10, line dedup by a log-template tree.

A line is parsed to a template: tokens with a digit become a variable field, and
the line falls into a leaf of a tree of fixed depth, by its number of tokens and
its first ``depth`` tokens.  Within a leaf, lines whose tokens agree at
``similarity`` of the places share a template; the places where they differ are its
variable fields.

Support is judged on runs of lines.  The context of a template reaches over all
templates that always follow it, and over all that always come before it, so the
lines of a passage share the surroundings of the whole passage.  A template is
recurring if its run stands in different surroundings: at least ``min_support``
different templates come before the run and at least as many after it (the
text's own hash stands in at its first and last line); two are enough in a run of
more than ``long_words`` words.  Texts that are nothing but the run count as one
surrounding, so copies of one document are left to near-dedup.  So is a
text with four fifths or more of its words in runs of only two surroundings: it
is a near copy.  Of a recurring template the document with the smallest id keeps
its lines; all others lose them.

Neighbours are counted exactly, as different pairs of template and neighbour,
which merge map-side.  Only leaves that stand in two different texts go on.  Leaves
are clustered in groups of about ``GROUP`` lines, as many as the leaf's counted size
asks for, and the groups' templates again in rounds of such groups, split by
other tokens each round, until a leaf is one group or no split merges more; so
no task gets a whole hot leaf of similar lines.

Defined cases: a NULL text stays NULL and has no lines; lines of fewer than
``min_tokens`` tokens are never dropped; a text that loses all its lines becomes
empty, its row stays; repeated rows lose the same lines; extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.common import map_rows, materialize
from arenaflow.session import ship_package

DIGIT = re.compile(rb"\d")
FIELD = b"<*>"
# Lines that are clustered together, about.
GROUP = 256
LINES = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("doc_hash", T.LongType()), T.StructField("line_no", T.IntegerType()),
     T.StructField("n_lines", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
     T.StructField("leaf", T.LongType()), T.StructField("line", T.LongType()), T.StructField("tokens", T.BinaryType()),
     T.StructField("before", T.LongType()), T.StructField("after", T.LongType())]
)
TEMPLATES = T.StructType([T.StructField("leaf", T.LongType()), T.StructField("line", T.LongType()), T.StructField("template", T.LongType()), T.StructField("tokens", T.BinaryType())])


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _bit(value: int) -> int:
    place = value & 63
    return (1 << place) - ((1 << 64) if place == 63 else 0)


def token_codes(tokens: list[bytes]) -> bytes:
    """16 bits of each token's hash; variable fields are 0."""
    return np.array([0 if t == FIELD else (xxhash.xxh3_64_intdigest(t) & 0xFFFF) or 1 for t in tokens], "<u2").tobytes()


def text_lines(text: str | None, depth: int, min_tokens: int) -> list[tuple[int, int, int, bytes]]:
    """(number, leaf, line, tokens) of the lines of a text."""
    rows = []
    for number, line in enumerate(text.encode().split(b"\n") if text else ()):
        tokens = line.split()
        if DIGIT.search(line):
            tokens = [FIELD if DIGIT.search(t) else t for t in tokens]
        if len(tokens) >= min_tokens:
            leaf = _hash(b"%d " % len(tokens) + b" ".join(tokens[:depth]))
            rows.append((number, leaf, _hash(b" ".join(tokens)), token_codes(tokens)))
    return rows


def placed_lines(doc_id, text: str | None, doc_hash: int, depth: int, min_tokens: int) -> list[tuple]:
    """The rows of :data:`LINES` of a text."""
    rows = text_lines(text, depth, min_tokens)
    keys = [doc_hash, *(r[2] for r in rows), doc_hash]
    words = sum(len(r[3]) // 2 for r in rows)
    return [(doc_id, doc_hash, row[0], len(rows), words, *row[1:], keys[i], keys[i + 2]) for i, row in enumerate(rows)]


def parsed_lines(doc_id, text: str | None, doc_hash: int, depth: int, min_tokens: int) -> list[tuple]:
    """A text's lines with the direct neighbours as bitmaps of 64 places (for comparisons in memory)."""
    rows = text_lines(text, depth, min_tokens)
    keys = [doc_hash, *(r[2] for r in rows), doc_hash]
    return [(doc_id, doc_hash, *row, _bit(keys[i]), _bit(keys[i + 2])) for i, row in enumerate(rows)]


def cluster(rows: list[tuple[int, np.ndarray]], similarity: float) -> list[tuple[int, int, np.ndarray]]:
    """(line, template, template's tokens) for the lines of one leaf, in the given order.

    A line joins the template it agrees with at the most places, variable fields
    not counted as agreement, if that is ``similarity`` of them or more; the
    places where they differ become variable fields.
    """
    width = len(rows[0][1])
    codes = np.zeros((4, width), np.uint16)
    names: list[int] = []
    member: list[int] = []
    for line, tokens in rows:
        n = len(names)
        agree = ((codes[:n] == tokens) & (tokens != 0)).sum(1) if n else np.zeros(0, int)
        fields = (tokens == 0).sum() if n else 0
        best = int(agree.argmax()) if n else -1
        if n and agree[best] + min(fields, int((codes[best] == 0).sum())) >= similarity * width:
            codes[best][codes[best] != tokens] = 0
        else:
            best = n
            if n == len(codes):
                codes = np.concatenate([codes, np.zeros_like(codes)])
            codes[n] = tokens
            names.append(line)
        member.append(best)
    return [(line, names[k], codes[k]) for (line, _), k in zip(rows, member, strict=True)]


def _clustered(lines: DataFrame, similarity: float) -> DataFrame:
    """:data:`TEMPLATES` of ``leaf``, ``part``, ``line``, ``tokens``, clustered within each leaf's part."""
    ship_package(lines.sparkSession)
    schema = to_arrow_schema(TEMPLATES)

    def made(group: list[tuple]) -> list[tuple]:
        leaf = group[0][0]
        if len(group) == 1:
            return [(leaf, group[0][2], group[0][2], group[0][3])]
        rows = [(line, np.frombuffer(tokens, "<u2")) for _, _, line, tokens in group]
        return [(leaf, line, name, codes.tobytes()) for line, name, codes in cluster(rows, similarity)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:2] != group[0][:2]:
                    out += made(group)
                    group = []
                group.append(row)
            if out:
                yield _rows(out, schema)
                out = []
        if group:
            yield _rows(made(group), schema)

    ordered = lines.select("leaf", "part", "line", "tokens").repartition("leaf", "part").sortWithinPartitions("leaf", "part", "line")
    return ordered.mapInArrow(run, TEMPLATES)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def line_templates(different: DataFrame, depth: int, similarity: float) -> DataFrame:
    """``line``, ``template`` of the lines (``leaf``, ``line``, ``tokens``) that share their leaf with other lines."""
    several = different.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    heads = materialize(different.join(several, "leaf").select("leaf", "line", "tokens"), "shared-lines")
    width = F.octet_length("tokens") / 2
    # lines that agree at ``similarity`` of the places agree wholly in one of so many pieces
    pieces = F.floor((1 - similarity) * width + 1e-9) + 1
    names, turn, calm = None, 0, 0
    while True:
        hot = materialize(
            heads.groupBy("leaf").agg(F.count("*").alias("n_leaf"), F.max(pieces).alias("pieces")).where(F.col("n_leaf") > GROUP), "hot-leaves"
        )
        size = hot.agg(F.sum("n_leaf").alias("n"), F.max("pieces").alias("pieces")).first()
        keyed = heads.join(hot, "leaf", "left")
        if size["n"] is None:
            grouped = heads.withColumn("part", F.lit(0).cast("long"))
        else:
            length = F.ceil((width - depth) / F.col("pieces"))
            start = 2 * (depth + F.pmod(F.lit(turn - 1), F.col("pieces")) * length) + 1
            piece = F.substring("tokens", start.cast("int"), (2 * length).cast("int")) if turn else F.lit(None)
            keyed = keyed.withColumn("piece", F.when(F.col("n_leaf").isNotNull(), F.xxhash64(piece)).otherwise(F.lit(0)))
            counted = keyed.where("n_leaf is not null").groupBy("leaf", "piece").agg(F.ceil(F.count("*") / F.lit(GROUP)).alias("slices"))
            salted = F.pmod(F.xxhash64("line", F.lit(turn)), F.coalesce("slices", F.lit(1)))
            grouped = keyed.join(counted, ["leaf", "piece"], "left").withColumn("part", F.xxhash64("piece", salted))
        local = materialize(_clustered(grouped, similarity), "local-templates")
        if names is None:
            names = local.select("line", "template")
        else:
            step = local.select(F.col("line").alias("head"), F.col("template").alias("merged"))
            # leaves that were done before are not in ``heads`` any more
            names = names.join(step, names["template"] == step["head"], "left").select("line", F.coalesce("merged", "template").alias("template"))
            names = materialize(names, "template-names")
        if size["n"] is None:
            return names
        heads = materialize(
            local.join(hot.select("leaf"), "leaf", "left_semi").groupBy("leaf", "template").agg(F.min("tokens").alias("tokens"))
            .select("leaf", F.col("template").alias("line"), "tokens"), "template-heads"
        )
        calm = calm + 1 if heads.count() == size["n"] else 0
        if calm > size["pieces"]:
            return names
        turn += 1


def chains(nodes: DataFrame, only: DataFrame) -> DataFrame:
    """``template``, ``end``, ``steps``, ``beyond`` (words after the template) of the templates with
    just one neighbour (``only``: ``template``, ``next``), by doubling of the way."""
    words = nodes.select(F.col("template").alias("next"), F.col("words").alias("beyond"))
    way = materialize(only.join(words, "next").select("template", F.col("next").alias("end"), F.lit(1).cast("long").alias("steps"), F.col("beyond").cast("long")), "ways")
    while True:
        further = way.select(
            F.col("template").alias("end"), F.col("end").alias("end_2"), F.col("steps").alias("steps_2"), F.col("beyond").alias("beyond_2")
        )
        longer = materialize(way.join(further, "end", "left"), "longer-ways")
        if longer.where("end_2 is not null and end_2 <> template").isEmpty():
            return way
        way = longer.select(
            "template", F.coalesce("end_2", "end").alias("end"), (F.col("steps") + F.coalesce("steps_2", F.lit(0))).alias("steps"),
            (F.col("beyond") + F.coalesce("beyond_2", F.lit(0))).alias("beyond"),
        )


def recurring_templates(found: DataFrame, names: DataFrame, min_support: int, long_words: int) -> DataFrame:
    """``template``, ``keeper``, ``few`` (less than ``min_support`` surroundings) of the recurring templates in ``found``."""
    nodes = materialize(
        found.groupBy("template").agg(F.min("doc_id").alias("keeper"), F.max("words").alias("words"), F.min("doc_hash").alias("low"), F.max("doc_hash").alias("high"))
        .where("low <> high").select("template", "keeper", "words"), "templates"
    )
    named = names.select(F.col("line").alias("key"), F.col("template").alias("named"))

    def neighbours(side: str) -> DataFrame:
        edge = F.col(side) == F.col("doc_hash")
        pairs = found.join(nodes.select("template"), "template", "left_semi").select(
            "template", F.col(side).alias("key"), edge.alias("edge"), F.when(edge, F.col("n_lines")).alias("n_lines")
        ).distinct()
        pairs = pairs.join(named, "key", "left").select("template", F.coalesce("named", "key").alias("key"), "edge", "n_lines")
        return materialize(pairs.distinct(), f"{side}-neighbours")

    def counted(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("template").agg(F.count("*").alias("n"), F.min("key").alias("next"), F.max("edge").alias("edge"))

    pairs = {"before": neighbours("before"), "after": neighbours("after")}
    runs = nodes
    for side, rows in pairs.items():
        count = materialize(counted(rows), f"{side}-counts")
        way = chains(nodes, count.where("n = 1 and not edge").select("template", "next"))
        way = way.select("template", F.col("end").alias(f"{side}_end"), F.col("steps").alias(f"{side}_steps"), F.col("beyond").alias(f"{side}_words"))
        runs = runs.join(way, "template", "left").withColumn(f"{side}_end", F.coalesce(f"{side}_end", "template"))
        runs = runs.join(count.select(F.col("template").alias(f"{side}_end"), F.col("n").alias(f"n_{side}")), f"{side}_end")
    zero = F.lit(0)
    runs = materialize(
        runs.withColumn("n_lines", (1 + F.coalesce("before_steps", zero) + F.coalesce("after_steps", zero)).cast("int"))
        .withColumn("run_words", F.col("words") + F.coalesce("before_words", zero) + F.coalesce("after_words", zero)), "runs"
    )
    run = ["before_end", "after_end", "n_lines"]
    # the texts that are nothing but the run: one row a text
    first = pairs["before"].where("edge").select(F.col("template").alias("before_end"), "key", "n_lines")
    last = pairs["after"].where("edge").select(F.col("template").alias("after_end"), "key")
    whole = first.join(last, "key").groupBy(*run).agg(F.count("*").alias("whole"))
    support = F.least("n_before", "n_after") - F.greatest(F.coalesce("whole", zero) - 1, zero)
    enough = F.when(F.col("run_words") > long_words, F.lit(min(2, min_support))).otherwise(F.lit(min_support))
    return runs.join(whole, run, "left").where(support >= enough).select("template", "keeper", (support < min_support).alias("few"))


def recurring_lines(
    docs: DataFrame, min_support: int, depth: int, similarity: float, min_tokens: int, long_words: int
) -> DataFrame:
    """``doc_id``, ``doc_hash`` (``xxhash64`` of the text), ``drops``: the numbers of the lines to drop."""

    def start():
        return lambda row: placed_lines(*row, depth, min_tokens)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("doc_hash")).where(F.col("text").isNotNull())
    lines = materialize(map_rows(texts, start, LINES), "parsed-lines")
    leaves = lines.groupBy("leaf").agg(F.min("doc_hash").alias("low"), F.max("doc_hash").alias("high")).where("low <> high").select("leaf")
    # never broadcast, as they grow with the lines
    shared = materialize(lines.join(materialize(leaves, "shared-leaves").hint("merge"), "leaf", "left_semi"), "lines-of-shared-leaves")
    different = materialize(shared.groupBy("leaf", "line").agg(F.min("tokens").alias("tokens")), "different-lines")
    names = line_templates(different, depth, similarity)
    found = shared.withColumn("words", (F.octet_length("tokens") / 2).cast("int")).drop("leaf", "tokens").join(names, "line", "left")
    found = materialize(found.withColumn("template", F.coalesce("template", "line")), "lines-with-templates")
    recurring = materialize(recurring_templates(found, names, min_support, long_words), "recurring-templates")
    dropped = found.select("doc_id", "doc_hash", "line_no", "n_words", "words", "template").join(recurring, "template").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    of_text = dropped.groupBy("doc_id", "doc_hash").agg(F.max("n_words").alias("n_words"), F.collect_set(F.struct("line_no", "words", "few")).alias("lines"))
    few_words = F.aggregate(F.filter("lines", lambda x: x["few"]), F.lit(0).cast("long"), lambda n, x: n + x["words"])
    near_copy = 5 * few_words >= 4 * F.col("n_words")
    drops = F.transform(F.filter("lines", lambda x: ~(near_copy & x["few"])), lambda x: x["line_no"])
    return of_text.select("doc_id", "doc_hash", drops.alias("drops")).where(F.size("drops") > 0)


def _shortened(docs: DataFrame, **how) -> DataFrame:
    """``row`` (all of ``docs``), ``text`` (shortened), ``n_lines``, ``n_dropped``."""
    drops = recurring_lines(docs, **how).select(F.col("doc_id").alias("drop_id"), F.col("doc_hash").alias("drop_hash"), "drops")
    # the row's own columns are folded into one, so their names can't clash
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("drop_id")) & (F.xxhash64("row.text") == F.col("drop_hash"))
    lines = F.split("row.text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("drops", i)), "\n")
    # one plan at every size: the drops grow with the texts, so they are never broadcast
    return rows.join(drops.hint("merge"), same, "left").select(
        "row",
        F.when(F.col("drops").isNull(), F.col("row.text")).otherwise(kept).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


HOW = {"min_support": 3, "depth": 4, "similarity": 0.8, "min_tokens": 3, "long_words": 50}


def line_dedup(docs: DataFrame, **how) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` (long; NULL text: 0), ``text`` as shortened.

    ``how``: other values for ``min_support``, ``depth``, ``similarity``, ``min_tokens`` or ``long_words``.
    """
    return _shortened(docs, **HOW | how).select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", "text")


def without_recurring_lines(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` with the shortened texts; ``n_chars``, if there, follows a text that lost lines."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
        new["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return _shortened(docs, **HOW | how).select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
