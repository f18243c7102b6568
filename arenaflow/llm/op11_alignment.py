"""Operator 11, cross-tokenizer alignment by interval coalescing.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, applied to
space + text; B is a sentencepiece model, applied to the text (it adds the space
itself).  Where the bytes of both token sequences are those of space + text, every
token is an interval of bytes.  All A and B tokens of many documents are sorted
by start with one ``lexsort`` and the running maximum of their ends is taken; a
group breaks where a start reaches it, and the overlapping A-B pairs of a group are
expanded as its links.

Corpus-wide counts of linked id pairs: a worker numbers the distinct pairs of a
*chunk* (documents with about ``chunk_links`` links), so that a link is a small number. Only
the distinct pairs of the chunks, with their sums, are shuffled; the counts
come back to the chunk that asked.  Nothing is broadcast but one row for
each id of B's vocabulary.

Words are encoded once and kept in the worker's bounded cache (both tokenizers
merge within words); the ids are the library's for the whole text.

Defined cases: NULL or empty texts, and texts whose tokens do not spell them, have no
tokens: zeros and an empty digest.  Special strings inside a text are plain text.
Ties: every link whose count equals its B id's highest is a best one.  Repeated
rows each get their row and each count; an empty table gives an empty result; extra columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from string import ascii_letters, punctuation

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.bpe import WordBpe
from arenaflow.llm.common import materialize, once
from arenaflow.session import ship_package

SPACE = "▁"  # sentencepiece's sign for a space
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
CACHE = 300_000  # pieces that a worker keeps for each side
LEFT = 32  # an id pair is (A id << LEFT) + B id

CHUNKS = T.StructType(
    [T.StructField("chunk", T.StringType())]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [T.StructField("groups_sha256", T.ArrayType(T.StringType())), T.StructField("links", T.BinaryType())]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("pairs", "times")]
)
RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [T.StructField("groups_sha256", T.StringType())]
)


class Words(dict):
    """Piece of text -> its ids as bytes; bounded.  ``odd`` are the pieces whose tokens do not spell them.

    ``ids_of`` gives the ids of several pieces; the pieces that a text has and the cache has not are encoded together.
    """

    def __init__(self, ids_of, spelled):
        super().__init__()
        self.ids_of, self.spelled, self.odd = ids_of, spelled, set()

    def of(self, pieces: list[str]) -> tuple[np.ndarray, bool]:
        """Ids of the pieces in order, and whether each is known to spell its piece."""
        found = list(map(self.get, pieces))
        if None in found:
            at = [i for i, ids in enumerate(found) if ids is None]
            if len(self) >= CACHE:
                self.clear()
                self.odd.clear()
                at = range(len(pieces))
            missing = list(dict.fromkeys([pieces[i] for i in at]))
            for piece, ids in zip(missing, self.ids_of(missing), strict=True):
                if b"".join(map(self.spelled.__getitem__, ids)) != piece.encode():
                    self.odd.add(piece)
                self[piece] = array("I", ids).tobytes()
            for i in at:
                found[i] = self[pieces[i]]
        ids = np.frombuffer(b"".join(found), "<u4")
        return ids, not self.odd or self.odd.isdisjoint(pieces)


class SideA:
    """Byte-level BPE of space + text, special strings as plain text."""

    def __init__(self, path: str):
        self.bpe = WordBpe(path)
        self.bpe.library.encode_special_tokens = True
        self.spelled = self.bpe.id_bytes()
        self.words = Words(lambda pieces: map(self.bpe.word_ids, pieces), self.spelled)
        self.rest = Words(lambda parts: map(self.bpe.library_ids, parts), self.spelled)

    def ids(self, text: str) -> tuple[np.ndarray, bool]:
        found = [
            (self.rest.of([part]) if far else self.words.of(self.bpe.pretokens(part))) for far, part in self.bpe.parts(" " + text)
        ]
        if len(found) == 1:
            return found[0]
        return np.concatenate([ids for ids, _ in found]), all(ok for _, ok in found)


class SideB:
    """Sentencepiece ids of a text, cut where no piece of the vocabulary can reach across: before
    a run of spaces, around line ends if these are always single bytes, and, for a piece not seen yet,
    between a letter and a sign that no entry of the vocabulary joins."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [p for i, p in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.spelled = [
            bytes([int(m[1], 16)]) if model.is_byte(i) and (m := BYTE_PIECE.fullmatch(p)) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        # fixed value: the probe that shows whether spaces are kept as they are
        self.cuts = model.decode(model.encode("  a  b ")) == "  a  b " and not any(SPACE in p.lstrip(SPACE) for p in names)
        lines = self.cuts and not any("\n" in p for p in names) and [names[i] for i in model.encode("\n")] == [SPACE, "<0x0A>"]
        self.pieces = re.compile(r" +[^ \n]*|\n[^ \n]*" if lines else r" +[^ ]*")
        joined = {b for p in plain for a, b in zip(p, p[1:], strict=False) if a in ascii_letters}
        signs = "".join(c for c in punctuation if lines and c not in joined)
        self.ends = re.compile(f"([ \n][^ \n]*[A-Za-z])([{re.escape(signs)}]+)") if signs else None
        self.words = Words(self._ids, self.spelled)
        self.stems: dict[str, list[int]] = {}

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        cut = [(m.groups() if self.ends and (m := self.ends.fullmatch(p)) else (p, "")) for p in pieces]
        new = list({part for pair in cut for part in pair if part}.difference(self.stems))
        if len(self.stems) + len(new) > CACHE // 3:
            self.stems.clear()
            new = list({part for pair in cut for part in pair if part})
        # the model puts a space in front of anything but nothing: give it the one that is there, or take
        # it away again; a sign goes behind a line end, which is taken away too
        kind = [" \n".find(p[0]) for p in new]
        asked = [p[1:] if k == 0 else p if k == 1 else "\n" + p for k, p in zip(kind, new, strict=True)]
        for p, k, ids in zip(new, kind, self.model.encode(asked, num_threads=1), strict=True):
            self.stems[p] = ids if k == 0 else ids[1:] if k == 1 else ids[2:]
        if " " in self.stems:
            self.stems[" "] = [self.model.piece_to_id(SPACE)]
        return [self.stems[a] + self.stems[b] if b else self.stems[a] for a, b in cut]

    def ids(self, text: str) -> tuple[np.ndarray, bool]:
        if self.cuts and SPACE not in text:  # the sign itself would count as a space
            return self.words.of(self.pieces.findall(" " + text))
        return np.array(self.model.encode(text), "<u4"), False


class Aligner:
    """Aligns the tokens of a batch of texts."""

    def __init__(self, tokenizer_a: str, tokenizer_b: str):
        self.a, self.b = SideA(tokenizer_a), SideB(tokenizer_b)
        self.length = [np.array([len(s) for s in side.spelled], np.int64) for side in (self.a, self.b)]
        # an id's text with the sign that follows it: within its side, or at the side's end
        self.names = [f"{i}{end}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for end in ends for i in range(len(side.spelled))]
        self.first = np.cumsum([0, len(self.a.spelled), len(self.a.spelled), len(self.b.spelled)])

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, None where they do not spell space + text."""
        if not text:
            return None
        (ids_a, known_a), (ids_b, known_b) = self.a.ids(text), self.b.ids(text)
        whole = None
        for side, ids, known in ((self.a, ids_a, known_a), (self.b, ids_b, known_b)):
            if not known:
                whole = whole or (" " + text).encode()
                if b"".join(map(side.spelled.__getitem__, ids.tolist())) != whole:
                    return None
        return ids_a, ids_b

    def align(self, docs: list[tuple[np.ndarray, np.ndarray]]):
        """Per document: numbers of groups and links, digest; and all links' id pairs, in document order."""
        none = np.zeros(0, np.int64)
        if not docs:
            return none, none, [], none
        ids = [np.concatenate(side).astype(np.int64) for side in zip(*docs, strict=True)]
        ends = [np.cumsum(length[i]) for length, i in zip(self.length, ids, strict=True)]
        starts = [e - length[i] for e, length, i in zip(ends, self.length, ids, strict=True)]
        n_a, n_b = len(ids[0]), len(ids[1])
        # groups: by start, a token opens one where it reaches the running maximum of the ends
        start, end = np.concatenate(starts), np.concatenate(ends)
        order = np.lexsort((np.repeat([0, 1], [n_a, n_b]), start))
        reach = np.maximum.accumulate(end[order])
        opens = np.append(True, start[order][1:] >= reach[:-1])
        group = np.empty(n_a + n_b, np.int64)
        group[order] = np.cumsum(opens) - 1
        group_a, group_b = group[:n_a], group[n_a:]
        # links: the B tokens that reach into each A token, expanded
        low = np.searchsorted(ends[1], starts[0], "right")
        size = np.searchsorted(starts[1], ends[0], "left") - low
        first = np.cumsum(size) - size
        at = np.repeat(low - first, size) + np.arange(size.sum())
        pairs = (np.repeat(ids[0], size) << LEFT) + ids[1][at]
        bounds = np.cumsum([0] + [len(a) for a, _ in docs])
        n_links = np.diff(np.append(first, len(at))[bounds])
        edges = np.append(group_a, group_a[-1] + 1)[bounds]
        # digest: A tokens, then B tokens, group by group
        count_a, count_b = np.bincount(group_a), np.bincount(group_b)
        begin = np.cumsum(count_a + count_b) - count_a - count_b
        last_a = np.append(group_a[1:] != group_a[:-1], True).astype(np.int64)
        last_b = np.append(group_b[1:] != group_b[:-1], True).astype(np.int64)
        code = np.empty(n_a + n_b, np.int64)
        code[begin[group_a] + np.arange(n_a) - (np.cumsum(count_a) - count_a)[group_a]] = self.first[last_a] + ids[0]
        code[(begin + count_a)[group_b] + np.arange(n_b) - (np.cumsum(count_b) - count_b)[group_b]] = self.first[2 + last_b] + ids[1]
        cuts = np.append(begin, len(code))[edges].tolist()
        name = self.names.__getitem__
        digests = [
            hashlib.sha256("".join(map(name, code[i:j].tolist()))[:-1].encode()).hexdigest() for i, j in zip(cuts, cuts[1:], strict=False)
        ]
        return np.diff(edges), n_links, digests, pairs


def _place(pairs: int) -> str:
    """Type of a place among so many pairs."""
    return "<u2" if pairs <= 1 << 16 else "<u4"


class Chunk:
    """Documents gathered until they hold enough links; one output row."""

    def __init__(self):
        self.rows, self.waiting, self.pairs, self.links = [], [], [], 0

    def row(self) -> tuple:
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        keys, at, times = np.unique(pairs, return_inverse=True, return_counts=True)
        columns = [list(c) for c in zip(*self.rows, strict=True)]
        return (uuid.uuid4().hex, *columns, at.astype(_place(len(keys))).tobytes(), keys, times)


def _chunk_batch(row: tuple, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)


def aligned_chunks(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, chunk_links: int = 500_000, batch_tokens: int = 200_000) -> DataFrame:
    """One row a chunk: its documents' figures, its distinct id pairs with their
    numbers of links, and the links as places in these pairs (see :func:`_place`)."""
    ship_package(docs.sparkSession)
    schema = to_arrow_schema(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = once(("aligner", tokenizer_a, tokenizer_b), lambda: Aligner(tokenizer_a, tokenizer_b))
        chunk, size = Chunk(), 0

        def flush():
            groups, links, digests, pairs = aligner.align([t for _, t in chunk.waiting if t is not None])
            found = iter(zip(groups.tolist(), links.tolist(), digests, strict=True))
            for doc, t in chunk.waiting:
                g, n, digest = next(found) if t is not None else (0, 0, "")
                n_a, n_b = map(len, t or ((), ()))
                chunk.rows.append((doc, n_a, n_b, g, n, digest))
            chunk.pairs.append(pairs)
            chunk.links += len(pairs)
            chunk.waiting = []

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = aligner.tokens(text)
                chunk.waiting.append((doc, found))
                size += len(found[0]) if found else 1
                if size >= batch_tokens:
                    flush()
                    size = 0
                    if chunk.links >= chunk_links or len(chunk.rows) >= chunk_links:
                        yield _chunk_batch(chunk.row(), schema)
                        chunk = Chunk()
        flush()
        if chunk.rows:
            yield _chunk_batch(chunk.row(), schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair``, ``b``, ``count``: the links that hold each id pair, corpus-wide."""
    found = chunks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counted = found.groupBy("pair").agg(F.sum("n").alias("count"))
    return counted.select("pair", F.col("pair").bitwiseAND((1 << LEFT) - 1).alias("b"), "count")


def token_alignment(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, chunk_links: int = 500_000) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``tokenizer_a`` is a byte-level ``tokenizers`` JSON file, ``tokenizer_b`` a sentencepiece model, by
    their paths on every machine.
    """
    chunks = materialize(aligned_chunks(docs, tokenizer_a, tokenizer_b, chunk_links), "alignment-chunks")
    counts = materialize(pair_counts(chunks), "alignment-pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # at most one row an id of B
    known = counts.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(known, "pair").select("chunk", "place", "count", "best")
    order = to_arrow_schema(RESULT)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy()
        one = {name: left.column(name)[0] for name in left.column_names}
        at = np.frombuffer(one["links"].as_py(), _place(len(place)))
        n_links = one["n_links"].values.to_numpy()
        bounds = np.append(0, np.cumsum(n_links))
        sums = [np.append(0, np.cumsum(x[at]))[bounds] if len(at) else np.zeros(len(bounds), np.int64) for x in (best, count)]
        values = {"n_best": pa.array(np.diff(sums[0])), "count_sum": pa.array(np.diff(sums[1]))}
        return pa.table([values[f.name] if f.name in values else one[f.name].values for f in order], schema=order)

    own = chunks.drop("pairs", "times").withColumnRenamed("chunk", "own")
    return own.groupBy("own").cogroup(answers.groupBy("chunk")).applyInArrow(finish, RESULT)
