"""Operator 4, byte-level BPE encoding and decoding with a transducer lexicon.

The frequent words' pre-tokens are compiled into a minimal acyclic transducer
(``automaton.py``) whose outputs are their ids.  The file goes to the shared
folder, Spark hands it to every machine, and the Python workers memory-map it.
A pre-token that the lexicon lacks is merged exactly and kept in the worker's
bounded cache.  The lexicon changes only the speed, never the ids.

Defined cases: a NULL text counts as empty (no ids, empty decoded text); special
strings inside a text are their single id, as the library's default has it;
texts of any length are encoded whole; repeated rows each get their row; an empty table gives an empty result; extra
columns, whatever their names, are ignored.  Words with characters from ``PLAIN_LIMIT`` on are encoded by the
library (see ``bpe.py``).
"""

from __future__ import annotations

import hashlib
import struct
from pathlib import Path

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.automaton import Lexicon, compile_lexicon
from arenaflow.llm.bpe import NOT_PLAIN, WordBpe
from arenaflow.llm.common import WORKER_CACHE, frequent_words, map_rows, once, scratch_dir, write_bytes

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
     T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
)


def lexicon_entries(bpe: WordBpe, words: list[str]) -> dict[bytes, list[int]]:
    """Pre-tokens of the words, as they stand at the start of a line and after a space, with their ids."""
    out: dict[bytes, list[int]] = {}
    for word in words:
        if NOT_PLAIN.search(word):
            continue
        for form in (word, " " + word):
            for segment in bpe.segments(form)[::2]:
                for piece in bpe.pretokens(segment):
                    key = piece.encode()
                    if key not in out:
                        out[key] = bpe.word_ids(piece)
    return out


def share_file(spark: SparkSession, data: bytes, stem: str) -> str:
    """Puts a file of bounded size on every machine; returns its name for ``SparkFiles.get``."""
    name = f"{stem}-{hashlib.sha256(data).hexdigest()[:16]}.bin"
    known = Path(SparkFiles.getRootDirectory()) / name
    if not known.exists():
        path = f"{scratch_dir(spark, stem)}/{name}"
        write_bytes(spark, path, data)
        spark.sparkContext.addFile(path)
    return name


class Encoder(dict):
    """Pre-token -> ids as bytes: worker cache, then lexicon, then the merges."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon):
        super().__init__()
        self.bpe, self.lexicon = bpe, lexicon
        self.id_bytes = bpe.id_bytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.lexicon.ids(piece.encode())
        if ids is None:
            merged = self.bpe.word_ids(piece)
            ids = struct.pack(f"<{len(merged)}I", *merged)
        if len(self) >= WORKER_CACHE:
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        out = []
        for far, part in self.bpe.parts(text):
            if far:
                out.append(np.array(self.bpe.library_ids(part), "<u4").tobytes())
                continue
            for i, segment in enumerate(self.bpe.segments(part)):
                if i % 2:
                    out.append(struct.pack("<I", self.bpe.special[segment]))
                else:
                    out.extend(map(self.__getitem__, self.bpe.pretokens(segment)))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.id_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def bpe_encoder(docs: DataFrame, tokenizer: str, lexicon_words: int = 50_000):
    """A function for the workers that gives the :class:`Encoder`, with the lexicon of ``docs`` in place."""
    words = frequent_words(docs, lexicon_words)
    data = compile_lexicon(lexicon_entries(WordBpe(tokenizer), words))
    name = share_file(docs.sparkSession, data, "lexicon")

    def encoder() -> Encoder:
        return once((tokenizer, name), lambda: Encoder(WordBpe(tokenizer), Lexicon.mapped(SparkFiles.get(name))))

    return encoder


def bpe_encode(docs: DataFrame, tokenizer: str, lexicon_words: int = 50_000) -> DataFrame:
    """``doc_id``, ``ids`` (whole text) and ``decoded``, the text that the ids decode to."""
    encoder = bpe_encoder(docs, tokenizer, lexicon_words)

    def start():
        enc = encoder()

        def one(row):
            ids = enc.encode(row[1] or "")
            yield row[0], ids.tolist(), enc.decode(ids)

        return one

    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    )
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, schema)


def bpe_digests(docs: DataFrame, tokenizer: str, lexicon_words: int = 50_000) -> DataFrame:
    """``doc_id``, ``n_tokens``, digests of the ids and of the decoded text.

    The digests are taken where the text is encoded, so the ids never leave the worker.
    """
    encoder = bpe_encoder(docs, tokenizer, lexicon_words)

    def start():
        enc = encoder()

        def one(row):
            ids = enc.encode(row[1] or "")
            decoded = enc.decode(ids).encode()
            yield row[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA)
