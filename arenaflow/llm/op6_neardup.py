"""Operator 6, near-duplicate detection by MinHash bands and odd sketches.

1. Every document gets the set of its five-word shingles (64-bit hashes), a
   128-bit hash of the whole set, MinHash samples cut into bands, and an odd
   sketch: one MinHash sample from each of 1,024 bins of the hash range, folded
   into a parity bitmap.
2. Documents with equal sets are one class, named by its smallest id; only
   classes go on.
3. Classes that share a band are candidates.  First each band's members are
   paired with the band's smallest member.  The population count of the XOR of
   two odd sketches estimates the similarity; pairs clearly below the threshold go, and the
   rest are confirmed on their full sets.
4. Confirmed links give components.  Then pairs that share a band but not a
   component, and were not compared yet, are compared in the same way, each in
   the first band they share; pairs within a component need no comparison, and
   no link between components is lost.

A pair at the threshold shares no band with probability (1 - 0.85**5)**25 = 4e-7.

Defined cases: a document with fewer than five words has its whole sequence as
its one shingle; a NULL or empty text has the empty set and is linked with nothing;
rows with one id are one document (linked if any of their texts is) and each
keep their row; a NULL id is linked with nothing: its component is NULL and it
is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.common import WordHashes, map_rows, materialize, once, shingle_hashes
from arenaflow.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 25, 5
SAMPLES = BANDS * ROWS
BINS = 1024
SKETCH_BITS = 1024
SKETCH = [f"odd{i}" for i in range(SKETCH_BITS // 64)]
# A pair goes unconfirmed if its sketches differ in so many standard deviations more bits than expected.
SIGMAS = 7.0
# Pairs of one document, or members of one band, that one task compares; more are dealt over several.
SPREAD = 500
_RNG = np.random.default_rng(20210601)
_FACTORS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2)
_CHUNK = 2048

SIGNATURES = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()),
     T.StructField("text_hash", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), *(T.StructField(c, T.LongType()) for c in SKETCH)]
)


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted hashes of a text's different shingles, A-Z in lower case."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    return np.unique(shingle_hashes(hashes.of(words), WORDS))


def minhash(shingles: np.ndarray) -> np.ndarray:
    best = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        values = shingles[i : i + _CHUNK, None] * _FACTORS
        values += _OFFSETS
        np.minimum(best, values.min(0), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band: its number and its samples."""
    rows = samples.reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = shingle_hashes(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, i], 1)
    return keys.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of MinHash samples that fall on each bit; ``shingles`` sorted."""
    _, first = np.unique(shingles % np.uint64(BINS), return_index=True)  # the smallest hash in each bin
    places = (shingle_hashes(shingles[first], 1) >> np.uint64(32)).astype(np.int64) % SKETCH_BITS
    parity = np.bincount(places, minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view("<i8")


def sketch_limit(n_a: Column, n_b: Column, similarity: float) -> Column:
    """Most bits in which the sketches of sets of these sizes may differ at this similarity.

    A set of ``n`` fills ``BINS * (1 - exp(-n / BINS))`` bins; of the union's
    filled bins the share ``similarity`` has the same sample on both sides, and
    every other sample flips a bit.  The limit is the expected number of
    differing bits plus ``SIGMAS`` standard deviations.
    """

    def filled(n):
        return BINS * (1 - F.exp(-n / F.lit(float(BINS))))

    union = (n_a + n_b) / F.lit(1 + similarity)
    flips = filled(n_a) + filled(n_b) - 2 * similarity * filled(union)
    hidden = 1 - filled(union) / union  # share of the union that is no bin's sample
    # a sparse bin flips one bit, a crowded one two: half the spread at low load, all of it at high load
    crowded = F.least(F.lit(1.0), 0.5 + 0.75 * hidden)
    spread = 4 * similarity * (1 - similarity) * filled(union) * hidden * crowded
    load = flips / F.lit(float(SKETCH_BITS))
    expected = SKETCH_BITS / 2 * (1 - F.exp(-2 * load))
    variance = spread * F.exp(-4 * load) + SKETCH_BITS / 4 * (1 - F.exp(-4 * load) * (1 + 4 * load)) + 1
    return expected + SIGMAS * F.sqrt(variance)


def signatures(docs: DataFrame) -> DataFrame:
    def start():
        hashes = once("word-hashes", WordHashes)
        empty = (b"", 0, [], [0] * len(SKETCH))

        def one(row):
            doc_id, text, text_hash = row
            found = shingle_set(text, hashes)
            if not len(found):
                yield doc_id, 0, b"", text_hash, [], *empty[3]
                return
            samples = minhash(found)
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            yield doc_id, len(found), digest, text_hash, band_keys(samples).tolist(), *odd_sketch(found).tolist()

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h")), start, SIGNATURES)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``node``, ``shingles`` (sorted) of ``node``, ``text``."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def start():
        hashes = once("word-hashes", WordHashes)
        return lambda row: ((row[0], shingle_set(row[1], hashes).view(np.int64).tolist()),)

    return map_rows(texts.select("node", "text"), start, schema)


def _far(names_a: list[str], names_b: list[str]) -> Column:
    bits = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(names_a, names_b, strict=True)]
    total = bits[0]
    for x in bits[1:]:
        total = total + x
    return total


def _plausible(percent: int) -> Column:
    """Sizes allow the similarity, and the sketches do not speak clearly against it (columns of both sides)."""
    sizes = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    near = _far([f"{c}_a" for c in SKETCH], [f"{c}_b" for c in SKETCH]) <= sketch_limit(F.col("n_a"), F.col("n_b"), percent / 100)
    return sizes & near


def _side(features: DataFrame, side: str) -> DataFrame:
    return features.select(
        F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in SKETCH)
    )


def _upto(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets have ``100 * intersection >= percent * union``.

    The set of an ``a`` with very many pairs (the center of a large band) is handed out in copies, one for
    each ``SPREAD`` of them, so that its pairs are compared by many tasks.
    """
    pairs = materialize(pairs, "pairs")
    hot = pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > SPREAD).select("a", F.ceil(F.col("n") / SPREAD).cast("int").alias("copies"))
    hot = materialize(hot, "hot-centers")  # at most one row for SPREAD pairs
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).alias("copy"))
    left = sets.join(hot, sets["node"] == hot["a"], "left").select(
        F.col("node").alias("a"), F.col("shingles").alias("set_a"), F.explode(_upto(F.coalesce("copies", F.lit(1)))).alias("copy")
    )
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return dealt.join(left, ["a", "copy"]).join(right, "b").where(F.lit(100) * both >= F.lit(percent) * union).select("a", "b").distinct()


def near_duplicate_links(docs: DataFrame, found: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``node``, ``component`` of the classes that are linked with another."""
    features = materialize(
        found.join(classes, "set_hash").where(F.col("doc_id") == F.col("node")).select("node", "n_shingles", "text_hash", "bands", *SKETCH), "classes"
    )
    banded = features.select(F.posexplode("bands").alias("place", "band"), "node")
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("center"), F.max("node").alias("last"))
    members = materialize(banded.join(buckets.where("center <> last").select("band", "center"), "band"), "members")
    wanted = members.select("node").distinct()
    texts = features.select("node", "text_hash").join(wanted, "node", "left_semi").join(
        docs.select(F.col("doc_id").cast("long").alias("_id"), "text"),
        (F.col("node") == F.col("_id")) & (F.col("text_hash") == F.xxhash64("text")),
    )
    sets = materialize(shingle_sets(texts).distinct(), "sets")

    def plausible(pairs: DataFrame) -> DataFrame:
        return pairs.join(_side(features, "a"), "a").join(_side(features, "b"), "b").where(_plausible(percent)).select("a", "b").distinct()

    first = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(confirmed(plausible(first), sets, percent), "links")
    components = connected_components(links)
    # members of a band that are not in one component yet, the center's pairs having been compared
    placed = members.join(components, "node", "left").select("place", "band", "center", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    rest = placed.where("node <> center").join(mixed, "band", "left_semi").join(features.drop("text_hash"), "node").drop("center")
    rest = materialize(rest, "mixed-bands")

    # a large band is compared in blocks: its members are dealt over them on one side, and stand in each on the other
    blocks = rest.groupBy("band").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("blocks"))
    rest = rest.join(blocks, "band")

    def side(x: str) -> DataFrame:
        names = {"component": f"c_{x}", "node": x, "n_shingles": f"n_{x}", "bands": f"bands_{x}", **{c: f"{c}_{x}" for c in SKETCH}}
        block = F.pmod(F.xxhash64("node"), "blocks") if x == "a" else F.explode(_upto(F.col("blocks")))
        return rest.select("place", "band", block.alias(f"block_{x}"), *(F.col(c).alias(n) for c, n in names.items()))

    shared_before = F.arrays_overlap(F.slice("bands_a", 1, F.col("place")), F.slice("bands_b", 1, F.col("place")))
    a, b = side("a"), side("b").drop("place")
    once_each = (F.col("c_a") < F.col("c_b")) & _plausible(percent) & ~shared_before
    second = a.join(b, (a["band"] == b["band"]) & (F.col("block_a") == F.col("block_b")) & once_each).select("a", "b").distinct()
    more = materialize(confirmed(second, sets, percent), "links")
    return components if more.isEmpty() else connected_components(links.union(more))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row."""
    found = materialize(signatures(docs), "signatures")
    some = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(some.groupBy("set_hash").agg(F.min("doc_id").alias("node")), "set-classes")
    linked = near_duplicate_links(docs, some, classes, percent)
    named = classes.join(linked, "node", "left").select("set_hash", F.coalesce("component", "node").alias("component_id"))
    # rows without a set or an id get no name here: their hash is made NULL
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_hash"))
    rows = found.select("doc_id", "n_shingles", key.alias("set_hash")).join(named, "set_hash", "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all columns as they are (rows that share an id are one document)."""
    kept = near_duplicates(docs, percent).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
