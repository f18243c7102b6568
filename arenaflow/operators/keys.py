"""Reduction of a large log to candidate keys by a broadcast bitmap of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the bitmap: 2^24 are 262,144 words of 64 bits, some MB to broadcast, whatever the number of keys.
KEY_BITS = 24


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """Word and bit of a key, from its 64-bit hash."""
    place = F.xxhash64(key).bitwiseAND((1 << bits) - 1)
    return F.shiftright(place, 6), place.bitwiseAND(63).cast("int")


def key_bitmap(keys: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """``(_word, _mask)``: one bit set for every key, a Bloom filter with one hash.

    At most ``2^(bits - 6)`` rows, whatever the number of keys, so it may be broadcast.  The
    aggregation combines map-side; a key that repeats costs nothing.
    """
    word, bit = _place(F.col(key), bits)
    return keys.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bit")).groupBy("_word").agg(
        F.bit_or("_bit").alias("_mask")
    )


def maybe_among(rows: DataFrame, bitmap: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """The rows whose key's bit is set: all rows of the bitmap's keys, and a share of the others that is
    the share of set bits (n keys set at most n / 2^bits of them).

    A map-side semi join: no row of the log is shuffled for it.  With far more keys than bits it
    lets everything pass, and the result is still right if an exact join follows.
    """
    word, bit = _place(rows[key], bits)
    hit = (word == bitmap["_word"]) & (F.call_function("getbit", bitmap["_mask"], bit) == 1)
    return rows.join(F.broadcast(bitmap), hit, "left_semi")
