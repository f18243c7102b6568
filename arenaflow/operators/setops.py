"""Bag and set union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``UNION``: bag union then duplicate removal (NULLs compare equal).

    The distinct is an aggregate with a map-side partial step, so a value that
    repeats many times is collapsed before the shuffle.
    """
    return union_all(*frames).distinct()
