"""Joins and key lists that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.session import stored

HEAVY_ROWS = 4_000_000


@dataclass(frozen=True)
class HeavyKeys:
    """The keys that own too many rows for one task; ``keys`` is None when there are none."""

    keys: DataFrame | None


def find_heavy(df: DataFrame, key: str, rows: int = HEAVY_ROWS) -> HeavyKeys:
    """Keys with more than ``rows`` rows, looked up now so that plans without any stay simple.

    A table of N rows has at most N / ``rows`` of them, 250,000 at 10**12 rows
    with the default: small enough to broadcast whatever the data look like.
    The count is pre-aggregated before its shuffle, reads one column and runs
    once: its short list is written and then looked at.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = stored(counts.where(F.col("_rows") > rows).select(key), "heavy-keys")
    return HeavyKeys(None if heavy.isEmpty() else heavy)


def split_heavy(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys); NULL keys are ordinary."""
    marks = F.broadcast(heavy)
    return df.join(marks, key, "left_anti"), df.join(marks, key, "left_semi")


def join_unique(many: DataFrame, one: DataFrame, key: str, heavy: HeavyKeys) -> DataFrame:
    """Inner join of ``many`` with ``one``, whose ``key`` is unique.

    Rows of heavy keys never meet in one task: since ``one`` has a single row
    per key, its heavy part is as small as the list of heavy keys and is
    broadcast. All other rows take the ordinary shuffled join.
    """
    if heavy.keys is None:
        return many.join(one, key)
    usual, hot = split_heavy(many, key, heavy.keys)
    settled = stored(one, "unique-side")
    hot_side = settled.join(F.broadcast(heavy.keys), key, "left_semi")
    return usual.join(settled, key).unionByName(hot.join(F.broadcast(hot_side), key))
