"""Packing documents into sequences of bounded length by linear grouping.

Lengths are whole numbers up to the capacity, so everything that decides where
a document goes depends on one histogram of at most ``capacity`` rows:

1. large lengths are sorted and cut into groups of equal cardinality, each
   rounded up to its largest length;
2. configurations of rounded lengths are chosen one after the other, each the
   fullest that holds the largest length left, and used as often as it fits;
3. actual documents take the places of their group, in order of length, which
   leaves the bins more room than the rounded lengths promised;
4. small lengths go into the fullest bin that still has room for them.

The plan is a list of intervals over the ranks of all pieces sorted by length.
Spark gives each piece its rank by a count per length and bucket, and looks up
its interval. No bin, group or list of documents meets in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringlens.llm.subwords import token_bytes
from ringlens.session import stored

CAPACITY = 1024
GROUPS = 512
SMALL_SHARE = 16
END_ID = 2
BUCKETS = 64
ROWS_PER_BUCKET = 1 << 18
PIECE_TYPE = "array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>"


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[dict]:
    """Pieces of one document: unsigned little-endian 32-bit ids, cut so that only the first is shorter."""
    total = len(ids) // 4
    first = total % capacity or min(total, capacity)
    stops = range(first, total + 1, capacity)
    out, start = [], 0
    for piece, stop in enumerate(stops):
        part = ids[4 * start : 4 * stop]
        out.append({"piece": piece, "start": start, "length": stop - start, "ids_crc32": zlib.crc32(part)})
        start = stop
    return out


def document_pieces(docs: DataFrame, tokenizer_path: str, id_column: str, text_column: str, capacity: int) -> DataFrame:
    end = np.array([END_ID], "<u4").tobytes()

    @F.arrow_udf(PIECE_TYPE)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = token_bytes(tokenizer_path)
        kind = pa.list_(
            pa.struct({"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()})
        )
        for texts in batches:
            yield pa.array([pieces_of(encode(text or "") + end, capacity) for text in texts.to_pylist()], kind)

    return docs.select(
        F.col(f"`{id_column}`").alias("id"), F.explode(cut(F.col(f"`{text_column}`"))).alias("p")
    ).select("id", "p.*")


@dataclass(frozen=True)
class Run:
    """``times`` bins from ``bin`` on, which are filled alike up to ``filled``."""

    bin: int
    times: int
    filled: int


@dataclass(frozen=True)
class Interval:
    """Ranks from ``rank`` on go to consecutive bins, ``each`` neighbours to one bin, at ``offset``."""

    rank: int
    bin: int
    each: int
    offset: int
    length: int


def equal_groups(lengths: list[int], counts: list[int], groups: int) -> list[tuple[int, int]]:
    """(rounded length, number) of groups of equal cardinality over lengths in descending order."""
    total = sum(counts)
    size = max(1, -(-total // groups))
    out: list[tuple[int, int]] = []
    room = 0
    for length, count in zip(lengths, counts, strict=True):
        while count:
            if not room:
                out.append((length, 0))
                room = size
            taken = min(room, count)
            out[-1] = (out[-1][0], out[-1][1] + taken)
            room -= taken
            count -= taken
    merged: dict[int, int] = defaultdict(int)
    for length, count in out:
        merged[length] += count
    return list(merged.items())


def fullest(room: int, left: dict[int, int], items: int) -> list[int]:
    """Lengths with the largest sum within ``room``; among equal sums the fewest, then the larger ones."""
    mask = (1 << (room + 1)) - 1
    sizes = sorted((s for s, n in left.items() if n and s <= room), reverse=True)
    levels = [1]
    for _ in range(items):
        sums = 0
        for size in sizes:
            sums |= levels[-1] << size
        levels.append(sums & mask)

    def chosen(target: int, level: int, at: int, spare: dict[int, int]) -> list[int] | None:
        if level == 0:
            return [] if target == 0 else None
        for i in range(at, len(sizes)):
            size = sizes[i]
            if size * level < target:
                return None
            if size <= target and spare[size] and levels[level - 1] >> (target - size) & 1:
                spare[size] -= 1
                rest = chosen(target - size, level - 1, i, spare)
                if rest is not None:
                    return [size, *rest]
                spare[size] += 1
        return None

    reachable = 0
    for sums in levels:
        reachable |= sums
    while reachable:
        target = reachable.bit_length() - 1
        for level, sums in enumerate(levels):
            if sums >> target & 1 and (found := chosen(target, level, 0, dict(left))) is not None:
                return found
        reachable ^= 1 << target
    return []


def configurations(groups: list[tuple[int, int]], capacity: int, items: int = SMALL_SHARE) -> list[tuple[list[int], int]]:
    """(rounded lengths of one bin, number of such bins), until every group is used up."""
    left = dict(groups)
    out: list[tuple[list[int], int]] = []
    for size in sorted(left, reverse=True):
        while left[size]:
            left[size] -= 1
            pattern = [size, *fullest(capacity - size, left, items)]
            left[size] += 1
            used = {s: pattern.count(s) for s in set(pattern)}
            times = min(left[s] // n for s, n in used.items())
            for s, n in used.items():
                left[s] -= n * times
            out.append((pattern, times))
    return out


def plan(lengths: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Interval]:
    """Intervals that give each rank, over pieces sorted by descending length, its bin and offset.

    The work depends on the number of different lengths, never on the number
    of pieces.
    """
    small_limit = capacity // SMALL_SHARE
    ordered = sorted(lengths, reverse=True)
    large = [n for n in ordered if n > small_limit]
    small = [n for n in ordered if n <= small_limit]
    grouped = equal_groups(large, [lengths[n] for n in large], groups)

    # Rank where each length, and each rounded length, begins.
    starts, rank = {}, 0
    for n in ordered:
        starts[n] = rank
        rank += lengths[n]
    next_rank, rank = {}, 0
    for size, count in grouped:
        next_rank[size] = rank
        rank += count
    edges = [starts[n] for n in large]

    intervals: list[Interval] = []
    runs: list[Run] = []
    bins = 0
    for pattern, times in configurations(grouped, capacity):
        slots = []
        for size in pattern:
            slots.append(next_rank[size])
            next_rank[size] += times
        # Where the actual length of any slot changes, another run of equal bins begins.
        cuts = {0, times}
        for slot in slots:
            at = bisect_left(edges, slot)
            while at < len(edges) and edges[at] < slot + times:
                cuts.add(edges[at] - slot)
                at += 1
        marks = sorted(cuts)
        for begin, stop in zip(marks, marks[1:], strict=False):
            filled = 0
            for slot in slots:
                length = large[bisect_left(edges, slot + begin + 1) - 1]
                intervals.append(Interval(slot + begin, bins + begin, 1, filled, length))
                filled += length
            runs.append(Run(bins + begin, stop - begin, filled))
        bins += times

    by_room: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        by_room[capacity - run.filled].append(run)
    for length in small:
        rank, count = starts[length], lengths[length]
        while count:
            room = next((r for r in range(length, capacity + 1) if by_room.get(r)), None)
            if room is None:
                times = -(-count // (capacity // length))
                by_room[capacity].append(Run(bins, times, 0))
                bins += times
                continue
            run = by_room[room].pop()
            each = room // length
            full = min(run.times, count // each)
            if full:
                intervals.append(Interval(rank, run.bin, each, run.filled, length))
                filled = run.filled + each * length
                by_room[capacity - filled].append(Run(run.bin, full, filled))
                rank, count = rank + full * each, count - full * each
            if full < run.times:
                rest = Run(run.bin + full, run.times - full, run.filled)
                if count and count < each:
                    intervals.append(Interval(rank, rest.bin, each, rest.filled, length))
                    filled = rest.filled + count * length
                    by_room[capacity - filled].append(Run(rest.bin, 1, filled))
                    rest = Run(rest.bin + 1, rest.times - 1, rest.filled)
                    count = 0
                if rest.times:
                    by_room[capacity - rest.filled].append(rest)
    return sorted(intervals, key=lambda i: i.rank)


def assign(ranked: DataFrame, intervals: list[Interval]) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` by the rank; the plan has a bound that does not grow with the rows."""
    table = np.array([[i.rank, i.bin, i.each, i.offset, i.length] for i in intervals] or [[0, 0, 1, 0, 0]], np.int64)
    shared = ranked.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def placed(ranks: pa.Array) -> pa.Array:
        begin, first, each, offset, length = shared.value.T
        rank = ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(begin, rank, side="right") - 1
        past = rank - begin[at]
        return pa.StructArray.from_arrays(
            [first[at] + past // each[at], offset[at] + past % each[at] * length[at]], ["sequence_id", "offset"]
        )

    return ranked.withColumn("to", placed("rank")).select("*", "to.*").drop("to", "rank")


def rank_by_length(pieces: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """``rank`` of each piece by descending length; equal lengths are dealt to ``buckets`` windows."""
    before = Window.orderBy(F.desc("length"))
    totals = counts.groupBy("length").agg(F.sum("n").alias("total"))
    # At most ``capacity`` rows: one window over them is bounded.
    totals = totals.withColumn("above", F.coalesce(F.sum("total").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(totals.select("length", "above"), "length")
        .select("length", "bucket", (F.col("above") + F.col("inside")).alias("first"))
    )
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    return (
        pieces.withColumn("local", F.row_number().over(within))
        .join(firsts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("local") - 1)
        .drop("local", "first", "bucket")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: its place in its document and in a sequence of at most ``capacity`` tokens.

    * A document is its token ids and the end id; a null or empty text is the
      end id alone. Longer documents are cut into full pieces, of which the
      first may be shorter, so a text of any length is packed whole.
    * Repeated rows and null ids are packed like others; other columns are not
      read. An empty table gives an empty result.
    * Sequences are gapless from offset 0.
    """
    pieces = document_pieces(docs, tokenizer_path, id_column, text_column, capacity)
    pieces = stored(pieces, "pieces")
    total = pieces.count()
    buckets = max(BUCKETS, -(-total // ROWS_PER_BUCKET))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = stored(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = rank_by_length(pieces, counts, buckets)
    return assign(ranked, plan(histogram, capacity)).select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
