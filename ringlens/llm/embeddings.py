"""Near-duplicate vectors by random-hyperplane signs in several tables.

Vectors of one label that agree in all signs of one table meet in a bucket,
where the exact cosine decides. A pair counts in the first table that brings
it together, so sums over buckets count every link once. Buckets give back a
count per vector and a spanning set of links, never pairs; a large bucket is
split into tiles of bounded size, each pair of tiles a group of its own.

The number of signs follows the number of vectors, so that a bucket of
unrelated vectors stays small, and the number of tables follows the signs, so
that a pair at the threshold is missed with probability ``MISS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.components import connected_components
from ringlens.session import stored

LEAST_COSINE = 0.93
MISS = 1e-3
BUCKET = 4
MIN_BITS = 6
TILE = 2_048
SEED = 20_240
KEY = ["label", "size", "table", "code"]
GROUP = [*KEY, "one", "two"]
#: Groups up to this size are compared side by side, larger ones row block by row block.
SMALL_GROUP = 64
PAIRS = 32_768
ROWS_AT_ONCE = 8_192


def tables_for(vectors: int, least_cosine: float = LEAST_COSINE, miss: float = MISS) -> tuple[int, int]:
    """Signs per table, and tables, for so many vectors of one label."""
    bits = max(MIN_BITS, math.ceil(math.log2(max(vectors, 1) / BUCKET)))
    alike = (1 - math.acos(least_cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-alike))


def hyperplanes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, bits * tables))


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The signs of each table as one number per vector and table."""
    signs = vectors @ hyperplanes(vectors.shape[1], bits, tables) >= 0
    return signs.reshape(len(vectors), tables, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def unit_vectors(values: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and unit vectors of the usable ones: finite, not zero, no null."""
    places, units = [], []
    for i, value in enumerate(values):
        if value is None or any(x is None for x in value):
            continue
        vector = np.asarray(value, float)
        largest = np.abs(vector).max(initial=0)
        if not np.isfinite(largest) or largest == 0:
            continue
        vector = vector / largest
        places.append(i)
        units.append(vector / np.linalg.norm(vector))
    return np.array(places, int), units


def bucketed(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """A row per usable vector and table: its bucket, all its signatures and its unit vector."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                places, units = unit_vectors(batch.column("vec").to_pylist())
                for size in sorted({len(u) for u in units}):
                    chosen = [i for i, u in enumerate(units) if len(u) == size]
                    unit = np.stack([units[i] for i in chosen])
                    codes = signatures(unit, bits, tables)
                    row = np.repeat(np.arange(len(chosen)), tables)
                    at = pa.array(places[chosen][row])
                    packed = np.array([c.tobytes() for c in codes], object)
                    units_bytes = np.array([u.tobytes() for u in unit], object)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("label").take(at),
                            pa.array(np.full(len(row), size, np.int32)),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(chosen))),
                            pa.array(codes.ravel()),
                            batch.column("node").take(at),
                            batch.column("copies").take(at),
                            pa.array(packed[row], pa.binary()),
                            pa.array(units_bytes[row], pa.binary()),
                        ],
                        ["label", "size", "table", "code", "node", "copies", "codes", "unit"],
                    )

    schema = "label string, size int, table int, code bigint, node bigint, copies bigint, codes binary, unit binary"
    return vectors.select(F.col("label").cast("string").alias("label"), "node", "copies", "vec").mapInArrow(spread, schema)


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Splits buckets of more than ``tile`` rows: ``one`` and ``two`` name the pair of tiles a row takes part in.

    Only the keys of such buckets are looked up; without any, rows pass as they are.
    """
    counts = rows.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") > tile)
    large = stored(counts.select(*KEY, F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "large-buckets")
    zero = F.lit(0)
    if large.isEmpty():
        return rows.select(*KEY, zero.alias("one"), zero.alias("two"), zero.alias("mine"), "node", "copies", "codes", "unit")
    mine = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(F.least(F.col("mine"), other).alias("one"), F.greatest(F.col("mine"), other).alias("two")),
    )
    return (
        rows.join(large, KEY, "left")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("pair", F.explode(pair))
        .select(*KEY, "pair.*", "mine", "node", "copies", "codes", "unit")
    )


def spanning(node: np.ndarray, i: np.ndarray, j: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """Links among the given ones that join what was not joined before."""

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(node[i].tolist(), node[j].tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


class Rows:
    """Rows of whole groups, sorted by group, as arrays."""

    def __init__(self, table: pa.Table) -> None:
        self.node = table.column("node").to_numpy()
        self.mine = table.column("mine").to_numpy()
        self.copies = table.column("copies").to_numpy()
        self.table = table.column("table").to_numpy()
        self.across = table.column("one").to_numpy() != table.column("two").to_numpy()
        self.unit = unpacked(table.column("unit"), float)
        self.codes = unpacked(table.column("codes"), np.int64)

    def links(self, i: np.ndarray, j: np.ndarray, least_cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs that link, and meet here first: not within a tile twice, nor in an earlier table."""
        keep = ~self.across[i] | (self.mine[i] != self.mine[j])
        i, j = i[keep], j[keep]
        found = np.zeros(len(i), bool)
        for at in range(0, len(i), PAIRS):
            part = slice(at, at + PAIRS)
            found[part] = np.einsum("ij,ij->i", self.unit[i[part]], self.unit[j[part]]) >= least_cosine
        i, j = i[found], j[found]
        first = np.zeros(len(i), bool)
        for at in range(0, len(i), PAIRS):
            part = slice(at, at + PAIRS)
            same = self.codes[i[part]] == self.codes[j[part]]
            first[part] = same.argmax(axis=1) == self.table[i[part]]
        return i[first], j[first]


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(value, kind) for value in column.to_pylist()])


def pairs_of(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within groups of consecutive rows, a bounded number at a time."""
    sizes = stops - starts
    small = sizes <= SMALL_GROUP
    group = np.repeat(np.arange(small.sum()), sizes[small])
    place = np.concatenate([np.arange(a, b) for a, b in zip(starts[small], stops[small], strict=True)] or [np.zeros(0, int)])
    for apart in range(1, SMALL_GROUP):
        together = np.flatnonzero(group[apart:] == group[:-apart])
        if not len(together):
            break
        yield place[together], place[together + apart]
    for start, stop in zip(starts[~small], stops[~small], strict=True):
        for first in range(start, stop, 64):
            rows = np.arange(first, min(first + 64, stop))
            i = np.repeat(rows, stop - 1 - rows)
            yield i, np.concatenate([np.arange(row + 1, stop) for row in rows])


def linked_rows(table: pa.Table, least_cosine: float) -> pa.RecordBatch:
    """Links of whole groups: rows (node, links found here, node) and spanning links (a, 0, b).

    A link to a node counts once for each of its copies.
    """
    edges = np.flatnonzero(new_groups(table))
    starts, stops = edges, np.append(edges[1:], table.num_rows)
    sizes = table.column("size").to_numpy()[starts]
    counts: dict[int, int] = {}
    links: list[tuple[int, int]] = []
    for size in np.unique(sizes):
        chosen = (sizes == size) & (stops - starts > 1)
        if not chosen.any():
            continue
        place = np.concatenate([np.arange(a, b) for a, b in zip(starts[chosen], stops[chosen], strict=True)])
        rows = Rows(table.take(pa.array(place)))
        ends = np.cumsum(stops[chosen] - starts[chosen])
        out_i, out_j = [], []
        for i, j in pairs_of(np.append(0, ends[:-1]), ends):
            i, j = rows.links(i, j, least_cosine)
            out_i.append(i)
            out_j.append(j)
        i, j = np.concatenate(out_i), np.concatenate(out_j)
        total = np.zeros(len(rows.node), np.int64)
        np.add.at(total, i, rows.copies[j])
        np.add.at(total, j, rows.copies[i])
        for node, n in zip(rows.node[total > 0].tolist(), total[total > 0].tolist(), strict=True):
            counts[node] = counts.get(node, 0) + n
        links += spanning(rows.node, i, j, {})
    nodes = [*counts, *(a for a, _ in links)]
    found = [*counts.values(), *[0] * len(links)]
    others = [*counts, *(b for _, b in links)]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in (nodes, found, others)], ["node", "links", "other"]
    )


def new_groups(table: pa.Table) -> np.ndarray:
    """Whether a row differs from the one before in what makes a group."""
    begins = np.zeros(table.num_rows, bool)
    begins[:1] = True
    for name in GROUP:
        column = table.column(name).combine_chunks()
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            column = column.dictionary_encode().indices
        values = column.to_numpy(zero_copy_only=False)
        begins[1:] |= values[1:] != values[:-1]
    return begins


def linked_in_order(least_cosine: float):
    """A function over rows sorted by group, which keeps back the last group until it is whole."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < ROWS_AT_ONCE:
                continue
            last = int(np.flatnonzero(new_groups(held))[-1])
            if last:
                yield linked_rows(held.slice(0, last), least_cosine)
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield linked_rows(held, least_cosine)

    return linked


def embedding_groups(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    least_cosine: float = LEAST_COSINE,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    * Vectors link within one label that is not null, if their cosine is at
      least ``least_cosine``. Vectors that are null, empty, zero or hold null
      or non-finite components link with nothing, nor do vectors of different
      length. Such rows, and lone ones, are their own component.
    * Equal vectors of one label are one node, so copies never meet in pairs;
      they count among each other's links.
    * Repeated ids are rows of their own. A null id is kept, is not the id of
      a component unless it has no other, and a row with it is never ``kept``.
      Other columns are not read; an empty table gives an empty result.
    """
    plain = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{label_column}`").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vec"),
    )
    usable = F.expr("label IS NOT NULL AND vec IS NOT NULL AND exists(vec, x -> x <> 0D) AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    # A node stands for all copies of a vector under a label; adding zero makes -0.0 equal to 0.0.
    unsigned = F.transform("vec", lambda x: x + F.lit(0.0))
    key = [F.when(usable, F.xxhash64(F.lit(salt), "label", unsigned)).alias(f"key{salt}") for salt in (1, 2)]
    marked = stored(plain.select("*", *key), "vectors")
    classes = stored(
        marked.where("key1 is not null")
        .groupBy("key1", "key2")
        .agg(
            F.count("*").alias("copies"),
            F.min("id").alias("least"),
            F.any_value("label").alias("label"),
            F.any_value("vec").alias("vec"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits, tables = tables_for(largest, least_cosine)
    rows = stored(bucketed(classes, bits, tables), "buckets")
    dealt = tiled(rows, tile).repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
    found = dealt.mapInArrow(linked_in_order(least_cosine), "node bigint, links bigint, other bigint")
    found = stored(found, "vector-links")
    return labelled(marked, classes, found, id_column)


def labelled(marked: DataFrame, classes: DataFrame, found: DataFrame, id_column: str) -> DataFrame:
    """Counts and components of classes, given back to the vectors."""
    joined = connected_components(found.where("links = 0"), "node", "other")
    roots = classes.join(joined, "node", "left").select(
        "node", "key1", "key2", "least", "copies", F.coalesce("component", "node").alias("root")
    )
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = (
        roots.join(smallest, "root")
        .join(linked, "node", "left")
        .select("key1", "key2", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    )
    component = F.coalesce("component_id", "id")
    return marked.join(of_class, ["key1", "key2"], "left").select(
        F.col("id").alias(id_column),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
