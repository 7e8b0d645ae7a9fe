"""Document fingerprints by content-defined chunking, and their likeness.

A gear hash runs over the UTF-8 bytes: each byte doubles the hash and adds its
own random number. Kept to the last 16 bytes, it is a sum that array operations
give for all places at once. A chunk ends where the leading bits of the hash
are zero: six of them up to the normal length, four beyond it, which keeps
lengths close to normal. Boundaries depend on the bytes before them only, so an
insertion changes the chunks around it and leaves the others as they are. The
fingerprint is the set of chunk digests with their lengths; what two share, in
bytes, over the smaller of the two is how far one contains the other.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.words import utf8

WINDOW = 16
SHORTEST = 16
NORMAL = 32
LONGEST = 255
#: Leading zero bits that end a chunk below the normal length, and beyond it.
HARD_BITS = 6
EASY_BITS = 4
GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint32, endpoint=False)
BLOCK = 1 << 20
#: Bytes of a chunk's digest; a record is a digest and a length.
DIGEST = 5
#: Ids seen per range when ranges are laid out, and at most overall; only the balance depends on them.
SAMPLE_PER_RANGE = 20
SAMPLE_ROWS = 1_000_000
NO_ID = -(1 << 63)


def boundary_candidates(data: bytes) -> tuple[list[int], list[int]]:
    """Places behind which a chunk may end, by the strict and by the lenient condition."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    easy = np.flatnonzero(h < (1 << (32 - EASY_BITS)))
    hard = easy[h[easy] < (1 << (32 - HARD_BITS))]
    return (hard + 1).tolist(), (easy + 1).tolist()


def chunks(data: bytes) -> Iterator[bytes]:
    """The chunks of a text in turn; a text of any length needs the memory of one block.

    The shortest chunk is as long as the window, so a boundary never depends on
    bytes before its chunk, and blocks that begin with a chunk change nothing.
    """
    begin = 0
    while begin < len(data):
        block = data[begin : begin + BLOCK]
        last = begin + len(block) == len(data)
        hard, easy = boundary_candidates(block)
        at, i, j = 0, 0, 0
        while at < len(block) and (last or at + LONGEST <= len(block)):
            end = min(at + LONGEST, len(block))
            i = bisect_left(hard, at + SHORTEST, i)
            if i < len(hard) and hard[i] < at + NORMAL:
                end = min(end, hard[i])
            else:
                j = bisect_left(easy, at + NORMAL, j)
                if j < len(easy):
                    end = min(end, easy[j])
            yield block[at:end]
            at = end
        begin += at


def chunk_records(data: bytes) -> frozenset[bytes]:
    digest = xxhash.xxh3_64_digest
    return frozenset([digest(chunk)[:DIGEST] + bytes((len(chunk),)) for chunk in chunks(data)])


def printed(records: frozenset[bytes]) -> str:
    """The fingerprint as text: sorted records of six bytes in base 64; empty for an empty text."""
    return base64.b64encode(b"".join(sorted(records))).decode("ascii")


def parsed(fingerprint: str) -> frozenset[bytes]:
    data = base64.b64decode(fingerprint)
    return frozenset(data[i : i + DIGEST + 1] for i in range(0, len(data), DIGEST + 1))


def weight(records: frozenset[bytes]) -> int:
    return sum(record[DIGEST] for record in records)


def containment(a: frozenset[bytes], b: frozenset[bytes]) -> float:
    """Bytes of the chunks that both have over those of the smaller; two empty ones are alike, one is not."""
    if not a or not b:
        return float(a == b)
    return weight(a & b) / min(weight(a), weight(b))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column; null counts as empty."""

    @F.arrow_udf("string")
    def computed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([printed(chunk_records(one or b"")) for one in utf8(texts)], pa.string())

    return computed(text)


def likeness(a: Column, b: Column) -> Column:
    """How far the smaller of two fingerprints is contained in the other, 0 to 1; null if either is null."""

    @F.arrow_udf("double")
    def computed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array(
                [
                    None if x is None or y is None else containment(parsed(x), parsed(y))
                    for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)
                ],
                pa.float64(),
            )

    return computed(a, b)


class Ranges:
    """Ranges of (id, tie) keys, and where each row goes: to its own range, and a range's greatest also to the one above.

    The row after the smallest of a range, in descending order, is the greatest
    of the next lower range; after the smallest of all comes the greatest of all.
    """

    def __init__(self, bounds: list[tuple[int, int]]):
        self.bounds = sorted(set(bounds))
        self.ids = np.array([bound[0] for bound in self.bounds], np.int64)
        self.also: dict[tuple[int, int], int] = {}

    def places(self, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.ids, ids, "left")
        high = np.searchsorted(self.ids, ids, "right")
        for i in np.flatnonzero(low < high):
            low[i] = low[i] + sum(bound[1] <= ties[i] for bound in self.bounds[low[i] : high[i]])
        return low

    def set_greatest(self, greatest: dict[int, tuple[int, int]]) -> None:
        used = sorted(greatest)
        for i, place in enumerate(used):
            self.also[greatest[place]] = used[(i + 1) % len(used)]


def _laid_out(keys: DataFrame, ranges: int) -> Ranges:
    rows = keys.count()
    wanted = min(SAMPLE_PER_RANGE * ranges, SAMPLE_ROWS)
    sample = keys if rows <= wanted else keys.sample(min(1.0, wanted / rows), seed=7)
    seen = sorted((row.id, row.tie) for row in sample.collect())
    return Ranges([seen[i * len(seen) // ranges] for i in range(1, ranges)] if len(seen) > 1 else [])


def _place(ranges: Ranges):
    @F.arrow_udf("int")
    def computed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, ties in batches:
            yield pa.array(ranges.places(ids.to_numpy(False), ties.to_numpy(False)), pa.int32())

    return computed


def _places(ranges: Ranges):
    @F.arrow_udf("array<struct<place: int, extra: boolean>>")
    def computed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct({"place": pa.int32(), "extra": pa.bool_()}))
        for ids, ties in batches:
            x, y = ids.to_numpy(False), ties.to_numpy(False)
            rows = []
            for place, key in zip(ranges.places(x, y).tolist(), zip(x.tolist(), y.tolist(), strict=True), strict=True):
                row = [{"place": place, "extra": False}]
                if key in ranges.also:
                    row.append({"place": ranges.also[key], "extra": True})
                rows.append(row)
            yield pa.array(rows, kind)

    return computed


def followed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``place``, ``extra``, ``id``, ``text``, partitioned by ``place`` and sorted so that each row's next one follows it.

    Texts are shuffled once. Ids are cut into as many ranges as there are
    shuffle partitions, by a sample of ids that decides on the balance alone; one
    row per range goes to a second range, as the one that follows there. Where
    an id takes more than a range, its rows are spread by the hash of their text.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    number = F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(NO_ID))
    plain = docs.select(number.alias("id"), F.lit(0).cast("bigint").alias("tie"))
    layout = _laid_out(plain, ranges)
    spread = len(layout.bounds) + 1 < min(ranges, plain.count())
    tie = F.xxhash64(text) if spread else F.lit(0).cast("bigint")
    if spread:
        plain = docs.select(number.alias("id"), tie.alias("tie"))
        layout = _laid_out(plain, ranges)
    greatest = (
        plain.select("id", "tie", _place(layout)("id", "tie").alias("place"))
        .groupBy("place")
        .agg(F.max(F.struct("id", "tie")).alias("key"))
        .collect()
    )
    layout.set_greatest({row.place: (row.key.id, row.key.tie) for row in greatest})
    return (
        docs.select(F.col(f"`{id_column}`").alias("own"), number.alias("id"), tie.alias("tie"), text.alias("text"))
        .withColumn("places", _places(layout)("id", "tie"))
        .select("own", "id", "text", F.inline("places"))
        .repartition("place")
        .sortWithinPartitions("place", "extra", F.desc("id"), F.desc(F.xxhash64("text")))
    )


def edited(text: str, following: str) -> str:
    """The text with its last half, in code points and rounded down, replaced by the first as many of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def document_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how near they are, and the next document's.

    The next document is the one with the next smaller id, after the last the
    first. Ids are whole numbers; a null id comes last, rows of one id follow
    each other by the hash of their text, and equal rows are alike. A null text
    counts as empty; an empty text has an empty fingerprint, is near to empty
    ones only, and texts below 16 bytes are one chunk. Texts of any length are
    chunked block by block. Other columns are not read. An empty table gives none.
    """
    kind = pa.schema(
        [
            ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (place, id, text, records) of the row whose next one is still to come
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("place", "extra", "own")]
            rows = []
            for place, extra, own, data in zip(*columns, utf8(batch.column("text")), strict=True):
                if extra and waiting is None:
                    continue
                text, records = data.decode("utf-8", "replace"), chunk_records(data)
                if waiting is not None:
                    _, before, old, known = waiting
                    new = edited(old, text).encode("utf-8")
                    changed = chunk_records(new)
                    rows.append(
                        (
                            before, len(old), hashlib.sha256(new).hexdigest(), printed(known), printed(changed),
                            containment(known, changed), containment(known, records),
                        )
                    )
                waiting = None if extra else (place, own, text, records)
            if rows:
                arrays = [pa.array(list(column), field.type) for column, field in zip(zip(*rows, strict=True), kind, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    rows = followed(docs, id_column, text_column).select("place", "extra", F.col("own").cast("bigint").alias("own"), "text")
    schema = (
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return rows.mapInArrow(compared, schema).withColumnRenamed("id", id_column)
