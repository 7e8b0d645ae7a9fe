"""Collocations: phrases whose words occur together more often than their parts would.

Phrases are counted in tries over word ids. The two upper levels are nodes,
below them stand hash containers; a container that grows too large bursts into
a node of smaller ones. A trie that holds too many entries gives away whole
subtrees, the largest first, each as a sorted run of partial counts. What a task
gives away travels in parts by the hash of the prefix, many phrases to a row, and
is merged by part, so that a prefix's phrases meet in one partition. Counting
goes from words over pairs to longer phrases. As a phrase is no more frequent
than its parts, and none is more frequent than all that fall in its hash
bucket, each pass counts only what the tables of the passes before let through.
Tables have a bounded size and know every frequent word, pair or triple; what
they let through by mistake costs rows and changes no count.
"""

from __future__ import annotations

import re
import string
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.llm.words import utf8
from ringlens.session import stored

LONGEST = 5
LEAST_COUNT = 100
FIRST = 2000
NO_LANG = "und"
#: Size of a bit table; with more frequent phrases than an eighth of it, it lets more pass and stays right.
FILTER_BITS = 1 << 25
#: Entries of one container, and of a task's trie or word table, before it bursts or spills.
BURST = 4_096
ENTRIES = 400_000
#: Words that are looked at together.
WORDS_AT_ONCE = 1 << 19
BLOCK = 1 << 22
SEED = 42
#: Buckets for the occurrences of pairs and triples: a power of two from the number of words, within bounds. Eight to sixteen
#: words fall in each, so that few pass by what else is in them. A task needs a byte for each (two for least counts over 255); beyond MOST_BUCKETS * WORDS_PER_BUCKET words more phrases are counted that turn out not to be frequent.
WORDS_PER_BUCKET = 16
LEAST_BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 27
BUCKET_BLOCK = 1 << 14
CODEC = "zstd"
#: Parts that the prefixes of one language are dealt to. A task sends at most one row per language and part each time it
#: empties its trie, so rows grow with the tasks and not with the frequent phrases times the tasks.
PARTS = 1024
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, 4, np.uint64) * np.uint64(2) + np.uint64(1)

#: Characters between pieces become full stops, which no word holds; tabs become blanks.
TABLE = bytes.maketrans(
    b".,;:!?\n\x0b\x0c\r\t" + string.ascii_uppercase.encode(), b"." * 10 + b" " + string.ascii_lowercase.encode()
)
STOP = b"."
END = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
RUN = "lang string, prefix string, phrase string, words int, f bigint, block bigint, counts binary"
RUN_TYPE = pa.schema(
    [
        ("lang", pa.string()), ("prefix", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64()),
        ("block", pa.int64()), ("counts", pa.binary()),
    ]
)
PACKED = "lang string, part bigint, phrases binary, f binary, block bigint, counts binary"
PACKED_TYPE = pa.schema(
    [
        ("lang", pa.string()), ("part", pa.int64()), ("phrases", pa.binary()), ("f", pa.binary()), ("block", pa.int64()),
        ("counts", pa.binary()),
    ]
)
COUNT_TYPE = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])
LINE = b"\n"


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and stops of a text, block by block."""
    start = 0
    while start < len(text):
        stop = start + BLOCK
        if stop < len(text):
            found = END.search(text, stop)
            stop = found.start() if found else len(text)
        yield text[start:stop].translate(TABLE).replace(STOP, b" . ").split()
        start = stop


def columns_of(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
        if text:
            yield lang, text


def run_of(rows: list[tuple]) -> pa.RecordBatch:
    rows.sort(key=lambda row: (row[0] or "", row[2] or ""))
    return table_of(rows, RUN_TYPE)


def table_of(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(list(column), field.type) for column, field in zip(zip(*rows, strict=True), kind, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=kind)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of word counts by language, and the number of all words under a null phrase."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def spilled() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(STOP, None)
            if found:
                rows = [(lang, word, word, 1, n, None, None) for word, n in ((w.decode("utf-8", "replace"), n) for w, n in found.items())]
                yield run_of([*rows, (lang, "", None, 0, found.total(), None, None)])
        counts.clear()

    for batch in batches:
        for lang, text in columns_of(batch):
            for block in tokens(text):
                counts[lang].update(block)
            if len(counts[lang]) > ENTRIES or len(counts) > 64 and sum(map(len, counts.values())) > ENTRIES:
                yield from spilled()
        if sum(map(len, counts.values())) > ENTRIES:
            yield from spilled()
    yield from spilled()


class BitTable:
    """A set of 64-bit hashes, told by their leading bits; it forgets none of its members."""

    def __init__(self, table: bytes):
        self.table, self.places = table, np.frombuffer(table, np.uint8)
        self.shift = 64 - (8 * len(table)).bit_length() + 1

    def has(self, h: int) -> int:
        place = h >> self.shift
        return self.table[place >> 3] >> (place & 7) & 1

    def among(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(self.shift)
        return (self.places[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\n" + word, SEED)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first * FACTORS[0] + second * FACTORS[1]


def triple_hashes(pairs: np.ndarray, third: np.ndarray) -> np.ndarray:
    return (pairs ^ (pairs >> np.uint64(29))) * FACTORS[2] + third * FACTORS[3]


def bit_table(phrases: DataFrame, bits: int = FILTER_BITS) -> BitTable:
    """Words or pairs as a bit table; at most ``bits`` / 64 numbers reach the driver."""
    shift = np.uint64(64 - bits.bit_length() + 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [
                [word_hash(lang, word) for word in phrase.encode().split(b" ")]
                for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
            ]
            if hashes:
                a = np.array(hashes, np.uint64)
                h = a[:, 0] if a.shape[1] == 1 else pair_hashes(a[:, 0], a[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array((h >> shift).astype(np.int64))], names=["place"])

    place = phrases.select("lang", "phrase").mapInArrow(placed, "place bigint")
    words = place.groupBy(F.expr("place div 64").alias("i")).agg(F.expr("bit_or(shiftleft(1L, int(place % 64)))").alias("w"))
    table = np.zeros(bits // 64, "<i8")
    found = words.toArrow()
    table[found.column("i").to_numpy()] = found.column("w").to_numpy()
    return BitTable(table.tobytes())


def bucket_table(counts: DataFrame, buckets: int, least_count: int) -> BitTable:
    """The buckets whose counts of all tasks add up to ``least_count``; one bit of each reaches the driver."""

    kind = count_type(least_count)
    size = BUCKET_BLOCK * np.dtype(kind).itemsize

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None

        def done() -> Iterator[pa.RecordBatch]:
            if block is not None:
                bits = np.packbits(total >= least_count, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for number, data in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                if number != block:
                    yield from done()
                    block, total = number, np.zeros(BUCKET_BLOCK, np.int64)
                total += np.frombuffer(pa.decompress(data.as_buffer(), size, CODEC), kind)
        yield from done()

    rows = counts.repartition("block").sortWithinPartitions("block").mapInArrow(added, "block bigint, bits binary")
    table = bytearray(buckets // 8)
    width = BUCKET_BLOCK // 8
    for row in rows.collect():
        table[row.block * width : (row.block + 1) * width] = row.bits
    return BitTable(bytes(table))


def count_type(least_count: int) -> type:
    """Numbers that hold ``least_count``, beyond which no bucket counts."""
    return np.uint8 if least_count <= np.iinfo(np.uint8).max else np.uint16


def bucket_number(words: int) -> int:
    """Buckets for so many words, a power of two within documented bounds; few enough occurrences fall in each to tell."""
    return min(max(1 << (words // WORDS_PER_BUCKET).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)


class Node(dict):
    """A level of the trie: word ids (four bytes) and what lies below, nodes or containers."""


class HatTrie:
    """Counts of paths of word ids, four bytes each."""

    LEVELS = 2

    def __init__(self, most: int = ENTRIES, burst: int = BURST):
        self.root, self.size, self.most, self.burst_at = Node(), 0, most, burst

    def add(self, path: bytes, n: int) -> None:
        node, depth = self.root, 0
        while True:
            head = path[depth : depth + 4]
            below = node.get(head)
            if below is None:
                below = node[head] = {}
            depth += 4
            if type(below) is Node:
                node = below
                continue
            rest = path[depth:]
            if rest in below:
                below[rest] += n
            else:
                below[rest] = n
                self.size += 1
                if len(below) > self.burst_at and depth < 4 * self.LEVELS:
                    node[head] = self.burst(below)
            return

    @staticmethod
    def burst(container: dict[bytes, int]) -> Node:
        node = Node()
        for rest, n in container.items():
            node.setdefault(rest[:4], {})[rest[4:]] = n
        return node

    def paths(self, head: bytes) -> list[tuple[bytes, int]]:
        """All paths below one child of the root, in order."""
        found, open_ = [], [(head, self.root[head])]
        while open_:
            prefix, below = open_.pop()
            if type(below) is Node:
                open_ += [(prefix + key, child) for key, child in below.items()]
            else:
                found += [(prefix + rest, n) for rest, n in below.items()]
        return sorted(found)

    def subtrees(self, keep: int) -> Iterator[list[tuple[bytes, int]]]:
        """Gives away whole subtrees, the largest first, until at most ``keep`` entries are left."""
        sizes = {head: self._entries(below) for head, below in self.root.items()}
        for head in sorted(sizes, key=lambda head: -sizes[head]):
            if self.size <= keep:
                return
            found = self.paths(head)
            self.size -= len(found)
            del self.root[head]
            yield found

    def _entries(self, below: dict) -> int:
        return sum(map(self._entries, below.values())) if type(below) is Node else len(below)


class Scan:
    """What one pass over the texts does, and what the passes before let through.

    Counts in a trie the phrases of ``shortest`` to ``longest`` words, and adds
    up the pairs or triples (``width``) by the bucket of their hash.
    """

    def __init__(self, words, pairs=None, triples=None, shortest=0, longest=1, width=0, buckets=0, least_count=LEAST_COUNT):
        self.words, self.pairs, self.triples = words, pairs, triples
        self.shortest, self.longest, self.width = shortest, longest, width
        self.buckets, self.least_count = buckets, least_count
        self.reach = max(longest, width, 3)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, langs, hashes = [""], [""], array("Q", [0])
        ids: dict[str, Ids] = {}
        trie = HatTrie(ENTRIES, BURST)
        counts = np.zeros(self.buckets, count_type(self.least_count))
        shift = np.uint64(64 - self.buckets.bit_length() + 1)
        gap = [0] * (self.reach - 1)

        def rows(subtree: list[tuple[bytes, int]]) -> list[tuple]:
            sums: Counter = Counter()
            for path, n in subtree:
                for end in range(4 * self.shortest, len(path) + 1, 4):
                    sums[path[:end]] += n
            out = []
            for path, n in sums.items():
                numbers = np.frombuffer(path, ">u4").tolist()
                parts = [names[number] for number in numbers]
                out.append((langs[numbers[0]], " ".join(parts[:2]), " ".join(parts), len(parts), n, None, None))
            return out

        def added(numbers: list[int]) -> Iterator[pa.RecordBatch]:
            """Counts what starts before the last ``reach`` - 1 of the words."""
            a = np.array(numbers, np.int64)
            starts = len(a) - self.reach + 1
            link = (a[:-1] > 0) & (a[1:] > 0)
            h = np.frombuffer(hashes, np.uint64)[a]
            pair = pair_hashes(h[:-1], h[1:])
            if self.pairs is not None:
                link[link] = self.pairs.among(pair[link])
            three = link[:-1] & link[1:]
            triple = triple_hashes(pair[:-1], h[2:])
            if self.triples is not None:
                three[three] = self.triples.among(triple[three])
            if self.width:
                taken = pair[:starts][link[:starts]] if self.width == 2 else triple[:starts][three[:starts]]
                place, times = np.unique((taken >> shift).astype(np.int64), return_counts=True)
                # Beyond the least count nothing changes, so small numbers do.
                counts[place] = np.minimum(counts[place] + times, self.least_count)
            if not self.shortest:
                return
            length, going = np.ones(starts, np.int64), np.ones(starts, bool)
            for k in range(self.longest - 1):
                going &= link[k : k + starts] if k == 0 else three[k - 1 : k - 1 + starts]
                length += going
            at = np.flatnonzero(length >= self.shortest)
            data = a.astype(">u4").tobytes()
            begin = 4 * at
            found = Counter(map(data.__getitem__, map(slice, begin.tolist(), (begin + 4 * length[at]).tolist())))
            for path, n in found.items():
                trie.add(path, n)
            if trie.size > trie.most:
                for subtree in trie.subtrees(trie.most // 2):
                    yield run_of(rows(subtree))

        numbers: list[int] = []
        for batch in batches:
            for lang, text in columns_of(batch):
                table = ids.get(lang)
                if table is None:
                    table = ids[lang] = Ids(self.words, lang, names, langs, hashes)
                for block in tokens(text):
                    numbers += map(table.__getitem__, block)
                    if len(table) > table.limit:
                        table.keep()
                    if len(numbers) > WORDS_AT_ONCE:
                        yield from added(numbers)
                        numbers = numbers[len(numbers) - self.reach + 1 :]
                numbers += gap
        yield from added([*numbers, *gap])
        for subtree in trie.subtrees(0):
            yield run_of(rows(subtree))
        for block in range(self.buckets // BUCKET_BLOCK):
            part = counts[block * BUCKET_BLOCK : (block + 1) * BUCKET_BLOCK]
            if part.any():
                yield run_of([(None, None, None, None, None, block, pa.compress(part.tobytes(), CODEC, asbytes=True))])


class Ids(dict):
    """Word ids of one language; words that cannot be frequent have 0 and are forgotten when they are many."""

    def __init__(self, words: BitTable, lang: str, names: list[str], langs: list[str], hashes: array):
        self.words, self.lang, self.names, self.langs, self.hashes = words, lang, names, langs, hashes
        self.keep()

    def keep(self) -> None:
        kept = {word: number for word, number in self.items() if number}
        self.clear()
        self.update(kept)
        self[STOP] = 0
        self.limit = len(self) + ENTRIES

    def __missing__(self, word: bytes) -> int:
        number, h = 0, word_hash(self.lang, word)
        if self.words.has(h):
            number = len(self.names)
            self.names.append(word.decode("utf-8", "replace"))
            self.langs.append(self.lang)
            self.hashes.append(h)
        self[word] = number
        return number


class Packed:
    """A scan whose partial counts leave the task as rows of many phrases, one per language and part; no phrase holds a line end."""

    def __init__(self, scan: Scan):
        self.scan = scan

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple, tuple[list, list]] = defaultdict(lambda: ([], []))
        held = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            rows = [
                (lang, part, LINE.join(phrases), np.array(counts, "<i8").tobytes(), None, None)
                for (lang, part), (phrases, counts) in parts.items()
            ]
            if rows:
                yield table_of(rows, PACKED_TYPE)
            parts.clear()

        for run in self.scan(batches):
            for row in run.to_pylist():
                if row["block"] is not None:
                    yield table_of([(None, None, None, None, row["block"], row["counts"])], PACKED_TYPE)
                    continue
                phrases, counts = parts[row["lang"], xxhash.xxh64_intdigest(row["prefix"], SEED) % PARTS]
                phrases.append(row["phrase"].encode())
                counts.append(row["f"])
                held += 1
            if held > ENTRIES // 2:
                yield from emptied()
                held = 0
        yield from emptied()


def merged_parts(runs: DataFrame, least_count: int) -> DataFrame:
    """Adds the partial counts of all tasks, part by part: the phrases that occur ``least_count`` times."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, Counter()

        def done() -> Iterator[pa.RecordBatch]:
            found = [(at[0], p.decode(), p.count(b" ") + 1, n) for p, n in sums.items() if n >= least_count]
            if found:
                yield table_of(found, COUNT_TYPE)

        for batch in batches:
            for lang, part, phrases, f in zip(*(batch.column(name).to_pylist() for name in ("lang", "part", "phrases", "f")), strict=True):
                if (lang, part) != at:
                    yield from done()
                    at, sums = (lang, part), Counter()
                for phrase, n in zip(phrases.split(LINE), np.frombuffer(f, "<i8").tolist(), strict=True):
                    sums[phrase] += n
        yield from done()

    rows = runs.where("block is null").select("lang", "part", "phrases", "f")
    return rows.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(added, "lang string, phrase string, words int, f bigint")


def merged(runs: DataFrame) -> DataFrame:
    """Adds the partial counts of all runs, one prefix of at most two words in one partition."""
    return (
        runs.repartition("lang", "prefix")
        .groupBy("lang", "prefix", "phrase")
        .agg(F.first("words").alias("words"), F.sum("f").alias("f"))
        .drop("prefix")
    )


def frequent_phrases(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", longest: int = LONGEST,
    least_count: int = LEAST_COUNT, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Exact counts of all phrases of at most ``longest`` words that occur ``least_count`` times in their language.

    Columns ``lang``, ``phrase`` (words joined by blanks), ``words``, ``f``; a
    row with a null phrase has the number of all words. Reads the texts four
    times: for words, for the buckets of pairs of frequent words, for the pairs
    in buckets that can hold a frequent one and the buckets of triples of these,
    and for longer phrases made of such triples. ``least_count`` is at most 65,535.
    """
    plain = docs.select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text_column}`").alias("text")
    ).where("text is not null")
    frequent = f"f >= {int(least_count)} or phrase is null"
    found = stored(merged(plain.mapInArrow(count_words, RUN)).where(frequent), "words")
    if longest < 2:
        return found
    words = bit_table(found.where("phrase is not null"), filter_bits)
    total = found.where("phrase is null").agg(F.sum("f").alias("n")).first()["n"] or 0
    buckets = bucket_number(total)
    table = {"buckets": buckets, "least_count": least_count}
    scanned = plain.mapInArrow(Scan(words, width=2, **table), RUN).select("block", "counts")
    near_pairs = bucket_table(scanned, buckets, least_count)
    if longest == 2:
        doubles = plain.mapInArrow(Packed(Scan(words, near_pairs, shortest=2, longest=2, least_count=least_count)), PACKED)
        return found.unionByName(stored(merged_parts(doubles, least_count), "pairs"))
    scanned = stored(plain.mapInArrow(Packed(Scan(words, near_pairs, shortest=2, longest=2, width=3, **table)), PACKED), "pair_runs")
    doubles = stored(merged_parts(scanned, least_count), "pairs")
    triples = bucket_table(scanned.where("block is not null").select("block", "counts"), buckets, least_count)
    pairs = bit_table(doubles, filter_bits)
    longer = plain.mapInArrow(Packed(Scan(words, pairs, triples, 3, longest, least_count=least_count)), PACKED)
    return found.unionByName(doubles).unionByName(stored(merged_parts(longer, least_count), "phrases"))


def collocations(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", longest: int = LONGEST,
    least_count: int = LEAST_COUNT, first: int = FIRST, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The first phrases of each language by how far they exceed what their parts let expect.

    A phrase of 2 to ``longest`` words that occurs a >= ``least_count`` times has
    for each cut into two parts, which occur l and r times, the score
    floor(1000 a n / (l r)), n being the number of the language's words; the
    lowest counts, of equal ones that with the shortest first part. Phrases that
    a longer one contains and that occur no more often are left out. Numbers are
    exact: products are DECIMAL(38), which holds them for up to 10^15 words.

    A null text counts as empty, a null language as ``und``; equal rows count
    each; texts of any length are read block by block; an empty table has no
    phrases. Other columns are not read.
    """
    known = frequent_phrases(docs, lang_column, text_column, longest, least_count, filter_bits)
    totals = known.where("phrase is null").select("lang", F.col("f").alias("n"))
    counts = known.where("phrase is not null").select("lang", "phrase", "f")
    candidates = known.where("words >= 2").select("lang", "phrase", "f", F.split("phrase", " ").alias("w"), "words")
    # A longer phrase that is as frequent holds a phrase of one more word that is as frequent.
    inner = candidates.where("words >= 3").select(
        "lang", "f", F.explode(F.expr("array(array_join(slice(w, 1, words - 1), ' '), array_join(slice(w, 2, words - 1), ' '))")).alias("phrase")
    )
    outer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    kept = candidates.join(outer, ["lang", "phrase"], "left").where("outer is null or outer < f")
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"),
        F.explode(F.expr(
            "transform(sequence(1, words - 1), k -> struct(k AS k, array_join(slice(w, 1, k), ' ') AS head, "
            "array_join(slice(w, k + 1, words - k), ' ') AS tail))"
        )).alias("cut"),
    ).select("lang", "phrase", "a", "cut.*")
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    priced = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    score = F.expr(
        "(cast(a AS decimal(16, 0)) * cast(n AS decimal(16, 0)) * cast(1000 AS decimal(4, 0))) "
        "div (cast(l AS decimal(16, 0)) * cast(r AS decimal(16, 0)))"
    )
    least = priced.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    order = W.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    return (
        least.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= first)
        .select(
            "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("best.l").alias("l"),
            F.col("best.r").alias("r"), "n", F.col("best.score").cast("bigint").alias("score"),
        )
    )
