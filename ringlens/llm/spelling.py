"""Spelling variants: words one edit apart, found by an index of grams of varying length.

The gram dictionary is pruned by frequency: a gram of a word is made longer
only while more than ``limit`` words hold it, so frequent beginnings get long
grams and rare ones stay short. An edit at a given place affects the grams
that reach it. What it leaves to the left and to the right is decomposed by
the same dictionary, and of each side the rarest gram is taken, with its place
counted from that side's end of the word. Two words one edit apart agree in
both at the place of the edit. The lists of the two grams are merged by
equality of the pair, and the pairs of words that meet are verified. Different
places of an edit mostly leave the same grams, so a word has few entries.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.words import utf8
from ringlens.session import stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One run in so many, by its checksum, loses a letter.
ALTERED = 97
SHORTEST_GRAM = 2
LONGEST_GRAM = 6
#: Grams of one length that are made longer: at most so many, so the dictionary has at most five times as many.
DICTIONARY = 40_000
LEAST_LIMIT = 8
ENTRIES = 400_000
BLOCK = 1 << 22
BEGIN, END = "^", "$"

#: A-Z and a-z, and the letters from U+00C0 to U+00FF as UTF-8, of which only A-Z have been made small before.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_LENGTH)
NOT_RUN = re.compile(rb"[^A-Za-z\x80-\xff]")


def runs(text: bytes) -> Iterator[list[bytes]]:
    """Runs of letters of at least five code points, in lower case, block by block."""
    start = 0
    while start < len(text):
        stop = start + BLOCK
        if stop < len(text):
            found = NOT_RUN.search(text, stop)
            stop = found.start() if found else len(text)
        yield RUN.findall(text[start:stop].lower())
        start = stop


def altered(run: bytes, checksum: int) -> bytes | None:
    """The run without one code point, or None if it has become too short."""
    word = run.decode("utf-8")
    at = checksum % len(word)
    word = word[:at] + word[at + 1 :]
    return word.encode("utf-8") if len(word) >= LEAST_LENGTH else None


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n``: the different runs of letters with their number of occurrences, at least ``least_count``."""
    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def spilled() -> pa.RecordBatch:
            words = sorted(word for word, n in total.items() if n)
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8") for w in words], pa.string()), pa.array([total[w] for w in words], pa.int64())],
                schema=kind,
            )
            total.clear()
            return out

        for batch in batches:
            for number, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text")), strict=True):
                base = zlib.crc32(f"{'' if number is None else number}:".encode())
                for found in runs(text or b""):
                    total.update(found)
                    changed = {run: h for run in set(found) if not (h := zlib.crc32(run, base)) % ALTERED}
                    if changed:
                        times = Counter(run for run in found if run in changed)
                        for run, n in times.items():
                            total[run] -= n
                            word = altered(run, changed[run])
                            if word is not None:
                                total[word] += n
                    if len(total) > ENTRIES:
                        yield spilled()
        yield spilled()

    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).where("text is not null")
    counts = plain.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame, size: int = DICTIONARY) -> dict[str, int]:
    """The grams that are made longer, with the number of places that hold them, length by length.

    ``limit`` is the number of places over ``size``, so no length has more than
    ``size`` grams above it, whatever the number of words.
    """
    places = words.agg(F.sum(F.length("word") + 1).alias("n")).first()["n"] or 0
    limit = max(LEAST_LIMIT, -(-places // size))
    known: dict[str, int] = {}
    for length in range(SHORTEST_GRAM, LONGEST_GRAM):

        def grams(batches: Iterator[pa.RecordBatch], length=length, known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: Counter = Counter()
                for word in batch.column("word").to_pylist():
                    whole = BEGIN + word + END
                    found.update(
                        whole[i : i + length]
                        for i in range(len(whole) - length + 1)
                        if length == SHORTEST_GRAM or whole[i : i + length - 1] in known
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"]
                )

        counts = words.select("word").mapInArrow(grams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        level = {row.gram: row.n for row in counts.where(F.col("n") > limit).collect()}
        if not level:
            break
        known.update(level)
    return known


def rarest_left(whole: str, known: dict[str, int]) -> list[tuple[int, int, str]]:
    """For each e, the rarest gram within ``whole[:e]`` as (places, start, gram); rare ones count as 0, none as -1.

    It is a running minimum, as a gram is no rarer than the gram it begins.
    """
    best = (1 << 62, -1, "")
    out = [best] * min(SHORTEST_GRAM, len(whole) + 1)
    for e in range(SHORTEST_GRAM, len(whole) + 1):
        for start in range(max(0, e - LONGEST_GRAM), e - SHORTEST_GRAM + 1):
            gram = whole[start:e]
            if e - start > SHORTEST_GRAM and whole[start : e - 1] not in known:
                continue  # it ended before
            rank = known.get(gram, 0)
            if rank < best[0]:
                best = (rank, start, gram)
        out.append(best)
    return out


def rarest_right(whole: str, known: dict[str, int]) -> list[tuple[int, int, str]]:
    """For each j, the rarest gram within ``whole[j:]`` as (places, distance from the end, gram)."""
    best = (1 << 62, -1, "")
    out = [best] * (len(whole) + 1)
    for start in range(len(whole) - SHORTEST_GRAM, -1, -1):
        stop = start + SHORTEST_GRAM
        while stop < len(whole) and stop - start < LONGEST_GRAM and whole[start:stop] in known:
            stop += 1
        rank = known.get(whole[start:stop], 0)
        if rank < best[0]:
            best = (rank, len(whole) - start, whole[start:stop])
        out[start] = best
    return out


def entries(word: str, known: dict[str, int]) -> tuple[set[int], set[int]]:
    """Keys of the word with one code point left out, and of the word as it is for one put in.

    A key tells the length of the longer word and, for one place of the edit,
    the rarest gram on either side of it.
    """
    whole = BEGIN + word + END
    left, right = rarest_left(whole, known), rarest_right(whole, known)

    def key(length: int, i: int, j: int) -> int:
        (_, start, before), (_, distance, after) = left[i], right[j]
        return xxhash.xxh64_intdigest(f"{length} {start} {before} {distance} {after}".encode()) - (1 << 63)

    n = len(word)
    out = {(left[i], right[i + 1]): i for i in range(1, n + 1)}
    put = {(left[i], right[i]): i for i in range(1, n + 2)}
    return {key(n, i, i + 1) for i in out.values()}, {key(n + 1, i, i) for i in put.values()}


def near_words(words: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: all pairs of words one insertion, deletion or replacement apart, both ways.

    Long lists are split between tasks where Spark's adaptive join finds them;
    no pair leaves the join unverified.
    """
    known = gram_dictionary(words, size)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, put, rows = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                without, within = entries(word, known)
                keys += [*without, *within]
                put += [False] * len(without) + [True] * len(within)
                rows += [i] * (len(without) + len(within))
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(put, pa.bool_()), taken.column("word"), taken.column("n")],
                names=["key", "put", "word", "n"],
            )

    index = stored(words.select("word", "n").mapInArrow(indexed, "key bigint, put boolean, word string, n bigint"), "grams")
    a = index.select("key", F.col("put").alias("a_put"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = index.where("not put").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = a.join(b, "key").where("(a_put or a < b) and levenshtein(a, b, 1) = 1").select("a", "a_n", "b", "b_n").distinct()
    return pairs.select(
        F.inline(F.expr("array(struct(a AS word, a_n AS n, b AS near, b_n AS near_n), struct(b AS word, b_n AS n, a AS near, a_n AS near_n))"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: where following ``form`` ends, by doubling the steps; forms are at least twice as frequent."""
    up = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        over = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(up.join(over, "root", "left").select("word", "root", "next"), "steps")
        up = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next is not null").isEmpty():
            return up


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per word: its number, its near words, the one it is a variant of, and where that leads.

    Words are the runs of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z made small)
    of at least 5 code points that occur 3 times; one run in 97, by its
    checksum with the document's id, loses a code point first. Near words are
    one edit apart. The form is the most frequent near word, of equal ones the
    first, if it is at least twice as frequent as the word.

    A null text has no words; a null id is an empty one in the checksum; equal
    rows count each; words of any length are indexed in time proportional to
    their length; an empty table has no words. Other columns are not read.
    """
    words = stored(word_counts(docs, id_column, text_column), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.expr("CASE WHEN -best.less >= 2 * n THEN best.near END").alias("form"),
        F.expr("CASE WHEN -best.less >= 2 * n THEN -best.less END").alias("form_n"),
    )
    found = stored(found, "forms")
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
