"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of lower-case text: how often each
byte followed each context of up to ``ORDER`` bytes in the language's sample. A
byte's probability blends the orders by escape probabilities: in a context seen
n times with d different followers, a follower seen c times has c / (n + d),
and the share d / (n + d) escapes to the shorter context, where it is spread
over the bytes that did not follow here. So the probabilities of every context
sum to one, and the code length of a text is exact. Counts are frozen after
training, which turns the trees into one table of code lengths per context and
byte. The language with the shortest code is the answer.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringlens.session import stored

ORDER = 3
#: Learning takes at most so many documents of a language, those with the smallest hash,
SAMPLE_DOCS = 250
#: and keeps contexts of full length that occurred at least so often.
LEAST_COUNT = 2
UNDETERMINED = "und"
#: Texts are coded in blocks of so many bytes, which bounds the memory of a long one.
CHUNK = 1 << 20


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def context_counts(text: bytes, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes and numbers of all (context, byte) of each order, with the order in the top byte."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    codes = []
    for k in range(order + 1):
        if len(data) > k:
            code = np.full(len(data) - k, k << 56, np.int64)
            for i in range(k + 1):
                code |= data[i : len(data) - k + i] << (8 * (k - i))
            codes.append(code)
    return np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64),) * 2


@dataclass
class Trees:
    """Code lengths in bits of every symbol after every context seen in any language.

    ``symbols`` maps a byte to its symbol (0 for all bytes never seen),
    ``nodes`` the code of the last ``ORDER`` symbols to its longest known
    context, ``bits`` has a row per node, symbol and language.
    """

    languages: list[str]
    symbols: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    order: int

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits per language for the whole text, a block at a time."""
        total = np.zeros(len(self.languages))
        size = int(self.symbols.max()) + 1
        carried = np.zeros(self.order, np.int64)
        for start in range(0, len(text), CHUNK):
            seen = self.symbols[np.frombuffer(text[start : start + CHUNK], np.uint8)]
            line = np.concatenate([carried, seen])
            context = np.zeros(len(seen), np.int64)
            for i in range(self.order):
                context = context * size + line[i : i + len(seen)]
            total += self.bits[self.nodes[context] * size + seen].sum(axis=0, dtype=np.float64)
            carried = line[-self.order :]
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its posterior under equal priors; nothing to go by gives ``und`` and 0."""
        if not self.languages or not text or not has_letter(text):
            return UNDETERMINED, 0.0
        bits = self.code_lengths(folded(text))
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def build_trees(counts: dict[str, dict[int, int]], order: int = ORDER) -> Trees:
    """Trees of (order, context, byte) codes with their counts per language."""
    languages = sorted(counts)
    seen = sorted({code & 0xFF for table in counts.values() for code in table})
    size = len(seen) + 1
    symbols = np.zeros(256, np.int64)
    symbols[seen] = np.arange(1, size)

    # followers[language][context as a tuple of symbols] = counts per symbol
    followers: list[dict[tuple[int, ...], np.ndarray]] = []
    for language in languages:
        table: dict[tuple[int, ...], np.ndarray] = {}
        for code, n in counts[language].items():
            k = code >> 56
            path = tuple(int(symbols[code >> (8 * (k - i)) & 0xFF]) for i in range(k + 1))
            table.setdefault(path[:-1], np.zeros(size))[path[-1]] += n
        followers.append(table)
    contexts = sorted({c for table in followers for c in table} | {()}, key=lambda c: (len(c), c))
    number = {context: i for i, context in enumerate(contexts)}

    probability = np.empty((len(contexts), size, max(1, len(languages))), np.float64)
    for context, i in number.items():
        for j, table in enumerate(followers):
            shorter = np.full(size, 1 / size)
            if context:
                # A context's tail is a context of its own unless rare ones were left out.
                tail = context[1:]
                while tail not in number:
                    tail = tail[1:]
                shorter = probability[number[tail], :, j]
            probability[i, :, j] = blended(table.get(context), shorter)

    nodes = np.zeros(size**order, np.int32)
    for length in range(order + 1):
        span = size ** (order - length)
        for context in (c for c in contexts if len(c) == length):
            at = 0
            for symbol in context:
                at = at * size + symbol
            # Codes end with the latest symbols, so a context covers every code with its tail.
            nodes.reshape(span, -1)[:, at] = number[context]
    bits = -np.log2(probability).astype(np.float32)
    return Trees(languages, symbols, nodes, bits.reshape(-1, max(1, len(languages))), order)


def blended(counts: np.ndarray | None, shorter: np.ndarray) -> np.ndarray:
    """Probabilities after one context from its counts and the probabilities of the shorter context."""
    if counts is None or not counts.any():
        return shorter
    followed = counts > 0
    total, kinds = counts.sum(), followed.sum()
    rest = np.where(followed, 0, shorter)
    if not rest.sum():
        return counts / total
    return counts / (total + kinds) + rest / rest.sum() * (kinds / (total + kinds))


def training_sample(docs: DataFrame, id_column: str, text_column: str, label_column: str, sample_docs: int) -> DataFrame:
    """At most ``sample_docs`` labelled documents per language, those with the smallest hash of id and text.

    Hashes alone are ranked, so texts are neither sorted nor shuffled; equal
    documents count once.
    """
    labelled = docs.select(
        F.col(f"`{label_column}`").alias("label"),
        F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).alias("hash"),
        F.col(f"`{text_column}`").alias("text"),
    ).where("label is not null and text is not null and text <> ''")
    ranked = labelled.select(
        "label", "hash", F.row_number().over(Window.partitionBy("label").orderBy("hash")).alias("n")
    )
    # One row per language, as the trees have, so small enough for every task.
    limits = ranked.where(F.col("n") <= sample_docs).groupBy("label").agg(F.max("hash").alias("limit"))
    return (
        labelled.join(F.broadcast(limits), "label")
        .where("hash <= limit")
        .groupBy("label", "hash")
        .agg(F.min("text").alias("text"))
        .select("label", "text")
    )


def train(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    order: int = ORDER,
) -> Trees:
    """Trees of each label from a bounded sample of its documents, whole texts.

    Counting is done where the documents are; only sums per label, context and
    byte reach the driver, whose number the sample bounds.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                codes, numbers = context_counts(folded(text), order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(codes), pa.string()), pa.array(codes), pa.array(numbers.astype(np.int64))],
                    ["label", "code", "n"],
                )

    sample = stored(training_sample(docs, id_column, text_column, label_column, sample_docs), "language-sample")
    sums = (
        sample.mapInArrow(counted, "label string, code bigint, n bigint")
        .groupBy("label", "code")
        .agg(F.sum("n").alias("n"))
        .where((F.shiftright("code", 56) < order) | (F.col("n") >= LEAST_COUNT))
    )
    counts: dict[str, dict[int, int]] = {}
    table = sums.toArrow()
    for label, code, n in zip(*(table.column(c).to_pylist() for c in ("label", "code", "n")), strict=True):
        counts.setdefault(label, {})[code] = n
    return build_trees(counts, order)


def identify(docs: DataFrame, trees: Trees, text_column: str = "text") -> DataFrame:
    """Adds a column ``predicted`` with fields ``lang`` and ``score`` to the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(trees, protocol=5))

    @F.arrow_udf("struct<lang: string, score: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model: Trees = pickle.loads(shared.value)
        for texts in batches:
            found = [model.predict(text) for text in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"],
            )

    return docs.withColumn("predicted", predicted(F.col(f"`{text_column}`")))


def held_out(id_column: str = "doc_id"):
    """Documents no model may learn from: crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_ids(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred`` and ``score``.

    * Learns from documents that are not held out and have a label; the label,
      the id and other columns play no part in a prediction.
    * A null, empty or letterless text is ``und`` with score 0, and so is
      every text if there is nothing to learn from. Ties go to the language
      first in order.
    * Repeated rows and null ids give rows like others.
    """
    trees = train(docs.where(~held_out(id_column)), id_column, text_column, label_column)
    plain = docs.select(F.col(f"`{id_column}`").alias("id"), held_out(id_column).alias("held_out"), F.col(f"`{text_column}`").alias("text"))
    return identify(plain, trees, "text").select(
        F.col("id").alias(id_column),
        "held_out",
        F.col("predicted.lang").alias("lang_pred"),
        F.col("predicted.score").alias("score"),
    )


def keep_identified(docs: DataFrame, trees: Trees, text_column: str = "text", least_score: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose language is determined with at least ``least_score``."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    marked = identify(docs.select(row, F.col(f"`{text_column}`").alias("text")), trees, "text")
    return marked.where((F.col("predicted.lang") != UNDETERMINED) & (F.col("predicted.score") >= least_score)).select("row.*")
