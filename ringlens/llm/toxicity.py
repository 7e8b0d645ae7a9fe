"""Severity of toxic language by cumulative-link ordinal regression on words.

Grades are ordered. One weight per word is shared by all thresholds, and
P(grade >= k) = logistic(score - threshold_k), so a word that makes a text more
likely to be toxic at all also makes it more likely to be severe.

Learning takes a bounded sample of labelled rows. Words enter the model only if
their link to the labels passes a likelihood-ratio test corrected for the
number of words tested, and copies of one text count once, so that neither
label noise nor a family of copies makes ordinary words look toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.words import shingle_hashes
from ringlens.session import stored

#: Learning takes at most so many labelled documents, those with the smallest hash of their id,
SAMPLE_DOCS = 20_000
#: and at most so many words, those with the clearest link to the labels,
MAX_WORDS = 2_048
#: which occur in so many different labelled texts at least.
LEAST_DOCS = 3
PENALTY = 0.02
STEPS = 400
SHINGLE = 5
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """Weights per word and ordered thresholds; ``grades`` are the values of the classes in order.

    Scores from ``cut`` on count as above the lowest grade.
    """

    weights: dict[str, float]
    thresholds: np.ndarray
    grades: np.ndarray
    cut: float = np.inf

    def reached(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each score and each grade but the lowest."""
        return logistic(scores[:, None] - self.thresholds[None, :])

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected severity, most likely grade and whether above the lowest grade, of each text."""
        scores = np.array([sum(map(self.weights.__getitem__, self.weights.keys() & words_of(t))) for t in texts], float)
        reached = self.reached(scores)
        steps = np.concatenate([np.ones((len(texts), 1)), reached, np.zeros((len(texts), 1))], axis=1)
        shares = steps[:, :-1] - steps[:, 1:]
        return shares @ self.grades, self.grades[shares.argmax(axis=1)], scores >= self.cut


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, classes: np.ndarray, width: int, penalty: float = PENALTY, steps: int = STEPS):
    """Weights and thresholds of classes 0..K that maximise the penalised likelihood.

    ``rows`` and ``columns`` name the ones of a sparse 0/1 matrix. Thresholds
    are the first and the logarithms of the gaps, which keeps them in order.
    """
    n, top = len(classes), int(classes.max())
    shares = np.array([(classes >= k).mean() for k in range(1, top + 1)])
    starts = -np.log(shares / np.maximum(1 - shares, 1e-9))
    gaps = np.log(np.maximum(np.diff(starts), 1e-3))
    parameters = np.concatenate([np.zeros(width), starts[:1], gaps])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    every = np.arange(n)
    for step in range(1, steps + 1):
        weights, gaps = parameters[:width], np.exp(parameters[width + 1 :])
        thresholds = parameters[width] + np.concatenate([[0], np.cumsum(gaps)])
        scores = np.bincount(rows, weights[columns], n) if len(rows) else np.zeros(n)
        reached = logistic(scores[:, None] - thresholds[None, :])
        padded = np.concatenate([np.ones((n, 1)), reached, np.zeros((n, 1))], axis=1)
        slopes = padded * (1 - padded)
        chance = np.maximum(padded[every, classes] - padded[every, classes + 1], 1e-12)
        by_score = -(slopes[every, classes] - slopes[every, classes + 1]) / chance
        by_threshold = np.array(
            [
                (slopes[:, k] / chance * ((classes == k).astype(float) - (classes == k - 1))).sum()
                for k in range(1, top + 1)
            ]
        )
        by_weight = (np.bincount(columns, by_score[rows], width) if len(rows) else np.zeros(width)) + penalty * weights
        tails = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([by_weight, [by_threshold.sum()], tails[1:] * gaps]) / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.2 * (1 - step / (steps + 1))
        parameters = parameters - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    thresholds = parameters[width] + np.concatenate([[0], np.cumsum(np.exp(parameters[width + 1 :]))])
    return parameters[:width], thresholds


def best_cut(scores: np.ndarray, hits: np.ndarray) -> float:
    """The score that parts the labelled rows with the highest F1, midway between the scores beside it.

    Where texts with positive scores alone are above it, a text without any
    known word, whose score is 0, is below it.
    """
    order = np.argsort(-scores, kind="stable")
    ranked, found = scores[order], np.cumsum(hits[order])
    ends = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True))
    f1 = 2 * found[ends] / (ends + 1 + hits.sum())
    end = ends[int(f1.argmax())]
    if end + 1 == len(ranked):
        return -np.inf
    above, below = float(ranked[end]), float(ranked[end + 1])
    return (above + (max(below, 0.0) if above > 0 else below)) / 2


def severity_grade(toxic: str = "toxic", quality: str = "quality") -> Column:
    """0 for a text that is not toxic, 1 for a toxic one, 2 for one that is also of low quality; null stays null."""
    return F.when(F.col(toxic) == 0, 0).when((F.col(toxic) == 1) & (F.col(quality) == 0), 2).when(F.col(toxic) == 1, 1)


def labelled_words(docs: DataFrame, grades: DataFrame, id_column: str, text_column: str, sample_docs: int) -> DataFrame:
    """``grade`` and ``words`` of the sampled labelled documents, one row per family of copies."""
    highest = grades.where("id is not null and grade is not null").groupBy("id").agg(F.max("grade").alias("grade"))
    hashed = F.xxhash64("id")
    # The parameter bounds these rows, so they may be sent to every task.
    sampled = F.broadcast(highest.orderBy(hashed, "id").limit(sample_docs))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            family, words = [], []
            for text in batch.column("text").to_pylist():
                least = [int(h.min()) for h in shingle_hashes((text or "").encode("utf-8", "replace"), SHINGLE)]
                family.append(min(least, default=0) - (1 << 63))
                words.append(sorted(words_of(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array(family, pa.int64()), pa.array(words, pa.list_(pa.string()))],
                ["grade", "family", "words"],
            )

    found = texts.join(sampled, "id").select("text", F.col("grade").cast("int").alias("grade"))
    return (
        found.mapInArrow(read, "grade int, family bigint, words array<string>")
        .groupBy("family")
        .agg(F.max(F.struct("grade", "words")).alias("kept"))
        .select("kept.*")
    )


def linked_words(labelled: DataFrame, least_docs: int, max_words: int) -> list[str]:
    """Words whose link to grades above the lowest passes a corrected likelihood-ratio test, clearest first."""
    totals = labelled.agg(F.count("*").alias("n"), F.sum((F.col("grade") > 0).cast("long")).alias("hits"))
    counted = (
        labelled.select((F.col("grade") > 0).cast("long").alias("hit"), F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("df"), F.sum("hit").alias("a"))
        .where(F.col("df") >= least_docs)
    )
    counted = stored(counted, "words")
    n, hits = totals.first()
    tested = counted.count()
    if not tested or not hits or hits == n:
        return []
    rate = hits / n

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), F.col("df") * rate) + part(F.col("df") - F.col("a"), F.col("df") * (1 - rate)))
    best = (
        counted.withColumn("ratio", ratio)
        .where(F.col("ratio") >= 2 * float(np.log(max(tested, 2))))
        .orderBy(F.desc("ratio"), "word")
        .limit(max_words)
    )
    return [row.word for row in best.collect()]


def train(
    docs: DataFrame,
    grades: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    max_words: int = MAX_WORDS,
) -> OrdinalModel:
    """A model of ``grades`` (columns ``id`` and ``grade``, whole numbers from 0 up).

    Null grades and ids are left out, of several grades of one id the highest
    counts. Without two different grades the model rates every text alike.
    """
    labelled = stored(labelled_words(docs, grades, id_column, text_column, sample_docs), "labelled")
    words = linked_words(labelled, LEAST_DOCS, max_words)
    known = F.array(*[F.lit(word) for word in words]) if words else F.array().cast("array<string>")
    sample = labelled.select("grade", F.array_intersect("words", known).alias("words")).toArrow()
    values = np.array(sample.column("grade").to_pylist(), int)
    grades_seen = np.unique(values)
    if len(grades_seen) < 2:
        return OrdinalModel({}, np.zeros(0), grades_seen.astype(float) if len(grades_seen) else np.zeros(1))
    place = {word: i for i, word in enumerate(words)}
    lists = sample.column("words").to_pylist()
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    columns = np.array([place[word] for x in lists for word in x], int)
    weights, thresholds = fit_ordinal(rows, columns, np.searchsorted(grades_seen, values), len(words))
    scores = np.bincount(rows, weights[columns], len(values)) if len(rows) else np.zeros(len(values))
    cut = best_cut(scores, values > grades_seen[0]) if len(rows) else np.inf
    return OrdinalModel(dict(zip(words, weights.tolist(), strict=True)), thresholds, grades_seen.astype(float), cut)


def rate(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """Adds a column ``rated`` with ``severity``, ``grade`` and whether the text is ``toxic``."""

    @F.arrow_udf("struct<severity: double, grade: int, toxic: boolean>")
    def rated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            severity, grade, above = model.predict(texts.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(severity), pa.array(grade.astype(np.int32)), pa.array(above)], ["severity", "grade", "toxic"]
            )

    return docs.withColumn("rated", rated(F.col(f"`{text_column}`")))


def toxicity(docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, expected ``severity``, most likely ``grade`` and ``toxic``.

    A document is toxic from the score on that parts the labelled sample best.
    Null and empty texts have no words and get the base rate. Repeated rows
    and null ids give rows like others; other columns are not read.
    """
    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return rate(plain, model, "text").select(
        F.col("id").alias(id_column), "rated.severity", "rated.grade", "rated.toxic"
    )


def keep_harmless(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """The documents, with all their columns, that are not toxic."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    marked = rate(docs.select(row, F.col(f"`{text_column}`").alias("text")), model, "text")
    return marked.where(~F.col("rated.toxic")).select("row.*")
