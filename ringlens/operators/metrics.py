"""Evaluation of scored rows (label 0 or 1, score) as aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MEASURES = ["accuracy", "precision", "recall", "f1"]


@dataclass(frozen=True)
class Grid:
    """Thresholds ``start + i * step``, computed in doubles in exactly this form."""

    start: float = 0.01
    stop: float = 0.99
    step: float = 0.01

    @property
    def size(self) -> int:
        return math.ceil((self.stop + 1e-12 - self.start) / self.step)

    def value(self, index: Column) -> Column:
        return F.lit(self.start) + index.cast("double") * F.lit(self.step)

    def passed(self, score: Column) -> Column:
        """How many thresholds are at or below the score; a guess corrected by exact comparison."""
        last = self.size - 1
        guess = F.floor((score - F.lit(self.start)) / F.lit(self.step))
        near = F.greatest(F.lit(-1), F.least(guess, F.lit(last)))
        lower = F.greatest(near, F.lit(0))
        count = (
            F.when((near < last) & (self.value(near + 1) <= score), near + 2)
            .when((near >= 0) & (self.value(lower) <= score), near + 1)
            .otherwise(lower)
        )
        return count.cast("int")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def with_measures(df: DataFrame) -> DataFrame:
    """Adds accuracy, precision, recall and F1 to (tn, fp, fn, tp); 0 where a quotient is undefined."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    return df.withColumns(
        {
            "accuracy": _share(tn + tp, tn + fp + fn + tp),
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1": _share(2 * tp, 2 * tp + fp + fn),
        }
    )


def usable_rows(scored: DataFrame) -> DataFrame:
    """The rows every evaluation counts: label 0 or 1 and a score that is a number.

    All measures leave out the same rows; ``left_out`` says how many.
    """
    score = F.col("score")
    return scored.where(F.col("label").isin(0, 1) & score.isNotNull() & ~F.isnan(score.cast("double")))


def left_out(scored: DataFrame) -> DataFrame:
    """One row: number of rows, and how many of them no measure counts."""
    rows = F.count(F.lit(1))
    score = F.col("score")
    used = F.col("label").isin(0, 1) & score.isNotNull() & ~F.isnan(score.cast("double"))
    return scored.agg(rows.alias("rows"), (rows - F.count_if(used)).alias("left_out"))


def metrics_at(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts and measures, one row per threshold, in one pass."""
    positive = F.col("label") == 1

    def cells(threshold: float) -> Column:
        chosen = F.col("score") >= F.lit(float(threshold))
        counts = {"tn": ~positive & ~chosen, "fp": ~positive & chosen, "fn": positive & ~chosen, "tp": positive & chosen}
        return F.struct(
            F.lit(float(threshold)).alias("threshold"),
            *[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name) for name, c in counts.items()],
        )

    rows = usable_rows(scored).agg(F.array(*[cells(t) for t in thresholds]).alias("rows"))
    return with_measures(rows.select(F.inline("rows")))


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: weight of a positive row, never below 1, and 1 without positives."""
    positive = F.sum((F.col(label) == 1).cast("double"))
    negative = F.sum((F.col(label) == 0).cast("double"))
    return df.agg(
        F.when(positive > 0, F.greatest(negative / positive, F.lit(1.0)))
        .otherwise(F.lit(1.0))
        .alias("scale_pos_weight")
    )


def threshold_sweep(scored: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Measures at every threshold of the grid.

    Each row is counted once under the number of thresholds it passes; the
    sweep is a running sum over those counts, at most one row per threshold.
    """
    positive = F.col("label") == 1
    counts = usable_rows(scored).groupBy(grid.passed(F.col("score")).alias("passed")).agg(
        F.sum(positive.cast("bigint")).alias("pos"), F.sum((~positive).cast("bigint")).alias("neg")
    )
    steps = scored.sparkSession.range(0, grid.size + 1, 1, 1).select(F.col("id").cast("int").alias("passed"))
    full = steps.join(F.broadcast(counts), "passed", "left").fillna(0, ["pos", "neg"])
    every = W.partitionBy(F.lit(0))
    downward = every.orderBy(F.desc("passed"))
    table = full.select(
        "passed",
        F.sum("pos").over(downward).alias("tp"),
        F.sum("neg").over(downward).alias("fp"),
        F.sum("pos").over(every).alias("p"),
        F.sum("neg").over(every).alias("n"),
    ).where(F.col("passed") > 0)
    return with_measures(
        table.select(
            grid.value(F.col("passed") - 1).alias("threshold"),
            (F.col("n") - F.col("fp")).alias("tn"),
            "fp",
            (F.col("p") - F.col("tp")).alias("fn"),
            "tp",
        )
    )


def best_threshold(scored: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """The lowest threshold with the highest F1; 0.5 when only one class is present."""
    swept = threshold_sweep(scored, grid).withColumn("_rank", F.lit(0))
    halves = metrics_at(scored, [0.5]).withColumn("_rank", F.lit(1))
    both = swept.unionByName(halves)
    single = (F.col("tp") + F.col("fn") == 0) | (F.col("tn") + F.col("fp") == 0)
    usable = both.where((single & (F.col("_rank") == 1)) | (~single & (F.col("_rank") == 0)))
    return usable.orderBy(F.desc("f1"), "threshold").limit(1).drop("_rank")


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL for a single class.

    Equal scores are merged before anything is ordered. The distinct scores are
    range-partitioned, each range counts its own concordant pairs, and pairs
    between ranges follow from the totals per range.
    """
    positive = F.col("label") == 1
    scores = usable_rows(scored).groupBy("score").agg(
        F.sum(positive.cast("double")).alias("pos"), F.sum((~positive).cast("double")).alias("neg")
    )
    ranged = scores.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    above = W.partitionBy("part").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("pos").over(above), F.lit(0.0)) + F.col("pos") / 2
    parts = (
        ranged.select("part", "score", "pos", "neg", (F.col("neg") * inside).alias("pairs"))
        .groupBy("part")
        .agg(F.max("score").alias("top"), *[F.sum(name).alias(name) for name in ("pos", "neg", "pairs")])
    )
    higher = W.partitionBy(F.lit(0)).orderBy(F.desc("top")).rowsBetween(W.unboundedPreceding, -1)
    across = F.col("neg") * F.coalesce(F.sum("pos").over(higher), F.lit(0.0))
    return parts.select("pos", "neg", (F.col("pairs") + across).alias("pairs")).agg(
        F.when(
            (F.sum("pos") > 0) & (F.sum("neg") > 0), F.sum("pairs") / (F.sum("pos") * F.sum("neg"))
        ).alias("auc")
    )
