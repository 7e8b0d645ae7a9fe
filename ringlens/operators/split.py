"""Stratified split into training, validation and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.config import SplitConfig

PREFIX = 4  # hex digits: 65,536 buckets per class


def stratified_split(
    df: DataFrame, key: str, label: str = "label", config: SplitConfig = SplitConfig()
) -> DataFrame:
    """Adds ``role``: of each class, the first rows by hash of the key are test, the next validation.

    With n rows in a class, ceil(share * n) are test and ceil(share * rest) are
    validation; rows of one key always share a role. Instead of ranking rows,
    the split looks for the hash at which each share ends: bucket counts find
    the bucket, the hashes of that bucket find the value. Rows are then only
    compared with two values per class, without a shuffle.

    A row without a key is hashed by its other columns (as text, in order),
    so such rows are spread like others and equal ones share a role.
    """
    return with_roles(df, row_digest(df, key, label, config), label, config)


def row_digest(df: DataFrame, key: str | None, label: str, config: SplitConfig = SplitConfig()) -> Column:
    """Hash that decides the role of a row: of its key, or of all columns but the label where there is none."""
    others = [F.col(f"`{name}`").cast("string") for name in df.columns if name not in (key, label)]
    content = F.concat(F.lit("row:"), F.to_json(F.array(*others))) if others else F.lit("row:")
    known = content if key is None else F.coalesce(F.col(f"`{key}`").cast("string"), content)
    return F.md5(F.concat(known, F.lit(f":{config.seed}")))


def with_roles(df: DataFrame, digest: Column, label: str, config: SplitConfig = SplitConfig()) -> DataFrame:
    hashed = df.select(F.col(label).alias("_class"), digest.alias("_hash"))
    by_class = W.partitionBy("_class")
    counts = hashed.groupBy("_class", F.substring("_hash", 1, PREFIX).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    placed = counts.select(
        "_class",
        "_bucket",
        "_rows",
        (F.sum("_rows").over(by_class.orderBy("_bucket")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(by_class).alias("_total"),
    )
    tested = F.ceil(F.col("_total") * F.lit(config.test_share))
    checked = tested + F.ceil((F.col("_total") - tested) * F.lit(config.validation_share))
    ends = placed.select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit("test").alias("_end"), tested.alias("_cut")),
                F.struct(F.lit("validation").alias("_end"), checked.alias("_cut")),
            )
        ),
    ).where((F.col("_before") < F.col("_cut")) & (F.col("_cut") <= F.col("_before") + F.col("_rows")))
    edge = F.broadcast(ends.select("_class", "_bucket", "_end", (F.col("_cut") - F.col("_before")).alias("_take")))
    inside = (
        hashed.withColumn("_bucket", F.substring("_hash", 1, PREFIX))
        .join(edge, ["_class", "_bucket"])
        .groupBy("_class", "_end", "_take", "_hash")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    running = W.partitionBy("_class", "_end").orderBy("_hash")
    cuts = (
        inside.withColumn("_before", F.sum("_rows").over(running) - F.col("_rows"))
        .where(F.col("_before") < F.col("_take"))
        .groupBy("_class")
        .agg(
            F.max(F.when(F.col("_end") == "test", F.col("_hash"))).alias("_test"),
            F.max(F.when(F.col("_end") == "validation", F.col("_hash"))).alias("_validation"),
        )
    )
    role = (
        F.when(digest <= F.col("_test"), F.lit("test"))
        .when(digest <= F.col("_validation"), F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    return (
        df.join(F.broadcast(cuts), F.col(label) == F.col("_class"), "left")
        .withColumn("role", role)
        .drop("_class", "_test", "_validation")
    )
