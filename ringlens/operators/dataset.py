"""Corrected labels and the merged training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.functions.conversions import numeric_or_null
from ringlens.functions.phones import join_key
from ringlens.operators.skew import HEAVY_ROWS, HeavyKeys, find_heavy, join_unique


def first_per_key(df: DataFrame, key: str, *order) -> DataFrame:
    """One row per key, the first in the given order.

    Spark limits every map task to its first row per key before the shuffle,
    so a key that owns many rows sends only one from each task.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def new_labels(labels: DataFrame, phone: str = "phone", label: str = "label") -> DataFrame:
    """(_phone_key, new_label) of definite labels.

    Phones that only collide on the key are settled by the number of reports,
    where the labels carry it, then by phone.
    """
    value = numeric_or_null(F.col(label), labels.schema[label].dataType)
    reports = F.lit(0.0)
    if "total_reports" in labels.columns:
        reports = numeric_or_null(F.col("total_reports"), labels.schema["total_reports"].dataType)
    rows = labels.where(value.isin(0.0, 1.0)).select(
        join_key(F.col(phone)).alias("_phone_key"),
        value.cast("int").alias("new_label"),
        reports.alias("_reports"),
        F.col(phone).alias("_phone"),
    )
    winners = first_per_key(rows, "_phone_key", F.desc("_reports"), F.desc("_phone"), F.desc("new_label"))
    return winners.select("_phone_key", "new_label")


def changed_labels(
    labels: DataFrame,
    pool: DataFrame,
    phone: str = "phone",
    label: str = "label",
    heavy_rows: int = HEAVY_ROWS,
    unique_phones: bool = False,
) -> DataFrame:
    """Rows of the pool whose label is missing or contradicted, with the new label in second place.

    ``unique_phones`` says that the pool has one row per phone, as a scoring
    pool has: its keys need no search for heavy ones.
    """
    old = numeric_or_null(F.col(label), pool.schema[label].dataType) if label in pool.columns else F.lit(None)
    keyed = pool.withColumns({"_phone_key": join_key(F.col(phone)), "_old": old.cast("double")})
    heavy = HeavyKeys(None) if unique_phones else find_heavy(keyed, "_phone_key", heavy_rows)
    matched = join_unique(keyed, new_labels(labels, phone, label), "_phone_key", heavy)
    rest = [name for name in pool.columns if name != label]
    return matched.where(~F.col("_old").eqNullSafe(F.col("new_label").cast("double"))).select(
        rest[0], F.col("new_label").alias(label), *rest[1:]
    )


def same_types(df: DataFrame, other: DataFrame, phone: str, label: str = "label") -> DataFrame:
    """Columns as a training set needs them where both sides disagree: a CSV holds nothing but text.

    The label is a whole number and the phone is text on either side; other
    shared columns of different types become DOUBLE.
    """
    theirs = {field.name: field.dataType for field in other.schema.fields}
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name == phone:
            column = column.cast("string")
        elif field.name == label:
            column = numeric_or_null(column, field.dataType).cast("int")
        elif theirs.get(field.name, field.dataType) != field.dataType:
            column = numeric_or_null(column, field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def merge_training(changed: DataFrame, base: DataFrame | None, phone: str = "phone") -> DataFrame:
    """Corrected rows over base rows, one per phone key; columns missing on a side are NULL.

    With a single non-empty side that side is returned as it is. Without a
    phone column on both sides, equal rows are merged instead. Among several
    rows of one key and source the smallest (phone, label) is kept, then the
    one with the smallest hash of the whole row.

    Asks both inputs whether they are empty: pass tables that are already
    written rather than long lineages.
    """
    no_base = base is None or base.isEmpty()
    if changed.isEmpty():
        if no_base:
            raise ValueError("both the base training set and the changed rows are empty")
        return base
    if no_base:
        return changed
    changed, base = same_types(changed, base, phone), same_types(base, changed, phone)
    if phone not in changed.columns or phone not in base.columns:
        return changed.unionByName(base, allowMissingColumns=True).dropDuplicates()
    both = changed.withColumn("_source", F.lit(0)).unionByName(
        base.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    both = both.withColumn("_phone_key", join_key(F.col(phone)))
    whole = [F.col(f"`{name}`") for name in both.columns]
    ties = [phone] + [name for name in both.columns if name == "label"]
    kept = first_per_key(both, "_phone_key", "_source", *ties, F.xxhash64(*whole))
    return kept.drop("_source", "_phone_key")
