"""From features per report to a scoring pool per phone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.config import FeatureConfig
from ringlens.functions.conversions import numeric_or_null
from ringlens.operators.features import heavy_reports, report_features
from ringlens.operators.skew import HeavyKeys, join_unique

IDENTITY_COLUMNS = ("report", "phone", "Spam", "label", "Score")


def numeric_columns(df: DataFrame, excluded: Sequence[str] = IDENTITY_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in excluded and isinstance(f.dataType, T.NumericType)]


def report_phone_map(calls: DataFrame) -> DataFrame:
    """Distinct pairs of a report and a raw phone it was made for."""
    return (
        calls.select(F.col("report").cast("string").alias("report"), F.col("phone").cast("string").alias("phone"))
        .where(F.col("report").isNotNull() & F.col("phone").isNotNull())
        .distinct()
    )


def phone_features(features: DataFrame, calls: DataFrame, heavy: HeavyKeys, ordered: bool = True) -> DataFrame:
    """Every numeric feature summed over the reports of a phone (rates included, by definition).

    ``heavy`` lists the reports with very many calls, which bounds the phones
    a single report can have in the join.
    """
    columns = numeric_columns(features)
    if not columns:
        raise ValueError("no numeric feature columns to sum")
    pairs = join_unique(report_phone_map(calls), features.select("report", *columns), "report", heavy)
    summed = pairs.groupBy("phone").agg(*[F.sum(F.coalesce(F.col(name), F.lit(0))).alias(name) for name in columns])
    return summed.orderBy("phone") if ordered else summed


def phone_pool(
    calls: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig(), ordered: bool = True
) -> DataFrame:
    """Call history to one row of summed features per phone."""
    heavy = heavy_reports(calls, config)
    return phone_features(report_features(calls, providers, config, heavy), calls, heavy, ordered)


def align_features(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns, in training order, after the keys; absent ones are 0."""
    present = set(df.columns)
    return df.select(
        *keys, *[F.col(name) if name in present else F.lit(0).alias(name) for name in columns]
    )


def coerce_numeric(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All columns but the keys as DOUBLE; what is not a number is missing."""
    return df.select(
        *keys,
        *[
            numeric_or_null(F.col(f.name), f.dataType).alias(f.name)
            for f in df.schema.fields
            if f.name not in keys
        ],
    )


def predictions(scored: DataFrame, key: str, threshold: float) -> DataFrame:
    """(key, Spam, Score) with the class decided at the threshold."""
    return scored.select(
        F.col(key).cast("string").alias(key),
        (F.col("Score") >= F.lit(float(threshold))).cast("int").alias("Spam"),
        "Score",
    )
