"""Checks of tables before they are used."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.functions.conversions import numeric_or_null


class SchemaError(ValueError):
    """A table lacks columns or rows it must have."""


@dataclass(frozen=True)
class TableRule:
    required: Sequence[str]
    min_rows: int = 1


def validate_schema(df: DataFrame, rule: TableRule, name: str) -> DataFrame:
    """One row (name, valid, missing, rows_seen); no more rows are counted than the rule asks for."""
    missing = [column for column in rule.required if column not in df.columns]
    seen = df.limit(max(rule.min_rows, 0)).agg(F.count(F.lit(1)).alias("rows_seen"))
    return seen.select(
        F.lit(name).alias("name"),
        (F.lit(not missing) & (F.col("rows_seen") >= rule.min_rows)).alias("valid"),
        F.lit(",".join(missing)).alias("missing"),
        "rows_seen",
    )


def require_schema(df: DataFrame, rule: TableRule, name: str) -> DataFrame:
    """The table itself, or an error that says what it lacks."""
    missing = [column for column in rule.required if column not in df.columns]
    if missing:
        raise SchemaError(f"{name}: missing columns {missing}, found {df.columns}")
    if rule.min_rows > 0:
        seen = len(df.select(F.lit(1)).take(rule.min_rows))
        if seen < rule.min_rows:
            raise SchemaError(f"{name}: {seen} rows, expected at least {rule.min_rows}")
    return df


def validate_training(
    df: DataFrame, label: str = "label", null_share: float = 0.5, minority_share: float = 0.05
) -> DataFrame:
    """One row (valid BOOLEAN, issues ARRAY<STRING>) from a single aggregation over all columns."""
    rows = F.col("_rows")
    checks = [F.when(F.lit(label not in df.columns), F.lit(f"Missing label column '{label}'"))]
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for index, field in enumerate(df.schema.fields):
        present = F.col(field.name).isNotNull()
        if field.dataType.typeName() in ("float", "double"):
            present = present & ~F.isnan(field.name)
        aggregates.append(F.sum((~present).cast("bigint")).alias(f"_nulls{index}"))
        too_many = (rows > 0) & (F.col(f"_nulls{index}") > rows * F.lit(null_share))
        checks.append(F.when(too_many, F.lit(f"Column '{field.name}' has >50% nulls")))
    if label in df.columns:
        value = numeric_or_null(F.col(label), df.schema[label].dataType)
        positive = F.sum((value == 1).cast("bigint"))
        labelled = F.count(value)
        aggregates += [positive.alias("_positive"), labelled.alias("_labelled")]
        smaller = F.least(F.col("_positive"), F.col("_labelled") - F.col("_positive"))
        checks.append(
            F.when(
                (F.col("_labelled") > 0) & (smaller < F.col("_labelled") * F.lit(minority_share)),
                F.lit("Severe class imbalance"),
            )
        )
    return (
        df.agg(*aggregates)
        .select(F.array_compact(F.array(*checks)).alias("issues"))
        .select((F.size("issues") == 0).alias("valid"), "issues")
    )
