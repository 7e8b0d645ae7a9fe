"""Run manifests, model bundles, thresholds and the model registry as tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from itertools import count
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.functions.conversions import numeric_or_null
from ringlens.operators.model import TrainedModel
from ringlens.operators.promotion import promotion_gate
from ringlens.session import literal_table
from ringlens.sources.tables import load_if_exists
from ringlens.sources.versions import claim, numbers

MANIFEST = [
    ("run_id", "string"), ("command", "string"), ("status", "string"), ("timestamp", "string"),
    ("result", "string"), ("error_type", "string"), ("error_message", "string"),
]
REGISTRY = [
    ("number", "bigint"), ("version", "string"), ("path", "string"), ("status", "string"), ("reason", "string"),
    ("auc_val", "double"), ("f1_best", "double"), ("recorded_at", "string"),
]


def manifest_row(
    spark: SparkSession,
    run_id: str,
    command: str,
    status: str = "success",
    result: Mapping[str, Any] | None = None,
    error: Exception | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """One record of a run; results are kept as JSON text."""
    row = (
        run_id,
        command,
        status,
        timestamp or datetime.now(timezone.utc).isoformat(),
        None if result is None else json.dumps(result, ensure_ascii=False, sort_keys=True, default=str),
        None if error is None else type(error).__name__,
        None if error is None else str(error),
    )
    return literal_table(spark, MANIFEST, [row])


def append_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{n} {k}" for n, k in MANIFEST)).json(path)


def threshold_row(metrics: DataFrame, default: float = 0.5) -> DataFrame:
    """One row with ``threshold_best``, also if nested, or the default where it is not a number."""
    if "threshold_best" not in metrics.columns:
        value = F.lit(None).cast("double")
    else:
        column, kind = F.col("threshold_best"), metrics.schema["threshold_best"].dataType
        if isinstance(kind, T.StructType):
            known = {f.name: f.dataType for f in kind.fields}
            value = (
                numeric_or_null(column["threshold"], known["threshold"])
                if "threshold" in known
                else F.lit(None).cast("double")
            )
        else:
            value = numeric_or_null(column, kind)
    return metrics.agg(F.coalesce(F.max(value), F.lit(float(default))).alias("threshold"))


def load_threshold(spark: SparkSession, metrics_path: str, default: float = 0.5) -> float:
    metrics = load_if_exists(spark, metrics_path, "parquet")
    return float(default) if metrics is None else float(threshold_row(metrics, default).first()["threshold"])


def save_bundle(trained: TrainedModel, metrics: DataFrame, path: str) -> None:
    """Model, its input columns and its metrics side by side under one path."""
    spark = metrics.sparkSession
    trained.model.save(f"{path}/model")
    rows = [(i, name) for i, name in enumerate(trained.columns)]
    literal_table(spark, [("position", "int"), ("name", "string")], rows).coalesce(1).write.parquet(f"{path}/columns")
    metrics.coalesce(1).write.parquet(f"{path}/metrics")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], DataFrame]:
    columns = spark.read.parquet(f"{path}/columns").orderBy("position").collect()
    model = PipelineModel.load(f"{path}/model")
    return model, [row["name"] for row in columns], spark.read.parquet(f"{path}/metrics")


def registry_table(spark: SparkSession, registry: str) -> DataFrame | None:
    """All outcomes in the order of their numbers' claims, as a table; None where there are none."""
    if not numbers(spark, registry):
        return None
    return spark.read.schema(", ".join(f"{name} {kind}" for name, kind in REGISTRY)).json(registry)


def production_model(spark: SparkSession, registry: str, until: int | None = None) -> dict[str, Any] | None:
    """The latest promoted version, of the first ``until`` outcomes if given; older ones remain as the archive."""
    table = registry_table(spark, registry)
    if table is None:
        return None
    known = table.where("status = 'production'")
    if until is not None:
        known = known.where(F.col("number") <= until)
    row = known.orderBy(F.desc("number")).first()
    return None if row is None else row.asDict()


def promote(
    spark: SparkSession, registry: str, version: str, bundle_path: str, metrics: DataFrame, min_delta: float = 1e-6,
    before_claim: Callable[[int], None] | None = None,
) -> DataFrame:
    """Compares a candidate bundle with the production one and puts the outcome into the registry.

    An outcome takes the number after those it has seen. Where another trainer
    has taken that number meanwhile, the comparison is made again with what it
    has put there, so every promotion is an improvement over the one before.
    ``before_claim`` is called with the number of the attempt, for a last look.
    """
    for attempt in count(1):
        seen = ([0] + numbers(spark, registry))[-1]
        current = production_model(spark, registry, seen)
        known = current or {}
        pair = metrics.select(
            F.col("auc_val").alias("new_auc"),
            F.col("`f1@best`").alias("new_f1"),
            F.lit(current is not None).alias("has_old"),
            F.lit(known.get("auc_val")).cast("double").alias("old_auc"),
            F.lit(known.get("f1_best")).cast("double").alias("old_f1"),
        )
        outcome = promotion_gate(pair, min_delta).select(
            F.lit(seen + 1).cast("bigint").alias("number"),
            F.lit(version).alias("version"),
            F.lit(bundle_path).alias("path"),
            F.when(F.col("promoted"), F.lit("production")).otherwise(F.lit("rejected")).alias("status"),
            "reason",
            F.col("new_auc").cast("double").alias("auc_val"),
            F.col("new_f1").cast("double").alias("f1_best"),
            F.lit(datetime.now(timezone.utc).isoformat()).alias("recorded_at"),
        )
        line = outcome.select(F.to_json(F.struct(*outcome.columns))).first()[0]
        if before_claim is not None:
            before_claim(attempt)
        if claim(spark, registry, seen + 1, line + "\n"):
            return registry_table(spark, registry).where(F.col("number") == seen + 1)
