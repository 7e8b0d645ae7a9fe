"""The jobs: inference, labelling, dataset, training, all of them, and scoring one file.

Every job writes its tables under a workspace folder and returns what a caller
needs to go on. Steps hand over written tables, not long lineages. A table of
the workspace is replaced at once, when its new version is complete; what a job
returns is the version that it has written, which stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens import constants
from ringlens.config import FeatureConfig, LabelRules, SearchSpace, SplitConfig, TreeParams
from ringlens.functions.timing import DayWindow
from ringlens.operators.dataset import changed_labels, merge_training
from ringlens.operators.features import report_features
from ringlens.operators.feedback import clean_reports, report_summary
from ringlens.operators.labels import label_feedback
from ringlens.operators.model import fit, model_report, score, training_set, tune
from ringlens.operators.quality import validate_training
from ringlens.operators.rollup import phone_pool, predictions
from ringlens.session import own_intermediates, stored
from ringlens.sources import artifacts
from ringlens.sources.history import export_calls, export_reports
from ringlens.sources.providers import provider_dimension
from ringlens.sources.tables import load_if_exists, load_table, save_table
from ringlens.sources.versions import replace_table


@dataclass(frozen=True)
class JobConfig:
    """Where a job works and with which settings; ``as_of`` None means today."""

    workspace: str
    as_of: date | None = None
    zone: str = "Asia/Ho_Chi_Minh"
    history_days: int = 90
    report_days: int = 100
    providers: Mapping[str, Sequence[str]] | DataFrame = field(default_factory=lambda: dict(constants.PROVIDERS))
    features: FeatureConfig = FeatureConfig(work_days=constants.SHIPPED_WORK_DAYS)
    labels: LabelRules = LabelRules()
    split: SplitConfig = SplitConfig()
    trials: int = 5
    trial_seconds: float | None = 1800.0
    space: SearchSpace = SearchSpace()
    search: str | None = None  # name of a search over one training set, which a rerun goes on with
    base_path: str | None = None  # any supported format; None is a Parquet table in the workspace
    min_delta: float = 1e-6
    shuffle_partitions: int | None = None  # None keeps the session's setting

    def path(self, name: str) -> str:
        return f"{self.workspace.rstrip('/')}/{name}"

    @property
    def registry(self) -> str:
        return self.path("registry")

    @property
    def base_training(self) -> str:
        return self.base_path or self.path("base_training.parquet")

    @property
    def merged_training(self) -> str:
        return self.path("training.parquet")

    def window(self, days: int) -> DayWindow:
        return DayWindow.ending_today(days, self.zone) if self.as_of is None else DayWindow(self.as_of, days)


def score_history(
    spark: SparkSession,
    calls: DataFrame,
    bundle: str,
    config: JobConfig,
    threshold: float | None = None,
    per_phone: bool = True,
) -> tuple[DataFrame, float]:
    """(key, features, label, Score) of every phone, or every report, of a call history."""
    model, columns, metrics = artifacts.load_bundle(spark, bundle)
    limit = threshold
    if limit is None:
        limit = float(artifacts.threshold_row(metrics).first()["threshold"])
    if not 0.0 <= limit <= 1.0:
        raise ValueError(f"threshold {limit} is outside [0, 1]")
    key = "phone" if per_phone else "report"
    dimension = provider_dimension(spark, config.providers)
    if per_phone:
        pool = phone_pool(calls, dimension, config.features, ordered=False)
    else:
        pool = report_features(calls, dimension, config.features)
    scored = score(model, columns, pool, [key])
    return scored.withColumn("label", (F.col("Score") >= F.lit(limit)).cast("int")), limit


def _production(spark: SparkSession, config: JobConfig) -> str:
    current = artifacts.production_model(spark, config.registry)
    if current is None:
        raise RuntimeError(f"no production model in {config.registry}")
    return current["path"]


def infer(spark: SparkSession, history: str, config: JobConfig) -> dict[str, Any]:
    """Recent history to a scoring pool and predictions per phone."""
    exported = export_calls(spark, history, config.path("exports"), config.window(config.history_days))
    calls = load_table(spark, exported, "parquet")
    scored, threshold = score_history(spark, calls, _production(spark, config), config)
    pool = replace_table(scored, config.path("prediction_pool.parquet"))
    written = load_table(spark, pool)
    target = replace_table(predictions(written, "phone", threshold), config.path("predictions.jsonl"))
    return {"history_export": exported, "pool": pool, "predictions": target, "threshold_used": threshold}


def label(spark: SparkSession, reports: str, config: JobConfig) -> dict[str, Any]:
    """Recent reports to labels per phone."""
    exported = export_reports(spark, reports, config.path("exports"), config.window(config.report_days))
    summary = stored(report_summary(clean_reports(load_table(spark, exported, "parquet")), ordered=False), "summary")
    target = replace_table(label_feedback(summary, config.labels), config.path("feedback_labels.parquet"))
    return {"report_export": exported, "labels": target, "rows": load_table(spark, target).count()}


def dataset(spark: SparkSession, labels: str, pool: str, config: JobConfig) -> dict[str, Any]:
    """Corrected rows over the base training set; the pool has one row per phone."""
    changed = changed_labels(load_table(spark, labels), load_table(spark, pool), unique_phones=True)
    changed_path = replace_table(changed, config.path("changed_rows.parquet"))
    changed = load_table(spark, changed_path)
    base = load_if_exists(spark, config.base_training)
    merged = replace_table(merge_training(changed, base), config.merged_training)
    return {
        "changed_rows": changed_path,
        "changed_count": changed.count(),
        "training": merged,
        "training_count": load_table(spark, merged).count(),
    }


def train(
    spark: SparkSession,
    training: str | None,
    config: JobConfig,
    params: TreeParams | None = None,
) -> dict[str, Any]:
    """Checks the data, tunes, trains, evaluates and promotes if better; problems in the data are reported.

    Without a path it takes the merged training set, or the base set where
    none has been merged yet.
    """
    source = training or config.merged_training
    table = load_if_exists(spark, source)
    if table is None:
        source = config.base_training
        table = load_table(spark, source)
    quality = validate_training(table).first()
    prepared = training_set(table, "phone", config.split)
    version = uuid.uuid4().hex
    trials = record = None
    if params is None:
        tuned = tune(
            prepared.rows, prepared.columns, config.trials, config.trial_seconds, config.split.seed, config.space,
            log=config.search and config.path(f"searches/{config.search}"),
        )
        params = tuned.best
        record = {"data_path": source, "label_col": "label", "dropped_cols": prepared.dropped, **tuned.record}
        trials = save_table(tuned.trials.coalesce(1), config.path(f"candidates/{version}/trials.parquet"))
    trained = fit(prepared.rows, prepared.columns, params)
    bundle = config.path(f"candidates/{version}")
    report = model_report(trained, prepared.rows, source, "label", prepared.dropped)
    artifacts.save_bundle(trained, report, bundle)
    outcome = artifacts.promote(
        spark, config.registry, version, bundle, spark.read.parquet(f"{bundle}/metrics"), config.min_delta
    ).first()
    return {
        "version": version,
        "bundle": bundle,
        "trials": trials,
        "tuning": record,
        "valid": quality["valid"],
        "issues": list(quality["issues"]),
        "promoted": outcome["status"] == "production",
        "reason": outcome["reason"],
    }


def full(spark: SparkSession, history: str, reports: str, config: JobConfig) -> dict[str, Any]:
    """Inference, labelling, dataset and training one after the other."""
    inferred = infer(spark, history, config)
    labelled = label(spark, reports, config)
    merged = dataset(spark, labelled["labels"], inferred["pool"], config)
    trained = train(spark, merged["training"], config)
    return {"inference": inferred, "feedback": labelled, "dataset": merged, "training": trained}


def score_file(
    spark: SparkSession,
    path: str,
    config: JobConfig,
    threshold: float | None = None,
    per_phone: bool = True,
    target: str | None = None,
    fmt: str | None = None,
) -> dict[str, Any]:
    """Scores one history file in any supported format, by its suffix or as said; gives the table, its size and five rows."""
    calls = load_table(spark, path, fmt)
    scored, used = score_history(spark, calls, _production(spark, config), config, threshold, per_phone)
    key = "phone" if per_phone else "report"
    written = save_table(
        predictions(scored, key, used), target or config.path(f"scored-{uuid.uuid4().hex}.parquet")
    )
    table = load_table(spark, written)
    sample = [row.asDict() for row in prediction_sample(table, key).collect()]
    return {"output": written, "threshold_used": used, "rows": table.count(), "sample": sample}


def prediction_sample(table: DataFrame, key: str, rows: int = 5) -> DataFrame:
    return table.orderBy(key).limit(rows)


def recorded(
    spark: SparkSession, command: str, config: JobConfig, job: Callable[[], dict[str, Any]]
) -> dict[str, Any]:
    """Runs a job and leaves one manifest record of how it went."""
    run_id = uuid.uuid4().hex
    manifest = config.path("runs")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if config.shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(config.shuffle_partitions))
    try:
        with own_intermediates(spark):
            result = job()
    except Exception as error:
        artifacts.append_manifest(artifacts.manifest_row(spark, run_id, command, "failed", error=error), manifest)
        raise
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    artifacts.append_manifest(artifacts.manifest_row(spark, run_id, command, "success", result), manifest)
    return {**result, "run_id": run_id, "manifest": manifest}
