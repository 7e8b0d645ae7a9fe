"""Boosted-tree training, tuning, scoring and evaluation."""

from __future__ import annotations

import json
import math
import random
import threading
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import asdict, dataclass

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.config import SearchSpace, SplitConfig, TreeParams
from ringlens.functions.conversions import numeric_or_null
from ringlens.operators.metrics import Grid, best_threshold, class_weight, metrics_at, roc_auc
from ringlens.operators.rollup import IDENTITY_COLUMNS, align_features, coerce_numeric
from ringlens.operators.split import row_digest, with_roles
from ringlens.session import literal_table, shared_dir, stored
from ringlens.sources.versions import claim, entry, numbers

MISSING = -1.0  # features are never negative, so trees can tell a missing value from a present one


@dataclass
class TrainedModel:
    model: PipelineModel
    columns: list[str]
    weight: float

    @property
    def trees(self) -> int:
        return self.model.stages[-1].getNumTrees


def training_rows(
    df: DataFrame, key: str = "phone", label: str = "label"
) -> tuple[DataFrame, list[str], list[str]]:
    """(key if there is one, label, numeric features) of the rows with a label, the features, and what was dropped."""
    value = numeric_or_null(F.col(label), df.schema[label].dataType)
    dropped = [name for name in df.columns if name in (*IDENTITY_COLUMNS, key, label)]
    columns = [name for name in df.columns if name not in dropped]
    if not columns:
        raise ValueError("no feature columns left to train on")
    keys = [key] if key in df.columns else []
    labelled = df.where(value.isNotNull()).select(*keys, value.cast("int").alias("label"), *columns)
    return coerce_numeric(labelled, keys=[*keys, "label"]), columns, [name for name in dropped if name != label]


def _stages(columns: Sequence[str]) -> list:
    finite = ", ".join(
        f"CASE WHEN abs(`{c}`) < double('Infinity') THEN double(`{c}`) ELSE {MISSING}D END AS `_x{i}`"
        for i, c in enumerate(columns)
    )
    inputs = [f"_x{i}" for i in range(len(columns))]
    return [
        SQLTransformer(statement=f"SELECT *, {finite} FROM __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def fit(rows: DataFrame, columns: Sequence[str], params: TreeParams = TreeParams()) -> TrainedModel:
    """Trains on the rows of role train and keeps the trees that pay off on the rows of role validation.

    All rounds are trained, then one pass over the validation rows gives the
    loss after each; the first minimum that the next ``patience`` rounds do not
    beat ends the model. Without validation rows all trees stay.
    """
    shared_dir(rows.sparkSession)  # boosting checkpoints there
    weight = class_weight(rows.where(F.col("role") == "train")).first()["scale_pos_weight"]
    weighted = rows.withColumn("_weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
    prepare = _stages(columns)

    def prepared(role: str) -> DataFrame:
        used = weighted.where(F.col("role") == role)
        for stage in prepare:
            used = stage.transform(used)
        return used.select("features", "label", "_weight")

    trees = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="_weight",
        maxIter=params.rounds,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.row_sample,
        featureSubsetStrategy=str(params.column_sample),
        maxBins=params.bins,
        minInstancesPerNode=params.min_child_rows,
        minInfoGain=params.min_gain,
        seed=params.seed,
    ).fit(prepared("train"))
    checked = prepared("validation")
    if not checked.isEmpty():
        trees = first_trees(trees, best_round(trees.evaluateEachIteration(checked), params.patience))
    return TrainedModel(PipelineModel([*prepare, trees]), list(columns), float(weight))


def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds up to the first minimum that the ``patience`` rounds after it do not beat."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The model after its first ``count`` rounds."""
    if count >= model.getNumTrees:
        return model
    gateway = SparkContext._active_spark_context._gateway
    java, jvm = model._java_obj, gateway.jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, count), gateway.new_array(jvm.double, count)
    for i in range(count):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    shorter = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), 2)
    java.copyValues(shorter, jvm.org.apache.spark.ml.param.ParamMap.empty())
    return GBTClassificationModel(shorter)


def score(model: PipelineModel, columns: Sequence[str], pool: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``Score``, the probability of spam, to the keys and the model's columns."""
    inputs = coerce_numeric(align_features(pool, columns, keys), keys=keys)
    scored = model.transform(inputs)
    return scored.select(*keys, *columns, vector_to_array("probability")[1].alias("Score"))


def evaluation_rows(trained: TrainedModel, rows: DataFrame) -> DataFrame:
    scored = score(trained.model, trained.columns, rows, ["label", "role"])
    return scored.select("role", "label", F.col("Score").alias("score"))


def model_report(
    trained: TrainedModel, rows: DataFrame, source: str | None = None, label: str = "label", dropped: Sequence[str] = ()
) -> DataFrame:
    """One row: inputs, class weight, AUC and the measures on test rows at 0.5 and at the validated threshold."""
    evaluated = stored(evaluation_rows(trained, rows.where(F.col("role") != "train")), "evaluation")
    test = evaluated.where(F.col("role") == "test").select("label", "score")
    grid = Grid()
    best = best_threshold(evaluated.where(F.col("role") == "validation").select("label", "score"), grid)
    threshold = best.first()["threshold"]
    kept = ["tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"]

    def at(value: float, suffix: str) -> DataFrame:
        return metrics_at(test, [value]).select(F.struct(*[F.col(name).alias(f"{name}@{suffix}") for name in kept]))

    one_row = {
        "auc_val": roc_auc(test).select("auc"),
        "_half": at(0.5, "0.5"),
        "_best": at(threshold, "best"),
    }
    facts = rows.agg(F.count(F.lit(1)).alias("n_rows_used")).select(
        F.lit(source).cast("string").alias("data_path"),
        F.lit(label).alias("label_col"),
        F.array(*[F.lit(name) for name in dropped]).cast("array<string>").alias("dropped_cols"),
        "n_rows_used",
        F.lit(len(trained.columns)).alias("n_features"),
        F.lit(trained.weight).alias("scale_pos_weight"),
        F.lit(int(trained.trees)).alias("best_iteration"),
        F.lit(0.5).alias("threshold@0.5"),
        F.lit(float(threshold)).alias("threshold_best"),
        F.lit(grid.step).alias("threshold_search_step"),
    )
    joined = facts.withColumns({name: row.scalar() for name, row in one_row.items()})
    return joined.select(*[F.col(f"`{name}`") for name in facts.columns], "auc_val", "_half.*", "_best.*")


def sample_params(rng: random.Random, seed: int, space: SearchSpace = SearchSpace()) -> TreeParams:
    """One draw from the search space."""

    def stepped(ends: tuple[int, int], step: int) -> int:
        return rng.randrange(ends[0], ends[1] + 1, step)

    low, high = map(math.log, space.learning_rate)
    return TreeParams(
        rounds=stepped(space.rounds, space.rounds_step),
        depth=rng.randint(*space.depth),
        min_child_rows=max(1, round(rng.uniform(*space.min_child_rows))),
        learning_rate=min(max(math.exp(rng.uniform(low, high)), space.learning_rate[0]), space.learning_rate[1]),
        row_sample=rng.uniform(*space.row_sample),
        column_sample=rng.uniform(*space.column_sample),
        min_gain=rng.uniform(*space.min_gain),
        bins=stepped(space.bins, space.bins_step),
        patience=space.patience,
        seed=seed,
    )


@dataclass
class Tuning:
    """Best parameters, all trials as a table, and the record of the search."""

    best: TreeParams
    trials: DataFrame
    record: dict


def logged_trials(spark: SparkSession, log: str, drawn: Sequence[TreeParams]) -> dict[int, float]:
    """AUC of the trials of a log whose parameters are those drawn now."""
    found = [json.loads(entry(spark, log, number)) for number in numbers(spark, log) if number <= len(drawn)]
    return {row["trial"]: row["auc"] for row in found if row["params"] == asdict(drawn[row["trial"]])}


def tune(
    rows: DataFrame,
    columns: Sequence[str],
    trials: int = 5,
    budget_seconds: float | None = None,
    seed: int = 42,
    space: SearchSpace = SearchSpace(),
    side_by_side: int = 2,
    log: str | None = None,
) -> Tuning:
    """Random search for the highest AUC on validation rows.

    Parameters are drawn before anything runs, so they do not depend on
    timing. ``side_by_side`` trials share the cluster; none begins once the
    budget is spent, and those that still run then are cancelled, but at least
    one is run to its end. With a ``log`` folder each trial is written there as
    it ends, and a search that has been stopped goes on with the trials it
    lacks; a logged trial counts if its parameters are the drawn ones. The log
    belongs to one set of rows.
    """
    rng = random.Random(seed)
    drawn = [sample_params(rng, seed, space) for _ in range(trials)]
    started = time.monotonic()
    spark = rows.sparkSession
    context = spark.sparkContext
    known = {} if log is None else logged_trials(spark, log, drawn)
    mark = f"search-{uuid.uuid4().hex}"
    spent, ended = threading.Event(), threading.Event()

    def run(trial: int) -> float | None:
        if trial in known:
            return known[trial]
        if trial and budget_seconds is not None and time.monotonic() - started > budget_seconds:
            return None
        if trial:  # the first one is run whatever it takes
            context.addJobTag(mark)
        try:
            trained = fit(rows, columns, drawn[trial])
            held_out = evaluation_rows(trained, rows.where(F.col("role") == "validation"))
            auc = roc_auc(held_out.select("label", "score")).first()["auc"]
        except Exception:
            if trial and spent.is_set():
                return None
            raise
        finally:
            if trial:
                context.removeJobTag(mark)
        auc = 0.0 if auc is None else float(auc)
        if log is not None:
            claim(spark, log, trial + 1, json.dumps({"trial": trial, "params": asdict(drawn[trial]), "auc": auc}))
        return auc

    def stop() -> None:
        spent.set()
        while not ended.is_set():  # a trial may be between two jobs
            context.cancelJobsWithTag(mark)
            ended.wait(0.5)

    here = [copy_context() for _ in range(trials)]  # threads then use this job's folder for intermediates
    # Each trial gets its own copy of the local properties, which hold the tag.
    targets = [inheritable_thread_target(spark)(run) for _ in range(trials)]
    timer = None if budget_seconds is None else threading.Timer(max(budget_seconds, 0.0), stop)
    if timer is not None:
        timer.daemon = True
        timer.start()
    try:
        with ThreadPoolExecutor(max_workers=max(1, side_by_side)) as pool:
            found = list(pool.map(lambda trial: here[trial].run(targets[trial], trial), range(trials)))
    finally:
        ended.set()
        if timer is not None:
            timer.cancel()
    results = [(i, drawn[i], auc) for i, auc in enumerate(found) if auc is not None]
    best = max(results, key=lambda result: (result[2], -result[0]))
    kinds = {int: "int", float: "double"}
    fields = list(asdict(results[0][1]))
    schema = [("trial", "int"), *[(f, kinds[type(getattr(results[0][1], f))]) for f in fields]]
    table = literal_table(
        rows.sparkSession,
        [*schema, ("auc", "double"), ("is_best", "boolean")],
        [(i, *[getattr(params, f) for f in fields], auc, i == best[0]) for i, params, auc in results],
    )
    weight = class_weight(rows.where(F.col("role") == "train")).first()["scale_pos_weight"]
    record = {
        "n_features": len(columns),
        "scale_pos_weight_used": float(weight),
        "n_trials": len(results),
        "n_resumed": sum(i in known for i, _, _ in results),
        "best_auc": best[2],
        "best_params": asdict(best[1]),
    }
    return Tuning(best[1], table, record)


@dataclass
class TrainingSet:
    """Rows with roles, stored once because training passes over them many times."""

    rows: DataFrame
    columns: list[str]
    dropped: list[str]


def training_set(df: DataFrame, key: str = "phone", config: SplitConfig = SplitConfig()) -> TrainingSet:
    """Labelled numeric rows with their role.

    The hash that decides the role is computed once, with the rows it belongs
    to; finding the shares and comparing rows with them then reads only that.
    """
    rows, columns, dropped = training_rows(df, key)
    digest = row_digest(rows, key if key in rows.columns else None, "label", config)
    hashed = stored(rows.withColumn("_digest", digest), "training-rows")
    roles = with_roles(hashed, F.col("_digest"), "label", config).drop("_digest")
    return TrainingSet(stored(roles, "training-roles"), columns, dropped)


def split_rows(df: DataFrame, key: str = "phone", config: SplitConfig = SplitConfig()) -> tuple[DataFrame, list[str]]:
    """Rows and feature names of the training set."""
    made = training_set(df, key, config)
    return made.rows, made.columns
