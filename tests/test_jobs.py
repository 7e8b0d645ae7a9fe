"""Models, registry, jobs and streams end to end on small inputs."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import catalog as K
from ringlens.config import SearchSpace, TreeParams
from ringlens.operators import model as ML
from ringlens.operators.risk import evaluate_risk, risk_features
from ringlens.plans import jobs
from ringlens.session import CHECKPOINT_DIR, fresh_path, literal_table, shared_dir, stored
from ringlens.sources import artifacts
from ringlens.sources.tables import load_table, save_table
from ringlens.streaming.risk import start_risk_stream

TREES = TreeParams(rounds=5, depth=3, learning_rate=0.3)


def separable(spark, rows=200):
    """Two features that decide the label, one of them with gaps, and one that is noise."""
    i = F.col("id")
    return spark.range(rows).select(
        F.concat(F.lit("09"), F.lpad(i.cast("string"), 8, "0")).alias("phone"),
        (i % 2).cast("int").alias("label"),
        (i % 2 * 10 + i % 7).cast("double").alias("a"),
        F.when(i % 5 > 0, i % 2 * 3.0).alias("b"),
        (i * 37 % 11).alias("noise"),
        F.lit(0.5).alias("Score"),
    )


def test_model_separates_and_survives_a_roundtrip(spark):
    rows, columns = ML.split_rows(separable(spark))
    assert columns == ["a", "b", "noise"]
    trained = ML.fit(rows, columns, TREES)
    report = ML.model_report(trained, rows)
    row = report.first()
    assert row["auc_val"] > 0.99 and row["f1@best"] > 0.95
    assert row["n_rows_used"] == 200 and row["n_features"] == 3
    assert row["tn@0.5"] + row["fp@0.5"] + row["fn@0.5"] + row["tp@0.5"] == 30
    path = fresh_path(spark, "bundle")
    artifacts.save_bundle(trained, report, path)
    model, kept, metrics = artifacts.load_bundle(spark, path)
    pool = separable(spark).drop("b").withColumn("extra", F.lit(1))
    before = ML.score(trained.model, columns, pool, ["phone"]).orderBy("phone").collect()
    after = ML.score(model, kept, pool, ["phone"]).orderBy("phone").collect()
    assert before == after
    assert 0.0 < artifacts.threshold_row(metrics).first()[0] < 1.0


SPACE = SearchSpace(rounds=(2, 4), rounds_step=1, depth=(2, 3), bins=(16, 32), bins_step=16)


def test_tuning_marks_the_best_trial(spark):
    rows, columns = ML.split_rows(separable(spark, 120))
    tuned = ML.tune(rows, columns, trials=2, space=SPACE)
    found = tuned.trials.orderBy("trial").collect()
    assert len(found) == 2 and sum(r["is_best"] for r in found) == 1
    assert max(r["auc"] for r in found) == next(r["auc"] for r in found if r["is_best"])
    assert tuned.best.depth == next(r["depth"] for r in found if r["is_best"])
    assert tuned.record["n_features"] == 3 and tuned.record["best_params"]["depth"] == tuned.best.depth
    assert ML.tune(rows, columns, trials=3, budget_seconds=0.0, space=SPACE, side_by_side=1).trials.count() == 1


def test_draws_cover_their_space():
    import random

    draws = [ML.sample_params(random.Random(i), 1) for i in range(300)]
    assert {d.rounds for d in draws} <= set(range(800, 3501, 100)) and len({d.rounds for d in draws}) > 20
    assert all(3 <= d.depth <= 10 and 0.01 <= d.learning_rate <= 0.2 and d.patience == 80 for d in draws)


def test_boosting_waits_for_a_later_minimum():
    losses = [5, 4, 4.5, 4.6, 3, 3.1, 3.2]
    assert ML.best_round(losses, patience=50) == 5
    assert ML.best_round(losses, patience=2) == 2
    assert ML.best_round([1.0], patience=5) == 1


def test_first_trees_are_those_of_the_model(spark):
    rows, columns = ML.split_rows(separable(spark))
    whole = ML.fit(rows, columns, TreeParams(rounds=6, depth=2, learning_rate=0.1))
    trees = whole.model.stages[-1]
    short = ML.first_trees(trees, 2)
    assert short.getNumTrees == 2 and list(short.treeWeights) == list(trees.treeWeights)[:2]
    path = fresh_path(spark, "short")
    short.save(path)
    assert type(short).load(path).getNumTrees == 2
    assert "probability" in short.transform(whole.model.stages[1].transform(whole.model.stages[0].transform(rows))).columns


def test_training_without_a_phone(spark):
    rows, columns = ML.split_rows(separable(spark).drop("phone"))
    assert columns == ["a", "b", "noise"] and rows.groupBy("role").count().count() == 3


def test_jobs_leave_no_intermediates_and_no_settings(spark):
    config = jobs.JobConfig(workspace=fresh_path(spark, "workspace"), shuffle_partitions=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = {}

    def job():
        seen["partitions"] = spark.conf.get("spark.sql.shuffle.partitions")
        seen["file"] = stored(spark.range(3), "step").inputFiles()[0]
        return {}

    jobs.recorded(spark, "label", config, job)
    assert seen["partitions"] == "3" and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert not os.path.exists(seen["file"].split(":", 1)[1].replace("//", "/"))


def test_training_falls_back_to_a_csv_base(spark, tmp_path):
    base = save_table(separable(spark, 120), f"{tmp_path}/base.csv")
    config = jobs.JobConfig(workspace=fresh_path(spark, "workspace"), base_path=base)
    result = jobs.train(spark, None, config, TREES)
    report = spark.read.parquet(f"{result['bundle']}/metrics").first()
    assert result["promoted"] and report["data_path"] == base and report["dropped_cols"] == ["phone", "Score"]
    assert report["n_rows_used"] == 120 and report["threshold@0.5"] == 0.5


def test_thresholds_fall_back(spark):
    def read(value, kind):
        return artifacts.threshold_row(literal_table(spark, [("threshold_best", kind)], [(value,)])).first()[0]

    assert read(0.55, "double") == 0.55
    assert read("0.6", "string") == 0.6
    assert read("high", "string") == 0.5
    assert read(None, "double") == 0.5
    nested = spark.range(1).select(F.struct(F.lit(0.7).alias("threshold")).alias("threshold_best"))
    assert artifacts.threshold_row(nested).first()[0] == 0.7
    assert artifacts.threshold_row(spark.range(1)).first()[0] == 0.5
    assert artifacts.load_threshold(spark, fresh_path(spark, "nothing")) == 0.5


def test_registry_keeps_the_better_model(spark):
    registry = fresh_path(spark, "registry")

    def offer(version, auc, f1):
        metrics = literal_table(spark, [("auc_val", "double"), ("f1@best", "double")], [(auc, f1)])
        return artifacts.promote(spark, registry, version, f"/models/{version}", metrics).first()["status"]

    assert artifacts.production_model(spark, registry) is None
    assert offer("v1", 0.8, 0.7) == "production"
    assert offer("v2", 0.7, 0.9) == "rejected"
    assert artifacts.production_model(spark, registry)["version"] == "v1"
    assert offer("v3", 0.9, 0.7) == "production"
    assert artifacts.production_model(spark, registry)["path"] == "/models/v3"


def test_manifest_records_success_and_failure(spark):
    config = jobs.JobConfig(workspace=fresh_path(spark, "workspace"))
    result = jobs.recorded(spark, "label", config, lambda: {"rows": 3})
    with pytest.raises(ValueError, match="boom"):
        jobs.recorded(spark, "train", config, lambda: (_ for _ in ()).throw(ValueError("boom")))
    rows = {r["command"]: r for r in artifacts.read_manifest(spark, result["manifest"]).collect()}
    assert (rows["label"]["status"], rows["label"]["result"]) == ("success", '{"rows": 3}')
    assert (rows["train"]["status"], rows["train"]["error_type"], rows["train"]["error_message"]) == (
        "failed", "ValueError", "boom",
    )


def test_all_jobs_hand_over_to_each_other(spark, sf):
    config = K.workspace(spark, sf)
    history, reports = K.upstream_file(spark, sf), K.reports_file(spark, sf)
    with pytest.raises(RuntimeError, match="no production model"):
        jobs.infer(spark, history, config)
    save_table(K.labelled_pool(spark, sf), config.base_training)
    first = jobs.train(spark, config.base_training, config, TREES)
    assert first["promoted"] and first["reason"] == "no_old_metrics"
    result = jobs.full(spark, history, reports, config)
    predictions = load_table(spark, result["inference"]["predictions"])
    assert sorted(predictions.columns) == ["Score", "Spam", "phone"]
    limit = result["inference"]["threshold_used"]
    assert predictions.where((F.col("Score") >= limit) != (F.col("Spam") == 1)).count() == 0
    assert result["dataset"]["training_count"] >= result["dataset"]["changed_count"] > 0
    assert load_table(spark, result["training"]["trials"]).count() == 2
    assert result["training"]["tuning"]["n_trials"] == 2


def test_scoring_a_file(spark, sf):
    config = K.with_production(spark, sf)
    source = save_table(K.call_history(spark, sf), fresh_path(spark, "history") + ".parquet")
    result = jobs.score_file(spark, source, config, threshold=0.0)
    assert result["rows"] == 15 and len(result["sample"]) == 5
    assert {row["Spam"] for row in result["sample"]} == {1}
    with pytest.raises(ValueError, match="outside"):
        jobs.score_file(spark, source, config, threshold=1.5)


def test_stream_equals_batch_across_restarts(spark):
    rows = spark.range(40).select(
        F.concat(F.lit("024"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("phone"),
        (F.col("id") / 40).alias("Score"),
        (F.col("id") % 9).cast("int").alias("sum_call"),
        F.lit(12.0).alias("duration"),
    )
    source, target, log = (fresh_path(spark, name) for name in ("source", "target", "log"))
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("phone"), F.lit(2)) == part).write.mode("append").parquet(source)
        query = start_risk_stream(spark, source, rows.schema, target, log, files_per_batch=1, available_now=True)
        query.awaitTermination()
    batch = evaluate_risk(risk_features(rows, keep=("Score",)))
    streamed = spark.read.parquet(target)
    assert streamed.orderBy("phone").collect() == batch.orderBy("phone").collect()


def test_windows_follow_the_given_day(spark):
    config = jobs.JobConfig(workspace="w/", as_of=date(2024, 1, 30))
    assert config.window(7).start == date(2024, 1, 24)
    assert config.path("x") == "w/x"


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get(CHECKPOINT_DIR, None)
    folder = shared_dir(spark)
    assert folder == (named.rstrip("/") if named else spark.sparkContext.getCheckpointDir().rstrip("/"))
    assert stored(spark.range(3), "kept").inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        folder.split(":", 1)[-1].lstrip("/")
    )
