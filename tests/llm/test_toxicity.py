import numpy as np
import pytest

from ringlens.llm import toxicity
from ringlens.llm.catalog import CATALOG


def likelihood(rows, columns, classes, weights, thresholds, penalty):
    scores = np.bincount(rows, weights[columns], len(classes))
    reached = toxicity.logistic(scores[:, None] - thresholds[None, :])
    padded = np.concatenate([np.ones((len(classes), 1)), reached, np.zeros((len(classes), 1))], axis=1)
    chance = padded[np.arange(len(classes)), classes] - padded[np.arange(len(classes)), classes + 1]
    return np.log(chance).sum() - penalty / 2 * (weights**2).sum()


def test_fit_is_at_a_maximum():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 3, 300)
    present = rng.random((300, 4)) < 0.2 + 0.2 * classes[:, None] * np.array([1, 0.5, 0, -0.4])
    rows, columns = np.nonzero(present)
    weights, thresholds = toxicity.fit_ordinal(rows, columns, classes, 4, penalty=0.5, steps=1500)
    assert (np.diff(thresholds) > 0).all()
    best = likelihood(rows, columns, classes, weights, thresholds, 0.5)
    for i in range(4):
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[i] += step
            assert likelihood(rows, columns, classes, moved, thresholds, 0.5) < best
    for i in range(2):
        for step in (-0.05, 0.05):
            moved = thresholds.copy()
            moved[i] += step
            assert likelihood(rows, columns, classes, weights, moved, 0.5) < best


def test_severity_is_the_expected_grade():
    model = toxicity.OrdinalModel({"bad": 4.0}, np.array([2.0, 3.0]), np.array([0.0, 1.0, 2.0]), 2.5)
    severity, grade, above = model.predict(["Bad BAD thing", "fine", None, ""])
    one, two = toxicity.logistic(np.array([2.0])), toxicity.logistic(np.array([1.0]))
    assert severity[0] == pytest.approx((one - two + 2 * two)[0])
    assert grade[0] == 2 and grade[1] == 0
    assert above.tolist() == [True, False, False, False]


def test_cut_parts_the_sample_best():
    scores = np.array([5.0, 4.0, 1.0, 1.0, 0.0, 0.0])
    assert toxicity.best_cut(scores, np.array([1, 1, 1, 1, 0, 0], bool)) == 0.5
    assert toxicity.best_cut(scores, np.array([1, 1, 0, 0, 0, 0], bool)) == 2.5
    assert toxicity.best_cut(scores, np.array([1, 1, 1, 1, 1, 1], bool)) == -np.inf


def test_query_finds_toxic_documents_and_leaves_clean_ones(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = CATALOG["op8_toxicity"].run(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    known = [(r.toxic, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    clean = [said for said, label in known if label == 0]
    toxic = [said for said, label in known if label == 1]
    assert sum(clean) <= 0.01 * len(clean)
    assert sum(toxic) >= 0.5 * len(toxic)
    assert all(0 <= r.severity <= 2 for r in rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string, rated string, severity int, id int, grade int"
    rows = [(i, f"vile {i} text number {i * 7}", "x", 1, 1, 1) for i in range(40)]
    rows += [(100 + i, f"kind {i} text number {i * 11}", "x", 1, 1, 1) for i in range(80)]
    rows += [(None, "vile", None, None, None, None), (300, None, None, None, None, None), (301, "", None, None, None, None)]
    rows += [(0, "vile 0 text number 0", "x", 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    grades = spark.createDataFrame(
        [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(80)] + [(None, 1), (300, None), (0, 1), (999, 1)], "id long, grade int"
    )
    model = toxicity.train(docs, grades)
    assert model.weights["vile"] > 0
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r.toxic == (r.doc_id is None or r.doc_id < 40) for r in got)
    kept = toxicity.keep_harmless(docs, model)
    assert kept.columns == docs.columns and kept.count() == 82
    none = toxicity.train(docs, spark.createDataFrame([], "id long, grade int"))
    assert not any(r.toxic for r in toxicity.toxicity(docs, none).collect())
    assert toxicity.toxicity(spark.createDataFrame([], schema), model).collect() == []
    assert toxicity.train(spark.createDataFrame([], schema), grades).weights == {}


def test_grades_of_labels(spark):
    rows = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (1, 0), (1, None), (None, 1)], "toxic int, quality int")
    assert [r[0] for r in rows.select(toxicity.severity_grade()).collect()] == [0, 0, 1, 2, 1, None]
