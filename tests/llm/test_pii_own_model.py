"""The model that the query itself learns: recall and false reports by form, and odd tables."""

import random

import pytest

from ringlens.llm import pii

SF = "/root/testdata/sf0.1"
RIGHT = {
    "at in parentheses": lambda r: f"{word(r)} (at) {word(r)}.{word(r)}.org",
    "at in brackets": lambda r: f"{word(r)}{r.randrange(99)} [at] {word(r)}.com",
    "area code": lambda r: f"({three(r)}) {three(r)}-{four(r)}",
    "hyphens": lambda r: f"{three(r)}-{three(r)}-{four(r)}",
    "after tel": lambda r: f"tel {' '.join(str(r.randrange(10, 100)) for _ in range(5))}",
}
WRONG = {
    "no host": lambda r: f"stood (at) {word(r)}",
    "order": lambda r: f"order ({three(r)}) {three(r)}-{four(r)}",
    "code": lambda r: f"code {three(r)}-{three(r)}-{four(r)}",
    "plain": lambda r: f"room {r.randrange(10**6, 10**7)}",
}


def word(r):
    return "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randrange(2, 9)))


def three(r):
    return r.randrange(200, 999)


def four(r):
    return r.randrange(1000, 9999)


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("form", [*RIGHT, *WRONG])
def test_forms(spark, model, form):
    rng = random.Random(form)
    make = (RIGHT | WRONG)[form]
    docs = spark.createDataFrame([(i, f"so {make(rng)}, as said") for i in range(200)], "doc_id long, text string")
    found = sum(bool(row.spans) for row in pii.find_personal_data(docs, model).collect())
    assert found >= 180 if form in RIGHT else found <= 2, (form, found)


def test_odd_tables_with_a_trained_model(spark, model):
    schema = "doc_id long, text string, base string, candidates int"
    rows = [(1, None, "x", 1), (None, "", None, None), (2, "x (at) y.org", "y", 2), (2, "x (at) y.org", "y", 2), (3, "7" * 60_000, "", 0)]
    found = pii.find_personal_data(spark.createDataFrame(rows, schema), model).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in found if r.doc_id != 3) == [(0, ""), (1, ""), *[(2, "address:0:12")] * 2]
    kept = pii.redact(spark.createDataFrame(rows, schema), model)
    assert kept.columns == ["doc_id", "text", "base", "candidates"]
    assert sorted((r.doc_id or 0, r.text or "-", r.base or "-") for r in kept.collect() if r.doc_id != 3) == [
        (0, "-", "-"), (1, "-", "x"), *[(2, "[address]", "y")] * 2
    ]
    empty = spark.createDataFrame([], schema)
    assert pii.find_personal_data(empty, model).count() == pii.redact(empty, model).count() == 0
    assert pii.train(empty) == pii.NO_MODEL


def test_few_held_out_candidates_add_nothing(spark):
    texts = [(f"write a{i}@b{i}.org, or stood (at) home {i}",) for i in range(12)]
    few = pii.train(spark.createDataFrame(texts, "text string"))
    assert few.thresholds == dict.fromkeys(pii.ADDED_KINDS)


def test_every_candidate_counts(spark):
    """Forms that are rare among 100,000 numbers are learned and calibrated from all of their candidates."""
    numbers = spark.range(1000).selectExpr(
        "concat_ws(' ', transform(sequence(0, 99), i -> concat('order ', 1000000000 + 7919 * (100 * id + i)))) AS text"
    )
    addresses = spark.createDataFrame(
        [(f"write a{i}{'.b' * (i % 2)}@c{i}.org, or stood (at) home{i}",) for i in range(80)], "text string"
    )
    model = pii.train(numbers.unionByName(addresses))
    assert model.thresholds["address"] is not None
