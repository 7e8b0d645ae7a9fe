import re
from collections import defaultdict
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry_point
import corpus_pipeline
from checks.compare import connect, ordered
from ringlens.llm import language
from ringlens.llm import toxicity as toxic
from ringlens.llm.catalog import CATALOG, toxicity_model


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in CATALOG if name.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(CATALOG) <= set(entry_point.queries())


@pytest.mark.parametrize("name", [name for name, query in CATALOG.items() if query.sql])
def test_query_matches_sql(spark, sf, name):
    df = CATALOG[name].run(spark, sf)
    result = connect(sf).execute(CATALOG[name].sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    theirs = ordered(result.fetchall(), names, sorted(names))
    assert ordered([tuple(r) for r in df.collect()], df.columns, sorted(names)) == theirs and theirs


def one_per_group(rows):
    """Smallest ids of the groups that a five-word Jaccard similarity of 0.8 links, by all pairs that share a run."""
    runs, holders = {}, defaultdict(list)
    for number, text in rows:
        words = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = [w for w in re.split("[ \t-\r]+", words) if w]
        runs[number] = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
        for run in runs[number]:
            holders[run].append(number)
    root = {number: number for number in runs}

    def top(number):
        while root[number] != number:
            number = root[number]
        return number

    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        if 5 * len(runs[a] & runs[b]) >= 4 * len(runs[a] | runs[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return sorted(number for number in runs if top(number) == number)


def test_stages_follow_their_operators(spark):
    """Each stage is held against its operator's own decisions on what it was given."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language_id", "simhash_near_dedup", "personal_data", "best_fit_packing"]
    columns = docs.columns

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    rated = toxic.toxicity(docs, toxicity_model(spark, sf, docs)).collect()
    kept = stages["toxicity"](spark, docs, sf)
    assert kept.columns == columns
    assert ids(kept) == sorted(r.doc_id for r in rated if not r.toxic) and any(r.toxic for r in rated)

    given = kept.select("doc_id", "text", "lang").collect()
    trees = language.train(docs.where(~language.held_out()))
    told = stages["language_id"](spark, docs, sf)
    assert told.columns == columns
    said = {r.doc_id: trees.predict(r.text) for r in docs.select("doc_id", "text").collect()}
    assert ids(told) == sorted(i for i, (lang, score) in said.items() if lang != "und" and score >= 0.5)
    assert len(given) == kept.count()

    single = stages["simhash_near_dedup"](spark, docs, sf)
    assert single.columns == columns
    assert ids(single) == one_per_group([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])

    clean = stages["personal_data"](spark, docs, sf)
    assert clean.columns == columns and ids(clean) == ids(docs)
    assert not clean.where("text rlike '[A-Za-z0-9]@[a-z0-9]+[.]example[.]com'").count()

    packed = stages["best_fit_packing"](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(ids(docs))


def test_pipeline_runs(spark, sf):
    rows = CATALOG["pipeline"].run(spark, sf).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
