import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlens.llm import language
from ringlens.llm.catalog import CATALOG


def counts_of(texts):
    out = {}
    for label, text in texts.items():
        codes, numbers = language.context_counts(language.folded(text))
        out[label] = dict(zip(codes.tolist(), numbers.tolist(), strict=True))
    return out


TEXTS = {"x": "the cat sat on the mat and the cat ran" * 3, "y": "der hund und die katze und der ball ä" * 3}


def test_every_context_is_a_distribution():
    trees = language.build_trees(counts_of(TEXTS))
    size = int(trees.symbols.max()) + 1
    shares = np.exp2(-trees.bits.astype(float)).reshape(-1, size, 2).sum(axis=1)
    assert np.allclose(shares, 1, atol=1e-4)


def naive_bits(table, text, order, alphabet):
    """Code length by walking the escape chain for each byte."""

    def chance(context, byte):
        followers = {code & 0xFF: n for code, n in table.items() if code >> 56 == len(context) and code >> 8 & (256 ** len(context) - 1) == int.from_bytes(context, "big")}
        if not context and not followers:
            return 1 / (len(alphabet) + 1)
        shorter = (lambda b: chance(context[1:], b)) if context else (lambda b: 1 / (len(alphabet) + 1))
        if not followers:
            return shorter(byte)
        total, kinds = sum(followers.values()), len(followers)
        if byte in followers:
            return followers[byte] / (total + kinds)
        rest = 1 - sum(shorter(b) for b in followers)
        return kinds / (total + kinds) * shorter(byte) / rest

    return sum(-np.log2(chance(text[max(0, i - order) : i], byte)) for i, byte in enumerate(text))


def test_code_lengths_are_those_of_the_trees():
    counts = counts_of(TEXTS)
    trees = language.build_trees(counts)
    alphabet = {code & 0xFF for table in counts.values() for code in table}
    # Texts begin in the context of unseen symbols, as does the walk over an unknown context.
    text = b"the hund"
    got = trees.code_lengths(text)
    for j, label in enumerate(trees.languages):
        assert got[j] == pytest.approx(naive_bits(counts[label], text, 3, alphabet), abs=1e-3)


def test_blocks_do_not_change_code_lengths(monkeypatch):
    trees = language.build_trees(counts_of(TEXTS))
    text = language.folded("the katze ran und sat on der mat " * 9)
    whole = trees.code_lengths(text)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert np.allclose(trees.code_lengths(text), whole)


def test_query_predicts_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = CATALOG["op6_language_id"].run(spark, sf).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_predictions_ignore_label_and_id(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    trees = language.train(docs.where(~language.held_out()))
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 5)
    one = language.identify(docs, trees).select("text", "predicted").collect()
    two = language.identify(changed, trees).select("text", "predicted").collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, predicted int, label string, id int"
    rows = [
        (0, TEXTS["x"], "x", 1, "a", 1), (1, TEXTS["y"], "y", 1, "a", 1), (1, TEXTS["y"], "y", 1, "a", 1),
        (None, "the cat sat", None, None, None, None), (3, None, "x", None, None, None), (4, "", "x", None, None, None),
        (5, "123 ... !!", "y", None, None, None), (6, "的", "y", None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {(r.doc_id, r.lang_pred) for r in language.language_ids(df).collect()}
    assert {(None, "x"), (3, "und"), (4, "und"), (5, "und")} <= got
    assert language.language_ids(df).count() == len(rows)
    kept = language.keep_identified(df, language.train(df), least_score=0.0)
    assert kept.columns == df.columns and kept.count() == 5
    empty = spark.createDataFrame([], schema)
    assert language.language_ids(empty).collect() == []
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.language_ids(unlabelled).collect()} == {"und"}
