import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ringlens.llm import pii
from ringlens.llm.catalog import CATALOG

BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def accepted(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and passes_luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def naive(text):
    return [(k, m.start(), m.end()) for k, p in BASE for m in p.finditer(text or "") if accepted(k, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TEXTS = [
    None, "", "plain words", "a@b.com_x@c.d.e x@y z@", "é😀 mail me.too+1@ex-a.co.uk, or @no.one", "a@b.c@d.e", "..a@-.-..b",
    "1.2.3.4.5.6.7.8 300.1.2.3.4.5.6.7 001.02.3.0004 1.2.3 256.1.1.1 0000000000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111111111111112 4111  1111 1111 1111", "4111111111111111 4",
    "0000000000000000 00000000000000000000 6011000990139424-", "+1 (415) 555-2671 +12345678 +1234567 ++12345678 +1 2-(3).4 5 6 7 8 9 0 1 2 3 4 5 6",
    "tel +49 30 901820 and 10.0.0.1 at x@y.zz", "1 " * 3000, "12345678" * 400, "a.b-c" * 800 + "@x.yz", "+1" + "(" * 500 + "2",
    "1.2.3.4 " * 700, "\n+1 234 567 890\n4111 1111\n1111 1111",
]


def test_base_spans_are_the_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in pii.find_personal_data(df, pii.NO_MODEL).collect():
        expected = naive(TEXTS[row.doc_id])
        assert row.spans == listed(expected), TEXTS[row.doc_id]
        assert row.base_sha256 == hashlib.sha256(listed(expected).encode()).hexdigest()
        for kind, _ in BASE:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in expected)


def test_query_agrees_with_the_patterns(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = CATALOG["op9_personal_data"].run(spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = naive(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(listed(base).split(",")) <= {*row.spans.split(","), ""}


@pytest.fixture(scope="module")
def trained(spark):
    texts = [f"card {4000000000000000 + i * 9973} phone +1 (415) 555-{1000 + i} no {i * 31}" for i in range(300)]
    texts += [f"year {1900 + i} code {10**8 + i * 17} at 10.{i % 300}.3.4 or a{i}@b.org" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, pii.train(docs)


def test_expressions_are_the_trees(spark, trained):
    docs, model = trained
    assert any(least is not None for least in model.thresholds.values())
    found = pii.with_candidates(pii.with_base_spans(docs, "text"), "text").select("base", F.explode("candidates").alias("c"))
    rows = found.select(F.expr(model.score).alias("score"), F.expr("exists(base, b -> b.start = c.start AND b.stop = c.stop)").alias("right")).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    right = [r.score for r in rows if r.right]
    wrong = [r.score for r in rows if not r.right]
    assert sum(right) / len(right) > 0.8 > 0.2 > sum(wrong) / len(wrong)


def test_trusted_threshold():
    from pyspark.sql import Row

    bins = [Row(bin=98, good=500.0, n=500), Row(bin=60, good=10.0, n=10), Row(bin=10, good=0.0, n=90)]
    assert pii.trusted(bins) == 0.6
    assert pii.trusted([Row(bin=98, good=5.0, n=5)]) is None
    assert pii.trusted([]) is None


def test_added_spans_keep_off_the_base(spark, trained):
    docs, _ = trained
    eager = pii.SpanModel("1D", dict.fromkeys(pii.ADDED_KINDS, 0.5))
    extra = docs.limit(0).unionByName(spark.createDataFrame([(1, "write to joe (at) example.org or 555 123 4567 89, not a@b.cc")], docs.schema))
    spans = pii.find_personal_data(extra, eager).first().spans.split(",")
    assert spans[0].startswith("email:")
    assert sorted(s.split(":")[0] for s in spans[1:]) == ["address", "number"]
    none = pii.train(spark.createDataFrame([(1, "no data at all"), (2, None)], "doc_id long, text string"))
    assert none == pii.NO_MODEL


def test_redaction(spark):
    schema = "doc_id long, text string, base string, n_chars long, new int"
    rows = [
        (1, "é mail a@b.cc now 10.0.0.1!", "keep", 27, 1), (2, None, None, 0, None), (2, "clean", None, 5, None), (2, "clean", None, 5, None),
        (None, "", None, None, None), (3, "+1 100.100.10.10 x", None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    out = pii.redact(df, pii.NO_MODEL)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = sorted(((r.doc_id or -1, r.text, r.base, r.n_chars) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, "é mail [email] now [ip]!", "keep", 24), (2, None, None, 0), (2, "clean", None, 5), (2, "clean", None, 5), (-1, "", None, 0), (3, "[phone] x", None, 9)],
        key=str,
    )
    assert pii.redact(spark.createDataFrame([], schema), pii.NO_MODEL).collect() == []
    assert pii.find_personal_data(spark.createDataFrame([], schema), pii.NO_MODEL).collect() == []


def test_main_path_has_no_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = pii.find_personal_data(docs, pii.NO_MODEL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
