import hashlib
import random

import pytest

from ringlens.llm import chunk_prints as cp


def naive_chunks(data: bytes) -> list[bytes]:
    """Byte by byte: the hash of the last 16 bytes decides, strictly up to 32 bytes and leniently beyond."""

    def h(end):
        value = 0
        for byte in data[max(0, end - cp.WINDOW) : end]:
            value = (value * 2 + int(cp.GEAR[byte])) % 2**32
        return value

    out, begin = [], 0
    while begin < len(data):
        end = begin + 1
        while end < len(data):
            size = end - begin
            bits = cp.HARD_BITS if size < cp.NORMAL else cp.EASY_BITS
            if size >= cp.LONGEST or size >= cp.SHORTEST and h(end) < 2 ** (32 - bits):
                break
            end += 1
        out.append(data[begin:end])
        begin = end
    return out


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n))


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_chunks(monkeypatch, block):
    monkeypatch.setattr(cp, "BLOCK", block)
    rng = random.Random(1)
    for n in (0, 1, 2, 30, 700):
        data = words(rng, n).encode() if n else b""
        assert list(cp.chunks(data)) == naive_chunks(data)
    same = b"a" * 5000
    assert list(cp.chunks(same)) == naive_chunks(same)


def test_likeness_follows_what_is_shared():
    rng = random.Random(2)
    text = words(rng, 2000)
    whole = cp.chunk_records(text.encode())
    shifted = cp.chunk_records(("xyz " + text).encode())
    part = cp.chunk_records(text[3000:6000].encode())
    other = cp.chunk_records(words(rng, 2000).encode())
    assert cp.containment(whole, shifted) > 0.98
    assert cp.containment(whole, part) > 0.9
    assert cp.containment(whole, other) == 0.0
    assert cp.containment(frozenset(), frozenset()) == 1.0 and cp.containment(whole, frozenset()) == 0.0
    assert cp.parsed(cp.printed(whole)) == whole


def naive(docs):
    """``docs``: (id, text); equal rows are interchangeable."""
    rows = sorted([(i, t or "") for i, t in docs], key=lambda row: -row[0])
    out = []
    for k, (number, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        a, b, c = (frozenset(cp.xxhash.xxh3_64_digest(x)[:5] + bytes((len(x),)) for x in naive_chunks(t.encode())) for t in (text, new, following))
        out.append((number, len(text), hashlib.sha256(new.encode()).hexdigest(), cp.printed(a), cp.printed(b), cp.containment(a, b), cp.containment(a, c)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_documents(spark, partitions):
    rng = random.Random(3)
    docs = [(i * 7 - 50, words(rng, rng.choice([0, 1, 5, 60, 300]))) for i in range(60)]
    docs += [(1000, None), (1001, ""), (1002, docs[5][1]), (1003, "é" * 40)]
    rng.shuffle(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS place", "'x' AS extra", "2 AS id")
        found = cp.document_fingerprints(df.repartition(5))
        assert sorted(map(tuple, found.collect())) == naive(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    """Null and repeated ids, equal rows, one row, none; an id that fills several ranges."""
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert cp.document_fingerprints(empty).collect() == []
    one = cp.document_fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in one] == [(7, 1.0, hashlib.sha256(b"abcabc").hexdigest())]
    rows = [(None, "a b"), (None, None), (5, "same"), (5, "same"), *[(9, f"text {i}") for i in range(200)]]
    found = cp.document_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in found) == sorted((i or -1, len(t or "")) for i, t in rows)
    again = cp.document_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_columns(spark):
    df = spark.createDataFrame([("abc " * 50, "abc " * 50), ("x", None)], "a string, b string")
    out = df.select(cp.likeness(cp.fingerprint(df.a), cp.fingerprint(df.b)).alias("v")).collect()
    assert [r.v for r in out] == [1.0, 0.0]
