import random
import re
from collections import Counter, defaultdict

import pytest

from checks.compare import connect, ordered
from ringlens.llm import collocations as co
from ringlens.llm.catalog import CATALOG


def naive(docs, least, first):
    """``docs``: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def sample(rng, n):
    common = ["the", "of", "new", "york", "city", "É", "x.y", "a"]
    docs = []
    for _ in range(n):
        words = [rng.choice(common) if rng.random() < 0.8 else rng.choice("bcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", "\n", " ", " "]) for w in words)
        docs.append((rng.choice(["en", "fr", None]), rng.choice([text, text.upper()])))
    return docs + [("en", None), ("en", ""), ("de", " . "), (None, "New York City " * 30)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    """Once with room for all, once with bursting containers, spilled subtrees and blocks of a few bytes."""
    if small:
        for name, value in (("BURST", 3), ("ENTRIES", 40), ("WORDS_AT_ONCE", 30), ("BLOCK", 50)):
            monkeypatch.setattr(co, name, value)
    docs = sample(random.Random(4), 150)
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS f", "3 AS n")
    for bits in (1 << 25, 64):  # a full table lets everything pass
        found = co.collocations(df.repartition(3), least_count=10, first=25, filter_bits=bits)
        assert sorted(map(tuple, found.collect())) == naive(docs, 10, 25)


def test_workers_spill(monkeypatch):
    """What a task gives away early adds up to the same counts."""
    docs = sample(random.Random(5), 60)
    batch = co.pa.RecordBatch.from_pydict({"lang": [d[0] or "und" for d in docs], "text": [d[1] for d in docs]})

    class All(co.BitTable):
        def __init__(self):
            pass

        def has(self, h):
            return 1

    def total(batches):
        sums = Counter()
        for b in batches:
            rows = b.to_pylist()
            assert [(r["lang"], r["phrase"] or "") for r in rows] == sorted((r["lang"], r["phrase"] or "") for r in rows)
            for r in rows:
                sums[r["lang"], r["prefix"], r["phrase"], r["words"]] += r["f"]
        return sums

    def all_counts():
        counter = co.Scan(All(), shortest=3, longest=5)
        return total(co.count_words(iter([batch]))), total(counter(iter([batch])))

    whole = all_counts()
    for name, value in (("ENTRIES", 40), ("WORDS_AT_ONCE", 30), ("BLOCK", 50)):
        monkeypatch.setattr(co, name, value)
    monkeypatch.setattr(co, "BURST", 3)
    assert all_counts() == whole


def test_exact_beyond_64_bits(spark, monkeypatch):
    known = spark.createDataFrame(
        [("en", None, 0, 10**14), ("en", "a", 1, 10**13), ("en", "b", 1, 3), ("en", "a b", 2, 3)], "lang string, phrase string, words int, f bigint"
    )
    monkeypatch.setattr(co, "frequent_phrases", lambda *a: known)
    row = co.collocations(known).first()
    assert row.score == 1000 * 3 * 10**14 // (10**13 * 3)


def test_empty(spark):
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    query = CATALOG["op12_collocations"]
    found = query.run(spark, folder)
    result = connect(folder).execute(query.sql)
    names = sorted(d[0] for d in result.description)
    assert names == sorted(found.columns)
    theirs = ordered(result.fetchall(), [d[0] for d in result.description], names)
    assert ordered([tuple(r) for r in found.collect()], found.columns, names) == theirs and len(theirs) > 50


@pytest.mark.parametrize("words", [10**7, 10**8, 10**9])
def test_few_pairs_pass_by_their_bucket(words):
    """Pairs that occur 60 times each must rarely fill a bucket to 100 by what else falls in it."""
    buckets = co.bucket_number(words)
    rng = co.np.random.default_rng(7)
    others = rng.poisson(words / buckets, 100_000)
    assert co.np.mean(60 + others >= 100) < 0.01
    assert buckets <= co.MOST_BUCKETS and buckets % co.BUCKET_BLOCK == 0


def test_a_task_sends_one_row_per_part(monkeypatch):
    """However many phrases a task has counted, its rows are bounded by the parts; their counts are those of the scan."""
    monkeypatch.setattr(co, "PARTS", 8)
    docs = sample(random.Random(8), 200)
    batch = co.pa.RecordBatch.from_pydict({"lang": [d[0] or "und" for d in docs], "text": [d[1] for d in docs]})

    class All(co.BitTable):
        def __init__(self):
            pass

        def has(self, h):
            return 1

    scan = co.Scan(All(), shortest=2, longest=2)
    plain = Counter({(r["lang"], r["phrase"]): r["f"] for b in scan(iter([batch])) for r in b.to_pylist()})
    rows = [r for b in co.Packed(co.Scan(All(), shortest=2, longest=2))(iter([batch])) for r in b.to_pylist()]
    packed = Counter()
    for r in rows:
        for phrase, n in zip(r["phrases"].decode().split("\n"), co.np.frombuffer(r["f"], "<i8").tolist(), strict=True):
            packed[r["lang"], phrase] += n
    assert packed == plain and len(plain) > 300
    assert len(rows) <= 8 * len({r["lang"] for r in rows})
