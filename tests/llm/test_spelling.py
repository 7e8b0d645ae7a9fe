import random
import re
import zlib
from collections import Counter

import pytest

from ringlens.llm import spelling


def naive_counts(docs):
    counts = Counter()
    for number, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)
        yield from (word[:i] + c + word[i:] for c in letters)


def naive(counts):
    letters = sorted({c for w in counts for c in w})
    near = {w: {v for v in edits(w, letters) if v in counts and v != w} for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    out = spelling.spelling_variants(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("limit", [1, 8])
def test_against_brute_force(spark, monkeypatch, limit):
    """Dense words of few letters, chains of forms, ties, Latin-1 letters; with long and with short grams."""
    monkeypatch.setattr(spelling, "LEAST_LIMIT", limit)
    rng = random.Random(6)
    base = ["".join(rng.choices("abé", k=rng.randint(4, 9))) for _ in range(150)] + ["ÀÿÉÿabc", "×÷×÷×÷", "Étoile", "étoile"]
    docs = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(30)]
        words = [w.upper() if rng.random() < 0.2 and w.isascii() else w for w in words]
        docs.append((rng.choice([i, i, None]), "".join(w + rng.choice([" ", "-", "1", "ā", "\n"]) for w in words)))
    docs += [(3, None), (4, ""), (5, "x" * 3000), (5, "x" * 3000), (5, "x" * 3000), (6, ("x" * 2999 + " ") * 4)]
    docs += [(7, " ".join(["kettle"] * 40 + ["kettles"] * 14 + ["kettless"] * 5 + ["kettleßs"] * 5))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS id")
    # The long ones are too many edits for the brute force: they are near each other.
    counts = naive_counts(docs)
    long = {w: n for w, n in counts.items() if len(w) > 1000}
    assert long == {"x" * 3000: 3, "x" * 2999: 4}
    expected = naive({w: n for w, n in counts.items() if w not in long})
    got = found(df.repartition(3))
    assert [row for row in got if len(row[0]) <= 1000] == expected
    assert [row[3:] for row in got if len(row[0]) > 1000] == [(4, 1, None), (3, 1, None)]
    assert any(row[1] != row[2] and row[1] for row in expected)


def test_real_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    counts = naive_counts([tuple(r) for r in docs.collect()])
    assert found(docs) == naive(counts) and len(counts) > 1000


def test_blocks(monkeypatch):
    text = ("Größe straße " * 20 + "ABCDEFGH" * 30 + " 12 ab cdefg").encode()
    whole = [run for part in spelling.runs(text) for run in part]
    monkeypatch.setattr(spelling, "BLOCK", 7)
    assert [run for part in spelling.runs(text) for run in part] == whole


def test_empty(spark):
    assert found(spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert found(spark.createDataFrame([(1, "abcd efgh"), (2, "words words")], "doc_id bigint, text string")) == []
