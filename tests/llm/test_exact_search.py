import math

import numpy as np
import pytest

from ringlens.llm import exact_search

SCHEMA = "vec_id long, embedding array<double>, rank string, q int, id int"


def brute(rows, k=10, every=100):
    held = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x * 1024) for x in vector):
            continue
        q = [math.floor(1024 * x) for x in vector]
        if vec_id not in held or np.array(q, float).tobytes() < np.array(held[vec_id], float).tobytes():
            held[vec_id] = q
    out = []
    for a, x in held.items():
        if a % every == 0:
            scores = sorted((-max(min(sum(p * r for p, r in zip(x, y, strict=False)), 2**63 - 1), -(2**63)), b) for b, y in held.items() if b != a)
            out += [(a, rank, b, -s) for rank, (s, b) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    return sorted(tuple(r) for r in exact_search.top_k(df, **options).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("blocks", [(1_024, 16_384), (3, 40)])
def test_top_k_agrees_with_brute_force(spark, blocks):
    rng = np.random.default_rng(4)
    rows = [(i - 300, (rng.integers(-3, 4, 24) / 8 + (i % 5 == 0) * rng.standard_normal(24)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[300][1]) for i in range(25)]
    assert run(spark, rows, query_block=blocks[0], candidate_block=blocks[1]) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.5]), (200, []), (7, None), (None, [1.0, 1.0]), (8, [None, 1.0]), (9, [float("nan"), 1.0]),
        (10, [float("inf"), 1.0]), (11, [-1.5, 0.00001]), (12, [1.0, 2.0]), (13, [1e12, -1e12]), (300, [1e15, 3e15]), (14, [1e307, 1.0]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(100, [1.0])]) == []
    assert run(spark, []) == []


@pytest.mark.parametrize("segments", [1, 3, 4, 10])
def test_statistics_bound_the_score(segments):
    rng = np.random.default_rng(segments)
    a, b = rng.standard_normal((50, 10)), rng.standard_normal((60, 10))
    bounds = exact_search.segment_statistics(a, segments) @ exact_search.segment_statistics(b, segments).T
    assert (bounds >= a @ b.T - 1e-9).all()
