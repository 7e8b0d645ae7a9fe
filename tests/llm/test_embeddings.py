import math

import numpy as np
import pytest

from ringlens.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node long, n_links int, class string"


def brute(rows):
    usable = {}
    for i, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        v = np.array(vector, np.float32).astype(float)
        usable[i] = (label, v / np.linalg.norm(v))
    near = {i: set() for i in range(len(rows))}
    for i, (a, u) in usable.items():
        for j, (b, v) in usable.items():
            if i < j and a == b and len(u) == len(v) and u @ v >= 0.93:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=str)


def clusters(rng, dimension=16):
    rows = []
    for center in range(30):
        base = rng.standard_normal(dimension)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (base + rng.standard_normal(dimension) * rng.choice([0.05, 0.1, 0.25])).tolist(), center % 3))
    copied = rows[3][1]
    rows += [(len(rows) + i, copied, 0) for i in range(40)]
    rows += [(len(rows) + i, (np.array(copied) * (i + 2)).tolist(), 0) for i in range(30)]
    return rows


@pytest.mark.parametrize("tile", [2_048, 8])
def test_groups_agree_with_brute_force(spark, tile):
    rows = [(*row, None, None, None) for row in clusters(np.random.default_rng(2))]
    got = embeddings.embedding_groups(spark.createDataFrame(rows, SCHEMA), tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
        (9, [float("nan"), 2.0, 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1), (11, [1.0, 2.0], 1), (None, v, 1), (None, [5.0, 0.0, -0.0], 7),
        (13, [5.0, -0.0, 0.0], 7), (14, [1e-38, 2e-38, 3e-38], 1), (15, [1e38, 2e38, 3e38], 1), (None, None, None),
    ]
    rows = [(*row, 1, 2, "x") for row in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, embeddings.embedding_groups(df).collect()), key=str) == brute(rows)
    assert embeddings.embedding_groups(df.limit(0)).collect() == []


def test_tables_follow_size_and_threshold():
    for n in (1, 100, 10_000, 10**7, 10**10):
        bits, tables = embeddings.tables_for(n)
        alike = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - alike) ** tables <= embeddings.MISS
        assert n / 2**bits <= embeddings.BUCKET or bits == embeddings.MIN_BITS


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        u = rng.standard_normal(64)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(64)
        w -= w @ u * u
        w /= np.linalg.norm(w)
        rows += [(2 * i, u.tolist(), 1), (2 * i + 1, (0.9305 * u + math.sqrt(1 - 0.9305**2) * w).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id for r in embeddings.embedding_groups(df).collect() if r.n_links}
    assert len(found) >= 0.99 * 800
