import random

import pytest
from pyspark.sql import functions as F

from ringlens.operators.sequences import previous_across_ranges


@pytest.mark.parametrize("span", [1, 10, 10**6])
def test_previous_value_across_ranges(spark, span):
    """A report in many ranges, ranges without values, null keys and negative places."""
    rng = random.Random(8)
    rows = []
    for key in ("a", "b", None):
        for at in rng.sample(range(-200, 800), 120):
            rows.append((key, at, rng.choice([None, None, at]), rng.choice(["x", "y", None])))
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint, m string").repartition(5)
    values = {"p": F.col("v"), "q": F.struct("m")}
    got = previous_across_ranges(df, ["k"], "at", values, span).collect()
    assert len(got) == len(rows)
    for r in got:
        before = sorted((row for row in rows if row[0] == r.k and row[1] < r.at), key=lambda row: row[1])
        assert r.p == next((row[2] for row in reversed(before) if row[2] is not None), None)
        assert (r.q and (r.q.m,)) == ((before[-1][3],) if before else None)
