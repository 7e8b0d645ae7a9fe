"""Feature blocks against a plain Python reading of their definitions, and the two plans against each other."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from ringlens.config import FeatureConfig
from ringlens.operators.features import derive_features, marked_calls, report_features
from ringlens.operators.rollup import align_features, phone_features, report_phone_map
from ringlens.operators.sequences import layered_metrics, ordered_metrics
from ringlens.operators.skew import HeavyKeys, find_heavy
from ringlens.sources.providers import provider_dimension

SCHEMA = (
    "phone string, phone_member string, report string, type int, time timestamp_ntz, "
    "in_contact double, duration double, Spam int"
)
START = datetime(2024, 1, 1)


def random_calls(seed: int, rows: int = 400) -> list[tuple]:
    """Few reporters, many ties, exact copies, one reporter with a third of all calls."""
    rng = random.Random(seed)
    calls = []
    for _ in range(rows):
        report = "hot" if rng.random() < 0.33 else f"r{rng.randrange(6)}"
        second = rng.choice([rng.randrange(400_000), rng.randrange(20)])
        time = START + timedelta(seconds=second, microseconds=rng.choice([0, 0, 250_000, 999_999]))
        calls.append(
            (
                "0912000001", f"+8497{rng.randrange(8):06d}", report, rng.choice([1, 1, 2, 3, 4, 5]), time,
                float(rng.randrange(2)), float(rng.randrange(60)), rng.randrange(2),
            )
        )
    calls += [calls[0]] * 40
    return calls


def brute_force(calls: list[tuple]) -> dict[str, dict[str, float]]:
    def median(gaps):
        return statistics.median(gaps) if gaps else None

    def gaps_of(times):
        seconds = [int((t - START).total_seconds() // 1) for t in times]
        return [b - a for a, b in zip(seconds, seconds[1:])]

    by_report = defaultdict(list)
    for call in calls:
        if call[3] in (1, 2, 3, 4):
            by_report[call[2]].append(call)
    out = {}
    for report, rows in by_report.items():
        rows.sort(key=lambda c: (c[4], c[1], c[3], c[6]))
        to, back = [c for c in rows if c[3] in (1, 3)], [c for c in rows if c[3] in (2, 4)]

        def per_member(side):
            members = defaultdict(list)
            for c in side:
                members[c[1]].append(c[4])
            return sum(m for m in (median(gaps_of(t)) for t in members.values()) if m is not None) / 3600

        days = {c[4].date() for c in rows}
        out[report] = {
            "frequency": (median(gaps_of([c[4] for c in rows])) or 0) / 3600,
            "total_frequency_to": (median(gaps_of([c[4] for c in to])) or 0) / 3600,
            "total_frequency_in": (median(gaps_of([c[4] for c in back])) or 0) / 3600,
            "total_frequency_to_by_phonemember": per_member(to),
            "total_frequency_in_by_phonemember": per_member(back),
            "total_redial": sum(a[1] == b[1] for a, b in zip(rows, rows[1:])),
            "total_contacted": len({c[1] for c in rows}),
            "total_contacted_to": len({c[1] for c in to}),
            "total_contacted_in": len({c[1] for c in back}),
            "mean_call_by_day": sum(c[3] in (1, 2) for c in rows) / len(days),
            "sum_call": len(rows),
            "duration": sum(c[6] for c in rows),
            "in_hour": sum(7 <= c[4].hour <= 19 and c[4].weekday() < 5 for c in rows),
            "call_in_div_call_to": sum(c[3] in (2, 4) for c in rows)
            / (sum(c[3] in (1, 4) for c in rows) + 1),
        }
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("heavy_rows", [10**9, 60, 0])
def test_features_match_brute_force(spark, seed, heavy_rows):
    """The same results whether no, some or all reports take the layered plan."""
    calls = random_calls(seed)
    df = spark.createDataFrame(calls, SCHEMA)
    config = FeatureConfig(heavy_rows=heavy_rows)
    got = {r["report"]: r for r in report_features(df, provider_dimension(spark, {}), config).collect()}
    expected = brute_force(calls)
    assert set(got) == set(expected)
    for report, metrics in expected.items():
        for name, value in metrics.items():
            assert got[report][name] == pytest.approx(value, abs=1e-9), (report, name)


def test_both_plans_give_equal_rows(spark):
    df = spark.createDataFrame(random_calls(3), SCHEMA)
    marked = marked_calls(df, provider_dimension(spark, {"a": ["9700"], "b": ["0912"]}))
    one = ordered_metrics(marked)
    two = layered_metrics(marked).select(one.columns)
    names = ["report", "frequency", "total_redial", "total_frequency_in_by_phonemember", "mean_call_by_day"]
    assert sorted(map(tuple, one.fillna(0).select(names).collect())) == sorted(
        map(tuple, two.fillna(0).select(names).collect())
    )


def test_single_call_has_no_gaps(spark):
    df = spark.createDataFrame([("0912000001", "0912000002", "r", 1, START, 1.0, 30.0, 0)], SCHEMA)
    row = report_features(df, provider_dimension(spark, {})).first()
    assert row["frequency"] == row["time_join"] == row["total_redial"] == 0
    assert row["call_back_rate"] == 0.0
    assert (row["total_contacted"], row["mean_call_by_day"], row["call_to_rate"]) == (1, 1.0, 1.0)


def test_invalid_calls_are_dropped(spark):
    good = ("0912000001", "0912000002", "r", 1, START, 1.0, 30.0, 0)
    variants = [
        {0: None}, {1: "12"}, {1: "12a456"}, {2: None}, {3: 5}, {3: None}, {4: None}, {5: None}, {6: None}, {7: None},
        {0: "091200\n"},
    ]
    bad = [tuple(change.get(i, v) for i, v in enumerate(good)) for change in variants]
    df = spark.createDataFrame([good, *bad], SCHEMA)
    assert marked_calls(df, provider_dimension(spark, {})).count() == 1


def test_provider_prefixes_must_be_unique(spark):
    with pytest.raises(ValueError, match="more than one provider"):
        provider_dimension(spark, {"a": ["0912"], "b": ["0912"]})


def test_rollup_sums_over_reports_with_and_without_heavy_keys(spark):
    calls = [c[:1] + c[1:] for c in random_calls(4)]
    rows = [(f"09120000{i % 30:02d}", *c[1:]) for i, c in enumerate(calls)]
    df = spark.createDataFrame(rows, SCHEMA)
    features = report_features(df, provider_dimension(spark, {}))
    plain = phone_features(features, df, HeavyKeys(None)).collect()
    split = phone_features(features, df, find_heavy(report_phone_map(df), "report", 20)).collect()
    assert [r["phone"] for r in plain] == sorted(r["phone"] for r in plain)
    sizes = {r["report"]: r["sum_call"] for r in features.collect()}
    expected = defaultdict(int)
    for report, phone in {(r[2], r[0]) for r in rows}:
        expected[phone] += sizes.get(report, 0)
    assert {r["phone"]: r["sum_call"] for r in plain} == dict(expected)
    assert {r["phone"]: r["sum_call"] for r in split} == dict(expected)


def test_alignment_fills_drops_and_orders(spark):
    df = spark.createDataFrame([("p", 1, 2.0)], "phone string, b int, a double")
    aligned = align_features(df, ["a", "missing", "b"], keys=["phone"])
    assert aligned.columns == ["phone", "a", "missing", "b"]
    assert aligned.first()["missing"] == 0


def test_derived_features_do_not_need_python(spark):
    df = spark.createDataFrame(random_calls(5, 50), SCHEMA)
    plan = derive_features(ordered_metrics(marked_calls(df, provider_dimension(spark, {}))))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
