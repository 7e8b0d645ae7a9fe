"""What the plans must look like to hold at scale."""

from __future__ import annotations

import pytest

from checks import catalog as K
from ringlens.operators.dataset import first_per_key
from ringlens.sources import history
from ringlens.sources.tables import load_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle(spark, sf):
    text = plan(K.features(spark, sf))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange") - text.count("BroadcastExchange") == 1
    assert text.count("Sort [") == 3
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_one_block_prunes_the_others(spark, sf):
    text = plan(K.aggregates(spark, sf).select("report", "total_redial"))
    assert text.count("Window [") == 1 and "percentile" not in text


@pytest.mark.parametrize("name", ["agg_base", "agg_contacted", "agg_daily"])
def test_unordered_blocks_aggregate_before_every_shuffle(spark, sf, name):
    lines = [line.strip(" :+-") for line in plan(K.CATALOG[name].run(spark, sf)).split("\n")]
    shuffles = [i for i, line in enumerate(lines) if line.startswith("Exchange hashpartitioning")]
    assert shuffles and all("partial_" in lines[i + 1] for i in shuffles)
    assert not any(line.startswith("Window") for line in lines)


def test_date_filter_reaches_the_scan(spark, sf):
    source = K.upstream_file(spark, sf)
    text = plan(history.recent_calls(load_table(spark, source), K.HISTORY_WINDOW))
    assert "GreaterThanOrEqual(time,2024-01-24" in text and "LessThan(time,2024-01-31" in text


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    text = plan(first_per_key(df, "k", "v"))
    assert "row_number(), 1, Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_split_adds_no_shuffle_of_rows(spark, sf):
    df = K.split(spark, sf)
    text = plan(df)
    left = text[: text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in left


@pytest.mark.parametrize(
    "name", [n for n in K.CATALOG if K.CATALOG[n].sql and not n.startswith(("job_", "stream_", "train_", "tune", "model_"))]
)
def test_no_python_in_the_data_path(spark, sf, name):
    text = plan(K.CATALOG[name].run(spark, sf))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_provider_tables_are_planned_by_their_size(spark, sf):
    from ringlens.operators.calls import with_providers
    from ringlens.sources.providers import provider_dimension

    large = provider_dimension(spark, {f"n{i}": [f"{i:05d}"] for i in range(50_000)})
    assert large.count() == 50_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        text = plan(with_providers(K.cleaned(spark, sf), large))
        assert "BroadcastHashJoin" not in text and "CartesianProduct" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_are_counted_once(spark, sf):
    from ringlens.operators.skew import find_heavy

    calls = spark.createDataFrame([(i % 3,) for i in range(30)], "k int")
    assert sorted(r.k for r in find_heavy(calls, "k", 5).keys.collect()) == [0, 1, 2]
    assert find_heavy(calls, "k", 10).keys is None


def test_heavy_reports_are_not_ordered_in_one_task(spark, sf):
    """No window takes a report, or a report and member, as a whole."""
    import re

    from ringlens.operators.calls import clean_calls, mark_calls
    from ringlens.operators.sequences import layered_metrics

    text = plan(layered_metrics(mark_calls(clean_calls(K.call_history(spark, sf)), K.providers(spark))))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", text)
    assert windows and all("_range" in keys or "second" in keys for keys in windows)
