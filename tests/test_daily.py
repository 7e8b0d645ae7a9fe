"""Windows moved over daily states against the features of the same calls."""

from __future__ import annotations

import re
from datetime import date

import pytest
from test_features import SCHEMA, random_calls

from ringlens.config import FeatureConfig
from ringlens.functions.timing import DayWindow
from ringlens.operators.daily import describe_days
from ringlens.operators.features import marked_calls, report_features
from ringlens.session import fresh_path
from ringlens.sources.day_states import DayStates
from ringlens.sources.providers import provider_dimension

PROVIDERS = {"a": ["9700"], "b": ["0912"]}


def inside(calls, window):
    return calls.where(window.contains(calls.time, calls.schema["time"].dataType))


def rows(df, columns):
    return sorted(map(tuple, df.select(columns).collect()))


def assert_same(got, calls, providers, window):
    want = report_features(inside(calls, window), providers)
    assert got.select(want.columns).dtypes == want.dtypes
    assert rows(got, want.columns) == rows(want, want.columns)


def test_moved_windows_equal_the_features_of_their_calls(spark):
    """Forwards, by several days at once, past the data, and back again."""
    calls = spark.createDataFrame(random_calls(11), SCHEMA)
    providers = provider_dimension(spark, PROVIDERS)
    states = DayStates(spark, fresh_path(spark, "states"))
    for end in (3, 4, 6, 8, 4):
        window = DayWindow(date(2024, 1, end), 3)
        assert_same(states.features(calls, providers, window), calls, providers, window)
    assert len(states._log("windows")) == 2


def test_days_described_again_are_exchanged(spark):
    """Calls that arrive late change their day only, and a window that holds it."""
    late = spark.createDataFrame(random_calls(12), SCHEMA)
    early = late.where("second(time) % 3 <> 0")
    providers = provider_dimension(spark, PROVIDERS)
    states = DayStates(spark, fresh_path(spark, "states"))
    window = DayWindow(date(2024, 1, 5), 5)
    assert_same(states.features(early, providers, window), early, providers, window)
    first = (window.start - date(1970, 1, 1)).days
    states.describe(late, providers, [first, first + 3])
    assert set(states.batches()) == set(range(first, first + 5))
    mixed = early.where("day(time) not in (1, 4)").union(late.where("day(time) in (1, 4)"))
    assert_same(states.features(early, providers, window), mixed, providers, window)


def test_an_unfinished_state_is_not_seen(spark, monkeypatch):
    calls = spark.createDataFrame(random_calls(13, 80), SCHEMA)
    providers = provider_dimension(spark, PROVIDERS)
    folder = fresh_path(spark, "states")
    states, window = DayStates(spark, folder), DayWindow(date(2024, 1, 3), 2)

    def killed(name, item):
        raise KeyboardInterrupt

    monkeypatch.setattr(states, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        states.features(calls, providers, window)
    again = DayStates(spark, folder)
    assert again.batches() == {}
    assert_same(again.features(calls, providers, window), calls, providers, window)


def test_states_keep_to_their_configuration_and_days(spark):
    calls = spark.createDataFrame(random_calls(14, 40), SCHEMA)
    providers = provider_dimension(spark, PROVIDERS)
    folder = fresh_path(spark, "states")
    states, window = DayStates(spark, folder), DayWindow(date(2024, 1, 2), 2)
    with pytest.raises(ValueError, match="2 days .* not described"):
        states.move(window)
    states.features(calls, providers, window)
    assert DayStates(spark, folder, FeatureConfig(heavy_rows=3)).batches()
    with pytest.raises(ValueError, match="another configuration"):
        DayStates(spark, folder, FeatureConfig(first_hour=9)).batches()


def test_no_calls_give_no_features(spark):
    calls = spark.createDataFrame([], SCHEMA)
    providers = provider_dimension(spark, PROVIDERS)
    states = DayStates(spark, fresh_path(spark, "states"))
    for end in (2, 3):
        assert states.features(calls, providers, DayWindow(date(2024, 1, end), 2)).count() == 0


def test_moving_reads_only_the_days_that_differ(spark):
    """No day inside both windows is read from the states, and no call."""
    calls = spark.createDataFrame(random_calls(15, 80), SCHEMA)
    providers = provider_dimension(spark, PROVIDERS)
    states = DayStates(spark, fresh_path(spark, "states"))
    states.features(calls, providers, DayWindow(date(2024, 1, 4), 4))
    asked = []
    read = states._days
    states._days = lambda held: asked.append(sorted(day for day, _ in held)) or read(held)
    states.features(calls, providers, DayWindow(date(2024, 1, 5), 4))
    first = (date(2024, 1, 1) - date(1970, 1, 1)).days
    assert asked == [[first], [first + 4]]


def test_no_window_holds_more_than_a_day_of_a_sequence(spark):
    calls = spark.createDataFrame(random_calls(16, 80), SCHEMA)
    state = describe_days(marked_calls(calls, provider_dimension(spark, PROVIDERS)))
    for part in (state.reports, state.sequences):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        keys = re.findall(r"windowspecdefinition\(([^\n]*?) ASC", plan)
        assert keys and all("day#" in key for key in keys)
        assert "Python" not in plan
