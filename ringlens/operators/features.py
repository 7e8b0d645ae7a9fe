"""The 45 behavioural features of a reporter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.config import FeatureConfig
from ringlens.functions.conversions import ratio, round_half_even
from ringlens.operators.calls import clean_calls, expand_calls, mark_calls, with_direction
from ringlens.operators.sequences import layered_metrics, ordered_metrics
from ringlens.operators.skew import HeavyKeys, find_heavy, split_heavy
from ringlens.session import stored

ZERO_WHEN_MISSING = [
    "frequency", "total_frequency_to", "total_frequency_in", "total_frequency_to_by_phonemember",
    "total_frequency_in_by_phonemember", "time_join", "total_redial", "total_contacted",
    "total_contacted_to", "total_contacted_in", "mean_call_by_day",
]
COUNTS = [
    "in_hour", "not_in_hour", "call_to", "call_in", "call_to_miss", "call_in_miss", "total_redial",
    "total_contacted", "total_contacted_to", "total_contacted_in", "Spam",
]
PASSED = [
    "avg_in_contact", "same_network", "avg_success", "frequency", "total_frequency_to",
    "total_frequency_in", "total_frequency_to_by_phonemember", "total_frequency_in_by_phonemember",
    "time_join", "mean_call_by_day",
]
DURATIONS = ["duration", "duration_call_to", "duration_call_in"]


def heavy_reports(calls: DataFrame, config: FeatureConfig = FeatureConfig()) -> HeavyKeys:
    """Reporters with too many calls for one window; counted on raw rows, which reads one column."""
    return find_heavy(calls.select(F.col("report").cast("string").alias("report")), "report", config.heavy_rows)


def marked_calls(
    calls: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    return mark_calls(clean_calls(calls, config), providers, config).drop("phone")


def directed_calls(
    calls: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Calls with every derived column, for blocks that need no order."""
    return expand_calls(with_direction(marked_calls(calls, providers, config), config), config)


def report_aggregates(
    calls: DataFrame,
    providers: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """One row per report with every aggregate; selecting some of them prunes the rest from the plan.

    Without heavy reports this is a single pass over the calls. The calls of
    heavy reports, if any, are stored because their plan reads them several times.
    """
    marks = heavy_reports(calls, config) if heavy is None else heavy
    marked = marked_calls(calls, providers, config)
    if marks.keys is None:
        merged = ordered_metrics(marked, config)
    else:
        usual, hot = split_heavy(marked, "report", marks.keys)
        layered = layered_metrics(stored(hot, "heavy-calls"), config)
        merged = ordered_metrics(usual, config).unionByName(layered)
    return merged.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in ZERO_WHEN_MISSING})


def derive_features(aggregates: DataFrame) -> DataFrame:
    """Ratios and products of the aggregates; several names differ from what they hold, as the model expects."""
    c = F.col
    every = c("call_to") + c("call_in") + c("call_to_miss") + c("call_in_miss")
    missed = c("call_in_miss") + c("call_to_miss")
    rate: dict[str, Column] = {
        f"{name}_rate": ratio(c(name), every) for name in ("call_to", "call_in", "call_to_miss", "call_in_miss")
    }
    busy = c("frequency") * c("in_hour")
    talk = busy * c("duration_call_to")
    inbound = ratio(c("call_in") + c("call_in_miss"), c("call_to") + c("call_in_miss") + 1)
    return aggregates.select(
        "report",
        *[c(name) for name in PASSED],
        *[round_half_even(c(name), "bigint").alias(name) for name in DURATIONS],
        *[c(name).cast("int").alias(name) for name in COUNTS],
        *[column.alias(name) for name, column in rate.items()],
        ratio(c("call_to"), c("call_in")).alias("callto_callin"),
        ratio(c("call_to_miss"), c("call_in")).alias("call_back_rate"),
        ratio(c("call_to") + c("call_in"), missed).alias("call_miss"),
        every.alias("sum_call"),
        ratio(c("duration_call_to"), c("call_to")).alias("avg_duration_call_to"),
        ratio(c("duration_call_in"), c("call_in")).alias("avg_duration_call_in"),
        (c("call_to") * c("frequency")).alias("call_to_miss_mul_frequency"),
        (c("duration_call_to") / (c("duration_call_to") + c("duration_call_in") + 1)).alias(
            "duration_call_to_rate"
        ),
        (c("call_to") * c("avg_in_contact")).alias("call_to_mul_in_contact"),
        (c("call_to") * c("avg_success")).alias("call_to_mul_success"),
        busy.alias("frequency_mul_in_hour"),
        (rate["call_in_miss_rate"] * busy).alias("call_to_miss_frequency_in_hour"),
        inbound.alias("call_in_div_call_to"),
        (inbound * c("in_hour")).alias("call_in_div_call_to_mul_in_hour"),
        (rate["call_to_miss_rate"] * c("duration_call_to")).alias("call_to_miss_rate_mul_duration_call_to"),
        talk.alias("frequency_in_hour_mul_duration_call_to"),
        (c("in_hour") * c("avg_success")).alias("in_hour_mul_avg_success"),
        (talk * inbound).alias("call_in_div_call_to_mul_in_hour_mul_avg_success"),
    )


def report_features(
    calls: DataFrame,
    providers: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Call history to one row of features per report."""
    return derive_features(report_aggregates(calls, providers, config, heavy))
