"""Cleaning and enriching call records, one row in and at most one row out."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.config import FeatureConfig
from ringlens.functions.conversions import strict_int
from ringlens.functions.phones import DIALABLE, strip_country
from ringlens.functions.timing import epoch_second, naive_time, second_of_day, weekday

HOUR = 3600
FLAGS = ["call_to", "call_in", "call_to_miss", "call_in_miss"]


def clean_calls(calls: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Canonical columns of the rows with every field present, a known type and two dialable numbers.

    Column names are matched without case. The filter is stated on the raw
    columns, so it reaches the scan instead of repeating the conversions.
    """
    kind = {field.name.lower(): field.dataType for field in calls.schema.fields}
    types = (config.out_type, config.in_type, config.out_missed_type, config.in_missed_type)
    call_type = strict_int(F.col("type"), kind["type"])
    time = naive_time(F.col("time"), kind["time"])
    conditions = [
        *[F.col(name).isNotNull() for name in ("report", "in_contact", "duration", "spam")],
        time.isNotNull(),
        call_type.isin(*types),
        *[F.col(name).cast("string").rlike(DIALABLE) for name in ("phone", "phone_member")],
    ]
    return calls.where(reduce(and_, conditions)).select(
        strip_country(F.col("phone")).alias("phone"),
        strip_country(F.col("phone_member")).alias("phone_member"),
        F.col("report").cast("string").alias("report"),
        call_type.alias("type"),
        time.alias("time"),
        F.col("in_contact").cast("double").alias("in_contact"),
        F.col("duration").cast("double").alias("duration"),
        strict_int(F.col("spam"), kind["spam"]).alias("Spam"),
    )


def with_providers(calls: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Adds the network of both parties; unknown prefixes belong to one common group.

    ``providers`` comes from ``provider_dimension``, which keeps its prefixes
    unique. Whether it is broadcast is left to the planner, which sees its size.
    """
    out = calls
    for party, target in (("phone", "caller_provider"), ("phone_member", "receiver_provider")):
        owner = providers.select(F.col("prefix").alias(f"_{target}_prefix"), F.col("provider").alias(target))
        head = F.substring(F.col(party), 1, config.prefix_length)
        out = out.join(owner, head == F.col(f"_{target}_prefix"), "left").drop(f"_{target}_prefix")
        out = out.withColumn(target, F.coalesce(F.col(target), F.lit(config.other_provider)))
    return out


def business_hour(second: Column, config: FeatureConfig) -> Column:
    """Whether an epoch second lies in the office hours of a working day."""
    if not config.work_days:
        return F.lit(False)
    clock = second_of_day(second)
    office = (clock >= config.first_hour * HOUR) & (clock < (config.last_hour + 1) * HOUR)
    return office & weekday(second).isin(*config.work_days)


def mark_calls(
    cleaned: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Adds what needs more than the call itself: same network (lookups) and business hour (settings)."""
    return with_providers(cleaned, providers, config).select(
        "report", "phone", "phone_member", "type", "time", "in_contact", "duration", "Spam",
        (F.col("caller_provider") == F.col("receiver_provider")).alias("same_network"),
        business_hour(epoch_second(F.col("time")), config).alias("in_hour"),
    )


def expand_calls(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Adds the columns that follow from a marked row: cheaper to compute late than to shuffle and sort."""
    kinds = dict(
        zip(FLAGS, (config.out_type, config.in_type, config.out_missed_type, config.in_missed_type), strict=True)
    )
    flags = {name: (F.col("type") == code).cast("int") for name, code in kinds.items()}
    return marked.withColumns(
        {
            **flags,
            "not_in_hour": ~F.col("in_hour"),
            "success": F.col("duration") > config.success_seconds,
            "duration_call_in": F.col("duration") * flags["call_in"],
            "duration_call_to": F.col("duration") * flags["call_to"],
        }
    )


def enrich_calls(
    cleaned: DataFrame, providers: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Same-network, business-hour and success flags, one flag per call type, directional durations."""
    return expand_calls(mark_calls(cleaned, providers, config), config)


def with_direction(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Adds the epoch second and whether the reporter placed the call (answered or not)."""
    return marked.withColumns(
        {
            "second": epoch_second(F.col("time")),
            "outgoing": F.col("type").isin(config.out_type, config.out_missed_type),
        }
    )
