"""The aggregates of a reporter as the sum of its days, so that a sliding window need not read its calls again.

A day is described once, from its own calls:

* ``reports``: per report and day the plain sums, redials inside the day, and its first and last call;
* ``sequences``: per report, member (null: all members) and kind (all calls, outgoing, incoming) the first and
  last second of the day and how often each gap occurs inside it.

A window keeps the same facts for all its days: per report and per sequence the list of its days, at most one entry
per day, and per sequence the number of times each gap occurs. Whole numbers add up and can be taken away again, so
moving a window means adding the days that enter it and taking away those that leave. What lies between two days (the
gap and the redial from one to the next) is never stored: it follows from the ends of neighbouring days.

All groups are bounded whatever a report's number of calls: a sequence has at most 86,400 seconds a day, some 415
different gaps inside a day, and one entry per day in a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.config import FeatureConfig
from ringlens.functions.timing import day_number
from ringlens.operators.calls import expand_calls, with_direction
from ringlens.operators.features import ZERO_WHEN_MISSING
from ringlens.operators.sequences import HOUR
from ringlens.session import stored

SEQUENCE = ["report", "phone_member", "kind"]

#: Sums of a day; means are kept as a sum and the number of values.
SUMS = {
    "in_contact": "in_contact",
    "duration": "duration",
    "duration_call_to": "duration_call_to",
    "duration_call_in": "duration_call_in",
    "same_network": "same_network",
    "in_hour": "in_hour",
    "not_in_hour": "not_in_hour",
    "success": "success",
    "call_to": "call_to",
    "call_in": "call_in",
    "call_to_miss": "call_to_miss",
    "call_in_miss": "call_in_miss",
}
FLAGS = ["same_network", "in_hour", "not_in_hour", "success"]
AVERAGED = {"in_contact": "avg_in_contact", "same_network": "same_network", "success": "avg_success"}


@dataclass(frozen=True)
class DayState:
    """Facts of single days: one row per report and day, one per sequence and day."""

    reports: DataFrame
    sequences: DataFrame

    def of_days(self, days: Sequence[int]) -> DayState:
        return DayState(*[part.where(F.col("day").isin(list(days))) for part in (self.reports, self.sequences)])

    def union(self, other: DayState) -> DayState:
        return DayState(self.reports.unionByName(other.reports), self.sequences.unionByName(other.sequences))


@dataclass(frozen=True)
class WindowState:
    """Facts of all days of a window: one row per report, per sequence, and per sequence and gap."""

    reports: DataFrame
    ends: DataFrame
    gaps: DataFrame


def describe_days(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DayState:
    """The days that occur in marked calls. Pre-aggregated before each shuffle; no window holds more than a day."""
    directed = expand_calls(with_direction(marked, config), config).withColumn("day", day_number(F.col("second")))
    numbers = {name: F.col(name).cast("int") if name in FLAGS else F.col(name) for name in SUMS}
    sums = directed.groupBy("report", "day").agg(
        *[F.sum(value).alias(name) for name, value in numbers.items()],
        *[F.count(numbers[name]).alias(f"n_{name}") for name in AVERAGED],
        F.max("Spam").alias("Spam"),
        F.min("second").alias("first"),
        F.max("second").alias("last"),
    )
    instants = stored(
        directed.groupBy("report", "phone_member", "day", "second", "time").agg(
            F.sum(F.col("outgoing").cast("bigint")).alias("gap_to"),
            F.sum((~F.col("outgoing")).cast("bigint")).alias("gap_in"),
        ),
        "day-instants",
    )
    # No report and day lacks redials, so the join keeps every row.
    return DayState(sums.join(_redials(instants), ["report", "day"]), _sequences(instants))


def _redials(instants: DataFrame) -> DataFrame:
    """Calls that follow one with the same member on the same day, and the day's first and last member.

    Calls of one instant are ordered by member, so its smallest and largest
    member and the number of calls say everything about it.
    """
    described = instants.groupBy("report", "day", "second", "time").agg(
        (F.sum(F.col("gap_to") + F.col("gap_in")) - F.count(F.lit(1))).alias("redials"),
        F.min("phone_member").alias("first_member"),
        F.max("phone_member").alias("last_member"),
    )

    def joined(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        previous = F.lag("last_member").over(W.partitionBy(*keys).orderBy(order))
        again = F.coalesce(previous == F.col("first_member"), F.lit(False)).cast("int")
        return (
            rows.withColumn("redials", F.col("redials") + again)
            .groupBy(*keys)
            .agg(
                F.sum("redials").alias("redials"),
                F.min_by("first_member", order).alias("first_member"),
                F.max_by("last_member", order).alias("last_member"),
            )
        )

    return joined(joined(described, ["report", "day", "second"], "time"), ["report", "day"], "second")


def _sequences(instants: DataFrame) -> DataFrame:
    """Ends and counted gaps of every sequence and day; a second with n calls holds n - 1 gaps of zero."""
    member = F.col("phone_member")
    nobody = F.lit(None).cast("string")
    entries = [
        F.struct(who.alias("phone_member"), F.lit(kind).alias("kind"), calls.cast("bigint").alias("calls"))
        for who, kind, calls in (
            (nobody, "gap", F.col("gap_to") + F.col("gap_in")),
            (nobody, "gap_to", F.col("gap_to")),
            (nobody, "gap_in", F.col("gap_in")),
            (member, "gap_to", F.col("gap_to")),
            (member, "gap_in", F.col("gap_in")),
        )
    ]
    keys = [*SEQUENCE, "day"]
    seconds = (
        instants.select("report", "day", "second", F.inline(F.array(*entries)))
        .where("calls > 0")
        .groupBy(*keys, "second")
        .agg(F.sum("calls").alias("calls"))
    )
    linked = seconds.withColumn("previous", F.lag("second").over(W.partitionBy(*keys).orderBy("second")))
    one = F.lit(1).cast("bigint")
    gap = [
        F.struct((F.col("second") - F.col("previous")).alias("value"), one.alias("times")),
        F.struct(F.lit(0).cast("bigint").alias("value"), (F.col("calls") - 1).alias("times")),
    ]
    counted = (
        linked.select(*keys, "second", F.inline(F.array(*gap)))
        .groupBy(*keys, "value")
        .agg(F.sum("times").alias("times"), F.min("second").alias("first"), F.max("second").alias("last"))
    )
    kept = F.when(F.col("value").isNotNull() & (F.col("times") > 0), F.struct("value", "times"))
    return counted.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.collect_list(kept).alias("gaps")
    )


def _listed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The days of a key in one ordered list; a window has one row per key and day."""
    facts = [name for name in rows.columns if name not in (*keys, "day")]
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("day", *facts))).alias("days"))


def _counted_gaps(sequences: DataFrame, sign: int) -> DataFrame:
    return sequences.select(*SEQUENCE, F.inline("gaps")).withColumn("times", F.col("times") * sign)


def open_window(days: DayState) -> WindowState:
    """A window over the given days, each of which is given once."""
    return WindowState(
        _listed(days.reports, ["report"]),
        _listed(days.sequences.drop("gaps"), SEQUENCE),
        _counted_gaps(days.sequences, 1).groupBy(*SEQUENCE, "value").agg(F.sum("times").alias("times")),
    )


def move_window(window: WindowState, leaving: DayState, left: Sequence[int], entering: DayState) -> WindowState:
    """The window without the days ``left``, whose states are ``leaving``, and with those of ``entering``.

    A day that is described anew, since calls arrived late, leaves with its old
    state and enters with its new one.
    """

    def relisted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
        kept = old.select(*keys, F.inline("days")).where(~F.col("day").isin(list(left)))
        return _listed(kept.unionByName(new), keys)

    gaps = [window.gaps, _counted_gaps(entering.sequences, 1), _counted_gaps(leaving.sequences, -1)]
    return WindowState(
        relisted(window.reports, entering.reports, ["report"]),
        relisted(window.ends, entering.sequences.drop("gaps"), SEQUENCE),
        reduce(DataFrame.unionByName, gaps)
        .groupBy(*SEQUENCE, "value")
        .agg(F.sum("times").alias("times"))
        .where("times <> 0"),  # a negative count would mean that a day left which had not been in; medians refuse it
    )


def _medians(window: WindowState) -> DataFrame:
    """Medians of the gaps and numbers of members by report."""
    # One row per gap between neighbouring days, and one without a value for the sequence itself.
    between = F.zip_with(
        F.expr("slice(days, 1, size(days) - 1)"),
        F.expr("slice(days, 2, size(days))"),
        lambda before, after: after["first"] - before["last"],
    )
    nothing = F.array(F.lit(None).cast("bigint"))
    borders = window.ends.select(*SEQUENCE, F.explode(F.concat(nothing, between)).alias("value")).withColumn(
        "times", F.when(F.col("value").isNull(), 0).otherwise(1).cast("bigint")
    )
    medians = (
        window.gaps.select(*SEQUENCE, "value", "times")
        .unionByName(borders)
        .groupBy(*SEQUENCE, "value")
        .agg(F.sum("times").alias("times"))
        .groupBy(*SEQUENCE)
        .agg(F.expr("percentile(value, 0.5, times)").alias("median"))
    )

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("median")))

    def met(kind: str) -> Column:
        return F.max((F.col("kind") == kind).cast("int"))

    members = medians.groupBy("report", "phone_member").agg(
        of("gap").alias("gap"), of("gap_to").alias("gap_to"), of("gap_in").alias("gap_in"),
        met("gap_to").alias("to"), met("gap_in").alias("back"),
    )
    everyone, someone = F.col("phone_member").isNull(), F.col("phone_member").isNotNull()
    return members.groupBy("report").agg(
        (F.max(F.when(everyone, F.col("gap"))) / HOUR).alias("frequency"),
        (F.max(F.when(everyone, F.col("gap_to"))) / HOUR).alias("total_frequency_to"),
        (F.max(F.when(everyone, F.col("gap_in"))) / HOUR).alias("total_frequency_in"),
        (F.sum(F.when(someone, F.col("gap_to"))) / HOUR).alias("total_frequency_to_by_phonemember"),
        (F.sum(F.when(someone, F.col("gap_in"))) / HOUR).alias("total_frequency_in_by_phonemember"),
        F.count(F.when(someone, 1)).alias("total_contacted"),
        F.sum(F.when(someone, F.col("to"))).alias("total_contacted_to"),
        F.sum(F.when(someone, F.col("back"))).alias("total_contacted_in"),
    )


def _day_sums(window: WindowState) -> DataFrame:
    """Sums, means, time span and redials by report; the days of a report lie in one row, so they are added before the shuffle."""
    again = F.zip_with(
        F.expr("slice(days, 1, size(days) - 1)"),
        F.expr("slice(days, 2, size(days))"),
        lambda before, after: (before["last_member"] == after["first_member"]).cast("bigint"),
    )
    across = F.aggregate(again, F.lit(0).cast("bigint"), lambda total, x: total + x)
    days = window.reports.select("report", across.alias("_across"), F.inline("days"))
    return days.groupBy("report").agg(
        *[F.sum(name).alias(name) for name in SUMS if name not in AVERAGED],
        *[(F.sum(name) / F.sum(f"n_{name}")).alias(target) for name, target in AVERAGED.items()],
        F.max("Spam").alias("Spam"),
        ((F.max("last") - F.min("first")) / HOUR).alias("time_join"),
        (F.sum("redials") + F.max("_across")).alias("total_redial"),
        (F.sum(F.col("call_to") + F.col("call_in")) / F.count(F.lit(1))).alias("mean_call_by_day"),
    )


def window_aggregates(window: WindowState) -> DataFrame:
    """What ``features.report_aggregates`` gives for the calls of the window's days.

    Equal to the last bit as long as durations are whole seconds: sums of
    fractions depend on the order in which they are added in either plan.
    """
    merged = _day_sums(window).join(_medians(window), "report")
    return merged.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in ZERO_WHEN_MISSING})
