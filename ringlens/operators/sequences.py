"""Per-reporter aggregates that depend on the order of calls.

Two plans give the same rows:

* ``ordered_metrics`` sorts all calls of a reporter in one task. One shuffle,
  no join; used for reporters whose number of calls is known to be moderate.
* ``layered_metrics`` never puts the calls of one reporter together. It first
  collapses calls to seconds (partial aggregation before each shuffle), orders
  the seconds of a day together, and hands one row per day on to the next, so
  the longest window has 86,400 rows, whatever the number of calls and the
  length of the history. Used for the few reporters above ``heavy_rows``.

Call gaps are whole non-negative seconds that add up to at most the length T of
the history, so one sequence has at most sqrt(2 T) different gaps (about 4,000
in 90 days): the value-count buffers of the exact medians stay that small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.config import FeatureConfig
from ringlens.functions.timing import day_number
from ringlens.operators.calls import expand_calls, with_direction
from ringlens.session import stored

HOUR = 3600.0

ADDITIVE = {
    "avg_in_contact": lambda: F.avg("in_contact"),
    "same_network": lambda: F.avg(F.col("same_network").cast("int")),
    "duration": lambda: F.sum("duration"),
    "duration_call_to": lambda: F.sum("duration_call_to"),
    "duration_call_in": lambda: F.sum("duration_call_in"),
    "in_hour": lambda: F.sum(F.col("in_hour").cast("int")),
    "not_in_hour": lambda: F.sum(F.col("not_in_hour").cast("int")),
    "avg_success": lambda: F.avg(F.col("success").cast("int")),
    "call_to": lambda: F.sum("call_to"),
    "call_in": lambda: F.sum("call_in"),
    "call_to_miss": lambda: F.sum("call_to_miss"),
    "call_in_miss": lambda: F.sum("call_in_miss"),
    "Spam": lambda: F.max("Spam"),
    "time_join": lambda: (F.max("second") - F.min("second")) / HOUR,
}


def additive_metrics() -> list[Column]:
    return [build().alias(name) for name, build in ADDITIVE.items()]


def call_gaps(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Adds seconds since the previous call, overall, in the same direction and with the same member.

    All windows need the same hash partitioning by report, so they share one
    shuffle and differ only in the sort within a partition; the last two also
    share the sort. The shuffle is stated here so that derived columns are
    computed after it.
    """
    directed = with_direction(marked.repartition("report"), config)
    calls = W.partitionBy("report").orderBy("time", "phone_member", "type", "duration")
    members = W.partitionBy("report", "phone_member").orderBy("outgoing", "time", "type", "duration")
    ways = W.partitionBy("report", "phone_member", "outgoing").orderBy("time", "type", "duration")
    second, outgoing = F.col("second"), F.col("outgoing")

    def since(mine: Column) -> Column:
        """Gap to the closest earlier call for which ``mine`` holds."""
        earlier = calls.rowsBetween(W.unboundedPreceding, -1)
        return F.when(mine, second - F.last(F.when(mine, second), ignorenulls=True).over(earlier))

    return directed.withColumns(
        {
            "gap": second - F.lag("second").over(calls),
            "gap_to": since(outgoing),
            "gap_in": since(~outgoing),
            "previous_member": F.lag("phone_member").over(calls),
            "previous_second": F.lag("second").over(calls),
        }
    ).withColumns(
        {
            "member_call": F.row_number().over(members),
            "member_gap": second - F.lag("second").over(ways),
        }
    )


def ordered_metrics(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """All aggregates by report in a single pass over its ordered calls.

    The median gap of every member and direction is read off the rank of the
    gaps: the middle one counts fully, or two middle ones count half each, so
    the sum over members needs no grouping by member.
    """
    outgoing = F.col("outgoing")
    ranked = W.partitionBy("report", "phone_member", "outgoing").orderBy(F.asc_nulls_last("member_gap"))
    whole = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    twice, gaps = 2 * F.col("_rank"), F.col("_gaps")
    rows = (
        call_gaps(marked, config)
        .withColumns({"_rank": F.row_number().over(ranked), "_gaps": F.count("member_gap").over(whole)})
        .withColumn(
            "member_median",
            F.when(twice == gaps + 1, F.col("member_gap").cast("double")).when(
                (twice == gaps) | (twice == gaps + 2), F.col("member_gap") / 2
            ),
        )
    )

    def count_if(condition: Column) -> Column:
        return F.sum(F.coalesce(condition, F.lit(False)).cast("int"))

    first_contact = F.col("member_gap").isNull()
    new_day = ~day_number(F.col("second")).eqNullSafe(day_number(F.col("previous_second")))
    return expand_calls(rows, config).groupBy("report").agg(
        *additive_metrics(),
        (F.median("gap") / HOUR).alias("frequency"),
        (F.median("gap_to") / HOUR).alias("total_frequency_to"),
        (F.median("gap_in") / HOUR).alias("total_frequency_in"),
        (F.sum(F.when(outgoing, F.col("member_median"))) / HOUR).alias("total_frequency_to_by_phonemember"),
        (F.sum(F.when(~outgoing, F.col("member_median"))) / HOUR).alias("total_frequency_in_by_phonemember"),
        count_if(F.col("phone_member") == F.col("previous_member")).alias("total_redial"),
        count_if(F.col("member_call") == 1).alias("total_contacted"),
        count_if(outgoing & first_contact).alias("total_contacted_to"),
        count_if(~outgoing & first_contact).alias("total_contacted_in"),
        # Answered calls per active day: the mean over days of a sum is the sum over the number of days.
        (F.sum(F.col("call_to") + F.col("call_in")) / count_if(new_day)).alias("mean_call_by_day"),
    )


#: Seconds of one range in which the rows of a heavy sequence are ordered together.
RANGE_SECONDS = 86_400


def previous_across_ranges(
    rows: DataFrame, keys: list[str], order: str, values: dict[str, Column], span: int = RANGE_SECONDS
) -> DataFrame:
    """Adds for each name the latest earlier value of a sequence that is not null, without sorting the sequence in one task.

    ``order`` is a whole number that is different in all rows of a sequence.
    Rows are ordered inside ranges of ``span``; what a range hands on is one row
    per range, and a sequence has as many of these as its history has ranges.
    A range without a value hands on what it was handed.
    """
    names = list(values)
    ranged = rows.withColumns({"_range": F.floor(F.col(order) / span), **{f"_value_{n}": values[n] for n in names}})
    inside = W.partitionBy(*keys, "_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    handed = (
        ranged.groupBy(*keys, "_range")
        .agg(*[F.expr(f"max_by(_value_{n}, if(_value_{n} is null, null, `{order}`))").alias(n) for n in names])
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_range", *names))).alias("_list"))
    )
    earlier = ", ".join(
        f"try_element_at(filter(slice(_list, 1, i), y -> y.`{n}` is not null), -1).`{n}` AS `_handed_{n}`" for n in names
    )
    handed = handed.select(
        *[F.col(key).alias(f"_key_{key}") for key in keys],
        F.inline(F.expr(f"transform(_list, (x, i) -> struct(x._range AS _to, {earlier}))")),
    )
    same = reduce(lambda x, y: x & y, [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys])
    joined = ranged.withColumns(
        {f"_near_{n}": F.last(f"_value_{n}", ignorenulls=True).over(inside) for n in names}
    ).join(handed, same & (F.col("_range") == F.col("_to")))
    return joined.select(*rows.columns, *[F.coalesce(f"_near_{n}", f"_handed_{n}").alias(n) for n in names])


def _weighted_gaps(seconds: DataFrame, keys: list[str]) -> DataFrame:
    """Medians of the gaps of a sequence given as (second, calls, calls_to, calls_in) rows.

    A second with n calls stands for n - 1 gaps of zero and one gap back to the
    previous second in which the sequence has a call.
    """
    kinds = {"gap": "calls", "gap_to": "calls_to", "gap_in": "calls_in"}
    kept = {name: count for name, count in kinds.items() if count in seconds.columns}

    def entry(name: str, value: Column, times: Column, condition: Column) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(name).alias("kind"), value.cast("bigint").alias("value"), times.alias("times")),
        )

    one = F.lit(1).cast("bigint")
    linked = previous_across_ranges(
        seconds, keys, "second", {f"_{name}": F.when(F.col(count) > 0, F.col("second")) for name, count in kept.items()}
    )
    entries = [
        item
        for name, count in kept.items()
        for item in (
            entry(name, F.lit(0), F.col(count) - 1, F.col(count) > 1),
            entry(name, F.col("second") - F.col(f"_{name}"), one, (F.col(count) > 0) & F.col(f"_{name}").isNotNull()),
        )
    ]
    long = linked.select(*keys, F.inline(F.array_compact(F.array(*entries))))
    counted = long.groupBy(*keys, "kind", "value").agg(F.sum("times").alias("times"))
    return counted.groupBy(*keys).agg(
        *[
            F.expr(f"percentile(if(kind = '{name}', value, null), 0.5, times)").alias(name)
            for name in kept
        ]
    )


def _layered_redials(instants: DataFrame) -> DataFrame:
    """Consecutive calls with the same member, from (report, second, time, member, calls_to, calls_in) rows.

    Calls at one instant are ordered by member, so an instant is described by
    its number of calls and members and its smallest and largest member. A
    second holds at most a million instants and a history one row per second.
    """
    described = instants.groupBy("report", "second", "time").agg(
        (F.sum(F.col("calls_to") + F.col("calls_in")) - F.count(F.lit(1))).alias("redials"),
        F.min("phone_member").alias("first_member"),
        F.max("phone_member").alias("last_member"),
    )

    def chained(previous: Column) -> Column:
        return F.col("redials") + F.coalesce(previous == F.col("first_member"), F.lit(False)).cast("int")

    within = F.lag("last_member").over(W.partitionBy("report", "second").orderBy("time"))
    seconds = (
        described.select("*", chained(within).alias("linked"))
        .groupBy("report", "second")
        .agg(
            F.sum("linked").alias("redials"),
            F.min(F.struct("time", "first_member"))["first_member"].alias("first_member"),
            F.max(F.struct("time", "last_member"))["last_member"].alias("last_member"),
        )
    )
    # A second without a member hides the one before it, so seconds are handed on rather than members.
    linked = previous_across_ranges(seconds, ["report"], "second", {"previous": F.struct("last_member")})
    return (
        linked.select("report", chained(F.col("previous.last_member")).alias("linked"))
        .groupBy("report")
        .agg(F.sum("linked").alias("total_redial"))
    )


def base_metrics(directed: DataFrame) -> DataFrame:
    """Sums, means and the time span by report; aggregated before the shuffle, so skew does not matter."""
    return directed.groupBy("report").agg(*additive_metrics())


def contacts(directed: DataFrame) -> DataFrame:
    """Distinct members by report, overall and per direction, through one row per report and member."""
    return _contacted(directed, F.col("outgoing"), ~F.col("outgoing"))


def _contacted(rows: DataFrame, to: Column, back: Column) -> DataFrame:
    return (
        rows.groupBy("report", "phone_member")
        .agg(F.max(to.cast("int")).alias("to"), F.max(back.cast("int")).alias("in"))
        .groupBy("report")
        .agg(
            F.count(F.lit(1)).alias("total_contacted"),
            F.sum("to").alias("total_contacted_to"),
            F.sum("in").alias("total_contacted_in"),
        )
    )


def daily_mean(directed: DataFrame) -> DataFrame:
    """Mean number of answered calls over the days on which a report has calls."""
    return _answered_per_day(directed, F.col("call_to") + F.col("call_in"))


def _answered_per_day(rows: DataFrame, answered: Column) -> DataFrame:
    return (
        rows.groupBy("report", day_number(F.col("second")).alias("day"))
        .agg(F.sum(answered).alias("answered"))
        .groupBy("report")
        .agg(F.avg("answered").alias("mean_call_by_day"))
    )


def layered_metrics(marked: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The aggregates of ``ordered_metrics`` with every group bounded; meant for few, very large reports.

    The calls are read twice: for the sums, and for one stored aggregate per
    report, member and instant, from which all other blocks follow.
    """
    directed = expand_calls(with_direction(marked, config), config)
    outgoing = F.col("outgoing")
    sums = base_metrics(directed)
    instants = stored(
        directed.groupBy("report", "phone_member", "second", "time").agg(
            F.sum(outgoing.cast("bigint")).alias("calls_to"),
            F.sum((~outgoing).cast("bigint")).alias("calls_in"),
            F.sum(F.col("call_to") + F.col("call_in")).alias("answered"),
        ),
        "instants",
    )
    counts = [F.sum(name).alias(name) for name in ("calls_to", "calls_in")]
    per_member = instants.groupBy("report", "phone_member", "second").agg(*counts)
    per_second = instants.groupBy("report", "second").agg(
        F.sum(F.col("calls_to") + F.col("calls_in")).alias("calls"), *counts
    )
    gaps = _weighted_gaps(per_second, ["report"]).select(
        "report",
        (F.col("gap") / HOUR).alias("frequency"),
        (F.col("gap_to") / HOUR).alias("total_frequency_to"),
        (F.col("gap_in") / HOUR).alias("total_frequency_in"),
    )
    member_gaps = (
        _weighted_gaps(per_member, ["report", "phone_member"])
        .groupBy("report")
        .agg(
            (F.sum("gap_to") / HOUR).alias("total_frequency_to_by_phonemember"),
            (F.sum("gap_in") / HOUR).alias("total_frequency_in_by_phonemember"),
        )
    )
    met = _contacted(instants, F.col("calls_to") > 0, F.col("calls_in") > 0)
    days = _answered_per_day(instants, F.col("answered"))
    blocks = [gaps, member_gaps, _layered_redials(instants), met, days]
    return reduce(lambda left, right: left.join(right, "report", "left"), blocks, sums)
