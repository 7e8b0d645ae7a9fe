"""Risk level 0 to 4 of a phone from its score, its calls and the shape of its number.

Everything is a Column expression, so the same code serves batch and streams.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens import constants
from ringlens.config import RiskConfig
from ringlens.functions.conversions import double_or, int_or, two_decimals
from ringlens.functions.phones import phone_origin, stripped
from ringlens.operators.skew import HEAVY_ROWS, find_heavy, join_unique

FEATURES = [
    "is_international", "prefix", "total_call", "miss_call", "avg_duration", "frequency_per_day",
    "callback_rate", "mostly_out_of_business_hour", "in_contact", "successful_call_count", "avg_in_duration",
]


def risk_features(pool: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the rules look at, from one row of the phone pool; absent columns count as 0."""
    kinds = {field.name: field.dataType for field in pool.schema.fields}

    def number(name: str) -> Column:
        return double_or(F.col(name), kinds[name]) if name in kinds else F.lit(0.0)

    def whole(name: str) -> Column:
        return int_or(F.col(name), kinds[name]) if name in kinds else F.lit(0).cast("bigint")

    phone = stripped(F.col("phone"))
    origin = phone_origin(F.col("phone"))
    calls = whole("sum_call")
    return pool.select(
        phone.alias("phone"),
        *keep,
        origin["is_international"].alias("is_international"),
        origin["prefix"].alias("prefix"),
        calls.alias("total_call"),
        (whole("call_to_miss") + whole("call_in_miss")).alias("miss_call"),
        F.when(calls > 0, number("duration") / calls).otherwise(F.lit(0.0)).alias("avg_duration"),
        number("mean_call_by_day").alias("frequency_per_day"),
        number("call_back_rate").alias("callback_rate"),
        (number("not_in_hour") > number("in_hour")).alias("mostly_out_of_business_hour"),
        (number("avg_in_contact") > 0.0).alias("in_contact"),
        whole("total_contacted").alias("successful_call_count"),
        number("avg_duration_call_in").alias("avg_in_duration"),
    )


def model_level(score: Column, config: RiskConfig = RiskConfig()) -> Column:
    """Level of the first limit the score stays below, else the last level."""
    last = config.score_levels[-1][1] if config.score_levels else 0
    steps = [F.when(score < F.lit(limit), F.lit(level)) for limit, level in config.score_levels]
    return F.coalesce(*steps, F.when(score.isNotNull(), F.lit(last)))


def _sentence(template: str, *values: Column) -> Column:
    parts = template.split("{}")
    pieces: list[Column] = [F.lit(parts[0])]
    for value, text in zip(values, parts[1:], strict=True):
        pieces += [value.cast("string"), F.lit(text)]
    return F.concat(*pieces)


def _listed_prefixes(config: RiskConfig) -> tuple[Column, Column]:
    """(first domestic prefix that matches, whether the foreign one is risky) by the lists of the settings."""
    phone, prefix = F.col("phone"), F.col("prefix")
    risky = prefix.isin(*config.foreign_prefixes) if config.foreign_prefixes else F.lit(False)
    matches = [
        F.when(prefix.startswith(head) | phone.startswith(head), F.lit(head)) for head in config.domestic_prefixes
    ]
    return F.coalesce(*matches) if matches else F.lit(None).cast("string"), risky


def _signals(config: RiskConfig, prefixes: tuple[Column, Column]) -> list[tuple[Column, int, Column]]:
    """(condition, level, reason) of every behaviour rule, in the order reasons are listed."""
    c = F.col
    prefix, calls, mean = c("prefix"), c("total_call"), c("avg_duration")
    head, risky_foreign = prefixes
    short = (calls >= config.short_min_calls) & (mean < config.short_seconds)
    missed = F.when(calls > 0, c("miss_call") / calls).otherwise(F.lit(0.0))
    return [
        (
            c("is_international") & risky_foreign,
            config.foreign_risky_level,
            _sentence(constants.REASON_FOREIGN_RISKY, prefix),
        ),
        (c("is_international") & ~risky_foreign, config.foreign_level, F.lit(constants.REASON_FOREIGN)),
        (
            head.isNotNull() & short,
            config.prefix_short_level,
            _sentence(constants.REASON_PREFIX_SHORT_CALLS, head),
        ),
        (head.isNotNull() & ~short, config.prefix_level, _sentence(constants.REASON_PREFIX, head)),
        (
            (calls >= config.missed_min_calls) & (missed > config.missed_ratio),
            config.missed_level,
            F.lit(constants.REASON_MISSED),
        ),
        (
            (c("frequency_per_day") >= config.frequent_per_day) & (mean < config.frequent_short_seconds),
            config.frequent_level,
            F.lit(constants.REASON_FREQUENT_SHORT),
        ),
        (
            (c("callback_rate") < config.callback_rate) & (calls >= config.callback_min_calls),
            config.callback_level,
            F.lit(constants.REASON_FEW_CALLBACKS),
        ),
        (c("mostly_out_of_business_hour"), config.out_of_hours_level, F.lit(constants.REASON_OUT_OF_HOURS)),
    ]


def rule_level(
    config: RiskConfig = RiskConfig(), listed: Column | None = None, prefixes: tuple[Column, Column] | None = None
) -> tuple[Column, Column]:
    """(level, reasons) of the rules; a blacklisted phone ends the evaluation with a single reason.

    ``listed`` says whether a phone is blacklisted where that is known from a
    table, ``prefixes`` likewise which domestic prefix matches and whether the
    foreign one is risky; otherwise the short lists of the settings decide.
    """
    signals = _signals(config, prefixes or _listed_prefixes(config))
    if listed is None:
        listed = F.col("phone").isin(*config.blacklist) if config.blacklist else F.lit(False)
    levels = [F.when(condition, F.lit(level)).otherwise(F.lit(0)) for condition, level, _ in signals]
    level = F.when(listed, F.lit(config.blacklist_level)).otherwise(F.greatest(F.lit(0), *levels))
    found = F.array_compact(F.array(*[F.when(condition, reason) for condition, _, reason in signals]))
    reasons = F.when(listed, F.array(F.lit(constants.REASON_BLACKLISTED))).otherwise(found)
    return level, reasons


def trust_credit(config: RiskConfig = RiskConfig()) -> Column:
    """How many levels contacts and a good history take off, as a number not above 0."""
    contact = F.when(F.col("in_contact"), F.lit(-config.contact_credit)).otherwise(F.lit(0))
    good = (F.col("successful_call_count") >= config.history_min_calls) & (
        F.col("avg_in_duration") >= config.history_min_seconds
    )
    return contact + F.when(good, F.lit(-config.history_credit)).otherwise(F.lit(0))


def lowered(level: Column, credit: Column, config: RiskConfig = RiskConfig()) -> Column:
    """Level after the credit, with a floor that is higher for foreign numbers."""
    floor = F.when(F.col("is_international"), F.lit(config.foreign_floor)).otherwise(F.lit(0))
    return F.greatest(floor, level + credit)


def mark_listed(rows: DataFrame, blacklist: DataFrame, mark: str, phone: str = "phone") -> DataFrame:
    """Adds whether a row's phone is on a list of any size: a left join on the phone, whose side is unique."""
    listed = blacklist.select(stripped(F.col(phone)).alias("phone")).distinct().withColumn(mark, F.lit(True))
    return rows.join(listed, "phone", "left").withColumn(mark, F.coalesce(F.col(mark), F.lit(False)))


def mark_prefixes(
    rows: DataFrame, prefixes: DataFrame, first: str, risky: str, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Adds the first domestic prefix that a row's phone or origin starts with, and whether its foreign one is risky.

    ``prefixes`` has ``kind`` (domestic or foreign), ``head`` and ``place``, and
    may have any size. Of the domestic heads that match, the one with the
    smallest place counts, then the smallest head; a foreign head is the whole
    prefix. Each phone meets the table under its own beginnings, up to the
    longest listed head, by equality; beginnings that many phones share
    are joined apart. Null heads are ignored.
    """
    known = prefixes.where(F.col("head").isNotNull())
    domestic, foreign = F.col("kind") == "domestic", F.col("kind") == "foreign"
    rules = known.groupBy("head").agg(
        F.min(F.when(domestic, F.col("place"))).alias("place"),
        F.max(domestic).alias("domestic"),
        F.max(foreign).alias("foreign"),
    )
    longest = F.coalesce(known.select(F.max(F.length("head"))).scalar(), F.lit(0))

    def beginnings(text: str) -> Column:
        sizes = F.sequence(F.lit(0), F.least(F.length(text), "longest"))
        return F.coalesce(F.transform(sizes, lambda size: F.substring(text, F.lit(1), size)), F.array().cast("array<string>"))

    phones = rows.select("phone", "prefix").distinct().withColumn("longest", longest)
    heads = phones.select("phone", "prefix", F.explode(F.array_union(beginnings("phone"), beginnings("prefix"))).alias("head"))
    met = join_unique(heads, rules, "head", find_heavy(heads, "head", heavy_rows))
    found = met.groupBy(F.col("phone").alias("_phone"), F.col("prefix").alias("_prefix")).agg(
        F.min(F.when(F.col("domestic"), F.struct("place", "head")))["head"].alias(first),
        F.max(F.col("foreign") & F.col("head").eqNullSafe(F.col("prefix"))).alias(risky),
    )
    same = F.col("phone").eqNullSafe(F.col("_phone")) & F.col("prefix").eqNullSafe(F.col("_prefix"))
    joined = rows.join(found, same, "left").drop("_phone", "_prefix")
    return joined.withColumn(risky, F.coalesce(F.col(risky), F.lit(False)))


def evaluate_risk(
    rows: DataFrame,
    score: str = "Score",
    config: RiskConfig = RiskConfig(),
    blacklist: DataFrame | None = None,
    prefixes: DataFrame | None = None,
) -> DataFrame:
    """phone, levels, title, subtitle, reasons and the features used, from risk features and a score.

    A ``blacklist`` table (column ``phone``) takes the place of the list in the
    settings, a table of ``prefixes`` (see ``mark_prefixes``) that of the
    settings' two lists; the latter needs a batch.
    """
    listed = marks = None
    if blacklist is not None:
        rows = mark_listed(rows, blacklist, "_listed")
        listed = F.col("_listed")
    if prefixes is not None:
        rows = mark_prefixes(rows, prefixes, "_first", "_risky")
        marks = (F.col("_first"), F.col("_risky"))
    level, reasons = rule_level(config, listed, marks)
    staged = rows.withColumns(
        {
            "model_level": model_level(F.col(score), config),
            "rule_level": level,
            "_reasons": reasons,
            "_credit": trust_credit(config),
        }
    )
    final = lowered(F.greatest("model_level", "rule_level"), F.col("_credit"), config)
    known = F.when(F.col("model_level").isNotNull(), final)
    staged = staged.withColumn("final_level", known)

    def message(part: int) -> Column:
        cases = [F.when(F.col("final_level") == n, F.lit(text[part])) for n, text in config.messages.items()]
        return F.coalesce(*cases, F.lit(constants.UNKNOWN_MESSAGE[part]))

    shown = _sentence(constants.REASON_SCORE, two_decimals(F.col(score)), F.col("model_level"))
    rules_apply = (F.col("rule_level") > 0) | (F.size("_reasons") > 0)
    parts = [
        F.array(shown),
        F.when(
            rules_apply,
            F.concat(F.array(_sentence(constants.REASON_RULE_LEVEL, F.col("rule_level"))), F.col("_reasons")),
        ).otherwise(F.array().cast("array<string>")),
        F.when(F.col("_credit") < 0, F.array(F.lit(constants.REASON_TRUSTED))).otherwise(
            F.array().cast("array<string>")
        ),
    ]
    return staged.select(
        "phone",
        "final_level",
        "model_level",
        "rule_level",
        message(0).alias("title"),
        message(1).alias("subtitle"),
        reduce(lambda a, b: F.concat(a, b), parts).alias("reasons"),
        F.struct(*FEATURES).alias("features_used"),
    )
