"""Three-class labels from the summary of user reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens import constants
from ringlens.config import LabelRules
from ringlens.functions.conversions import numeric_or_null

COUNTS = ["total_reports", "spam_reports", "ham_reports", "unique_spam_members", "unique_ham_members"]


def filled_counts(summary: DataFrame) -> DataFrame:
    """Counts without gaps; ham falls back to the not-spam count and the total to spam plus ham."""
    df = summary
    if "ham_reports" not in df.columns and "not_spam_reports" in df.columns:
        df = df.withColumn("ham_reports", F.col("not_spam_reports"))
    kinds = {field.name: field.dataType for field in df.schema.fields}
    df = df.withColumns(
        {
            name: F.coalesce(numeric_or_null(F.col(name), kinds[name]), F.lit(0.0)).cast("bigint")
            for name in COUNTS
            if name in kinds
        }
    )
    if "total_reports" not in df.columns:
        df = df.withColumn("total_reports", F.col("spam_reports") + F.col("ham_reports"))
    return df


def label_thresholds(counted: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """One row with the report counts that mean high volume.

    The exact quantile runs over value counts: the counts of n reports take at
    most sqrt(2 n) different values, so the final buffer stays small.
    """

    def volume(name: str) -> Column:
        quantile = F.expr(f"percentile(if(kind = '{name}', value, null), {rules.volume_quantile}D, phones)")
        phones = F.sum(F.when(F.col("kind") == name, F.col("phones")))
        high = F.greatest(F.lit(rules.volume_floor), F.rint(quantile).cast("int"))
        return F.when(phones >= rules.volume_min_phones, high).otherwise(F.lit(rules.volume_floor))

    values = counted.select(
        F.inline(
            F.array(
                F.struct(F.lit("spam").alias("kind"), F.col("spam_reports").alias("value")),
                F.struct(F.lit("ham").alias("kind"), F.col("ham_reports").alias("value")),
            )
        )
    )
    return (
        values.groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("phones"))
        .agg(volume("spam").alias("spam_high"), volume("ham").alias("ham_high"))
    )


def _number(value: float) -> str:
    return repr(float(value))


def label_feedback(summary: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Adds rates, label (1 spam, 0 ham, -1 unknown), rule, confidence and note; the first rule that fits wins.

    The volume limits come from all phones, so the summary is read twice:
    pass a written table rather than a long lineage when it is large.
    """
    counted = filled_counts(summary)
    total, spam, ham = F.col("total_reports"), F.col("spam_reports"), F.col("ham_reports")
    spam_members, ham_members = F.col("unique_spam_members"), F.col("unique_ham_members")

    def rate(part: Column) -> Column:
        return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))

    def outcome(label: int, rule: str, confidence: str, note: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            F.lit(rule).alias("rule_id"),
            F.lit(confidence).alias("confidence"),
            note.alias("rule_note"),
        )

    def noted(template: str, value: Column) -> Column:
        before, after = template.split("{}")
        return F.concat(F.lit(before), value.cast("string"), F.lit(after))

    spam_note = constants.NOTE_SPAM_STRONG.format(
        rules.strong_total, rules.spam_members, rules.spam_reports, _number(rules.spam_rate)
    )
    ham_note = constants.NOTE_HAM_STRONG.format(
        rules.strong_total, rules.ham_members, rules.ham_reports, _number(rules.ham_rate)
    )
    verdict = (
        F.when(
            (total >= rules.strong_total)
            & (spam_members >= rules.spam_members)
            & (spam >= rules.spam_reports)
            & (F.col("spam_rate") >= rules.spam_rate),
            outcome(1, "SPAM_CONSENSUS_STRONG", "high", F.lit(spam_note)),
        )
        .when(
            (spam_members >= 2) & (spam >= F.col("spam_high")) & (F.col("spam_rate") >= 0.60),
            outcome(1, "SPAM_VOLUME_HI", "medium", noted(constants.NOTE_SPAM_VOLUME, F.col("spam_high"))),
        )
        .when(
            (total >= rules.strong_total)
            & (ham_members >= rules.ham_members)
            & (ham >= rules.ham_reports)
            & (F.col("ham_rate") >= rules.ham_rate)
            & (spam <= 1),
            outcome(0, "HAM_CONSENSUS_STRONG", "high", F.lit(ham_note)),
        )
        .when(
            (ham_members >= 2) & (ham >= F.col("ham_high")) & (F.col("ham_rate") >= 0.60) & (spam == 0),
            outcome(0, "HAM_VOLUME_HI", "medium", noted(constants.NOTE_HAM_VOLUME, F.col("ham_high"))),
        )
        .when(
            ((spam > 0) & (ham > 0)) | (total < 3) | (spam_members + ham_members < 2),
            outcome(-1, "REVIEW_CONFLICT_OR_LOW_EVID", "low", F.lit("")),
        )
        .otherwise(outcome(-1, "unknown", "", F.lit("")))
    )
    limits = label_thresholds(counted, rules).select(F.struct("spam_high", "ham_high")).scalar()
    return (
        counted.withColumns({"spam_rate": rate(spam), "ham_rate": rate(ham), "_limits": limits})
        .withColumns({name: F.col("_limits")[name] for name in ("spam_high", "ham_high")})
        .withColumn("_verdict", verdict)
        .select(*counted.columns, "spam_rate", "ham_rate", "_verdict.*")
    )
