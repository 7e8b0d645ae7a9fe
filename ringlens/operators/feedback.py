"""User reports: cleaning and the summary per phone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.functions.conversions import numeric_or_null

# Marks of a caller who is not in the contacts, and of a missing member.
NOT_IN_CONTACTS = ["no", "\\N"]
MISSING_IDS = ["nan", "None", "NaT", ""]


def clean_reports(reports: DataFrame) -> DataFrame:
    """Distinct reports of spam (1) or ham (2) about callers who are not contacts.

    ``device_report`` becomes an integer; missing member marks become NULL.
    The filters come first, which leaves the same rows and less to shuffle.
    """
    verdict = numeric_or_null(F.col("device_report"), reports.schema["device_report"].dataType)
    distinct = reports.where(verdict.isin(1.0, 2.0) & F.col("in_contact").isin(*NOT_IN_CONTACTS)).dropDuplicates()
    columns = {"device_report": verdict.cast("int")}
    if "member_id" in reports.columns:
        member = F.col("member_id").cast("string")
        columns["member_id"] = F.when(~member.isin(*MISSING_IDS), member)
    return distinct.withColumns(columns)


def report_summary(cleaned: DataFrame, ordered: bool = True) -> DataFrame:
    """Reports and distinct reporting members per phone and verdict, most reported first.

    Grouping by phone and member first spreads a phone with very many reports
    over the cluster and turns both distinct counts into plain sums.
    """
    spam, ham = F.col("device_report") == 1, F.col("device_report") == 2
    per_member = (
        cleaned.where(F.col("phone").isNotNull())
        .groupBy("phone", "member_id")
        .agg(F.sum(spam.cast("bigint")).alias("spam"), F.sum(ham.cast("bigint")).alias("ham"))
    )
    known = F.col("member_id").isNotNull()
    summary = per_member.groupBy("phone").agg(
        F.sum(F.col("spam") + F.col("ham")).alias("total_reports"),
        F.sum("spam").alias("spam_reports"),
        F.sum("ham").alias("not_spam_reports"),
        F.sum((known & (F.col("spam") > 0)).cast("bigint")).alias("unique_spam_members"),
        F.sum((known & (F.col("ham") > 0)).cast("bigint")).alias("unique_ham_members"),
    )
    return summary.orderBy(F.desc("total_reports"), "phone") if ordered else summary
