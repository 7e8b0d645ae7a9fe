"""The last N days of call history and of user reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.functions.timing import DayWindow
from ringlens.sources.tables import load_table, save_table


def recent_calls(upstream: DataFrame, window: DayWindow) -> DataFrame:
    """Upstream records of the window in the canonical layout; every phone reports for itself."""
    kind = {field.name.lower(): field.dataType for field in upstream.schema.fields}
    return upstream.where(window.contains(F.col("time"), kind["time"])).select(
        F.col("member_id").cast("string").alias("phone_member"),
        F.col("phone").cast("string").alias("phone"),
        F.col("phone").cast("string").alias("report"),
        F.lit(0).alias("spam"),
        "type",
        "time",
        "in_contact",
        "duration",
    )


def time_column(df: DataFrame) -> str | None:
    """``report_time`` if the table has it in any case, else ``time``, else nothing."""
    names = {name.lower(): name for name in df.columns}
    return names.get("report_time", names.get("time"))


def recent_reports(reports: DataFrame, window: DayWindow) -> DataFrame:
    """Reports of the window with all their columns; unfiltered when they carry no time."""
    column = time_column(reports)
    if column is None:
        return reports
    return reports.where(window.contains(F.col(column), reports.schema[column].dataType))


def export_calls(spark: SparkSession, source: str, folder: str, window: DayWindow) -> str:
    target = f"{folder.rstrip('/')}/call_histories_{window.label()}.parquet"
    return save_table(recent_calls(load_table(spark, source, "parquet"), window), target, "parquet", "overwrite")


def export_reports(spark: SparkSession, source: str, folder: str, window: DayWindow) -> str:
    """Writes under the name of the source, which therefore must lie in another folder."""
    target = f"{folder.rstrip('/')}/{source.rstrip('/').rsplit('/', 1)[-1]}"
    if target == source.rstrip("/"):
        raise ValueError(f"the export would overwrite its own source {source}")
    return save_table(recent_reports(load_table(spark, source, "parquet"), window), target, "parquet", "overwrite")
