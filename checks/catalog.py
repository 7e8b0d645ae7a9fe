"""Every registered query: how Spark runs it and, where SQL can, what it must return."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from checks import oracle as O
from ringlens.config import FeatureConfig, RiskConfig, SearchSpace, TreeParams
from ringlens.constants import FEATURE_COLUMNS, SHIPPED_WORK_DAYS
from ringlens.functions import conversions as conv
from ringlens.functions.phones import join_key, phone_origin, strip_country
from ringlens.functions.timing import DayWindow
from ringlens.operators import calls as C
from ringlens.operators import dataset as D
from ringlens.operators import features as FT
from ringlens.operators import feedback as FB
from ringlens.operators import labels as L
from ringlens.operators import metrics as M
from ringlens.operators import model as ML
from ringlens.operators import promotion as PR
from ringlens.operators import quality as Q
from ringlens.operators import risk as R
from ringlens.operators import rollup as RU
from ringlens.operators.sequences import base_metrics, call_gaps, contacts, daily_mean
from ringlens.operators.skew import find_heavy
from ringlens.operators.split import stratified_split
from ringlens.plans import jobs
from ringlens.session import fresh_path, stored
from ringlens.sources import artifacts, history, tables
from ringlens.sources.day_states import DayStates
from ringlens.sources.providers import provider_dimension
from ringlens.sources.settings import load_risk_config
from ringlens.sources.versions import replace_table
from ringlens.streaming.risk import start_risk_stream

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOG: dict[str, Query] = {}

HISTORY_WINDOW = DayWindow(date(2024, 1, 30), 7)
REPORT_WINDOW = DayWindow(date(2000, 6, 30), 100)
CONFIG = FeatureConfig()
# What the tuning queries search: few rounds of shallow trees, drawn as from any other space.
QUICK_SPACE = SearchSpace(rounds=(10, 30), rounds_step=5, depth=(3, 5), bins=(32, 128), bins_step=32)
ROWS_PER_ARRAY = 100_000
CANONICAL = "phone, phone_member, report, type, time, in_contact, duration, Spam"


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        CATALOG[name] = Query(run, sql)
        return run

    return register


def call_history(spark: SparkSession, sf: str) -> DataFrame:
    return A.read(spark, sf, A.CALL_HISTORY)


def shared_reports(spark: SparkSession, sf: str) -> DataFrame:
    return A.read(spark, sf, A.SHARED_REPORTS)


def providers(spark: SparkSession) -> DataFrame:
    return provider_dimension(spark, O.TEST_PROVIDERS)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_calls(call_history(spark, sf))


def aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return FT.report_aggregates(call_history(spark, sf), providers(spark))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return FT.report_features(call_history(spark, sf), providers(spark))


def pool(spark: SparkSession, sf: str) -> DataFrame:
    return RU.phone_pool(call_history(spark, sf), providers(spark))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return A.read(spark, sf, A.REPORTS)


def summary(spark: SparkSession, sf: str, ordered: bool = False) -> DataFrame:
    return FB.report_summary(FB.clean_reports(reports(spark, sf)), ordered)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return A.read(spark, sf, A.SCORED)


def workspace(spark: SparkSession, sf: str, days: int = 30, **overrides) -> jobs.JobConfig:
    return jobs.JobConfig(
        workspace=fresh_path(spark, "workspace"),
        as_of=date(2024, 1, 30),
        history_days=days,
        providers=O.TEST_PROVIDERS,
        trials=2,
        space=QUICK_SPACE,
        **overrides,
    )


def labelled(reported: DataFrame) -> DataFrame:
    """Features per phone with a label, as a base training set has them."""
    labels = F.when(F.col("Spam") == 1, F.lit(1)).otherwise(F.lit(0))
    return reported.select(F.col("report").alias("phone"), labels.alias("label"), *FEATURE_COLUMNS)


def labelled_pool(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(features(spark, sf))


# --- sources and sinks ---


@query("scan_call_history", f"SELECT {CANONICAL} FROM ({A.CALL_HISTORY}) h")
def scan_call_history(spark, sf):
    path = tables.save_table(call_history(spark, sf), fresh_path(spark, "scan") + ".parquet")
    return tables.load_table(spark, path)


@query("csv_roundtrip", A.REPORTS)
def csv_roundtrip(spark, sf):
    df = reports(spark, sf)
    path = tables.save_table(df, fresh_path(spark, "reports") + ".csv")
    return tables.load_table(spark, path, schema=df.schema)


@query("replaced_table", f"SELECT * FROM ({A.REPORTS}) r WHERE device_report = '1'")
def replaced_table(spark, sf):
    """Of three versions the second is read: the third fails while it is written."""
    df = reports(spark, sf)
    path = fresh_path(spark, "reports") + ".parquet"
    replace_table(df, path)
    replace_table(df.where("device_report = '1'"), path)
    try:
        replace_table(df.withColumn("phone", F.when(F.col("device_report") == "2", F.raise_error("no")).otherwise(F.col("phone"))), path)
    except Exception as error:
        if "USER_RAISED_EXCEPTION" not in str(error):
            raise
    return tables.load_table(spark, path)


@query("json_roundtrip", A.REPORTS)
def json_roundtrip(spark, sf):
    df = reports(spark, sf)
    path = tables.save_table(df, fresh_path(spark, "reports") + ".jsonl")
    return tables.load_table(spark, path, schema=df.schema)


@query("json_lines_in_json", A.REPORTS)
def json_lines_in_json(spark, sf):
    """Lines under the suffix of an array, in several files."""
    df = reports(spark, sf)
    path = tables.save_table(df.repartition(3), fresh_path(spark, "reports") + ".json")
    return tables.load_table(spark, path, schema=df.schema)


def write_arrays(df: DataFrame, path: str) -> None:
    """Appends files with one array over many lines each, of about ``ROWS_PER_ARRAY`` rows."""
    as_json = F.to_json(F.struct(*df.columns))
    buckets = max(1, -(-df.count() // ROWS_PER_ARRAY))
    bucket = F.pmod(F.xxhash64("json", F.monotonically_increasing_id()), F.lit(buckets)).alias("bucket")
    array = F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list("json")), ",\n"), F.lit("\n]"))
    arrays = df.select(as_json.alias("json")).select("json", bucket).groupBy("bucket").agg(array.alias("value"))
    arrays.select("value").write.mode("append").option("fileExtension", "json").option("maxRecordsPerFile", 1).text(path)


@query("json_array", A.REPORTS)
def json_array(spark, sf):
    """A folder that holds arrays over many lines beside line-delimited files."""
    df = reports(spark, sf)
    path = fresh_path(spark, "reports") + ".json"
    even = F.pmod(F.hash("phone"), F.lit(2)) == 0
    tables.save_table(df.where(~even), path)
    write_arrays(df.where(even), path)
    return tables.load_table(spark, path, schema=df.schema)


HALVES = f"SELECT *, CAST(right(phone, 1) AS INTEGER) % 2 AS half FROM ({A.REPORTS}) r"


def written_by_half(spark: SparkSession, df: DataFrame) -> str:
    """Reports partitioned by the last digit of the phone: lines below ``half=0``, arrays below ``half=1``."""
    path = fresh_path(spark, "reports") + ".json"
    odd = F.right("phone", F.lit(1)).cast("int") % 2 == 1
    tables.save_table(df.where(~odd), f"{path}/half=0", "json")
    write_arrays(df.where(odd), f"{path}/half=1")
    return path


@query("json_partitioned", HALVES)
def json_partitioned(spark, sf):
    """A partitioned folder of both kinds keeps its partition column."""
    df = reports(spark, sf)
    return tables.load_table(spark, written_by_half(spark, df), schema=df.schema)


@query("json_split_arrays", HALVES)
def json_split_arrays(spark, sf):
    """The same with every array cut at its elements, as large ones are."""
    df = reports(spark, sf)
    return tables.load_table(spark, written_by_half(spark, df), schema=df.schema, split_arrays_from=0)


@query(
    "provider_dim",
    f"""SELECT d.prefix, d.provider, count(DISTINCT c.phone) AS phones, count(c.phone) AS calls
    FROM {O.dimension()} d LEFT JOIN ({O.clean(A.CALL_HISTORY)}) c ON left(c.phone, 4) = d.prefix
    GROUP BY ALL""",
)
def provider_dim(spark, sf):
    heads = (
        cleaned(spark, sf)
        .groupBy(F.substring("phone", 1, CONFIG.prefix_length).alias("prefix"), "phone")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("phones"), F.sum("n").alias("calls"))
    )
    return providers(spark).join(heads, "prefix", "left").fillna(0, ["phones", "calls"])


@query(
    "history_last_n_days",
    f"""SELECT member_id AS phone_member, phone, phone AS report, CAST(0 AS INTEGER) AS spam, type, time,
    in_contact, duration FROM ({A.UPSTREAM_CALLS}) u
    WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'""",
)
def history_last_n_days(spark, sf):
    source = tables.save_table(A.read(spark, sf, A.UPSTREAM_CALLS), fresh_path(spark, "upstream") + ".parquet")
    return tables.load_table(spark, history.export_calls(spark, source, fresh_path(spark, "exports"), HISTORY_WINDOW))


@query(
    "reports_last_n_days",
    f"""SELECT * FROM ({A.REPORTS}) r
    WHERE CAST(report_time AS DATE) BETWEEN DATE '2000-03-23' AND DATE '2000-06-30'""",
)
def reports_last_n_days(spark, sf):
    source = tables.save_table(reports(spark, sf), fresh_path(spark, "reports") + ".parquet")
    return tables.load_table(spark, history.export_reports(spark, source, fresh_path(spark, "exports"), REPORT_WINDOW))


@query("reports_no_time_col", f"SELECT phone, member_id, device_report, in_contact FROM ({A.REPORTS}) r")
def reports_no_time_col(spark, sf):
    return history.recent_reports(reports(spark, sf).drop("report_time"), REPORT_WINDOW)


@query(
    "run_manifest",
    f"""SELECT 'run-1' AS run_id, 'label' AS command, 'success' AS status, '2024-01-30T00:00:00' AS timestamp,
      '{{"phones": ' || count(DISTINCT phone) || ', "rows": ' || count(*) || '}}' AS result,
      CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message FROM ({A.REPORTS}) r
    UNION ALL
    SELECT 'run-1', 'dataset', 'failed', '2024-01-30T00:00:01', NULL, 'ValueError', 'no rows' """,
)
def run_manifest(spark, sf):
    path = fresh_path(spark, "runs")
    per_phone = reports(spark, sf).groupBy("phone").count()
    facts = per_phone.agg(F.count(F.lit(1)).alias("phones"), F.sum("count").alias("rows")).first().asDict()
    done = artifacts.manifest_row(spark, "run-1", "label", "success", facts, timestamp="2024-01-30T00:00:00")
    failed = artifacts.manifest_row(
        spark, "run-1", "dataset", "failed", error=ValueError("no rows"), timestamp="2024-01-30T00:00:01"
    )
    artifacts.append_manifest(done, path)
    artifacts.append_manifest(failed, path)
    return artifacts.read_manifest(spark, path)


SCORE_ROWS = f"SELECT label, score FROM ({A.SCORED}) x"
BEST = f"SELECT * FROM ({O.sweep(SCORE_ROWS)}) b ORDER BY f1 DESC, threshold LIMIT 1"


@query("load_threshold", f"SELECT threshold FROM ({BEST}) t")
def load_threshold(spark, sf):
    best = M.best_threshold(scored(spark, sf)).select(F.struct("threshold").alias("threshold_best"))
    return artifacts.threshold_row(stored(best, "metrics"))


# --- cleaning, projections and scalar conversions ---


@query(
    "clean_phone",
    f"""SELECT phone, phone_member, {O.bare('phone')} AS phone_clean, {O.bare('phone_member')} AS member_clean,
    count(*) AS calls FROM ({A.CALL_HISTORY}) h GROUP BY ALL""",
)
def clean_phone(spark, sf):
    return (
        call_history(spark, sf)
        .groupBy("phone", "phone_member")
        .agg(F.count(F.lit(1)).alias("calls"))
        .withColumns(
            {"phone_clean": strip_country(F.col("phone")), "member_clean": strip_country(F.col("phone_member"))}
        )
    )


@query("clean_calls", O.clean(A.CALL_HISTORY))
def clean_calls(spark, sf):
    return cleaned(spark, sf)


@query("enrich_calls", O.enrich(A.CALL_HISTORY))
def enrich_calls(spark, sf):
    return C.enrich_calls(cleaned(spark, sf), providers(spark))


@query("provider_lookup", O.providers_of(A.CALL_HISTORY))
def provider_lookup(spark, sf):
    return C.with_providers(cleaned(spark, sf), providers(spark))


@query("clean_reports", O.clean_reports())
def clean_reports(spark, sf):
    return FB.clean_reports(reports(spark, sf))


PHONE_FORMS = """
SELECT DISTINCT CASE page_id % 6 WHEN 0 THEN '+84 9' || page_id || '-345' WHEN 1 THEN '  ' WHEN 2 THEN '000' || page_id
  WHEN 3 THEN NULL WHEN 4 THEN '(0)' ELSE url END AS raw FROM pages
"""


@query("normalize_phone", f"SELECT raw, {O.join_key('raw')} AS phone_key FROM ({PHONE_FORMS}) p")
def normalize_phone(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    raw = spark.sql(A.spark_dialect(PHONE_FORMS).replace("FROM pages", "FROM {pages}"), pages=pages)
    return raw.select("raw", join_key(F.col("raw")).alias("phone_key"))


@query(
    "align_features",
    f"""SELECT report, call_in, CAST(0 AS INTEGER) AS unseen_feature, duration, avg_success
    FROM ({O.features(A.CALL_HISTORY)}) f""",
)
def align_features(spark, sf):
    wanted = ["call_in", "unseen_feature", "duration", "avg_success"]
    return RU.align_features(features(spark, sf).drop("phone", "Spam"), wanted, keys=["report"])


NUMBER_FORMS = """
SELECT event_id, CASE event_id % 12 WHEN 0 THEN '1' WHEN 1 THEN '2.5' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
  WHEN 4 THEN 'NaN' WHEN 5 THEN ' 12.75 ' WHEN 6 THEN '' WHEN 7 THEN '-3e2' WHEN 8 THEN '7d'
  WHEN 9 THEN CAST(user_id AS VARCHAR) WHEN 10 THEN event_type ELSE 'True' END AS raw,
  CASE WHEN event_id % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS amount, user_id FROM events
"""
PARSED = """CASE WHEN raw IS NOT NULL AND regexp_full_match(trim(raw), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
  THEN CAST(trim(raw) AS DOUBLE) END"""


def number_forms(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    return spark.sql(A.spark_dialect(NUMBER_FORMS).replace("FROM events", "FROM {events}"), events=events)


@query(
    "coerce_numeric",
    f"""SELECT event_id, {PARSED} AS raw, CASE WHEN isnan(amount) THEN NULL ELSE amount END AS amount,
    CAST(user_id AS DOUBLE) AS user_id FROM ({NUMBER_FORMS}) n""",
)
def coerce_numeric(spark, sf):
    return RU.coerce_numeric(number_forms(spark, sf), keys=["event_id"])


@query(
    "scalar_conversions",
    f"""SELECT event_id, coalesce({PARSED}, 0) AS as_double, coalesce(CAST(trunc({PARSED}) AS BIGINT), -1) AS as_int,
    coalesce(lower(raw) IN ('true', '1', 'yes'), false) AS as_bool,
    CASE WHEN isnan(amount) THEN NULL ELSE CAST(round_even(amount / 2, 0) AS BIGINT) END AS half
    FROM ({NUMBER_FORMS}) n""",
)
def scalar_conversions(spark, sf):
    df = number_forms(spark, sf)
    raw, kind = F.col("raw"), df.schema["raw"].dataType
    amount = conv.numeric_or_null(F.col("amount"), df.schema["amount"].dataType)
    return df.select(
        "event_id",
        conv.double_or(raw, kind).alias("as_double"),
        conv.int_or(raw, kind, -1).alias("as_int"),
        conv.bool_or(raw, kind).alias("as_bool"),
        conv.round_half_even(amount / 2, "bigint").alias("half"),
    )


# --- feature blocks ---


@query("call_gaps", f"""SELECT report, phone_member, type, time, duration, gap,
    CASE WHEN outgoing THEN way_gap END AS gap_to, CASE WHEN NOT outgoing THEN way_gap END AS gap_in,
    member_gap FROM ({O.gaps(A.CALL_HISTORY)}) g""")
def gaps(spark, sf):
    marked = FT.marked_calls(call_history(spark, sf), providers(spark))
    return call_gaps(marked).select(
        "report", "phone_member", "type", "time", "duration", "gap", "gap_to", "gap_in", "member_gap"
    )


BASE = [
    "avg_in_contact", "same_network", "duration", "duration_call_to", "duration_call_in", "in_hour",
    "not_in_hour", "avg_success", "call_to", "call_in", "call_to_miss", "call_in_miss", "Spam",
]
BLOCKS = {
    "agg_frequency": ["frequency", "total_frequency_to", "total_frequency_in"],
    "agg_frequency_member": ["total_frequency_to_by_phonemember", "total_frequency_in_by_phonemember"],
    "agg_redial": ["total_redial"],
}
UNORDERED_BLOCKS = {
    "agg_base": (base_metrics, BASE),
    "agg_time_join": (base_metrics, ["time_join"]),
    "agg_contacted": (contacts, ["total_contacted", "total_contacted_to", "total_contacted_in"]),
    "agg_daily": (daily_mean, ["mean_call_by_day"]),
}


def _block(columns: list[str]) -> Run:
    return lambda spark, sf: aggregates(spark, sf).select("report", *columns)


def _unordered(block: Callable[[DataFrame], DataFrame], columns: list[str]) -> Run:
    return lambda spark, sf: block(FT.directed_calls(call_history(spark, sf), providers(spark))).select(
        "report", *columns
    )


def _block_sql(columns: list[str]) -> str:
    return f"SELECT report, {', '.join(columns)} FROM ({O.with_days(A.CALL_HISTORY)}) b"


for _name, _columns in BLOCKS.items():
    query(_name, _block_sql(_columns))(_block(_columns))
for _name, (_metrics, _columns) in UNORDERED_BLOCKS.items():
    query(_name, _block_sql(_columns))(_unordered(_metrics, _columns))


@query("features_report", O.features(A.CALL_HISTORY))
def features_report(spark, sf):
    return features(spark, sf)


@query("features_report_heavy", O.features(A.CALL_HISTORY))
def features_report_heavy(spark, sf):
    """Same result with a limit low enough that busy reports take the layered plan."""
    config = FeatureConfig(heavy_rows=65)
    return FT.report_features(call_history(spark, sf), providers(spark), config)


def advanced(spark: SparkSession, sf: str, window: DayWindow, before: list[date]) -> DataFrame:
    """Features of a window whose state has been moved on from the windows that end on earlier days."""
    calls, dimension = call_history(spark, sf), providers(spark)
    states = DayStates(spark, fresh_path(spark, "day-states"))
    for day in before:
        states.features(calls, dimension, DayWindow(day, window.days))
    return states.features(calls, dimension, window)


@query("features_incremental", O.features(A.CALL_HISTORY))
def features_incremental(spark, sf):
    """The whole history, reached from the state of fifteen days before: the later days enter, as many leave."""
    return advanced(spark, sf, DayWindow(date(2024, 1, 30), 30), [date(2024, 1, 15)])


@query(
    "features_sliding",
    O.features(
        f"SELECT * FROM ({A.CALL_HISTORY}) w WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'"
    ),
)
def features_sliding(spark, sf):
    """A week that has moved on a day at a time, which full days leave and enter."""
    return advanced(spark, sf, HISTORY_WINDOW, [date(2024, 1, 28), date(2024, 1, 29)])


@query("features_csv_history", O.features(A.CALL_HISTORY))
def features_csv_history(spark, sf):
    """The feature builder on a CSV history, where every column arrives as text."""
    path = tables.save_table(call_history(spark, sf), fresh_path(spark, "history") + ".csv")
    return FT.report_features(tables.load_table(spark, path), providers(spark))


@query("features_json_history", O.features(A.CALL_HISTORY))
def features_json_history(spark, sf):
    path = tables.save_table(call_history(spark, sf), fresh_path(spark, "history") + ".jsonl")
    return FT.report_features(tables.load_table(spark, path), providers(spark))


@query("features_report_shared", O.features(A.SHARED_REPORTS))
def features_report_shared(spark, sf):
    return FT.report_features(shared_reports(spark, sf), providers(spark))


@query("report_phone_map", f"SELECT DISTINCT report, phone FROM ({A.SHARED_REPORTS}) h")
def report_phone_map(spark, sf):
    return RU.report_phone_map(shared_reports(spark, sf))


@query("features_phone", O.phone_pool(A.CALL_HISTORY))
def features_phone(spark, sf):
    return pool(spark, sf)


@query("features_phone_shared", O.phone_pool(A.SHARED_REPORTS))
def features_phone_shared(spark, sf):
    """One report for many phones, with a limit low enough to split the join by heavy reports."""
    calls = shared_reports(spark, sf)
    heavy = find_heavy(RU.report_phone_map(calls), "report", 3)
    return RU.phone_features(FT.report_features(calls, providers(spark)), calls, heavy)


# --- predictions ---


def scored_pool(spark: SparkSession, sf: str) -> DataFrame:
    """The phone pool with a score read off the phone number."""
    score = (F.substring("phone", -6, 6).cast("int") % 100 + F.lit(0.5)) / 100
    return pool(spark, sf).withColumn("Score", score)


PREDICTIONS = f"SELECT phone, CAST(score >= 0.5 AS INTEGER) AS Spam, score AS Score FROM ({O.risk_pool()}) p"


@query("predictions", PREDICTIONS)
def predictions(spark, sf):
    rows = RU.predictions(scored_pool(spark, sf), "phone", 0.5)
    path = tables.save_table(rows, fresh_path(spark, "predictions") + ".jsonl")
    return tables.load_table(spark, path, schema=rows.schema)


@query("prediction_sample", f"SELECT * FROM ({PREDICTIONS}) p ORDER BY phone LIMIT 5")
def prediction_sample(spark, sf):
    return jobs.prediction_sample(RU.predictions(scored_pool(spark, sf), "phone", 0.5), "phone")


# --- feedback, labels and the training set ---


@query("report_summary", O.report_summary())
def report_summary(spark, sf):
    return summary(spark, sf, ordered=True)


@query("label_thresholds", O.label_thresholds(O.report_summary()))
def label_thresholds(spark, sf):
    return L.label_thresholds(L.filled_counts(summary(spark, sf)))


@query("label_feedback", O.label_feedback(O.report_summary()))
def label_feedback(spark, sf):
    return L.label_feedback(stored(summary(spark, sf), "summary"))


CHANGED = O.changed_labels(O.label_feedback(O.report_summary()), A.POOL, "p.sum_call, p.duration")


@query("changed_labels", CHANGED)
def changed_labels(spark, sf):
    labels = L.label_feedback(stored(summary(spark, sf), "summary"))
    return D.changed_labels(labels, A.read(spark, sf, A.POOL), unique_phones=True)


KEYED_BASE = f"""
SELECT phone, label, sum_call, CAST(NULL AS DOUBLE) AS duration, nation FROM ({A.BASE_TRAINING}) b
WHERE {O.join_key('phone')} NOT IN (SELECT {O.join_key('phone')} FROM ({CHANGED}) c)
"""
MERGED = f"SELECT phone, label, sum_call, duration, CAST(NULL AS INTEGER) AS nation FROM ({CHANGED}) c UNION ALL {KEYED_BASE}"


@query("merge_training", MERGED)
def merge_training(spark, sf):
    changed = stored(changed_labels(spark, sf), "changed")
    return D.merge_training(changed, A.read(spark, sf, A.BASE_TRAINING))


def csv_base(spark: SparkSession, sf: str) -> str:
    """The base training set as a CSV file, in which every column is text."""
    return tables.save_table(A.read(spark, sf, A.BASE_TRAINING), fresh_path(spark, "base") + ".csv")


# sum_call has a number on one side and text on the other; nation is on one side only.
TEXT_MERGED = f"SELECT phone, label, CAST(sum_call AS DOUBLE) AS sum_call, duration, CAST(nation AS VARCHAR) AS nation FROM ({MERGED}) m"


@query("merge_training_csv", TEXT_MERGED)
def merge_training_csv(spark, sf):
    changed = stored(changed_labels(spark, sf), "changed")
    return D.merge_training(changed, tables.load_table(spark, csv_base(spark, sf)))


@query(
    "merge_training_nokey",
    f"""SELECT label, sum_call, CAST(NULL AS DOUBLE) AS duration, nation FROM ({A.BASE_TRAINING}) b
    UNION SELECT label, sum_call, duration, CAST(NULL AS INTEGER) FROM ({A.POOL}) p""",
)
def merge_training_nokey(spark, sf):
    return D.merge_training(
        A.read(spark, sf, A.POOL).drop("phone"), A.read(spark, sf, A.BASE_TRAINING).drop("phone")
    )


# --- table checks ---


@query(
    "validate_schema",
    f"""SELECT 'calls' AS name, count(*) >= 100 AS valid, '' AS missing, count(*) AS rows_seen
    FROM (SELECT 1 FROM ({A.CALL_HISTORY}) h LIMIT 100) t
    UNION ALL SELECT 'reports', false, 'score', count(*) FROM (SELECT 1 FROM ({A.REPORTS}) r LIMIT 10) t""",
)
def validate_schema(spark, sf):
    calls = Q.validate_schema(call_history(spark, sf), Q.TableRule(["phone", "report", "time"], 100), "calls")
    return calls.unionByName(Q.validate_schema(reports(spark, sf), Q.TableRule(["phone", "score"], 10), "reports"))


TRAINING_FORMS = f"""
SELECT phone, label, sum_call, CASE WHEN nation % 10 < 6 THEN NULL ELSE nation END AS sparse,
  CASE WHEN nation = 24 THEN 1 ELSE 0 END AS rare FROM ({A.BASE_TRAINING}) b
"""


@query(
    "validate_training",
    f"""SELECT set, concat_ws('; ',
      CASE WHEN nulls > 0.5 * n THEN 'Column ''sparse'' has >50% nulls' END,
      CASE WHEN least(pos, n - pos) < 0.05 * n THEN 'Severe class imbalance' END) AS issues,
      NOT (nulls > 0.5 * n OR least(pos, n - pos) < 0.05 * n) AS valid
    FROM (
      SELECT 'label' AS set, count(*) AS n, count(*) FILTER (WHERE sparse IS NULL) AS nulls, sum(label) AS pos
      FROM ({TRAINING_FORMS}) a
      UNION ALL SELECT 'rare', count(*), count(*) FILTER (WHERE sparse IS NULL), sum(rare) FROM ({TRAINING_FORMS}) b
      UNION ALL SELECT 'plain', count(*), 0, sum(label) FROM ({TRAINING_FORMS}) c
    ) s""",
)
def validate_training(spark, sf):
    text = A.spark_dialect(TRAINING_FORMS.replace(A.BASE_TRAINING, "SELECT * FROM {base}"))
    df = spark.sql(text, base=A.read(spark, sf, A.BASE_TRAINING))
    sets = {
        "label": Q.validate_training(df),
        "rare": Q.validate_training(df, label="rare"),
        "plain": Q.validate_training(df.drop("sparse")),
    }
    rows = [
        checked.select(F.lit(name).alias("set"), F.array_join("issues", "; ").alias("issues"), "valid")
        for name, checked in sets.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- evaluation ---


@query(
    "class_weight",
    f"""SELECT greatest(count(*) FILTER (WHERE label = 0) / CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE), 1.0)
    AS scale_pos_weight FROM ({A.SCORED}) s""",
)
def class_weight(spark, sf):
    return M.class_weight(scored(spark, sf))


@query("metrics_at_threshold", O.at_thresholds(SCORE_ROWS, [0.5, 0.25, 0.999]))
def metrics_at_threshold(spark, sf):
    return M.metrics_at(scored(spark, sf), [0.5, 0.25, 0.999])


DIRTY_SCORES = f"""
SELECT CASE WHEN row_id % 13 = 0 THEN NULL WHEN row_id % 17 = 0 THEN 2 ELSE label END AS label,
  CASE WHEN row_id % 7 = 0 THEN NULL WHEN row_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE score END AS score
FROM ({A.SCORED}) x
"""
CLEAN_SCORES = f"SELECT * FROM ({DIRTY_SCORES}) d WHERE label IN (0, 1) AND score IS NOT NULL AND NOT isnan(score)"


@query(
    "metrics_dirty_scores",
    f"""SELECT s.*, a.auc, l.rows, l.left_out FROM ({O.sweep(CLEAN_SCORES)}) s, ({O.roc_auc(CLEAN_SCORES)}) a,
    (SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM ({CLEAN_SCORES}) c) AS left_out FROM ({DIRTY_SCORES}) d) l""",
)
def metrics_dirty_scores(spark, sf):
    """NULL and NaN scores and labels that are none: every measure leaves out the same rows."""
    text = A.spark_dialect(DIRTY_SCORES.replace(A.SCORED, "SELECT * FROM {scored}"))
    rows = stored(spark.sql(text, scored=scored(spark, sf)), "dirty")
    out = M.left_out(rows)
    return M.threshold_sweep(rows).withColumns(
        {
            "auc": M.roc_auc(rows).scalar(),
            "rows": out.select("rows").scalar(),
            "left_out": out.select("left_out").scalar(),
        }
    )


@query("threshold_sweep", O.sweep(SCORE_ROWS))
def threshold_sweep(spark, sf):
    return M.threshold_sweep(scored(spark, sf))


@query("best_threshold", BEST)
def best_threshold(spark, sf):
    return M.best_threshold(scored(spark, sf))


@query("roc_auc", O.roc_auc(SCORE_ROWS))
def roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf))


@query("stratified_split", O.split(A.SCORED, "row_id", "row_id, label"))
def split(spark, sf):
    return stratified_split(scored(spark, sf), "row_id").select("row_id", "label", "role")


KEYLESS = f"""
SELECT row_id, label, CASE WHEN row_id % 5 < 2 THEN NULL ELSE CAST(row_id AS VARCHAR) END AS owner,
  CASE WHEN row_id % 3 = 0 THEN NULL ELSE event_type END AS kind FROM ({A.SCORED}) x
"""
CONTENT = """'row:["' || row_id || '",' || coalesce('"' || kind || '"', 'null') || ']'"""


@query("stratified_split_nulls", O.split(KEYLESS, f"coalesce(owner, {CONTENT})", "row_id, label"))
def split_nulls(spark, sf):
    """Two fifths of the rows have no key and are spread by their content."""
    text = A.spark_dialect(KEYLESS.replace(A.SCORED, "SELECT * FROM {scored}"))
    rows = spark.sql(text, scored=scored(spark, sf))
    return stratified_split(rows, "owner").select("row_id", "label", "role")


# Metric pairs of two pretend models per group of events, some without one measure or the other.
METRIC_PAIRS = f"""
SELECT event_type, bucket, bucket <> 0 AS has_old,
  CASE WHEN bucket IN (1, 2) THEN NULL ELSE CASE WHEN bucket IN (3, 4) THEN floor(a * 10) / 10 ELSE a END END AS new_auc,
  CASE WHEN bucket = 0 THEN NULL ELSE CASE WHEN bucket IN (3, 4) THEN floor(a * 10) / 10 ELSE b END END AS old_auc,
  CASE WHEN bucket IN (2, 6) THEN NULL ELSE b END AS new_f1,
  CASE WHEN bucket = 0 OR (bucket = 1 AND event_type < 'm') THEN NULL ELSE a END AS old_f1
FROM (
  SELECT event_type, CAST(row_id % 8 AS INTEGER) AS bucket,
    sum(CASE WHEN label = 1 THEN score ELSE 0 END) / CAST(count(*) AS DOUBLE) AS a,
    sum(CASE WHEN score > 0.5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS b
  FROM ({A.SCORED}) s GROUP BY event_type, CAST(row_id % 8 AS INTEGER)
) g
"""


def metric_pairs(spark: SparkSession, sf: str) -> DataFrame:
    text = A.spark_dialect(METRIC_PAIRS.replace(A.SCORED, "SELECT * FROM {scored}"))
    # Rounded because sums of doubles depend on the order of rows.
    measures = ["new_auc", "old_auc", "new_f1", "old_f1"]
    df = spark.sql(text, scored=scored(spark, sf))
    return df.withColumns({name: F.round(name, 6) for name in measures})


@query(
    "promotion_gate",
    f"""SELECT event_type, bucket, has_old, new_auc, old_auc, new_f1, old_f1,
      gate IN (1, 3, 4, 6, 7) AS promoted,
      ['no_old_metrics', 'new_f1@best_missing', 'old_f1@best_missing_new_has', 'better_f1@best', 'not_better_f1@best',
       'better_auc_val', 'tie_auc_val_better_f1@best', 'not_better_auc_val'][gate] AS reason,
      CASE WHEN gate IN (4, 5, 7) THEN new_f1 WHEN gate IN (6, 8) THEN new_auc END AS new,
      CASE WHEN gate IN (4, 5, 7) THEN old_f1 WHEN gate IN (6, 8) THEN old_auc END AS old
    FROM (
      SELECT *, CASE WHEN NOT has_old THEN 1
        WHEN new_auc IS NULL OR old_auc IS NULL THEN
          CASE WHEN new_f1 IS NULL THEN 2 WHEN old_f1 IS NULL THEN 3 WHEN new_f1 > old_f1 + 1e-6 THEN 4 ELSE 5 END
        WHEN new_auc > old_auc + 1e-6 THEN 6
        WHEN abs(new_auc - old_auc) <= 1e-6 AND new_f1 > old_f1 + 1e-6 THEN 7 ELSE 8 END AS gate
      FROM (
        SELECT event_type, bucket, has_old, round(new_auc, 6) AS new_auc, round(old_auc, 6) AS old_auc,
          round(new_f1, 6) AS new_f1, round(old_f1, 6) AS old_f1 FROM ({METRIC_PAIRS}) m
      ) r
    ) g""",
)
def promotion_gate(spark, sf):
    return PR.promotion_gate(metric_pairs(spark, sf))


# --- risk ---


@query(
    "phone_origin",
    "SELECT phone, {1} AS is_international, {2} AS prefix FROM (SELECT *, {0} FROM ".format(*O.phone_origin("phone"))
    + f"(SELECT DISTINCT phone FROM ({A.CALL_HISTORY}) h UNION SELECT DISTINCT phone_member FROM ({A.CALL_HISTORY}) h"
    + f" UNION SELECT url FROM pages UNION SELECT left(phone, 5) FROM ({A.CALL_HISTORY}) h) p) q",
)
def origin(spark, sf):
    calls = call_history(spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    numbers = (
        calls.select("phone")
        .union(calls.select("phone_member"))
        .union(pages.select("url"))
        .union(calls.select(F.substring("phone", 1, 5)))
        .distinct()
    )
    return numbers.select("phone", phone_origin(F.col("phone")).alias("o")).select("phone", "o.*")


def risk_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.risk_features(scored_pool(spark, sf), keep=("Score",))


@query("risk_features", O.risk_features(O.risk_pool()))
def risk_features(spark, sf):
    return risk_rows(spark, sf).withColumnRenamed("Score", "score")


@query("risk_model_level", f"SELECT phone, score, model_level FROM ({O.risk_levels()}) l")
def risk_model_level(spark, sf):
    rows = scored_pool(spark, sf)
    return rows.select("phone", F.col("Score").alias("score"), R.model_level(F.col("Score")).alias("model_level"))


@query("risk_rule_level", f"SELECT phone, rule_level, rule_reasons FROM ({O.risk_levels()}) l")
def risk_rule_level(spark, sf):
    level, reasons = R.rule_level()
    return risk_rows(spark, sf).select(
        "phone", level.alias("rule_level"), F.array_join(reasons, " | ").alias("rule_reasons")
    )


@query(
    "risk_whitelist",
    f"""SELECT phone, credit, greatest(CASE WHEN is_international THEN 1 ELSE 0 END, 3 + credit) AS from_three
    FROM ({O.risk_levels()}) l""",
)
def risk_whitelist(spark, sf):
    credit = R.trust_credit()
    return risk_rows(spark, sf).select(
        "phone", credit.alias("credit"), R.lowered(F.lit(3), credit).alias("from_three")
    )


def flat(evaluated: DataFrame) -> DataFrame:
    return evaluated.select(
        "phone", "final_level", "model_level", "rule_level", "title", "subtitle",
        F.array_join("reasons", " | ").alias("reasons"),
        *[f"features_used.{name}" for name in ("is_international", "prefix", "total_call", "avg_duration")],
    )


@query("risk_evaluate", O.risk_evaluate())
def risk_evaluate(spark, sf):
    return flat(R.evaluate_risk(risk_rows(spark, sf), config=RiskConfig()))


@query("risk_config_file", O.risk_evaluate())
def risk_config_file(spark, sf):
    """Rules, limits, lists and messages come from a file."""
    path = fresh_path(spark, "risk") + ".json"
    text = json.dumps(RiskConfig().to_mapping())
    spark.range(1).select(F.lit(text)).write.text(path)
    return flat(R.evaluate_risk(risk_rows(spark, sf), config=load_risk_config(spark, path)))


LARGE_POOL = f"SELECT phone, score, sum_call * 50000000 AS sum_call, call_to_miss * 40000000 AS call_to_miss, call_in_miss, duration, mean_call_by_day, call_back_rate, in_hour, not_in_hour, avg_in_contact, total_contacted, avg_duration_call_in FROM ({O.risk_pool()}) l"


@query("risk_features_large", O.risk_features(LARGE_POOL))
def risk_features_large(spark, sf):
    """Sums of calls beyond 32 bits."""
    large = scored_pool(spark, sf).withColumns(
        {"sum_call": F.col("sum_call") * 50_000_000, "call_to_miss": F.col("call_to_miss") * 40_000_000}
    )
    return R.risk_features(large, keep=("Score",)).withColumnRenamed("Score", "score")


LISTED = f"SELECT phone FROM ({A.CALL_HISTORY}) h WHERE in_contact = 1 AND duration > 480"


@query("risk_blacklist_table", O.risk_evaluate(LISTED))
def risk_blacklist_table(spark, sf):
    """The blacklist is a table: phones with a very long call to a contact."""
    listed = call_history(spark, sf).where("in_contact = 1 and duration > 480").select("phone")
    return flat(R.evaluate_risk(risk_rows(spark, sf), blacklist=listed))


#: Rules from the calls: beginnings of called phones, of six characters where several calls were short, of four where one was long,
#: and codes of foreign phones that took calls.
PREFIX_RULES = f"""
    SELECT 'domestic' AS kind, substr(phone, 1, 6) AS head, CAST(1 AS BIGINT) AS place
    FROM ({A.CALL_HISTORY}) h WHERE duration < 5 GROUP BY ALL HAVING count(*) >= 2
    UNION ALL SELECT 'domestic', substr(phone, 1, 4), 10 - count(*) % 7 FROM ({A.CALL_HISTORY}) h
    WHERE duration > 450 GROUP BY ALL
    UNION ALL SELECT DISTINCT 'foreign', substr(phone, 2, 3), CAST(0 AS BIGINT) FROM ({A.CALL_HISTORY}) h
    WHERE starts_with(phone, '+') AND type = 2"""


def prefix_rules(spark: SparkSession, sf: str) -> DataFrame:
    calls = call_history(spark, sf)

    def counted(rows: DataFrame, size: int) -> DataFrame:
        return rows.groupBy(F.substring("phone", 1, size).alias("head")).agg(F.count("*").alias("n"))

    def rules(kind: str, heads: DataFrame, place: str) -> DataFrame:
        return heads.select(F.lit(kind).alias("kind"), "head", F.expr(place).cast("bigint").alias("place"))

    incoming = calls.where("startswith(phone, '+') and type = 2")
    return (
        rules("domestic", counted(calls.where("duration < 5"), 6).where("n >= 2"), "1")
        .unionByName(rules("domestic", counted(calls.where("duration > 450"), 4), "10 - n % 7"))
        .unionByName(rules("foreign", counted(incoming.withColumn("phone", F.expr("substring(phone, 2)")), 3), "0"))
    )


@query("risk_prefix_table", O.risk_evaluate(None, PREFIX_RULES))
def risk_prefix_table(spark, sf):
    """The prefix lists are a table; of several that match, the one with the smallest place counts."""
    return flat(R.evaluate_risk(risk_rows(spark, sf), prefixes=prefix_rules(spark, sf)))


@query("stream_risk", O.risk_evaluate())
def stream_risk(spark, sf):
    """The same rows through a stream that reads files as they are and stops when it has seen them all."""
    arrived = stored(scored_pool(spark, sf).repartition(4, "phone"), "arriving")
    source = arrived.inputFiles()[0].rsplit("/", 1)[0]
    target, log = fresh_path(spark, "risk"), fresh_path(spark, "risk-log")
    stream = start_risk_stream(
        spark, source, arrived.schema, target, log, files_per_batch=2, available_now=True
    )
    stream.awaitTermination()
    return flat(spark.read.parquet(target))


LISTED_LATER = f"SELECT phone FROM ({LISTED}) l WHERE CAST(right(phone, 1) AS INTEGER) % 2 = 1"


@query("stream_blacklist", O.risk_evaluate(LISTED_LATER))
def stream_blacklist(spark, sf):
    """The list is empty when phones with an even last digit arrive, and replaced before those with an odd one do."""
    arriving = stored(scored_pool(spark, sf), "arriving")
    source, target, log = (fresh_path(spark, name) for name in ("source", "risk", "risk-log"))
    listed = fresh_path(spark, "listed") + ".parquet"
    phones = A.read(spark, sf, LISTED).select("phone")
    odd = F.right("phone", F.lit(1)).cast("int") % 2 == 1
    replace_table(phones.where("false"), listed)
    arriving.where(~odd).write.mode("append").parquet(source)
    stream = start_risk_stream(spark, source, arriving.schema, target, log, blacklist=listed)
    stream.processAllAvailable()
    replace_table(phones, listed)
    arriving.where(odd).write.mode("append").parquet(source)
    stream.processAllAvailable()
    stream.stop()
    return flat(spark.read.parquet(target))


# --- models and jobs ---


def split_sizes(label_rows: str) -> str:
    """Sizes of the roles of each class, from the shares alone."""
    return f"""
    SELECT label, n, tested, ceil((n - tested) * CAST(0.2 AS DOUBLE)) AS checked FROM (
      SELECT label, count(*) AS n, ceil(count(*) * CAST(0.15 AS DOUBLE)) AS tested FROM ({label_rows}) r GROUP BY label
    ) c"""


LABELS = f"SELECT CASE WHEN Spam = 1 THEN 1 ELSE 0 END AS label FROM ({O.features(A.CALL_HISTORY)}) f"
REPORTED = f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows_used, CAST({len(FEATURE_COLUMNS)} AS INTEGER) AS n_features,
  greatest(sum(CASE WHEN label = 0 THEN n - tested - checked ELSE 0 END)
    / sum(CASE WHEN label = 1 THEN n - tested - checked ELSE 0 END), CAST(1 AS DOUBLE)) AS scale_pos_weight,
  CAST(sum(CASE WHEN label = 0 THEN tested ELSE 0 END) AS BIGINT) AS negatives,
  CAST(sum(CASE WHEN label = 1 THEN tested ELSE 0 END) AS BIGINT) AS positives, 'label' AS label_col,
  CAST(0.01 AS DOUBLE) AS threshold_search_step, true AS bounded
FROM ({split_sizes(LABELS)}) s
"""


def certain(report: DataFrame) -> DataFrame:
    """What a report must say whatever the trees are, and that its measures are within their bounds."""
    measures = ["auc_val", *[f"{m}@{at}" for m in ("accuracy", "precision", "recall", "f1") for at in ("0.5", "best")]]
    bounded = [F.col(f"`{m}`").between(0.0, 1.0) for m in measures]
    sums = [F.col(f"`{a}@0.5`") + F.col(f"`{b}@0.5`") == F.col(f"`{a}@best`") + F.col(f"`{b}@best`") for a, b in (("tn", "fp"), ("fn", "tp"))]
    within = F.forall(F.array(*bounded, *sums, F.col("best_iteration") >= 1), lambda x: x)
    return report.select(
        "n_rows_used",
        "n_features",
        "scale_pos_weight",
        (F.col("`tn@0.5`") + F.col("`fp@0.5`")).alias("negatives"),
        (F.col("`fn@0.5`") + F.col("`tp@0.5`")).alias("positives"),
        "label_col",
        "threshold_search_step",
        within.alias("bounded"),
    )


def agreed(predicted: DataFrame, key: str, threshold: float) -> DataFrame:
    """Whom a prediction is about, whether the score is a probability and the class follows from it."""
    score = F.col("Score")
    return predicted.select(
        key,
        score.between(0.0, 1.0).alias("in_range"),
        ((F.col("Spam") == 1) == (score >= threshold)).alias("consistent"),
    )


@query("train_score", f"SELECT phone, true AS in_range, true AS consistent FROM ({O.phone_pool(A.CALL_HISTORY)}) p")
def train_score(spark, sf):
    rows, columns = ML.split_rows(labelled_pool(spark, sf))
    trained = ML.fit(rows, columns)
    path = fresh_path(spark, "bundle")
    artifacts.save_bundle(trained, rows.groupBy().count(), path)
    model, kept, _ = artifacts.load_bundle(spark, path)
    return agreed(RU.predictions(ML.score(model, kept, pool(spark, sf), ["phone"]), "phone", 0.5), "phone", 0.5)


PLANTED = "SELECT CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS label FROM customer"


@query(
    "train_separable",
    f"""SELECT 'test' AS role, CAST(sum(tested) AS BIGINT) AS rows, CAST(1 AS DOUBLE) AS auc, CAST(1 AS DOUBLE) AS best_f1
    FROM ({split_sizes(PLANTED)}) s
    UNION ALL SELECT 'train', CAST(sum(n - tested - checked) AS BIGINT), CAST(1 AS DOUBLE), CAST(1 AS DOUBLE)
    FROM ({split_sizes(PLANTED)}) s
    UNION ALL SELECT 'validation', CAST(sum(checked) AS BIGINT), CAST(1 AS DOUBLE), CAST(1 AS DOUBLE)
    FROM ({split_sizes(PLANTED)}) s""",
)
def train_separable(spark, sf):
    """Two columns tell the classes apart with a gap, one is noise: every role must be ranked and classified without a fault."""
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    label = F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0)
    planted = customers.select(
        F.col("c_custkey").cast("string").alias("phone"),
        label.alias("label"),
        (label * 20 + F.col("c_custkey") % 11).alias("sum_call"),
        (F.col("c_custkey") % 13 - label * 30).alias("total_redial"),
        F.col("c_acctbal").cast("double").alias("duration"),
    )
    rows, columns = ML.split_rows(planted)
    scores = stored(ML.evaluation_rows(ML.fit(rows, columns), rows), "planted")
    parts = []
    for role in ("test", "train", "validation"):
        mine = scores.where(F.col("role") == role).select("label", "score")
        parts.append(
            mine.groupBy().count().select(
                F.lit(role).alias("role"),
                F.col("count").alias("rows"),
                M.roc_auc(mine).select("auc").scalar().alias("auc"),
                M.best_threshold(mine).select("f1").scalar().alias("best_f1"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("train_nokey", f"SELECT label, count(*) AS rows, true AS in_range FROM ({LABELS}) l GROUP BY label")
def train_nokey(spark, sf):
    """A training set without phones, as a merge without a key makes it."""
    rows, columns = ML.split_rows(labelled_pool(spark, sf).drop("phone"))
    trained = ML.fit(rows, columns)
    scores = ML.score(trained.model, columns, rows, ["label"])
    return scores.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("Score").between(0.0, 1.0)).alias("in_range")
    )


@query("tune", "SELECT CAST(i AS INTEGER) AS trial, true AS in_space, true AS one_best FROM range(3) r(i)")
def tune(spark, sf):
    """Three trials of a small space; every draw lies in it, and the one best trial has the highest AUC."""
    rows, columns = ML.split_rows(labelled_pool(spark, sf))
    trials = stored(ML.tune(rows, columns, trials=3, space=QUICK_SPACE).trials, "trials")
    c, space = F.col, QUICK_SPACE
    inside = (
        c("rounds").between(*space.rounds) & (c("rounds") % space.rounds_step == 0)
        & c("bins").between(*space.bins) & (c("bins") % space.bins_step == 0) & c("depth").between(*space.depth)
    )
    for name in ("min_child_rows", "learning_rate", "row_sample", "column_sample", "min_gain"):
        inside = inside & c(name).between(*getattr(space, name))
    best = trials.agg(
        (F.count_if("is_best") == 1) & (F.max("auc") == F.max(F.when(c("is_best"), c("auc"))))
    ).scalar()
    return trials.select("trial", inside.alias("in_space"), best.alias("one_best"))


@query(
    "tune_resumed",
    "SELECT CAST(i AS INTEGER) AS trial, true AS logged, i < 1 AS resumed, CAST(3 AS BIGINT) AS entries FROM range(3) r(i)",
)
def tune_resumed(spark, sf):
    """A search that was stopped after its first trial goes on with the second; the log has each trial once, with its AUC."""
    rows, columns = ML.split_rows(labelled_pool(spark, sf))
    log = fresh_path(spark, "search")
    first = ML.tune(rows, columns, trials=1, space=QUICK_SPACE, log=log).trials.first()
    whole = ML.tune(rows, columns, trials=3, space=QUICK_SPACE, log=log)
    kept = spark.read.json(log).select("trial", F.col("auc").alias("logged_auc"))
    resumed = (F.col("trial") < whole.record["n_resumed"]) & (F.col("auc") == F.lit(first["auc"]))
    return whole.trials.join(kept.withColumn("trial", F.col("trial").cast("int")), "trial").select(
        "trial", (F.col("auc") == F.col("logged_auc")).alias("logged"), (F.when(F.col("trial") == 0, resumed).otherwise(F.lit(False))).alias("resumed"),
        F.lit(kept.count()).cast("bigint").alias("entries"),
    )


@query("model_report", REPORTED)
def model_report(spark, sf):
    made = ML.training_set(labelled_pool(spark, sf))
    return certain(ML.model_report(ML.fit(made.rows, made.columns), made.rows, None, "label", made.dropped))


@query(
    "model_registry",
    """SELECT 'v1' AS version, 'production' AS status, 'no_old_metrics' AS reason
    UNION ALL SELECT 'v2', 'rejected', 'not_better_auc_val'""",
)
def model_registry(spark, sf):
    """A first model is promoted; the same model again is not better."""
    rows, columns = ML.split_rows(labelled_pool(spark, sf))
    trained = ML.fit(rows, columns)
    registry = fresh_path(spark, "registry")
    metrics = stored(ML.model_report(trained, rows), "metrics")
    for version in ("v1", "v2"):
        path = fresh_path(spark, f"bundle-{version}")
        artifacts.save_bundle(trained, metrics, path)
        artifacts.promote(spark, registry, version, path, metrics)
    return artifacts.registry_table(spark, registry).select("version", "status", "reason")


@query(
    "registry_conflict",
    """WITH m AS (SELECT count(*) AS n FROM customer)
    SELECT CAST(number AS BIGINT) AS number, version, status, reason, CAST(auc_val AS DOUBLE) AS auc_val FROM (
      SELECT 1 AS number, 'v1' AS version, 'production' AS status, 'no_old_metrics' AS reason, 1 - 9 / (n + 10.0) AS auc_val FROM m
      UNION ALL SELECT 2, 'v3', 'production', 'better_auc_val', 1 - 5 / (n + 10.0) FROM m
      UNION ALL SELECT 3, 'v2', 'rejected', 'not_better_auc_val', 1 - 7 / (n + 10.0) FROM m) r""",
)
def registry_conflict(spark, sf):
    """While v2 is compared with v1, v3 is promoted; v2 loses its number, is compared with v3, and is rejected."""
    registry = fresh_path(spark, "registry")
    customers = spark.read.parquet(f"{sf}/customer.parquet").agg(F.count("*").alias("n"))

    def offer(version: str, share: int, before=None) -> None:
        auc = F.lit(1.0) - F.lit(float(share)) / (F.col("n") + 10.0)
        metrics = customers.select(auc.alias("auc_val"), F.lit(0.5).alias("f1@best"))
        artifacts.promote(spark, registry, version, f"/models/{version}", metrics, before_claim=before)

    offer("v1", 9)
    offer("v2", 7, before=lambda attempt: offer("v3", 5) if attempt == 1 else None)
    return artifacts.registry_table(spark, registry).select("number", "version", "status", "reason", "auc_val")


def with_production(spark: SparkSession, sf: str) -> jobs.JobConfig:
    """A workspace whose base training set has produced a first model, with trees of the default number and depth."""
    config = workspace(spark, sf)
    shipped = FT.report_features(call_history(spark, sf), providers(spark), config.features)
    tables.save_table(labelled(shipped), config.base_training)
    jobs.train(spark, config.base_training, config, TreeParams())
    return config


def upstream_file(spark: SparkSession, sf: str) -> str:
    return tables.save_table(A.read(spark, sf, A.UPSTREAM_CALLS), fresh_path(spark, "upstream") + ".parquet")


def reports_file(spark: SparkSession, sf: str) -> str:
    """Reports about the phones of the call history, as well as about those of the orders."""
    about_calls = call_history(spark, sf).select(
        "phone",
        F.concat(F.lit("m"), F.substring("phone_member", -2, 2)).alias("member_id"),
        F.when(F.col("Spam") == 1, "1").otherwise("2").alias("device_report"),
        F.lit("no").alias("in_contact"),
        F.col("time").alias("report_time"),
    )
    both = reports(spark, sf).unionByName(about_calls)
    return tables.save_table(both, fresh_path(spark, "reports") + ".parquet")


def shipped_days(sql: str) -> str:
    """The same SQL with the working days of the shipped jobs."""
    plain, shipped = (f"IN ({O.office_days(days)})" for days in (FeatureConfig().work_days, SHIPPED_WORK_DAYS))
    return sql.replace(f"isodow(time) {plain}", f"isodow(time) {shipped}")


EXPORTED = f"""
SELECT phone, member_id AS phone_member, phone AS report, type, time, in_contact, duration, CAST(0 AS INTEGER) AS Spam
FROM ({A.UPSTREAM_CALLS}) u WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
"""


@query(
    "job_infer",
    f"""SELECT phone, in_hour, not_in_hour, sum_call, true AS in_range, true AS consistent
    FROM ({shipped_days(O.phone_pool(EXPORTED))}) p""",
)
def job_infer(spark, sf):
    """The first model is trained inside the query, with the default trees."""
    config = with_production(spark, sf)
    result = jobs.infer(spark, upstream_file(spark, sf), config)
    about = agreed(tables.load_table(spark, result["predictions"]), "phone", result["threshold_used"])
    kept = tables.load_table(spark, result["pool"]).select(
        "phone", *[F.col(name).cast("bigint").alias(name) for name in ("in_hour", "not_in_hour", "sum_call")]
    )
    return kept.join(about, "phone")


RECENT_REPORTS = f"""
SELECT * FROM ({O.clean_reports()}) c WHERE CAST(report_time AS DATE) BETWEEN DATE '1998-01-02' AND DATE '2000-12-31'
"""


@query("job_label", O.label_feedback(O.report_summary(RECENT_REPORTS)))
def job_label(spark, sf):
    config = jobs.JobConfig(
        workspace=fresh_path(spark, "workspace"), as_of=date(2000, 12, 31), report_days=1095
    )
    source = tables.save_table(reports(spark, sf), fresh_path(spark, "reports") + ".parquet")
    return tables.load_table(spark, jobs.label(spark, source, config)["labels"])


@query("job_dataset", MERGED)
def job_dataset(spark, sf):
    config = jobs.JobConfig(workspace=fresh_path(spark, "workspace"))
    labels = tables.save_table(L.label_feedback(summary(spark, sf)), config.path("labels.parquet"))
    source = tables.save_table(A.read(spark, sf, A.POOL), config.path("pool.parquet"))
    tables.save_table(A.read(spark, sf, A.BASE_TRAINING), config.base_training)
    return tables.load_table(spark, jobs.dataset(spark, labels, source, config)["training"])


@query("job_dataset_csv", TEXT_MERGED)
def job_dataset_csv(spark, sf):
    """The base training set is a CSV file."""
    config = jobs.JobConfig(workspace=fresh_path(spark, "workspace"), base_path=csv_base(spark, sf))
    labels = tables.save_table(L.label_feedback(summary(spark, sf)), config.path("labels.parquet"))
    source = tables.save_table(A.read(spark, sf, A.POOL), config.path("pool.parquet"))
    return tables.load_table(spark, jobs.dataset(spark, labels, source, config)["training"])


@query("job_train", REPORTED)
def job_train(spark, sf):
    """Without a merged set, the base set is trained; tunes two trials over ``QUICK_SPACE`` to keep the query short."""
    config = workspace(spark, sf)
    tables.save_table(labelled_pool(spark, sf), config.base_training)
    result = jobs.recorded(spark, "train", config, lambda: jobs.train(spark, None, config))
    return certain(spark.read.parquet(f"{result['bundle']}/metrics"))


@query(
    "job_full",
    f"""SELECT report AS phone, CASE WHEN Spam = 1 THEN 1 ELSE 0 END AS label,
    {', '.join(f'CAST({name} AS DOUBLE) AS {name}' for name in FEATURE_COLUMNS)}
    FROM ({shipped_days(O.features(A.CALL_HISTORY))}) f""",
)
def job_full(spark, sf):
    """Reports agree with the base labels, so every phone ends with these, corrected or not.

    The first model has the default trees; the one trained last is the better of two trials over ``QUICK_SPACE``.
    """
    config = with_production(spark, sf)
    job = lambda: jobs.full(spark, upstream_file(spark, sf), reports_file(spark, sf), config)
    result = jobs.recorded(spark, "full", config, job)
    merged = tables.load_table(spark, result["dataset"]["training"])
    return merged.select("phone", "label", *[F.col(name).cast("double").alias(name) for name in FEATURE_COLUMNS])


@query(
    "job_score_file",
    f"SELECT report, true AS in_range, true AS consistent FROM ({O.features(A.SHARED_REPORTS)}) f",
)
def job_score_file(spark, sf):
    """The first model is trained inside the query, with the default trees."""
    config = with_production(spark, sf)
    source = tables.save_table(shared_reports(spark, sf), fresh_path(spark, "history"), "parquet")
    result = jobs.score_file(spark, source, config, threshold=0.4, per_phone=False, fmt="parquet")
    return agreed(tables.load_table(spark, result["output"]), "report", 0.4)
