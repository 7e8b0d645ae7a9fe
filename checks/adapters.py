"""The driver tables seen as call history, user reports and scored rows.

Each adapter is written once, in the SQL both engines understand up to the
few spellings replaced below, so that inputs cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALLS = """
SELECT
  CASE user_id % 10
    WHEN 0 THEN '+8498' WHEN 1 THEN '0912' WHEN 2 THEN '0243' WHEN 3 THEN '+2317' WHEN 4 THEN '1900'
    WHEN 5 THEN '008490' WHEN 6 THEN '+1415' WHEN 7 THEN '0977' WHEN 8 THEN '0225' ELSE '8486' END
    || lpad(CAST(user_id AS VARCHAR), 6, '0') AS phone,
  CASE WHEN k = 99 THEN 'abc123' WHEN k = 98 THEN '12'
    ELSE CASE k % 3 WHEN 0 THEN '+8497' WHEN 1 THEN '0901' ELSE '8488' END
         || lpad(CAST(k % 20 AS VARCHAR), 6, '0') END AS phone_member,
  CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'error' THEN 4
    ELSE CASE WHEN event_id % 10 = 0 THEN 5 ELSE 1 END END AS type,
  ts AS time,
  CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS in_contact,
  CAST(floor(value) AS DOUBLE) AS duration,
  CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS Spam,
  user_id
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
"""

CALL_HISTORY = f"""
SELECT phone, phone_member, phone AS report, type, time, in_contact, duration, Spam FROM ({CALLS}) c
"""

# Several phones share a report, as when one device reports for many numbers.
SHARED_REPORTS = f"""
SELECT phone, phone_member, 'R' || CAST(user_id % 40 AS VARCHAR) AS report, type, time, in_contact, duration, Spam
FROM ({CALLS}) c
"""

UPSTREAM_CALLS = f"""
SELECT phone_member AS member_id, phone, type, time, in_contact, duration FROM ({CALLS}) c
"""

REPORTS = r"""
SELECT '0' || CAST(900000000 + o_custkey AS VARCHAR) AS phone,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 11 AS VARCHAR) END AS member_id,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 9 = 0 THEN '3'
       WHEN o_custkey % 5 = 0 THEN '1' WHEN o_custkey % 5 = 1 THEN '2'
       WHEN o_custkey % 5 = 2 THEN CASE WHEN o_orderkey % 10 < 8 THEN '1' ELSE '2' END
       WHEN o_custkey % 5 = 3 THEN CASE WHEN o_orderkey % 10 < 9 THEN '2' ELSE '1' END
       ELSE CAST(o_orderkey % 2 + 1 AS VARCHAR) END AS device_report,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'yes' WHEN '2-HIGH' THEN '\N' ELSE 'no' END AS in_contact,
  o_orderdate AS report_time
FROM orders
"""

# Odd thousandths: no score equals a threshold of the grid or a risk limit.
SCORED = """
SELECT event_id AS row_id, CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS label, event_type,
  (2 * (3 * k + CASE WHEN user_id % 5 = 0 THEN 150 ELSE 0 END) + 1) / CAST(1000.0 AS DOUBLE) AS score
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
"""

# A prediction per customer, under the phone numbers the reports use.
POOL = """
SELECT '0' || CAST(900000000 + c_custkey AS VARCHAR) AS phone,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS label,
  c_custkey % 97 AS sum_call, c_acctbal AS duration
FROM customer
"""

BASE_TRAINING = """
SELECT '+0' || CAST(900000000 + c_custkey AS VARCHAR) AS phone, CAST(c_custkey % 2 AS INT) AS label,
  c_custkey % 89 AS sum_call, c_nationkey AS nation
FROM customer WHERE c_custkey % 3 = 0
"""


EVENTS_WITH_K = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e"


def spark_dialect(sql: str) -> str:
    return (
        sql.replace("AS VARCHAR", "AS STRING")
        .replace(r"'\N'", r"'\\N'")
    )


def read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """An adapter over the Parquet tables of one folder.

    ``k`` is generated rather than projected: Catalyst would otherwise parse
    the JSON again in every expression and pushed filter that uses it.
    """
    frames = {}
    text = sql
    if EVENTS_WITH_K in text:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        k = F.get_json_object("props", "$.k").cast("int")
        frames["events"] = events.select("*", F.explode(F.array(k)).alias("k"))
        text = text.replace(EVENTS_WITH_K, "{events} e")
    for name in ("orders", "customer"):
        if f"FROM {name}" in text:
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(spark_dialect(text), **frames)
