"""Reports, labels, training set and table checks."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ringlens.functions.timing import DayWindow
from ringlens.operators.dataset import changed_labels, merge_training, new_labels
from ringlens.operators.feedback import clean_reports, report_summary
from ringlens.operators.labels import filled_counts, label_feedback, label_thresholds
from ringlens.operators.quality import SchemaError, TableRule, require_schema, validate_training
from ringlens.sources.history import export_reports, recent_reports, time_column
from ringlens.sources.tables import infer_format, load_table, save_table

REPORTS = "phone string, member_id string, device_report string, in_contact string"


def test_reports_are_cleaned_and_counted(spark):
    rows = [
        ("a", "m1", "1", "no"), ("a", "m1", "1", "no"), ("a", "m2", "1.0", "\\N"), ("a", "nan", "1", "no"),
        ("a", "m1", "2", "no"), ("a", "m3", "3", "no"), ("a", "m4", "1", "yes"), ("b", None, "2", "no"),
        ("b", "", "2", "no"), ("b", "m1", "x", "no"),
    ]
    got = report_summary(clean_reports(spark.createDataFrame(rows, REPORTS))).collect()
    assert [tuple(r) for r in got] == [("a", 4, 3, 1, 2, 1), ("b", 2, 0, 2, 0, 0)]


SUMMARY = (
    "phone string, total_reports long, spam_reports long, not_spam_reports long, "
    "unique_spam_members long, unique_ham_members long"
)


def test_first_fitting_rule_wins(spark):
    rows = [
        ("strong-spam", 6, 5, 1, 3, 1), ("volume-spam", 8, 8, 0, 2, 0), ("strong-ham", 7, 1, 6, 1, 3),
        ("volume-ham", 8, 0, 8, 0, 2), ("conflict", 4, 2, 2, 2, 2), ("few", 2, 2, 0, 2, 0),
        ("unknown", 4, 4, 0, 2, 0),
    ]
    got = {r["phone"]: r for r in label_feedback(spark.createDataFrame(rows, SUMMARY)).collect()}
    picked = {p: (r["label"], r["rule_id"], r["confidence"], r["rule_note"]) for p, r in got.items()}
    assert picked == {
        "strong-spam": (1, "SPAM_CONSENSUS_STRONG", "high", "total>=6, Uspam>=3, Rspam>=5, SR>=0.7"),
        "volume-spam": (1, "SPAM_VOLUME_HI", "medium", "Rspam>=8 (p95), Uspam>=2, SR>=0.60"),
        "strong-ham": (0, "HAM_CONSENSUS_STRONG", "high", "total>=6, Uham>=3, Rham>=5, HR>=0.7, spam<=1"),
        "volume-ham": (0, "HAM_VOLUME_HI", "medium", "Rham>=8 (p95), Uham>=2, HR>=0.60, spam=0"),
        "conflict": (-1, "REVIEW_CONFLICT_OR_LOW_EVID", "low", ""),
        "few": (-1, "REVIEW_CONFLICT_OR_LOW_EVID", "low", ""),
        "unknown": (-1, "unknown", "", ""),
    }


def test_volume_limits_need_fifty_phones(spark):
    def limits(phones):
        rows = [(str(i), i, i, 0, 1, 0) for i in range(1, phones + 1)]
        return tuple(label_thresholds(filled_counts(spark.createDataFrame(rows, SUMMARY))).first())

    assert limits(49) == (8, 8)
    assert limits(50) == (48, 8)  # 47.55 rounds to 48; no ham reports leave the floor


def test_counts_are_filled(spark):
    df = spark.createDataFrame([("a", "3", None)], "phone string, spam_reports string, not_spam_reports int")
    row = filled_counts(df).first()
    assert (row["spam_reports"], row["ham_reports"], row["total_reports"]) == (3, 0, 3)


def test_changed_labels(spark):
    labels = spark.createDataFrame(
        [("0901", 1), ("0902", 0), ("0903", 1), ("0904", -1), ("0905", 1)], "phone string, label int"
    )
    pool = spark.createDataFrame(
        [("901", 0, 1.0), ("+902", 0, 2.0), ("903", None, 3.0), ("904", 0, 4.0), ("999", 0, 5.0)],
        "phone string, label int, x double",
    )
    for heavy_rows in (10**6, 0):
        got = changed_labels(labels, pool, heavy_rows=heavy_rows)
        assert got.columns == ["phone", "label", "x"]
        assert sorted(map(tuple, got.collect())) == [("901", 1, 1.0), ("903", 1, 3.0)]
    unlabelled = changed_labels(labels, pool.drop("label"))
    assert sorted(r["phone"] for r in unlabelled.collect()) == ["+902", "901", "903"]


def test_colliding_phones_are_settled_by_reports(spark):
    rows = [("0901", 1, 3), ("901", 0, 9), ("+0901", 1, 5)]
    got = new_labels(spark.createDataFrame(rows, "phone string, label int, total_reports long"))
    assert [tuple(r) for r in got.collect()] == [("901", 0)]


def test_merge_prefers_changed_rows(spark):
    changed = spark.createDataFrame([("0901", 1, 5.0)], "phone string, label int, x double")
    base = spark.createDataFrame([("901", 0, "b"), ("902", 0, "c"), ("0902", 1, "d")], "phone string, label int, y string")
    got = sorted(map(tuple, merge_training(changed, base).select("phone", "label", "x", "y").collect()))
    assert got == [("0901", 1, 5.0, None), ("0902", 1, None, "d")]


def test_merge_with_an_empty_side(spark):
    rows = spark.createDataFrame([("1", 0), ("1", 0)], "phone string, label int")
    empty = rows.limit(0)
    assert merge_training(empty, rows).count() == 2
    assert merge_training(rows, empty).count() == merge_training(rows, None).count() == 2
    assert merge_training(rows.drop("phone"), rows).count() == 2
    with pytest.raises(ValueError, match="empty"):
        merge_training(empty, None)


def issues(spark, df, **kwargs):
    row = validate_training(df, **kwargs).first()
    return row["valid"], row["issues"]


def test_training_data_checks(spark):
    good = spark.createDataFrame([(i, i % 2) for i in range(5)], "f int, label int")
    assert issues(spark, good) == (True, [])
    valid, found = issues(spark, good.drop("label"))
    assert not valid and "Missing label" in found[0]
    sparse = spark.createDataFrame([(1.0, 0), (None, 1), (float("nan"), 0), (None, 1), (5.0, 0)], "f double, label int")
    valid, found = issues(spark, sparse)
    assert not valid and ">50% nulls" in found[0]
    skewed = spark.createDataFrame([(i, int(i > 0)) for i in range(100)], "f int, label int")
    valid, found = issues(spark, skewed)
    assert not valid and "imbalance" in found[0]


def test_required_schema(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require_schema(df, TableRule(["a"]), "t") is df
    with pytest.raises(SchemaError, match="missing columns"):
        require_schema(df, TableRule(["a", "b"]), "t")
    with pytest.raises(SchemaError, match="at least 2"):
        require_schema(df, TableRule(["a"], 2), "t")


def test_time_column_is_found_without_case(spark):
    assert time_column(spark.createDataFrame([(1, 2)], "Time int, Report_Time int")) == "Report_Time"
    assert time_column(spark.createDataFrame([(1, 2)], "TIME int, x int")) == "TIME"
    assert time_column(spark.createDataFrame([(1,)], "x int")) is None


def test_unreadable_times_are_dropped(spark):
    df = spark.createDataFrame([("2024-01-30 10:00:00",), ("2024-01",), ("x",), (None,)], "time string")
    assert recent_reports(df, DayWindow(date(2024, 1, 30), 7)).count() == 1


def test_report_export_refuses_its_own_source(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime(2024, 1, 30))], "phone string, report_time timestamp_ntz")
    source = save_table(df, f"{tmp_path}/reports.parquet")
    window = DayWindow(date(2024, 1, 30), 1)
    with pytest.raises(ValueError, match="overwrite"):
        export_reports(spark, source, str(tmp_path), window)
    assert load_table(spark, export_reports(spark, source, f"{tmp_path}/out", window)).count() == 1


def test_formats(spark, tmp_path):
    names = {"x.parquet": "parquet", "x.csv": "csv", "x.jsonl": "jsonl", "X.JSON": "json", "x.unknown": "csv",
             "x.ndjson": "jsonl", "x.pq": "parquet"}
    assert {n: infer_format(n) for n in names} == names
    with pytest.raises(ValueError, match="unsupported"):
        load_table(spark, "x.csv", fmt="xlsx")
    df = spark.createDataFrame([("0901", 'a "quoted", one', None)], "phone string, note string, n int")
    for suffix in ("parquet", "pq", "csv", "jsonl", "ndjson", "json"):
        path = save_table(df, f"{tmp_path}/t.{suffix}")
        assert load_table(spark, path, schema=df.schema).collect() == df.collect()
    (tmp_path / "array.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert load_table(spark, f"{tmp_path}/array.json").agg(F.sum("a")).first()[0] == 3


def test_json_is_told_apart_per_file(spark, tmp_path):
    folder = tmp_path / "mixed.json"
    folder.mkdir()
    (folder / "a.json").write_text('\ufeff\n  [\n{"a": 1, "b": "x"},\n {"a": 2}]')
    (folder / "b.json").write_text('{"a": 10}\n\n{"a": 20, "c": 5}\n')
    (folder / "c.json").write_text("")
    rows = load_table(spark, str(folder))
    assert sorted(rows.columns) == ["a", "b", "c"]
    assert sorted(r.a for r in rows.collect()) == [1, 2, 10, 20]
    typed = load_table(spark, str(folder), schema="a long, b string")
    assert sorted((r.a, r.b) for r in typed.collect())[0] == (1, "x")
    many = save_table(spark.range(20).repartition(4), f"{tmp_path}/lines.json")
    assert sorted(r.id for r in load_table(spark, many).collect()) == list(range(20))


def test_text_from_a_csv_is_compared_as_numbers(spark):
    labels = spark.createDataFrame([("0901", "1", "9"), ("901", "0", "10")], "phone string, label string, total_reports string")
    assert [tuple(r) for r in new_labels(labels).collect()] == [("901", 0)]


def test_merge_takes_a_text_base(spark):
    changed = spark.createDataFrame([("0901", 1, 5, 1.5)], "phone string, label int, x long, y double")
    base = spark.createDataFrame([("0902", "0.0", "7", "abc"), ("901", "0", "1", "1")], "phone string, label string, x string, y string")
    got = sorted(tuple(r) for r in merge_training(changed, base).select("phone", "label", "x", "y").collect())
    assert got == [("0901", 1, 5.0, 1.5), ("0902", 0, 7.0, None)]


def test_merge_keeps_the_same_row_whatever_the_order(spark):
    rows = [("0901", 1, float(i)) for i in range(30)]
    base = spark.createDataFrame(rows, "phone string, label int, x double")
    changed = spark.createDataFrame([("0902", 1, 0.0)], base.schema)
    kept = {merge_training(changed, base.repartition(n)).where("phone = '0901'").first().x for n in (1, 3, 7)}
    assert len(kept) == 1
