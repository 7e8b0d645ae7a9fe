from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ringlens.session import fresh_path, literal_table
from ringlens.sources import artifacts, versions
from ringlens.sources.tables import load_table


def test_a_failed_write_leaves_the_old_table(spark):
    path = fresh_path(spark, "table") + ".parquet"
    versions.replace_table(spark.range(5), path)
    before = load_table(spark, path)
    with pytest.raises(Exception, match="broken"):
        versions.replace_table(spark.range(9).withColumn("id", F.when(F.col("id") > 6, F.raise_error("broken")).otherwise(F.col("id"))), path)
    assert load_table(spark, path).count() == 5
    versions.replace_table(spark.range(7), path)
    # Who has begun to read the version before can go on.
    assert load_table(spark, path).count() == 7 and before.count() == 5
    versions.replace_table(spark.range(8), path)
    assert versions.numbers(spark, f"{path}/_versions") == [2, 3]
    assert load_table(spark, path).count() == 8


def test_a_writer_killed_before_its_claim(spark, monkeypatch):
    path = fresh_path(spark, "table") + ".csv"
    versions.replace_table(spark.range(3), path)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "claim", killed)
    with pytest.raises(KeyboardInterrupt):
        versions.replace_table(spark.range(4), path)
    assert load_table(spark, path).count() == 3


def test_one_number_has_one_owner(spark):
    folder = fresh_path(spark, "log")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: versions.claim(spark, folder, 1, f"writer {i}"), range(16)))
    assert sum(won) == 1
    assert versions.entry(spark, folder, 1) == f"writer {won.index(True)}"


def test_plain_tables_are_read_as_before(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    assert load_table(spark, f"{tmp_path}/t.parquet").count() == 3
    assert versions.current_path(spark, f"{tmp_path}/nothing") == f"{tmp_path}/nothing"


def test_promoters_at_once(spark):
    """Whoever comes first, every promotion beats the one before it, and the best model ends in production."""
    registry = fresh_path(spark, "registry")

    def offer(auc):
        metrics = literal_table(spark, [("auc_val", "double"), ("f1@best", "double")], [(auc, 0.5)])
        return artifacts.promote(spark, registry, f"v{auc}", f"/m/{auc}", metrics).first()["version"]

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(offer, [0.7, 0.9, 0.8, 0.6])) == ["v0.7", "v0.9", "v0.8", "v0.6"]
    rows = artifacts.registry_table(spark, registry).orderBy("number").collect()
    assert [r.number for r in rows] == [1, 2, 3, 4]
    promoted = [r.auc_val for r in rows if r.status == "production"]
    assert promoted == sorted(promoted) and promoted[-1] == 0.9
