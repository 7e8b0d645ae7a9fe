import glob
import json
import os

import pytest

from checks import catalog
from ringlens.sources.json_arrays import first_characters
from ringlens.sources.tables import load_table


def test_arrays_are_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_ARRAY", 50)
    paths = []
    monkeypatch.setattr(catalog, "fresh_path", lambda *given: paths.append(fresh(*given)) or paths[-1])
    got = catalog.CATALOG["json_array"].run(spark, sf)
    source = catalog.reports(spark, sf)
    assert sorted(map(str, got.collect())) == sorted(map(str, source.select(*got.columns).collect()))
    folder = next(path for path in paths if "reports" in path).removeprefix("file:") + ".json"
    texts = [open(name).read() for name in glob.glob(os.path.join(folder, "part-*"))]
    assert texts, paths
    arrays = [text for text in texts if text.startswith("[")]
    half = source.where("pmod(hash(phone), 2) = 0").count()
    assert len(arrays) >= half / 100 and all(text.count("[\n") == 1 and text.count("\n{") <= 100 for text in arrays)


def fresh(spark, name):
    from ringlens.session import fresh_path

    return fresh_path(spark, name)


def hard_rows(n):
    """Objects with braces, quotes and backslashes in texts, nested objects and arrays, and long ones."""
    return [
        {"id": i, "text": '{"a": [1, }]}' * (i % 4) + "\\" * (i % 3) + '"é', "in": {"x": i, "y": [{"z": i}, {}]}, "long": "ab}" * (i % 7) * 40}
        for i in range(n)
    ]


@pytest.mark.parametrize("style", ["lines", "one_line", "indented"])
def test_arrays_split_at_elements(spark, tmp_path, style):
    """Whatever the blocks cut through, the rows are those of the parser."""
    rows = hard_rows(20)
    text = {
        "lines": "[\n" + ",\n".join(map(json.dumps, rows)) + "\n]\n",
        "one_line": "\ufeff " + json.dumps(rows),
        "indented": json.dumps(rows, indent=2),
    }[style]
    for day in (1, 2):
        folder = tmp_path / "table.json" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "a b.json").write_text(text)
        (folder / "empty.json").write_text(" [ ]\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (300, 10**7):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            found = load_table(spark, f"{tmp_path}/table.json", split_arrays_from=4)
            got = [(r.day, r.id, r.text, r["in"].x, r["in"].y[0].z, r.long) for r in found.collect()]
            assert found.schema["day"].dataType.simpleString() == "int"
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert sorted(got) == sorted((day, r["id"], r["text"], r["in"]["x"], r["id"], r["long"]) for day in (1, 2) for r in rows)


def test_partition_columns_of_a_mixed_folder(spark, tmp_path):
    for day, text in ((1, '{"a": 1}\n{"a": 2}\n'), (2, '[{"a": 3},\n {"a": 4}]')):
        folder = tmp_path / "t.json" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(text)
    got = load_table(spark, f"{tmp_path}/t.json").collect()
    assert sorted((r.day, r.a) for r in got) == [(1, 1), (1, 2), (2, 3), (2, 4)]
    assert {r.a for r in load_table(spark, f"{tmp_path}/t.json/day=*", "json").collect()} == {1, 2, 3, 4}


def test_formats_are_found_in_one_job(spark, tmp_path):
    folder = tmp_path / "many.json"
    folder.mkdir()
    for i in range(300):
        (folder / f"{i}.json").write_text(f'[{{"a": {i}}}]' if i % 2 else f'{{"a": {i}}}\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sniff", "")
    found = first_characters(spark, str(folder))
    assert len(tracker.getJobIdsForGroup("sniff")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(found) == 300 and sum(first == "[" for first, _ in found.values()) == 150
    assert load_table(spark, str(folder), schema="a int").agg({"a": "sum"}).first()[0] == sum(range(300))
