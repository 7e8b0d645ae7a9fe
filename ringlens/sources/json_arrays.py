"""JSON files told apart by tasks, and arrays of any size read by several tasks.

A closing brace is taken as the end of a record, so Spark's text reader cuts a
file at braces and deals its blocks to tasks, whatever the file's lines are.
Whether a block begins inside a text, and how deep, depends on all blocks
before it; a first pass says of every block what it does to either state, and
the blocks of a file are put together from that. A second pass knows its state
and writes one element per line; elements that cross a block's border are few
and are joined from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlens.session import fresh_path, share_code

STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)
REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
SUMMARY = "file string, begin bigint, ends_in_0 boolean, deeper_0 bigint, ends_in_1 boolean, deeper_1 bigint"


def braces(spark: SparkSession, paths: str | list[str], base: str | None) -> DataFrame:
    """``value``: the text up to each closing brace, with partition columns, file and block."""
    reader = spark.read.option("lineSep", "}")
    text = (reader.option("basePath", base) if base else reader).text(paths)
    return text.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_begin"))


def first_characters(spark: SparkSession, path: str, base: str | None = None) -> dict[str, tuple[str, int]]:
    """The first character of each file that is not blank, and the file's size, found in one job.

    A task stops reading as soon as it knows: at once in a block that is not a
    file's first, after one record in a large file. Small files share a task.
    """
    whole = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    ))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            out = []
            done = False
            for row in batch.to_pylist():
                if row["begin"] == 0 and row["file"] != known and row["first"]:
                    known = row["file"]
                    out.append((known, row["first"], row["size"]))
                if row["length"] >= whole and (row["begin"] > 0 or row["file"] == known):
                    done = True
                    break
            if out:
                arrays = [pa.array(list(column)) for column in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "first", "size"])
            if done:
                return

    rows = braces(spark, path, base).select(
        F.col("_file").alias("file"), F.col("_begin").alias("begin"), F.col("_metadata.file_block_length").alias("length"),
        F.col("_metadata.file_size").alias("size"), F.expr(r"left(regexp_replace(value, '^[\\s\\ufeff]+', ''), 1)").alias("first"),
    )
    found = rows.mapInArrow(told, "file string, first string, size bigint").collect()
    return {unquote(row.file): (row.first, row.size) for row in found}


def passed(inside: bool, text: str) -> tuple[bool, int]:
    """Whether a text or its absence follows a fragment, and how many levels deeper it leads, before its closing brace."""
    if inside:
        found = REST_OF_STRING.match(text)
        if found is None:
            return True, 0
        text = text[found.end() :]
    plain = STRING.sub("", text)
    opened = plain.find('"')
    if opened >= 0:
        plain = plain[:opened]
    return opened >= 0, plain.count("{") + plain.count("[") - plain.count("]")


def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does, entered outside (0) and inside (1) of a text."""
    block, states = None, [(False, 0), (True, 0)]

    def row() -> Iterator[pa.RecordBatch]:
        if block is not None:
            values = [*block, *states[0], *states[1]]
            names = ["file", "begin", "ends_in_0", "deeper_0", "ends_in_1", "deeper_1"]
            yield pa.RecordBatch.from_arrays([pa.array([value]) for value in values], names=names)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("file", "begin", "value")]
        for file, begin, value in zip(*columns, strict=True):
            if (file, begin) != block:
                yield from row()
                block, states = (file, begin), [(False, 0), (True, 0)]
            for i, (inside, depth) in enumerate(states):
                ends, deeper = passed(inside, value)
                states[i] = (ends, depth + deeper - (not ends))
    yield from row()


def block_states(fragments: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """State at the start of each block: whether it is inside a text, and the depth.

    One row per block of about 128 MB reaches the driver: 100 TB have 800,000.
    """
    rows = fragments.select(F.col("_file").alias("file"), F.col("_begin").alias("begin"), "value").mapInArrow(summarised, SUMMARY)
    states: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    for row in rows.orderBy("file", "begin").collect():
        if row.file != file:
            file, inside, depth = row.file, False, 0
        states[row.file, row.begin] = (inside, depth)
        inside, depth = (row.ends_in_1, depth + row.deeper_1) if inside else (row.ends_in_0, depth + row.deeper_0)
    return states


def elements_of(states, kept: list[str]):
    """A task's function: each element of an array as one line, or the parts of it that a block holds.

    ``part`` is ``whole``, or ``tail`` for a beginning without an end, ``head``
    for an end without a beginning, and ``middle`` for neither.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, inside, depth, open_, entered, last = None, False, 0, [], False, None

        def rows(batch, found):
            at, parts, values, begins = zip(*found, strict=True)
            taken = batch.select(kept).take(pa.array(at, pa.int64())) if kept else None
            columns = [*(taken.columns if kept else []), batch.column("_file").take(pa.array(at, pa.int64()))]
            columns += [pa.array(begins, pa.int64()), pa.array(parts, pa.string()), pa.array(values, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*kept, "_file", "_begin", "_part", "value"])

        for batch in batches:
            found = []
            columns = [batch.column(name).to_pylist() for name in ("_file", "_begin", "value")]
            for i, (file, begin, value) in enumerate(zip(*columns, strict=True)):
                if (file, begin) != block:
                    if open_:
                        left = (0, "middle" if entered else "tail", "".join(open_), block[1])
                        if i == 0:
                            yield rows(last, [left])
                        else:
                            found.append((i - 1, *left[1:]))
                    block = (file, begin)
                    inside, depth = states[block]
                    entered, open_ = inside or depth >= 2, []
                ends, deeper = passed(inside, value)
                if not open_ and not entered:
                    start = value.find("{")
                    value = value[start:] if start >= 0 else ""
                inside, depth = ends, depth + deeper - (not ends)
                if value or open_ or entered:
                    open_.append(value.replace("\r", " ").replace("\n", " ") + "}")
                if not inside and depth == 1 and open_:
                    found.append((i, "head" if entered else "whole", "".join(open_), begin))
                    open_, entered = [], False
                elif not inside and depth < 1:
                    open_, entered = [], False
            if found:
                yield rows(batch, found)
            if batch.num_rows:
                last = batch.slice(batch.num_rows - 1)
        if open_:
            yield rows(last, [(0, "middle" if entered else "tail", "".join(open_), block[1])])

    return cut


def array_lines(spark: SparkSession, files: list[str], base: str | None = None) -> list[str]:
    """Folders with the elements of JSON arrays of objects, one per line, and with the partition columns of the files."""
    share_code(spark)
    fragments = braces(spark, files, base)
    kept = [name for name in fragments.columns if name not in ("value", "_file", "_begin")]
    kinds = {field.name: field.dataType.simpleString() for field in fragments.schema.fields}
    states = block_states(fragments)
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in kept), "_file string, _begin bigint, _part string, value string"])
    cut = fragments.mapInArrow(elements_of(states, kept), schema)
    target = fresh_path(spark, "array-lines")
    crossing = F.to_json(F.struct(F.col("_file").alias("file"), F.col("_begin").alias("begin"), "_part", "value"))
    whole = F.col("_part") == "whole"
    cut.select(
        *kept, F.when(whole, "whole").otherwise("parts").alias("_part"), F.when(whole, F.col("value")).otherwise(crossing).alias("value")
    ).write.partitionBy("_part", *kept).text(target)
    folders = [f"{target}/_part={name}" for name in ("whole", "parts") if _exists(spark, f"{target}/_part={name}")]
    if folders and folders[-1].endswith("parts"):
        folders[-1] = _joined(spark, folders[-1], kept)
    return folders


def _joined(spark: SparkSession, parts: str, kept: list[str]) -> str:
    """Elements that cross borders: a tail, the middles after it and the head that ends it."""
    found = spark.read.schema("file string, begin bigint, _part string, value string").option("basePath", parts).json(parts)
    owner = F.last(F.when(F.col("_part") == "tail", F.col("begin")), ignorenulls=True).over(
        # A block has at most two parts here, the end of one element before the beginning of the next.
        W.partitionBy("file").orderBy("begin", F.col("_part") == "tail")
    )
    groups = found.withColumn("owner", owner).groupBy("file", "owner", *kept)
    order = F.struct("begin", (F.col("_part") == "tail").alias("tail"), "value")
    listed = groups.agg(F.array_sort(F.collect_list(order)).alias("list"))
    lines = listed.select(*kept, F.expr("array_join(transform(list, x -> x.value), '')").alias("value"))
    target = f"{parts}-joined"
    writer = lines.write.partitionBy(*kept) if kept else lines.write
    writer.text(target)
    return target


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
