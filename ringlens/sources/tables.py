"""Reading and writing tables by format."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ringlens.sources.json_arrays import array_lines, first_characters
from ringlens.sources.versions import current_path

FORMATS = {
    "parquet": "parquet", "pq": "parquet", "csv": "csv", "jsonl": "jsonl", "ndjson": "jsonl", "json": "json",
    "json_array": "json_array",
}

#: Arrays of more bytes are cut at their elements and read by several tasks; smaller ones are parsed by one.
SPLIT_ARRAYS_FROM = 128 << 20


def infer_format(path: str) -> str:
    """Format named by the suffix; csv when the suffix says nothing."""
    name = str(path).rstrip("/").lower()
    return FORMATS.get(name.rpartition(".")[2], "csv")


def load_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None,
    split_arrays_from: int = SPLIT_ARRAYS_FROM,
) -> DataFrame:
    """A table in any supported format.

    CSV columns are text unless a schema says otherwise: inference would read
    the data twice and turn phone numbers into integers without their leading
    zeros, and every operator converts text itself. JSON carries its own types;
    a schema saves the pass that discovers them. ``json`` decides per file
    between lines and one array; ``jsonl`` and ``json_array`` say which. Arrays of
    objects of more than ``split_arrays_from`` bytes are read by several tasks. Of
    a table written by ``replace_table`` the current version is read.
    """
    kind = FORMATS.get((fmt or infer_format(path)).lower().strip())
    path = current_path(spark, path)
    if kind is None:
        raise ValueError(f"unsupported format {fmt!r}; use one of {sorted(FORMATS)}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "csv":
        return reader.option("header", True).option("escape", '"').csv(path)
    if kind in ("json", "json_array"):
        return _load_json(spark, path, schema, split_arrays_from, kind == "json_array")
    return reader.json(path)


def _base(path: str) -> str | None:
    """The folder below which directory names are partition columns; a pattern has none."""
    return None if re.search(r"[*?\[{]", path) else path


def _load_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None, split_from: int, arrays_only: bool
) -> DataFrame:
    """JSON of either kind: one object per line, which can be split between tasks, or an array over many lines.

    Each file is looked at by itself, as a folder may hold both; columns that
    only one kind has are NULL in the other, and partition columns stay. With
    ``arrays_only`` a file that is no array is one object over many lines.
    """
    known = first_characters(spark, path)
    lines = [file for file, (first, _) in known.items() if first != "["]
    large = [file for file, (first, size) in known.items() if first == "[" and size > split_from]
    small = [file for file, (first, size) in known.items() if first == "[" and size <= split_from]
    base = _base(path) if len(known) > 1 else None

    def reader(array: bool, base: str | None) -> DataFrameReader:
        plain = (spark.read.schema(schema) if schema is not None else spark.read).option("multiLine", array)
        return plain.option("basePath", base) if base else plain

    if not large and not (lines and small):
        return reader(bool(small) or arrays_only, None).json(path)
    parts = [reader(array, base).json(files) for files, array in ((lines, arrays_only), (small, True)) if files]
    if large:
        parts += [reader(False, folder).json(folder) for folder in array_lines(spark, large, base)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_if_exists(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """The table, or None where there is none."""
    try:
        return load_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists") -> str:
    """Writes a directory of part files; JSON is written as one object per line."""
    kind = FORMATS[(fmt or infer_format(path)).lower().strip()]
    writer = df.write.mode(mode)
    if kind == "parquet":
        writer.option("compression", "zstd").parquet(path)
    elif kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.json(path)
    return path
