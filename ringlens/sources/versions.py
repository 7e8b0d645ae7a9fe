"""Tables that are replaced at once, and numbers that only one writer can claim.

A versioned table is a folder with one subfolder per version and a log that
names them. A version counts from the moment its number in the log is claimed,
which is one file that must not exist before; until then readers have the
version before, and a writer that fails or is killed leaves it untouched.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

LOG = "_versions"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _write(spark: SparkSession, path: str, text: str) -> None:
    place, files = _file_system(spark, path)
    out = files.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()


def claim(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Writes entry ``number`` of a log with its whole text, or gives False where another writer has been first.

    The text is written beside and then renamed to a name that must be free,
    which file systems of a cluster do in one step; a local one makes a link.
    """
    place, files = _file_system(spark, folder)
    files.mkdirs(place)
    final, beside = f"{folder}/{number:012d}", f"{folder}/.{uuid.uuid4().hex}"
    _write(spark, beside, text)
    if files.getUri().getScheme() == "file":
        local = [urlparse(str(files.makeQualified(_file_system(spark, name)[0]).toUri())).path for name in (beside, final)]
        try:
            os.link(*local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local[0])
    java = spark._jvm
    context = java.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    rename = java.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(java.org.apache.hadoop.fs.Path(beside), java.org.apache.hadoop.fs.Path(final), options)
        return True
    except Exception:
        if files.exists(java.org.apache.hadoop.fs.Path(final)):
            files.delete(java.org.apache.hadoop.fs.Path(beside), False)
            return False
        raise


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The claimed numbers in order."""
    place, files = _file_system(spark, folder)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name) for name in names if name.isdigit())


def entry(spark: SparkSession, folder: str, number: int) -> str:
    place, files = _file_system(spark, f"{folder}/{number:012d}")
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or a whole folder."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of a versioned table's current version; any other path as it is."""
    log = f"{path.rstrip('/')}/{LOG}"
    known = numbers(spark, log) if not any(mark in path for mark in "*?[{") else []
    return f"{path.rstrip('/')}/{entry(spark, log, known[-1])}" if known else path


def replace_table(df: DataFrame, path: str, fmt: str | None = None, keep: int = 2) -> str:
    """Writes a new version of a table, makes it the current one, and gives its folder.

    The last ``keep`` versions stay, so that readers of the one before can
    finish. Of writers at the same time the one that claims last is current.
    """
    from ringlens.sources.tables import infer_format, save_table

    spark = df.sparkSession
    kind = fmt or infer_format(path)
    name = f"version-{uuid.uuid4().hex}.{kind}"
    target = save_table(df, f"{path.rstrip('/')}/{name}", kind)
    log = f"{path.rstrip('/')}/{LOG}"
    while True:
        known = numbers(spark, log)
        if claim(spark, log, known[-1] + 1 if known else 1, name):
            break
    for number in numbers(spark, log)[:-keep]:
        remove(spark, f"{path.rstrip('/')}/{entry(spark, log, number)}")
        remove(spark, f"{log}/{number:012d}")
    return target
