"""Session helpers: recommended settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "ringlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Shuffle partitions are left to the cluster (AQE coalesces them); a local
    run should pass ``**{"spark.sql.shuffle.partitions": "8"}``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Call sites of every Column cost a round trip to the JVM each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only when the setting is missing (a local test session) is a temporary
    folder made and put in its place, so that all callers agree on one.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ringlens-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_own_folder: ContextVar[str | None] = ContextVar("own_folder", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never one that exists."""
    return f"{_own_folder.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_intermediates(spark: SparkSession) -> Iterator[str]:
    """Puts the intermediate tables of a job into one folder and removes it once the job has succeeded.

    A failed job leaves them to be looked at. Results must have been written
    elsewhere, as the jobs do.
    """
    folder = f"{shared_dir(spark)}/job-{uuid.uuid4().hex}"
    token = _own_folder.set(folder)
    try:
        yield folder
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    finally:
        _own_folder.reset(token)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    Cuts the lineage in a way that survives the loss of executors, and keeps
    columns separate so that later readers fetch only those they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, schema: list[tuple[str, str]], rows: list[tuple]) -> DataFrame:
    """A small constant table built from literals, planned without Python rows.

    ``rows`` is configuration held in code, so its size is known at plan time.
    """
    columns = [name for name, _ in schema]
    if not rows:
        return spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in schema))

    def record(row: tuple) -> Column:
        return F.struct(
            *[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, schema, strict=True)]
        )

    return spark.range(1).select(F.inline(F.array(*[record(row) for row in rows]))).select(*columns)


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed and the session started elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
