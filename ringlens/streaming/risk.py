"""Risk evaluation of rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringlens.config import RiskConfig
from ringlens.operators.risk import evaluate_risk, risk_features
from ringlens.sources.tables import load_table


def evaluate_stream(rows: DataFrame, score: str = "Score", config: RiskConfig = RiskConfig()) -> DataFrame:
    """The batch evaluation on a streaming frame: stateless, so no watermark is needed."""
    return evaluate_risk(risk_features(rows, keep=(score,)), score, config)


def start_risk_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    config: RiskConfig = RiskConfig(),
    files_per_batch: int = 1000,
    available_now: bool = False,
    blacklist: str | None = None,
) -> StreamingQuery:
    """Evaluates Parquet rows that arrive in ``source`` and appends results to ``target``.

    File offsets in ``checkpoint`` and the sink's own log make the output
    exactly-once across restarts. ``blacklist`` is the path of a table (column
    ``phone``) that may be replaced while the stream runs; each batch reads it
    as it is then, and goes to ``batch=<number>`` below the target, which a
    repeated batch overwrites.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    if blacklist is not None:

        def evaluated(batch: DataFrame, number: int) -> None:
            listed = load_table(batch.sparkSession, blacklist)
            found = evaluate_risk(risk_features(batch, keep=("Score",)), "Score", config, listed)
            found.write.mode("overwrite").parquet(f"{target}/batch={number}")

        started = rows.writeStream.foreachBatch(evaluated).option("checkpointLocation", checkpoint)
        return (started.trigger(availableNow=True) if available_now else started).start()
    writer = (
        evaluate_stream(rows, config=config)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
