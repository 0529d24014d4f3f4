"""Live features and scores: a stream of events to tables of closed windows.

State is kept per (window, service, status, latency), that is, spread over all tasks however
busy one service is. A window leaves the state once the watermark has passed its end; the
features of closed windows then come from the very functions that serve batch tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pulsegrid.operators.features import features_of_counts
from pulsegrid.operators.windows import WINDOW, Sliding, event_windows
from pulsegrid.plans.scorers import Model, score
from pulsegrid.sources import ledger
from pulsegrid.sources.events import with_date
from pulsegrid.sources.sinks import score_lines, write_anomalies, write_metrics

Trigger = dict[str, object]
#: Take what is there and stop; a service would use ``{"processingTime": "10 seconds"}``.
AVAILABLE_NOW: Trigger = {"availableNow": True}


def stream_table(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Replay Parquet files as a stream, oldest file first. A single file needs a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def watermarked_windows(events: DataFrame, windows: Sliding, delay_seconds: float) -> DataFrame:
    """Events per window end, with a watermark that closes an end ``delay`` after it.

    The watermark is on the window end itself. The newest event reaches ends up to one width
    ahead, so the width is added to the delay. Bounds are exact: an event on a grid point
    belongs to the window that starts there and to the one that ends there.
    """
    micros = windows.width + round(delay_seconds * 1_000_000)
    return event_windows(events, windows).withWatermark("window_end", f"{micros} microseconds")


def closed_counts(events: DataFrame, windows: Sliding, delay_seconds: float) -> DataFrame:
    """Events per (window, status, latency) of closed windows; later rows for them are dropped.

    Events are dealt out before they are given to their windows: a task counts its share of a batch,
    where one that reads a file whole would hold a row for every window and latency in it.
    """
    dealt = events.select("service_name", "status_code", "latency_ms", "ts").repartition("ts", "latency_ms")
    rows = watermarked_windows(dealt, windows, delay_seconds)
    return rows.groupBy("window_end", "service_name", "status_code", "latency_ms").agg(
        F.count(F.lit(1)).alias("n")
    )


def closed_features(closed: DataFrame, windows: Sliding) -> DataFrame:
    """Features of closed windows: each is a pane of its own that reaches no further."""
    panes = closed.withColumn("pane_end", F.col("window_end")).withColumn("reach", F.lit(0))
    return features_of_counts(panes.drop("window_end"), windows)


def run_live(
    events: DataFrame,
    windows: Sliding,
    delay_seconds: float,
    path: str,
    model: Model | None = None,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write the closed windows of a stream under ``path``, batch by batch.

    Tables: ``closed`` (counts), ``metrics`` (features) and, given a model, ``anomalies`` and
    ``scores`` (JSON lines). A batch writes to folders named by its number, which a repeated batch
    overwrites, or adds to a growing table, which takes its number once: after a crash every window
    is there exactly once. State and progress lie in ``path/progress``.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = f"batch_id={number}"
        batch.write.mode("overwrite").parquet(f"{path}/closed/{folder}")
        closed = spark.read.schema(batch.schema).parquet(f"{path}/closed/{folder}")
        if closed.isEmpty():
            return
        features = closed_features(closed, windows)
        if model is not None:
            features.write.mode("overwrite").parquet(f"{path}/features/{folder}")
            features = spark.read.schema(features.schema).parquet(f"{path}/features/{folder}")
            scored = score(features, model)
            write_anomalies(scored, f"{path}/anomalies", "live", number)
            score_lines(scored).write.mode("overwrite").text(f"{path}/scores/{folder}")
        write_metrics(features, f"{path}/metrics", "live", number)

    return (
        closed_counts(events, windows, delay_seconds)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**trigger)
        .foreachBatch(write_batch)
        .start()
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return ledger.read(spark, f"{path}/metrics").drop("date")


def run_archive(events: DataFrame, path: str, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Second consumer of the same stream: raw events by date and service."""
    return (
        with_date(events, "ts")
        .writeStream.format("parquet")
        .partitionBy("date", "service_name")
        .option("path", f"{path}/events")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**trigger)
        .start()
    )


def run_silence(
    events: DataFrame,
    windows: Sliding,
    delay_seconds: float,
    path: str,
    model: Model | None = None,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write the windows in which a known service sent nothing, scored if there is a model."""
    from pulsegrid.streaming.silence import silent_windows

    silent = silent_windows(events, windows, delay_seconds)
    return (
        (score(silent, model) if model is not None else silent)
        .writeStream.format("parquet")
        .option("path", f"{path}/silent")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**trigger)
        .start()
    )
