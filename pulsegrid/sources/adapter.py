"""The ``events`` table seen as service log events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.session import prepare
from pulsegrid.sources.schema import EVENTS_TABLE


def as_log_events(events: DataFrame) -> DataFrame:
    """Map event rows to log rows; a projection only, so pruning and filters reach the scan."""
    slot = F.col("user_id") % 3
    kind = F.col("event_type")
    error = (
        F.when(F.col("event_id") % 4 == 0, 500)
        .when(F.col("event_id") % 4 == 1, 502)
        .when(F.col("event_id") % 4 == 2, 404)
        .otherwise(400)
    )
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(slot == 0, "auth-service")
        .when(slot == 1, "payments-service")
        .otherwise("inventory-service")
        .alias("service_name"),
        F.when(slot == 0, "us-east-1")
        .when(slot == 1, "eu-west-1")
        .otherwise("ap-southeast-1")
        .alias("region"),
        F.when(kind == "error", error)
        .when(kind == "signup", 201)
        .when(kind == "click", 204)
        .otherwise(200)
        .alias("status_code"),
        F.greatest(F.lit(1.0), F.col("value")).alias("latency_ms"),
        F.col("props").alias("message"),
        F.lit("normal").alias("anomaly_mode"),
    )


def read_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events of a table directory."""
    events = prepare(spark).read.schema(EVENTS_TABLE).parquet(f"{sf_dir}/events.parquet")
    return as_log_events(events)
