"""Small log tables for tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.functions.columns import epoch_to_timestamp, uniform
from pulsegrid.operators.features import window_features
from pulsegrid.operators.windows import Sliding

EVENT = "timestamp double, service_name string, status_code int, latency_ms double"
#: Back-to-back windows: every event lies in one.
APART = Sliding(30, 30)


def log_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Events from (timestamp, service, status, latency)."""
    frame = spark.createDataFrame(rows, EVENT)
    return frame.withColumn("ts", epoch_to_timestamp(F.col("timestamp"))).drop("timestamp")


def one_window(latencies: list[float], codes: list[int], service: str = "svc") -> list[tuple]:
    return [(1_000_000.0, service, code, float(ms)) for ms, code in zip(latencies, codes)]


def features_of(spark: SparkSession, latencies: list[float], codes: list[int]) -> dict:
    """Features of a single window whose events carry one stamp, on a grid point."""
    window = Sliding(10, 10)
    rows = window_features(log_table(spark, one_window(latencies, codes)), window).collect()
    return rows[0].asDict()


def _normal(*tag) -> Column:
    """Standard normal numbers from two hash uniforms."""
    radius = F.sqrt(-2.0 * F.ln(1.0 - uniform(*tag, "'radius'")))
    return radius * F.cos(2.0 * math.pi * uniform(*tag, "'angle'"))


def _normal_status(u: Column) -> Column:
    # Shares of the status codes in normal traffic, added up.
    return (
        F.when(u < 0.88, 200).when(u < 0.93, 201).when(u < 0.96, 204).when(u < 0.98, 400)
        .when(u < 0.99, 404).otherwise(500)
    )


def traffic(
    spark: SparkSession,
    service: str,
    events_per_window: int,
    windows: int,
    seed: int,
    spread: float = 0.2,
    first: int = 1,
) -> DataFrame:
    """Normal traffic: one window every 30 s, log-normal latencies, the usual status mix."""
    n = F.floor(events_per_window * (1 + spread * _normal(seed, f"'{service}'", "id", "'n'")))
    per_window = spark.range(first, first + windows).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(10), n).cast("int")))
    )
    tag = (seed, f"'{service}'", "id", "k")
    return per_window.select(
        F.monotonically_increasing_id().alias("event_id"),
        F.timestamp_seconds(F.col("id") * 30 - 15).alias("ts"),
        F.lit(service).alias("service_name"),
        _normal_status(uniform(*tag, "'status'")).alias("status_code"),
        F.greatest(F.lit(1.0), F.round(F.exp(4.4 + 0.5 * _normal(*tag, "'ms'")), 3)).alias(
            "latency_ms"
        ),
    )


#: Services and their events per 30 s.
RATES = (("auth-service", 150), ("payments-service", 90), ("inventory-service", 120))


def normal_features(spark: SparkSession, windows: int, seed: int) -> DataFrame:
    """Normal windows of all services."""
    events = None
    for service, rate in RATES:
        part = traffic(spark, service, rate, windows, seed)
        events = part if events is None else events.unionByName(part)
    return window_features(events, APART)
