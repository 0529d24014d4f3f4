"""The six window features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions.columns import settle_sql
from pulsegrid.operators.percentiles import LATENCY_CELL, nearest_ranks
from pulsegrid.operators.windows import (
    PANE,
    WINDOW,
    Sliding,
    add_pane,
    event_bounds,
    spine,
    to_windows,
)

#: Feature order of the model input (fixed values).
FEATURES = (
    "request_count",
    "error_rate",
    "p50_latency_ms",
    "p95_latency_ms",
    "p99_latency_ms",
    "status_entropy",
)
PERCENTS = (50, 95, 99)


def pane_histogram(counts: DataFrame) -> DataFrame:
    """Status and coarse latency histogram per pane: all that most features need.

    Partial aggregation happens beside the scan, so a busy pane shuffles some
    thousand cells instead of its events.
    """
    return (
        counts.selectExpr(*PANE, "status_code", LATENCY_CELL, "n")
        .groupBy(*PANE, "status_code", "cell")
        .agg(F.sum("n").alias("n"))
    )


def status_histogram(histogram: DataFrame, windows: Sliding) -> DataFrame:
    """Events per window and status code."""
    return (
        to_windows(histogram, windows)
        .groupBy(*WINDOW, "status_code")
        .agg(F.sum("n").alias("n"))
    )


def traffic(statuses: DataFrame) -> DataFrame:
    """Request count, error rate and status entropy per window from the status histogram.

    Entropy is in nats, as ln N - (sum of c ln c) / N over the counts c of the codes.
    """
    errors = "sum(CASE WHEN status_code >= 500 THEN n ELSE 0 END)"
    return statuses.groupBy(*WINDOW).agg(
        F.expr("double(sum(n))").alias("request_count"),
        F.expr(settle_sql(f"{errors} / sum(n)")).alias("error_rate"),
        F.expr(f"abs({settle_sql('ln(sum(n)) - sum(n * ln(n)) / sum(n)')})").alias(
            "status_entropy"
        ),
    )


def count_rows(events: DataFrame, windows: Sliding) -> DataFrame:
    """Events as pane rows of weight one."""
    return add_pane(events, windows).selectExpr(*PANE, "status_code", "latency_ms", "1L AS n")


def latency(histogram: DataFrame, counts: DataFrame, windows: Sliding) -> DataFrame:
    """The latency percentiles per window."""
    return nearest_ranks(histogram, counts, windows, PERCENTS).toDF(
        *WINDOW, *[f"p{p}_latency_ms" for p in PERCENTS]
    )


def window_traffic(events: DataFrame, windows: Sliding) -> DataFrame:
    """The features that need no latencies, per non-empty window."""
    panes = add_pane(events, windows).groupBy(*PANE, "status_code")
    return traffic(status_histogram(panes.agg(F.count(F.lit(1)).alias("n")), windows))


def window_latency(events: DataFrame, windows: Sliding) -> DataFrame:
    """The latency percentiles per non-empty window."""
    counts = count_rows(events, windows)
    cells = counts.selectExpr(*PANE, LATENCY_CELL, "n").groupBy(*PANE, "cell")
    return latency(cells.agg(F.sum("n").alias("n")), counts, windows)


def features_of_counts(counts: DataFrame, windows: Sliding) -> DataFrame:
    """Features from rows (pane, status_code, latency_ms, n)."""
    histogram = pane_histogram(counts)
    return (
        traffic(status_histogram(histogram, windows))
        .join(latency(histogram, counts, windows), list(WINDOW))
        .select(*WINDOW, *FEATURES)
    )


def window_features(events: DataFrame, windows: Sliding) -> DataFrame:
    """One feature row per service and non-empty window."""
    return features_of_counts(count_rows(events, windows), windows)


def spine_features(events: DataFrame, windows: Sliding) -> DataFrame:
    """One row per service and window end, all zeros where the service was silent.

    Ends after the last complete one, which see only part of their window, are left out.
    """
    return (
        spine(event_bounds(events, windows), windows)
        .join(window_features(events, windows), list(WINDOW), "left")
        .na.fill(0.0, list(FEATURES))
        .select(*WINDOW, *FEATURES)
    )


def model_vector() -> Column:
    """The six features in model order."""
    return F.array(*[F.col(name) for name in FEATURES])


def corpus_means(features: DataFrame) -> DataFrame:
    """Mean of every feature over a training corpus."""
    return features.agg(
        F.count(F.lit(1)).alias("windows"), *[F.avg(name).alias(name) for name in FEATURES]
    )
