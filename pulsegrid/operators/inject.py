"""Labelled anomalies put into an existing event table.

Rows outside the injected spans keep their values. Every draw is a hash of (seed, event id),
so the same events are changed on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions.columns import mode_label, settle, uniform
from pulsegrid.operators.spans import disjoint, lookup

# Status codes of the two status modes, their shares and the latency factors.
BURST_CODES = (500, 502, 503, 504)
BURST_SHARE = 0.8
UNUSUAL_CODES = (206, 301, 302, 304, 401, 403, 429, 503)
UNUSUAL_SHARE = 0.7
SPIKE_FACTORS = (20.0, 40.0)
LATENCY_DIGITS = 3

MODES = ("latency_spike", "error_burst", "unusual_status")

KEY = ("service_name",)


def _one_of(codes: tuple[int, ...], u: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(code) for code in codes]), F.floor(u * len(codes)).cast("int") + 1
    )


def inject(events: DataFrame, mode: Column | str, seed: int = 42) -> DataFrame:
    """Apply an anomaly mode, a name or a column of names, and set the label."""
    mode = mode_label(F.lit(mode) if isinstance(mode, str) else mode)
    hit, pick = uniform(seed, "event_id", 1), uniform(seed, "event_id", 2)
    low, high = SPIKE_FACTORS
    spiked = settle(F.col("latency_ms") * (low + (high - low) * hit), LATENCY_DIGITS)
    status = F.col("status_code")
    burst = F.when(hit < BURST_SHARE, _one_of(BURST_CODES, pick)).otherwise(200)
    unusual = F.when(hit < UNUSUAL_SHARE, _one_of(UNUSUAL_CODES, pick)).otherwise(status)
    return events.withColumns(
        {
            "latency_ms": F.when(mode == "latency_spike", spiked).otherwise(F.col("latency_ms")),
            "status_code": F.when(mode == "error_burst", burst)
            .when(mode == "unusual_status", unusual)
            .otherwise(status),
            "anomaly_mode": mode,
        }
    )


def inject_spans(events: DataFrame, spans: DataFrame, seed: int = 42) -> DataFrame:
    """Inject into one service and time span at a time.

    ``spans`` has service_name, start (inclusive), stop (exclusive) and mode, of any length. Where spans
    of a service overlap, the one that started last holds, of those the one that stops first, then the
    largest mode by name: an event is changed once.
    """
    apart = disjoint(spans.select(*KEY, "start", "stop", F.col("mode").alias("mode_of_span")), KEY, "mode_of_span")
    matched = lookup(events, "ts", apart, KEY)
    changed = inject(matched, F.coalesce(F.col("mode_of_span"), F.col("anomaly_mode")), seed)
    return changed.select(*events.columns)


def labelled_union(events: DataFrame, seed: int = 42) -> DataFrame:
    """The events as they are and once per anomaly mode, labelled: a test set."""
    modes = F.array(*map(F.lit, ("normal", *MODES)))
    every = events.withColumn("mode_of_copy", F.explode(modes))
    return inject(every, F.col("mode_of_copy"), seed).drop("mode_of_copy")
