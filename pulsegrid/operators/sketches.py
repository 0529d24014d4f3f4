"""Latency quantiles from sketches that merge: one per pane, put together for any windows or range.

For windows too large for exact ranks. A sketch of some kilobytes stands for all latencies of a pane;
panes are sketched beside the scan, and only sketches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsegrid.operators.features import PERCENTS
from pulsegrid.operators.windows import PANE, WINDOW, Sliding, add_pane, to_windows

K = 400  #: size of a sketch; ranks are off by about 0.7 % with it
RANK_ERROR = 0.015  #: of all ranks; off by more in less than one of a hundred sketches of size K


def pane_sketches(events: DataFrame, windows: Sliding, k: int = K) -> DataFrame:
    """``(service, pane, sketch, n)``: a table to keep, from which any windows can be had later."""
    return add_pane(events, windows).groupBy(*PANE).agg(
        F.kll_sketch_agg_double("latency_ms", k).alias("sketch"), F.count("latency_ms").alias("n")
    )


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """One sketch for all of ``sketches`` that have the same columns ``by``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def window_sketches(panes: DataFrame, windows: Sliding) -> DataFrame:
    """The sketches of all windows that panes lie in."""
    return merged(to_windows(panes, windows), *WINDOW)


def quantiles(sketches: DataFrame, percents: tuple[int, ...] = PERCENTS) -> DataFrame:
    """Adds the latency at each percent, as ``p50_latency_ms`` and so on; the sketch goes."""
    at = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)).alias(f"p{p}_latency_ms")
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *map(at, percents))
