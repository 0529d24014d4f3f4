"""Training corpus with the same number of windows for every service."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulsegrid.functions.columns import mode_label, uniform
from pulsegrid.operators.windows import Sliding, shifted_sql

#: Candidates kept per wanted row before ranking, and a floor for tiny samples: the chance of
#: ending up short is below e^-50.
OVERDRAW, OVERDRAW_FLOOR = 4, 64


#: What identifies a window inside a hash tag.
ROW_TAG = ("service_name", "unix_micros(window_end)")


def without_warm_up(features: DataFrame, windows: Sliding) -> DataFrame:
    """Drop the first windows of each service, which reach back before its first event."""
    first = features.groupBy("service_name").agg(F.min("window_end").alias("first_window"))
    full = F.expr(shifted_sql("first_window", windows.max_reach - 1, windows))
    return (
        features.join(first, "service_name").filter(F.col("window_end") >= full).drop("first_window")
    )


def short_services(
    corpus: DataFrame, features: DataFrame, n_samples: int = 6000, least_windows: int = 1
) -> DataFrame:
    """Services of which ``corpus`` holds fewer windows than the quota, though ``features`` has more."""
    if "anomaly_mode" in features.columns:
        features = features.filter(mode_label(F.col("anomaly_mode")) == "normal")
    sizes = (
        features.groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") >= least_windows)
    )
    quota = sizes.agg(F.ceil(F.lit(n_samples) / F.count(F.lit(1))).cast("bigint")).scalar()
    held = corpus.groupBy("service_name").agg(F.count(F.lit(1)).alias("held"))
    return (
        sizes.withColumn("quota", quota)
        .join(held, "service_name", "left")
        .filter(F.coalesce("held", F.lit(0)) < F.least("quota", "size"))
    )


def balanced_corpus(
    features: DataFrame,
    n_samples: int = 6000,
    seed: int = 42,
    least_windows: int = 1,
    overdraw: int = OVERDRAW,
) -> DataFrame:
    """The same number of windows of every service that has as many, ``n_samples`` together.

    Each service gives ``n_samples / services`` windows, or all it has; only services with fewer
    than ``least_windows`` are left out. Where rows carry ``anomaly_mode``, only normal ones
    count. Windows are drawn by hash: those with the lowest numbers. Only those below a
    threshold that lets through about four times the quota are ranked, so the ranking of a
    service never sees more rows than that; :func:`short_services` tells whether that was enough.
    """
    if "anomaly_mode" in features.columns:
        features = features.filter(mode_label(F.col("anomaly_mode")) == "normal")
    sizes = (
        features.groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") >= least_windows)
    )
    share = sizes.agg(F.ceil(F.lit(n_samples) / F.count(F.lit(1))).cast("bigint"))
    quota = F.col("quota")
    drawn = (
        features.join(sizes.withColumn("quota", share.scalar()), "service_name")
        .withColumn("u", uniform(seed, "'corpus'", *ROW_TAG))
        .filter(F.col("u") * F.col("size") < quota * overdraw + OVERDRAW_FLOOR)
    )
    order = Window.partitionBy("service_name").orderBy("u", "window_end")
    return (
        drawn.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= quota)
        .drop("u", "size", "quota", "place")
    )
