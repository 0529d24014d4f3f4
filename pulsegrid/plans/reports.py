"""Reports on features and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.functions.columns import MICROS, mode_label, settle, uniform, utc_date
from pulsegrid.operators.spans import holding
from pulsegrid.operators.windows import PANE, WINDOW, Sliding, add_pane, to_windows


def rate_panel(counts: DataFrame, windows: Sliding) -> DataFrame:
    """Requests per second and error rate per service over time, from window counts."""
    return counts.select(
        *WINDOW,
        settle(F.col("n") / F.lit(windows.width_seconds)).alias("requests_per_second"),
        settle(F.col("errors") / F.col("n")).alias("error_rate"),
    ).orderBy(*WINDOW)


def latency_panel(features: DataFrame) -> DataFrame:
    """Latency percentiles per service over time."""
    return features.select(
        *WINDOW, "p50_latency_ms", "p95_latency_ms", "p99_latency_ms"
    ).orderBy(*WINDOW)


def score_panel(scored: DataFrame) -> DataFrame:
    """Score series; flagged points once more in a column of their own."""
    return scored.select(
        *WINDOW,
        "anomaly_score",
        F.when(F.col("is_anomalous"), F.col("anomaly_score")).alias("flagged_score"),
    ).orderBy(*WINDOW)


def alert_edges(scored: DataFrame) -> DataFrame:
    """Flagged windows whose service was not flagged in its window before, however long ago.

    The window before is looked up within a day; for a day's first window it is the last of the
    service's day before. So no task sees more of a service than a day, or its days.
    """
    rows = scored.select(
        *WINDOW, "anomaly_score", "is_anomalous", utc_date(F.col("window_end")).alias("day")
    )
    days = rows.groupBy("service_name", "day").agg(
        F.max_by("is_anomalous", "window_end").alias("last_flag")
    )
    by_day = Window.partitionBy("service_name").orderBy("day")
    before = days.select("service_name", "day", F.lag("last_flag").over(by_day).alias("day_before"))
    within = Window.partitionBy("service_name", "day").orderBy("window_end")
    return (
        rows.withColumn("before", F.lag("is_anomalous").over(within))
        .join(before, ["service_name", "day"])
        .filter(F.col("is_anomalous") & ~F.coalesce("before", "day_before", F.lit(False)))
        .select(*WINDOW, "anomaly_score")
    )


def region_rollup(events: DataFrame) -> DataFrame:
    """Requests, error rate and highest latency per service, per region and overall."""
    per_service = events.groupBy("region", "service_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status_code") >= 500).alias("errors"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
    return per_service.rollup("region", "service_name").agg(
        F.sum("n").alias("requests"),
        settle(F.sum("errors") / F.sum("n")).alias("error_rate"),
        F.max("max_latency_ms").alias("max_latency_ms"),
    )


def window_modes(events: DataFrame, windows: Sliding) -> DataFrame:
    """The anomaly mode seen in each non-empty window, ``normal`` if none."""
    mode = F.nullif(mode_label(F.col("anomaly_mode")), F.lit("normal"))
    panes = add_pane(events, windows).groupBy(*PANE).agg(F.max(mode).alias("mode"))
    return (
        to_windows(panes, windows)
        .groupBy(*WINDOW)
        .agg(F.coalesce(F.max("mode"), F.lit("normal")).alias("anomaly_mode"))
    )


def _share(part: Column, whole: Column) -> Column:
    return settle(F.when(whole > 0, part / whole))


def confusion(scored: DataFrame, modes: DataFrame, *keys: str) -> DataFrame:
    """Recall and false-positive rate per service (or other keys) against the labels."""
    keys = keys or ("service_name",)
    labelled = scored.join(modes, list(WINDOW), "left").withColumn(
        "injected", F.coalesce(F.col("anomaly_mode"), F.lit("normal")) != "normal"
    )
    flagged, injected = F.col("is_anomalous"), F.col("injected")
    return (
        labelled.groupBy(*keys)
        .agg(
            F.count_if(injected & flagged).alias("true_positives"),
            F.count_if(injected & ~flagged).alias("false_negatives"),
            F.count_if(~injected & flagged).alias("false_positives"),
            F.count_if(~injected & ~flagged).alias("true_negatives"),
        )
        .withColumn(
            "recall",
            _share(F.col("true_positives"), F.col("true_positives") + F.col("false_negatives")),
        )
        .withColumn(
            "false_positive_rate",
            _share(F.col("false_positives"), F.col("false_positives") + F.col("true_negatives")),
        )
    )


def compare_models(scored: DataFrame, modes: DataFrame) -> DataFrame:
    """Recall and false-positive rate per model version and service."""
    return confusion(scored, modes, "model_version", "service_name")


#: How likely a Poisson draw of mean one is at most 0, 1, 2, ...; beyond 9 once in a million.
POISSON = (
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.999998874797402, 0.9999998885745217,
)


def confidence(
    scored: DataFrame, modes: DataFrame, *keys: str, replicates: int = 200, level: float = 0.95, seed: int = 42
) -> DataFrame:
    """Recall and false-positive rate per key, with the bounds that hold them at ``level``.

    Bounds are nearest-rank percentiles over replicates, each of which counts every window as often as
    a Poisson draw of mean one says (a bootstrap without drawing rows). Draws are hashes of seed, service,
    window and replicate. One aggregation: replicates of a window are summed beside the scan. Null where
    no replicate has a window that counts.
    """
    keys = keys or ("service_name",)
    labelled = scored.select(*{*keys, *WINDOW}, "is_anomalous").join(modes, list(WINDOW), "left")
    injected = F.coalesce(F.col("anomaly_mode"), F.lit("normal")) != "normal"
    drawn = labelled.withColumn("injected", injected).withColumn(
        "replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates)))
    )
    u = uniform(seed, "'weight'", "service_name", "unix_micros(window_end)", "replicate")
    weight = sum((F.when(u >= p, 1).otherwise(0) for p in POISSON), F.lit(0))
    # Replicate 0 is the table as it is.
    drawn = drawn.withColumn("weight", F.when(F.col("replicate") == 0, 1).otherwise(weight))
    of = lambda condition: F.sum(F.when(condition, F.col("weight")).otherwise(0))
    hit, flagged = F.col("injected"), F.col("is_anomalous")
    rates = drawn.groupBy(*keys, "replicate").agg(
        _share(of(hit & flagged), of(hit)).alias("recall"),
        _share(of(~hit & flagged), of(~hit)).alias("false_positive_rate"),
    )
    out = []
    for name in ("recall", "false_positive_rate"):
        again = F.when(F.col("replicate") > 0, F.col(name))
        rates = rates.withColumn(f"{name}_again", again)
        out.append(F.max(F.when(F.col("replicate") == 0, F.col(name))).alias(name))
        for end, share in (("low", (1 - level) / 2), ("high", (1 + level) / 2)):
            rank = F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY {name}_again)")
            out.append(rank.alias(f"{name}_{end}"))
    return rates.groupBy(*keys).agg(*out)


def detection_delay(scored: DataFrame, spans: DataFrame, windows: Sliding) -> DataFrame:
    """Seconds from the start of each injected span to the first flagged window that sees it.

    Null where no window that overlaps the span was flagged.
    """
    ends = spans.select(
        "service_name", "mode", "start", (F.col("stop") + _seconds(windows.width)).alias("stop")
    )
    flagged = scored.filter("is_anomalous").select(*WINDOW)
    first = holding(flagged, "window_end", ends, ("service_name",)).groupBy("service_name", "mode", "start").agg(
        F.min("window_end").alias("first_flag")
    )
    delay = (F.unix_micros("first_flag") - F.unix_micros("start")) / F.lit(float(MICROS))
    seen = ends.select("service_name", "mode", "start").distinct()
    return seen.join(first, ["service_name", "mode", "start"], "left").select(
        "service_name", "mode", "start", delay.alias("delay_seconds")
    )


def _seconds(micros: int) -> Column:
    return F.make_dt_interval(secs=F.lit(micros / MICROS))


def profile_drift(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Observed events per second of each service beside its profile.

    The rate is taken over the whole time the table spans; services missing on either side
    show up with nulls there.
    """
    observed = events.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    span = observed.agg(
        (F.unix_micros(F.max("last")) - F.unix_micros(F.min("first"))) / F.lit(float(MICROS))
    )
    rate = F.col("events") / F.nullif(span.scalar(), F.lit(0.0))
    return (
        observed.select("service_name", "events", rate.alias("observed_per_second"))
        .join(profiles, "service_name", "full")
        .select(
            "service_name",
            "events",
            settle(F.col("observed_per_second")).alias("observed_per_second"),
            F.col("events_per_second").alias("profile_per_second"),
            settle(F.col("observed_per_second") / F.col("events_per_second")).alias("drift"),
        )
    )
