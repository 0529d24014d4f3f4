"""Alerts of a stream: edges over restarts, time to cool down, windows that come again."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import reports
from pulsegrid.streaming import alerts, live


def scored(spark, rows):
    frame = spark.createDataFrame(rows, "service_name string, e long, is_anomalous boolean")
    return frame.select(
        "service_name", F.timestamp_seconds("e").alias("window_end"),
        F.when(F.col("is_anomalous"), -0.25).otherwise(0.25).alias("anomaly_score"), "is_anomalous",
    )


def plainly(rows, cooldown):
    out, last, quiet = [], {}, {}
    for service, at, flag in sorted(rows, key=lambda r: r[1]):
        if flag and not last.get(service) and at >= quiet.get(service, at):
            out.append((service, at))
            quiet[service] = at + cooldown
        last[service] = flag
    return sorted(out)


@pytest.mark.parametrize("cooldown", [0, 60])
def test_alerts_over_restarts(spark, tmp_path, cooldown):
    draw = random.Random(3)
    rows = [(f"s{i}", t * 10, draw.random() < 0.4) for t in range(60) for i in range(2)]
    for number, part in enumerate((rows[:50], rows[40:90], rows[90:])):  # some windows come again
        scored(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = live.stream_table(spark, str(tmp_path / "in"), scored(spark, part).schema)
        alerts.run_alerts(stream, str(tmp_path / "out"), cooldown).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "alerts"))
    found = sorted((r[0], r[1]) for r in got.select("service_name", F.unix_seconds("window_end")).collect())
    assert found == plainly(rows, cooldown) and found
    if not cooldown:
        edges = reports.alert_edges(scored(spark, rows)).select("service_name", F.unix_seconds("window_end"))
        assert found == sorted(map(tuple, edges.collect()))
