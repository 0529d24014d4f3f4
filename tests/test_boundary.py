"""Boundaries from live scores: none without drift, the trained share after one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.columns import uniform
from pulsegrid.operators import boundary as bd

PER_DAY = 2000


def scored(spark, days: int, shift_from: int, shift: float, service: str = "svc"):
    """Scores whose lowest 5 % lie below 0, moved down by ``shift`` from a day on."""
    rows = spark.range(days * PER_DAY).withColumn("day", F.floor(F.col("id") / PER_DAY))
    draw = uniform(7, f"'{service}'", "id") - 0.05
    return rows.select(
        F.lit(service).alias("service_name"),
        F.timestamp_seconds(F.col("id") * F.lit(86400 / PER_DAY)).alias("window_end"),
        (draw / 3 - F.when(F.col("day") >= shift_from, shift).otherwise(0.0)).alias("anomaly_score"),
        "day",
    )


def shares(judged) -> dict:
    rate = F.avg(F.col("is_anomalous_live").cast("int")).alias("rate")
    return {r["day"]: r["rate"] for r in judged.groupBy("day").agg(rate).collect()}


def test_the_flagged_share_stays_after_a_shift(spark):
    rows = scored(spark, 24, 10, 0.08)
    found = bd.live_boundaries(bd.score_cells(rows), 0.05)
    per_day = {r["date"].day - 1: r for r in found.collect()}
    assert not any(per_day[d]["drifted"] for d in range(1, 11))
    assert all(per_day[d]["drifted"] for d in range(11, 24))
    rate = shares(bd.judge(rows, found))
    assert rate[10] > 0.2  # the day of the shift itself
    assert all(rate[d] == pytest.approx(0.05, abs=0.02) for d in [*range(10), *range(17, 24)])


def test_scores_that_rise_keep_their_share_too(spark):
    rows = scored(spark, 20, 5, -0.1)
    rate = shares(bd.judge(rows, bd.live_boundaries(bd.score_cells(rows), 0.05)))
    assert all(rate[d] == pytest.approx(0.05, abs=0.02) for d in range(12, 20))


def test_cells_add_up_over_parts_and_services(spark):
    rows = scored(spark, 3, 9, 0).unionByName(scored(spark, 3, 1, 0.2, "other"))
    whole = bd.score_cells(rows)
    parts = [bd.score_cells(rows.filter(F.col("anomaly_score") * 1000 % 3 < 1)),
             bd.score_cells(rows.filter(F.col("anomaly_score") * 1000 % 3 >= 1))]
    added = bd.merged(parts[0].unionByName(parts[1]))
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))
    drifted = {(r["service_name"], r["date"].day): r["drifted"] for r in bd.live_boundaries(whole, 0.05).collect()}
    assert drifted == {("svc", 2): False, ("svc", 3): False, ("other", 2): False, ("other", 3): True}


def test_odd_rows(spark):
    schema = "service_name string, window_end timestamp, anomaly_score double"
    empty = spark.createDataFrame([], schema)
    assert bd.live_boundaries(bd.score_cells(empty), 0.05).count() == 0
    rows = empty.unionByName(
        spark.sql(
            "SELECT 'a' AS service_name, timestamp '2024-01-01' + make_interval(0, 0, 0, d) AS window_end, s AS anomaly_score "
            "FROM VALUES (0, -0.5D), (0, null), (0, double('nan')), (1, -0.25D), (30, 0.0D), (30, -0.0D) AS t(d, s)"
        )
    )
    found = bd.live_boundaries(bd.score_cells(rows), 0.05, sigmas=1.0).collect()
    assert [(str(r["date"]), r["windows"], r["flagged"], r["boundary"]) for r in found] == [("2024-01-02", 1, 1, -0.5)]
    judged = bd.judge(rows, bd.live_boundaries(bd.score_cells(rows), 0.05, sigmas=1.0))
    assert judged.count() == 6 and judged.filter("is_anomalous_live").count() == 1
