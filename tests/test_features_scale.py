"""Features against brute force on crowded and skewed windows, properties, and plans."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from logs import log_table
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsegrid.operators import percentiles, windows as wn
from pulsegrid.operators.features import FEATURES, count_rows, spine_features, window_features

WINDOWS = wn.Sliding(30, 10)


def brute_force(rows: list[tuple], windows: wn.Sliding) -> dict:
    members = defaultdict(list)
    for ts, service, status, latency in rows:
        end = math.ceil(ts / 10) * 10
        while end - 30 <= ts:
            members[service, end].append((status, latency))
            end += 10
    result = {}
    for key, events in members.items():
        n = len(events)
        latencies = sorted(ms for _, ms in events)
        shares = [c / n for c in Counter(code for code, _ in events).values()]
        ranks = [max(0, math.ceil(p / 100.0 * n) - 1) for p in (50, 95, 99)]
        result[key] = [
            float(n),
            sum(code >= 500 for code, _ in events) / n,
            *[latencies[r] for r in ranks],
            -sum(p * math.log(p) for p in shares),
        ]
    return result


def skewed_rows() -> list[tuple]:
    """One service holds most rows; its latencies crowd into a few cells, some at one value."""
    rng = random.Random(3)
    rows = []
    for _ in range(20_000):
        latency = rng.choice([30_000.0, 30_000.0 + rng.random() / 100, rng.lognormvariate(4, 1)])
        rows.append((rng.uniform(0, 60), "hot", rng.choice([200, 500, 404]), latency))
    for _ in range(500):
        rows.append((float(rng.randrange(0, 61)), "cold", 200, rng.choice([-5.0, 0.0, 0.25, 7.0])))
    return rows


def test_matches_brute_force_under_skew(spark):
    rows = skewed_rows()
    rows = [(round(ts, 6), *rest) for ts, *rest in rows]
    want = brute_force(rows, WINDOWS)
    got = window_features(log_table(spark, rows), WINDOWS).collect()
    assert len(got) == len(want)
    for row in got:
        expected = want[row.service_name, int(row.window_end.timestamp())]
        assert [row[c] for c in FEATURES] == pytest.approx(expected, abs=1e-9)


def test_properties(spark):
    rows = [r for r in skewed_rows() if r[0] % 10 != 0]
    logs = log_table(spark, rows)
    features = window_features(logs, WINDOWS)
    bad = features.filter(
        "error_rate < 0 OR error_rate > 1 OR p50_latency_ms > p95_latency_ms "
        "OR p95_latency_ms > p99_latency_ms OR status_entropy < 0 "
        f"OR status_entropy > {math.log(3) + 1e-9}"
    )
    assert bad.count() == 0
    assert features.agg(F.sum("request_count")).first()[0] == 3 * len(rows)


def test_hot_cell_is_split(spark):
    """Nine tenths of the events in one cell of one window: the join is cut into pieces."""
    rows = spark.range(200_000).select(
        F.timestamp_micros(F.col("id") * 100).alias("ts"),
        F.lit("hot").alias("service_name"),
        F.lit(200).alias("status_code"),
        F.when(F.col("id") % 10 == 0, F.col("id") / 1000)
        .otherwise(30_000 + F.xxhash64("id") % 10_000 / 1000)
        .alias("latency_ms"),
    ).repartition(16)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        features = window_features(rows, wn.Sliding(60, 60))
        by_end = {r.window_end.timestamp(): r for r in features.collect()}
        assert "skew=true" in features._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert by_end[60].request_count == 200_000 and 29_990 < by_end[60].p50_latency_ms < 30_010


def test_a_million_values_in_one_cell(spark):
    """No task ranks more than a small part of them."""
    n = 1_000_000
    rows = spark.range(n).select(
        F.timestamp_micros(F.col("id") * 10).alias("ts"),
        F.lit("hot").alias("service_name"),
        F.lit(200).alias("status_code"),
        (100.0 + 0.2 * (F.xxhash64("id") % 500_000_000 + 500_000_000) / 1e9).alias("latency_ms"),
    )
    windows = wn.Sliding(60, 60)
    counts = count_rows(rows, windows)
    cells = counts.selectExpr(*wn.PANE, percentiles.LATENCY_CELL, "n").groupBy(*wn.PANE, "cell").agg(F.sum("n").alias("n"))
    held = percentiles._cells_holding_ranks(cells, windows, (50, 99))
    values = percentiles._values_of_cells(held, counts, windows).cache()
    per_cell = values.groupBy(*wn.WINDOW, "percent").count().agg(F.max("count")).first()[0]
    per_part = values.groupBy(*wn.WINDOW, "percent", "part").count().agg(F.max("count")).first()[0]
    assert per_cell > 300_000 and per_part < 1000
    found = percentiles.nearest_ranks(cells, counts, windows, (50, 99)).filter("window_end = timestamp_seconds(60)").first()
    values = sorted(r[0] for r in rows.filter("ts > timestamp_seconds(0)").select("latency_ms").collect())
    everything = sorted(values + [rows.filter("ts = timestamp_seconds(0)").first()["latency_ms"]])
    assert (found.p50, found.p99) == (everything[n // 2 - 1], everything[99 * n // 100 - 1])


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + (
        df._jdf.queryExecution().executedPlan().toString()
    )


def test_feature_plan_reads_four_columns_and_stays_in_the_jvm(spark, tmp_path):
    logs = log_table(spark, skewed_rows()[:100])
    logs.withColumn("message", F.lit("m")).withColumn("region", F.lit("r")).write.parquet(
        f"{tmp_path}/logs"
    )
    plan = plan_of(spine_features(spark.read.parquet(f"{tmp_path}/logs"), WINDOWS))
    assert "ReadSchema" in plan
    for schema in [part.split(">")[0] for part in plan.split("ReadSchema: ")[1:]]:
        assert "message" not in schema and "region" not in schema
    for unwanted in ("Python", "Cartesian", "NestedLoop", "collect_list", "percentile"):
        assert unwanted not in plan


@pytest.mark.parametrize("name, scans", [("s1_decode_events", 1), ("i5_labelled_union", 1), ("a4_status_histogram", 1)])
def test_queries_read_their_table_once(spark, name, scans):
    frame = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == scans and plan.count("from_json") <= 1
