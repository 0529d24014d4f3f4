"""Joins with spans of any length against all pairs; sketches, bounds and versions on small tables."""

from __future__ import annotations

import random

import pytest
from logs import log_table
from pyspark.sql import functions as F

from pulsegrid.operators import sketches, spans as sp
from pulsegrid.operators.windows import Sliding
from pulsegrid.plans import reports, scorers

SECOND = 1_000_000
YEARS = 400 * 365 * 86_400 * SECOND


def stamps(frame, *names):
    return frame.withColumns({n: F.timestamp_micros(n) for n in names})


def random_spans(draw, n):
    out = []
    for i in range(n):
        length = int(10 ** draw.uniform(0, 16))
        start = draw.randint(-YEARS // 4, YEARS // 4)
        out.append((f"s{draw.randint(0, 2)}", start, start + length, f"m{i}"))
    out += [out[0][:3] + ("same",), ("s0", 5, 5, "empty"), ("s0", 9, 5, "backwards"), ("s1", 0, 1, "tiny")]
    return out


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(4)
    rows = random_spans(draw, 60)
    edges = [at + d for _, start, stop, _ in rows for at in (start, stop) for d in (-1, 0, 1)]
    points = [(i, f"s{i % 4}", at) for i, at in enumerate(edges + [draw.randint(-YEARS, YEARS) for _ in range(300)])]
    spans = stamps(spark.createDataFrame(rows, "service_name string, start long, stop long, mode string"), "start", "stop")
    return rows, points, spans, stamps(spark.createDataFrame(points, "id long, service_name string, ts long"), "ts")


def test_points_meet_every_span_that_holds_them(tables):
    rows, points, spans, frame = tables
    got = sp.holding(frame, "ts", spans, ("service_name",)).select("id", "mode").collect()
    want = [(i, m) for i, s, at in points for k, start, stop, m in rows if k == s and start <= at < stop]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 100


def test_a_span_is_few_intervals(tables):
    rows, _, spans, _ = tables
    counts = sp.cover(spans).groupBy("mode").count().collect()
    assert max(r["count"] for r in counts) <= 2 * 15 * sp.LEVELS
    assert {r["mode"] for r in counts} == {m for _, start, stop, m in rows if start < stop}


def test_the_latest_start_holds(tables):
    rows, points, spans, frame = tables
    apart = sp.disjoint(spans, ("service_name",), "mode")
    got = {r["id"]: r["mode"] for r in sp.lookup(frame, "ts", apart, ("service_name",)).collect()}
    assert len(got) == len(points)
    for i, s, at in points:
        held = [(start, -stop, m) for k, start, stop, m in rows if k == s and start <= at < stop]
        assert got[i] == (max(held)[2] if held else None)


def test_no_spans(spark, tables):
    _, points, spans, frame = tables
    assert sp.holding(frame, "ts", spans.limit(0), ("service_name",)).count() == 0
    none = sp.lookup(frame, "ts", sp.disjoint(spans.limit(0), ("service_name",), "mode"), ("service_name",))
    assert none.filter("mode IS NULL").count() == len(points)


def test_sketches_merge_over_any_range(spark):
    draw = random.Random(2)
    rows = [(t / 50, f"s{t % 2}", 200, round(draw.lognormvariate(4, 1.5), 3)) for t in range(40_000)]
    panes = sketches.pane_sketches(log_table(spark, rows), Sliding(30, 10))
    for part, low, high in ((panes, 0, 800), (panes.filter("pane_end > timestamp_seconds(100) AND pane_end <= timestamp_seconds(300)"), 100, 300)):
        found = sketches.quantiles(sketches.merged(part, "service_name")).collect()
        assert len(found) == 2
        for r in found:
            mine = sorted(v for t, s, _, v in rows if s == r["service_name"] and low < t <= high or (t == low == 0 and s == r["service_name"]))
            assert r["n"] == len(mine)
            for p in (50, 95, 99):
                value = r[f"p{p}_latency_ms"]
                below = sum(v < value for v in mine) / len(mine)
                upto = sum(v <= value for v in mine) / len(mine)
                assert below - sketches.RANK_ERROR <= p / 100 <= upto + sketches.RANK_ERROR
    plan = sketches.merged(panes, "service_name")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # panes, then their sketches


def test_bounds_hold_the_rate(spark):
    draw = random.Random(5)
    rows = [("s", i * 10, draw.random() < (0.8 if i % 3 == 0 else 0.1), i % 3 == 0) for i in range(900)]
    frame = spark.createDataFrame(rows, "service_name string, e long, is_anomalous boolean, hit boolean").withColumn(
        "window_end", F.timestamp_seconds("e")
    )
    modes = frame.select("service_name", "window_end", F.when(F.col("hit"), "error_burst").otherwise("normal").alias("anomaly_mode"))
    (row,) = reports.confidence(frame, modes, replicates=300).collect()
    recall = sum(a for _, _, a, h in rows if h) / 300
    assert abs(row["recall"] - recall) < 1e-8
    wide = 1.96 * (recall * (1 - recall) / 300) ** 0.5
    for end, sign in (("low", -1), ("high", 1)):
        assert abs(row[f"recall_{end}"] - (recall + sign * wide)) < 0.015
    none = reports.confidence(frame.limit(0), modes).collect()
    assert none == []


def test_versions_hold_from_their_time_on(spark, monkeypatch):
    monkeypatch.setattr(scorers, "score", lambda rows, model: rows.withColumn("anomaly_score", F.lit(model)).withColumn("is_anomalous", F.lit(model < 0)))
    frame = spark.createDataFrame([(t,) for t in (5, 10, 15, 20, 25)], "t long").select(F.timestamp_seconds("t").alias("window_end"), "t")
    versions = spark.createDataFrame([("a", 10), ("b", 20), ("b2", 20)], "model_version string, at long").select(
        "model_version", F.timestamp_seconds("at").alias("valid_from")
    )
    got = scorers.score_as_of(frame, versions, {"a": 0.5, "b": 0.1, "b2": -0.5}).collect()
    assert sorted((r["t"], r["model_version"], r["anomaly_score"]) for r in got) == [
        (5, None, None), (10, "a", 0.5), (15, "a", 0.5), (20, "b2", -0.5), (25, "b2", -0.5),
    ]
