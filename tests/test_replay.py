"""Replays of tables as streams: slices in time order, counted by all tasks."""

from __future__ import annotations

import duckdb
from compare import connect, differences
from logs import log_table

from pyspark.sql import functions as F

from pulsegrid.operators.windows import Sliding
from pulsegrid.plans import catalog
from pulsegrid.plans.oracle import all_sql
from pulsegrid.streaming import live

#: Events of thirty days in no order, four at a time.
EVENTS = """
SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_microseconds((hash(i // 4) % 2592000000000)::BIGINT) AS ts,
  i % 50 AS user_id, CASE i % 5 WHEN 0 THEN 'error' ELSE 'click' END AS event_type,
  (hash(i * 7) % 1000) / 4.0 AS value, '{}' AS props
FROM range(3000) r(i) ORDER BY hash(i * 3)
"""


def test_replay_takes_bounded_batches(spark, tmp_path, monkeypatch):
    """However many events there are, and with the results of one batch of them all."""
    duckdb.sql(EVENTS).write_parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "REPLAY_ROWS", 1000, raising=False)
    run_live, queries = live.run_live, []
    monkeypatch.setattr(live, "run_live", lambda *args: queries.append(run_live(*args)) or queries[-1])
    found = catalog.w6_late_rows(spark, str(tmp_path))
    assert differences(found, connect(str(tmp_path)), all_sql()["w6_late_rows"]) == []
    batches = [p["numInputRows"] for query in queries for p in query.recentProgress]
    assert sum(batches) == 3000 and max(batches) <= 1100


def test_slices_are_in_time_order_and_whole(spark, monkeypatch):
    monkeypatch.setattr(catalog, "REPLAY_ROWS", 100)
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 9 != 0, F.timestamp_seconds(F.col("id") * 7919 % 1000 - F.col("id") * 7919 % 5)).alias("ts")
    )
    slices = catalog._in_time_order(rows)
    spans = [part.agg(F.min("ts"), F.max("ts")).first() for part in slices]
    assert len(slices) > 5 and all(before[1] < after[0] for before, after in zip(spans, spans[1:]))
    assert sorted(r.id for part in slices for r in part.collect()) == list(range(1000))
    nulls = rows.withColumn("ts", F.lit(None).cast("timestamp"))
    assert [part.count() for part in catalog._in_time_order(nulls)] == [1000]
    assert [part.count() for part in catalog._in_time_order(rows.limit(0))] == [0]


def test_one_file_is_counted_by_all_tasks(spark, tmp_path):
    """No task counts every window and latency of a file by itself."""
    log_table(spark, [(t / 10, "svc", 200, float(t)) for t in range(400)]).coalesce(1).write.parquet(f"{tmp_path}/in")
    counts = live.closed_counts(spark.read.parquet(f"{tmp_path}/in"), Sliding(30, 10), 5.0)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count(1)") < plan.index("REPARTITION_BY_COL") < plan.index("FileScan parquet")
    assert counts.agg(F.sum("n")).first()[0] == 1204
