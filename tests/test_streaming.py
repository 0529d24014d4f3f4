"""Streams: parity with batch, late rows, restart, silence, JSON input, archive."""

from __future__ import annotations

import json
import os
import random

import pytest
from logs import log_table
from pyspark.sql import functions as F, types as T

from pulsegrid.operators import forest as fo
from pulsegrid.operators.corpus import balanced_corpus
from pulsegrid.operators.features import FEATURES, spine_features, window_features
from pulsegrid.operators.windows import Sliding
from pulsegrid.session import cut
from pulsegrid.sources import events as ev, ledger
from pulsegrid.streaming import live

WINDOWS = Sliding(30, 10)
DELAY = 5.0
SCHEMA = T.StructType(
    [
        T.StructField("service_name", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def drop_file(spark, folder, number: int, rows: list[tuple]) -> None:
    """Put one Parquet file into the folder, later than all before it."""
    target = f"{folder}/part-{number}.parquet"
    log_table(spark, rows).coalesce(1).write.parquet(f"{folder}-staging-{number}")
    (source,) = [f for f in os.listdir(f"{folder}-staging-{number}") if f.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    os.link(f"{folder}-staging-{number}/{source}", target)
    os.utime(target, (1_000_000 + number, 1_000_000 + number))


def steady(start: int, stop: int, service: str = "svc") -> list[tuple]:
    return [(t + 0.5, service, 500 if t % 7 == 0 else 200, float(t % 13 + 1)) for t in range(start, stop)]


def replay(spark, folder, out, forest=None):
    events = live.stream_table(spark, folder, SCHEMA, files_per_batch=1)
    live.run_live(events, WINDOWS, DELAY, out, forest).awaitTermination()
    return live.read_metrics(spark, out)


def closed(rows: list[tuple]) -> int:
    """Last end the watermark has passed: newest event's last end, less width and delay."""
    newest = max(r[0] for r in rows)
    last_end = int(newest // 10) * 10 + 30
    return last_end - 30 - int(DELAY)


def same(stream, batch) -> bool:
    batch = batch.select(*stream.columns)
    return stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_ordered_replay_equals_batch(spark, tmp_path):
    folder, rows = str(tmp_path / "in"), []
    for i in range(3):
        part = steady(100 * i, 100 * (i + 1)) + steady(100 * i + 50, 100 * i + 60, "rare")
        rows += part
        drop_file(spark, folder, i, part)
    got = replay(spark, folder, str(tmp_path / "out"))
    limit = F.timestamp_seconds(F.lit(closed(rows)))
    want = window_features(log_table(spark, rows), WINDOWS).filter(F.col("window_end") <= limit)
    assert got.count() > 30 and same(got, want)


def test_late_rows(spark, tmp_path):
    """A row within the delay counts; one whose windows were written before does not."""
    folder = str(tmp_path / "in")
    drop_file(spark, folder, 0, steady(0, 200))
    drop_file(spark, folder, 1, [(199.6, "svc", 200, 99.0), *steady(200, 300)])
    drop_file(spark, folder, 2, [(20.5, "svc", 200, 99.0), *steady(300, 400)])
    rows = replay(spark, folder, str(tmp_path / "out")).collect()
    counts = {r.window_end.timestamp(): r.request_count for r in rows}
    assert counts[200] == 31 and counts[30] == 30
    assert len(counts) == len(rows)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = steady(0, 125)
    drop_file(spark, folder, 0, rows)
    first = {r.window_end for r in replay(spark, folder, out).collect()}
    more = steady(125, 300)
    drop_file(spark, folder, 1, more)
    got = replay(spark, folder, out)
    limit = F.timestamp_seconds(F.lit(closed(rows + more)))
    want = window_features(log_table(spark, rows + more), WINDOWS).filter(F.col("window_end") <= limit)
    assert first and same(got, want)


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    """A batch that was written but not committed is done again, without doubling."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(spark, folder, 0, steady(0, 200))
    before = sorted(map(tuple, replay(spark, folder, out).collect()))
    commits = sorted((f for f in os.listdir(f"{out}/progress/commits") if f.isdigit()), key=int)
    for suffix in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{out}/progress/commits/{suffix}"):
            os.remove(f"{out}/progress/commits/{suffix}")
    assert sorted(map(tuple, replay(spark, folder, out).collect())) == before


def test_scores_of_a_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(1)
    usual = [
        (t / 5 + 0.1, "svc", rng.choice([200] * 15 + [500]), rng.lognormvariate(4, 0.5))
        for t in range(3000)
    ]
    drop_file(spark, folder, 0, usual + [(t / 5 + 0.15, "svc", 503, 9e3) for t in range(2000, 2150)])
    normal = cut(window_features(log_table(spark, usual), WINDOWS))
    forest = fo.fit(cut(balanced_corpus(normal)), fo.ForestParams(trees=20))
    metrics = replay(spark, folder, out, forest)
    flagged = ledger.read(spark, f"{out}/anomalies")
    ends = {r.window_end.timestamp() for r in flagged.collect()}
    assert {410.0, 420.0, 430.0, 440.0, 450.0} <= ends
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/scores").collect()]
    assert len(lines) == metrics.count()
    assert sum(line["is_anomalous"] for line in lines) == flagged.count()


def test_silent_service_keeps_its_rows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = []
    for i in range(4):
        part = steady(100 * i, 100 * (i + 1), "busy")
        if i in (0, 2):
            part += steady(100 * i, 100 * i + 12, "quiet")
        rows += part
        drop_file(spark, folder, i, part)
    events = live.stream_table(spark, folder, SCHEMA, files_per_batch=1)
    normal = cut(window_features(log_table(spark, rows), WINDOWS))
    forest = fo.fit(normal, fo.ForestParams(trees=10))
    live.run_silence(events, WINDOWS, DELAY, out, forest).awaitTermination()
    silent = spark.read.parquet(f"{out}/silent")
    assert silent.filter("is_anomalous != (anomaly_score < 0)").count() == 0
    got = silent.select("service_name", "window_end", *FEATURES)
    limit = F.timestamp_seconds(F.lit(closed(rows)))
    want = spine_features(log_table(spark, rows), WINDOWS).filter(
        (F.col("window_end") <= limit) & (F.col("request_count") == 0)
    )
    assert got.count() > 10 and same(got, want)


def test_json_stream_with_bad_messages(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    body = {"timestamp": 5.5, "service_name": "s", "status_code": 200, "latency_ms": 7.0}
    lines = [json.dumps({**body, "timestamp": t + 0.5}) for t in range(100)] + ["{bad", "17"]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    messages = spark.readStream.format("text").load(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    events = ev.usable(ev.decode(messages)).select("ts", "service_name", "status_code", "latency_ms")
    live.run_live(events, WINDOWS, DELAY, out).awaitTermination()
    assert live.read_metrics(spark, out).agg(F.max("request_count")).first()[0] == 30


def test_archive_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(spark, folder, 0, steady(0, 50))
    for number in (1, 2):
        drop_file(spark, folder, number, steady(86_400 * number, 86_400 * number + 10, "b"))
        events = live.stream_table(spark, folder, SCHEMA)
        live.run_archive(events, out).awaitTermination()
    counts = spark.read.parquet(f"{out}/events").groupBy("date", "service_name").count().collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in counts) == [
        ("1970-01-01", "svc", 50), ("1970-01-02", "b", 10), ("1970-01-03", "b", 10),
    ]


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ev.read_topic(spark, "localhost:1", "logs.raw")
