"""The live stream of panes: equal to batch with gaps, late events, restarts and stamps of the future."""

from __future__ import annotations

import os
import random

from logs import log_table
from pyspark.sql import functions as F
from test_streaming import DELAY, SCHEMA, WINDOWS, drop_file, same, steady

from pulsegrid.operators import forest as fo
from pulsegrid.operators.corpus import balanced_corpus
from pulsegrid.operators.features import FEATURES, spine_features, window_features
from pulsegrid.operators.windows import WINDOW
from pulsegrid.session import cut
from pulsegrid.sources import ledger
from pulsegrid.streaming import live, running


def play(spark, folder, out, **options):
    events = live.stream_table(spark, folder, SCHEMA, files_per_batch=1)
    query = running.run_windows(events, WINDOWS, DELAY, out, **options)
    query.awaitTermination()
    return query


def closed(rows):
    return (max(r[0] for r in rows) - DELAY) // 10 * 10


def want(spark, rows):
    limit = F.timestamp_seconds(F.lit(int(closed(rows))))
    return spine_features(log_table(spark, rows), WINDOWS).filter(F.col("window_end") <= limit)


def matches(spark, out, rows):
    got = running.read_live(spark, out)
    # The newest event of a batch may open windows that spine_features leaves for later.
    return got.count() > 0 and same(got, want(spark, rows))


def test_live_table_has_every_window(spark, tmp_path):
    folder, out, rows = str(tmp_path / "in"), str(tmp_path / "out"), []
    for i in range(5):
        part = steady(100 * i, 100 * i + 60, "busy")  # silent for 40 seconds of 100
        part += steady(100 * i + 5, 100 * i + 9, "rare") if i in (1, 4) else []
        part += [(100.0 * i + 10, "busy", 200, 5.0), (100.0 * i + 20, "edge", 404, 7.0)]  # on the grid
        rows += part
        drop_file(spark, folder, i, part)
    query = play(spark, folder, out)
    assert matches(spark, out, rows)
    silent = running.read_live(spark, out).filter("request_count = 0").select("service_name").distinct()
    assert silent.count() == 3
    # The state is the table of panes: an event is one row of it at most, not one per window.
    assert query.lastProgress["stateOperators"] == []
    panes = running.read_live(spark, out, "panes")
    assert panes.count() <= len(rows) == panes.agg(F.sum("n")).first()[0]


def test_late_events_are_kept_and_correct_their_windows(spark, tmp_path):
    folder, out, rows = str(tmp_path / "in"), str(tmp_path / "out"), []
    late = [(20.5, "svc", 500, 99.0), (250.0, "svc", 200, 1.0), (55.5, "new", 200, 3.0)]
    for i, part in enumerate([steady(100, 400), [*late, *steady(400, 500)], [(30.5, "svc", 200, 7.0)], steady(500, 600)]):
        rows += part
        drop_file(spark, folder, i, part)
    play(spark, folder, out)
    assert matches(spark, out, rows)
    kept = running.read_live(spark, out, "late").select("service_name", "latency_ms").collect()
    assert sorted(map(tuple, kept)) == [("new", 3.0), ("svc", 1.0), ("svc", 7.0), ("svc", 99.0)]
    assert running.read_live(spark, out, "panes").agg(F.sum("n")).first()[0] == len(rows)


def test_restart_and_repeated_batch(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = steady(0, 125) + steady(3, 9, "quiet")
    drop_file(spark, folder, 0, rows)
    play(spark, folder, out)
    more = [(40.5, "svc", 200, 50.0), *steady(125, 300)]
    drop_file(spark, folder, 1, more)
    play(spark, folder, out)
    assert matches(spark, out, rows + more)
    # The last batch was done but is not known to be: it comes again.
    commits = sorted((f for f in os.listdir(f"{out}/progress/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{out}/progress/commits/{name}"):
            os.remove(f"{out}/progress/commits/{name}")
    versions = {t: ledger.manifest(spark, f"{out}/{t}").version for t in ("panes", "metrics", "late", "services")}
    play(spark, folder, out)
    assert {t: ledger.manifest(spark, f"{out}/{t}").version for t in versions} == versions
    assert matches(spark, out, rows + more)


def test_a_batch_that_broke_off_is_completed(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    first, second = steady(0, 100), [(20.5, "svc", 200, 50.0), *steady(100, 200)]
    drop_file(spark, folder, 0, first)
    play(spark, folder, out)
    drop_file(spark, folder, 1, second)
    for broken in ("ahead", "late", "services", "metrics"):
        upsert = running.Running.upsert

        def breaks(self, rows, name, *args, **notes):
            if name == broken:
                raise RuntimeError("lost")
            return upsert(self, rows, name, *args, **notes)

        with monkeypatch.context() as patch:
            patch.setattr(running.Running, "upsert", breaks)
            try:
                play(spark, folder, out)
            except Exception as error:
                assert "lost" in str(error)
    play(spark, folder, out)
    assert matches(spark, out, first + second)
    assert running.read_live(spark, out, "late").count() == 1


def test_stamps_of_the_future_close_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = steady(0, 100)
    drop_file(spark, folder, 0, [*rows, (4_070_908_800.0, "svc", 200, 1.0)])
    drop_file(spark, folder, 1, steady(100, 200))
    play(spark, folder, out)
    assert matches(spark, out, rows + steady(100, 200))
    assert running.read_live(spark, out, "ahead").count() == 1


def test_scores_follow_corrections(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(1)
    rows = [
        (t / 5 + 0.1, "svc", rng.choice([200] * 15 + [500]), rng.lognormvariate(4, 0.5)) for t in range(3000)
    ]
    normal = cut(window_features(log_table(spark, rows), WINDOWS))
    forest = fo.fit(cut(balanced_corpus(normal)), fo.ForestParams(trees=20))
    drop_file(spark, folder, 0, rows)
    late = [(150.0 + i / 15, "svc", 503, 9e3) for i in range(150)]
    drop_file(spark, folder, 1, late)
    play(spark, folder, out, model=forest)
    scores = running.read_live(spark, out, "scores")
    metrics = running.read_live(spark, out)
    again = fo.score(metrics, forest).select(*WINDOW, "anomaly_score", "is_anomalous")
    assert scores.count() == metrics.count() and same(scores, again)
    flagged = {r["window_end"].timestamp() for r in running.anomalies(spark, out).collect()}
    assert {150.0, 160.0, 170.0, 180.0} & flagged
