"""Growing tables: halves of days, repeated batches, competing writers, compaction, retention."""

from __future__ import annotations

import os
from datetime import date

import pytest
from logs import log_table
from pyspark.sql import functions as F

from pulsegrid.sources import ledger

DAY = 86_400.0


def rows(spark, numbers, value=0):
    """One row an hour: (id, ts, v)."""
    frame = spark.createDataFrame([(n, n * 3600.0, value) for n in numbers], "id long, at double, v int")
    return frame.select("id", F.timestamp_micros((F.col("at") * 1e6).cast("long")).alias("ts"), "v")


def content(spark, path):
    return sorted((r["id"], r["v"]) for r in ledger.read(spark, path).collect())


def data_files(path):
    return [f for _, _, files in os.walk(f"{path}/rows") for f in files if f.endswith(".parquet")]


def test_halves_of_a_day_add_up(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ledger.upsert(rows(spark, range(12)), path, "ts", ("id",), number=0)
    assert ledger.upsert(rows(spark, range(12, 24)), path, "ts", ("id",), number=1)
    assert content(spark, path) == [(i, 0) for i in range(24)]
    assert not ledger.upsert(rows(spark, range(12, 24)), path, "ts", ("id",), number=1)
    assert not ledger.upsert(rows(spark, range(5)), path, "ts", ("id",), number=0)
    assert len(content(spark, path)) == 24


def test_last_row_of_a_key_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = rows(spark, range(30), 1).unionByName(rows(spark, [3, 3], 9))
    ledger.upsert(twice, path, "ts", ("id",))
    first = content(spark, path)
    assert [i for i, _ in first] == list(range(30))
    ledger.upsert(rows(spark, [2, 25, 60], 2), path, "ts", ("id",))
    want = dict(first) | {2: 2, 25: 2, 60: 2}
    assert content(spark, path) == sorted(want.items())
    assert ledger.compact(spark, path) == ["1970-01-01", "1970-01-02"]
    assert content(spark, path) == sorted(want.items())
    ledger.upsert(rows(spark, [2], 3), path, "ts", ("id",))
    assert dict(content(spark, path))[2] == 3


def test_without_keys_every_row_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in (0, 1, 1):
        ledger.upsert(rows(spark, [1, 1]), path, "ts", writer="w", number=number)
    assert content(spark, path) == [(1, 0)] * 4


def test_small_files_are_merged_and_cleaned(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        ledger.upsert(rows(spark, [i, 30 + i]), path, "ts", ("id",), number=i)
    before, files = content(spark, path), len(data_files(path))
    assert files == 12 and ledger.compact(spark, path) and ledger.compact(spark, path) == []
    assert ledger.clean(spark, path) == 12 and ledger.clean(spark, path) == 0
    assert len(data_files(path)) == 2 and content(spark, path) == before


def test_batches_committed_during_compaction_stay_newer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for i in range(2):
        ledger.upsert(rows(spark, [1, 2], i), path, "ts", ("id",), number=i)
    stage = ledger._stage

    def slow(batch, *args):
        dates = stage(batch, *args)
        monkeypatch.setattr(ledger, "_stage", stage)
        ledger.upsert(rows(spark, [2, 50], 7), path, "ts", ("id",), number=2)
        return dates

    monkeypatch.setattr(ledger, "_stage", slow)
    ledger.compact(spark, path)
    assert content(spark, path) == [(1, 1), (2, 7), (50, 7)]


def test_writers_that_collide_both_get_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ledger.upsert(rows(spark, [0]), path, "ts", ("id",))
    commit, raced = ledger._commit, []

    def race(spark_, path_, after):
        if not raced:
            raced.append(True)
            ledger.upsert(rows(spark, [1]), path, "ts", ("id",), writer="other", number=4)
        commit(spark_, path_, after)

    monkeypatch.setattr(ledger, "_commit", race)
    ledger.upsert(rows(spark, [2]), path, "ts", ("id",), writer="mine", number=9)
    assert content(spark, path) == [(0, 0), (1, 0), (2, 0)]
    assert ledger.manifest(spark, path).writers == {"other": 4, "mine": 9}


def test_a_staged_batch_without_commit_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ledger.upsert(rows(spark, [1]), path, "ts", ("id",), number=0)

    def lost(*_):
        raise RuntimeError("executor and driver gone")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_commit", lost)
        with pytest.raises(RuntimeError):
            ledger.upsert(rows(spark, [2]), path, "ts", ("id",), number=1)
    assert content(spark, path) == [(1, 0)] and len(data_files(path)) == 2
    assert ledger.upsert(rows(spark, [2]), path, "ts", ("id",), number=1)
    assert ledger.clean(spark, path) == 1 and content(spark, path) == [(1, 0), (2, 0)]


def test_dates_are_dropped_without_reading(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        ledger.upsert(rows(spark, range(i, 24 * 5, 3)), path, "ts", ("id",), number=i)
    assert ledger.drop_before(spark, path, date(1970, 1, 4)) == ["1970-01-01", "1970-01-02", "1970-01-03"]
    assert ledger.drop_before(spark, path, date(1970, 1, 4)) == []
    assert content(spark, path) == [(i, 0) for i in range(72, 120)]
    assert ledger.clean(spark, path, versions=1) == 0 and ledger.clean(spark, path) == 9
    left = {d for _, folders, _ in os.walk(f"{path}/rows") for d in folders if d.startswith("date=")}
    assert left == {"date=1970-01-04", "date=1970-01-05"} and len(content(spark, path)) == 48


def test_filters_reach_the_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.upsert(rows(spark, range(72)), path, "ts", ("id",))
    ledger.upsert(rows(spark, [1, 30], 5), path, "ts", ("id",))
    for day, several in (("1970-01-03", False), ("1970-01-01", True)):
        some = ledger.read(spark, path).filter(f"date = DATE '{day}'").select("id", "v")
        assert some.count() == 24
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan
        assert some.select(F.input_file_name()).distinct().count() <= (2 if several else 1)


def test_empty_batches_and_missing_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        ledger.read(spark, path)
    assert ledger.compact(spark, path) == [] and ledger.clean(spark, path) == 0
    assert ledger.drop_before(spark, path, date(2000, 1, 1)) == []
    assert ledger.upsert(rows(spark, []), path, "ts", ("id",), number=0)
    assert content(spark, path) == []
    with pytest.raises(Exception, match="without a time"):
        ledger.upsert(rows(spark, [1]).withColumn("ts", F.lit(None).cast("timestamp")), path, "ts", ("id",))
    nulls = rows(spark, [1, 1]).withColumn("id", F.lit(None).cast("long"))
    ledger.upsert(nulls, path, "ts", ("id",))
    assert content(spark, path) == [(None, 0)]
