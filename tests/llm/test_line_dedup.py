"""Line dedup against the same done plainly."""

from __future__ import annotations

import numpy as np
import pytest

from pulsegrid.llm import line_dedup


def plainly(rows, least=10):
    """[(lines, dropped, kept)] per (doc, text) row."""
    lines = [(text or "").split("\n") for _, text in rows]
    lower = {ord("A") + i: ord("a") + i for i in range(26)}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = {}
    for (doc, _), parts in zip(rows, lines):
        for line in parts:
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for (doc, _), parts in zip(rows, lines):
        kept = []
        for line in parts:
            held = holders.get(key(line), set())
            if len(held) < 2 or doc == min(h for h in held if h is not None):
                kept.append(line)
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def test_perfect_hash_is_one_to_one():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 50_000):
        high, low = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
        if n == 1000:  # halves that many keys share
            high[:500] = 7
            low[500:] = 9
        hashed = line_dedup.PerfectHash.build(high, low)
        assert sorted(hashed.places(high, low).tolist()) == list(range(n))
        assert hashed.sizes.sum() <= max(64 * 40, 5 * n)


ROWS = [
    (5, "A common line here\nunique to five, at least\n  a COMMON line here\t"),
    (2, "a common line here\nshort\nshort"),
    (9, "a common line here\nshort\n\n"),
    (9, "a common line here\nshort\n\n"),
    (9, "a common line here\ntwice within nine\ntwice within nine"),
    (1 << 60, "ÄÖÜ äöü ß\nÄÖÜ äöü ßß\nonly twice, big ids"),
    ((1 << 60) + 1, "ÄÖÜ äöü ß\nÄÖÜ äöü ßß\nonly twice, big ids"),
    (None, "a common line here\nonly without an id\nonly twice, big ids"),
    (None, "only without an id"),
    (11, None),
    (12, ""),
    (13, "\n"),
    (14, "x" * 3_000_000 + "\n" + "many lines in one\n" * 50_000),
    (15, "MANY lines in one\r\n\x00\x00\x00 zero bytes\n"),
    (16, "\x00\x00\x00 zero bytes\nno break ends "),
    (17, "no break ends"),
]


@pytest.mark.parametrize("size", [1, 4, 2048])
def test_lines_as_done_plainly(spark, monkeypatch, size):
    """Down to shards of one key, of which hot ones have many copies."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", size)
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 2)
    frame = spark.createDataFrame([(d, t, f"n{i}", {"k": i}) for i, (d, t) in enumerate(ROWS)],
                                  "doc_id long, text string, kept string, lost map<string,int>")
    got = sorted(line_dedup.drop_lines(frame).collect(), key=lambda r: r["row"]["lost"]["k"])
    assert [(r["row"]["doc_id"], r["row"]["text"]) for r in got] == ROWS
    assert [(r["n_lines"], r["n_dropped"], r["kept"]) for r in got] == plainly(ROWS)


def test_random_lines(spark):
    rng = np.random.default_rng(4)
    pool = [f"line number {i} of the pool" for i in range(400)]
    rows = [(int(d), "\n".join(rng.choice(pool, rng.integers(0, 12)))) for d in rng.permutation(600)]
    got = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    found = {r["row"]["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in got.collect()}
    assert found == {d: w for (d, _), w in zip(rows, plainly(rows))}


def test_no_rows_and_no_long_lines(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_lines(empty).count() == 0
    short = spark.createDataFrame([(1, "a\nb"), (2, "a\nb")], "doc_id long, text string")
    assert {r["n_dropped"] for r in line_dedup.drop_lines(short).collect()} == {0}
