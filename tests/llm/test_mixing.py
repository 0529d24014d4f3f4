"""The registered mix against raking done plainly, cell by cell; both ways to rake against each other."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from pulsegrid.llm import mixing, queries

SF_DIR = "/root/testdata/sf0.01"


def fit(weight, wanted, names):
    """``weight`` per cell key scaled to the masses ``wanted[dimension][value]``, by plain sweeps."""
    weight = dict(weight)
    for _ in range(mixing.SWEEPS):
        off = 0.0
        for i, name in enumerate(names):
            have = defaultdict(float)
            for key, w in weight.items():
                have[key[i]] += w
            factor = {v: wanted[name].get(v, 0.0) / have[v] for v in have if have[v] > 0}
            off = max([off] + [abs(factor[v] - 1) for v in factor if wanted[name].get(v)])
            weight = {key: w * factor.get(key[i], 0.0) for key, w in weight.items()}
        if off <= mixing.TOLERANCE:
            break
    return weight


def plainly(tokens, rare=mixing.RARE):
    """Probability per cell of ``tokens``, with the default targets."""
    total = sum(tokens.values())
    wanted = {}
    for i, name in enumerate(mixing.DIMENSIONS):
        held = defaultdict(float)
        for key, n in tokens.items():
            held[key[i]] += n
        raised = {v: n ** mixing.FLATTEN[name] for v, n in held.items()}
        wanted[name] = {v: r / sum(raised.values()) * total for v, r in raised.items()}
    weight = fit(tokens, wanted, mixing.DIMENSIONS)
    ratio = {key: weight[key] / tokens[key] for key in tokens}
    bins = defaultdict(list)
    for key, r in ratio.items():
        bins[np.floor(np.log2(r) * 64)].append(key)
    room, most = rare * total, None
    for at in sorted(bins, reverse=True):
        room -= sum(tokens[key] for key in bins[at])
        if room < 0:
            most = max(ratio[key] for key in bins[at])
            break
    weight = {key: w / most for key, w in weight.items()}
    goal, full = dict(weight), set()
    while over := {k for k, w in weight.items() if k not in full and w > tokens[k] * (1 + 1e-9)}:
        full |= over
        rest = {k: float(tokens[k]) for k in tokens if k not in full}
        mass = sum(weight[k] for k in rest)
        left = {}
        for i, name in enumerate(mixing.DIMENSIONS):
            gap = defaultdict(float)
            for k in tokens:
                gap[k[i]] += goal[k] - (tokens[k] if k in full else 0.0)
            gap = {v: max(g, 0.0) for v, g in gap.items() if any(k[i] == v for k in rest)}
            left[name] = {v: g / sum(gap.values()) * mass for v, g in gap.items()}
        weight = {k: float(tokens[k]) for k in full} | fit(rest, left, mixing.DIMENSIONS)
    return {key: min(1.0, weight[key] / tokens[key]) for key in tokens}


def test_query_against_plain_raking(spark):
    got = queries.op4_mixing(spark, SF_DIR).collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    tokens = defaultdict(int)
    for r in got:
        tokens[r["source"], r["lang"], r["topic"]] += r["tokens"]
    want = plainly({key: n for key, n in tokens.items() if n})
    for r in got:
        if r["tokens"]:
            assert abs(r["probability"] - want[r["source"], r["lang"], r["topic"]]) <= 1e-6
    share = sum(r["chosen"] for r in got) / len(got)
    assert abs(share - np.mean([r["probability"] for r in got])) <= 0.04


@pytest.mark.parametrize("rare", [0.0, 0.02])
def test_tables_and_driver_rake_alike(spark, monkeypatch, rare):
    rng = np.random.default_rng(8)
    rows = [(int(i), " ".join(["word"] * int(rng.integers(0, 60))), f"s{int(rng.exponential(2))}", [None, "a", "b"][int(rng.integers(0, 3))])
            for i in range(400)]
    rows += [(900, "one single word too many", "rare", "a"), (901, None, "s0", "c"), (902, "x", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    rows_of = lambda: sorted(mixing.mix(docs, rare=rare).select("row.doc_id", "probability").collect())
    here = rows_of()
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
    there = rows_of()
    assert [i for i, _ in here] == [i for i, _ in there]
    assert max(abs(a - b) for (_, a), (_, b) in zip(here, there)) <= 1e-6


def test_misses_are_reported(spark):
    rows = [(i, "w " * 10, "big" if i else "small", "x") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    half = spark.createDataFrame([("big", 0.5), ("small", 0.5), ("none", 3.0)], "value string, share double")
    mixed = mixing.mix(docs, {"source": half}, rare=0.5)
    found = {(r["dimension"], r["value"]): r for r in mixing.marginals(mixed, {"source": half}).collect()}
    assert found["source", "small"]["target"] == 0.5 and found["source", "small"]["miss"] < -0.4
    exact = mixing.marginals(mixing.mix(docs, {"source": half}, rare=0.0), {"source": half}).filter("dimension = 'source'")
    assert all(abs(r["miss"]) < 1e-6 for r in exact.collect())
