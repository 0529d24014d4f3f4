"""Source divergence against the same done plainly, with whole numbers."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import divergence


def plainly(rows, least, ranks):
    """``rows`` of (text, lang, source) to the audit's rows."""
    count, docs = Counter(), Counter()
    groups = sorted({(lang or "", source or "") for _, lang, source in rows})
    for text, lang, source in rows:
        words = [w.decode() for w in divergence.terms((text or "").encode())]
        for word in words:
            count[lang or "", source or "", word] += 1
        for word in set(words):
            docs[lang or "", word] += 1
    out = []
    for lang in {g for g, _ in groups}:
        kept = [w for (g, w), n in docs.items() if g == lang and n >= least]
        sources = [s for g, s in groups if g == lang]
        n = {s: [count[lang, s, w] for w in kept] for s in sources}
        whole = [sum(c) for c in zip(*n.values())]
        share = lambda ns: [1 + 10**9 * (x + 2) // (sum(ns) + 2 * len(kept)) for x in ns]
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(whole)
        for s in sources:
            p = share(n[s])
            pairs = [(sum(map(f, p, share(n[o]))), o) for o in sources if o != s]
            held = [(f(x, y), w) for x, y, w, k in zip(p, q, kept, n[s]) if k and x > y]
            order = lambda found: sorted(found, key=lambda v: (-v[0], v[1].encode()))
            for part, found in (("pair", order(pairs)), ("term", order(held)[:ranks])):
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def got(spark, rows, least, ranks):
    frame = spark.createDataFrame([(*r, 1, {"a": 1}) for r in rows],
                                  "text string, lang string, source string, n int, sources map<string,int>")
    return sorted(tuple(r) for r in divergence.audit(frame, least_docs=least, ranks=ranks).collect())


@pytest.mark.parametrize("flush", [1, 1 << 18])
def test_random_texts(spark, monkeypatch, flush):
    monkeypatch.setattr(divergence, "FLUSH", flush)
    rng = np.random.default_rng(6)
    words = np.array(["Über", "über", "a", "zebra", "it's", "x1y", "ÀB", "日本", "𝒳", "né"] + [f"w{chr(97 + i)}" for i in range(20)])
    skew = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 30), p=skew / skew.sum())) for _ in range(60)]
    rows = [(texts[i], ["en", "de", None][i % 3], f"s{j}") for i, j in zip(rng.integers(0, 60, 300), rng.integers(0, 7, 300))]
    for least, ranks in ((1, 100), (10, 3), (60, 10), (1000, 10)):
        assert got(spark, rows, least, ranks) == plainly(rows, least, ranks)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "", ""), ("one Two one", "", "b"), ("12 34 --", "", "c"), ("word", "x", "alone"),
            ("A" * 2_000_000 + " b" * 100_000, "", "d"), ("one two one", "", "e"), ("one two one", "", "e"), ("ß\x00Σ\x7fσ", "", "f")]
    for least in (1, 2):
        assert got(spark, rows, least, 10) == plainly(rows, least, 10)
    assert got(spark, [], 1, 10) == []


def test_terms():
    text = "It's A_b \x00c\x7f ÄÖ1ü [@`{Z"
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    want = ["it", "s", "a", "b", "c", "ÄÖ", "ü", "z"]
    assert [w.decode() for w in divergence.terms(text.encode())] == want
    assert re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower) == want
