"""Nearest neighbours, toxicity and mixing against plain versions and held-out labels."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import hnsw, mixing, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def nearest_by_hand(ids, rows, asked, k):
    out = {}
    for q in asked:
        apart = np.sqrt(((rows - rows[ids.index(q)]) ** 2).sum(axis=1))
        out[q] = [(s, i) for s, i in sorted(zip(apart, ids)) if i != q][:k]
    return out


def test_search_recall(spark):
    rng = np.random.default_rng(6)
    rows = np.concatenate([rng.normal(size=(900, 16)), rng.normal(size=16) + 0.01 * rng.normal(size=(300, 16))])
    rows = np.concatenate([rows, rows[:40]]).astype(np.float32).astype(float)
    ids = list(range(len(rows)))
    frame = spark.createDataFrame([(i, r.tolist(), 0, "x") for i, r in zip(ids, rows)],
                                  "vec_id long, embedding array<float>, shard int, links string")
    old, hnsw.QUERIES = hnsw.QUERIES, 20
    try:
        got = hnsw.nearest(frame, frame.filter("vec_id % 20 = 0"), shard=300).collect()
    finally:
        hnsw.QUERIES = old
    want = nearest_by_hand(ids, rows, ids[::20], 10)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert found.keys() == want.keys() and all(len(x) == 10 for x in found.values())
    assert all(x == sorted(x) for x in found.values())
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.97 * 10 * len(want)
    exact = {(q, i): s for q in want for s, i in nearest_by_hand(ids, rows, [q], len(ids))[q]}
    assert all(abs(r["score"] - exact[r["query_id"], r["vec_id"]]) < 1e-12 for r in got)


def test_search_of_few_and_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in hnsw.nearest(frame, frame.filter("vec_id in (0, 4)")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 3, 1.0), (0, 3, 2, 2**0.5)]
    assert hnsw.nearest(frame.limit(0), frame).count() == 0
    assert hnsw.nearest(frame, frame.limit(0)).count() == 0


def test_ties_go_to_smaller_ids(spark):
    """All as far from each other: what a graph reaches is kept by id."""
    rows = [(i, [float(i == j) for j in range(60)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hnsw.nearest(frame, frame.filter("vec_id % 10 = 0")).collect()
    for query in range(0, 60, 10):
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == query)
        assert [i for _, i in mine] == [i for i in range(60) if i != query][:10]


def test_queries_visit_few_cells_of_crowds(spark, monkeypatch):
    """Forty crowds, one of which holds a third: few cells are visited, and the neighbours are all there."""
    monkeypatch.setattr(hnsw, "QUERIES", 50)
    rng = np.random.default_rng(8)
    centres = 20 * rng.normal(size=(40, 8))
    of = np.where(rng.random(3000) < 1 / 3, 0, rng.integers(0, 40, 3000))
    rows = centres[of] + rng.normal(size=(3000, 8))
    rows[::7] = rows[0]  # equal vectors by the hundred
    ids = [2**60 + i for i in range(3000)]
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, rows)], "vec_id long, embedding array<double>")
    asked = frame.filter("vec_id % 10 = 0")
    _, placed, router, dim = hnsw.build_index(hnsw.usable(frame, "vec_id", "embedding"), 100)
    assert len(router.centres) == 30 and router.sizes.sum() == 3000
    queries_ = hnsw.usable(asked, "vec_id", "embedding").toDF("query_id", "query")
    assert hnsw._probes(router, placed, queries_, queries_.count(), dim, 10) <= 10
    got = hnsw.nearest(frame, asked, shard=100).collect()
    want = nearest_by_hand(ids, rows, [i for i in ids if i % 10 == 0], 10)
    assert len(got) == 10 * len(want)
    hits = sum(abs(r["score"] - want[r["query_id"]][r["rank"] - 1][0]) < 1e-9 for r in got)
    assert hits >= 0.97 * len(got)


def test_cells_with_too_few_rows_are_not_enough(spark):
    """A lone vector's cell holds no other: more cells are visited until there are enough rows."""
    rows = [(i, [float(i % 10), 0.1 * (i // 10)]) for i in range(100)] + [(1000, [500.0, 500.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hnsw.nearest(frame, frame.filter("vec_id = 1000"), shard=20).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 11))


def test_every_node_is_reached():
    vecs = np.eye(300)
    graph = hnsw.Graph.build(vecs, hnsw._levels(np.arange(300)))
    for layer, links in enumerate(graph.layers):
        held = (links[:, 0] >= 0).nonzero()[0]
        assert hnsw._reached(links, np.array([graph.top]))[held].all()


def test_search_query(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    ids, rows = [v["vec_id"] for v in vectors], np.array([v["embedding"] for v in vectors], float)
    want = nearest_by_hand(ids, rows, [i for i in ids if i % 100 == 0], 10)
    got = queries.op9_hnsw_search(spark, SF_DIR).collect()
    hits = sum((r["score"], r["vec_id"]) in [(s, i) for s, i in want[r["query_id"]]] or
               r["vec_id"] in [i for _, i in want[r["query_id"]]] for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("text", ["", "a", "  A,b!  c\n", "word " * 100, "x" * 500, "ab " * 31 + "y" * 200 + " z"])
def test_windows_hold_all_words(text):
    whole = toxicity.normalised(text)
    parts = list(toxicity.windows(whole))
    assert all(0 < len(p) <= toxicity.WINDOW for p in parts)
    joined = b""
    for p in parts:
        joined += p[1:] if joined.endswith(b" ") and p.startswith(b" ") else p
    assert joined == whole


def test_toxicity_of_held_out_documents(spark):
    rng = np.random.default_rng(2)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    plain = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(3000)]
    bad = ["zwork", "xuqil", "kwyzzo", "vexhag"]
    docs, labels = [], []
    for i in range(1500):
        words = list(rng.choice(plain, rng.integers(20, 200)))
        toxic = i % 6 == 0
        for at in rng.integers(0, len(words), max(2, len(words) // 40)) if toxic else []:
            words[at] = str(rng.choice(bad)) + str(rng.choice(["", "er", "s"]))
        docs.append((i, " ".join(words), "x", 1.0))
        labels.append((i, int(toxic)))
    docs += [(9001, None, "x", 1.0), (9002, "", "x", 1.0), (9002, "", "x", 1.0), (None, "xuqil vexhags", "x", 1.0), (9003, "z" * 30000, None, 1.0)]
    labels += [(0, 1), (0, 0), (None, 1), (2, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, toxicity double")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.judge(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 1500 and r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1}
    toxic = [r["predicted"] for r in held if r["doc_id"] % 6 == 0]
    clean = [r["predicted"] for r in held if r["doc_id"] % 6]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.7 for r in rows)
    # A held-out label changes nothing.
    again = toxicity.train(docs, labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert np.allclose(again.weights, model.weights) and again.toxic == model.toxic
    # Nor do partitions, or copies of rows.
    dealt = toxicity.train(docs.union(docs.limit(200)).repartition(7), labels.repartition(3))
    assert dealt.toxic == model.toxic and dealt.ordinary == model.ordinary
    assert np.array_equal(dealt.weights, model.weights)


def test_stretches_are_what_strings_cover():
    grams = np.unique(np.concatenate([toxicity._grams(x) for x in (b"abcdefgh", b"ghijkl")]))
    weight = np.arange(1.0, len(grams) + 1)
    found = toxicity.stretches(b"xx abcdefgh yy abcdefghijkl abcdef", grams, weight)
    assert [x for x, _ in found] == [b"abcdefgh", b"abcdefghijkl", b"abcdef"]
    assert toxicity.stretches(b"abc", grams, weight) == [] == toxicity.stretches(b"abcdefgh", grams[:0], weight[:0])


def test_toxic_phrases_of_ordinary_words(spark):
    """No word of its own, only which words stand together: some are found, where a list of words finds none."""
    rng = np.random.default_rng(9)
    words = [f"{a}{b}" for a in ("mor", "tan", "fel", "gis", "pul", "dra") for b in ("a", "el", "ido", "um", "esk", "ort", "inga", "oy")]
    phrase = ["mora fel%s" % b for b in ("el", "ido")] + ["gisum dra%s pulesk" % b for b in ("ort", "oy")]
    rows, labels = [], []
    for i in range(900):
        text = list(rng.choice(words, 60))
        if i % 4 == 0:
            for at in (5, 25, 45):
                text[at] = str(rng.choice(phrase))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [r for r in toxicity.judge(docs, model).collect() if r["held_out"]]
    assert np.mean([r["predicted"] for r in held if r["doc_id"] % 4 == 0]) >= 0.4
    assert np.mean([r["predicted"] for r in held if r["doc_id"] % 4]) <= 0.05


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.judge(docs, toxicity.train(docs, none)).collect()} == {0}
    one = spark.createDataFrame([(2, 1), (3, 1), (5, 1)], "doc_id long, toxic int")
    toxicity.train(docs.limit(0), one)
    assert toxicity.judge(docs.limit(0), toxicity.train(docs, one)).count() == 0


def test_toxicity_query(spark):
    rows = {r["doc_id"]: r for r in queries.op8_toxicity(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    clean = [rows[x["doc_id"]]["predicted"] for x in labels if not x["toxic"] and rows[x["doc_id"]]["held_out"]]
    toxic = [rows[x["doc_id"]]["predicted"] for x in labels if x["toxic"] and rows[x["doc_id"]]["held_out"]]
    assert np.mean(clean) <= 0.02 and np.mean(toxic) >= 0.5


def raked_by_hand(cells, targets, sweeps=500):
    weight = dict(cells)
    total = sum(cells.values())
    for _ in range(sweeps):
        for axis, shares in enumerate(targets):
            for value, share in shares.items():
                have = sum(w for c, w in weight.items() if c[axis] == value)
                for c in weight:
                    if c[axis] == value:
                        weight[c] *= share * total / have
    return weight


def test_rake_and_sample(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(6000):
        source = str(rng.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1]))
        lang = None if rng.random() < 0.1 else str(rng.choice(["en", "de"], p=[0.8, 0.2]))
        rows.append((i, "word " * int(rng.integers(1, 30)), source, lang, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    table = lambda shares: spark.createDataFrame(list(shares.items()), "value string, share double")
    shares = [{"a": 0.4, "b": 0.4, "c": 0.2}, {"en": 0.5, "de": 0.3, None: 0.2}]
    targets = {"source": table(shares[0] | {"unseen": 0.5}), "lang": table(shares[1])}
    got = mixing.mix(docs, targets, topic=F.lit("one")).toPandas()
    cells = {}
    for _, text, source, lang, _ in rows:
        cells[source, lang] = cells.get((source, lang), 0) + len(text.split())
    weight = raked_by_hand(cells, shares)
    ratio = {c: weight[c] / cells[c] for c in cells}
    most = max(ratio.values())
    got["lang"] = got["lang"].where(got["lang"].notna(), None)
    expected = [ratio[s, None if x is None else x] / most for s, x in zip(got["source"], got["lang"])]
    assert np.allclose(got["probability"], expected, atol=1e-4)
    for (source, lang), part in got.groupby(["source", got["lang"].fillna("-")]):
        p = part["probability"].iloc[0]
        assert abs(part["chosen"].mean() - p) <= 5 * np.sqrt(p * (1 - p) / len(part)) + 1e-9
    again = mixing.mix(docs.repartition(5), targets, topic=F.lit("one")).toPandas()
    key = lambda x: [r["doc_id"] for r in x["row"]]
    assert dict(zip(key(again), again["chosen"])) == dict(zip(key(got), got["chosen"]))
    half = mixing.mix(docs, targets, topic=F.lit("one"), budget=1000.0).toPandas()
    assert abs((half["probability"] * half["tokens"]).sum() - 1000) < 5


def test_a_rare_document_does_not_thin_the_rest(spark):
    """One short document of a further source and language changes the others' shares little."""
    rows = [(i, "word " * 40, "hot" if i % 3 == 0 else f"s{i % 19}", "en" if i % 4 else "de") for i in range(6000)]
    shape = "doc_id long, text string, source string, lang string"
    of = lambda rows: mixing.mix(spark.createDataFrame(rows, shape), topic=F.lit("one")).cache()
    without, found = of(rows), of([*rows, (-1, "a b c", "rare", "xx")])
    share = lambda mixed: {r["value"]: r["expected"] / r["tokens"] for r in mixing.marginals(mixed).filter("dimension <> 'topic'").collect()}
    before, after = share(without), share(found)
    assert after.pop("rare") == after.pop("xx") == 1.0
    assert before.keys() == after.keys() and all(abs(after[x] - before[x]) < 0.01 for x in before)
    assert before["hot"] > 0.4


def test_mix_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "a", "en"), (None, "two words", "a", None), (3, "w " * 50000, "b", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "1 AS topic", "2 AS tokens", "3 AS ratio")
    got = mixing.mix(docs).collect()
    assert len(got) == 5 and all(0 < r["probability"] <= 1 for r in got)
    kept = mixing.keep_mixed(docs)
    assert kept.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0
