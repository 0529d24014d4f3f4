"""SimHash and embedding near copies against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import cells, components, pq_dedup, queries, simhash

SF_DIR = "/root/testdata/sf0.01"


def closed(n, linked):
    """Smallest node reachable from each, by plain search."""
    near = {i: [] for i in range(n)}
    for i, j in linked:
        near[i].append(j)
        near[j].append(i)
    label = list(range(n))
    for start in range(n):
        if label[start] == start:
            todo = [start]
            while todo:
                for other in near[todo.pop()]:
                    if label[other] > start:
                        label[other] = start
                        todo.append(other)
    return label


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    shingles = shingles or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", "One two", "one TWO three", "a b c d a b c", "É é x y\x0bz", "w " * 70000],
)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def test_components_of_paths_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)]
    links += [(1, 1), (None, 3), (3, 2), (2, 3), (260, 261)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = {i: 100 for i in range(100, 141)} | {5: 5} | {i: 5 for i in range(200, 260)}
    assert got == want | {2: 2, 3: 2, 260: 260, 261: 260}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_each_pair_of_a_cell_meets_once(spark, block):
    rows = [(c, k < 12, c * 100 + k) for c in range(3) for k in range(20)]
    rows += [(9, False, 901), (9, False, 902)]  # a cell that is no one's home
    dealt = cells.deal(spark.createDataFrame(rows, "cell int, home boolean, id long"), "id", block)
    met = {}
    tasks = {}
    for r in dealt.collect():
        tasks.setdefault((r["cell"], r["first"], r["second"]), []).append(r)
    for (_, first, second), members in tasks.items():
        left = [r["id"] for r in members if r["own"] == first]
        right = [r["id"] for r in members if r["own"] == second]
        pairs = {frozenset((x, y)) for x in left for y in right if x != y}
        for pair in pairs:
            met[pair] = met.get(pair, 0) + 1
    home = {i: h for _, h, i in rows}
    want = {
        frozenset((x, y))
        for c, hx, x in rows for d, hy, y in rows
        if c == d and x < y and (hx or hy)
    }
    assert set(met) == want and set(met.values()) == {1} and home


def test_simhash_links_as_all_pairs_do(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = simhash.near_copies(docs, radius=8).toPandas().sort_values("doc_id", ignore_index=True)
    prints = got["simhash"].to_numpy(np.int64).view(np.uint64)
    i, j = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 8).nonzero()
    label = closed(len(prints), zip(i.tolist(), j.tolist()))
    assert got["component_id"].tolist() == got["doc_id"].to_numpy()[label].tolist()
    assert (got["component_id"] != got["doc_id"]).any()


def test_crowded_cells_of_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 4)
    prints = {int(b) ^ int(m) for b in base for m in np.bitwise_or(1 << rng.integers(0, 30, 300), 1 << rng.integers(0, 62, 300))}
    prints = sorted(p if p < 1 << 63 else p - (1 << 64) for p in prints)
    old, simhash.BLOCK = simhash.BLOCK, 50
    try:
        frame = spark.createDataFrame([(p,) for p in prints], "simhash long")
        got = {r["node"]: r["component"] for r in components.components(simhash.links(frame, 2, 5)).collect()}
    finally:
        simhash.BLOCK = old
    array = np.array(prints, np.int64).view(np.uint64)
    i, j = (np.bitwise_count(array[:, None] ^ array[None, :]) <= 2).nonzero()
    label = closed(len(prints), zip(i.tolist(), j.tolist()))
    assert [got.get(p, p) for p in prints] == [prints[x] for x in label]


def test_one_document_of_a_group_stays(spark):
    text = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(3, text, "a", 1), (1, text.upper(), "b", 2), (1, text.upper(), "b", 2), (7, None, "c", 3),
            (8, "", "c", 4), (None, text, "d", 5), (None, "lonely words stand here", "d", 6), (9, "other words altogether", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, simhash string, component_id long")
    kept = sorted(simhash.keep_one(docs).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    assert [r["doc_id"] for r in kept] == [1, 7, 9, None, None]
    assert kept[0]["simhash"] == "b" and kept[0].asDict().keys() == {"doc_id", "text", "simhash", "component_id"}
    marked = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert marked[3] == 1 and marked[8] == 7
    empty = docs.limit(0)
    assert simhash.near_copies(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_copies_beside_columns_of_any_kind(spark):
    rows = [(2, "one two three four", 1, {"a": 1}), (1, "one two three four", 2, {"b": 2}), (1, "one two three four", 2, {"b": 2}), (5, "", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, row map<string,int>")
    kept = sorted(simhash.keep_one(docs).collect())
    assert [(r["doc_id"], r["kept_id"], r["row"]) for r in kept] == [(1, 2, {"b": 2}), (5, 3, None)]


def test_query_against_all_pairs(spark):
    """The registered query: fingerprints as text, groups at two bits."""
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op2_simhash_dedup(spark, SF_DIR).collect()}
    assert got.keys() == rows.keys()
    ids = sorted(rows)
    prints = np.array([plain_fingerprint(rows[i]) for i in ids], np.uint64)
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints.tolist()]
    i, j = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2).nonzero()
    label = closed(len(ids), zip(i.tolist(), j.tolist()))
    assert [got[i]["component_id"] for i in ids] == [ids[x] for x in label]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embeddings_link_as_all_pairs_do(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 24))
    near = base[:200] + rng.normal(size=(200, 24)) * np.linspace(0.02, 0.4, 200)[:, None]
    crowd = base[0] + rng.normal(size=(300, 24)) * 0.02
    rows = np.concatenate([base, near, crowd, base[:20] * 3, base[:5]]).astype(np.float32)
    frame = vectors(spark, [(i, r.tolist(), i % 3) for i, r in enumerate(rows)])
    old, pq_dedup.BLOCK = pq_dedup.BLOCK, 64
    try:
        got = pq_dedup.near_copies(frame, reach=1.0).toPandas().sort_values("vec_id", ignore_index=True)
        default = pq_dedup.near_copies(frame).agg(F.sum("n_links")).first()[0]
    finally:
        pq_dedup.BLOCK = old
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = closed(len(rows), zip(*(x.tolist() for x in linked.nonzero())))
    assert got["n_links"].tolist() == linked.sum(axis=1).tolist()
    assert got["component_id"].tolist() == label
    assert got["kept"].tolist() == [x == i for i, x in enumerate(label)]
    assert default >= 0.99 * linked.sum()


@pytest.mark.parametrize("dim", [2, 3, 24])
def test_no_link_is_lost_across_lists(spark, dim):
    """Few dimensions, and a crowd with many centres on it: links point from centre to centre."""
    rng = np.random.default_rng(dim)
    crowd = rng.normal(size=dim) + rng.normal(size=(700, dim)) * (0.12 if dim > 3 else 0.5)
    rows = np.concatenate([rng.normal(size=(300, dim)), crowd]).astype(np.float32)
    frame = vectors(spark, [(i, r.tolist(), 0) for i, r in enumerate(rows)])
    got = pq_dedup.near_copies(frame, lists=100).toPandas().sort_values("vec_id", ignore_index=True)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert got["n_links"].tolist() == linked.sum(axis=1).tolist()
    assert got["component_id"].tolist() == closed(len(rows), zip(*(x.tolist() for x in linked.nonzero())))


def test_vectors_without_a_direction(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 1), (3, [0.0, 0.0], 0), (4, None, 0),
            (5, [1.0, None], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [], 0), (None, [1.0, 0.0], 0),
            (9, [1.0], 0), (10, [1e-30, 0.0], 0)]
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_copies(vectors(spark, rows)).collect()}
    linked = {(1, 4, 1, True), (2, 4, 1, False), (9, 4, 1, False), (10, 4, 1, False)}
    assert got == linked | {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)} | {(None, 0, None, False)}
    assert pq_dedup.near_copies(vectors(spark, rows).limit(0)).count() == 0
    assert pq_dedup.near_copies(vectors(spark, [(4, None, 0)])).collect()[0]["n_links"] == 0
