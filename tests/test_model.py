"""Behaviour of the models on normal and broken traffic."""

from __future__ import annotations

import math

import pytest
from logs import APART, RATES, normal_features, traffic
from pyspark.sql import functions as F

from pulsegrid.operators import forest as fo, reconstruct as rec
from pulsegrid.operators.corpus import balanced_corpus
from pulsegrid.operators.features import FEATURES, model_vector, window_features
from pulsegrid.operators.inject import BURST_CODES
from pulsegrid.operators.windows import WINDOW
from pulsegrid.plans import scorers
from pulsegrid.session import cut
from pulsegrid.sources.sinks import load_forest, save_forest, score_lines, score_rows

CASES = 40


@pytest.fixture(scope="module")
def corpus(spark):
    return cut(balanced_corpus(normal_features(spark, 500, seed=42)))


@pytest.fixture(scope="module", params=[42, 7])
def forest(request, corpus):
    return fo.fit(corpus, fo.ForestParams(seed=request.param))


def flagged_share(events, forest) -> float:
    scored = fo.score(window_features(events, APART), forest)
    return scored.agg(F.avg(F.col("is_anomalous").cast("double"))).first()[0]


def slower(events, factor: float):
    return events.withColumn("latency_ms", F.col("latency_ms") * factor)


def failing(events, share: float = 0.8):
    code = F.element_at(F.array(*map(F.lit, BURST_CODES)), (F.col("event_id") % 4 + 1).cast("int"))
    return events.withColumn(
        "status_code", F.when(F.col("event_id") % 10 < share * 10, code).otherwise(200)
    )


@pytest.mark.parametrize("service, rate", RATES)
def test_normal_windows_are_rarely_flagged(spark, forest, service, rate):
    assert flagged_share(traffic(spark, service, rate, 3 * CASES, 31, spread=0.1), forest) <= 0.12


@pytest.mark.parametrize("factor", [30, 35])
def test_latency_spike_is_flagged(spark, forest, factor):
    events = slower(traffic(spark, "auth-service", 150, CASES, 32, spread=0), factor)
    assert flagged_share(events, forest) == 1.0


def test_error_burst_with_slow_answers_is_flagged(spark, forest):
    events = failing(slower(traffic(spark, "auth-service", 150, CASES, 33, spread=0), 5))
    assert flagged_share(events, forest) == 1.0


def test_errors_alone_are_mostly_flagged(spark, forest):
    events = failing(traffic(spark, "payments-service", 90, CASES, 34, spread=0))
    assert flagged_share(events, forest) > 0.5


def test_spike_scores_below_normal(spark, forest):
    normal = traffic(spark, "auth-service", 150, CASES, 35, spread=0)
    scores = [
        fo.score(window_features(events, APART), forest).agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
        for events in (normal, slower(normal, 35))
    ]
    assert scores[1][1] < scores[0][0]


def test_five_percent_of_the_corpus_is_flagged(corpus, forest):
    share = fo.score(corpus, forest).agg(F.avg(F.col("is_anomalous").cast("int"))).first()[0]
    assert share == pytest.approx(0.05, abs=0.005)


def test_same_seed_same_forest(corpus, forest):
    again = fo.fit(corpus, forest.params)
    assert again.offset == forest.offset
    assert again.nodes.exceptAll(forest.nodes).count() == 0


def test_joined_paths_agree_with_batches(corpus, forest):
    joined = fo.path_lengths(corpus, forest).groupBy(*WINDOW).agg(F.avg("path_length").alias("a"))
    both = corpus.select(*WINDOW, fo.mean_path(model_vector(), forest).alias("b")).join(joined, list(WINDOW))
    assert both.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert both.count() == corpus.count()


def test_node_table_is_a_forest(forest):
    nodes = forest.nodes
    roots = nodes.filter("node = 1")
    assert roots.count() == forest.params.trees
    assert roots.filter(f"size != {forest.sample_size}").count() == 0
    children = nodes.groupBy("tree", F.floor(F.col("node") / 2).alias("node")).agg(
        F.sum("size").alias("below")
    )
    inner = nodes.filter("feature IS NOT NULL").join(children, ["tree", "node"], "left")
    assert inner.filter("below IS NULL OR below != size").count() == 0


def test_balanced(corpus):
    counts = {r[0]: r[1] for r in corpus.groupBy("service_name").count().collect()}
    assert len(counts) == 3 and len(set(counts.values())) == 1


def test_quota_holds_under_skew(spark):
    """A service with most of the windows gives no more than the others."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 29_000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("service_name"),
        F.timestamp_seconds("id").alias("window_end"),
    )
    drawn = balanced_corpus(rows, n_samples=600)
    assert {r[0]: r[1] for r in drawn.groupBy("service_name").count().collect()} == {
        name: 120 for name in ("hot", "s0", "s1", "s2", "s3")
    }


@pytest.mark.parametrize("rows, trees", [(50, 10), (5_000, 20), (60_000, 10)])
def test_subsample_fills_every_tree(spark, rows, trees):
    corpus = spark.range(rows).select(
        F.lit("s").alias("service_name"), F.timestamp_seconds("id").alias("window_end")
    )
    sample = fo.subsample(corpus, fo.ForestParams(trees=trees, sample_size=64), rows)
    per_tree = sample.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("window_end").alias("d"))
    assert sorted((r.tree, r.n, r.d) for r in per_tree.collect()) == [
        (t, min(64, rows), min(64, rows)) for t in range(trees)
    ]


def test_average_path():
    assert fo.average_path(1) == 0 and fo.average_path(2) == 1
    assert fo.average_path(256) == pytest.approx(10.245, abs=1e-3)


def test_store_and_load(spark, corpus, forest, tmp_path):
    save_forest(forest, str(tmp_path), "v1")
    loaded = load_forest(spark, str(tmp_path), "v1")
    assert (loaded.params, loaded.sample_size, loaded.offset) == (
        forest.params, forest.sample_size, forest.offset,
    )
    differing = fo.score(corpus, loaded).exceptAll(fo.score(corpus, forest))
    assert differing.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_forest(spark, str(tmp_path), "v9")


def test_score_rows(spark, corpus, forest):
    scored = fo.score(corpus.limit(3), forest)
    row = score_rows(scored).first()
    assert row.timestamp.endswith("Z") and len(row.timestamp) == 20
    assert row.is_anomalous == (row.anomaly_score < 0)
    assert '"anomaly_score"' in score_lines(scored).first().value
    assert fo.score(corpus.filter("false"), forest).count() == 0


def test_reconstruction_matches_numpy(spark, corpus):
    import numpy as np

    model = rec.fit(corpus, components=3)
    x = np.array([list(r) for r in corpus.select(*FEATURES).collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    rest = z - z @ vt[:3].T @ vt[:3]
    raw = -(rest**2).sum(1)
    assert model.offset == pytest.approx(np.quantile(raw, 0.05), abs=1e-6)
    got = rec.score(corpus, model).agg(F.sum("anomaly_score")).first()[0]
    assert got == pytest.approx((raw - model.offset).sum(), abs=1e-2)


def test_reconstruction_flags_a_spike(spark, corpus):
    events = slower(traffic(spark, "auth-service", 150, CASES, 32, spread=0), 30)
    scored = rec.score(window_features(events, APART), rec.fit(corpus))
    assert scored.filter("NOT is_anomalous").count() == 0
    assert math.isfinite(scored.agg(F.min("anomaly_score")).first()[0])


def test_poor_service_does_not_cap_the_others(spark):
    rows = spark.range(6001).select(
        F.when(F.col("id") == 0, "newborn").otherwise(F.concat(F.lit("s"), F.col("id") % 2)).alias("service_name"),
        F.timestamp_seconds("id").alias("window_end"),
        F.when(F.col("id") > 5000, "error_burst").otherwise("normal").alias("anomaly_mode"),
    )
    drawn = balanced_corpus(rows, n_samples=3000)
    assert {r[0]: r[1] for r in drawn.groupBy("service_name").count().collect()} == {"newborn": 1, "s0": 1000, "s1": 1000}
    assert drawn.filter("anomaly_mode <> 'normal'").isEmpty()
    assert balanced_corpus(rows, n_samples=3000, least_windows=2).select("service_name").distinct().count() == 2


def test_neighbouring_trees_draw_independently(spark):
    corpus = spark.range(6000).select(F.lit("s").alias("service_name"), F.timestamp_seconds("id").alias("window_end"))
    sample = fo.subsample(corpus, fo.ForestParams(), 6000).toPandas()
    rows = sample.groupby("tree")["window_end"].apply(set)
    shared = [len(rows[t] & rows[(t + k) % 100]) for t in range(100) for k in (1, 2, 50)]
    assert sum(shared) / len(shared) == pytest.approx(256 * 256 / 6000, rel=0.15)


def test_forest_in_slices(corpus, forest):
    one = fo.score(corpus, forest).orderBy("service_name", "window_end").collect()
    old, fo.BROADCAST_NODES = fo.BROADCAST_NODES, 7 * 2 ** (forest.depth + 1)
    try:
        forest.release()
        assert len(forest.walkers) == -(-forest.params.trees // 7)
        assert fo.score(corpus, forest).orderBy("service_name", "window_end").collect() == one
    finally:
        fo.BROADCAST_NODES = old
        forest.release()


def test_any_scorer_is_stored_and_loaded(spark, corpus, forest, tmp_path):
    models = {"v1": forest, "v2": rec.fit(corpus)}
    for version, model in models.items():
        scorers.save(spark, model, str(tmp_path), version)
    for version, model in models.items():
        loaded = scorers.load(spark, str(tmp_path), version)
        assert type(loaded) is type(model)
        rows = [scorers.score(corpus, m).orderBy("service_name", "window_end").collect() for m in (model, loaded)]
        assert rows[0] == rows[1]
    with pytest.raises(Exception):
        scorers.load(spark, str(tmp_path), "v3")
