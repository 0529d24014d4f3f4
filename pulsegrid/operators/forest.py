"""Isolation Forest (Liu, Ting and Zhou 2008) on DataFrames.

Nodes are numbered as in a heap: the root is 1 and the children of ``n`` are ``2n`` and
``2n + 1``, so a node's depth is the length of its number. All draws are hashes of
(seed, tree, node), which makes a forest a pure function of corpus and parameters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pulsegrid.functions.columns import FEATURE_DIGITS, settle, uniform, uniform_sql
from pulsegrid.operators.corpus import OVERDRAW, OVERDRAW_FLOOR, ROW_TAG
from pulsegrid.operators.features import FEATURES, model_vector
from pulsegrid.operators.windows import WINDOW
from pulsegrid.session import cut

EULER_GAMMA = 0.5772156649

#: Nodes (some 30 bytes each) that are sent to executors at a time; larger forests go in slices.
BROADCAST_NODES = 1_000_000


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    sample_size: int = 256
    contamination: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class Forest:
    """A trained model: its node table and the figures that turn path lengths into scores."""

    nodes: DataFrame = field(repr=False)
    params: ForestParams
    sample_size: int
    offset: float = 0.0

    @property
    def depth(self) -> int:
        return height_limit(self.sample_size)

    @property
    def max_nodes(self) -> int:
        return self.params.trees * 2 ** (self.depth + 1)

    def broadcastable(self) -> DataFrame:
        return F.broadcast(self.nodes) if self.max_nodes <= BROADCAST_NODES else self.nodes

    @cached_property
    def walkers(self) -> "list[Walker]":
        """Slices of the forest on the executors, each of BROADCAST_NODES nodes at most.

        Fetched when first needed and kept for all batches, until :meth:`release`.
        """
        step = max(1, BROADCAST_NODES // 2 ** (self.depth + 1))
        return [Walker(self, i, min(i + step, self.params.trees)) for i in range(0, self.params.trees, step)]

    def release(self) -> None:
        """Takes the forest from the executors; it is sent anew when next used."""
        for walker in self.__dict__.pop("walkers", []):
            walker.shared.destroy()


def height_limit(sample_size: int) -> int:
    return math.ceil(math.log2(max(sample_size, 2)))


def average_path(size: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``size`` rows."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1) + EULER_GAMMA) - 2.0 * (size - 1) / size


def average_path_column(size: Column) -> Column:
    n = size.cast("double")
    return (
        F.when(size <= 1, F.lit(0.0))
        .when(size == 2, F.lit(1.0))
        .otherwise(2.0 * (F.ln(n - 1.0) + F.lit(EULER_GAMMA)) - 2.0 * (n - 1.0) / n)
    )


def node_depth(node: Column) -> Column:
    return F.length(F.bin(node.cast("bigint"))) - 1


def subsample(corpus: DataFrame, params: ForestParams, size: int) -> DataFrame:
    """``min(sample_size, size)`` rows for every tree, without replacement within a tree.

    A row is offered to as many drawn trees as give each about four times the rows it needs: to all
    of them when the corpus is small, to one, or none, when it is large. Rows thus cost one
    hash each, not one per tree, and each tree ranks a bounded number of candidates. The
    number of partitions is given because adaptive coalescing goes by bytes, and growing trees
    takes time, not space.
    """
    wanted = min(params.sample_size, size)
    offers = params.trees * (OVERDRAW * wanted + OVERDRAW_FLOOR)
    offered = min(params.trees, math.ceil(offers / size))
    pool = corpus
    if offers < size:
        pool = corpus.filter(uniform(params.seed, "'pool'", *ROW_TAG) < offers / size)
    trees = F.sequence(F.lit(0), F.lit(params.trees - 1))
    if 2 * offered < params.trees:
        # As many draws as give ``offered`` different trees on average; no two trees are drawn
        # together more often than others. Beyond half of the trees a row is offered to all.
        draws = math.ceil(math.log1p(-offered / params.trees) / math.log1p(-1 / params.trees))
        drawn = [
            F.floor(uniform(params.seed, "'tree'", i, *ROW_TAG) * params.trees).cast("int")
            for i in range(draws)
        ]
        trees = F.array_distinct(F.array(*drawn))
    candidates = pool.withColumn("tree", F.explode(trees))
    tasks = min(params.trees, corpus.sparkSession.sparkContext.defaultParallelism)
    order = Window.partitionBy("tree").orderBy("draw", *WINDOW)
    return (
        candidates.withColumn("draw", uniform(params.seed, "'draw'", "tree", *ROW_TAG))
        .repartition(tasks, "tree")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= wanted)
        .drop("draw", "place")
    )


_VISIT = "node: bigint, size: bigint, feature: int, cut: double"
_NODE = "OVER (PARTITION BY tree, node)"


def _split_level(rows: DataFrame, seed: int) -> DataFrame:
    """Add each row's node to its path, and move the row to the child it belongs to."""
    ranges = ", ".join(
        f"struct({i} AS feature, min(x[{i}]) {_NODE} AS lo, max(x[{i}]) {_NODE} AS hi)"
        for i in range(len(FEATURES))
    )
    sized = rows.selectExpr(
        "tree", "node", "x", "path", f"count(*) {_NODE} AS size", f"array({ranges}) AS ranges"
    )
    u, v = (uniform_sql(seed, label, "tree", "node") for label in ("'feature'", "'cut'"))
    varied = "filter(ranges, r -> r.hi > r.lo) AS varied"
    chosen = sized.selectExpr("tree", "node", "x", "path", "size", varied).selectExpr(
        "tree", "node", "x", "path", "size", f"get(varied, int({u} * size(varied))) AS p"
    )
    split = f"struct(node, size, p.feature AS feature, p.lo + {v} * (p.hi - p.lo) AS cut)"
    return chosen.selectExpr("tree", "node", "x", "path", f"{split} AS split").selectExpr(
        "tree",
        "x",
        "array_append(path, split) AS path",
        f"{_child_sql('split.feature', 'split.cut')} AS node",
    )


def _child_sql(feature: str, cut_at: str) -> str:
    """The node a row goes to: itself at a leaf."""
    return f"IF({feature} IS NULL, node, 2 * node + int(x[{feature}] >= {cut_at}))"


def grow(sample: DataFrame, params: ForestParams, size: int) -> DataFrame:
    """Node table (tree, node, size, feature, cut) of all trees; leaves have no feature.

    One level is one set of window aggregates over (tree, node). The sample is already
    partitioned by tree, which serves every level, so all levels run in the stage that ranked
    the sample, without a further shuffle and without reading it twice. A tree's partition
    holds at most ``sample_size`` rows.
    """
    depth = height_limit(min(params.sample_size, size))
    rows = sample.select(
        "tree", F.lit(1).cast("bigint").alias("node"), model_vector().alias("x")
    ).withColumn("path", F.array().cast(f"array<struct<{_VISIT}>>"))
    for _ in range(depth):
        rows = _split_level(rows, params.seed)
    bottom = F.expr(
        f"struct(node, count(*) {_NODE} AS size, int(NULL) AS feature, double(NULL) AS cut)"
    )
    visited = rows.select("tree", F.array_append("path", bottom).alias("path")).select(
        "tree", F.inline("path")
    )
    return visited.groupBy("tree", "node").agg(
        F.max("size").alias("size"), F.max("feature").alias("feature"), F.max("cut").alias("cut")
    )


def path_lengths(features: DataFrame, forest: Forest) -> DataFrame:
    """Path length of every (row, tree): one join with the node table per level.

    Shows each tree's part; scores use :func:`mean_path`, which needs no row per tree.
    """
    rows = features.select(
        *WINDOW,
        model_vector().alias("x"),
        F.explode(F.sequence(F.lit(0), F.lit(forest.params.trees - 1))).alias("tree"),
        F.lit(1).cast("bigint").alias("node"),
    )
    nodes = forest.broadcastable()
    splits = nodes.select("tree", "node", "feature", "cut")
    for _ in range(forest.depth):
        rows = (
            rows.join(splits, ["tree", "node"])
            .selectExpr(*WINDOW, "x", "tree", f"{_child_sql('feature', 'cut')} AS node")
        )
    return rows.join(nodes.select("tree", "node", "size"), ["tree", "node"]).select(
        *WINDOW,
        "tree",
        (node_depth(F.col("node")) + average_path_column(F.col("size"))).alias("path_length"),
    )


class Walker:
    """Trees ``start`` to ``stop`` of a forest as three arrays on the executors."""

    def __init__(self, forest: Forest, start: int, stop: int) -> None:
        shape = (stop - start, 2 ** (forest.depth + 1))
        mine = forest.nodes.filter((F.col("tree") >= start) & (F.col("tree") < stop))
        table = mine.select("tree", "node", "feature", "cut", "size").toArrow()
        tree, node, size = (table[name].to_numpy().astype(np.int64) for name in ("tree", "node", "size"))
        at = (tree - start, node)
        feature = np.full(shape, -1, dtype=np.int64)
        feature[at] = table["feature"].fill_null(-1).to_numpy()
        cuts = np.zeros(shape)
        cuts[at] = table["cut"].fill_null(0.0).to_numpy()
        sizes, which = np.unique(size, return_inverse=True)
        beyond = np.array([average_path(int(n)) for n in sizes])
        length = np.zeros(shape)
        # The depth of node 1 is 0, of 2 and 3 it is 1, and so on.
        length[at] = np.frexp(node.astype(float))[1] - 1 + beyond[which]
        self.depth = forest.depth
        self.shared = forest.nodes.sparkSession.sparkContext.broadcast((feature, cuts, length))

    def total_path(self, x: Column) -> Column:
        """Path lengths of a vector in these trees, added up; a batch walks down all together."""
        shared, depth = self.shared, self.depth

        @F.pandas_udf(T.DoubleType())
        def walk(vectors: pd.Series) -> pd.Series:
            feature, cuts, length = shared.value
            if vectors.empty:
                return pd.Series(dtype="float64")
            values = np.stack(vectors.to_numpy())
            row = np.arange(len(values))[:, None]
            tree = np.arange(feature.shape[0])[None, :]
            node = np.ones((len(values), feature.shape[0]), dtype=np.int64)
            for _ in range(depth):
                used = feature[tree, node]
                right = values[row, np.maximum(used, 0)] >= cuts[tree, node]
                node = np.where(used < 0, node, 2 * node + right)
            return pd.Series(length[tree, node].sum(axis=1))

        return walk(x)


def mean_path(x: Column, forest: Forest) -> Column:
    """Mean path length of a feature vector over all trees, in Arrow batches."""
    parts = [walker.total_path(x) for walker in forest.walkers]
    return sum(parts[1:], parts[0]) / F.lit(float(forest.params.trees))


def raw_score(path: Column, forest: Forest) -> Column:
    """Minus two to the power of minus the normalised path: near -1 for outliers."""
    return settle(-F.pow(F.lit(2.0), -path / F.lit(average_path(forest.sample_size))))


def fit(corpus: DataFrame, params: ForestParams = ForestParams()) -> Forest:
    """Grow the trees and set the boundary so that ``contamination`` of the corpus is flagged.

    The corpus is read several times and should be a bounded, materialised table such as a
    cut :func:`~pulsegrid.operators.corpus.balanced_corpus`.
    """
    size = corpus.count()
    if size == 0:
        raise ValueError("empty training corpus")
    nodes = cut(grow(subsample(corpus, params, size), params, size))
    forest = Forest(nodes, params, min(params.sample_size, size))
    raw = corpus.select(raw_score(mean_path(model_vector(), forest), forest).alias("raw"))
    offset = raw.agg(F.percentile("raw", F.lit(params.contamination)).alias("offset")).first()
    fitted = replace(forest, offset=round(offset["offset"], FEATURE_DIGITS))
    fitted.__dict__["walkers"] = forest.walkers
    return fitted


def score(features: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly_score`` (lower is more anomalous) and ``is_anomalous`` (score below 0)."""
    exact = settle(raw_score(mean_path(model_vector(), forest), forest) - F.lit(forest.offset))
    return (
        features.withColumn("exact", exact)
        .withColumn("anomaly_score", settle(F.col("exact"), 6))
        .withColumn("is_anomalous", F.col("exact") < 0)
        .drop("exact")
    )
