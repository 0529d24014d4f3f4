"""Where results go: score lines, the metrics and anomalies tables, the model store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.functions.columns import iso_stamp
from pulsegrid.operators.forest import Forest, ForestParams
from pulsegrid.operators.reconstruct import Reconstruction
from pulsegrid.operators.windows import WINDOW
from pulsegrid.sources import ledger


def score_rows(scored: DataFrame) -> DataFrame:
    """The published columns of scored windows."""
    return scored.select(
        iso_stamp(F.col("window_end")).alias("timestamp"),
        "service_name",
        "anomaly_score",
        "is_anomalous",
    )


def score_lines(scored: DataFrame) -> DataFrame:
    """Score rows as JSON lines in a column ``value``, ready for a text or topic sink."""
    return score_rows(scored).select(F.to_json(F.struct("*")).alias("value"))


def write_table(rows: DataFrame, path: str, writer: str = "batch", number: int | None = None) -> bool:
    """Add windows to a growing table by UTC date; a window that is there already is replaced."""
    return ledger.upsert(rows, path, "window_end", WINDOW, writer=writer, number=number)


def write_metrics(scored: DataFrame, path: str, writer: str = "batch", number: int | None = None) -> bool:
    """Per-window statistics of all services."""
    return write_table(scored.drop("anomaly_score", "is_anomalous"), path, writer, number)


def write_anomalies(scored: DataFrame, path: str, writer: str = "batch", number: int | None = None) -> bool:
    """Flagged windows with their scores."""
    flagged = scored.filter("is_anomalous").select("service_name", "window_end", "anomaly_score")
    return write_table(flagged, path, writer, number)


def save_forest(forest: Forest, path: str, version: str) -> None:
    """Store a model beside other versions; its figures go last and mark it complete.

    Files hold FILE_NODES nodes each, about: an ordinary forest is one file, quick to open.
    """
    spark = forest.nodes.sparkSession
    files = max(1, -(-forest.max_nodes // FILE_NODES))
    forest.nodes.repartition(files).write.mode("overwrite").parquet(f"{path}/forest/model_version={version}")
    params = forest.params
    figures = [
        (
            params.trees,
            params.sample_size,
            params.contamination,
            params.seed,
            forest.sample_size,
            forest.offset,
        )
    ]
    spark.createDataFrame(figures, _FIGURES).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/model_meta/model_version={version}"
    )


def save_reconstruction(
    spark: SparkSession, model: Reconstruction, path: str, version: str
) -> None:
    row = [(list(model.mean), list(model.scale), [list(c) for c in model.components], model.offset)]
    spark.createDataFrame(row, _RECONSTRUCTION).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/reconstruction/model_version={version}"
    )


def load_reconstruction(spark: SparkSession, path: str, version: str) -> Reconstruction:
    row = spark.read.parquet(f"{path}/reconstruction/model_version={version}").first()
    components = tuple(tuple(c) for c in row["components"])
    return Reconstruction(tuple(row["mean"]), tuple(row["scale"]), components, row["offset"])


_RECONSTRUCTION = (
    "mean array<double>, scale array<double>, components array<array<double>>, offset double"
)
_NODES = "tree int, node bigint, size bigint, feature int, cut double"
FILE_NODES = 1 << 20
_FIGURES = (
    "trees int, max_sample_size int, contamination double, seed bigint, "
    "sample_size int, offset double"
)


def load_forest(spark: SparkSession, path: str, version: str) -> Forest:
    """Load a stored model; a missing version is an error (Spark's own, on the path)."""
    # With their types given, neither file is opened before it is read.
    meta = spark.read.schema(_FIGURES).parquet(f"{path}/model_meta/model_version={version}").first()
    nodes = spark.read.schema(_NODES).parquet(f"{path}/forest/model_version={version}")
    params = ForestParams(
        meta["trees"], meta["max_sample_size"], meta["contamination"], meta["seed"]
    )
    return Forest(nodes, params, meta["sample_size"], meta["offset"])
