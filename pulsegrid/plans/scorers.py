"""One interface to all scorers: score, store and load by model version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsegrid.operators import forest as fo, reconstruct as rec
from pulsegrid.operators.spans import lookup
from pulsegrid.session import cut
from pulsegrid.sources import sinks

Model = fo.Forest | rec.Reconstruction


def score(features: DataFrame, model: Model) -> DataFrame:
    """Add ``anomaly_score`` (lower is more anomalous) and ``is_anomalous`` (below 0)."""
    return (fo if isinstance(model, fo.Forest) else rec).score(features, model)


def save(spark: SparkSession, model: Model, path: str, version: str) -> None:
    """Store a model beside other versions; a table of kinds, written last, tells which it is."""
    if isinstance(model, fo.Forest):
        kind = "forest"
        sinks.save_forest(model, path, version)
    else:
        kind = "reconstruction"
        sinks.save_reconstruction(spark, model, path, version)
    kinds = spark.createDataFrame([(kind,)], "kind string").coalesce(1)
    kinds.write.mode("overwrite").parquet(f"{path}/model_kind/model_version={version}")


def load(spark: SparkSession, path: str, version: str) -> Model:
    """The model of a version; a missing one is an error (Spark's own, on the path)."""
    kind = spark.read.parquet(f"{path}/model_kind/model_version={version}").first()["kind"]
    read = {"forest": sinks.load_forest, "reconstruction": sinks.load_reconstruction}[kind]
    return read(spark, path, version)


def score_as_of(features: DataFrame, versions: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Windows scored by the model that was valid at their end, with its ``model_version``.

    ``versions`` has model_version and valid_from: a version holds from then until the next one does; of
    several from one time the largest name. Windows before the first version have null for version and
    score. A window is scored once, by its version only.
    """
    from_then = versions.groupBy("valid_from").agg(F.max("model_version").alias("model_version"))
    # One row per version: the only table that is ordered as a whole.
    ends = F.coalesce(F.lead("valid_from").over(Window.orderBy("valid_from")), F.lit("9999-01-01").cast("timestamp"))
    spans = from_then.select(
        F.lit(0).alias("all"), F.col("valid_from").alias("start"), ends.alias("stop"), "model_version"
    )
    placed = cut(lookup(features.withColumn("all", F.lit(0)), "window_end", spans, ("all",)).drop("all"))
    none = placed.filter("model_version IS NULL")
    out = none.withColumn("anomaly_score", F.lit(None).cast("double")).withColumn(
        "is_anomalous", F.lit(None).cast("boolean")
    )
    for row in from_then.collect():
        mine = placed.filter(F.col("model_version") == row["model_version"])
        out = out.unionByName(score(mine, models[row["model_version"]]))
    return out
