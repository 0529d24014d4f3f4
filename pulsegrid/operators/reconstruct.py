"""Second scorer: reconstruction error of a linear autoencoder.

Standardised features are projected to their first principal components and back; what the
projection cannot reproduce of a window is its error. Principal components are the optimum of
a linear autoencoder, and MLlib fits them in one pass over the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulsegrid.functions.columns import FEATURE_DIGITS, settle
from pulsegrid.operators.features import model_vector


@dataclass(frozen=True)
class Reconstruction:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]
    offset: float = 0.0


def _error(x: Column, model: Reconstruction) -> Column:
    mean, scale = np.array(model.mean), np.array(model.scale)
    components = np.array(model.components)

    @F.pandas_udf(T.DoubleType())
    def squared_error(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series(dtype="float64")
        z = (np.stack(vectors.to_numpy()) - mean) / scale
        rest = z - z @ components @ components.T
        return pd.Series((rest**2).sum(axis=1))

    return settle(-squared_error(x))


def fit(corpus: DataFrame, components: int = 3, contamination: float = 0.05) -> Reconstruction:
    """Fit on normal windows; the boundary flags the ``contamination`` share of them."""
    rows = corpus.select(model_vector().alias("x"))
    vectors = rows.select(array_to_vector("x").alias("v"))
    scaler: StandardScalerModel = StandardScaler(
        withMean=True, inputCol="v", outputCol="z"
    ).fit(vectors)
    pca = PCA(k=components, inputCol="z", outputCol="p").fit(scaler.transform(vectors))
    scale = [s if s > 0 else 1.0 for s in scaler.std.toArray()]
    model = Reconstruction(
        tuple(scaler.mean.toArray().tolist()),
        tuple(float(s) for s in scale),
        tuple(map(tuple, pca.pc.toArray().tolist())),
    )
    errors = rows.select(_error(F.col("x"), model).alias("raw"))
    offset = errors.agg(F.percentile("raw", F.lit(contamination)).alias("offset")).first()
    return Reconstruction(
        model.mean, model.scale, model.components, round(offset["offset"], FEATURE_DIGITS)
    )


def score(features: DataFrame, model: Reconstruction) -> DataFrame:
    """Same columns as the forest's score: lower is more anomalous, flagged below 0."""
    exact = settle(_error(model_vector(), model) - F.lit(model.offset))
    return (
        features.withColumn("exact", exact)
        .withColumn("anomaly_score", settle(F.col("exact"), 6))
        .withColumn("is_anomalous", F.col("exact") < 0)
        .drop("exact")
    )
