"""From log events to a model and to scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrid.operators import forest
from pulsegrid.operators.corpus import OVERDRAW, balanced_corpus, short_services, without_warm_up
from pulsegrid.operators.features import spine_features
from pulsegrid.operators.windows import Sliding
from pulsegrid.session import cut

N_SAMPLES = 6000


def training_corpus(
    features: DataFrame, windows: Sliding, n_samples: int = N_SAMPLES, seed: int = 42
) -> DataFrame:
    """Balanced windows of a normal period, as a table.

    Should the threshold have let through too few windows of a service, more are offered.
    """
    full, overdraw = without_warm_up(features, windows), OVERDRAW
    while True:
        corpus = cut(balanced_corpus(full, n_samples, seed, overdraw=overdraw))
        if short_services(corpus, full, n_samples).isEmpty():
            return corpus
        overdraw *= OVERDRAW


def train(
    features: DataFrame,
    windows: Sliding,
    params: forest.ForestParams = forest.ForestParams(),
    n_samples: int = N_SAMPLES,
) -> forest.Forest:
    """Train on a materialised table of feature rows of a normal period."""
    return forest.fit(training_corpus(features, windows, n_samples, params.seed), params)


def train_on_events(
    events: DataFrame, windows: Sliding, params: forest.ForestParams = forest.ForestParams()
) -> tuple[DataFrame, forest.Forest]:
    """Features of all windows, as a table, and the model trained on them."""
    features = cut(spine_features(events, windows))
    return features, train(features, windows, params)
