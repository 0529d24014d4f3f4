"""Mix sources to target weights: rake token weights to marginals, then sample documents."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.session import cut

DIMENSIONS = ("source", "lang", "topic")
#: Without targets, a value's share is its share of tokens to this power, so that rare values gain.
FLATTEN = {"source": 0.8, "lang": 0.8, "topic": 1.0}
SWEEPS = 50
TOLERANCE = 1e-6  #: largest relative miss of a marginal at which raking ends
RARE = 0.001  #: cells of the highest ratios, with so much of the tokens at most, do not set the factor
FITS = 1e-9  #: by which share a cell may need more than it has before it is taken whole
DRIVER_CELLS = 1 << 16  #: cells up to which the driver rakes them and sends their table to the documents


def words(text: Column) -> Column:
    """White-space words, the unit of weight by default; null is empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def topic_of(text: Column) -> Column:
    """What kind of text it is, by its characters: a stand-in where no topic is given."""
    text = F.coalesce(text, F.lit(""))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))
    return (
        F.when(text == "", "empty")
        .when(share(r"[{}<>=;#$%&*_|\\]") > 0.02, "markup")
        .when(share("[0-9]") > 0.02, "numbers")
        .when(share("\n") > 0.02, "lists")
        .when(F.length(text) > 4000, "long prose")
        .otherwise("prose")
    )


def _marginal(cells: DataFrame, name: str, weight: str) -> DataFrame:
    return cells.groupBy(F.col(name).alias("value")).agg(F.sum(weight).alias("mass"))


def _flattened(cells: DataFrame, name: str) -> DataFrame:
    """``(value, share)`` targets from the cells' own shares."""
    raised = _marginal(cells, name, "tokens").withColumn(
        "raised", F.pow(F.col("mass"), F.lit(FLATTEN[name]))
    )
    total = raised.agg(F.sum("raised").alias("all"))
    return raised.join(F.broadcast(total)).select("value", (F.col("raised") / F.col("all")).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """``cells`` with ``weight``: their tokens, fitted to the marginal shares in ``targets``.

    Iterative proportional fitting: per sweep, the weights of all cells of a value are scaled to the
    value's share of the total, for one dimension after another, until all fit to TOLERANCE or after
    SWEEPS sweeps (targets that contradict each other do not fit). A sweep is written to the shared
    folder. Values without a target get weight zero, targets without tokens are left out.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    wanted = {}
    for name, shares in targets.items():
        held = shares.join(_marginal(cells, name, "tokens").withColumnRenamed("value", "held"),
                           F.col("value").eqNullSafe(F.col("held")), "left_semi")
        some = held.agg(F.sum("share")).first()[0] or 1.0
        wanted[name] = cut(held.select("value", (F.col("share") / some * total).alias("target")))
    current = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(SWEEPS):
        misses = None
        for name, target in wanted.items():
            have = _marginal(current, name, "weight")
            factor = have.withColumnRenamed("value", "had").join(
                target, F.col("had").eqNullSafe(F.col("value")), "left"
            ).select("had", F.coalesce(F.col("target") / F.col("mass"), F.lit(0.0)).alias("factor"))
            current = (
                current.join(factor, F.col(name).eqNullSafe(F.col("had")))
                .withColumn("weight", F.col("weight") * F.col("factor"))
                .withColumn("off_" + name, F.abs(F.col("factor") - 1))
                .drop("had", "factor")
            )
            misses = F.col("off_" + name) if misses is None else F.greatest(misses, "off_" + name)
        swept = cut(current.withColumn("off", F.when(F.col("weight") > 0, misses)))
        off = swept.agg(F.max("off")).first()[0]
        current = swept.drop("off", *("off_" + name for name in wanted))
        if off is None or off <= TOLERANCE:
            break
    return current


def _ceiling(raked: DataFrame, rare: float) -> float | None:
    """The largest ratio, but for that of cells with ``rare`` of the tokens in all."""
    bins = raked.filter("ratio > 0").groupBy(F.floor(F.log2("ratio") * 64).alias("bin")).agg(
        F.max("ratio").alias("most"), F.sum("tokens").alias("tokens")
    ).orderBy(F.desc("bin")).collect()
    room = rare * sum(row["tokens"] for row in bins)
    for row in bins:
        room -= row["tokens"]
        if room < 0:
            return row["most"]
    return None


class Cells:
    """Cells held in the driver, for at most DRIVER_CELLS of them; the same steps as on tables."""

    def __init__(self, cells: DataFrame, targets: Mapping[str, DataFrame] | None) -> None:
        rows = cells.orderBy(*DIMENSIONS).collect()
        self.schema, self.spark = cells.schema, cells.sparkSession
        self.keys = [tuple(row[name] for name in DIMENSIONS) for row in rows]
        self.tokens = np.array([row["tokens"] for row in rows], float)
        self.codes, self.wanted = {}, {}
        for i, name in enumerate(DIMENSIONS):
            values: dict[str | None, int] = {}
            code = np.array([values.setdefault(key[i], len(values)) for key in self.keys], np.int64)
            if targets is None:
                share = np.bincount(code, self.tokens, len(values)) ** FLATTEN[name]
            elif name not in targets:
                continue
            else:
                held = cells.select(F.col(name).alias("held")).distinct()
                shares = targets[name].join(held, F.col("value").eqNullSafe(F.col("held")), "left_semi")
                given = {row["value"]: row["share"] for row in shares.collect()}
                share = np.array([given.get(value) or 0.0 for value in values])
            self.codes[name], self.wanted[name] = code, share / (share.sum() or 1.0)

    def rake(self, weight: np.ndarray, wanted: Mapping[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        """The weights of ``rows``, fitted to ``wanted`` masses per value."""
        weight = weight[rows].copy()
        for _ in range(SWEEPS):
            off = 0.0
            for name, target in wanted.items():
                code = self.codes[name][rows]
                have = np.bincount(code, weight, len(target))
                factor = np.divide(target, have, out=np.zeros(len(target)), where=have > 0)
                weight *= factor[code]
                off = max(off, np.abs(factor - 1).max(initial=0.0, where=(have > 0) & (target > 0)))
            if off <= TOLERANCE:
                break
        return weight

    def ratios(self, budget: float | None, rare: float) -> tuple[DataFrame, float]:
        every = np.arange(len(self.keys))
        total = self.tokens.sum()
        weight = self.rake(self.tokens, {name: share * total for name, share in self.wanted.items()}, every)
        ratio = np.divide(weight, self.tokens, out=np.zeros(len(every)), where=self.tokens > 0)
        bins = np.floor(np.log2(ratio, out=np.zeros(len(every)), where=ratio > 0) * 64)
        room, most = rare * self.tokens[ratio > 0].sum(), None
        for at in sorted(set(bins[ratio > 0].tolist()), reverse=True):
            inside = (ratio > 0) & (bins == at)
            room -= self.tokens[inside].sum()
            if room < 0:
                most = ratio[inside].max()
                break
        factor = 1 / most if most else 1.0
        if budget is not None and weight.sum():
            factor = min(factor, budget / weight.sum())
        weight *= factor
        wanted, full = weight.copy(), np.zeros(len(every), bool)
        while np.any(over := ~full & (weight > self.tokens * (1 + FITS))):
            full |= over
            weight[full] = self.tokens[full]
            rest = np.flatnonzero(~full)
            mass = weight[rest].sum()
            if not mass:
                break
            left = {}
            for name, code in self.codes.items():
                size = len(self.wanted[name])
                taken = np.bincount(code[full], self.tokens[full], size)
                gap = np.maximum(np.bincount(code, wanted, size) - taken, 0.0)
                gap[np.bincount(code[rest], minlength=size) == 0] = 0.0
                left[name] = gap / (gap.sum() or 1.0) * mass
            weight[rest] = self.rake(self.tokens, left, rest)
        ratio = np.minimum(1.0, np.divide(weight, self.tokens, out=np.zeros(len(every)), where=self.tokens > 0))
        schema = ", ".join(f"cell_{name} string" for name in DIMENSIONS) + ", ratio double"
        rows = [(*key, float(r)) for key, r in zip(self.keys, ratio)]
        return self.spark.createDataFrame(rows, schema), factor


def _refill(raked: DataFrame, factor: float, names: list[str]) -> DataFrame:
    """Cells with ``ratio`` as their probability, 1 for cells that would need more than they have.

    What those lack is not to be had. The others are raked again, to what the marginals leave them,
    with the expected tokens they had; cells that then need more are taken whole in turn, until none does.
    """
    current = raked.withColumn("weight", F.col("weight") * factor).select(
        *DIMENSIONS, "tokens", "weight", F.col("weight").alias("wanted"), F.lit(False).alias("full")
    )
    over = ~F.col("full") & (F.col("weight") > F.col("tokens") * (1 + FITS))
    while not current.filter(over).isEmpty():
        full = F.col("full") | over
        current = cut(
            current.withColumn("full", full).withColumn(
                "weight", F.when(F.col("full"), F.col("tokens")).otherwise(F.col("weight"))
            )
        )
        rest = current.filter("NOT full")
        mass, tokens = rest.agg(F.sum("weight"), F.sum("tokens")).first()
        if not mass:
            break
        left = F.sum("wanted") - F.sum(F.when(F.col("full"), F.col("tokens")).otherwise(0.0))
        targets = {
            name: current.groupBy(F.col(name).alias("value")).agg(F.greatest(left, F.lit(0.0)).alias("share"))
            for name in names
        }
        again = rake(rest, targets).withColumn("weight", F.col("weight") * (mass / tokens))
        current = cut(current.filter("full").unionByName(again))
    return current.withColumn("ratio", F.least(F.lit(1.0), F.col("weight") / F.col("tokens")))


def _ratios(
    cells: DataFrame, targets: Mapping[str, DataFrame] | None, budget: float | None, rare: float
) -> tuple[DataFrame, float]:
    """``(cell_source, cell_lang, cell_topic, ratio)``, and the factor: for any number of cells."""
    wanted = {name: _flattened(cells, name) for name in DIMENSIONS} if targets is None else targets
    raked = cut(rake(cells, wanted).withColumn("ratio", F.col("weight") / F.col("tokens")))
    mass = raked.agg(F.sum("weight")).first()[0]
    most = _ceiling(raked, rare)
    factor = 1 / most if most else 1.0
    if budget is not None and mass:
        factor = min(factor, budget / mass)
    filled = _refill(raked, factor, list(wanted))
    return filled.select(*(F.col(name).alias("cell_" + name) for name in DIMENSIONS), "ratio"), factor


def marginals(mixed: DataFrame, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(dimension, value, tokens, expected, share, target, miss)`` of a mix.

    ``expected`` tokens are kept of ``tokens``; ``share`` is theirs among all expected, ``target`` the
    share asked for (``targets``, or by default that of ``mix``, among values that have tokens), and
    ``miss`` their difference: what cells taken whole, or targets that contradict each other, cost.
    """
    cells = cut(
        mixed.groupBy(*DIMENSIONS).agg(
            F.sum("tokens").cast("double").alias("tokens"),
            F.sum(F.col("tokens") * F.col("probability")).alias("expected"),
        ).filter("tokens > 0")
    )
    whole = cells.agg(F.sum("expected")).first()[0] or 1.0
    out = None
    for name in DIMENSIONS:
        rows = cells.groupBy(F.lit(name).alias("dimension"), F.col(name).alias("value")).agg(
            F.sum("tokens").alias("tokens"), F.sum("expected").alias("expected")
        )
        if targets is None:
            asked = _flattened(cells, name)
        elif name in targets:
            held = targets[name].join(
                rows.select(F.col("value").alias("held")), F.col("value").eqNullSafe(F.col("held")), "left_semi"
            )
            some = held.agg(F.sum("share")).first()[0] or 1.0
            asked = held.select("value", (F.col("share") / some).alias("share"))
        else:
            asked = rows.select("value", F.lit(None).cast("double").alias("share"))
        asked = asked.select(F.col("value").alias("of"), F.col("share").alias("target"))
        share = F.col("expected") / whole
        found = rows.join(asked, F.col("value").eqNullSafe(F.col("of")), "left").select(
            "dimension", "value", "tokens", "expected", share.alias("share"), "target",
            (share - F.col("target")).alias("miss"),
        )
        out = found if out is None else out.unionByName(found)
    return out


def mix(
    docs: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    budget: float | None = None,
    rare: float = RARE,
    seed: int = 42,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    tokens: Column | None = None,
) -> DataFrame:
    """``docs`` as ``row``, with source, lang, topic, tokens, probability and chosen.

    Documents are put in cells by source, language and topic; the cells' tokens are raked to
    ``targets`` (per dimension ``(value, share)``, by default FLATTEN of the table's own shares). A
    document's probability is its cell's weight over its tokens, times one factor: the largest that
    keeps all at 1 or below, or less if ``budget`` tokens are expected before. So expected tokens per
    source, language and topic are in the proportions asked for. Cells of the highest ratios with ``rare``
    of the tokens in all have no say in the factor: they are taken whole, fall short of their
    proportions (see ``marginals``), and the others are raked again to what is left, until no cell needs
    more than it has. With ``rare`` 0 the rarest cell sets the factor. A document is chosen if a hash of seed, id
    and text, as a number in [0, 1), is smaller: the same for any partitioning.

    A null source or language is a value of its own. Documents without tokens are in no cell that
    counts: their probability is that of the factor alone. Repeated rows share their fate. An empty
    table gives an empty result.
    """
    measured = cut(
        docs.select(
            F.struct(*docs.columns).alias("row"),
            F.xxhash64(F.lit(seed), F.col(id), F.col(text)).alias("draw"),
            F.col(source).cast("string").alias("source"),
            F.col(lang).cast("string").alias("lang"),
            (topic_of(F.col(text)) if topic is None else topic).alias("topic"),
            (words(F.col(text)) if tokens is None else tokens).cast("long").alias("tokens"),
        )
    )
    cells = cut(
        measured.groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("tokens")).filter("tokens > 0")
    )
    if cells.count() <= DRIVER_CELLS:
        ratios, factor = Cells(cells, targets).ratios(budget, rare)
        ratios = F.broadcast(ratios)
    else:  # the join is a shuffle, whose hot cells may be split
        ratios, factor = _ratios(cells, targets, budget, rare)
    same = F.lit(True)
    for name in DIMENSIONS:
        same &= F.col(name).eqNullSafe(F.col("cell_" + name))
    uniform = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    probability = F.round(F.least(F.lit(1.0), F.coalesce("ratio", F.lit(factor))), 9)
    return (
        measured.join(ratios, same, "left")
        .withColumn("probability", probability)
        .withColumn("chosen", uniform < F.col("probability"))
        .select("row", *DIMENSIONS, "tokens", "probability", "chosen")
    )


def keep_mixed(docs: DataFrame, **options) -> DataFrame:
    """The chosen rows of ``docs``, as they are."""
    return mix(docs, **options).filter("chosen").select("row.*")
