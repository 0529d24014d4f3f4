"""Joins of points in time with spans of any length, by aligned intervals.

A span [start, stop) is cut into intervals whose lengths are powers of RADIX units and that begin at
multiples of their length: some 2 * (RADIX - 1) per level at most, a few hundred for centuries. A point
lies in one interval of each level, so a range join becomes an equality join per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.session import cut

UNIT_BITS = 20  #: a unit is so many bits of a microsecond stamp: about a second
RADIX_BITS = 4
LEVELS = 11  #: that reach over all stamps


def _unit(micros: Column, level: int) -> Column:
    """The interval of a level that a stamp lies in; shifts round down, before 1970 too."""
    return F.shiftright(micros, UNIT_BITS + RADIX_BITS * level)


def _between(first: Column, past: Column) -> Column:
    none = F.expr("CAST(array() AS array<bigint>)")
    return F.when(first < past, F.sequence(first, past - 1)).otherwise(none)


def cover(spans: DataFrame) -> DataFrame:
    """``spans`` once per interval it is cut into, as ``level`` and ``node``; empty spans have none.

    Intervals cover whole units: whoever joins by them still compares with start and stop.
    """
    low = F.shiftright(F.unix_micros("start"), UNIT_BITS)
    past = F.shiftright(F.unix_micros("stop") - 1, UNIT_BITS) + 1
    parts = []
    for level in range(LEVELS):
        first = lambda at: -F.shiftright(-F.col("low_unit"), RADIX_BITS * at)  # rounded up
        last = lambda at: F.shiftright("past_unit", RADIX_BITS * at)
        inner = (first(level + 1) < last(level + 1)) & F.lit(level + 1 < LEVELS)
        wide = lambda node: F.shiftleft(node, RADIX_BITS)
        nodes = F.when(
            inner,
            F.concat(
                _between(first(level), wide(first(level + 1))), _between(wide(last(level + 1)), last(level))
            ),
        ).otherwise(_between(first(level), last(level)))
        parts.append(F.transform(nodes, lambda node: F.struct(F.lit(level).alias("level"), node.alias("node"))))
    every = F.explode(F.concat(*parts)).alias("interval")
    units = spans.filter("start < stop").withColumn("low_unit", low).withColumn("past_unit", past)
    return units.select(*spans.columns, every).select(*spans.columns, "interval.level", "interval.node")


def _levels(covered: DataFrame) -> list[int]:
    """Levels in use: at most LEVELS numbers."""
    return sorted(r["level"] for r in covered.select("level").distinct().collect())


def holding(points: DataFrame, at: str, spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Points once per span of the same ``keys`` that holds them, with the span's other columns."""
    covered = cut(cover(spans))
    micros = F.unix_micros(at)
    own = F.explode(F.array(*[
        F.struct(F.lit(x).alias("level"), _unit(micros, x).alias("node")) for x in _levels(covered) or [0]
    ])).alias("own")
    named = points.select("*", own).select(*points.columns, "own.level", "own.node")
    met = named.join(covered, [*keys, "level", "node"])
    return met.filter((F.col(at) >= F.col("start")) & (F.col(at) < F.col("stop"))).drop("level", "node")


def disjoint(spans: DataFrame, keys: tuple[str, ...], *order: str) -> DataFrame:
    """Spans of the same keys that do not overlap, each part with the columns of the span that holds it.

    Where several do, the one that started last holds; of those the one that stops first, then the
    largest by ``order``. Empty spans, and ones with a null end, hold nothing.
    """
    real = spans.filter("start < stop")
    kept = [c for c in spans.columns if c not in (*keys, "start", "stop")]
    ends = real.select(*keys, F.explode(F.array("start", "stop")).alias("at")).distinct()
    follows = F.lead("at").over(Window.partitionBy(*keys).orderBy("at"))
    parts = ends.withColumn("past", follows).filter("past IS NOT NULL")
    held = holding(parts, "at", real, keys)
    rank = F.struct("start", -F.unix_micros("stop"), *order)
    best = held.groupBy(*keys, "at", "past").agg(F.max_by(F.struct(*kept), rank).alias("best"))
    return best.select(*keys, F.col("at").alias("start"), F.col("past").alias("stop"), *[f"best.{c}" for c in kept])


def lookup(points: DataFrame, at: str, apart: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """All points, each once, with the other columns of the span that holds it, null where none does.

    ``apart`` are spans that do not overlap (see :func:`disjoint`). One join per level in use, at most
    LEVELS, so that no point is multiplied.
    """
    covered = cut(cover(apart))  # read once per level
    kept = [c for c in apart.columns if c not in (*keys, "start", "stop")]
    out, found = points, []
    for level in _levels(covered):
        names = {c: f"{c}_at_{level}" for c in covered.columns}
        side = covered.filter(F.col("level") == level).withColumnsRenamed(names)
        same = F.col(names["node"]) == _unit(F.unix_micros(at), level)
        for key in keys:
            same &= F.col(key) == F.col(names[key])
        inside = (F.col(at) >= F.col(names["start"])) & (F.col(at) < F.col(names["stop"]))
        out = out.join(side, same & inside, "left")
        found.append(names)
    if not found:
        types = {f.name: f.dataType for f in apart.schema}
        return points.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in kept])
    # One level at most has found a span: its start tells which.
    pick = lambda c: F.coalesce(*[F.when(F.col(n["start"]).isNotNull(), F.col(n[c])) for n in found]).alias(c)
    return out.select(*points.columns, *map(pick, kept))
