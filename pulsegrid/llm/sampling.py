"""Bounded samples drawn by hash."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F


def drawn(rows: DataFrame, count: int, wanted: int, seed: int, *key: str) -> DataFrame:
    """At most ``wanted`` of the ``count`` rows, those whose keys hash lowest.

    All rows with a hash above a threshold are dropped beside the scan, so that tasks pass on little
    more than ``wanted`` rows between them, however many tasks there are. Far fewer rows than
    ``wanted`` come back only if many rows share few keys.
    """
    share = (wanted + 6 * math.sqrt(wanted) + 20) / max(count, 1)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) / F.lit(float(1 << 53))
    marked = rows.withColumn("drawn_by", draw)
    if share < 1:
        marked = marked.filter(F.col("drawn_by") < share)
    return marked.orderBy("drawn_by", *key).limit(wanted).drop("drawn_by")
