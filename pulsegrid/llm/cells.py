"""Deal rows that share a cell to bounded tasks, so that each pair meets in exactly one.

A row is at home in one cell and may visit others. Home rows of a cell are compared with each
other and with its visitors; visitors are not compared with each other. A cell of any size is
cut into blocks, and each pair of blocks is a task of its own: nothing is left out, and no task
holds more than about two blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_CELLS = 1 << 16  #: cells there may be, which bounds the table of counts that is broadcast


def _span(start: Column, end: Column) -> Column:
    """Whole numbers from start to end, none if end is smaller."""
    none = F.expr("CAST(array() AS array<long>)")
    return F.when(start <= end, F.sequence(start, end)).otherwise(none)


def deal(visits: DataFrame, key: str, block: int) -> DataFrame:
    """``visits (cell int, home boolean, key, ...)`` once per task it belongs to.

    Adds ``first`` and ``second``, the task's two blocks within the cell, and ``own``, the row's
    block. Group by ``(cell, first, second)``; where both blocks are one, it is a block of home
    rows to compare with itself. ``key`` is unique among the rows of a cell. There are at most
    MAX_CELLS cells: the caller chooses them.
    """
    blocks = lambda rows: F.ceil(rows / F.lit(block)).cast("long")
    counts = visits.groupBy("cell").agg(
        blocks(F.count_if("home")).alias("homes"),
        blocks(F.count_if(~F.col("home"))).alias("guests"),
    )
    homes, guests, own = F.col("homes"), F.col("guests"), F.col("own")
    placed = (
        visits.join(F.broadcast(counts.filter(homes > 0)), "cell")
        .withColumn(
            "own",
            F.when(F.col("home"), F.expr(f"pmod(xxhash64({key}), homes)")).otherwise(
                homes + F.expr(f"pmod(xxhash64({key}), guests)")
            ),
        )
    )
    earlier = F.transform(
        _span(F.lit(0).cast("long"), F.when(F.col("home"), own).otherwise(homes - 1)),
        lambda other: F.struct(other.alias("first"), own.alias("second")),
    )
    later = F.transform(
        _span(own + 1, F.when(F.col("home"), homes + guests - 1).otherwise(F.lit(-1).cast("long"))),
        lambda other: F.struct(own.alias("first"), other.alias("second")),
    )
    return (
        placed.withColumn("task", F.explode(F.concat(earlier, later)))
        .select("*", "task.first", "task.second")
        .drop("task", "homes", "guests")
    )
