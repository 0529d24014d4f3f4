"""Exact nearest-rank percentiles of sliding windows, without collecting a window anywhere.

``percentile_disc`` keeps every distinct value of a group in one task. Here the rank is found
in two steps: a histogram over logarithmic cells, counted beside the scan, tells which cell of
a window holds it; then the events of just those cells are joined, counted per value, and
ranked. A window that holds a third of all events is counted by all tasks. Should one cell of
one pane hold as much, say because a timeout cuts all requests at the same latency, the join
is a plain inner equality join that adaptive execution splits (``spark.sql.adaptive.skewJoin``),
and its output is counted per value before it moves again.

A task ranks a window's cells (some 3 500 up to 10^6 ms), then the FINE parts of the cell that
holds the rank, then the distinct values of one such part: a part is a millionth of its value wide,
so a million different values in one cell come to some 250 in a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulsegrid.functions.columns import nearest_rank_sql, value_grid_sql
from pulsegrid.operators.windows import PANE, WINDOW, Sliding, shifted_sql, to_windows

#: Cells per e-fold: each spans 0.4 % of the value.
CELLS_PER_E_FOLD = 256

#: Parts of a cell.
FINE = 4096

#: Cell of an event's latency.
LATENCY_CELL = f"{value_grid_sql('latency_ms', CELLS_PER_E_FOLD)} AS cell"


def _running(by: str, order: str) -> str:
    return (
        f"sum(n) OVER (PARTITION BY {by} ORDER BY {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def _cells_holding_ranks(
    histogram: DataFrame, windows: Sliding, percents: Sequence[float]
) -> DataFrame:
    """The cell of each (window, percent) that holds the wanted rank, and the rank within it."""
    cells = to_windows(histogram, windows).groupBy(*WINDOW, "cell").agg({"n": "sum"})
    key = ", ".join(WINDOW)
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    counted = cells.withColumnRenamed("sum(n)", "n").selectExpr(
        *WINDOW,
        "cell",
        f"{_running(key, 'cell')} - n AS below",
        f"{_running(key, 'cell')} AS upto",
        f"sum(n) OVER (PARTITION BY {key} ORDER BY cell {whole}) AS total",
    )
    ranks = {p: nearest_rank_sql(p, "total") for p in percents}
    held = {p: f"({rank} > below AND {rank} <= upto)" for p, rank in ranks.items()}
    hits = ", ".join(
        f"IF({held[p]}, struct({float(p)!r}D AS percent, {ranks[p]} - below AS rank), NULL)"
        for p in percents
    )
    return (
        counted.filter(" OR ".join(held.values()))
        .selectExpr(*WINDOW, "cell", f"explode(array({hits})) AS hit")
        .filter("hit IS NOT NULL")
        .select(*WINDOW, "cell", "hit.percent", "hit.rank")
    )


def _values_of_cells(cells: DataFrame, counts: DataFrame, windows: Sliding) -> DataFrame:
    """Distinct values and their counts in the panes below the given window cells."""
    values = counts.selectExpr(*PANE, LATENCY_CELL, "latency_ms", "n")
    below = cells.selectExpr("*", f"explode(sequence(0, {windows.max_reach})) AS back").selectExpr(
        "*", f"{shifted_sql('window_end', '-back', windows)} AS pane_end"
    )
    return (
        values.join(below, ["service_name", "pane_end", "cell"])
        .filter("reach >= back")
        .selectExpr("*", f"{value_grid_sql('latency_ms', CELLS_PER_E_FOLD * FINE)} AS part")
        .groupBy(*WINDOW, "percent", "rank", "part", "latency_ms")
        .agg({"n": "sum"})
        .withColumnRenamed("sum(n)", "n")
    )


def _parts_holding_ranks(values: DataFrame) -> DataFrame:
    """The part of each (window, percent) that holds the wanted rank, and the rank within it."""
    parts = values.groupBy(*WINDOW, "percent", "rank", "part").agg({"n": "sum"})
    upto = _running(f"{', '.join(WINDOW)}, percent", "part")
    counted = parts.withColumnRenamed("sum(n)", "n").selectExpr("*", f"{upto} AS upto")
    return counted.filter("rank <= upto AND rank > upto - n").selectExpr(
        *WINDOW, "percent", "part", "rank - (upto - n) AS rank"
    )


def nearest_ranks(
    histogram: DataFrame, counts: DataFrame, windows: Sliding, percents: Sequence[float]
) -> DataFrame:
    """Columns ``p<percent>`` per service and window.

    ``histogram`` holds (pane, cell, n), ``counts`` the same events as (pane, latency_ms, n).
    """
    cells = _cells_holding_ranks(histogram, windows, percents)
    values = _values_of_cells(cells, counts, windows)
    held = _parts_holding_ranks(values)
    values = values.drop("rank").join(held, [*WINDOW, "percent", "part"])
    upto = _running(f"{', '.join(WINDOW)}, percent, part", "latency_ms")
    found = values.selectExpr("*", f"{upto} AS upto").filter("rank <= upto AND rank > upto - n")
    one_row = found.groupBy(*WINDOW).pivot("percent", [float(p) for p in percents])
    return one_row.agg({"latency_ms": "max"}).toDF(*WINDOW, *[f"p{p:g}" for p in percents])
