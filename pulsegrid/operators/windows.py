"""Sliding windows on an aligned event-time grid.

A window with end ``e`` holds the events with ``e - width <= ts <= e``; ends lie on multiples
of the slide. All events with the same first end and the same number of further ends lie in
exactly the same windows, so the two together form a *pane*: aggregate per pane first, then
give each pane row (not each event) to its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pulsegrid.functions.columns import MICROS

#: Ends of a service that one row of the spine is spread into at a time.
SPINE_CHUNK = 4096

PANE = ("service_name", "pane_end", "reach")
WINDOW = ("service_name", "window_end")


@dataclass(frozen=True)
class Sliding:
    """Window width and slide in seconds."""

    width_seconds: float = 30.0
    slide_seconds: float = 10.0

    def __post_init__(self) -> None:
        if self.width_seconds <= 0 or self.slide_seconds <= 0:
            raise ValueError("width and slide must be positive")

    @property
    def width(self) -> int:
        return round(self.width_seconds * MICROS)

    @property
    def slide(self) -> int:
        return round(self.slide_seconds * MICROS)

    @property
    def max_reach(self) -> int:
        """Further ends of an event lying exactly on a grid point."""
        return self.width // self.slide


def first_end_sql(ts: str, windows: Sliding) -> str:
    """First grid point at or after the event."""
    return f"timestamp_micros(unix_micros({ts}) + pmod(-unix_micros({ts}), {windows.slide}L))"


def shifted_sql(ts: str, steps: str | int, windows: Sliding) -> str:
    """The grid point ``steps`` slides after ``ts``."""
    return f"timestamp_micros(unix_micros({ts}) + {steps} * {windows.slide}L)"


def add_pane(events: DataFrame, windows: Sliding) -> DataFrame:
    """Add ``pane_end`` (first end) and ``reach`` (further ends) to events with a ``ts``."""
    room = f"unix_micros(ts) + {windows.width}L - unix_micros(pane_end)"
    return (
        events.selectExpr("*", f"{first_end_sql('ts', windows)} AS pane_end")
        .selectExpr("*", f"int(floor(({room}) / {windows.slide}L)) AS reach")
        .filter("reach >= 0")
    )


def to_windows(panes: DataFrame, windows: Sliding) -> DataFrame:
    """Give each pane row to every window that covers its pane."""
    kept = [name for name in panes.columns if name not in ("pane_end", "reach")]
    return panes.selectExpr("*", "explode(sequence(0, reach)) AS step").selectExpr(
        *kept, f"{shifted_sql('pane_end', 'step', windows)} AS window_end"
    )


def event_windows(events: DataFrame, windows: Sliding) -> DataFrame:
    """One row per event and window end."""
    return to_windows(add_pane(events, windows), windows)


def pane_counts(events: DataFrame, windows: Sliding) -> DataFrame:
    """Requests and errors per pane: the small table that windows are summed from."""
    return (
        add_pane(events, windows)
        .groupBy(*PANE)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("status_code") >= 500).alias("errors"),
        )
    )


def window_counts(events: DataFrame, windows: Sliding) -> DataFrame:
    """Requests and errors per window, summed from panes."""
    return (
        to_windows(pane_counts(events, windows), windows)
        .groupBy(*WINDOW)
        .agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))
    )


def event_bounds(events: DataFrame, windows: Sliding) -> DataFrame:
    """First end of the oldest and of the newest event of each service.

    Reads two columns and reduces them to one row per service beside the scan.
    """
    return events.groupBy("service_name").agg(
        F.expr(first_end_sql("min(ts)", windows)).alias("first_end"),
        F.expr(first_end_sql("max(ts)", windows)).alias("last_end"),
    )


def spine(bounds: DataFrame, windows: Sliding) -> DataFrame:
    """Every window end of every service, from its first event's first end to the last end.

    The last end is the first one at or after the newest event of all services; a service
    that has fallen silent keeps its rows. Ends come from sequences per service, so nothing
    is crossed: no row holds a service's whole grid.
    """
    last = F.unix_micros(bounds.agg(F.max("last_end")).scalar())
    spans = bounds.select("service_name", F.unix_micros("first_end").alias("first"), last.alias("last"))
    return ends_between(spans, windows)


def ends_between(spans: DataFrame, windows: Sliding) -> DataFrame:
    """Every window end of ``spans (service_name, first, last)``, grid points in microseconds.

    A span whose last lies before its first has none. Ends come in sequences of SPINE_CHUNK.
    """
    stride = windows.slide * SPINE_CHUNK
    begins = F.sequence("first", "last", F.lit(stride))
    ends = F.sequence(
        "begin", F.least(F.col("begin") + stride - windows.slide, F.col("last")), F.lit(windows.slide)
    )
    return (
        spans.filter("first <= last")
        .select("service_name", "last", F.explode(begins).alias("begin"))
        .select("service_name", F.explode(ends).alias("slot"))
        .select("service_name", F.timestamp_micros("slot").alias("window_end"))
    )


def latest_window(events: DataFrame, windows: Sliding) -> DataFrame:
    """Events of the window that ends at the first grid point at or after the newest event."""
    end = events.agg(F.expr(first_end_sql("max(ts)", windows))).scalar()
    start = F.timestamp_micros(F.unix_micros(end) - F.lit(windows.width))
    return events.filter(F.col("ts") >= start)
