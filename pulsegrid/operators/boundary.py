"""A boundary that follows live scores where they have drifted from those of the training.

Scores are counted per service, day and narrow cell: a table that stays small however many windows there
are, is added up over any days and services, and can be kept for a year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulsegrid.functions.columns import settle, utc_date

CELLS = 4096  #: cells in a unit of the score, a power of two: their edges are exact
DAYS = 7  #: days before the one that is judged from which its boundary comes
SIGMAS = 3.0  #: standard errors by which the flagged share may miss the trained one

DAY = ["service_name", "date"]


def score_cells(scored: DataFrame) -> DataFrame:
    """``(service_name, date, cell, n)`` of scored windows, by the UTC day they end in.

    Windows without a score are left out.
    """
    rows = scored.filter(F.col("anomaly_score").isNotNull() & ~F.isnan("anomaly_score")).select(
        "service_name",
        utc_date(F.col("window_end")).alias("date"),
        F.floor(F.col("anomaly_score") * CELLS).cast("int").alias("cell"),
    )
    return rows.groupBy(*DAY, "cell").agg(F.count("*").alias("n"))


def merged(cells: DataFrame) -> DataFrame:
    """The cells of several tables, or of one that holds a cell several times, as one."""
    return cells.groupBy(*DAY, "cell").agg(F.sum("n").alias("n"))


def trailing(cells: DataFrame, days: int = DAYS) -> DataFrame:
    """For each day that has cells those of the ``days`` days before it, its own not among them."""
    later = F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", days)))
    moved = merged(cells.withColumn("date", later))
    return moved.join(cells.select(*DAY).distinct(), DAY, "left_semi")


def live_boundaries(
    cells: DataFrame,
    contamination: float,
    days: int = DAYS,
    sigmas: float = SIGMAS,
    overlap: float = 1.0,
) -> DataFrame:
    """``(service_name, date, windows, flagged, drift, drifted, boundary)`` per service and day.

    ``drift`` tells by how many standard errors the share of the days before that lies below the trained
    boundary, 0, misses ``contamination``; neighbours of which ``overlap`` share their events count as one.
    Beyond ``sigmas`` the service has drifted, and its boundary for the day is the highest cell edge that
    flags no more than ``contamination`` of the days before; else it is 0. A service's first day, and one
    after ``days`` silent days, is not listed.
    """
    below = Window.partitionBy(*DAY).orderBy("cell")
    counted = trailing(cells, days).withColumn("upto", F.sum("n").over(below))
    windows = F.sum("n").over(Window.partitionBy(*DAY))
    # A cell whose windows may all be flagged lies below the boundary; the next one's lower edge is it.
    kept = counted.withColumn("windows", windows).withColumn(
        "above", F.when(F.col("upto") > F.col("windows") * F.lit(contamination), F.col("cell"))
    )
    found = kept.groupBy(*DAY).agg(
        F.max("windows").alias("windows"),
        F.coalesce(F.sum(F.when(F.col("cell") < 0, F.col("n"))), F.lit(0)).alias("flagged"),
        F.min("above").alias("edge"),
    )
    error = F.sqrt(F.col("windows") * F.lit(contamination * (1 - contamination) * overlap))
    drift = settle((F.col("flagged") - F.col("windows") * F.lit(contamination)) / error, 6)
    return (
        found.withColumn("drift", drift)
        .withColumn("drifted", F.abs("drift") > sigmas)
        .withColumn("boundary", F.when(F.col("drifted"), F.col("edge") / F.lit(float(CELLS))).otherwise(0.0))
        .drop("edge")
    )


def judge(scored: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Adds ``live_boundary`` and ``is_anomalous_live``: the score is below it.

    Windows of days that have no boundary are judged by the trained one.
    """
    known = boundaries.select(
        F.col("service_name").alias("known_service"), F.col("date").alias("known_date"),
        F.col("boundary").alias("live_boundary"),
    )
    same = (F.col("service_name") == F.col("known_service")) & (
        utc_date(F.col("window_end")) == F.col("known_date")
    )
    return (
        scored.join(known, same, "left")
        .drop("known_service", "known_date")
        .withColumn("live_boundary", F.coalesce("live_boundary", F.lit(0.0)))
        .withColumn("is_anomalous_live", F.col("anomaly_score") < F.col("live_boundary"))
    )
