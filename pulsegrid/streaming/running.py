"""One live stream: panes are its state, silent services keep their rows, late events correct theirs.

Every micro-batch adds its events, counted per pane, to a table; an event is one row of it at most,
however many windows it lies in. A window is computed from its panes when it closes, and again when
an event arrives that belonged to it. All tables are growing ones (see ``sources.ledger``) that take a
batch's number once, so a batch that is repeated after a crash adds nothing twice.

Under ``path``: ``panes``, ``services`` (first window ends), ``metrics`` (features, zeros for silent
windows), ``scores`` (with a model), ``late`` (events behind the closed windows), ``ahead`` (events
stamped too far in the future), ``progress`` (the stream's own).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.features import FEATURES, features_of_counts
from pulsegrid.operators.windows import PANE, WINDOW, Sliding, add_pane, ends_between, to_windows
from pulsegrid.plans.scorers import Model, score
from pulsegrid.sources import ledger
from pulsegrid.streaming.live import AVAILABLE_NOW, Trigger

EPOCH = date(1970, 1, 1)
DAY = 86_400_000_000
WRITER = "live"


def _stamp(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _days(first: int, last: int) -> Column:
    """Rows of a growing table dated from one time to another, in microseconds."""
    low, high = (EPOCH + timedelta(days=at // DAY) for at in (first, last))
    return F.col("date").between(F.lit(low), F.lit(high))


@dataclass(frozen=True)
class Running:
    """What a batch needs to know; ``ahead`` and ``delay`` in microseconds."""

    windows: Sliding
    delay: int
    ahead: int
    path: str
    model: Model | None

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def upsert(self, rows: DataFrame, name: str, ts: str, number: int, keys: tuple[str, ...] = (), **notes) -> bool:
        return ledger.upsert(rows, self.table(name), ts, keys, writer=WRITER, number=number, notes=notes)

    def __call__(self, batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            self.take(batch, number)
        finally:
            batch.unpersist()

    def take(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = ledger.manifest(spark, self.table("panes"))
        if held and held.writers.get(WRITER, -1) >= number:
            notes = held.notes  # of this very batch: only the last one can come again
            timely = batch.filter(F.col("ts") <= _stamp(notes["limit"]))
        else:
            before = held.notes if held else {}
            limit = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0] + self.ahead
            timely = batch.filter(F.col("ts") <= _stamp(limit))
            newest = timely.agg(F.unix_micros(F.max("ts"))).first()[0]
            newest = max((x for x in (newest, before.get("newest")) if x is not None), default=None)
            closed = before.get("closed")
            if newest is not None:
                grid = (newest - self.delay) // self.windows.slide * self.windows.slide
                closed = grid if closed is None else max(closed, grid)
            notes = {"limit": limit, "newest": newest, "was_closed": before.get("closed"), "closed": closed}
            counts = add_pane(timely, self.windows).groupBy(*PANE, "status_code", "latency_ms").agg(
                F.count(F.lit(1)).alias("n")
            )
            self.upsert(counts, "panes", "pane_end", number, **notes)
        self.upsert(batch.filter(F.col("ts") > _stamp(notes["limit"])), "ahead", "ts", number)
        panes = add_pane(timely, self.windows)
        was_closed = notes["was_closed"]
        late = panes.limit(0) if was_closed is None else panes.filter(F.col("pane_end") <= _stamp(was_closed))
        self.upsert(late.drop("pane_end", "reach"), "late", "ts", number)
        self.settle(panes, late, number, notes)

    def settle(self, panes: DataFrame, late: DataFrame, number: int, notes: dict) -> None:
        """Features, and scores, of all windows that this batch closes or corrects."""
        spark, closed, before = panes.sparkSession, notes["closed"], notes["was_closed"]
        if closed is None:
            return
        met = panes.groupBy("service_name").agg(F.min("pane_end").alias("first_end"))
        if ledger.manifest(spark, self.table("services")) is None:
            known = met.limit(0)
        else:  # as they were before this batch, also when it comes again
            known = ledger.read(spark, self.table("services")).filter(F.col("number") < number)
            known = known.groupBy("service_name").agg(F.min("first_end").alias("first_end"))
        was = known.withColumnRenamed("first_end", "was_first")
        news = met.join(was, "service_name", "left").filter("was_first IS NULL OR first_end < was_first")
        self.upsert(
            news.select("service_name", "first_end", F.lit(number).cast("long").alias("number")), "services", "first_end", number
        )
        news, slide = news.persist(), self.windows.slide
        first, last = F.unix_micros("first_end").alias("first"), F.lit(closed).alias("last")
        # Services known before owe the ends from the last closed one on, new ones all of theirs.
        spans = [news.filter("was_first IS NULL").select("service_name", first, last)]
        if before is not None:
            owed = F.greatest(F.unix_micros("first_end"), F.lit(before + slide)).alias("first")
            spans.append(known.select("service_name", owed, last))
            back = F.least(F.unix_micros("was_first") - slide, F.lit(before)).alias("last")
            spans.append(news.filter("was_first IS NOT NULL").select("service_name", first, back))
        ends = ends_between(spans[0], self.windows)
        for span in spans[1:]:
            ends = ends.unionByName(ends_between(span, self.windows))
        touched = to_windows(late.select("service_name", "pane_end", "reach").distinct(), self.windows)
        ends = ends.unionByName(touched.filter(F.col("window_end") <= _stamp(closed))).distinct()
        heard = self.features(spark, late, before, closed)
        features = ends.join(heard, list(WINDOW), "left").na.fill(0.0, list(FEATURES)).select(*WINDOW, *FEATURES)
        features.persist()
        self.upsert(features, "metrics", "window_end", number, WINDOW)
        if self.model is not None:
            scored = score(features, self.model).select(*WINDOW, "anomaly_score", "is_anomalous")
            self.upsert(scored, "scores", "window_end", number, WINDOW)
        features.unpersist()
        news.unpersist()

    def features(self, spark: SparkSession, late: DataFrame, before: int | None, closed: int) -> DataFrame:
        """Features, from the table of panes, of the windows that close now and of those touched late."""
        panes = ledger.read(spark, self.table("panes"))
        end, width = F.col("pane_end"), self.windows.width
        if before is None:
            fresh = panes.filter(end <= _stamp(closed))
            return features_of_counts(fresh.drop("date"), self.windows).filter(F.col("window_end") <= _stamp(closed))
        fresh = panes.filter(_days(before - width, closed)).filter((end > _stamp(before - width)) & (end <= _stamp(closed)))
        new = features_of_counts(fresh.drop("date"), self.windows).filter(
            (F.col("window_end") > _stamp(before)) & (F.col("window_end") <= _stamp(closed))
        )
        touched = to_windows(late.select("service_name", "pane_end", "reach").distinct(), self.windows)
        touched = touched.filter(F.col("window_end") <= _stamp(before)).distinct().persist()
        days = [r[0] for r in touched.select(F.explode(F.sequence(
            F.floor((F.unix_micros("window_end") - width) / DAY), F.floor(F.unix_micros("window_end") / DAY)
        ))).distinct().collect()]
        if not days:
            return new
        # The panes that reach into a touched window, of the days in question alone.
        steps = F.sequence(F.lit(0), F.lit(self.windows.max_reach))
        behind = touched.select("service_name", F.explode(steps).alias("step"), "window_end").select(
            "service_name",
            F.timestamp_micros(F.unix_micros("window_end") - F.col("step") * self.windows.slide).alias("pane_end"),
        ).distinct()
        some = panes.filter(F.col("date").isin([EPOCH + timedelta(days=d) for d in days])).drop("date")
        again = features_of_counts(some.join(behind, ["service_name", "pane_end"], "left_semi"), self.windows)
        return new.unionByName(again.join(touched, list(WINDOW), "left_semi"))


def run_windows(
    events: DataFrame,
    windows: Sliding,
    delay_seconds: float,
    path: str,
    model: Model | None = None,
    ahead_seconds: float = 86_400.0,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep the tables under ``path`` up to date with a stream of events.

    A window is closed, and written, once an event ``delay_seconds`` after its end has been seen. From
    its first window on, a service has a row for every closed end, all zeros where it was silent. An
    event whose windows are closed already is kept in ``late`` as it came, and the rows of its windows,
    scores included, are replaced; one that makes its service known earlier adds the silent windows in
    between. An event stamped more than ``ahead_seconds`` after its arrival goes to ``ahead`` and closes
    nothing. Events need ts, service_name, status_code and latency_ms.
    """
    running = Running(windows, round(delay_seconds * 1e6), round(ahead_seconds * 1e6), path, model)
    return (
        events.writeStream.foreachBatch(running)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**trigger)
        .start()
    )


def read_live(spark: SparkSession, path: str, name: str = "metrics") -> DataFrame:
    """One of the tables, without its dates."""
    return ledger.read(spark, f"{path}/{name}").drop("date")


def anomalies(spark: SparkSession, path: str) -> DataFrame:
    """The windows flagged as things stand: a corrected window may come and go."""
    return read_live(spark, path, "scores").filter("is_anomalous")
