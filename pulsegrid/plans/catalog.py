"""Every operator as a query over the driver's tables.

The ``events`` table has some hundred rows a day, so windows are six hours wide and slide by
two, the same three to one as the library's default of 30 and 10 seconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pulsegrid.functions.columns import (
    iso_stamp,
    mode_label,
    settle,
    timestamp_to_epoch,
    utc_date,
    utc_stamp,
)
from pulsegrid.operators import boundary as bd, features as ft, forest as fo, inject as inj
from pulsegrid.operators import reconstruct as rec, sketches as sk, windows as wn
from pulsegrid.plans import reports, scorers, training
from pulsegrid.session import cut, prepare, shared_dir
from pulsegrid.sources import events as ev, ledger, sinks
from pulsegrid.sources.adapter import as_log_events, read_logs
from pulsegrid.sources.schema import EVENTS_TABLE
from pulsegrid.streaming import alerts, live, running

WINDOWS = wn.Sliding(6 * 3600, 2 * 3600)
SHORT_WINDOWS = wn.Sliding(1800, 600)
DELAY_SECONDS = 3600
SEED = 42
#: Spans of injected anomalies: service, start, stop, mode.
SPANS = (
    ("payments-service", "2024-01-10 00:00:00", "2024-01-11 00:00:00", "error_burst"),
    ("auth-service", "2024-01-15 06:00:00", "2024-01-15 18:00:00", "latency_spike"),
    ("inventory-service", "2024-01-20 00:00:00", "2024-01-21 00:00:00", "unusual_status"),
)
#: Spans that overlap, of which one lasts ten years and one is empty.
ANY_SPANS = (
    *SPANS,
    ("auth-service", "2020-01-01 00:00:00", "2030-01-01 00:00:00", "unusual_status"),
    ("payments-service", "2024-01-10 12:00:00.5", "2024-01-12 00:00:00", "latency_spike"),
    ("payments-service", "2024-01-10 12:00:00.5", "2024-01-10 18:00:00", "unusual_status"),
    ("inventory-service", "2024-01-05 00:00:00", "2024-01-05 00:00:00", "error_burst"),
)
#: Model versions, the time each holds from, and the share its boundary flags.
VERSIONS = (("v1", "2024-01-05 00:00:00", 0.05), ("v2", "2024-01-16 00:00:00", 0.1))
REPLICATES = 100
DRIFT_SIGMAS = 1.0  #: few enough for some days of the tables to have drifted
RULE = 0.25  #: error rate from which the plain rule flags a window
LATE_BEFORE = "2024-01-10 00:00:00"
STOPPED_AT = "2024-01-15 09:30:00"
RETENTION_SECONDS = 7 * 86400
RANGE = ("2024-01-12 06:00:00", "2024-01-14 18:00:00")
REPLAY_ROWS = 2_000_000  #: events, about, that a replay hands to the stream at a time

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as other engines return them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if f.dataType == T.TimestampType() else f.name
            for f in df.schema
        ]
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            settle(F.col(f.name), digits).alias(f.name) if f.dataType == T.DoubleType() else f.name
            for f in df.schema
        ]
    )


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def span_table(spark: SparkSession, spans: tuple = SPANS) -> DataFrame:
    text = spark.createDataFrame(list(spans), "service_name string, start string, stop string, mode string")
    return text.withColumns({c: F.col(c).cast("timestamp") for c in ("start", "stop")})


def features_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.window_features(read_logs(spark, sf_dir), WINDOWS)


def model_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, fo.Forest]:
    return training.train_on_events(read_logs(spark, sf_dir), WINDOWS)


def scored_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, forest = model_of(spark, sf_dir)
    return fo.score(features, forest)


def corpus_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cut(ft.spine_features(read_logs(spark, sf_dir), WINDOWS))
    return training.training_corpus(features, WINDOWS)


def injected_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inj.inject_spans(read_logs(spark, sf_dir), span_table(spark), SEED)


def injected_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Injected events scored by a model of the untouched ones, and the events' labels."""
    _, forest = model_of(spark, sf_dir)
    logs = injected_logs(spark, sf_dir)
    features = ft.spine_features(logs, WINDOWS)
    return fo.score(features, forest), reports.window_modes(logs, WINDOWS)


# -- sources and sinks


def messages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows as JSON messages, seven of fifty spoilt and one of fifty without a service.

    Spoilt: no JSON, text for a number, stamps beyond all bounds, not a number or in
    milliseconds, latencies that are infinite or not a number.
    """
    logs = read_logs(spark, sf_dir)
    turn = F.col("event_id") % 50
    stamp = timestamp_to_epoch(F.col("ts"))
    fields = [
        F.when(turn == 2, 1e300).when(turn == 3, float("nan")).when(turn == 4, stamp * 1000)
        .otherwise(stamp).alias("timestamp"),
        F.when(turn != 7, F.col("service_name")).alias("service_name"),
        F.when(turn == 5, float("inf")).when(turn == 6, float("nan")).otherwise(F.col("latency_ms"))
        .alias("latency_ms"),
        F.col("message"),
        F.col("region"),
        F.col("anomaly_mode"),
    ]
    # Numbers that JSON does not have come out as text; a careless sender writes them bare.
    good = F.regexp_replace(F.to_json(F.struct(*fields, "status_code")), '"(NaN|Infinity)"', "$1")
    text_code = F.to_json(F.struct(*fields, F.lit("oops").alias("status_code")))
    return logs.select(
        "event_id",
        F.when(turn == 0, F.lit("{bad")).when(turn == 1, text_code).otherwise(good).alias("value"),
    )


def s1_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in one pass, those set aside without fields."""
    events = ev.normalise(ev.decode(messages_of(spark, sf_dir)))
    usable = F.col(ev.CORRUPT).isNull()
    fields = [F.when(usable, F.col(c)).alias(c) for c in ("ts", "service_name", "status_code", "latency_ms")]
    return plain(events.select("event_id", usable.alias("usable"), *fields))


def s3_encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = ev.encode(read_logs(spark, sf_dir))
    back = ev.usable(ev.decode(sent)).withColumn("key", F.col("key").cast("string"))
    return plain(back)


def s4_score_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sinks.score_lines(scored_of(spark, sf_dir))
    path = fresh_path(spark, "lines")
    lines.write.text(path)
    return spark.read.schema(
        "timestamp string, service_name string, anomaly_score double, is_anomalous boolean"
    ).json(path)


def s5_model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model that was stored and loaded."""
    features, forest = model_of(spark, sf_dir)
    path = fresh_path(spark, "models")
    sinks.save_forest(forest, path, "v1")
    scored = fo.score(features, sinks.load_forest(spark, path, "v1"))
    return plain(scored.select(*wn.WINDOW, "anomaly_score", "is_anomalous"))


MORNING, AFTERNOON = "hour(ts) < 12", "hour(ts) >= 12"


def s6_archive_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive that grows: mornings, afternoons, the afternoons repeated, one day sent once more."""
    path, logs = fresh_path(spark, "archive"), read_logs(spark, sf_dir)
    for number, rows in ((0, MORNING), (1, AFTERNOON), (1, AFTERNOON), (2, "dayofmonth(ts) = 1")):
        ev.write_archive(logs.filter(rows), path, ("event_id",), "sender", number)
    ledger.compact(spark, path)
    return (
        ev.read_archive(spark, path)
        .groupBy("date", "service_name")
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))
    )


def _table(write: Callable[..., bool], name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Filled by half days, of which one is written over by the same windows."""
        path, scored = fresh_path(spark, name), cut(scored_of(spark, sf_dir))
        for rows in ("hour(window_end) < 12", "hour(window_end) >= 12", "dayofmonth(window_end) = 10"):
            write(scored.filter(rows), path)
        return plain(rounded(ledger.read(spark, path)))

    return query


def s9_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and rows left of an archive whose old folders have been deleted, twice over."""
    path, logs = fresh_path(spark, "archive"), read_logs(spark, sf_dir)
    for rows in (MORNING, AFTERNOON):
        ev.write_archive(logs.filter(rows), path, ("event_id",))
    for _ in range(2):
        ev.expire(spark, path, RETENTION_SECONDS)
    # Whatever the manifest says: what lies in the table's folders.
    files = spark.read.option("recursiveFileLookup", "true").schema(logs.schema).parquet(f"{path}/rows")
    day = F.regexp_extract(F.input_file_name(), "date=([0-9-]+)", 1).alias("day")
    return files.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def s9_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ev.retained(read_logs(spark, sf_dir), RETENTION_SECONDS)
    return plain(kept.select("event_id", "ts", "service_name"))


# -- projections and filters


def p1_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_logs(spark, sf_dir).select(
        "event_id",
        timestamp_to_epoch(F.col("ts")).alias("timestamp"),
        F.when(F.col("event_id") % 10 != 0, F.col("service_name")).alias("service_name"),
        (F.col("latency_ms") / 10).alias("latency_ms"),
        F.lit(None).cast("string").alias("anomaly_mode"),
    )
    events = ev.normalise(raw)
    return plain(events.withColumn("latency_ms", ev.latency_floor(F.col("latency_ms"))))


def p3_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = read_logs(spark, sf_dir).filter(F.col("status_code") >= 500)
    return logs.select("event_id", "service_name", "status_code")


def p4_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = wn.latest_window(read_logs(spark, sf_dir), WINDOWS)
    return plain(latest.select("event_id", "ts", "service_name"))


def p6_model_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = features_of(spark, sf_dir).select(*wn.WINDOW, ft.model_vector().alias("x"))
    parts = [F.col("x")[i].alias(f"x{i}") for i in range(len(ft.FEATURES))]
    return plain(rounded(vectors.select(*wn.WINDOW, *parts)))


def p7_iso_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_logs(spark, sf_dir).select("event_id", iso_stamp(F.col("ts")).alias("stamp"))


def p9_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    untidy = (
        F.when(F.col("event_id") % 4 == 0, "  Latency_Spike ")
        .when(F.col("event_id") % 4 == 1, "   ")
        .when(F.col("event_id") % 4 == 2, F.col("anomaly_mode"))
    )
    return read_logs(spark, sf_dir).select("event_id", mode_label(untidy).alias("label"))


# -- windows


def w1_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = wn.event_windows(read_logs(spark, sf_dir), WINDOWS)
    return plain(members.groupBy(*wn.WINDOW).agg(F.count(F.lit(1)).alias("n")))


def w3_window_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(wn.spine(wn.event_bounds(read_logs(spark, sf_dir), WINDOWS), WINDOWS))


def w4_spine_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(ft.spine_features(read_logs(spark, sf_dir), WINDOWS)))


def w9_pane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(wn.window_counts(read_logs(spark, sf_dir), WINDOWS))


def _live_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = live.stream_table(spark, f"{sf_dir}/event[s].parquet", EVENTS_TABLE)
    return as_log_events(replay)


def w4_stream_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silent windows found by the stateful stream; short windows, so that there are some."""
    path = fresh_path(spark, "silence")
    query = live.run_silence(
        _live_logs(spark, sf_dir), SHORT_WINDOWS, DELAY_SECONDS, path
    )
    query.awaitTermination()
    return plain(spark.read.parquet(f"{path}/silent"))


def w5_stream_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all closed windows, written by the stream."""
    path = fresh_path(spark, "live")
    live.run_live(_live_logs(spark, sf_dir), WINDOWS, DELAY_SECONDS, path).awaitTermination()
    return plain(rounded(live.read_metrics(spark, path)))


def _in_time_order(rows: DataFrame) -> list[DataFrame]:
    """``rows`` in slices of some REPLAY_ROWS, none older than those of the slice before.

    No event of a later slice is behind the watermark of an earlier one, so a stream that takes them
    one by one has the results of taking all at once, and keeps the open windows alone as its state.
    """
    slices = -(-rows.count() // REPLAY_ROWS)
    if slices < 2:
        return [rows]
    marks = [k / slices for k in range(1, slices)]
    ends = rows.agg(F.percentile_approx(F.unix_micros("ts"), marks, 100 * slices)).first()[0]
    ts, held = F.col("ts"), cut(rows.repartitionByRange(slices, "ts"))
    ends = [F.timestamp_micros(F.lit(end)) for end in sorted(set(ends or []))]
    if not ends:
        return [held]
    between = [(ts > low) & (ts <= high) for low, high in zip(ends, ends[1:])]
    return [held.filter(part) for part in (ts.isNull() | (ts <= ends[0]), *between, ts > ends[-1])]


def _live_twice(spark: SparkSession, first: DataFrame, second: DataFrame) -> DataFrame:
    """Metrics of a stream that stopped after ``first`` and went on with ``second``.

    The stream also stops after every slice of either, which a batch is bounded by.
    """
    files, path = fresh_path(spark, "files"), fresh_path(spark, "live")
    for part in (first, second):
        for rows in _in_time_order(part.select("event_id", "ts", "service_name", "status_code", "latency_ms")):
            rows.write.mode("append").parquet(files)
            events = live.stream_table(spark, files, rows.schema)
            live.run_live(events, WINDOWS, DELAY_SECONDS, path).awaitTermination()
    return plain(rounded(live.read_metrics(spark, path)))


def w6_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of fifty early events arrives when its windows are long closed, and is dropped."""
    logs = read_logs(spark, sf_dir)
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < utc_stamp(LATE_BEFORE))
    return _live_twice(spark, logs.filter(~late), logs.filter(late))


def w7_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops in the middle of the month and goes on: every window once."""
    logs, middle = read_logs(spark, sf_dir), utc_stamp(STOPPED_AT)
    return _live_twice(spark, logs.filter(F.col("ts") < middle), logs.filter(F.col("ts") >= middle))


#: A service that falls silent for some days.
GAP = ("payments-service", "2024-01-11 00:00:00", "2024-01-14 00:00:00")


def _running(spark: SparkSession, *parts: DataFrame) -> str:
    """Tables of the one live stream, which stopped after each of ``parts``."""
    files, path = fresh_path(spark, "files"), fresh_path(spark, "running")
    for rows in parts:
        rows = rows.select("event_id", "ts", "service_name", "status_code", "latency_ms")
        rows.coalesce(1).write.mode("append").parquet(files)
        events = live.stream_table(spark, files, rows.schema)
        running.run_windows(events, WINDOWS, DELAY_SECONDS, path).awaitTermination()
    return path


def w4_live_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live metrics with a row for every window of a service that was silent for days."""
    service, start, stop = GAP
    silent = (F.col("service_name") == service) & (F.col("ts") >= utc_stamp(start)) & (F.col("ts") < utc_stamp(stop))
    logs, middle = read_logs(spark, sf_dir).filter(~silent), utc_stamp(STOPPED_AT)
    path = _running(spark, logs.filter(F.col("ts") < middle), logs.filter(F.col("ts") >= middle))
    return plain(rounded(running.read_live(spark, path)))


def _late_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    logs = read_logs(spark, sf_dir)
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < utc_stamp(LATE_BEFORE))
    return logs.filter(~late), logs.filter(late)


def w5_pane_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live stream's state: events per pane, each in one of them only."""
    panes = running.read_live(spark, _running(spark, *_late_parts(spark, sf_dir)), "panes")
    return plain(panes.groupBy(*wn.PANE).agg(F.sum("n").alias("n")))


def w6_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that came too late for their windows, as the live stream keeps them."""
    late = running.read_live(spark, _running(spark, *_late_parts(spark, sf_dir)), "late")
    return plain(late.select("event_id", "ts", "service_name", "latency_ms"))


def w6_late_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live metrics after late events: as if all had come in time."""
    return plain(rounded(running.read_live(spark, _running(spark, *_late_parts(spark, sf_dir)))))


# -- features


def a_traffic(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        traffic = ft.window_traffic(read_logs(spark, sf_dir), WINDOWS)
        return plain(rounded(traffic.select(*wn.WINDOW, name)))

    return query


def a3_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(ft.window_latency(read_logs(spark, sf_dir), WINDOWS)))


def a3_sketch_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows from merged sketches: their events, and whether each percentile has the rank it should."""
    logs = read_logs(spark, sf_dir)
    merged = sk.window_sketches(sk.pane_sketches(logs, WINDOWS), WINDOWS)
    found = cut(sk.quantiles(merged))
    met = wn.event_windows(logs.select("ts", "service_name", "latency_ms"), WINDOWS).join(found, list(wn.WINDOW))
    checks = []
    for p in ft.PERCENTS:
        name = f"p{p}_latency_ms"
        below = F.count_if(F.col("latency_ms") < F.col(name)) / F.count(F.lit(1))
        upto = F.count_if(F.col("latency_ms") <= F.col(name)) / F.count(F.lit(1))
        near = (below - sk.RANK_ERROR <= p / 100) & (upto + sk.RANK_ERROR >= p / 100)
        checks.append(near.alias(f"p{p}_near"))
    return plain(met.groupBy(*wn.WINDOW).agg(F.max("n").alias("n"), *checks))


def a4_status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = ft.pane_histogram(ft.count_rows(read_logs(spark, sf_dir), WINDOWS))
    return plain(ft.status_histogram(histogram, WINDOWS))


def a6_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(features_of(spark, sf_dir)))


def a8_corpus_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.corpus_means(corpus_of(spark, sf_dir)))


# -- model


def m1_balanced_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(corpus_of(spark, sf_dir)))


def m2_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = corpus_of(spark, sf_dir)
    sample = fo.subsample(corpus, fo.ForestParams(), corpus.count())
    return plain(sample.select("tree", *wn.WINDOW))


def m3_forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(model_of(spark, sf_dir)[1].nodes)


def m5_path_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(fo.path_lengths(*model_of(spark, sf_dir))))


def m6_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boundary and how much of the corpus it flags."""
    corpus = corpus_of(spark, sf_dir)
    forest = fo.fit(corpus)
    return rounded(
        fo.score(corpus, forest)
        .agg(
            F.count(F.lit(1)).alias("windows"), F.count_if("is_anomalous").alias("flagged")
        )
        .withColumn("threshold", F.lit(forest.offset))
    )


def m6_live_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries that follow the scores of injected events, and the windows they flag on their days."""
    scored = cut(injected_scores(spark, sf_dir)[0])
    share, overlap = fo.ForestParams().contamination, WINDOWS.width / WINDOWS.slide
    found = cut(bd.live_boundaries(bd.score_cells(scored), share, sigmas=DRIFT_SIGMAS, overlap=overlap))
    judged = bd.judge(scored, found).groupBy("service_name", utc_date(F.col("window_end")).alias("date"))
    return found.join(judged.agg(F.count_if("is_anomalous_live").alias("flagged_live")), bd.DAY)


def m7_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_of(spark, sf_dir)
    return plain(scored.select(*wn.WINDOW, "anomaly_score", "is_anomalous"))


def m8_same_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that two forests of one corpus and seed have in common: all."""
    corpus = corpus_of(spark, sf_dir)
    forests = [fo.fit(rows) for rows in (corpus, corpus.repartition(3))]
    return rounded(forests[0].nodes.intersect(forests[1].nodes))


def m9_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cut(ft.spine_features(read_logs(spark, sf_dir), WINDOWS))
    model = rec.fit(training.training_corpus(features, WINDOWS))
    scored = rec.score(features, model)
    return plain(scored.select(*wn.WINDOW, "anomaly_score", "is_anomalous"))


def m10_model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = cut(ft.spine_features(read_logs(spark, sf_dir), WINDOWS))
    corpus = training.training_corpus(normal, WINDOWS)
    logs = injected_logs(spark, sf_dir)
    features = cut(ft.spine_features(logs, WINDOWS))
    v1 = fo.score(features, fo.fit(corpus)).withColumn("model_version", F.lit("v1"))
    v2 = rec.score(features, rec.fit(corpus)).withColumn("model_version", F.lit("v2"))
    return reports.compare_models(v1.unionByName(v2), reports.window_modes(logs, WINDOWS))


def m7_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows scored by the version that held when they ended."""
    features = cut(ft.spine_features(read_logs(spark, sf_dir), WINDOWS))
    corpus = training.training_corpus(features, WINDOWS)
    models = {name: fo.fit(corpus, fo.ForestParams(contamination=share)) for name, _, share in VERSIONS}
    versions = spark.createDataFrame([v[:2] for v in VERSIONS], "model_version string, valid_from string")
    versions = versions.withColumn("valid_from", F.col("valid_from").cast("timestamp"))
    scored = scorers.score_as_of(features, versions, models)
    return plain(scored.select(*wn.WINDOW, "model_version", "anomaly_score", "is_anomalous"))


def m10_recall_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall and false positives of the forest and of a plain rule, with their bounds."""
    scored, modes = injected_scores(spark, sf_dir)
    scored = cut(scored)
    rule = scored.withColumn("is_anomalous", F.col("error_rate") >= RULE).withColumn("model_version", F.lit("rule"))
    both = scored.withColumn("model_version", F.lit("forest")).unionByName(rule)
    bounds = reports.confidence(both, modes, "model_version", "service_name", replicates=REPLICATES, seed=SEED)
    return rounded(bounds)


# -- injection

EVENT_COLUMNS = ("event_id", "service_name", "status_code", "latency_ms", "anomaly_mode")


def injected(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inj.inject(read_logs(spark, sf_dir), mode, SEED).select(*EVENT_COLUMNS)

    return query


def i4_scoped_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return injected_logs(spark, sf_dir).select(*EVENT_COLUMNS)


def i4_any_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of any length that overlap: an event is changed by one of them."""
    logs = inj.inject_spans(read_logs(spark, sf_dir), span_table(spark, ANY_SPANS), SEED)
    return logs.select(*EVENT_COLUMNS)


def i5_labelled_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test set, counted per mode and status."""
    rows = inj.labelled_union(read_logs(spark, sf_dir), SEED)
    return rows.groupBy("anomaly_mode", "service_name", "status_code").agg(
        F.count(F.lit(1)).alias("n"), F.max("latency_ms").alias("max_latency_ms")
    )


# -- reports


def d1_rate_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = wn.window_counts(read_logs(spark, sf_dir), WINDOWS)
    return plain(rounded(reports.rate_panel(counts, WINDOWS)))


def d2_latency_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    latency = ft.window_latency(read_logs(spark, sf_dir), WINDOWS)
    return plain(reports.latency_panel(latency))


def d3_score_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.score_panel(scored_of(spark, sf_dir)))


def d4_alert_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.alert_edges(cut(scored_of(spark, sf_dir))))


def d4_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream of scored windows that stopped in the middle of the month and went on."""
    scored = cut(scored_of(spark, sf_dir)).select(*wn.WINDOW, "anomaly_score", "is_anomalous")
    files, path, middle = fresh_path(spark, "files"), fresh_path(spark, "alerts"), utc_stamp(STOPPED_AT)
    for rows in (scored.filter(F.col("window_end") < middle), scored.filter(F.col("window_end") >= middle)):
        rows.coalesce(1).write.mode("append").parquet(files)
        alerts.run_alerts(live.stream_table(spark, files, scored.schema), path).awaitTermination()
    return plain(spark.read.parquet(f"{path}/alerts"))


def d5_region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.region_rollup(read_logs(spark, sf_dir)))


def d6_detection_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = injected_scores(spark, sf_dir)
    return plain(reports.detection_delay(scored, span_table(spark), WINDOWS))


def d7_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.confusion(*injected_scores(spark, sf_dir)))


def d8_profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.profile_drift(read_logs(spark, sf_dir), ev.service_profiles(spark))


def d9_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    ev.write_archive(read_logs(spark, sf_dir), path)
    rows = ev.time_range(ev.read_archive(spark, path), *RANGE)
    return plain(rows.select("event_id", "ts", "service_name", "latency_ms"))


def all_queries() -> dict[str, Query]:
    named = {
        "s1_decode_events": s1_decode_events,
        "s3_encode_events": s3_encode_events,
        "s4_score_json": s4_score_json,
        "s5_model_store": s5_model_store,
        "s6_archive_daily": s6_archive_daily,
        "s7_metrics_table": _table(sinks.write_metrics, "metrics"),
        "s8_anomalies_table": _table(sinks.write_anomalies, "anomalies"),
        "s9_retention": s9_retention,
        "s9_expire": s9_expire,
        "p1_normalise": p1_normalise,
        "p3_errors": p3_errors,
        "p4_latest_window": p4_latest_window,
        "p6_model_vector": p6_model_vector,
        "p7_iso_stamp": p7_iso_stamp,
        "p9_label": p9_label,
        "w1_window_counts": w1_window_counts,
        "w3_window_grid": w3_window_grid,
        "w4_spine_features": w4_spine_features,
        "w4_stream_silence": w4_stream_silence,
        "w5_stream_parity": w5_stream_parity,
        "w4_live_spine": w4_live_spine,
        "w5_pane_state": w5_pane_state,
        "w6_late_rows": w6_late_rows,
        "w6_late_kept": w6_late_kept,
        "w6_late_corrected": w6_late_corrected,
        "w7_restart": w7_restart,
        "w9_pane_counts": w9_pane_counts,
        "a1_request_count": a_traffic("request_count"),
        "a2_error_rate": a_traffic("error_rate"),
        "a3_latency_percentiles": a3_latency_percentiles,
        "a3_sketch_ranks": a3_sketch_ranks,
        "a4_status_histogram": a4_status_histogram,
        "a5_status_entropy": a_traffic("status_entropy"),
        "a6_window_features": a6_window_features,
        "a8_corpus_means": a8_corpus_means,
        "m1_balanced_corpus": m1_balanced_corpus,
        "m2_subsample": m2_subsample,
        "m3_forest_nodes": m3_forest_nodes,
        "m5_path_length": m5_path_length,
        "m6_threshold": m6_threshold,
        "m6_live_boundary": m6_live_boundary,
        "m7_scores": m7_scores,
        "m7_versions": m7_versions,
        "m8_same_seed": m8_same_seed,
        "m9_reconstruction": m9_reconstruction,
        "m10_model_compare": m10_model_compare,
        "m10_recall_bounds": m10_recall_bounds,
        "i1_latency_spike": injected("latency_spike"),
        "i2_error_burst": injected("error_burst"),
        "i3_unusual_status": injected("unusual_status"),
        "i4_scoped_injection": i4_scoped_injection,
        "i4_any_spans": i4_any_spans,
        "i5_labelled_union": i5_labelled_union,
        "d1_rate_panel": d1_rate_panel,
        "d2_latency_panel": d2_latency_panel,
        "d3_score_panel": d3_score_panel,
        "d4_alert_edges": d4_alert_edges,
        "d4_stream_alerts": d4_stream_alerts,
        "d5_region_rollup": d5_region_rollup,
        "d6_detection_delay": d6_detection_delay,
        "d7_confusion": d7_confusion,
        "d8_profile_drift": d8_profile_drift,
        "d9_time_range": d9_time_range,
    }

    def in_utc(query: Query) -> Query:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir)

    return {name: in_utc(query) for name, query in named.items()}
