"""Reading and writing log events: JSON messages, topics, archive tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pulsegrid.functions.columns import (
    epoch_to_timestamp,
    mode_label,
    timestamp_to_epoch,
    utc_date,
    utc_stamp,
)
from pulsegrid.sources import ledger
from pulsegrid.sources.schema import LOG_EVENT, SERVICE_PROFILE, SERVICE_PROFILES

CORRUPT = "corrupt_record"
_REQUIRED = ("timestamp", "status_code", "latency_ms")


#: Event times outside are set aside: a stamp in milliseconds would stretch the window grid by
#: tens of thousands of years.
EARLIEST, LATEST = "1970-01-01 00:00:00", "2100-01-01 00:00:00"


def decode(
    messages: DataFrame, value: str = "value", earliest: str = EARLIEST, latest: str = LATEST
) -> DataFrame:
    """Add the fields of a JSON message and ``corrupt_record``.

    ``corrupt_record`` holds the text of a message that is not JSON, has a field of the wrong
    type, lacks a field that features need, holds a number that is not finite, or a time not in
    [earliest, latest) (UTC); it is null for a usable event. Works on batch and streaming frames;
    other columns pass through, such as a topic's partition and offset, which tell where a bad
    message is.

    The parsed fields come out of a generator: filters on them stay above it, where a filter on
    a plain column would be pushed below and parse each message once per field it mentions.
    """
    text = F.col(value).cast("string")
    schema = T.StructType([*LOG_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "allowNonNumericNumbers": "false",
    }
    parsed = messages.select("*", F.inline(F.array(F.from_json(text, schema, options))))
    lacking = " OR ".join(f"{name} IS NULL" for name in _REQUIRED)
    ts = epoch_to_timestamp(F.col("timestamp"))
    timely = F.coalesce((ts >= utc_stamp(earliest)) & (ts < utc_stamp(latest)), F.lit(False))
    finite = F.abs("latency_ms") < float("inf")  # a literal beyond the range of doubles is infinite
    bad = F.expr(f"{lacking} OR {CORRUPT} IS NOT NULL") | ~timely | ~finite
    corrupt = F.when(bad, text)
    return parsed.select(
        *[c for c in messages.columns if c != value],
        *[f.name for f in LOG_EVENT],
        F.coalesce(corrupt, F.when(F.col(value).isNull(), F.lit(""))).alias(CORRUPT),
    )


def usable(decoded: DataFrame) -> DataFrame:
    """Decoded events fit for features, normalised."""
    return normalise(decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))


def quarantined(decoded: DataFrame) -> DataFrame:
    """The messages set aside, with the columns they came with; the job goes on without them."""
    return decoded.filter(F.col(CORRUPT).isNotNull()).drop(*[f.name for f in LOG_EVENT])


def normalise(events: DataFrame) -> DataFrame:
    """Event time from epoch seconds, default service, label."""
    return (
        events.withColumn("ts", epoch_to_timestamp(F.col("timestamp")))
        .withColumn("service_name", F.coalesce("service_name", F.lit("unknown")))
        .withColumn("anomaly_mode", mode_label(F.col("anomaly_mode")))
        .drop("timestamp")
    )


def latency_floor(latency: Column) -> Column:
    return F.greatest(F.lit(1.0), latency)


def encode(events: DataFrame) -> DataFrame:
    """Events as (key, value): the key is the service, so that a topic keeps each service's
    events in order; the value is UTF-8 JSON."""
    fields = [
        timestamp_to_epoch(F.col("ts")).alias("timestamp"),
        *[F.col(f.name) for f in LOG_EVENT if f.name != "timestamp"],
    ]
    return events.select(
        F.col("service_name").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def topic_options(
    servers: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = True
) -> dict[str, str]:
    """Options of the topic source. ``latest`` skips the backlog, ``earliest`` replays it.

    Offsets that the topic no longer holds stop the job unless ``fail_on_data_loss`` is false.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError(f"starting must be latest or earliest, not {starting!r}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Streaming events of a topic; needs the Kafka connector on the class path."""
    options = topic_options(servers, topic, starting)
    messages = spark.readStream.format("kafka").options(**options).load()
    return decode(messages.select("value", "partition", "offset"))


def topic_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the topic sink: all replicas acknowledge, five retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
    }


def write_topic(events: DataFrame, servers: str, topic: str) -> None:
    encode(events).write.format("kafka").options(**topic_sink_options(servers, topic)).save()


def with_date(rows: DataFrame, ts: str) -> DataFrame:
    return rows.withColumn("date", utc_date(F.col(ts)))


def write_archive(
    events: DataFrame,
    path: str,
    keys: tuple[str, ...] = (),
    writer: str = "batch",
    number: int | None = None,
) -> bool:
    """Add raw events to an archive by UTC date and service; see ``ledger.upsert``.

    With ``keys``, such as an event's id, events that are written again replace themselves.
    """
    return ledger.upsert(events, path, "ts", keys, ("service_name",), writer, number)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return ledger.read(spark, path)


def expire(spark: SparkSession, path: str, seconds: float) -> list[str]:
    """Delete whole days of a growing table that end ``seconds`` or more before its newest row.

    Only the newest day is read, to find that row. The day that holds the border stays whole (see
    ``retained`` for its rows). Safe to repeat; returns the days that went.
    """
    held = ledger.manifest(spark, path)
    if held is None or not held.dates:
        return []
    last = ledger.read(spark, path).filter(F.col("date") == F.lit(held.dates[-1]).cast("date"))
    oldest = F.timestamp_micros(F.unix_micros(F.max(held.ts)) - F.lit(round(seconds * 1_000_000)))
    gone = ledger.drop_before(spark, path, last.agg(utc_date(oldest)).first()[0])
    ledger.clean(spark, path)
    return gone


def time_range(rows: DataFrame, start: str, stop: str, ts: str = "ts") -> DataFrame:
    """Rows of [start, stop), in UTC, of a date-partitioned table; only those days are read."""
    low, high = utc_stamp(start), utc_stamp(stop)
    return rows.filter(
        (F.col("date") >= utc_date(low))
        & (F.col("date") <= utc_date(high))
        & (F.col(ts) >= low)
        & (F.col(ts) < high)
    )


def retained(rows: DataFrame, seconds: float, ts: str = "ts") -> DataFrame:
    """Rows not older than ``seconds`` before the newest one.

    Of a table partitioned by date only the folders of the days kept are read, and only the last
    day's to find the newest row.
    """
    last = rows
    if "date" in rows.columns:
        last = rows.filter(F.col("date") == rows.agg(F.max("date")).scalar())
    newest = last.agg(F.max(ts)).scalar()
    oldest = F.timestamp_micros(F.unix_micros(newest) - F.lit(round(seconds * 1_000_000)))
    if "date" in rows.columns:
        rows = rows.filter(F.col("date") >= utc_date(oldest))
    return rows.filter(F.col(ts) >= oldest)


def service_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SERVICE_PROFILES), SERVICE_PROFILE)
