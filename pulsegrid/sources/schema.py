"""Row types."""

from __future__ import annotations

from pyspark.sql import types as T

#: Log event as it travels in JSON; ``timestamp`` is Unix epoch seconds.
LOG_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("anomaly_mode", T.StringType()),
    ]
)

#: Services with their region and events per second.
SERVICE_PROFILES = (
    ("auth-service", "us-east-1", 5.0),
    ("payments-service", "eu-west-1", 3.0),
    ("inventory-service", "ap-southeast-1", 4.0),
)
SERVICE_PROFILE = T.StructType(
    [
        T.StructField("service_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("events_per_second", T.DoubleType()),
    ]
)

#: Schema of the ``events`` table that stands in for a log archive.
EVENTS_TABLE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
