"""Alerts from a stream of scored windows: rising edges, with a time to cool down.

State is three numbers per service, kept over micro-batches and restarts: its last window, whether that
was flagged, and the end of the window it last alerted for. A service costs a row per window, however
busy it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pulsegrid.streaming.live import AVAILABLE_NOW, Trigger
from pulsegrid.streaming.silence import ROCKSDB, STATE_STORE


def alert_processor(cooldown: int) -> StatefulProcessor:
    """The stateful part, for a cool-down in microseconds; made here, it travels to workers by value."""

    class AlertProcessor(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "window bigint, flagged boolean, alert bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            frame = pd.concat(list(rows)).sort_values("micros")
            window, flagged, alert = self.last.get() if self.last.exists() else (None, False, None)
            out = []
            for at, score, anomalous in zip(frame["micros"], frame["anomaly_score"], frame["is_anomalous"]):
                if window is not None and at <= window:
                    continue  # a window that has been judged before
                quiet = alert is None or at - alert >= cooldown
                if anomalous and not flagged and quiet:
                    alert = int(at)
                    out.append((key[0], pd.Timestamp(alert, unit="us"), score))
                window, flagged = int(at), bool(anomalous)
            if window is not None:
                self.last.update((window, flagged, alert))
            yield pd.DataFrame(out, columns=["service_name", "window_end", "anomaly_score"])

        def close(self) -> None:
            pass

    return AlertProcessor()


def alerts(scored: DataFrame, cooldown_seconds: float = 0.0) -> DataFrame:
    """Flagged windows of a stream whose service was not flagged in its window before.

    After an alert a service is quiet for ``cooldown_seconds``; an edge in that time raises none, now or
    later. Windows of a service arrive in the order of their ends, as closed windows do; one that comes
    again, or late, is passed over.
    """
    scored.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    rows = scored.select(
        "service_name", F.unix_micros("window_end").alias("micros"), "anomaly_score", "is_anomalous"
    )
    return rows.groupBy("service_name").transformWithStateInPandas(
        statefulProcessor=alert_processor(round(cooldown_seconds * 1e6)),
        outputStructType="service_name string, window_end timestamp, anomaly_score double",
        outputMode="Append",
        timeMode="None",
    )


def run_alerts(
    scored: DataFrame, path: str, cooldown_seconds: float = 0.0, trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Write alerts under ``path/alerts``, each once; state and progress lie in ``path/progress``."""
    return (
        alerts(scored, cooldown_seconds)
        .writeStream.format("parquet")
        .option("path", f"{path}/alerts")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(**trigger)
        .start()
    )
