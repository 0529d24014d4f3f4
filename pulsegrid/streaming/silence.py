"""Windows in which a service that was heard before sent nothing.

The stateful part sees one row per service and closed window, never events, so that a busy
service costs it no more than a quiet one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulsegrid.operators.features import FEATURES
from pulsegrid.operators.windows import Sliding
from pulsegrid.streaming.live import watermarked_windows

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def silence_processor(slide: int) -> StatefulProcessor:
    """The stateful part, for a slide in microseconds.

    A class made in a function travels to the workers by value, so they need not have this
    package installed.
    """

    class SilenceProcessor(StatefulProcessor):
        """Keeps the next window end a service owes; every end it skips is a silent window."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.owed = handle.getValueState("owed", "window_end bigint")

        def _rows(self, service: str, ends: list[int]) -> Iterator[pd.DataFrame]:
            if ends:
                stamps = pd.to_datetime(pd.Series(ends, dtype="int64"), unit="us")
                yield pd.DataFrame({"service_name": service, "window_end": stamps})

        def _owe(self, end: int) -> None:
            self.owed.update((end,))
            self.handle.registerTimer(-(-end // 1000))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            heard = sorted(end for frame in rows for end in frame["end_micros"].tolist())
            next_end = self.owed.get()[0] if self.owed.exists() else heard[0]
            silent: list[int] = []
            for end in heard:
                silent.extend(range(next_end, end, slide))
                next_end = end + slide
            self._owe(next_end)
            yield from self._rows(key[0], silent)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # A timer set here fires only with the next batch: settle all ends due by now at once.
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            next_end = self.owed.get()[0]
            silent = list(range(next_end, passed + 1, slide))
            if silent:
                next_end = silent[-1] + slide
                self._owe(next_end)
            yield from self._rows(key[0], silent)

        def close(self) -> None:
            pass

    return SilenceProcessor()


def silent_windows(events: DataFrame, windows: Sliding, delay_seconds: float) -> DataFrame:
    """Zero feature rows for the closed windows a service sent nothing in.

    From a service's first window on, these and the features of closed windows together hold
    one row per window end, as long as the watermark moves.
    """
    events.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    heard = (
        watermarked_windows(events.select("service_name", "ts"), windows, delay_seconds)
        .groupBy("window_end", "service_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("service_name", "window_end", F.unix_micros("window_end").alias("end_micros"))
    )
    silent = heard.groupBy("service_name").transformWithStateInPandas(
        statefulProcessor=silence_processor(windows.slide),
        outputStructType="service_name string, window_end timestamp",
        outputMode="Append",
        timeMode="EventTime",
    )
    return silent.withColumns({name: F.lit(0.0) for name in FEATURES})
