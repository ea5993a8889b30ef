"""Live rankings: the top of each window as soon as the watermark closes it."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall.operators.windows import download_stats

# The state handler travels to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TopOfWindow(StatefulProcessor):
    """The ``top`` apps of a window by downloads, then by name, kept while its rows come in.

    The state is ``top`` rows at most. When the watermark has passed the window its rows go out and the state with them.
    """

    def __init__(self, top: int):
        self._top = top

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._best = handle.getListState("best", "app_name string, download_count long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame(list(self._best.get()) if self._best.exists() else [], columns=["app_name", "download_count"])
        for part in rows:  # a window's apps come in parts, none of which is kept
            best = pd.concat([best, part[["app_name", "download_count"]]]) if len(best) else part[["app_name", "download_count"]]
            best = best.sort_values(["download_count", "app_name"], ascending=[False, True]).head(self._top)
        self._best.put([(str(app), int(n)) for app, n in zip(best["app_name"], best["download_count"])])
        if not list(self._handle.listTimers()):
            self._handle.registerTimer(int(key[1].timestamp() * 1000) - 1)
        yield self._rows(key, [])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        best = list(self._best.get())
        self._best.clear()
        yield self._rows(key, best)

    @staticmethod
    def _rows(key: Any, best: list) -> pd.DataFrame:
        found = pd.DataFrame(best, columns=["app_name", "download_count"]).astype({"download_count": "int64"})
        found.insert(0, "window_end", pd.Timestamp(key[1]))
        found.insert(0, "window_start", pd.Timestamp(key[0]))
        found["rank"] = pd.Series(range(1, len(found) + 1), dtype="int32")
        return found

    def close(self) -> None:
        pass


def stream_download_ranking(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", top: int = 10) -> DataFrame:
    """The ``top`` apps of every closed window, as ``download_ranking`` gives them in batch; for streams with a watermark.

    Downloads are counted per window and app in the JVM; keyed state then holds ``top`` rows per open window.
    """
    return (
        download_stats(events, size, slide)
        .groupBy("window_start", "window_end")
        .transformWithStateInPandas(
            statefulProcessor=TopOfWindow(top),
            outputStructType="window_start timestamp, window_end timestamp, app_name string, download_count long, rank int",
            outputMode="Append",
            timeMode="EventTime",
        )
    )
