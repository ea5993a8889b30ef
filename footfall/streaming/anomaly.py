"""Drop and surge alerts on a stream: keyed state instead of a variable shared by all tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall.operators.windows import alert_columns, download_counts

# The state handler travels to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUTPUT = (
    "window_start timestamp, window_end timestamp, dimension_value string, "
    "current_count long, previous_count long, change_rate double"
)


class PreviousWindow(StatefulProcessor):
    """Remembers the last non-empty window of each key; sees one row per closed window."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._previous = handle.getValueState("previous", "count long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # The windows one micro-batch closed, a handful per key.
        closed = pd.concat(list(rows)).sort_values("window_start")
        previous = self._previous.get()[0] if self._previous.exists() else None
        closed["previous_count"] = closed["current_count"].shift(1)
        closed.iloc[0, closed.columns.get_loc("previous_count")] = previous
        self._previous.update((int(closed["current_count"].iloc[-1]),))
        known = closed[closed["previous_count"] > 0].copy()
        known["previous_count"] = known["previous_count"].astype("int64")
        known["change_rate"] = (known["current_count"] - known["previous_count"]) / known["previous_count"]
        yield known[
            ["window_start", "window_end", "dimension_value", "current_count", "previous_count", "change_rate"]
        ]

    def close(self) -> None:
        pass


def stream_anomaly(
    events: DataFrame,
    size: str = "5 minutes",
    threshold: float = -0.5,
    threshold_up: float | None = None,
    dimension=None,
) -> DataFrame:
    """The streaming form of ``download_anomaly``; ``events`` carries a watermark.

    Python sees only the counted windows, never the events.
    """
    counts = download_counts(events, size, dimension)
    compared = counts.groupBy("dimension_value").transformWithStateInPandas(
        statefulProcessor=PreviousWindow(), outputStructType=_OUTPUT, outputMode="Append", timeMode="None"
    )
    return compared.withColumns(alert_columns(threshold, threshold_up))
