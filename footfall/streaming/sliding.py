"""Sliding PV and UV on a stream from signed steps: a window's value is a running sum, no row is copied into windows."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall.functions.expressions import interval_micros

# The state handlers travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PaneSteps(StatefulProcessor):
    """Per user the last pane with an event; panes come in order, as the watermark closes them.

    A pane p adds its events to the windows that end with panes p to p + width - 1. It adds the user to those of
    these windows that the user's pane before p does not reach: a step up at the first, a step down behind the last.
    Where the pane before still reaches some of them, the step down it announced is taken back.
    """

    def __init__(self, slide: int, width: int):
        self._slide, self._width = slide, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "pane long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # At most one row per pane that a micro-batch closed.
        closed = pd.concat(list(rows)).sort_values("pane")
        pane, n = closed["pane"].to_numpy(), closed["n"].to_numpy()
        width = self._width
        up, down = pane + 1, pane + 1 + width  # counted at window ends, in panes
        steps = [(up, n, np.zeros_like(n)), (down, -n, np.zeros_like(n))]
        if key[0] is not None:  # a null user counts as events only
            before = self._last.get()[0] if self._last.exists() else int(pane[0]) - width
            reach = np.concatenate(([before], pane[:-1])) + 1 + width  # where the pane before announced its step down
            steps += [(np.maximum(up, reach), 0 * n, np.ones_like(n)), (down, 0 * n, -np.ones_like(n))]
            self._last.update((int(pane[-1]),))
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            self._handle.registerTimer((int(pane[-1]) + 1 + width) * self._slide // 1000)
        end, pv, uv = (np.concatenate(parts) for parts in zip(*steps))
        # The last instant before the end: the event time of a window that ends there.
        at = pd.to_datetime(end * self._slide - 1, unit="us")
        yield pd.DataFrame({"at": at, "pv": pv, "uv": uv})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # No window that the last pane reaches can take another one any more.
        self._last.clear()
        yield pd.DataFrame({"at": pd.to_datetime([]), "pv": np.zeros(0, np.int64), "uv": np.zeros(0, np.int64)})

    def close(self) -> None:
        pass


class RunningSum(StatefulProcessor):
    """The totals behind the last step; one row per window end that has steps comes in, one per closed window goes out."""

    def __init__(self, slide: int):
        self._slide = slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._total = handle.getValueState("total", "stop long, pv long, uv long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        steps = pd.concat(list(rows)).sort_values("stop")
        stop, pv, uv = (steps[c].to_numpy() for c in ("stop", "pv", "uv"))
        before = self._total.get() if self._total.exists() else (int(stop[0]), 0, 0)
        yield self._held(before, stop, pv, uv, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        yield self._held(self._total.get(), none, none, none, timerValues)

    def _held(self, before: tuple, stop: np.ndarray, pv: np.ndarray, uv: np.ndarray, timerValues: Any) -> pd.DataFrame:
        """A row per window end from the one behind the last row to the watermark, which all steps before have passed."""
        slide = self._slide
        closed = timerValues.getCurrentWatermarkInMs() * 1000 // slide * slide + slide
        edges = np.concatenate(([before[0]], stop, [max(closed, int(stop[-1]) if len(stop) else before[0])]))
        held_pv, held_uv = before[1] + np.concatenate(([0], np.cumsum(pv))), before[2] + np.concatenate(([0], np.cumsum(uv)))
        # Where the totals are above 0 the next step is at most a window away.
        times = np.where(held_pv > 0, np.diff(edges) // slide, 0)
        self._total.update((int(edges[-1]), int(held_pv[-1]), int(held_uv[-1])))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if held_pv[-1] > 0:
            self._handle.registerTimer(int(edges[-1]) // 1000 - 1)
        first = np.repeat(np.cumsum(times) - times, times)
        end = np.repeat(edges[:-1], times) + (np.arange(times.sum()) - first) * slide
        return pd.DataFrame({"stop": end, "pv": np.repeat(held_pv, times), "uv": np.repeat(held_uv, times)})

    def close(self) -> None:
        pass


def stream_pv_uv_sliding(events: DataFrame, size: str = "5 minutes", slide: str = "5 seconds") -> DataFrame:
    """Events and exact distinct users per sliding window, as ``pv_uv_windowed`` gives them in batch; for streams.

    ``events`` carries a watermark. 1. Counts per user and pane of one ``slide``, in the JVM. 2. Keyed state of one
    pane number per user turns a pane into at most three signed steps at window ends, however many windows it lies in.
    3. Steps add up per window end; the state is one row per end still to come. 4. One running sum over the window
    ends: one small row each, some seventeen thousand a day at five seconds. A window comes out once the watermark has
    passed it, also where nothing changes in it; windows without events give no row.
    """
    step, whole = interval_micros(slide), interval_micros(size)
    if whole % step:
        raise ValueError(f"{size} is no multiple of {slide}")
    pane = F.floor(F.unix_micros("window.start") / step).alias("pane")
    panes = events.groupBy(F.window("event_time", slide), "user_id").agg(F.count("*").alias("n"))
    steps = (
        panes.select("user_id", F.window_time("window").alias("closed_at"), pane, "n")
        .groupBy("user_id")
        .transformWithStateInPandas(
            statefulProcessor=PaneSteps(step, whole // step),
            outputStructType="at timestamp, pv long, uv long",
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="at",
        )
    )
    ends = steps.groupBy(F.window("at", slide)).agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))
    totals = (
        ends.select(F.lit(0).alias("all"), F.window_time("window").alias("closed_at"), F.unix_micros("window.end").alias("stop"), "pv", "uv")
        .groupBy("all")
        .transformWithStateInPandas(
            statefulProcessor=RunningSum(step), outputStructType="stop long, pv long, uv long", outputMode="Append", timeMode="EventTime"
        )
    )
    return totals.select(F.timestamp_micros(F.col("stop") - whole).alias("window_start"), F.timestamp_micros("stop").alias("window_end"), "pv", "uv")
