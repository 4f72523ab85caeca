"""The stateful operator that no built-in streaming operator expresses.

It works on numbers per key; everything around it stays in DataFrame expressions.  This module imports nothing of the package, so it can travel
to the workers by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class DayRefreshProcessor(StatefulProcessor):
    """Publishes the running total of one key and day at every refresh of event time.

    Input rows: the key columns, day, tick_ms, and the measures (``measures`` maps each to
    BIGINT or DOUBLE) already summed per tick.  State: the sums of ticks not yet published, and the total of those that are.
    When a timer fires, every tick the watermark has passed is published in order and a
    timer for the next open tick is set.  A row that comes after its tick was published
    joins the next one; one that comes after its day is over is dropped.
    """

    def __init__(self, columns: list[str], measures: dict[str, str], refresh_ms: int, offset_ms: int):
        self.columns = columns
        self.measures = list(measures)
        self.kinds = measures
        self.refresh_ms = refresh_ms
        self.offset_ms = offset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = ", ".join(f"{m} {kind}" for m, kind in self.kinds.items())
        self.open = handle.getListState("open", f"tick_ms BIGINT, {sums}")
        self.total = handle.getValueState("total", sums)

    def _last_tick(self, key) -> int:
        return (int(key[-1]) + 1) * 86_400_000 - self.offset_ms - 1

    def _by_tick(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        whole = {c: "int64" for c in ["tick_ms", *self.measures] if self.kinds.get(c) != "DOUBLE"}
        return pd.concat(frames)[["tick_ms", *self.measures]].groupby("tick_ms", as_index=False).sum().astype(whole)

    def _rows(self, frame: pd.DataFrame) -> list[tuple]:
        """Rows as Python numbers, each column in its own type."""
        return list(zip(*(frame[c].tolist() for c in frame.columns), strict=True))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark, last = timerValues.getCurrentWatermarkInMs(), self._last_tick(key)
        if last > watermark:
            upcoming = min((watermark // self.refresh_ms + 1) * self.refresh_ms, last)
            added = None
            for frame in rows:
                frame = frame.assign(tick_ms=frame["tick_ms"].clip(lower=upcoming))
                added = self._by_tick([frame] if added is None else [added, frame])
            self.open.appendList(self._rows(added))
            self.handle.registerTimer(int(added["tick_ms"].min()))
            self.handle.registerTimer(last)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        stored = [tuple(r) for r in self.open.get()]
        if stored:
            ticks = self._by_tick([pd.DataFrame(stored, columns=["tick_ms", *self.measures])])
            due, ahead = ticks[ticks["tick_ms"] <= watermark], ticks[ticks["tick_ms"] > watermark]
            if len(due):
                total = self.total.get() or (0,) * len(self.measures)
                running = due[self.measures].cumsum() + list(total)
                self.total.update(self._rows(running.tail(1))[0])
                if len(ahead):
                    self.open.put(self._rows(ahead))
                else:
                    self.open.clear()
                names = {c: v for c, v in zip(self.columns, key)}
                yield running.assign(**names, tick_ms=due["tick_ms"])[[*self.columns, "tick_ms", *self.measures]]
            if len(ahead):
                self.handle.registerTimer(int(ahead["tick_ms"].min()))
        if self._last_tick(key) <= watermark:
            self.total.clear()

    def close(self) -> None:
        pass


def combine_ticks(columns: list[str], measures: list[str]):
    """Per task: sum the measures of rows with the same key, day and tick before they are shuffled."""

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = [*columns, "tick_ms"]
        for frame in frames:
            yield frame.groupby(by, dropna=False, as_index=False)[measures].sum()[[*by, *measures]]

    return combine
