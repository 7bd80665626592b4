"""The exclusion period as keyed state with event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def judged(times: np.ndarray, due: int | None, period: int) -> tuple[list[int], int | None]:
    """Which of the times in order are alerts, and when the next one is due: each alert is the first at or after that."""
    alerts, k = [], 0 if due is None else int(np.searchsorted(times, due))
    while k < len(times):
        alerts.append(k)
        due = int(times[k]) + period
        k = int(np.searchsorted(times, due))
    return alerts, due


class FirstAlerts(StatefulProcessor):
    """State of a bucket of pixels, one value: the hotspots that wait for the watermark (pixel, microseconds, event), and
    when the next alerts of its pixels are due (pixel, microseconds). A bucket calls for its state once, however many
    pixels it has."""

    def __init__(self, period: int):
        self.period = period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "waiting binary, due binary")

    def _load(self) -> tuple[np.ndarray, np.ndarray]:
        held = self.state.get()
        waiting, due = (b"", b"") if held is None else held
        return np.frombuffer(waiting, np.int64).reshape(-1, 3), np.frombuffer(due, np.int64).reshape(-1, 2)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [np.stack([pdf["pixel_id"].to_numpy(np.int64), pdf["ts"].to_numpy("datetime64[us]").astype(np.int64), pdf["event_id"].to_numpy(np.int64)], axis=1) for pdf in rows]
        waiting, due = self._load()
        waiting = np.concatenate([waiting, *new])
        if len(waiting):
            self.state.update((waiting.tobytes(), due.tobytes()))
            self.handle.registerTimer(-(-int(waiting[:, 1].min()) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, due = self._load()
        ready, later = waiting[waiting[:, 1] <= passed], waiting[waiting[:, 1] > passed]
        ready = ready[np.lexsort((ready[:, 2], ready[:, 1], ready[:, 0]))]
        dues, found = dict(due.tolist()), []
        for part in np.split(ready, np.flatnonzero(np.diff(ready[:, 0])) + 1) if len(ready) else []:
            pixel = int(part[0, 0])
            alerts, dues[pixel] = judged(part[:, 1], dues.get(pixel), self.period)
            found.append(part[alerts])
        # What is due no later than the watermark needs no state: whatever comes is later.
        due = np.array([(p, t) for p, t in dues.items() if t > passed], np.int64).reshape(-1, 2)
        if len(later) or len(due):
            self.state.update((later.tobytes(), due.tobytes()))
            self.handle.registerTimer(-(-int(min([*later[:, 1], *due[:, 1]])) // 1000))
        else:
            self.state.clear()
        out = np.concatenate(found) if found else ready[:0]
        if len(out):
            yield pd.DataFrame({"pixel_id": out[:, 0], "event_id": out[:, 2], "ts": pd.to_datetime(out[:, 1], unit="us")})

    def close(self) -> None:
        pass
