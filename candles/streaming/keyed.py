"""Indicators that continue across micro-batches, with their memory in Spark's state store.

Each series has one small state: its newest closes, its averages and the place of its newest row. A
micro-batch reads and writes the state of series that ticked and no other; checkpoints, restarts and
replays are those of the state store. Series that no longer tick can be forgotten: after `idle` of event
time by a timer, or after `ttl` of wall-clock time by the store itself.

A series' rows of one micro-batch go through one task, in order, since each depends on those before; a
batch is bounded by the options of its source. `streaming.bars.Remembered` cuts even that into slices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candles.operators.indicators import LOSS_FLOOR
from candles.operators.series import TICKS, Series

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KINDS = ("sma", "rsi", "ema")


def keep_state(spark: SparkSession) -> None:
    """Let streams started from here on keep their state in RocksDB, of which a batch writes what changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def trailing(values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the last `n` values; NaN where there are fewer."""
    out = np.full(len(values), np.nan)
    if len(values) >= n:
        out[n - 1:] = np.lib.stride_tricks.sliding_window_view(values, n).sum(axis=1)
    return out


class Memory(StatefulProcessor):
    """State and computation of one series; `wanted` maps column names to (kind, length)."""

    def __init__(self, wanted: dict[str, tuple[str, int]], order: list[T.StructField], value: str, idle_ms: int | None, ttl_ms: int | None):
        self.wanted, self.order, self.value = wanted, [f.name for f in order], value
        self.idle_ms, self.ttl_ms = idle_ms, ttl_ms
        # SMA looks at n - 1 closes before a row, RSI at n.
        self.reach = max([n for kind, n in wanted.values() if kind != "ema"], default=0)
        self.averages = [name for name, (kind, _) in wanted.items() if kind == "ema"]
        self.fields = T.StructType([
            *order, T.StructField("rows", T.LongType()), T.StructField("closes", T.ArrayType(T.DoubleType())),
            T.StructField("averages", T.ArrayType(T.DoubleType()))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", self.fields, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable", ignore_index=True)
        state = self.past.get() if self.past.exists() else None
        late = self._late(frame, state)
        fresh = frame[~late].reset_index(drop=True)
        if late.any():
            yield self._late_rows(frame[late])
        if len(fresh):
            made, state = self._computed(fresh, state)
            self.past.update(state)
            yield made
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            newest = pd.Timestamp(state[0]).tz_localize(None).value // 1_000_000
            self.handle.registerTimer(newest + self.idle_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.past.clear()
        return iter([])

    def _late(self, frame: pd.DataFrame, state: tuple | None) -> np.ndarray:
        """Rows at or before the newest one known."""
        if state is None:
            return np.zeros(len(frame), bool)
        late = np.ones(len(frame), bool)
        for name, last in reversed(list(zip(self.order, state))):
            own = frame[name]
            if isinstance(own.dtype, pd.DatetimeTZDtype) or own.dtype.kind == "M":
                own, last = pd.to_datetime(own, utc=True), pd.to_datetime(last, utc=True)
            late = np.asarray(own < last) | (np.asarray(own == last) & late)
        return late

    def _late_rows(self, frame: pd.DataFrame) -> pd.DataFrame:
        return frame.drop(columns=[self.value]).assign(**{name: np.nan for name in self.wanted}, late=True)

    def _computed(self, fresh: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple]:
        """Indicators of rows in order, and the state after them. A row without a value has no indicators
        and is not remembered."""
        close = fresh[self.value].to_numpy(np.float64, na_value=np.nan)
        known = np.flatnonzero(~np.isnan(close))
        *_, seen, past, averages = state if state is not None else (0, [], [None] * len(self.averages))
        past, averages = np.array(past or [], np.float64), dict(zip(self.averages, averages))
        whole = np.concatenate([past, close[known]])
        changes = np.diff(whole, prepend=whole[:1])
        out = {}
        for name, (kind, n) in self.wanted.items():
            values = np.full(len(fresh), np.nan)
            if kind == "sma":
                made = trailing(whole, n) / n
            elif kind == "rsi":
                gain, loss = (trailing(np.maximum(x, 0), n) / n for x in (changes, -changes))
                made = 100 - 100 / (1 + gain / np.maximum(loss, LOSS_FLOOR))
                # Of a series cut off before, the oldest change is not known; no window reaches it.
            else:
                k, before = 2 / (n + 1), averages[name]
                steps = accumulate(close[known].tolist(), lambda e, x: k * x + (1 - k) * e, **({} if before is None else {"initial": before}))
                made = np.concatenate([past, np.array(list(steps)[0 if before is None else 1:], np.float64)])
                averages[name] = float(made[-1]) if len(known) else before
            values[known] = made[len(past):]
            out[name] = values
        last = fresh.iloc[-1]
        places = [x.to_pydatetime() if isinstance(x, pd.Timestamp) else x.item() if hasattr(x, "item") else x for x in (last[c] for c in self.order)]
        kept = whole[max(len(whole) - self.reach, 0):].tolist() if self.reach else []
        made = fresh.drop(columns=[self.value]).assign(**out, late=False)
        return made, (*places, int(seen) + len(known), kept, [averages[a] for a in self.averages])


def keyed_indicators(
    df: DataFrame, wanted: dict[str, tuple[str, int]], series: Series = TICKS, value: str = "price",
    idle: str | None = None, delay: str = "0 seconds", ttl_ms: int | None = None,
) -> DataFrame:
    """A stream's rows with indicators: series keys and order, a column for each of `wanted` and `late`.

    `wanted` maps a column to ("sma" | "rsi" | "ema", length): the mean and the relative strength of the
    last values (NULL while there are fewer), the recursive average. All share one state. A row at or
    before the newest known of its series comes out with `late` and without indicators, and changes nothing. Rows
    without a value have no indicators and are not counted.

    With `idle` ("90 days") a series is forgotten when the watermark, `delay` behind the newest row,
    has passed its newest row by that; it starts afresh if it comes back. With `ttl_ms` that happens after
    so much wall-clock time. Call `keep_state` before the stream is started.
    """
    unknown = [kind for kind, _ in wanted.values() if kind not in KINDS]
    if unknown or not wanted:
        raise ValueError(f"unknown indicators {unknown}" if unknown else "no indicators")
    if idle and ttl_ms:
        raise ValueError("a state is forgotten by event time or by wall-clock time, not by both")
    rows = df.select(*series.keys, *series.order, F.col(value).cast("double").alias(value))
    idle_ms = _milliseconds(idle) if idle else None
    if idle:
        rows = rows.withWatermark(series.time, delay)
    order = [rows.schema[c] for c in series.order]
    out = T.StructType([
        *(rows.schema[c] for c in (*series.keys, *series.order)),
        *(T.StructField(name, T.DoubleType()) for name in wanted), T.StructField("late", T.BooleanType())])
    memory = Memory(wanted, [T.StructField(f.name, f.dataType) for f in order], value, idle_ms, ttl_ms)
    mode = "EventTime" if idle else "ProcessingTime" if ttl_ms else "None"
    return rows.groupBy(*series.keys).transformWithStateInPandas(memory, out, "Append", mode)


def _milliseconds(text: str) -> int:
    return int(pd.Timedelta(text).value // 1_000_000)
