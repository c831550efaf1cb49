"""Keyed state and event-time timers.

Each processor sees the rows of one key in one micro-batch, in no particular order; those whose result
depends on order sort them by event time first.  How many rows that can be is set by the source
(`maxFilesPerTrigger`), not by the size of the key.  Event times are the long column `us` (microseconds).
State lives in the RocksDB store; timers, in milliseconds, round up so that they never fire early.

Where keys have a handful of rows each, a call per key costs far more than its rows.  `GroupProcessor`s see groups of
keys, dealt out by hash, and work on whole columns; the open rows of a group are one state value with one timer.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_US = 86_400_000_000
DAY_MS = DAY_US // 1000

# `us` of a row without event time in a `GroupProcessor`, after all others; no column of times has nulls, which pandas
# would turn into floats.
NO_TIME = 2**63 - 1
# Groups of keys of a stream; as state belongs to a group, a checkpoint is bound to the number it was started with.
GROUPS = 1024


def run_processor(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    """Apply a processor per key to a watermarked stream; `ts` is its event time."""
    timed = df.withColumn("us", F.unix_micros("ts"))
    return timed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")


def run_clock_processor(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    """The same with timers on processing time, which need no watermark."""
    timed = df.withColumn("us", F.unix_micros("ts"))
    return timed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "ProcessingTime")


def run_group_processor(
    df: DataFrame, keys: list[str], processor: GroupProcessor, schema: str, groups: int = GROUPS
) -> DataFrame:
    """Apply a processor to groups of keys of a watermarked stream; `ts` is its event time.  Rows without the first key,
    such as the end marker, are group -1, which is skipped."""
    first = F.col(keys[0])
    group = F.when(first.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(groups)))
    timed = df.withColumns({
        "_group": group.cast("long"), "us": F.coalesce(F.unix_micros("ts"), F.lit(NO_TIME)),
        keys[0]: F.coalesce(first, F.lit("0").cast(df.schema[keys[0]].dataType)),
    })
    return timed.groupBy("_group").transformWithStateInPandas(processor, schema, "Append", "EventTime")


def in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(["us", "event_id"], ignore_index=True)


def is_marker(key: tuple) -> bool:
    return key[0] is None or pd.isna(key[0])


def to_ms(us):
    return -(-us // 1000)


class Processor(StatefulProcessor):
    """Skips the end marker and leaves nothing to do for processors without timers."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not is_marker(key):
            yield from self.rows(key, rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.timer(key, expiredTimerInfo.getExpiryTimeInMs())

    def rows(self, key, rows) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def timer(self, key, at_ms: int) -> Iterator[pd.DataFrame]:
        return iter(())

    def close(self) -> None:
        pass


class RollingStats(Processor):
    """Running sum, max and min after every row, and the first row's event time."""

    schema = "event_id long, user_id long, rolling_sum double, rolling_max double, rolling_min double, first_us long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.so_far = handle.getValueState("so_far", "total double, high double, low double, first_us long")

    def rows(self, key, rows):
        df = in_order(rows)
        total, high, low, first = self.so_far.get() or (0.0, float("-inf"), float("inf"), int(df.us[0]))
        sums = df.value.cumsum() + total
        highs = df.value.cummax().clip(lower=high)
        lows = df.value.cummin().clip(upper=low)
        self.so_far.update((float(sums.iloc[-1]), float(highs.iloc[-1]), float(lows.iloc[-1]), first))
        yield pd.DataFrame(
            {
                "event_id": df.event_id, "user_id": key[0], "rolling_sum": sums, "rolling_max": highs,
                "rolling_min": lows, "first_us": first,
            }
        )


class LastValue(Processor):
    """The previous value of the key."""

    schema = "event_id long, user_id long, value double, last_value double"

    def init(self, handle):
        self.last = handle.getValueState("last", "value double")

    def rows(self, key, rows):
        df = in_order(rows)
        before = df.value.shift(1)
        if self.last.exists():
            before.iloc[0] = self.last.get()[0]
        self.last.update((float(df.value.iloc[-1]),))
        yield pd.DataFrame({"event_id": df.event_id, "user_id": key[0], "value": df.value, "last_value": before})


class CountWindow(Processor):
    """Sum of every `size` consecutive values."""

    schema = "user_id long, window_no long, total double"

    def __init__(self, size: int):
        self.size = size

    def init(self, handle):
        self.held = handle.getListState("held", "value double")
        self.fired = handle.getValueState("fired", "n long")

    def rows(self, key, rows):
        held = [v for (v,) in self.held.get()] if self.held.exists() else []
        values = held + in_order(rows).value.tolist()
        done = self.fired.get()[0] if self.fired.exists() else 0
        whole = len(values) // self.size
        rest = values[whole * self.size:]
        if rest:
            self.held.put([(float(v),) for v in rest])
        else:
            self.held.clear()
        self.fired.update((done + whole,))
        if whole:
            sums = [sum(values[i * self.size:(i + 1) * self.size]) for i in range(whole)]
            yield pd.DataFrame({"user_id": key[0], "window_no": range(done, done + whole), "total": sums})


class StateKinds(Processor):
    """One value, one list and one map per key: rows seen, the newest three ids, rows per event type."""

    schema = "user_id long, n long, newest string, types string"

    def init(self, handle):
        self.count = handle.getValueState("count", "n long")
        self.newest = handle.getListState("newest", "event_id long")
        self.types = handle.getMapState("types", "event_type string", "n long")

    def rows(self, key, rows):
        df = in_order(rows)
        n = (self.count.get()[0] if self.count.exists() else 0) + len(df)
        self.count.update((n,))
        held = [i for (i,) in self.newest.get()] if self.newest.exists() else []
        newest = deque(held + df.event_id.tolist(), maxlen=3)
        self.newest.put([(int(i),) for i in newest])
        for kind, more in df.event_type.value_counts().items():
            old = self.types.getValue((kind,))[0] if self.types.containsKey((kind,)) else 0
            self.types.updateValue((kind,), (old + int(more),))
        counts = sorted((k[0], v[0]) for k, v in self.types.iterator())
        yield pd.DataFrame(
            {
                "user_id": [key[0]], "n": [n], "newest": [",".join(map(str, newest))],
                "types": [",".join(f"{k}={v}" for k, v in counts)],
            }
        )


class Inactivity(Processor):
    """An alert when a key has no row for `quiet_us` after one: each row moves the key's timer."""

    schema = "user_id long, last_us long, alert_us long"

    def __init__(self, quiet_us: int):
        self.quiet_us = quiet_us

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    def _alerts(self, key, last):
        return pd.DataFrame({"user_id": key[0], "last_us": last, "alert_us": [v + self.quiet_us for v in last]})

    def rows(self, key, rows):
        times = in_order(rows).us.tolist()
        if self.last.exists():
            old = self.last.get()[0]
            self.handle.deleteTimer(to_ms(old + self.quiet_us))
            times = [old, *times]
        passed = [a for a, b in zip(times[:-1], times[1:]) if b > a + self.quiet_us]
        newest = int(max(times))
        self.last.update((newest,))
        self.handle.registerTimer(to_ms(newest + self.quiet_us))
        if passed:
            yield self._alerts(key, passed)

    def timer(self, key, at_ms):
        last = self.last.get()[0]
        self.last.clear()
        yield self._alerts(key, [last])


class Unanswered(StatefulProcessor):
    """An alert for a row that meets `asks` and is the last of its key, unless the key has another row within `wait_ms`
    of processing time: such a row sets a timer, every row of a later batch deletes it.

    A batch's rows come before the timers that are due in it, so a timer fires in the first batch that starts after it
    is due and has no row for its key.
    """

    schema = "user_id long, event_id long"

    def __init__(self, column: str, asks: str, wait_ms: int):
        self.column, self.asks, self.wait_ms = column, asks, wait_ms

    def init(self, handle):
        self.handle = handle
        self.open = handle.getValueState("open", "event_id long, due_ms long")

    def handleInputRows(self, key, rows, timerValues):
        df = in_order(rows)
        if is_marker(key):
            return
        if self.open.exists():
            self.handle.deleteTimer(self.open.get()[1])
            self.open.clear()
        if df[self.column].iloc[-1] == self.asks:
            due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(due)
            self.open.update((int(df.event_id.iloc[-1]), due))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        event_id = self.open.get()[0]
        self.open.clear()
        yield pd.DataFrame({"user_id": [key[0]], "event_id": [event_id]})

    def close(self):
        pass


class RiseTimer(Processor):
    """Alert when a value keeps rising for `hold_us`; see `operators.alerts.rise_alerts` for the rules."""

    schema = "user_id long, start_us long, alert_us long"

    def __init__(self, hold_us: int, floor: float = -1.0):
        self.hold_us = hold_us
        self.floor = floor

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "value double")
        self.start = handle.getValueState("start", "us long")

    def _alerts(self, key, starts):
        return pd.DataFrame({"user_id": key[0], "start_us": starts, "alert_us": [s + self.hold_us for s in starts]})

    def rows(self, key, rows):
        last = self.last.get()[0] if self.last.exists() else self.floor
        pending = self.start.get()[0] if self.start.exists() else None
        if pending is not None:
            self.handle.deleteTimer(to_ms(pending + self.hold_us))
        fired = []
        for row in in_order(rows).itertuples():
            if pending is not None and row.us > pending + self.hold_us:
                fired.append(pending)
                pending = None
            if row.value <= last:
                pending = None
            elif pending is None:
                pending = int(row.us)
            last = float(row.value)
        self.last.update((last,))
        if pending is None:
            self.start.clear()
        else:
            self.start.update((pending,))
            self.handle.registerTimer(to_ms(pending + self.hold_us))
        if fired:
            yield self._alerts(key, fired)

    def timer(self, key, at_ms):
        start = self.start.get()[0]
        self.start.clear()
        yield self._alerts(key, [start])


class GroupProcessor(StatefulProcessor):
    """What is open of a group of keys is one table, `held`, of which each row has a deadline; the group's only timer is
    the first of them.

    Subclasses say what rows and deadlines do: `rows` takes what is held (None if nothing) and the new rows, `expired`
    takes the rows that are due.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "held binary, next_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            return
        held, timer = self._read()
        out, held = self.rows(held, pd.concat(list(rows), ignore_index=True))
        self._write(held, timer)
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, timer = self._read()
        passed = max(timer, timerValues.getCurrentWatermarkInMs() - 1)
        due = self.due_ms(held) <= passed
        out = self.expired(held[due])
        self._write(held[~due])
        if len(out):
            yield out

    def _read(self) -> tuple[pd.DataFrame | None, int | None]:
        value = self.open.get()
        if value is None:
            return None, None
        return pa.ipc.open_stream(value[0]).read_pandas(), value[1]

    def _write(self, held: pd.DataFrame, timer: int | None = None) -> None:
        """Keep `held` and move the timer, which stands at `timer`; one that fires goes by itself."""
        first = int(self.due_ms(held).min()) if len(held) else None
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if first is None:
            self.open.clear()
            return
        rows = pa.Table.from_pandas(held, preserve_index=False)
        with pa.BufferOutputStream() as buffer:
            with pa.ipc.new_stream(buffer, rows.schema) as stream:
                stream.write_table(rows)
            self.open.update((buffer.getvalue().to_pybytes(), first))

    def rows(self, held: pd.DataFrame | None, fresh: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Results, and what is held from now on."""
        raise NotImplementedError

    def due_ms(self, held: pd.DataFrame) -> pd.Series:
        raise NotImplementedError

    def expired(self, due: pd.DataFrame) -> pd.DataFrame:
        """Results for rows that are held no more."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def known_us(us: pd.Series) -> pd.Series:
    """Null where there is no time."""
    return us.astype("Int64").mask(us == NO_TIME)


class DailyLimit(GroupProcessor):
    """Rows up to the daily limit pass, the next one raises the day's only alert, the rest are dropped.
    Held is one count per key and day; the following midnight forgets the day."""

    schema = "event_id long, user_id long, event_type string, day_us long, nth long, output string"
    day = ["user_id", "event_type", "day"]

    def __init__(self, limit: int):
        self.limit = limit

    def rows(self, held, fresh):
        df = fresh.sort_values(["us", "event_id"], ignore_index=True)
        df["day"] = df.us // DAY_US
        df["nth"] = df.groupby(self.day, dropna=False, sort=False).cumcount() + 1
        counts = df.groupby(self.day, dropna=False, sort=False, as_index=False).agg(n=("nth", "max"))
        if held is not None:
            before = df[self.day].merge(held, on=self.day, how="left").n
            df["nth"] += before.fillna(0).astype("int64").to_numpy()
            counts = pd.concat([held, counts]).groupby(self.day, dropna=False, sort=False, as_index=False).agg(n=("n", "sum"))
        kept = df[df.nth <= self.limit + 1]
        out = pd.DataFrame(
            {
                "event_id": kept.event_id, "user_id": kept.user_id, "event_type": kept.event_type,
                "day_us": known_us((kept.day * DAY_US).where(kept.us != NO_TIME, NO_TIME)), "nth": kept.nth,
                "output": np.where(kept.nth <= self.limit, "pass", "alert"),
            }
        )
        return out, counts

    def due_ms(self, held):
        return (held.day + 1) * DAY_MS

    def expired(self, due):
        return pd.DataFrame()


class OrderOutcome(GroupProcessor):
    """Outcome of each order once both events are in, or when `hold_us` has passed since the first one."""

    schema = "order_id long, create_us long, pay_us long, outcome string"

    def __init__(self, limit_us: int, hold_us: int):
        self.limit_us = limit_us
        self.hold_us = hold_us

    def _results(self, df: pd.DataFrame) -> pd.DataFrame:
        late = df.pay_us.to_numpy() - df.create_us.to_numpy() > self.limit_us
        outcome = np.where(late, "paid_late", "paid")
        outcome = np.where(df.pay_us == NO_TIME, "timeout", outcome)
        outcome = np.where(df.create_us == NO_TIME, "create_missing", outcome)
        return pd.DataFrame(
            {"order_id": df.order_id, "create_us": known_us(df.create_us), "pay_us": known_us(df.pay_us), "outcome": outcome}
        )

    def rows(self, held, fresh):
        create = fresh.event_type == "create"
        both = pd.DataFrame(
            {
                "order_id": fresh.order_id, "create_us": fresh.us.where(create, NO_TIME),
                "pay_us": fresh.us.where(~create, NO_TIME), "due_ms": NO_TIME,
            }
        )
        if held is not None:
            both = pd.concat([held, both])
        orders = both.groupby("order_id", sort=False, as_index=False).min()
        first = orders[["create_us", "pay_us"]].min(axis=1)
        # The deadline stays as the first batch of the order set it.
        due = orders.due_ms.where(orders.due_ms != NO_TIME, to_ms(first + self.hold_us))
        orders = orders.assign(due_ms=due)[first != NO_TIME]
        whole = (orders.create_us != NO_TIME) & (orders.pay_us != NO_TIME)
        return self._results(orders[whole]), orders[~whole]

    def due_ms(self, held):
        return held.due_ms

    def expired(self, due):
        return self._results(due)


class Reconcile(GroupProcessor):
    """Pair rows of two feeds per key in order, each once; what is left `hold_us` after the key's newest row
    comes out alone.  Only one side of a key can be waiting, since two waiting rows would be a pair."""

    schema = "order_key long, order_us long, ship_us long, side string"

    def __init__(self, hold_us: int):
        self.hold_us = hold_us

    def rows(self, held, fresh):
        both = fresh.sort_values(["us", "is_left"])[["order_key", "is_left", "us"]].astype({"is_left": bool})
        both = both if held is None else pd.concat([held, both])
        both = both.reset_index(drop=True)
        both["place"] = both.groupby(["order_key", "is_left"], sort=False).cumcount()
        sides = both.groupby("order_key", sort=False).is_left
        lefts, all_ = sides.transform("sum"), sides.transform("size")
        matched = both.place < np.minimum(lefts, all_ - lefts)
        paired = both[matched].sort_values(["order_key", "place"])
        left, right = paired[paired.is_left], paired[~paired.is_left]
        out = pd.DataFrame(
            {
                "order_key": left.order_key.to_numpy(), "order_us": known_us(left.us).array,
                "ship_us": known_us(right.us).array, "side": "matched",
            }
        )
        return out, both[~matched].drop(columns="place")

    def due_ms(self, held):
        # Rows without a time wait for nothing.
        newest = held.us.where(held.us != NO_TIME, 0).groupby(held.order_key, sort=False).transform("max")
        return to_ms(newest + self.hold_us)

    def expired(self, due):
        us, left = known_us(due.us), due.is_left
        side = np.where(left, "left_only", "right_only")
        return pd.DataFrame({"order_key": due.order_key, "order_us": us.where(left), "ship_us": us.where(~left), "side": side})


class FailAfterFail(Processor):
    """A failure directly followed by another one in less than `within_us`."""

    schema = "user_id long, fail_id long, next_id long"

    def __init__(self, within_us: int):
        self.within_us = within_us

    def init(self, handle):
        self.last = handle.getValueState("last", "bad boolean, us long, event_id long")

    def rows(self, key, rows):
        df = in_order(rows)[["us", "event_id", "event_type"]]
        bad = df.event_type == "error"
        before = pd.DataFrame({"bad": bad.shift(1, fill_value=False), "us": df.us.shift(1), "event_id": df.event_id.shift(1)})
        if self.last.exists():
            before.iloc[0] = self.last.get()
        newest = df.iloc[-1]
        self.last.update((bool(bad.iloc[-1]), int(newest.us), int(newest.event_id)))
        hit = bad & before.bad.astype(bool) & (df.us - before.us < self.within_us)
        if hit.any():
            yield pd.DataFrame(
                {"user_id": key[0], "fail_id": before.event_id[hit].astype("int64"), "next_id": df.event_id[hit]}
            )
