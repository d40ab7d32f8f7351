"""Keyed stateful processors of the stream: one record or one outcome per key.

A key's state is a few values: the record at hand while it waits, then only a mark that the key is
done.  Event-time timers end both, so the state holds the keys of the last ``wait`` + ``keep`` and
nothing else, however long the stream runs.  State and timers live in the checkpoint, so a restarted
stream goes on where it was.  Needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# executors need no copy of this package: the processors travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TRIES = 3
FINAL = ("Downloaded", "Skipped")
DELAY = "10 minutes"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed processors need; set it before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Waiting(StatefulProcessor):
    """A record per key that waits for a timer, then a mark for some time.

    A key has one value: the record, its only timer, and whether the key is done.  Every call of the
    state is a message to the JVM, so a key's state is read once and written once."""

    def __init__(self, record: str, out: list[str], wait_ms: int, keep_ms: int):
        self.record, self.out, self.wait_ms, self.keep_ms = record, Row(*out), wait_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"{self.record}, __timer long, __done boolean")

    def close(self) -> None:
        pass

    def hold(self, record: tuple, old_ms: int | None, at_ms: int, done: bool = False) -> None:
        """The key's record and its only timer, in place of the one at ``old_ms``."""
        if old_ms != at_ms:
            if old_ms is not None:
                self.handle.deleteTimer(old_ms)
            self.handle.registerTimer(at_ms)
        self.state.update((*record, at_ms, done))

    def finish(self, at_ms: int, held, old_ms: int | None) -> None:
        """From now on the key's records are ignored, for the time that the mark is kept."""
        self.hold((None,) * len(held), old_ms, at_ms + self.keep_ms, True)

    def on_timeout(self, key, held) -> Row:
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.state.get()
        if state is None:
            return
        *held, timer, done = state
        if done:
            self.state.clear()
        else:
            self.finish(expiredTimerInfo.getExpiryTimeInMs(), held, None)  # the expired timer goes by itself
            yield self.on_timeout(key, held)


class FirstRecord(_Waiting):
    """STR-2: the least record of a key by its leading ``n_order`` values, ``wait`` after it was first seen."""

    def __init__(self, key: str, record: str, columns: list[str], n_order: int, wait_ms: int, keep_ms: int):
        super().__init__(record, [key, *columns], wait_ms, keep_ms)
        self.columns, self.n_order = columns, n_order

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.state.get()
        if state is not None and state[-1]:
            return iter(())
        seen = [(r["__ms"], tuple(r[c] for c in self.columns)) for r in rows]
        held = [] if state is None else [tuple(state)[:-2]]
        order = lambda t: tuple((x is not None, x) for x in t[: self.n_order])  # noqa: E731  nulls first, as Spark sorts
        best = min([x for _, x in seen] + held, key=order)
        if state is None:
            self.hold(best, None, min(ms for ms, _ in seen) + self.wait_ms)
        elif best is not held[0]:
            self.hold(best, state[-2], state[-2])
        return iter(())

    def on_timeout(self, key, held) -> Row:
        return self.out(*key, *held)


class Outcome(_Waiting):
    """WIN-6: a key's first final status, else its last failure after ``MAX_TRIES`` tries or a timeout."""

    def __init__(self, key: str, wait_ms: int, keep_ms: int, max_tries: int = MAX_TRIES, final: tuple[str, ...] = FINAL):
        super().__init__("attempt int, status string", [key, "attempt", "status", "why"], wait_ms, keep_ms)
        self.max_tries, self.final = max_tries, final

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        tries = sorted((r["attempt"], r["status"], r["__ms"]) for r in rows if r["attempt"] <= self.max_tries)
        state = self.state.get() if tries else None
        if not tries or state is not None and state[-1]:
            return
        held, timer = (None, None) if state is None else (tuple(state)[:-2], state[-2])
        ended = next((t for t in tries if t[1] in self.final), None)
        last = max(t[2] for t in tries)
        if ended:
            self.finish(last, ended[:2], timer)
            yield self.out(*key, ended[0], ended[1], "final")
        elif tries[-1][0] == self.max_tries:
            self.finish(last, tries[-1][:2], timer)
            yield self.out(*key, tries[-1][0], tries[-1][1], "tries")
        else:
            self.hold(tries[-1][:2] if held is None or tries[-1][0] > held[0] else held, timer, last + self.wait_ms)

    def on_timeout(self, key, held) -> Row:
        return self.out(*key, held[0], held[1], "timeout")


def _ms(interval: str) -> int:
    """'2 hours' -> milliseconds."""
    number, unit = interval.split()
    return int(number) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def _timed(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    return stream.withWatermark(event_time, delay).withColumn("__ms", F.unix_millis(event_time))


def first_records(stream: DataFrame, key: str, order: list[str], event_time: str = "ts", wait: str = "1 hour", keep: str = "1 day", delay: str = DELAY) -> DataFrame:
    """STR-2, keyed and bounded: of each key the least record by ``order`` among those that arrive
    within ``wait`` of its first; copies within ``keep`` after that are dropped.  Columns: the key,
    ``order``, then the others; the event time is a column like them."""
    rest = [c for c in stream.columns if c not in (key, *order)]
    columns = [*order, *rest]
    kinds = dict(stream.dtypes)
    record = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    processor = FirstRecord(key, record, columns, len(order), _ms(wait), _ms(keep))
    keyed = _timed(stream, event_time, delay).groupBy(key)
    return keyed.transformWithState(processor, f"`{key}` {kinds[key]}, {record}", "Append", "EventTime")


def stream_outcomes(log: DataFrame, key: str = "k", event_time: str = "ts", wait: str = "1 hour", keep: str = "1 day", delay: str = DELAY) -> DataFrame:
    """WIN-6 as a stream: (key, attempt, status, why) once per key; ``why`` is ``final``, ``tries`` or
    ``timeout`` (nothing new for ``wait``)."""
    processor = Outcome(key, _ms(wait), _ms(keep))
    schema = f"`{key}` {dict(log.dtypes)[key]}, attempt int, status string, why string"
    return _timed(log.select(key, F.col("attempt").cast("int").alias("attempt"), "status", event_time), event_time, delay).groupBy(key).transformWithState(
        processor, schema, "Append", "EventTime"
    )
