"""Streams with keyed state, timers and time-to-live (R1 bounded, R9 retry, R6 late rows).

The state lives in Spark's state store (RocksDB, see ``session.state_session``), one row per key, and is recovered from the
checkpoint when an executor or the whole query is lost. Both processors hold a constant amount per key.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from reviewlake.session import ship_package
from reviewlake.streaming.streams import parse_error

#: Tries of a message before it is set aside, and seconds to wait for the next one.
MAX_TRIES, WAIT_SECONDS = 5, 3
STORED, AGAIN, SET_ASIDE = "stored", "again", "set aside"


class _Retry(StatefulProcessor):
    """Counts the failed tries of a key. The timer stands for a try that never came."""

    def __init__(self, max_tries: int, wait_ms: int, key: str):
        self.max_tries, self.wait_ms, self.key = max_tries, wait_ms, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getValueState("failed", "tries int, seq long, value string")

    def _rows(self, key, out: list[tuple]) -> Iterator[Row]:
        row = Row(self.key, "seq", "value", "state", "tries")
        return (row(key[0], *values) for values in out)

    def _failure(self, tries: int, seq: int, value: str | None, out: list[tuple]) -> int:
        """One more failed try; the number that are open after it."""
        out.append((seq, value, SET_ASIDE if tries + 1 >= self.max_tries else AGAIN, tries + 1))
        return 0 if tries + 1 >= self.max_tries else tries + 1

    def _settle(self, known: bool, tries: int, seq: int, value: str | None, now: int) -> None:
        """A key has a timer when it has state, so a key without (``known``) has none to look for."""
        if known:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if tries:
            self.failed.update((tries, seq, value))
            self.handle.registerTimer(now + self.wait_ms)
        elif known:
            self.failed.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.failed.get()
        tries, seq, value = state if state is not None else (0, None, None)
        out: list[tuple] = []
        for row in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"] or 0)):          # a key's messages of one micro-batch
            seq, value = row["seq"], row["value"]
            if row["good"]:
                out.append((seq, value, STORED, tries + 1))
                tries = 0
            else:
                tries = self._failure(tries, seq, value, out)
        self._settle(state is not None, tries, seq, value, timerValues.getCurrentProcessingTimeInMs())
        return self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.failed.get()
        out: list[tuple] = []
        if state is not None:
            tries, seq, value = state
            self._settle(True, self._failure(tries, seq, value, out), seq, value, timerValues.getCurrentProcessingTimeInMs())
        return self._rows(key, out)

    def close(self) -> None:
        pass


def retry(messages: DataFrame, schema: T.StructType | str, key: str = "id", max_tries: int = MAX_TRIES,
          wait_seconds: float = WAIT_SECONDS) -> DataFrame:
    """Messages (key, seq, value) -> (key, seq, value, state, tries).

    A message that parses by ``schema`` is ``stored``, with the number of tries it took. One that doesn't is wanted
    ``again``; after ``max_tries`` failures in a row the key's message is ``set aside`` and counting starts anew. When no
    message comes within ``wait_seconds`` of processing time, that counts as one more failure. ``seq``
    (the offset) orders the messages of a key. A null key is a key of its own.
    """
    ship_package(messages.sparkSession)
    rows = messages.select(F.col(key).cast("long").alias(key), F.col("seq").cast("long").alias("seq"),
                           F.col("value").cast("string").alias("value"))
    rows = rows.withColumn("good", F.col("value").isNotNull() & parse_error("value", schema).isNull())
    return rows.groupBy(key).transformWithState(
        _Retry(max_tries, int(wait_seconds * 1000), key), f"{key} long, seq long, value string, state string, tries int",
        "Append", "ProcessingTime")


class _Feed(StatefulProcessor):
    """Lets a key through when it has no state. Every arrival starts the time-to-live of its state anew."""

    def __init__(self, keys: Sequence[str], ttl_ms: int):
        self.keys, self.ttl_ms = list(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getValueState("sent", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for _ in rows:
            pass
        known = self.sent.exists()
        self.sent.update((True,))
        return iter(()) if known else iter((Row(*self.keys)(*key),))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.sent.update((True,))

    def close(self) -> None:
        pass


def bounded_category_feed(messages: DataFrame, ttl_seconds: float, history: DataFrame | None = None,
                          keys: Sequence[str] = ("id", "name")) -> DataFrame:
    """Each (id, name) once, with state only for keys that arrived within ``ttl_seconds``.

    A poll that repeats its whole list keeps the state of what is listed alive; what is no longer listed is
    forgotten, so the state is as large as the list and not as the history. ``history`` (rows with the keys) has
    been sent before: the first batch of a new checkpoint starts with it as state. A key that comes back after its
    time-to-live is sent once more, which keyed tables take in.
    """
    ship_package(messages.sparkSession)
    rows = messages.select(*keys)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    start = history.select(*keys).distinct().groupBy(*keys) if history is not None else None
    return rows.groupBy(*keys).transformWithState(
        _Feed(keys, int(ttl_seconds * 1000)), schema, "Append", "ProcessingTime", start)


def wait_until_idle(q: StreamingQuery) -> None:
    """Return when the running query has met no new input, in a batch that began after this call; raise its error."""
    seen = -1 if q.lastProgress is None else q.lastProgress["batchId"]
    while q.isActive:
        done = q.lastProgress
        if done is not None and done["batchId"] > seen + 1 and done["numInputRows"] == 0:
            return
        time.sleep(0.1)
    if q.exception() is not None:
        raise q.exception()


def run_until_idle(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a query that has timers or a time-to-live until it meets no new input, and stop it. (Such a query always has
    a next batch, so ``availableNow`` would not end.) The next run goes on from the checkpoint."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(processingTime="0 seconds").start())
    try:
        wait_until_idle(q)
    finally:
        q.stop()


def enrich_late(ids: DataFrame, rows: DataFrame, key: str, id_time: str, row_time: str, before: str, after: str,
                delay: str) -> DataFrame:
    """R6 over two streams: every id with the rows of its key whose time lies from ``before`` its own time to
    ``after`` it, whichever comes first; an id without such a row comes out alone once the watermark has passed.

    ``rows`` has the key under the same name and no other column of ``ids``. Both streams may be out of order by
    ``delay``. The state holds only what the watermark and the two intervals leave open.
    """
    left = ids.withWatermark(id_time, delay)
    right = rows.withColumnRenamed(key, "_key").withWatermark(row_time, delay)
    near = ((F.col(key) == F.col("_key")) & (F.col(row_time) >= F.col(id_time) - F.expr(f"INTERVAL {before}"))
            & (F.col(row_time) <= F.col(id_time) + F.expr(f"INTERVAL {after}")))
    return left.join(right, near, "leftOuter").drop("_key")
