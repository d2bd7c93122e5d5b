"""Retries that wait: a message that fails stays in keyed state until its back-off is over."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MAX_RETRIES = 3
PROCESSED, RETRY, DLQ = "processed", "retry", "dlq"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ATTEMPTS = "key string, attempt int, at_ms long, outcome string, body string"
BLOCK = 200  # waiting messages that are read and written together
MOST_HELD = 20_000  # messages of one key in memory before they are written


class BackOff(StatefulProcessor):
    """Tries a message when it comes and again ``2 ** n`` seconds after its n-th failure.

    What waits are blocks of messages under the message's key, each with a timer for the first that is due in it.
    Whatever of a block is due by then is tried again, the rest waits on; after ``max_retries`` failures a message is
    a dead letter. The messages that one key leaves waiting in a batch are written as few blocks of up to ``BLOCK``,
    so that calls of the state store grow with blocks, not with messages. In processing time a block is also
    given a time to live, so that nothing stays for ever if a timer were lost.
    """

    def __init__(self, works: Callable[[str, int], bool], max_retries: int, live_ms: int | None):
        self.works, self.max_retries, self.live_ms = works, max_retries, live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # First due time in milliseconds -> JSON list of [body, attempts so far, due time], the first due first.
        key = T.StructType([T.StructField("due", T.LongType())])
        value = T.StructType([T.StructField("waiting", T.StringType())])
        self.waiting = handle.getMapState("waiting", key, value, self.live_ms) if self.live_ms else handle.getMapState("waiting", key, value)

    def _try(self, key: str, body: str | None, attempt: int, now: int, passed: int, held: list) -> Iterator[Row]:
        """Attempts from ``now`` on; those whose time has ``passed`` follow at once, the next one is ``held``."""
        while True:
            works = self.works(body, attempt)
            outcome = PROCESSED if works else DLQ if attempt >= self.max_retries else RETRY
            yield Row(key=key, attempt=attempt, at_ms=now, outcome=outcome, body=body)
            if outcome != RETRY:
                return
            now, attempt = now + 1000 * 2**attempt, attempt + 1
            if now > passed:
                break
        held.append([body, attempt, now])

    def _hold(self, held: list) -> None:
        """Writes blocks of what waits, each under its first due time, and their timers."""
        held.sort(key=lambda m: m[2])
        for at in range(0, len(held), BLOCK):
            block = held[at : at + BLOCK]
            due = block[0][2]
            known = self.waiting.getValue((due,))
            self.waiting.updateValue((due,), (json.dumps([*json.loads(known[0]), *block] if known else block),))
            self.handle.registerTimer(due)

    def _passed(self, times) -> int:
        return times.getCurrentProcessingTimeInMs() if self.live_ms else times.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        held, passed = [], self._passed(timerValues)
        for row in rows:
            if row["at_ms"] is not None:
                yield from self._try(key[0], row["body"], 0, row["at_ms"], passed, held)
            if len(held) >= MOST_HELD:
                self._hold(held)
                held.clear()
        self._hold(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        due = expiredTimerInfo.getExpiryTimeInMs()
        known = self.waiting.getValue((due,))
        if known is None:
            return
        held, passed = [], self._passed(timerValues)
        self.waiting.removeKey((due,))
        for body, attempt, *later in json.loads(known[0]):
            at = later[0] if later else due  # a block of an older checkpoint holds messages of one time
            if at > passed:
                held.append([body, attempt, at])
            else:
                yield from self._try(key[0], body, attempt, at, passed, held)
        self._hold(held)

    def close(self) -> None:
        pass


def retried(
    messages: DataFrame, works: Callable[[str, int], bool], max_retries: int = MAX_RETRIES, delay: str = "0 seconds", live_ms: int | None = None
) -> DataFrame:
    """Every attempt at the messages (``key`` string, ``ts`` timestamp, ``body`` string) with its time and outcome.

    ``works(body, attempt)`` says whether an attempt succeeds; attempts count from 0. Time is the stream's own:
    a message is due when the watermark has passed its time, so a slow stream does not lose the order and a replay
    gives the same rows. With ``live_ms`` it is the clock's. The state is bounded by what waits.
    """
    timed = messages.withWatermark("ts", delay) if live_ms is None else messages
    rows = timed.selectExpr("key", *(["ts"] if live_ms is None else []), "unix_millis(ts) AS at_ms", "body")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    processor = BackOff(works, max_retries, live_ms)
    return rows.groupBy("key").transformWithState(processor, ATTEMPTS, "append", "eventTime" if live_ms is None else "processingTime")


@contextmanager
def keyed_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings under which a stream with this state is started: RocksDB, and as many stores as wanted."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
