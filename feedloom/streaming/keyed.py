"""State per key in Spark's own state store: admission of new keys, re-admission, ageing by timers.

Nothing is rewritten as a whole: a key's state is one entry of the store, a
batch touches the keys it holds, and the store commits with the batch, so a
stream that is killed at any point goes on from its last whole batch.  With a
sink that commits by batch (Spark's file sink, or ``batches.BatchSink`` under
``foreachBatch``) each key comes out once.

The store must be RocksDB (``use_store``); the rows travel as Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING, REJECTED = "pending", "rejected"


def use_store(spark: SparkSession) -> None:
    """Let streams that start from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def millis(at: datetime) -> int:
    """Epoch milliseconds of a row's time, in which the worker's own zone plays no part."""
    return round((at if at.tzinfo else at.astimezone()).astimezone(timezone.utc).timestamp() * 1000)


class _Admit(StatefulProcessor):
    """The first row of a key; the key blocks for ``hours``, or for ever."""

    def __init__(self, columns: list[str], order: str, at: str | None, hours: float | None):
        self.columns, self.order, self.at = columns, order, at
        self.block = None if hours is None else int(hours * 3_600_000)

    def init(self, handle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.until.get()[0] if self.until.exists() else None
        if held is not None and self.block is None:
            return
        if self.block is None:
            first = min(rows, key=lambda r: r[self.order])
            self.until.update((0,))
            yield Row(**{c: first[c] for c in self.columns})
            return
        before = held
        for r in sorted(rows, key=lambda r: (r[self.at], r[self.order])):  # the rows of one key in one batch
            now = millis(r[self.at])
            if held is None or now > held:
                held = now + self.block
                yield Row(**{c: r[c] for c in self.columns})
        if held != before:
            if before is not None:
                self.handle.deleteTimer(before + 1)
            self.until.update((held,))
            if held + 1 > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(held + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """No row can come any more that the key would block: its entry goes."""
        if self.until.exists() and self.until.get()[0] < expiredTimerInfo.getExpiryTimeInMs():
            self.until.clear()
        return iter(())


def admit(stream: DataFrame, key: str, order: str = "ordinal", at: str | None = None, hours: float | None = None) -> DataFrame:
    """The rows of a stream whose key is new; of a batch's equal keys the first by ``order``.

    ``hours``: a key blocks rows up to so long after the row that was let in,
    by the event time ``at``, which needs a watermark; without it a key blocks
    for ever.  Rows without a key, or with an empty one, count as seen.
    """
    if hours is not None and at is None:
        raise ValueError("re-admission goes by event time: name its column")
    rows = stream.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    processor = _Admit(rows.columns, order, at, hours)
    return rows.groupBy(key).transformWithState(processor, rows.schema, "append", "none" if hours is None else "eventTime")


class _Age(StatefulProcessor):
    """A queue row's life: pending until a decision, or until its days are over."""

    def __init__(self, key: str, days: float):
        self.key, self.wait = key, int(days * 86_400_000)

    def over(self, created: int) -> datetime:
        return datetime.fromtimestamp((created + self.wait) / 1000, timezone.utc)

    def init(self, handle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", "status string, created long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        status, created = self.row.get() if self.row.exists() else (None, None)
        found = sorted(rows, key=lambda r: (r["decision"] is not None, r["at"], r["seq"]))
        changed = None
        for r in found:
            if r["decision"] is None and status is None:
                status, created = PENDING, millis(r["at"])
                changed = (PENDING, r["at"])
        if status == PENDING:
            decisions = [r for r in found if r["decision"] is not None]
            timely = [r for r in decisions if millis(r["at"]) <= created + self.wait]
            if timely:
                status, changed = timely[-1]["decision"], (timely[-1]["decision"], timely[-1]["at"])
            elif decisions:  # its days were over, though the watermark had not shown it yet
                status, changed = REJECTED, (REJECTED, self.over(created))
        if changed is None:
            return
        self.row.update((status, created))
        if status == PENDING:
            self.handle.registerTimer(max(created + self.wait, timerValues.getCurrentWatermarkInMs()) + 1)
        else:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        yield Row(**{self.key: key[0], "status": status, "at": changed[1]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.row.exists():
            status, created = self.row.get()
            if status == PENDING:
                self.row.update((REJECTED, created))
                yield Row(**{self.key: key[0], "status": REJECTED, "at": self.over(created)})


def age(log: DataFrame, key: str = "key", days: float = 7) -> DataFrame:
    """``key, status, at``: a row each time a queue row changes, from a log of items and decisions.

    ``log``: a stream of ``key, decision, at, seq`` with a watermark on ``at``;
    ``decision`` is null for an item, which is pending from its time on.  The
    last decision of the batch that first has one counts; decisions before the
    item, on a decided one, or after its days by their own time, have no effect.  A pending row is rejected once
    the watermark passes its time by more than ``days``, with no further row of
    its key: the store's timer does it.  The last row of each key equals
    ``state.age_out`` after ``state.decide`` over the same log.
    """
    schema = StructType([log.schema[key], *StructType.fromDDL("status string, at timestamp").fields])
    named = log.select(F.col(key), "decision", F.col("at").cast("timestamp"), "seq")
    return named.groupBy(key).transformWithState(_Age(key, days), schema, "append", "eventTime")
