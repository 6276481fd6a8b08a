"""Element status in a stream: Spark keeps the last message of every element for its lifetime."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wavemeter.model import TIME
from wavemeter.operators.status import ELEMENT_FIELDS, ELEMENT_KEY, normalised_messages
from wavemeter.sinks.tables import upsert_table
from wavemeter.streaming.jobs import drain_batches

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Timers and typed state need this store; it keeps state on disk and logs what changed.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_MILLIS = "event_ms"
_ZONED = "event_time"
_SLOT = "slot"
# Groups that the elements of a stream are dealt into.
SLOTS = 16_384
# Messages of a task that are looked through at once, some tens of MB, and rows of a batch passed on.
ROWS_AT_ONCE, BATCH_ROWS = 200_000, 10_000


class LastMessage(StatefulProcessor):
    """Last message of every element of a slot; a timer ends them when the watermark has passed their time.

    Messages that are no newer than the one held change nothing and are not passed on, so the
    output holds what changed: new messages as active, ended ones as inactive. Reading and writing
    state costs a call each, whether of one element or of a list, so elements share slots, and the
    slot's timer is that of its oldest message.
    """

    def __init__(self, fields: Sequence[str], order: Sequence[str], state: str):
        self.columns, self.schema = (*ELEMENT_KEY, *fields), state
        self.order = tuple(self.columns.index(name) for name in order)
        self.millis = self.columns.index(_MILLIS)
        self.row = Row(*self.columns, "ativo")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("last", self.schema)

    def _rank(self, values: tuple) -> tuple:
        """Nulls come before all values."""
        return tuple((values[i] is not None, values[i]) for i in self.order)

    def _read(self) -> dict[tuple, tuple]:
        return {values[: len(ELEMENT_KEY)]: values for values in self.held.get()}

    def _due(self, held: dict[tuple, tuple]) -> int | None:
        # The watermark lags by the lifetime, so a message ends once the watermark lies behind it.
        return min(values[self.millis] for values in held.values()) + 1 if held else None

    def _write(self, held: dict[tuple, tuple], due: int | None) -> None:
        """Hold these messages; ``due`` is the timer that stands."""
        if not held:
            self.held.clear()
            return
        self.held.put(list(held.values()))
        soonest = self._due(held)
        if soonest != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(soonest)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest: dict[tuple, tuple] = {}
        for row in rows:
            values = tuple(row[name] for name in self.columns)
            element = values[: len(ELEMENT_KEY)]
            if element not in newest or self._rank(values) > self._rank(newest[element]):
                newest[element] = values
        held = self._read()
        due = self._due(held)
        changed = {
            element: values
            for element, values in newest.items()
            if element not in held or self._rank(values) > self._rank(held[element])
        }
        if changed:
            self._write(held | changed, due)
        for values in changed.values():
            yield self.row(*values, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        behind = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = self._read()
        ended = [values for values in held.values() if values[self.millis] < behind]
        # The timer that went off is gone.
        self._write({e: values for e, values in held.items() if values[self.millis] >= behind}, None)
        for values in ended:
            yield self.row(*values, False)


def _newest_of_batch(keys: Sequence[str], order: Sequence[str], at_once: int = ROWS_AT_ONCE):
    """One row per key of every ``at_once`` rows of a task, so that an element with most messages is cheap to move."""

    def newest(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        ranked = table.take(
            pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
        )
        places = ranked.select(keys).append_column("place", pa.array(range(len(ranked)), pa.int64()))
        last = places.group_by(list(keys), use_threads=False).aggregate([("place", "max")])
        yield from ranked.take(last["place_max"]).combine_chunks().to_batches(BATCH_ROWS)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= at_once:
                yield from newest(held)
                held, rows = [], 0
        if held:
            yield from newest(held)

    return run


def element_changes(
    messages: DataFrame, lifetime: timedelta = timedelta(days=1), order: Sequence[str] = (TIME,),
    slots: int = SLOTS,
) -> DataFrame:
    """Stream of changed elements: their last message, and ``ativo`` whether it is still within its lifetime.

    The clock is the latest event time seen: an element is ended as soon as its last message is
    older than that by more than the lifetime, and active again with its next message. ``order`` (the
    time first) breaks ties between equal times. Messages without a time, and those that
    have outlived the lifetime when they arrive, say nothing about a live element and are left out.
    Elements are dealt by hash into ``slots``, a number that stays with the checkpoint; choose it so that a
    slot has some dozens of live elements.
    """
    extra = [c for c in order if c != TIME]
    columns = [*ELEMENT_KEY, _MILLIS, TIME, *ELEMENT_FIELDS, *extra]
    rows = (
        normalised_messages(messages)
        .where(F.col(TIME).isNotNull())
        .withColumn(_MILLIS, F.unix_millis(F.col(TIME).cast("timestamp")))
        .select(*columns)
    )
    least = rows.mapInArrow(_newest_of_batch(ELEMENT_KEY, (TIME, *extra)), rows.schema)
    # A watermark needs a zoned time; the session zone is UTC.
    timed = least.withColumn(_ZONED, F.col(TIME).cast("timestamp")).withWatermark(_ZONED, _span(lifetime))
    slotted = timed.withColumn(_SLOT, F.pmod(F.xxhash64(*ELEMENT_KEY), F.lit(slots)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    state = ", ".join(f"{c} {kinds[c]}" for c in columns)
    changed = slotted.groupBy(_SLOT).transformWithState(
        LastMessage(columns[len(ELEMENT_KEY) :], (TIME, *extra), state), f"{state}, ativo boolean", "update", "eventtime"
    )
    return changed.select(*ELEMENT_KEY, *ELEMENT_FIELDS, F.col(TIME).alias("created_at"), "ativo")


def _span(time: timedelta) -> str:
    return f"{int(time.total_seconds() * 1000)} milliseconds"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside use the state store that timers need; others keep theirs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def track_elements(
    spark: SparkSession, messages: DataFrame, path: str, checkpoint: str,
    lifetime: timedelta = timedelta(days=1), order: Sequence[str] = (TIME,),
) -> None:
    """Bring the keyed table of elements up to date with all messages that are there now.

    State lives in Spark's store under the checkpoint; the table gets changed elements only, and a
    batch that is repeated after a failure changes nothing.
    """

    def handle(batch: DataFrame, number: int) -> None:
        upsert_table(spark, batch, path, ELEMENT_KEY, F.struct("created_at", F.col("ativo").cast("int") * -1))

    with keyed_state(spark):
        drain_batches(element_changes(messages, lifetime, order), handle, checkpoint, "update")
