"""Operators with keyed state: running buffers of a flow, and records of several lines.

Both hold what isn't complete in the state store between micro-batches, so no byte of a file is
read twice, and go on from the checkpoint after a restart. Timers in processing time release
what waits for input that doesn't come. What a key holds is bounded by its buffer.

Rows of a key that come in one micro-batch are put in order by the `order` columns; rows of
different micro-batches must come in order, as the tailing source gives them. Null keys are a
key like others; a null payload counts 0 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries that are started here keep their state in RocksDB, which these operators need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(order, kind="stable")


def octets(x: object) -> int:
    """Bytes of a payload; null has none."""
    return len(x) if isinstance(x, (bytes, bytearray)) else len(x.encode()) if isinstance(x, str) else 0


def stored_value(x: object) -> object:
    """A value of a frame as the state keeps it; what pandas has for null is None again."""
    return None if x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x else x


def only_timer(handle: StatefulProcessorHandle, at_ms: int | None) -> None:
    """The key's one timer: at `at_ms`, or none."""
    for t in list(handle.listTimers()):
        if t != at_ms:
            handle.deleteTimer(t)
    if at_ms is not None:
        handle.registerTimer(at_ms)


# --- running buffers


@dataclass(frozen=True)
class Limits:
    """An open buffer is due at so many records or bytes, or when its first record is so old."""

    records: int = 500
    bytes: int = 4 << 20
    age_ms: int = 5000


class Buffers(StatefulProcessor):
    """The open buffer of a key. A record that would take it beyond its bytes closes it first, so
    that a batch has more only if a single record does; then it is due when it is full. Age is counted by the
    records' own arrival: one that comes `age_ms` after the first closes the buffer, whichever
    micro-batch it is in, and a timer closes it where none comes."""

    def __init__(self, columns: list[str], kinds: StructType, order: list[str], payload: str, arrived: str, limits: Limits):
        self.columns, self.kinds, self.order, self.payload, self.arrived, self.limits = columns, kinds, order, payload, arrived, limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.kinds)
        self.facts = handle.getValueState("facts", "batch long, records long, bytes long, opened long")

    def closed(self, rows: list[tuple], batch: int, reason: str) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=self.columns, dtype=object)
        out["batch_no"], out["batch_records"], out["flush_reason"] = batch, len(rows), reason
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch, n, size, opened = self.facts.get() if self.facts.exists() else (0, 0, 0, 0)
        fresh: list[tuple] = []  # of the open buffer, not yet in the state
        stored = n > 0

        def close(reason: str) -> pd.DataFrame:
            nonlocal batch, n, size, stored, fresh
            every = [tuple(r) for r in self.held.get()] + fresh if stored else fresh
            if stored:
                self.held.clear()
            out = self.closed(every, batch, reason)
            batch, n, size, stored, fresh = batch + 1, 0, 0, False, []
            return out

        at_arrived = self.columns.index(self.arrived)
        at_payload = self.columns.index(self.payload)
        for row in in_order(rows, self.order)[self.columns].itertuples(index=False, name=None):
            now, own = int(row[at_arrived]), octets(row[at_payload])
            if n and now - opened >= self.limits.age_ms:
                yield close("age")
            if n and size + own > self.limits.bytes:
                yield close("bytes")
            if not n:
                opened = now
            fresh.append(tuple(map(stored_value, row)))
            n, size = n + 1, size + own
            if size >= self.limits.bytes:
                yield close("bytes")
            elif n >= self.limits.records:
                yield close("records")
        if fresh:
            self.held.appendList(fresh)
        self.facts.update((batch, n, size, opened))
        only_timer(self.handle, opened + self.limits.age_ms if n else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, n, _, opened = self.facts.get()
        if n and expiredTimerInfo.getExpiryTimeInMs() >= opened + self.limits.age_ms:
            every = [tuple(r) for r in self.held.get()]
            self.held.clear()
            self.facts.update((batch + 1, 0, 0, 0))
            yield self.closed(every, batch, "age")

    def close(self) -> None:
        pass


def buffered(rows: DataFrame, key: list[str], order: list[str], limits: Limits, payload: str = "data", arrived: Column | None = None, lanes: int = 1, lane_by: str | None = None) -> DataFrame:
    """The rows of a stream, held until their buffer is due: with batch_no (from 0 for each key),
    batch_records and flush_reason (bytes, records, age). `arrived` is in milliseconds, by default the micro-batch's time.
    With `lanes` a key has so many open buffers, by a hash of `lane_by`, so that a flow with
    a third of all rows isn't one task's work; `lane` tells them apart."""
    arrival = (F.unix_millis(F.current_timestamp()) if arrived is None else arrived).cast("long")
    of_lane = F.pmod(F.xxhash64(lane_by), F.lit(lanes)).cast("int") if lane_by is not None and lanes > 1 else F.lit(0)
    rows = rows.withColumn("lane", of_lane).withColumn("arrived_ms", arrival)
    columns, kinds = rows.columns, rows.schema
    out = StructType([*kinds.fields, StructField("batch_no", LongType()), StructField("batch_records", LongType()), StructField("flush_reason", StringType())])
    processor = Buffers(columns, kinds, ["arrived_ms", *order], payload, "arrived_ms", limits)
    return rows.groupBy(*key, "lane").transformWithStateInPandas(processor, out, "append", "ProcessingTime")


# --- records of several lines


LINE = "file_id string, file_path string, start_offset long, end_offset long, raw binary, terminated boolean"


class MultiLine(StatefulProcessor):
    """The open record of a file: it ends where a line begins the next, at a full buffer, where the
    next line doesn't follow it (the file was begun anew), or when no line came for `release_ms`."""

    def __init__(self, begins: str, delimiter: bytes, buffer: int, release_ms: int):
        self.begins, self.delimiter, self.buffer, self.release_ms = begins, delimiter, buffer, release_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pattern = re.compile(self.begins.encode())
        self.parts = handle.getListState("parts", "raw binary")
        self.facts = handle.getValueState("facts", "path string, first long, last long, bytes long, terminated boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        opened = self.facts.exists()
        path, first, last, size, terminated = self.facts.get() if opened else ("", 0, 0, 0, True)
        fresh: list[bytes] = []
        stored = opened

        def close(oversized: bool = False) -> None:
            nonlocal opened, stored, fresh, size
            every = [bytes(r[0]) for r in self.parts.get()] + fresh if stored else fresh
            if stored:
                self.parts.clear()
            out.append((key[0], path, first, last, self.delimiter.join(every), terminated, oversized))
            opened, stored, fresh, size = False, False, [], 0

        for _, where, start, end, raw, ended in in_order(rows, ["start_offset"])[["file_id", "file_path", "start_offset", "end_offset", "raw", "terminated"]].itertuples(index=False, name=None):
            raw = bytes(raw or b"")
            if opened and (start != last or self.pattern.match(raw)):
                close()
            if not opened:
                opened, first = True, int(start)
            fresh.append(raw)
            path, last, terminated, size = where, int(end), bool(ended), size + len(raw) + len(self.delimiter)
            if size >= self.buffer:
                close(oversized=True)
        if opened:
            self.parts.appendList([(x,) for x in fresh])
            self.facts.update((path, first, last, size, terminated))
        elif self.facts.exists():
            self.facts.clear()
        only_timer(self.handle, timerValues.getCurrentProcessingTimeInMs() + self.release_ms if opened and self.release_ms >= 0 else None)
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.facts.exists():
            path, first, last, _, terminated = self.facts.get()
            raw = self.delimiter.join(bytes(r[0]) for r in self.parts.get())
            self.parts.clear()
            self.facts.clear()
            yield self.frame([(key[0], path, first, last, raw, terminated, False)])

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["file_id", "file_path", "start_offset", "end_offset", "raw", "terminated", "oversized"])

    def close(self) -> None:
        pass


def multi_line(lines: DataFrame, start_pattern: str, delimiter: str = "\n", buffer: int = 6 << 20, release_ms: int = -1) -> DataFrame:
    """Lines of a stream (file_id, file_path, start_offset, end_offset, raw, terminated) joined to
    records as framing.multi_line joins those of a whole file. Without `release_ms` the last
    record of a file waits for the line that begins the next."""
    rows = lines.select(F.col("file_id").cast("string"), F.col("file_path").cast("string"), F.col("start_offset").cast("long"), F.col("end_offset").cast("long"), F.col("raw").cast("binary"), "terminated")
    out = StructType([*rows.schema.fields, StructField("oversized", BooleanType())])
    return rows.groupBy("file_id").transformWithStateInPandas(MultiLine(start_pattern, delimiter.encode(), buffer, release_ms), out, "append", "ProcessingTime")
