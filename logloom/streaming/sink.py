"""Delivery of micro-batches: batches of a call's size, retries of what failed, dead letters.

A sender is a callable (records) -> list of None or (code, message), one for each record. The
batch id names what was delivered, so that a replayed micro-batch overwrites itself.
"""

from __future__ import annotations

import logging
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logloom.operators import batching, delivery

Sender = Callable[[list[dict]], list[tuple[str, str] | None]]

#: What is written of each record that was sent or given up.
RESULT = "file_id string, end_offset long, partition_key string, data binary, error_code string, error_message string, task int, call long, pace double"
RESULT_FIELDS = pa.schema([("file_id", pa.string()), ("end_offset", pa.int64()), ("partition_key", pa.string()), ("data", pa.binary()), ("error_code", pa.string()), ("error_message", pa.string()), ("task", pa.int32()), ("call", pa.int64()), ("pace", pa.float64())])


class Backoff:
    """Delays after failures: doubled with each, with jitter; a partial failure counts as the
    share that failed, a success divides the count by ten."""

    def __init__(self, first_ms: int = 100, most_ms: int = 10_000, factor: float = 2.0, jitter: float = 0.3, recovery: float = 10.0, rng: Callable[[], float] = random.random, failures: float = 0.0):
        self.first_ms, self.most_ms, self.factor, self.jitter, self.recovery, self.rng = first_ms, most_ms, factor, jitter, recovery, rng
        self.failures = failures

    def failed(self, share: float = 1.0) -> None:
        self.failures += share

    def succeeded(self) -> None:
        self.failures /= self.recovery
        if self.failures < 1:
            self.failures = 0.0

    def next_ms(self) -> int:
        n = round(self.failures)
        if n == 0:
            return 0
        return int(min(self.most_ms, self.first_ms * self.factor ** (n - 1)) * (1 + (2 * self.rng() - 1) * self.jitter))


def send(records: list[dict], sender: Sender, backoff: Backoff, attempts: int = 10, sleep: Callable[[float], None] = time.sleep) -> list[tuple[dict, tuple[str, str] | None]]:
    """Each record with None, or with why it was given up: after so many attempts, or at once
    where no retry helps. Only what failed is sent again."""
    done: list[tuple[dict, tuple[str, str] | None]] = []
    left = records
    for attempt in range(attempts):
        if not left:
            break
        sleep(backoff.next_ms() / 1000)
        try:
            results = sender(left)
        except Exception as e:
            backoff.failed()
            results = [(type(e).__name__, str(e))] * len(left)
            if not delivery.retriable(e):
                return done + [(r, x) for r, x in zip(left, results, strict=True)]
        else:
            bad = sum(x is not None for x in results)
            backoff.failed(bad / len(left)) if bad else backoff.succeeded()
        done += [(r, None) for r, x in zip(left, results, strict=True) if x is None]
        failed = [(r, x) for r, x in zip(left, results, strict=True) if x is not None]
        if attempt == attempts - 1:
            return done + failed
        left = [r for r, _ in failed]
    return done


@dataclass
class Delivery:
    """A foreachBatch function: sends rows (file_id, end_offset, data, partition_key) and writes
    what became of them to `results`, partitioned by batch id. Rows of running buffers (lane,
    batch_no; see state.buffered) go buffer by buffer, the buffers of a lane in order.

    Tasks pace themselves, and hand on what they learnt: a row has the failure count (`pace`) at the
    end of its call (`call`, in `task`), and a micro-batch begins with the highest count at
    which a task of the one before it ended, also after a restart. A lone record that
    is larger than a call may be isn't sent, but becomes a dead letter."""

    sender: Sender
    results: str
    max_records: int = 500
    max_bytes: int = 4 << 20
    threads: int = 1
    attempts: int = 10
    first_ms: int = 100
    most_ms: int = 10_000
    log_level: int | None = logging.INFO

    def chunks(self, rows: Iterator[dict]) -> Iterator[list[dict]]:
        """Batches by count and bytes; a record larger than a batch goes alone. A buffer ends a batch."""
        out, size = [], 0
        for r in rows:
            n = len(r["data"] or b"")
            other = out and (r.get("lane"), r.get("batch_no")) != (out[-1].get("lane"), out[-1].get("batch_no"))
            if out and (other or len(out) >= self.max_records or size + n > self.max_bytes):
                yield out
                out, size = [], 0
            out.append(r)
            size += n
        if out:
            yield out

    def sent(self, rows: Iterator[dict], before: float, task: int) -> Iterator[list[dict]]:
        """Send a task's rows call by call: what became of each, with the size of what was to be sent."""
        backoff = Backoff(self.first_ms, self.most_ms, failures=before)
        for call, chunk in enumerate(self.chunks(rows)):
            try:
                batching.check_size(sum(len(r["data"] or b"") for r in chunk))
                done = send(chunk, self.sender, backoff, self.attempts)
            except batching.TooLarge as e:
                done = [(r, (type(e).__name__, str(e))) for r in chunk]
            yield [r | {"n_bytes": len(r["data"] or b""), "data": None if x is None else r["data"], "error_code": x and x[0], "error_message": x and x[1], "task": task, "call": call, "pace": backoff.failures} for r, x in done]

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        me, before = self, self.pace_after(df.sparkSession, batch_id - 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in me.sent((r for b in batches for r in b.to_pylist()), before, TaskContext.get().partitionId()):
                yield pa.RecordBatch.from_pylist([{n: r[n] for n in RESULT_FIELDS.names} for r in rows], schema=RESULT_FIELDS)

        buffers = [c for c in ("lane", "batch_no") if c in df.columns]
        rows = df.select("file_id", "end_offset", "partition_key", F.col("data").cast("binary").alias("data"), *buffers)
        if buffers:
            rows = rows.repartition(self.threads, "lane").sortWithinPartitions(*buffers, "file_id", "end_offset")
        elif self.threads > 1:
            rows = rows.repartition(self.threads)
        out = rows.mapInArrow(run, RESULT)
        # the payload of what failed is kept with its error: the dead letters
        out.write.mode("overwrite").parquet(f"{self.results}/batch_id={batch_id}")
        if self.log_level is not None:
            logging.getLogger("logloom.sink").log(self.log_level, "batch %d delivered", batch_id)


    def pace_after(self, spark: SparkSession, batch_id: int) -> float:
        """The highest failure count with which a task of a micro-batch ended; 0 where none was written."""
        try:
            rows = spark.read.parquet(f"{self.results}/batch_id={batch_id}")
        except AnalysisException:
            return 0.0
        return rows.groupBy("task").agg(F.max_by("pace", "call").alias("pace")).agg(F.coalesce(F.max("pace"), F.lit(0.0))).first()[0]


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes a batch under its id: replays overwrite themselves."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def copy_files(files: DataFrame, target: str, dump_directory: str = "", full_path: bool = False, after: Callable[[str], object] | None = None) -> DataFrame:
    """Copy whole files (path) under their object keys: (path, object_key, size), and what else
    the rows have. The copy is made under a name of the attempt and renamed; `after` is called
    with each copied path. A task that is run again takes a file that is gone, but has been
    copied, as done."""
    key = delivery.object_key(dump_directory, F.col("path") if full_path else F.element_at(F.split("path", "/"), -1))
    more = [c for c in files.columns if c not in ("path", "size", "object_key")]
    rows = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), *more).select("path", key.alias("object_key"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import shutil
        import uuid

        for batch in batches:
            sizes = []
            for r in batch.select(["path", "object_key"]).to_pylist():
                to = os.path.join(target, r["object_key"])
                os.makedirs(os.path.dirname(to), exist_ok=True)
                if os.path.exists(r["path"]) or not os.path.exists(to):
                    part = f"{to}.{uuid.uuid4().hex}.part"
                    shutil.copyfile(r["path"], part)
                    os.replace(part, to)
                    if after is not None:
                        after(r["path"])
                sizes.append(os.path.getsize(to))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "size"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("size", LongType())]))


def clean_all(sent: DataFrame, delete: bool = False, move_to: str = "", suffix: str = ".COMPLETED") -> None:
    """Clean up delivered files (path, size, mtime_ms), each only if it is still as it was when
    it was taken: one that was written to meanwhile stays, and is taken anew."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        for batch in rows:
            for r in batch.to_pylist():
                try:
                    s = os.stat(r["path"])
                except FileNotFoundError:
                    continue
                if (s.st_size, s.st_mtime_ns // 1_000_000) == (r["size"], r["mtime_ms"]):
                    clean_up(r["path"], delete=delete, move_to=move_to, suffix=suffix)
            yield batch

    sent.select("path", "size", "mtime_ms").mapInArrow(run, "path string, size long, mtime_ms long").write.format("noop").mode("overwrite").save()


def clean_up(path: str, file_id: str | None = None, delete: bool = False, move_to: str = "", suffix: str = ".COMPLETED") -> str | None:
    """Delete a delivered file, else move it, else add the suffix; only if it still is the file
    that was delivered. Returns where it is now."""
    import os
    import shutil

    s = os.stat(path)
    if file_id is not None and f"{s.st_dev}-{s.st_ino}" != file_id:
        return path
    if delete:
        os.remove(path)
        return None
    if move_to:
        os.makedirs(move_to, exist_ok=True)
        return shutil.move(path, os.path.join(move_to, os.path.basename(path)))
    os.rename(path, path + suffix)
    return path + suffix
