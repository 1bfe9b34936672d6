"""A streaming sink whose tasks say what they sent, and whose commit publishes that at once.

A task sends its records and writes what became of them to a file of its own attempt under `data/`;
its commit message names the file, with counts and its pace. The commit of a micro-batch writes one
manifest under `batches/` by rename. Only files that a manifest names are part of the result table, so a
task or driver that is killed at any point leaves neither a gap nor a duplicate: a micro-batch that is run
again puts its manifest in the place of the one before. (What such a batch sends again, the receiver
sees again.) An abort deletes what its tasks wrote; what killed tasks left is deleted by `vacuum`.

Every so many micro-batches the manifests of those that are done become one. The folder is shared by driver and
executors. Buffers of keyed state go in order only through `sink.Delivery`, as a stream can't be sorted.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from logloom.streaming import sink

MANIFEST = re.compile(r"([0-9]{12})\.(batch|compact)\Z")


@dataclass
class Sent(WriterCommitMessage):
    """What a task did: its file (None without records), records, failed ones, bytes, failure count at its end."""

    file: str | None
    records: int
    failed: int
    n_bytes: int
    pace: float


def manifests(results: str, kind: str) -> list[int]:
    folder = os.path.join(results, "batches")
    names = os.listdir(folder) if os.path.isdir(folder) else []
    return sorted(int(m[1]) for m in map(MANIFEST.match, names) if m and m[2] == kind)


def read_manifest(results: str, n: int, kind: str) -> dict[str, dict]:
    with open(os.path.join(results, "batches", f"{n:012d}.{kind}")) as f:
        return json.load(f)


def write_manifest(results: str, n: int, kind: str, batches: dict[str, dict]) -> None:
    os.makedirs(os.path.join(results, "batches"), exist_ok=True)
    to = os.path.join(results, "batches", f"{n:012d}.{kind}")
    part = f"{to}.{uuid.uuid4().hex}.part"
    with open(part, "w") as f:
        json.dump(batches, f)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, to)


def published(results: str) -> dict[int, dict]:
    """The published micro-batches: number -> files (with their counts) and pace."""
    # manifests go only once their successor is there, so a name that is gone is looked for anew
    for _ in range(10):
        try:
            base = max(manifests(results, "compact"), default=-1)
            out = {int(n): b for n, b in read_manifest(results, base, "compact").items()} if base >= 0 else {}
            for n in manifests(results, "batch"):
                if n >= base:
                    out |= {int(k): b for k, b in read_manifest(results, n, "batch").items()}
            return out
        except FileNotFoundError:
            continue
    raise OSError(f"the manifests of {results} don't stand still")


def table(spark: SparkSession, results: str) -> DataFrame:
    """The result table: the rows of published files."""
    names = [os.path.join(results, "data", f["file"]) for b in published(results).values() for f in b["files"]]
    return spark.read.schema(sink.RESULT).parquet(*names) if names else spark.createDataFrame([], sink.RESULT)


def summary(spark: SparkSession, results: str) -> DataFrame:
    """(batch_id, n_records, n_failed, n_bytes) of the published micro-batches, from the manifests alone."""
    rows = [(n, sum(f["records"] for f in b["files"]), sum(f["failed"] for f in b["files"]), sum(f["n_bytes"] for f in b["files"])) for n, b in sorted(published(results).items())]
    return spark.createDataFrame(rows, "batch_id long, n_records long, n_failed long, n_bytes long")


def vacuum(results: str, older_than_s: float = 86_400) -> list[str]:
    """Delete files that no manifest names, once they are so old that no running task writes them."""
    before = time.time() - older_than_s
    folder = os.path.join(results, "data")
    # listed before the manifests are read: a file that is published meanwhile is named
    old = [n for n in (os.listdir(folder) if os.path.isdir(folder) else []) if os.path.getmtime(os.path.join(folder, n)) <= before]
    named = {f["file"] for b in published(results).values() for f in b["files"]}
    gone = sorted(set(old) - named)
    for n in gone:
        os.remove(os.path.join(folder, n))
    return gone


class Writer(DataSourceStreamArrowWriter):
    def __init__(self, delivery: sink.Delivery, compact_every: int):
        self.delivery, self.compact_every = delivery, compact_every
        self.results = re.sub(r"^file:/+", "/", delivery.results)
        # a writer is made for each micro-batch: it begins where the one before ended
        last = max(manifests(self.results, "batch"), default=-1)
        self.before = max((b["pace"] for b in read_manifest(self.results, last, "batch").values()), default=0.0) if last >= 0 else 0.0

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        out, done = None, Sent(None, 0, 0, 0, 0.0)
        path = lambda: os.path.join(self.results, "data", done.file)
        try:
            for rows in self.delivery.sent((r for b in iterator for r in b.to_pylist()), self.before, TaskContext.get().partitionId()):
                if out is None:
                    os.makedirs(os.path.join(self.results, "data"), exist_ok=True)
                    done.file = f"{uuid.uuid4().hex}.parquet"
                    out = pq.ParquetWriter(path(), sink.RESULT_FIELDS)
                out.write_batch(pa.RecordBatch.from_pylist([{n: r[n] for n in sink.RESULT_FIELDS.names} for r in rows], schema=sink.RESULT_FIELDS))
                done.records += len(rows)
                done.failed += sum(r["error_code"] is not None for r in rows)
                done.n_bytes += sum(r["n_bytes"] for r in rows)
                done.pace = rows[-1]["pace"]
        except BaseException:
            if out is not None:
                out.close()
                os.remove(path())
            raise
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Sent | None], batchId: int) -> None:
        sent = [m for m in messages if m is not None]
        files = [{"file": m.file, "records": m.records, "failed": m.failed, "n_bytes": m.n_bytes} for m in sent if m.file]
        write_manifest(self.results, batchId, "batch", {str(batchId): {"files": files, "pace": max((m.pace for m in sent if m.file), default=0.0)}})
        # those before this one are done and won't be run again
        loose = [n for n in manifests(self.results, "batch") if n < batchId]
        if len(loose) >= self.compact_every:
            old = manifests(self.results, "compact")
            write_manifest(self.results, batchId, "compact", {str(n): b for n, b in published(self.results).items() if n < batchId})
            for n, kind in [*((n, "batch") for n in loose), *((n, "compact") for n in old if n < batchId)]:
                os.remove(os.path.join(self.results, "batches", f"{n:012d}.{kind}"))

    def abort(self, messages: list[Sent | None], batchId: int) -> None:
        for m in messages:
            if m is not None and m.file:
                os.remove(os.path.join(self.results, "data", m.file))


@dataclass
class Published:
    """Delivery through the sink: given to flow.start in the place of a foreachBatch function."""

    delivery: sink.Delivery
    compact_every: int = 64

    def writer(self, df: DataFrame):
        """The stream writer of a query over rows (file_id, end_offset, data, partition_key)."""
        delivery, every, name = self.delivery, self.compact_every, f"published_{uuid.uuid4().hex}"

        class Source(DataSource):
            @classmethod
            def name(cls) -> str:
                return name

            def streamWriter(self, schema: StructType, overwrite: bool) -> Writer:
                return Writer(delivery, every)

        df.sparkSession.dataSource.register(Source)
        rows = df.select("file_id", "end_offset", "partition_key", F.col("data").cast("binary").alias("data"))
        if delivery.threads > 1:
            rows = rows.repartition(delivery.threads)
        return rows.writeStream.format(name)
