"""Metrics of running flows: a listener that turns the progress of queries into metric rows.

Each micro-batch gives rows (flow, name, unit, min, max, count, sum): what the flow observed (records
processed, skipped, failed), how long it took, and the bytes and files behind, which come from the query's
offset log. They are written under the query's id and the batch's number, so that a batch that is run again
overwrites its own, and totals go on after a restart. The sets merge (see operators.metrics): those
of batches that are done become one file from time to time. The folder is on a file system that the driver can write to.
"""

from __future__ import annotations

import json
import logging
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from logloom.operators.metrics import INFO_BEHIND, WARN_BEHIND, merged
from logloom.streaming.offset_log import OffsetLog

ROWS = "flow string, name string, unit string, min double, max double, count long, sum double"
FILE = re.compile(r"([0-9a-f-]{36})\.([0-9]{12})\.(batch|merged)\.json\Z")
OBSERVED = "records "


def one(flow: str, name: str, unit: str, value: float) -> dict:
    return {"flow": flow, "name": name, "unit": unit, "min": float(value), "max": float(value), "count": 1, "sum": float(value)}


def merge(rows: list[dict]) -> list[dict]:
    """Sets of one flow, name and unit as one."""
    out: dict[tuple, dict] = {}
    for r in rows:
        k = (r["flow"], r["name"], r["unit"])
        o = out.get(k)
        out[k] = dict(r) if o is None else o | {"min": min(o["min"], r["min"]), "max": max(o["max"], r["max"]), "count": o["count"] + r["count"], "sum": o["sum"] + r["sum"]}
    return list(out.values())


class Lag:
    """Bytes that each file is behind, kept by following an offset log: the work is that of the changes."""

    def __init__(self, folder: str):
        self.log, self.files = OffsetLog(folder), {}

    def behind(self) -> tuple[int, int]:
        """(bytes, files) not read yet at the newest version."""
        self.files = self.log.follow(self.files)
        left = [n for n in (f["size"] - f["offset"] for f in self.files.values() if not f.get("gone")) if n > 0]
        return sum(left), len(left)


class MetricLog(StreamingQueryListener):
    """spark.streams.addListener(MetricLog(folder, {flow id: checkpoint folder}))"""

    def __init__(self, folder: str, checkpoints: dict[str, str] | None = None, merge_every: int = 64, logger: str = "logloom.status"):
        self.folder, self.merge_every, self.log = re.sub(r"^file:/+", "/", folder), merge_every, logging.getLogger(logger)
        self.lags = {flow: Lag(f"{c.rstrip('/')}/tail") for flow, c in (checkpoints or {}).items()}

    def files(self, query: str, kind: str) -> list[int]:
        names = os.listdir(self.folder) if os.path.isdir(self.folder) else []
        return sorted(int(m[2]) for m in map(FILE.match, names) if m and (m[1], m[3]) == (query, kind))

    def path(self, query: str, n: int, kind: str) -> str:
        return os.path.join(self.folder, f"{query}.{n:012d}.{kind}.json")

    def write(self, query: str, n: int, kind: str, rows: list[dict]) -> None:
        os.makedirs(self.folder, exist_ok=True)
        part = os.path.join(self.folder, f".{uuid.uuid4().hex}")
        with open(part, "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows))
        os.replace(part, self.path(query, n, kind))

    def read(self, query: str, n: int, kind: str) -> list[dict]:
        with open(self.path(query, n, kind)) as f:
            return [json.loads(line) for line in f]

    def record(self, query: str, batch: int, observed: dict[str, dict], took_ms: int) -> list[dict]:
        """Write the rows of a micro-batch, and merge those of batches before it once there are many.
        Merged files hold the batches before their number; so a stop between writing one and deleting
        what it holds counts nothing twice (see table)."""
        rows = []
        for name, values in observed.items():
            if name.startswith(OBSERVED):
                flow = name.removeprefix(OBSERVED)
                rows += [one(flow, k, "Count", v or 0) for k, v in values.items()] + [one(flow, "batch_duration", "Milliseconds", took_ms)]
                if flow in self.lags:
                    n_bytes, n_files = self.lags[flow].behind()
                    rows += [one(flow, "bytes_behind", "Bytes", n_bytes), one(flow, "files_behind", "Count", n_files)]
                    level = logging.WARNING if n_bytes >= WARN_BEHIND else logging.INFO if n_bytes >= INFO_BEHIND else logging.DEBUG
                    self.log.log(level, "%s: batch %d, %d bytes in %d files behind", flow, batch, n_bytes, n_files)
        if not rows:
            return rows
        self.write(query, batch, "batch", rows)
        done, old = [n for n in self.files(query, "batch") if n < batch], self.files(query, "merged")
        if len(done) >= self.merge_every:
            base = max(old, default=0)
            before = self.read(query, base, "merged") if old else []
            self.write(query, batch, "merged", merge([*before, *(r for n in done if n >= base for r in self.read(query, n, "batch"))]))
            for n, kind in [*((n, "batch") for n in done), *((n, "merged") for n in old if n < batch)]:
                os.remove(self.path(query, n, kind))
        return rows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            self.record(str(p.id), p.batchId, {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}, p.durationMs.get("triggerExecution", 0))
        except (OSError, ValueError) as e:
            self.log.warning("metrics of %s, batch %d, weren't written: %s", p.name or p.id, p.batchId, e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def table(spark: SparkSession, folder: str) -> DataFrame:
    """All metric rows: the newest merged file of each query and the batches since."""
    base = re.sub(r"^file:/+", "/", folder)
    found = [m for m in map(FILE.match, os.listdir(base) if os.path.isdir(base) else []) if m]
    newest: dict[str, int] = {}
    for m in found:
        if m[3] == "merged":
            newest[m[1]] = max(newest.get(m[1], 0), int(m[2]))
    paths = [os.path.join(base, m[0]) for m in found if (int(m[2]) == newest[m[1]] if m[3] == "merged" else int(m[2]) >= newest.get(m[1], 0))]
    return spark.read.schema(ROWS).json(paths) if paths else spark.createDataFrame([], ROWS)


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of each metric by flow, over all batches of all runs."""
    return merged(table(spark, folder), ["flow"])
