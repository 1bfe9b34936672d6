"""Files taken whole once they are stable: a poll at a time, its state a table of snapshots.

A poll's snapshot is written first, then its files are copied and its notices written, then the
originals are cleaned up. A file counts as sent only once the notices of its poll are there, so
whatever step a process stops after, the next poll names what wasn't sent again; a copy that was
made already is made again under the same key.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import keys
from logloom.operators.snapshot import stable_files
from logloom.plans.config import Flow
from logloom.sources.files import listing
from logloom.streaming import polls, sink

SNAPSHOT = "file_id string, path string, name string, size long, mtime_ms long, last_offset long, last_check_ms long"


NOTICE = "file_id string, path string, data string, size long, mtime_ms long"


def last_poll(spark: SparkSession, folder: str) -> int:
    """The number of the newest poll whose table is whole, 0 without one."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    polls = sorted((int(n.removeprefix("poll=")) for n in names if n.startswith("poll=")), reverse=True)
    return next((n for n in polls if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/poll={n}/_SUCCESS"))), 0)


def uploads(state: str) -> str:
    return f"{state.rstrip('/')}_uploads"


def last_snapshot(spark: SparkSession, state: str) -> tuple[DataFrame, int]:
    """The newest snapshot of a state folder and its number, which is 0 before the first. Files
    whose notices were written have their offset at 0, those not sent at -1."""
    n = last_poll(spark, state)
    if not n:
        return spark.createDataFrame([], SNAPSHOT), 0
    rows = spark.read.schema(SNAPSHOT).parquet(f"{state}/poll={n}")
    if last_poll(spark, uploads(state)) == n:
        sent = spark.read.schema(NOTICE).parquet(f"{uploads(state)}/poll={n}").select("file_id", "size", "mtime_ms", F.lit(0).cast("long").alias("sent"))
        rows = rows.join(sent, ["file_id", "size", "mtime_ms"], "left").withColumn("last_offset", F.coalesce("sent", "last_offset"))
    return rows.select(*[c.split()[0] for c in SNAPSHOT.split(", ")]), n


def poll(spark: SparkSession, flow: Flow, state: str, now_ms: int | None = None) -> DataFrame:
    """The files (file_id, path, name, size, mtime_ms) that are stable and weren't sent yet."""
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    old, n = last_snapshot(spark, state)
    recent = now_ms - 1000 * flow.ignore_not_updated_file_seconds if flow.ignore_not_updated_file_seconds >= 0 else None
    new = listing(spark, flow.file_pattern, flow.directory_recursion, flow.file_suffix, archives=flow.kind == "object_store", newer_than_ms=recent)
    states = stable_files(old, new, now_ms, flow.max_file_checking_millis, flow.ignore_empty_data)
    now = new.join(states, "file_id")
    # written before anything is sent: the states of one poll are what its files are taken by
    where = f"{state}/poll={n + 1}"
    now = now.withColumn("last_offset", F.when(F.col("state") == "Upload", F.lit(-1).cast("long")).otherwise(F.col("last_offset")))
    now.select("file_id", "path", "name", "size", "mtime_ms", "last_offset", "last_check_ms", "state").write.mode("overwrite").parquet(where)
    return spark.read.parquet(where).where("state = 'Upload'").select("file_id", "path", "name", "size", "mtime_ms")


def upload(spark: SparkSession, flow: Flow, state: str, target: str, now_ms: int | None = None, clean: bool = False) -> DataFrame:
    """Copy what has become stable and return the notices (object key as `data`) of it; with
    `clean` the originals are deleted, moved or renamed as the flow says. The copies are made
    once, however often the result is read. A blank destination has no notices."""
    files = poll(spark, flow, state, now_ms)
    where = f"{uploads(state)}/poll={last_poll(spark, state)}"
    done = sink.copy_files(files, target, flow.dump_directory, flow.upload_full_path)
    done.select("file_id", "path", F.col("object_key").alias("data"), "size", "mtime_ms").write.mode("overwrite").parquet(where)
    notices = spark.read.parquet(where)
    if clean:
        sink.clean_all(notices, delete=flow.delete_policy == "immediate", move_to=flow.file_move_to_dir, suffix=flow.file_suffix)
    notices = notices.select("path", "data", "size")
    return notices if flow.destination.strip() else notices.where(F.lit(False))


class Uploads:
    """A foreachBatch function over polls: uploads what has become stable and delivers the notices.

    A micro-batch that is run again delivers the notices of the poll it made, if that poll's copies were
    all made; else it polls anew, which names again what wasn't sent. So a stop between copying
    and delivering loses no notice."""

    def __init__(self, flow: Flow, state: str, target: str, deliver: Callable[[DataFrame, int], None], clean: bool = False):
        self.flow, self.state, self.target, self.deliver, self.clean = flow, state.rstrip("/"), target, deliver, clean

    def made_by(self, spark: SparkSession, batch_id: int) -> int:
        """The number of the poll that a micro-batch made before, 0 without one."""
        try:
            return spark.read.parquet(f"{self.state}_batches/batch_id={batch_id}").first()[0]
        except AnalysisException:
            return 0

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark, flow = df.sparkSession, self.flow
        row = df.first()
        if row is None:
            return
        made = self.made_by(spark, batch_id)
        where = f"{uploads(self.state)}/poll={made}"
        if made and last_poll(spark, uploads(self.state)) >= made:
            notices = spark.read.schema(NOTICE).parquet(where)
            if self.clean:
                sink.clean_all(notices, delete=flow.delete_policy == "immediate", move_to=flow.file_move_to_dir, suffix=flow.file_suffix)
            if not flow.destination.strip():
                notices = notices.where(F.lit(False))
        else:
            spark.range(1).select(F.lit(last_poll(spark, self.state) + 1).cast("long").alias("poll")).write.mode("overwrite").parquet(f"{self.state}_batches/batch_id={batch_id}")
            notices = upload(spark, flow, self.state, self.target, row["poll_ms"], self.clean)
        rows = notices.select(F.col("path").alias("file_id"), F.col("path").alias("file_path"), F.lit(0).cast("long").alias("start_offset"), F.col("size").alias("end_offset"), "data", keys.key(flow.partition_key_option, F.col("data"), F.col("path")).alias("partition_key"))
        self.deliver(rows, batch_id)


def start(spark: SparkSession, flow: Flow, deliver: Callable[[DataFrame, int], None], checkpoint: str, target: str, once: bool = False, clean: bool = False):
    """Start a flow of whole files as a streaming query with a checkpoint, a poll a micro-batch.
    The state of its files lies beside the checkpoint."""
    polls.register(spark)
    writer = spark.readStream.format("polls").load().writeStream.foreachBatch(Uploads(flow, f"{checkpoint.rstrip('/')}_files", target, deliver, clean)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flow.min_time_between_polls_millis} milliseconds")
    return writer.start()
