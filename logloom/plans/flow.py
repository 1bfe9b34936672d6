"""A flow as a DataFrame or a streaming query: read, convert, key, truncate."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import converters, keys
from logloom.operators import framing
from logloom.plans import whole
from logloom.plans.config import Config, Flow
from logloom.sources import files
from logloom.streaming import published, sink, state, tail


def records(rows: DataFrame, flow: Flow) -> DataFrame:
    """(file_id, file_path, start_offset, end_offset, raw text, terminated) -> RECORD rows: what
    a converter drops is gone, what it fails on goes as it came, what is too long is cut. How
    many were processed, skipped and failed is observed under the flow's id."""
    # the delimiter is still there while converters see the text, as they keep a line break
    text = F.concat(F.col("raw"), F.when(F.col("terminated"), flow.record_delimiter).otherwise(""))
    data, failed = converters.guarded(text, flow.converters)
    rows = rows.withColumn("_data", data)
    rows = rows.observe(f"records {flow.id}", F.count("_data").alias("processed"), F.count_if(F.col("_data").isNull()).alias("skipped"), F.count_if(failed).alias("failed"))
    rows = rows.where(F.col("_data").isNotNull())
    end = F.lit(flow.record_delimiter)
    if not flow.remain_record_delimiter:
        rows = rows.withColumn("_data", F.when(F.endswith("_data", end), F.substring("_data", F.lit(1), F.length("_data") - 1)).otherwise(F.col("_data")))
    terminator = (flow.truncated_record_terminator or flow.record_delimiter) if flow.remain_record_delimiter else None
    data = framing.truncated(F.col("_data"), flow.max_record_bytes, terminator)
    rows = rows.withColumn("data", data).withColumn("truncated", F.octet_length("_data") > flow.max_record_bytes)
    return rows.select("file_id", "file_path", "start_offset", "end_offset", "raw", "data", "truncated", keys.key(flow.partition_key_option, F.col("data"), F.col("file_path")).alias("partition_key"))


def batch(spark: SparkSession, flow: Flow) -> DataFrame:
    """All records of the files that are there now."""
    if not flow.file_appendable and flow.kind == "object_store":
        return files.whole_files(spark, flow.file_pattern, flow.directory_recursion, flow.file_suffix)
    recent = int(time.time() * 1000) - 1000 * flow.ignore_not_updated_file_seconds if flow.ignore_not_updated_file_seconds >= 0 else None
    rows = files.framed_records(spark, flow.file_pattern, flow.record_delimiter, flow.directory_recursion, flow.file_suffix, flow.file_encoding, recent)
    rows = framing.skip_header(rows, flow.skip_header_lines)
    if flow.multi_line_start_pattern:
        rows = framing.multi_line(rows, flow.multi_line_start_pattern)
    elif flow.miss_last_record_delimiter:
        rows = framing.drop_lone_delimiters(rows)
    # a record that is longer than the buffer is cut, as in a stream, and its delimiter is gone
    rows = framing.runaway(rows, framing.READ_BUFFER).withColumn("terminated", F.col("terminated") & (F.col("discarded") == 0))
    rows = rows.withColumn("raw", framing.decoded(F.col("raw"), "UTF-8"))
    return records(rows.withColumn("file_path", F.col("file_id")), flow)


def stream(spark: SparkSession, flow: Flow, running: bool = False, offset_log: str = "") -> DataFrame:
    """Records as files grow. With `running` what isn't complete stays in the state store:
    records of several lines are joined across micro-batches, and rows are held until the flow's buffer is due
    (see streaming.state), in as many lanes as the flow has sending threads. With `offset_log` the
    offsets are kept as deltas in that folder, which belongs to one query."""
    tail.register(spark)
    reader = spark.readStream.format("tail").option("path", flow.file_pattern).option("delimiter", flow.record_delimiter)
    reader = reader.option("startAtEnd", str(flow.initial_position == "END_OF_FILE").lower()).option("recursive", str(flow.directory_recursion).lower()).option("suffix", flow.file_suffix).option("skipHeaderLines", str(flow.skip_header_lines)).option("headerBytes", str(flow.header_bytes_length)).option("order", flow.order)
    if flow.miss_last_record_delimiter or not flow.file_appendable:
        reader = reader.option("releaseMs", str(flow.max_file_checking_millis))
    if flow.miss_last_record_delimiter:
        reader = reader.option("skipLoneDelimiters", "true")
    if flow.multi_line_start_pattern and not running:
        reader = reader.option("multiLineStart", flow.multi_line_start_pattern)
    if flow.ignore_not_updated_file_seconds >= 0:
        reader = reader.option("ignoreOlderSeconds", str(flow.ignore_not_updated_file_seconds))
    if offset_log:
        reader = reader.option("offsetLog", offset_log)
    rows = reader.load()
    if flow.multi_line_start_pattern and running:
        release = flow.max_file_checking_millis if flow.miss_last_record_delimiter or not flow.file_appendable else -1
        rows = state.multi_line(rows, flow.multi_line_start_pattern, flow.record_delimiter, framing.READ_BUFFER, release)
    rows = records(rows.withColumn("raw", framing.decoded(F.col("raw"), flow.file_encoding)), flow)
    if not running:
        return rows
    limits = state.Limits(flow.max_buffer_size_records, flow.max_buffer_size_bytes, flow.max_buffer_age_millis)
    return state.buffered(rows.withColumn("flow", F.lit(flow.id)), ["flow"], ["file_path", "start_offset"], limits, lanes=flow.sending_threads, lane_by="file_id")


def delivery(flow: Flow, sender: sink.Sender, results: str, attempts: int = 10) -> sink.Delivery:
    """The flow's delivery: its batches, threads, backoff and log level."""
    return sink.Delivery(sender, results, flow.max_buffer_size_records, flow.max_buffer_size_bytes, flow.sending_threads, attempts, flow.retry_initial_backoff_millis, flow.retry_max_backoff_millis, flow.log_level)


def offset_log(checkpoint: str) -> str:
    """The folder of a query's offset log, within its checkpoint so that both go together; none where
    the checkpoint is on a file system that Python can't write to."""
    path = re.sub(r"^file:/+", "/", checkpoint)
    return "" if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"{path.rstrip('/')}/tail"


def start(spark: SparkSession, flow: Flow, deliver: Callable[[DataFrame, int], None] | published.Published, checkpoint: str, once: bool = False, running: bool = False):
    """Start the flow's streaming query; a micro-batch is due at the age of a buffer. With
    `running` the flow's buffers and open records outlive micro-batches; such a query has
    timers, so it doesn't end by itself and can't be run `once`. Results are published as they are
committed where `deliver` is a Published sink."""
    if running and isinstance(deliver, published.Published):
        raise ValueError("running buffers are sent in order, which needs a foreachBatch delivery")
    if running:
        if once:
            raise ValueError("a flow with running buffers can't be run once: what its buffers hold would stay there")
        with state.state_store(spark):
            return stream(spark, flow, running=True, offset_log=offset_log(checkpoint)).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(processingTime=f"{flow.min_time_between_polls_millis} milliseconds").start()
    rows = stream(spark, flow, offset_log=offset_log(checkpoint))
    writer = deliver.writer(rows) if isinstance(deliver, published.Published) else rows.writeStream.foreachBatch(deliver)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flow.max_buffer_age_millis} milliseconds")
    return writer.start()


def start_all(spark: SparkSession, config: Config, deliver: Callable[[Flow], Callable[[DataFrame, int], None]], checkpoints: str, once: bool = False, target: Callable[[Flow], str] | None = None, clean: bool = False) -> dict:
    """Start the queries of all flows: flow id -> query. Each has a checkpoint folder of its own,
    named by a digest of its id, and the delivery made for it. Flows of whole files are copied to
    the folder that `target` names for them, cleaned up with `clean`; without `target` they
    aren't started."""
    folder = lambda f: f"{checkpoints.rstrip('/')}/{hashlib.sha256(f.id.encode()).hexdigest()[:16]}"
    out = {f.id: start(spark, f, deliver(f), folder(f), once) for f in config.flows if f.file_appendable}
    if target is not None:
        out |= {f.id: whole.start(spark, f, deliver(f), folder(f), target(f), once, clean) for f in config.flows if not f.file_appendable}
    return out


def all_batches(spark: SparkSession, config: Config) -> DataFrame:
    """The records of all flows, with the flow's id."""
    out = None
    for f in config.flows:
        df = batch(spark, f).withColumn("flow", F.lit(f.id))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no flow is enabled")
    return out
