"""Listing and batch reading of files by a directory and a glob of the last component."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logloom.operators.framing import decoded, lines

ARCHIVES = r"\.(gz|bz2|zip|tar)$"


def split_pattern(pattern: str) -> tuple[str, str]:
    """(directory, glob); a separator at the end means all files."""
    if pattern.endswith("/"):
        return pattern.rstrip("/") or "/", "*"
    p = PurePosixPath(pattern)
    directory = pattern[: -len(p.name)].rstrip("/") if p.name else pattern
    return directory or "/", p.name or "*"


def wanted(name: Column, suffix: str = ".COMPLETED", archives: bool = False) -> Column:
    """Names that are collected: not hidden, not done with, and no archives of stream flows."""
    keep = ~F.startswith(name, F.lit(".")) & ~F.endswith(name, F.lit(suffix))
    return keep if archives else keep & ~F.lower(name).rlike(ARCHIVES)


def listing(spark: SparkSession, pattern: str, recursive: bool = False, suffix: str = ".COMPLETED", archives: bool = False, newer_than_ms: int | None = None) -> DataFrame:
    """(file_id, path, name, size, mtime_ms) of the files, without their content."""
    directory, glob = split_pattern(pattern)
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(directory)
    name = F.element_at(F.split("path", "/"), -1)
    out = df.select(F.col("path").alias("file_id"), "path", name.alias("name"), F.col("length").alias("size"), F.unix_millis("modificationTime").alias("mtime_ms"))
    out = out.where(wanted(F.col("name"), suffix, archives))
    return out if newer_than_ms is None else out.where(F.col("mtime_ms") > newer_than_ms)


def text_records(spark: SparkSession, pattern: str, delimiter: str = "\n", recursive: bool = False, suffix: str = ".COMPLETED", encoding: str = "UTF-8") -> DataFrame:
    """(file_path, raw) of delimited records, read by splits: for transforms that need neither
    offsets nor the order of lines. The delimiter is given, so that \\r stays in a record."""
    directory, glob = split_pattern(pattern)
    df = spark.read.option("lineSep", delimiter).option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).option("encoding", encoding).text(directory)
    out = df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("raw"))
    return out.where(wanted(F.col("name"), suffix)).drop("name")


def numbered_blocks(blocks: DataFrame, delimiter: str) -> DataFrame:
    """Lines (path, block, size, raw), in order within each block, with their number and their
    first byte within the block. The order is that of the scan: a task reads blocks one after
    another, so running sums need no shuffle."""
    end = len(delimiter.encode())
    kept = blocks.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lines_before, bytes_before = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path, block = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            coded = path.dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (block[1:] != block[:-1])]))
            sizes = pc.binary_length(batch.column(3).cast(pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64) + end
            upto = np.concatenate([[0], np.cumsum(sizes)])
            number, first = np.arange(n, dtype=np.int64), upto[:-1].copy()
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), n], strict=True):
                own = (coded.dictionary[int(code[lo])].as_py(), int(block[lo]))
                if own != at:
                    at, lines_before, bytes_before = own, 0, 0
                number[lo:hi] += lines_before - lo
                first[lo:hi] += bytes_before - upto[lo]
                lines_before, bytes_before = lines_before + hi - lo, bytes_before + int(upto[hi] - upto[lo])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(first)], names=[*batch.schema.names, "line", "first"])

    return blocks.mapInArrow(run, StructType([*kept, StructField("line", LongType()), StructField("first", LongType())]))


def split_lines(spark: SparkSession, pattern: str, delimiter: str = "\n", recursive: bool = False, suffix: str = ".COMPLETED", newer_than_ms: int | None = None) -> DataFrame:
    """The rows of framing.lines over files of any size: Spark reads them in blocks that begin
    anew at a delimiter, so a file is read by many tasks. How many lines and bytes each block
    has is counted first; their sums over the blocks before it give numbers and offsets. Both
    passes see the files as they were listed. Offsets are bytes of the file, and raw holds its
    bytes as they are. line_no is long, as such a file may have more lines than an int holds."""
    directory, glob = split_pattern(pattern)
    df = spark.read.option("lineSep", delimiter).option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).text(directory)
    meta = lambda c: F.col(f"_metadata.{c}")
    df = df.where(wanted(meta("file_name"), suffix))
    if newer_than_ms is not None:
        df = df.where(F.unix_millis(meta("file_modification_time")) > newer_than_ms)
    blocks = df.select(meta("file_path").alias("path"), meta("file_block_start").alias("block"), meta("file_size").alias("size"), F.col("value").alias("raw"))
    counts = blocks.groupBy("path", "block").agg(F.count("*").alias("lines"), F.sum(F.octet_length("raw") + len(delimiter.encode())).alias("bytes"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("path", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("lines", "bytes")])
    out = numbered_blocks(blocks, delimiter).join(starts, ["path", "block"])
    start = F.col("first") + F.col("bytes_before")
    end = start + F.octet_length("raw") + len(delimiter.encode())
    return out.select(F.col("path").alias("file_id"), (F.col("line") + F.col("lines_before")).alias("line_no"), "raw", (end <= F.col("size")).alias("terminated"), start.alias("start_offset"), F.least(end, F.col("size")).alias("end_offset"))


def framed_records(spark: SparkSession, pattern: str, delimiter: str = "\n", recursive: bool = False, suffix: str = ".COMPLETED", encoding: str = "UTF-8", newer_than_ms: int | None = None) -> DataFrame:
    """Numbered lines with byte offsets (see framing.lines). Files in UTF-8 are read by splits.
    In other encodings a delimiter can't be told from bytes alone: there a file is a row and
    must fit a task."""
    if encoding.upper().replace("-", "") == "UTF8":
        return split_lines(spark, pattern, delimiter, recursive, suffix, newer_than_ms)
    directory, glob = split_pattern(pattern)
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(directory)
    df = df.where(wanted(F.element_at(F.split("path", "/"), -1), suffix))
    if newer_than_ms is not None:
        df = df.where(F.unix_millis("modificationTime") > newer_than_ms)
    return lines(df.select("path", decoded(F.col("content"), encoding).alias("text")), "path", "text", delimiter)


def whole_files(spark: SparkSession, pattern: str, recursive: bool = False, suffix: str = ".COMPLETED") -> DataFrame:
    """One row a file, its payload empty and its length that of the file; archives too."""
    files = listing(spark, pattern, recursive, suffix, archives=True)
    return files.select("file_id", F.col("path").alias("file_path"), F.lit(0).cast("long").alias("start_offset"), F.col("size").alias("end_offset"), F.lit("").alias("data"))
