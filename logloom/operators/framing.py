"""Records of text: lines, lines joined to records, offsets, headers, limits.

Offsets and limits are bytes. Framing works on rows (file_id, text) of whole texts or on lines
that already have their number, and never sorts more than one file's lines together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

#: Largest records by size class, in bytes.
MAX_RECORD = {"COMMON": 1 << 20, "ADVANCED": 5 << 20}
#: Bytes of a read buffer; no record is longer.
READ_BUFFER = 6 << 20
#: Lines that a task hands on at a time, at most.
LINES = 1 << 14


def lines(df: DataFrame, file_id: str, text: str, delimiter: str = "\n", keep_unterminated: bool = True, offsets: bool = True) -> DataFrame:
    """(file_id, line_no from 0, raw, terminated, start_offset, end_offset) of whole texts. The
    part after the last delimiter is a record only if it isn't empty; it is unterminated, and
    with `keep_unterminated` off it is held back as a tailer would hold it. A null text has no
    lines. Numbers and offsets are found where the text is, without a shuffle; without `offsets`
    (the two columns are left out then) by built-in functions alone."""
    if not offsets:
        parts = F.split(F.col(text).cast("string"), re.escape(delimiter), -1)
        out = df.select(F.col(file_id).alias("file_id"), parts.alias("_parts")).select("file_id", F.size("_parts").alias("_n"), F.posexplode("_parts").alias("line_no", "raw"))
        ended = F.col("line_no") < F.col("_n") - 1
        kept = ended | (F.col("raw") != "") if keep_unterminated else ended
        return out.where(kept).select("file_id", "line_no", "raw", ended.alias("terminated"))
    texts = df.select(F.col(file_id).alias("file_id"), F.col(text).cast("string").cast("binary").alias("text"))
    of = texts.schema["file_id"]
    names = ("line_no", "raw", "terminated", "end_offset", "start_offset")
    kinds = (IntegerType(), StringType(), BooleanType(), LongType(), LongType())
    end = delimiter.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = pc.split_pattern(batch.column(1).slice(i, 1), end).flatten()
                closed = max(len(parts) - 1, 0)
                n = closed + int(keep_unterminated and len(parts) > 0 and len(parts[-1].as_py()) > 0)
                ended = np.arange(n) < closed
                sizes = pc.binary_length(parts.slice(0, n)).to_numpy(zero_copy_only=False).astype(np.int64) + ended
                ends = np.cumsum(sizes)
                for at in range(0, n, LINES):
                    to = min(n, at + LINES)
                    # a view, as bytes that aren't valid UTF-8 stay what they are
                    raw = pa.concat_arrays([parts.slice(at, to - at)]).view(pa.string())
                    columns = [pa.array(np.arange(at, to, dtype=np.int32)), raw, pa.array(ended[at:to]), pa.array(ends[at:to]), pa.array((ends - sizes)[at:to])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(to - at, i))), *columns], names=["file_id", *names])

    return texts.mapInArrow(run, StructType([of, *map(StructField, names, kinds)]))


def skip_header(df: DataFrame, n: int) -> DataFrame:
    """Without the first n lines of each file."""
    return df.where(F.col("line_no") >= n) if n > 0 else df


def drop_lone_delimiters(df: DataFrame) -> DataFrame:
    """Without empty terminated records that more records of the file follow."""
    last = F.max("line_no").over(Window.partitionBy("file_id"))
    return df.withColumn("_last", last).where((F.col("raw") != "") | ~F.col("terminated") | (F.col("line_no") == F.col("_last"))).drop("_last")


def multi_line(df: DataFrame, start_pattern: str) -> DataFrame:
    """Lines joined to records: one begins at each line whose beginning matches, the file's
    first line always belongs to the first."""
    begins = F.col("raw").rlike(f"^(?:{start_pattern})")
    upto = Window.partitionBy("file_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = df.withColumn("record_no", F.sum(F.when(begins & (F.col("line_no") > 0), 1).otherwise(0)).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("line_no", "raw", "terminated")))
    out = numbered.groupBy("file_id", "record_no").agg(parts.alias("parts"), F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))
    return out.select(
        "file_id",
        "record_no",
        F.array_join(F.transform("parts", lambda p: p["raw"]), "\n").alias("raw"),
        F.element_at("parts", -1)["terminated"].alias("terminated"),
        "start_offset",
        "end_offset",
    )


def with_delimiter(raw: Column, terminated: Column, delimiter: str, remain: bool) -> Column:
    """The payload of a record: its delimiter stays only with `remain`."""
    return F.concat(raw, F.when(terminated, delimiter).otherwise("")) if remain else raw


def truncated(data: Column, limit: int, terminator: str | None = None) -> Column:
    """At most `limit` bytes; a cut record that ended with the terminator ends with it again."""
    raw = data.cast("binary")
    if terminator is None:
        return F.when(F.octet_length(raw) > limit, F.substring(raw, 1, limit)).otherwise(raw)
    end = F.lit(terminator).cast("binary")
    cut = F.when(F.endswith(raw, end), F.concat(F.substring(raw, 1, limit - len(terminator.encode())), end)).otherwise(F.substring(raw, 1, limit))
    return F.when(F.octet_length(raw) > limit, cut).otherwise(raw)


def runaway(df: DataFrame, buffer: int) -> DataFrame:
    """A record larger than the buffer becomes its first `buffer` bytes, the rest is discarded;
    `discarded` counts these bytes."""
    raw = F.col("raw").cast("binary")
    return df.withColumn("discarded", F.greatest(F.octet_length(raw) - buffer, F.lit(0)).cast("long")).withColumn("raw", F.when(F.octet_length(raw) > buffer, F.substring(raw, 1, buffer)).otherwise(raw))


def decoded(data: Column, encoding: str) -> Column:
    """Bytes as text; what isn't valid UTF-8 becomes U+FFFD and doesn't end the query."""
    if encoding.upper().replace("-", "") == "UTF8":
        return F.make_valid_utf8(data.cast("string"))
    return F.decode(data, encoding)
