"""Reading tables and keeping intermediate results where every executor sees them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: What a task unpacks into Python objects at a time, in bytes.
SLICE_BYTES = 4 << 20
#: With it the shuffle files of a write are deleted at its end.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How large a batch may become that is sent to Python, and what it is held to.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a temporary folder of this machine
    serves as long as the executors are on it too (master `local`); a cluster must name one."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        checkpoint = sc._jsc.sc().getCheckpointDir()
        if checkpoint.isDefined():
            where = checkpoint.get()
        elif sc.master == "local" or sc.master.startswith("local["):
            where = "file://" + tempfile.mkdtemp(prefix="logloom-")
            sc.setCheckpointDir(where)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return where.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: this cuts the
    lineage and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")  # or they stay on disk until the driver collects garbage
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_END)
        else:
            spark.conf.set(SHUFFLES_END, before)
    return spark.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends Python batches of BATCH_BYTES, unless it has a size of its own.
    Both sides hold whole batches beside the heap, two or three times over while they are made;
    Spark's 10,000 documents a batch are tens of megabytes. Results don't depend on it."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most `limit` bytes of a text or binary column, a row at least."""
    at, size, lengths = 0, 0, pc.binary_length(batch.column(column)).to_pylist()
    for n, length in enumerate(lengths):
        if size + (length or 0) > limit and n > at:
            yield batch.slice(at, n - at)
            at, size = n, 0
        size += length or 0
    if at < batch.num_rows:
        yield batch.slice(at)
