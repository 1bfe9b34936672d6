"""Batches of records by count and bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Default and largest number of records, bytes of a buffer and of a call.
LIMITS = {"stream": {"records": 500, "max_records": 10_000, "bytes": 4 << 20, "call": 5 << 20}, "object_store": {"records": 1, "max_records": 10, "bytes": 128 << 20, "call": 128 << 20}}


def by_count(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """`batch_id` from 0 within each group: n records each."""
    if not 1 <= n <= LIMITS["stream"]["max_records"]:
        raise ValueError(f"a batch has 1 to {LIMITS['stream']['max_records']} records")
    at = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("batch_id", F.floor((at - 1) / n).cast("long"))


def by_bytes(df: DataFrame, group: list[str], order: list[str], size: str, limit: int) -> DataFrame:
    """`batch_id` from 0 within each group: a batch never has more than `limit` bytes, but for a
    single record that is larger itself. The running bytes are cut into slices of `limit`: the
    records that lie in a slice are a batch, and one that reaches beyond its slice is a batch
    alone. A null size counts as 0."""
    inorder = Window.partitionBy(*group).orderBy(*order)
    upto = inorder.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.coalesce(F.col(size), F.lit(0)).cast("long")
    end = F.sum(n).over(upto)
    first = F.floor((end - n) / limit)
    at = (2 * first + F.when((n > 0) & (F.floor((end - 1) / limit) > first), 1).otherwise(0)).cast("long")
    out = df.withColumn("_at", at).withColumn("_new", (F.col("_at") != F.lag("_at").over(inorder)).cast("long"))
    return out.withColumn("batch_id", F.coalesce(F.sum("_new").over(upto), F.lit(0).cast("long"))).drop("_at", "_new")


def flush_due(df: DataFrame, records: int, size: int, age_ms: int) -> DataFrame:
    """Buffers (n_records, n_bytes, age_ms) that are due, and why."""
    reason = F.when(F.col("n_bytes") >= size, "bytes").when(F.col("n_records") >= records, "records").when(F.col("age_ms") >= age_ms, "age")
    return df.withColumn("flush_reason", reason).where(F.col("flush_reason").isNotNull())


class TooLarge(ValueError):
    """A batch that no call may have."""


def check_size(n_bytes: int, kind: str = "stream") -> None:
    """Reject a batch that is larger than a call may be."""
    if n_bytes > LIMITS[kind]["call"]:
        raise TooLarge(f"a call has at most {LIMITS[kind]['call']} bytes, not {n_bytes}")
