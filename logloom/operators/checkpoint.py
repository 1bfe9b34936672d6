"""Checkpoints: (flow, path, file_id, mtime_ms, size, offset, last_updated), keyed by flow and file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("flow", "file_id")


def commit_offsets(records: DataFrame) -> DataFrame:
    """The largest end offset of each file in a batch of records."""
    return records.groupBy("file_id").agg(F.max("end_offset").alias("offset"))


def merge(old: DataFrame, new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Upsert that never moves an offset back: the newest facts, the largest offset. Rows of
    `new` without an old one are inserted only for `existing` files, if these are given."""
    if existing is not None:
        ids = existing.select("file_id").distinct()
        new = new.join(old.select(*KEY).unionByName(new.join(ids, "file_id", "left_semi").select(*KEY)).distinct(), list(KEY), "left_semi")
    return latest_facts(old.withColumn("_order", F.lit(0)).unionByName(new.withColumn("_order", F.lit(1))), F.max("offset"))


def overwrite(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert that takes the new row as it is."""
    rows = old.withColumn("_order", F.lit(0)).unionByName(new.withColumn("_order", F.lit(1)))
    return latest_facts(rows, F.max_by("offset", F.struct("_order", "last_updated")))


def latest_facts(rows: DataFrame, offset: Column) -> DataFrame:
    """One row a key by hash aggregation, which combines before the shuffle."""
    newest = F.struct("_order", "last_updated")
    facts = [c for c in rows.columns if c not in (*KEY, "offset", "_order")]
    return rows.groupBy(*KEY).agg(*[F.max_by(c, newest).alias(c) for c in facts], offset.alias("offset")).select(*[c for c in rows.columns if c != "_order"])


def latest_per_file(checkpoints: DataFrame) -> DataFrame:
    """The row of latest time of each file, and of equal times that of the last path (of equal
    paths the largest of the other columns). Rows of a key are combined before the shuffle."""
    facts = [c for c in checkpoints.columns if c not in (*KEY, "mtime_ms", "path")]
    newest = F.max(F.struct("mtime_ms", "path", *facts)).alias("_row")
    return checkpoints.groupBy(*KEY).agg(newest).select(*KEY, "_row.*").select(*checkpoints.columns)


def latest_of_flow(checkpoints: DataFrame, flow: str) -> DataFrame:
    return checkpoints.where(F.col("flow") == flow).orderBy(F.col("last_updated").desc(), "file_id").limit(1)


def offset_of(checkpoints: DataFrame, wanted: DataFrame) -> DataFrame:
    """(flow, file_id, offset) of the wanted keys, 0 where there is no checkpoint."""
    return wanted.join(checkpoints.select(*KEY, "offset"), list(KEY), "left").select(*KEY, F.coalesce("offset", F.lit(0)).cast("long").alias("offset"))


def dump(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.orderBy(F.col("last_updated").desc())


def purge(checkpoints: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Without rows that weren't updated for so many days."""
    return checkpoints.where(F.col("last_updated") >= now - F.make_interval(days=F.lit(days)))


def delete_oldest(checkpoints: DataFrame, files: DataFrame) -> DataFrame:
    """Without the oldest row (by time, then path) of each of the files."""
    w = Window.partitionBy(*KEY).orderBy("mtime_ms", "path")
    marked = checkpoints.withColumn("_n", F.row_number().over(w)).join(files.select(*KEY).distinct().withColumn("_hit", F.lit(True)), list(KEY), "left")
    return marked.where("_n > 1 OR _hit IS NULL").drop("_n", "_hit")
