"""Snapshots of files: order, and what changed between two of them.

FILE_SNAPSHOT: file_id, path, name, mtime_ms, size, last_offset, header, header_len,
header_sha256, is_deleting, last_check_ms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digits in which the length of a run of digits is written.
LENGTH_DIGITS = 10


def natural_key(name: Column) -> Column:
    """A key whose order is that of names with numbers compared by value: each run of digits
    loses its leading zeros and has its length put in front, so that the longer number wins."""
    runs = F.regexp_extract_all(name, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))

    def keyed(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+(?=[0-9])", "")
        return F.when(run.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), LENGTH_DIGITS, "0"), digits)).otherwise(run)

    return F.array_join(F.transform(runs, keyed), "")


def ordered(files: DataFrame, newest_first: bool = False) -> DataFrame:
    """By time, then natural name: a range-partitioned sort."""
    time = F.col("mtime_ms").desc() if newest_first else F.col("mtime_ms").asc()
    return files.orderBy(time, natural_key(F.col("name")))


def same_header(a: Column, b: Column, a_hash: Column | None = None) -> Column:
    """Whether two headers agree as far as both go: by bytes, or by the digest of a prefix
    where only that is known. Nothing to compare agrees."""
    n = F.least(F.octet_length(a), F.octet_length(b))
    equal = F.coalesce(F.substring(a.cast("binary"), F.lit(1), n) == F.substring(b.cast("binary"), F.lit(1), n), F.lit(True))
    if a_hash is None:
        return F.when(F.coalesce(n, F.lit(0)) <= 0, True).otherwise(equal)
    return F.when(a.isNotNull(), F.when(n <= 0, True).otherwise(equal)).otherwise(F.coalesce(a_hash == F.sha2(b.cast("binary"), 256), F.lit(True)))


def matched(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and new rows of a file id side by side, as structs `o` and `n`."""
    o = old.select("file_id", F.struct(*old.columns).alias("o"))
    n = new.select("file_id", F.struct(*new.columns).alias("n"))
    return o.join(n, "file_id", "full_outer")


def appendable_actions(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_id, action, offset) for files that grow: CopyAndTruncate, New, ReNew, Shrink,
    Resume, Carry, Deleting, Deleted; the first that holds."""
    both = matched(old, new)
    header = same_header(F.col("o.header"), F.col("n.header"))
    known = F.col("o").isNotNull() & F.col("n").isNotNull()
    action = (
        F.when(~header, "ReNew")
        .when(F.col("n.size") < F.col("o.size"), "Shrink")
        .when((F.col("n.size") > F.col("o.size")) | (F.col("o.last_offset") < F.col("o.size")), "Resume")
        .otherwise("Carry")
    )
    kept = both.where(known).select("file_id", action.alias("action"), F.col("o.last_offset").alias("old_offset"))
    kept = kept.select("file_id", "action", F.when(F.col("action").isin("ReNew", "Shrink"), 0).otherwise(F.col("old_offset")).cast("long").alias("offset"))
    gone = both.where(F.col("n").isNull()).select("file_id", F.when(F.coalesce(F.col("o.is_deleting"), F.lit(False)), "Deleted").otherwise("Deleting").alias("action"), F.col("o.last_offset").cast("long").alias("offset"))
    # truncated: smaller, or without counterpart
    truncated = both.where(F.col("o").isNotNull() & (F.col("n").isNull() | (F.col("n.size") < F.col("o.size")))).select("o.*")
    fresh = both.where(F.col("o").isNull()).select("n.*")
    # a copy begins like its original: candidates meet under the digest of the shorter header,
    # which for a copy that is at least as large is the original's
    lengths = truncated.where(F.octet_length("header") > 0).select(F.octet_length("header").alias("len")).distinct()
    prefixes = fresh.select("file_id", "size", "header").join(F.broadcast(lengths), F.octet_length("header") >= F.col("len")).select("file_id", "size", F.sha2(F.substring(F.col("header").cast("binary"), F.lit(1), F.col("len")), 256).alias("digest"))
    origin = truncated.where(F.octet_length("header") > 0).select(F.sha2(F.col("header").cast("binary"), 256).alias("digest"), F.col("size").alias("old_size"), F.col("last_offset").alias("old_offset"), F.col("file_id").alias("origin"))
    # two origins tell whether there is just one: of a header that many files share, such as a
    # table's first line, only the two smallest files are looked at
    smallest = Window.partitionBy("digest").orderBy("old_size", "origin")
    origin = origin.withColumn("_n", F.row_number().over(smallest)).where("_n <= 2").drop("_n")
    copies = prefixes.join(origin, "digest").where("old_size <= size").groupBy("file_id").agg(F.countDistinct("origin").alias("origins"), F.min("old_offset").alias("old_offset")).where("origins = 1")
    # the only new file and the only truncated one, whose header is empty
    sole = fresh.agg(F.count("*").alias("new_n"), F.min("file_id").alias("file_id")).where("new_n = 1").join(
        truncated.agg(F.count("*").alias("old_n"), F.min("last_offset").alias("sole_offset"), F.max(F.octet_length("header")).alias("head")).where("old_n = 1 AND coalesce(head, 0) = 0"), F.lit(True)
    ).select("file_id", "sole_offset")
    news = fresh.select("file_id").join(copies, "file_id", "left").join(F.broadcast(sole), "file_id", "left")
    offset = F.coalesce("old_offset", "sole_offset")
    news = news.select("file_id", F.when(offset.isNotNull(), "CopyAndTruncate").otherwise("New").alias("action"), F.coalesce(offset, F.lit(0)).cast("long").alias("offset"))
    return kept.unionByName(gone).unionByName(news)


def stable_files(old: DataFrame, new: DataFrame, now_ms: int, wait_ms: int, ignore_empty: bool = True) -> DataFrame:
    """(file_id, state, last_offset, last_check_ms) for files taken whole once they have
    stopped to change: New, Upload, Empty, Changed, Waiting."""
    both = matched(old, new).where(F.col("n").isNotNull())
    same = (F.col("o.size") == F.col("n.size")) & (F.col("o.mtime_ms") == F.col("n.mtime_ms"))
    due = same & (F.col("o.last_offset") == -1) & (F.lit(now_ms) - F.col("o.last_check_ms") > wait_ms)
    unseen = F.col("o").isNull() | (F.col("o.last_check_ms") == -1)
    empty = F.lit(ignore_empty) & (F.col("n.size") == 0)
    state = F.when(unseen, "New").when(due & empty, "Empty").when(due, "Upload").when(~same, "Changed").otherwise("Waiting")
    out = both.select("file_id", state.alias("state"), "o", "n")
    again = F.col("state").isin("New", "Changed")
    return out.select(
        "file_id",
        "state",
        F.when(again, -1).when(F.col("state").isin("Upload", "Empty"), 0).otherwise(F.col("o.last_offset")).cast("long").alias("last_offset"),
        F.when(again, now_ms).otherwise(F.col("o.last_check_ms")).cast("long").alias("last_check_ms"),
    )


def must_refresh(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row (must_refresh): whether paths, ids or sizes call for a new snapshot; growth
    counts for all but the newest file."""
    current = old.agg(F.max(F.struct("mtime_ms", "path")).alias("m")).select(F.col("m.path").alias("current"))
    both = old.select("path", F.col("file_id").alias("oid"), F.col("size").alias("osize")).join(new.select("path", F.col("file_id").alias("nid"), F.col("size").alias("nsize")), "path", "full_outer").join(F.broadcast(current), F.lit(True), "left")
    changed = F.col("oid").isNull() | F.col("nid").isNull() | (F.col("oid") != F.col("nid")) | (F.col("nsize") < F.col("osize")) | ((F.col("nsize") > F.col("osize")) & (F.col("path") != F.col("current")))
    return both.agg(F.coalesce(F.max(changed), F.lit(False)).alias("must_refresh"))


def positions(files: DataFrame) -> DataFrame:
    """`position` of each file of its directory by time and natural name."""
    w = Window.partitionBy("directory").orderBy("mtime_ms", natural_key(F.col("name")))
    return files.withColumn("position", F.row_number().over(w))
