"""Metrics: rows (dims, name, unit, value) to statistics, totals and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units, and bytes behind from which status is info or warning.
UNITS = ("None", "Count", "Milliseconds", "Seconds", "Bytes", "Percent")
INFO_BEHIND, WARN_BEHIND = 30 << 20, 60 << 20


def statistics(rows: DataFrame, dims: list[str]) -> DataFrame:
    """min, max, count, sum and avg of each metric; a name with two units is an error."""
    units = rows.groupBy(*dims, "name").agg(F.count_distinct("unit").alias("n"), *stats())
    bad = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("units differ for "), F.col("name"))))
    return units.select(*dims, "name", F.coalesce(bad.cast("string"), F.col("unit")).alias("unit"), "min", "max", "count", "sum", "avg")


def stats() -> list[Column]:
    v = F.col("value")
    return [F.min("unit").alias("unit"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("count"), F.sum(v).alias("sum"), F.avg(v).alias("avg")]


def merged(sets: DataFrame, dims: list[str]) -> DataFrame:
    """Statistic sets combined."""
    return sets.groupBy(*dims, "name", "unit").agg(F.min("min").alias("min"), F.max("max").alias("max"), F.sum("count").alias("count"), F.sum("sum").alias("sum")).withColumn("avg", F.col("sum") / F.col("count"))


def totals(flows: DataFrame, columns: list[str]) -> DataFrame:
    return flows.agg(*[F.sum(c).alias(c) for c in columns])


def by_pattern(rows: DataFrame, pattern: str, fallback: float = 0.0) -> DataFrame:
    """The value of the first name in order that matches whole, or the fallback."""
    hit = rows.where(F.col("name").rlike(rf"^(?:{pattern})\z"))
    return hit.agg(F.coalesce(F.min(F.struct("name", "value"))["value"], F.lit(fallback)).alias("value"))


def lag(files: DataFrame, flow: str = "flow") -> DataFrame:
    """Files and bytes behind by flow."""
    unread = F.greatest(F.col("size") - F.col("last_offset"), F.lit(0))
    return files.groupBy(flow).agg(F.sum(unread).alias("bytes_behind"), F.sum((unread > 0).cast("long")).alias("files_behind"))


def status(behind: Column) -> Column:
    return F.when(behind >= WARN_BEHIND, "WARN").when(behind >= INFO_BEHIND, "INFO").otherwise("DEBUG")
