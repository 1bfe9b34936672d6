"""A checkpoint table that grows by deltas: merge on read, compaction that purges.

Layout: `<path>/gen=G/version=V/bucket=B/*.parquet`. An upsert or a deletion writes only its own
rows, as a version, by bucket of the key; a version that is written again (a replayed micro-batch) overwrites
itself. Reading takes the newest complete generation and folds each key's changes in the order
of their versions. Compaction writes the folded rows, without those beyond their time to live, as
the first version of the next generation, which counts once it is whole; then the older one
is deleted. One writer at a time; readers need no lock, but one that is at work while a compaction
ends must read again.

Rows are (flow, path, file_id, mtime_ms, size, offset, last_updated); a null flow or file_id is a
key like others. Of several rows of a key in one change the last updated counts, and the
largest offset where offsets are monotone. Reading an empty store gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import checkpoint

ROW = "flow string, path string, file_id string, mtime_ms long, size long, offset long, last_updated timestamp"
FACTS = ("path", "mtime_ms", "size", "last_updated")
#: What a change does with a key.
MERGE, PUT, DELETE = "merge", "put", "delete"


class CheckpointStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, days: int = 7):
        self.spark, self.path, self.buckets, self.days = spark, path.rstrip("/"), buckets, days

    @classmethod
    def of(cls, spark: SparkSession, path: str, flow) -> CheckpointStore:
        """The store of a flow, with its time to live."""
        return cls(spark, path, days=flow.checkpoint_time_to_live_days)

    # --- files

    def _names(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the complete folders `prefix=N` in `folder`."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(where):
            return []
        found = [s.getPath() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(f"{prefix}=")]
        if prefix == "version":
            found = [p for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().partition("=")[2]) for p in found)

    def _delete(self, folder: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def generation(self) -> int:
        """The newest generation with a complete version; 0 in a new store."""
        return max((g for g in self._names(self.path, "gen") if self._names(f"{self.path}/gen={g}", "version")), default=0)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*checkpoint.KEY), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, change: str, generation: int, version: int) -> None:
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spark.createDataFrame([], ROW).schema])
        out = checkpoint.latest_facts(out.withColumn("_order", F.lit(0)), F.max("offset") if change == MERGE else F.max_by("offset", F.struct("_order", "last_updated")))
        out = out.withColumn("change", F.lit(change)).withColumn("bucket", self._bucket())
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/gen={generation}/version={version}")

    # --- changes

    def upsert(self, rows: DataFrame, version: int, monotone: bool = True) -> None:
        """Newest facts; the largest offset, or without `monotone` the new one."""
        self._write(rows, MERGE if monotone else PUT, self.generation(), version)

    def delete(self, keys: DataFrame, version: int) -> None:
        """Forget the keys (flow, file_id)."""
        none = {f.name: F.lit(None).cast(f.dataType) for f in self.spark.createDataFrame([], ROW).schema if f.name not in checkpoint.KEY}
        self._write(keys.select(*checkpoint.KEY).withColumns(none), DELETE, self.generation(), version)

    def compact(self, now: Column) -> None:
        """Fold all changes into one version, without rows that weren't updated for `days`."""
        old = self.generation()
        versions = self._names(f"{self.path}/gen={old}", "version")
        if versions:
            kept = checkpoint.purge(self.read(), now, self.days)
            self._write(kept.repartition(self.buckets, self._bucket()), PUT, old + 1, versions[-1])
            for g in self._names(self.path, "gen"):
                if g <= old:
                    self._delete(f"{self.path}/gen={g}")

    # --- reading

    def changes(self) -> DataFrame | None:
        folder = f"{self.path}/gen={self.generation()}"
        versions = self._names(folder, "version")
        if not versions:
            return None
        return self.spark.read.option("basePath", folder).schema(f"{ROW}, change string, version long, bucket int").parquet(*[f"{folder}/version={v}" for v in versions])

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows as they stand; only of some buckets, if given."""
        rows = self.changes()
        if rows is None:
            return self.spark.createDataFrame([], ROW)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        change = F.struct("version", "change", "offset", F.struct(*FACTS).alias("facts"))
        each = rows.groupBy(*checkpoint.KEY).agg(F.array_sort(F.collect_list(change)).alias("changes"))
        kind = rows.select(change.alias("c")).schema["c"].dataType["facts"].dataType
        nothing = F.struct(F.lit(None).cast("long").alias("offset"), F.lit(None).cast(kind).alias("facts"))

        def fold(at: Column, c: Column) -> Column:
            merged = F.when(c["change"] == MERGE, F.greatest(at["offset"], c["offset"])).otherwise(c["offset"])
            return F.when(c["change"] == DELETE, nothing).otherwise(F.struct(merged.alias("offset"), c["facts"].alias("facts")))

        out = each.select(*checkpoint.KEY, F.aggregate("changes", nothing, fold).alias("at")).where("at.facts IS NOT NULL")
        return out.select("flow", F.col("at.facts.path"), "file_id", F.col("at.facts.mtime_ms"), F.col("at.facts.size"), F.col("at.offset"), F.col("at.facts.last_updated"))

    def offset_of(self, wanted: DataFrame) -> DataFrame:
        """(flow, file_id, offset) of the wanted keys, 0 where there is none; reads only their buckets."""
        buckets = [r[0] for r in wanted.select(self._bucket().alias("b")).distinct().collect()]  # at most self.buckets
        return checkpoint.offset_of(self.read(buckets), wanted)
