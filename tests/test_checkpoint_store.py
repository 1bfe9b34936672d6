import datetime as dt
import random

from pyspark.sql import functions as F

from logloom.operators import checkpoint
from logloom.operators.checkpoint_store import ROW, CheckpointStore
from logloom.plans.config import flow

DAY = dt.datetime(2024, 5, 1)


def frame(spark, rows):
    """(flow, file_id, offset, day)"""
    return spark.createDataFrame([(f, f"/{i}", i, 1000 + d, 10, o, DAY + dt.timedelta(days=d)) for f, i, o, d in rows], ROW)


def offsets(df):
    return {(r["flow"], r["file_id"]): (r["offset"], (r["last_updated"] - DAY).days) for r in df.collect()}


def test_deltas_equal_plain_upserts(spark, tmp_path):
    """Any mix of upserts and deletions reads as the plain operators would leave the table."""
    store = CheckpointStore(spark, f"file://{tmp_path}/store", buckets=4)
    assert store.read().count() == 0 and store.generation() == 0
    store.compact(F.current_timestamp())  # nothing to do
    r, plain = random.Random(1), {}
    for version in range(6):
        rows = [("f", f"{i}", r.randint(0, 99), version) for i in r.sample(range(8), 4)] + ([(None, None, version, version)] if version % 2 else [])
        monotone = version != 3
        store.upsert(frame(spark, rows), version, monotone)
        if version == 2:
            store.upsert(frame(spark, rows), version, monotone)  # a replay
        for f, i, o, d in rows:
            plain[f, i] = (max(o, plain[f, i][0]) if monotone and (f, i) in plain else o, d)
        if version == 4:
            gone = [k for k in plain if k[1] in ("1", "2")]
            store.delete(spark.createDataFrame([*gone, ("f", "none")], "flow string, file_id string"), 100)
            plain = {k: v for k, v in plain.items() if k not in gone}
            store.compact(F.lit(DAY))  # later versions follow the compacted one
            assert store.generation() == 1
        assert offsets(store.read()) == plain, version
        if version == 4:
            break
    store.upsert(frame(spark, [("f", "1", 5, 9)]), 101)
    assert offsets(store.read())["f", "1"] == (5, 9)
    wanted = spark.createDataFrame([("f", "1"), ("f", "nowhere")], "flow string, file_id string")
    assert {(x["file_id"], x["offset"]) for x in store.offset_of(wanted).collect()} == {("1", 5), ("nowhere", 0)}


def test_an_upsert_writes_only_its_rows(spark, tmp_path):
    store = CheckpointStore(spark, f"file://{tmp_path}/store", buckets=4)
    store.upsert(frame(spark, [("f", str(i), i, 0) for i in range(200)]), 0)
    store.upsert(frame(spark, [("f", "7", 700, 1), ("f", "7", 650, 2)]), 1)
    assert spark.read.parquet(f"{tmp_path}/store/gen=0/version=1").count() == 1
    assert offsets(store.read())["f", "7"] == (700, 2)
    same = checkpoint.merge(frame(spark, [("f", str(i), i, 0) for i in range(200)]), frame(spark, [("f", "7", 700, 1), ("f", "7", 650, 2)]))
    assert offsets(store.read()) == offsets(same)


def test_compaction_honours_the_time_to_live(spark, tmp_path):
    f = flow({"filePattern": "/x/*.log", "stream": "s", "checkpointTimeToLiveDays": 3})
    store = CheckpointStore.of(spark, f"file://{tmp_path}/store", f)
    store.upsert(frame(spark, [("f", "old", 1, 0), ("f", "new", 2, 8), ("f", "edge", 3, 7)]), 0)
    # a generation that isn't whole doesn't count
    (tmp_path / "store" / "gen=1" / "version=0").mkdir(parents=True)
    assert len(offsets(store.read())) == 3
    store.compact(F.lit(DAY + dt.timedelta(days=10)))
    assert offsets(store.read()) == {("f", "new"): (2, 8), ("f", "edge"): (3, 7)}
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if p.is_dir()) == ["gen=1"]
