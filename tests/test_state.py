import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from logloom.operators import framing
from logloom.sources import files
from logloom.streaming import state

ROWS = "flow string, file_id string, at long, arrived long, data binary"


def run(spark, source, schema, make, out, checkpoint, rows, until=lambda: True):
    """Run the query until it has read so many rows and `until` holds, then stop it. (A query
    with timers always has another micro-batch, so it doesn't end by itself.)"""
    with state.state_store(spark):
        df = make(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
    end = time.time() + 60
    try:
        while sum(p["numInputRows"] for p in q.recentProgress) < rows or not until():
            assert time.time() < end and q.exception() is None
            time.sleep(0.1)
    finally:
        q.stop()


def feed(spark, tmp_path, rows, schema, cuts):
    """A folder of files, one a micro-batch, in order."""
    source = str(tmp_path / f"in-{len(cuts)}")
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        part = str(tmp_path / "part")
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.parquet(part)
        os.makedirs(source, exist_ok=True)
        (f,) = (tmp_path / "part").glob("part-*.parquet")
        to = f"{source}/{n:04}.parquet"
        shutil.move(f, to)
        os.utime(to, (1_000_000 + n, 1_000_000 + n))
        shutil.rmtree(part)
    return source


def expected(rows, limits):
    """Batches of one flow by plain iteration."""
    out, open_, size, opened = [], [], 0, 0

    def close(reason):
        nonlocal open_, size
        out.append((tuple(open_), reason))
        open_, size = [], 0

    for _, _, at, arrived, data in rows:
        n = len(data or b"")
        if open_ and arrived - opened >= limits.age_ms:
            close("age")
        if open_ and size + n > limits.bytes:
            close("bytes")
        opened = opened if open_ else arrived
        open_.append(at)
        size += n
        if size >= limits.bytes:
            close("bytes")
        elif len(open_) >= limits.records:
            close("records")
    return out, open_


def test_buffers_across_micro_batches(spark, tmp_path):
    """The same rows in other micro-batches give the same batches, each for its own reason."""
    r = random.Random(3)
    limits = state.Limits(records=6, bytes=100, age_ms=1000)
    rows, now = [], int(time.time() * 1000) + 3_600_000  # so that no timer acts
    for i in range(60):
        now += r.choice([1, 10, 300, 1500])
        rows.append(("a", f"f{i % 3}", i, now, None if i == 7 else bytes(r.choice([3, 20, 60, 150]) if i % 4 == 0 else 5)))
    want, open_ = expected(rows, limits)
    assert open_ and {x for _, x in want} == {"age", "bytes", "records"}
    for cuts in ([], [1, 2, 30, 31, 59]):
        source = feed(spark, tmp_path, rows, ROWS, cuts)
        out, checkpoint = str(tmp_path / f"out-{len(cuts)}"), str(tmp_path / f"c-{len(cuts)}")
        make = lambda df: state.buffered(df, ["flow"], ["at"], limits, arrived=F.col("arrived"))
        run(spark, source, ROWS, make, out, checkpoint, len(rows))
        # a restarted query goes on from the open buffer: a row that comes much later closes it
        spark.createDataFrame([("a", "f", 60, now + 5000, b"x")], ROWS).coalesce(1).write.mode("append").parquet(source)
        run(spark, source, ROWS, make, out, checkpoint, 1)
        got = {}
        for x in spark.read.parquet(out).where("flow = 'a'").orderBy("batch_no", "at").collect():
            got.setdefault(x["batch_no"], (x["flush_reason"], x["batch_records"], []))[2].append(x["at"])
        assert [(tuple(ats), reason) for reason, n, ats in (got[k] for k in sorted(got)) if n == len(ats)] == [*want, (tuple(open_), "age")]
        assert sorted(got) == list(range(len(want) + 1))


def test_timer_closes_a_buffer(spark, tmp_path):
    source = feed(spark, tmp_path, [("a", "f", i, 1000, b"x") for i in range(3)], ROWS, [])
    out = str(tmp_path / "out")
    make = lambda df: state.buffered(df, ["flow"], ["at"], state.Limits(age_ms=1), arrived=F.col("arrived"))
    run(spark, source, ROWS, make, out, str(tmp_path / "c"), 3, lambda: spark.read.parquet(out).count() == 3)
    assert {(x["batch_no"], x["batch_records"], x["flush_reason"]) for x in spark.read.parquet(out).collect()} == {(0, 3, "age")}


def test_lanes_split_a_hot_flow(spark, tmp_path):
    rows = [("hot", f"f{i % 8}", i, 1000 + i, b"12345") for i in range(200)]
    source = feed(spark, tmp_path, rows, ROWS, [50, 120])
    make = lambda df: state.buffered(df, ["flow"], ["at"], state.Limits(records=10, bytes=1 << 20, age_ms=1), lanes=4, lane_by="file_id", arrived=F.lit(5))
    run(spark, source, ROWS, make, str(tmp_path / "out"), str(tmp_path / "c"), len(rows))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("lane").distinct().count() > 1
    assert got.groupBy("file_id").agg(F.countDistinct("lane").alias("n")).where("n > 1").count() == 0
    assert got.groupBy("lane", "batch_no").count().where("count <> 10 AND count > 10").count() == 0 and got.select("at").distinct().count() == got.count()


def test_multi_line_state_equals_whole_file(spark, tmp_path):
    """Equal to the records of the whole file for any cut into micro-batches and a restart."""
    r = random.Random(9)
    texts = {f"f{n}": "".join(r.choice(["E start\n", " more\n", "\n", "\tat é\n", "E again\n"]) for _ in range(40)) + r.choice(["", "E open", " tail"]) for n in range(3)}
    whole = spark.createDataFrame(list(texts.items()), "f string, t string")
    lines = framing.lines(whole, "f", "t")
    want = sorted((x["file_id"], x["start_offset"], x["end_offset"], x["raw"], x["terminated"]) for x in framing.multi_line(lines, "E ").collect())
    rows = [(x["file_id"], f"/{x['file_id']}", x["start_offset"], x["end_offset"], bytearray(x["raw"].encode()), x["terminated"]) for x in lines.orderBy("start_offset", "file_id").collect()]
    for cuts in ([], sorted(r.sample(range(1, len(rows)), 5))):
        source = feed(spark, tmp_path, rows, state.LINE, cuts)
        out, checkpoint = str(tmp_path / f"out-{len(cuts)}"), str(tmp_path / f"c-{len(cuts)}")
        patient = lambda df: state.multi_line(df, "E ", release_ms=3_600_000)
        run(spark, source, state.LINE, patient, out, checkpoint, len(rows))
        held = spark.read.parquet(out)
        assert held.count() == len(want) - 3  # the last of each file is open
        # a line of another offset: the file was begun anew, so what was open ends
        again = spark.createDataFrame([(f, f"/{f}", 0, 2, b"E", True) for f in texts], state.LINE).coalesce(1)
        again.write.mode("append").parquet(source)
        run(spark, source, state.LINE, patient, out, checkpoint, len(texts))
        got = sorted((x["file_id"], x["start_offset"], x["end_offset"], bytes(x["raw"]).decode(), x["terminated"]) for x in spark.read.parquet(out).collect())
        assert got == want


def test_multi_line_full_buffer_and_timer(spark, tmp_path):
    rows = [("f", "/f", 10 * i, 10 * i + 10, b"123456789", True) for i in range(5)]
    source = feed(spark, tmp_path, rows, state.LINE, [2])
    out = str(tmp_path / "out")
    run(spark, source, state.LINE, lambda df: state.multi_line(df, "E", buffer=20, release_ms=0), out, str(tmp_path / "c"), 5, lambda: spark.read.parquet(out).count() == 3)
    got = [(x["start_offset"], x["end_offset"], x["oversized"]) for x in spark.read.parquet(out).orderBy("start_offset").collect()]
    assert got == [(0, 20, True), (20, 40, True), (40, 50, False)]


@pytest.mark.parametrize("block", ["64b", "1k", "128m"])
def test_lines_by_splits_equal_whole_texts(spark, tmp_path, block):
    """Numbers and offsets of files that many tasks read are those of framing.lines."""
    r = random.Random(11)
    texts = ["".join(r.choice(["a", "bb", "", "é" * 30, "x" * 200, "\r", "\tz"]) + r.choice(["\n", "\n", "|"]) for _ in range(120)) + end for end in ("", "open", "\n\n")] + ["", "one", "\n"]
    for n, t in enumerate(texts):
        (tmp_path / f"{n}.log").write_bytes(t.encode())
    (tmp_path / "done.log.COMPLETED").write_bytes(b"x\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        for d in ("\n", "|"):
            found = files.split_lines(spark, f"{tmp_path}/*", d)
            order = ["file_id", "line_no", "raw", "terminated", "start_offset", "end_offset"]
            got = sorted((x["file_id"].rsplit("/", 1)[1], *x[1:]) for x in found.select(order).collect())
            whole = spark.createDataFrame([(f"{n}.log", t) for n, t in enumerate(texts)], "f string, t string")
            assert got == sorted(tuple(x) for x in framing.lines(whole, "f", "t", d).select(order).collect())
            plain = framing.lines(whole, "f", "t", d, offsets=False)
            assert sorted(map(tuple, plain.collect())) == [x[:4] for x in got]
        if block == "64b":
            assert files.split_lines(spark, f"{tmp_path}/0.log").rdd.getNumPartitions() > 0
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
