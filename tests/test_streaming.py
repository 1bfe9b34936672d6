import os
import time

import pytest
from pyspark.sql import functions as F

from logloom.functions import converters
from logloom.plans import flow as flows
from logloom.plans import whole
from logloom.plans.config import flow, load
from logloom.streaming import sink, tail


def reader(path, **options):
    return tail.TailReader({"path": str(path), **options})


def step(r, before):
    after = r.latestOffset()
    got = [row for p in r.partitions(before, after) for row in r.read(p)]
    return after, [bytes(row[4]) for row in got]


def test_append_rename_copytruncate_shrink(tmp_path):
    a = tmp_path / "a.log"
    a.write_bytes(b"one\ntwo\nthr")
    (tmp_path / "b.log.gz").write_bytes(b"x\n")
    (tmp_path / ".c.log").write_bytes(b"x\n")
    r = reader(tmp_path / "*")
    at, got = step(r, r.initialOffset())
    assert got == [b"one", b"two"]
    with a.open("ab") as f:
        f.write(b"ee\n")
    at, got = step(r, at)
    assert got == [b"three"]
    os.rename(a, tmp_path / "a.log.1")
    a.write_bytes(b"new\n")
    at, got = step(r, at)
    assert got == [b"new"]
    # copied, then truncated
    (tmp_path / "a.log.2").write_bytes(b"new\nmore\n")
    os.truncate(a, 0)
    at, got = step(r, at)
    assert got == [b"more"]
    # a restarted reader goes on from the offset alone
    with a.open("ab") as f:
        f.write(b"again\n")
    at, got = step(reader(tmp_path / "*"), at)
    assert got == [b"again"]
    assert step(reader(tmp_path / "*"), at)[1] == []


def test_options(tmp_path):
    a = tmp_path / "a.log"
    a.write_bytes(b"h\nx\nend")
    r = reader(tmp_path / "*.log", skipHeaderLines="1", releaseMs="0")
    assert step(r, r.initialOffset())[1] == [b"x", b"end"]
    r = reader(tmp_path / "*.log", startAtEnd="true")
    at = r.initialOffset()
    with a.open("ab") as f:
        f.write(b"ing\n")
    assert step(r, at)[1] == [b"ending"]
    a.write_bytes(b"0123456789abc\nok\n")
    r = reader(tmp_path / "*.log", bufferBytes="8")
    assert step(r, r.initialOffset())[1] == [b"01234567", b"ok"]
    a.write_bytes(b"E 1\n a\nE 2\n b\nE 3\n")
    r = reader(tmp_path / "*.log", multiLineStart="E ")
    assert step(r, r.initialOffset())[1] == [b"E 1\n a", b"E 2\n b"]


def test_one_limit_over_all_files(tmp_path):
    """Four files, two records a batch: nothing is lost, read twice or never read."""
    for n in range(4):
        (tmp_path / f"{n}.log").write_bytes(b"".join(b"%d%02d\n" % (n, i) for i in range(6)))
        os.utime(tmp_path / f"{n}.log", (n, n))
    r = reader(tmp_path / "*.log", maxBytesPerBatch="8", bufferBytes="4")
    at, seen, order = r.initialOffset(), [], []
    for _ in range(20):
        at, got = step(r, at)
        assert sum(len(x) + 1 for x in got) <= 8
        seen += got
        order += [x[:1] for x in got]
    assert sorted(seen) == sorted(b"%d%02d" % (n, i) for n in range(4) for i in range(6))
    assert len(set(order[:8])) == 4  # those that waited come first
    with (tmp_path / "0.log").open("ab") as f:
        f.write(b"end\n")
    assert step(r, at)[1] == [b"end"]
    # from the end, only what comes then; a restarted reader runs a batch again and goes on
    r = reader(tmp_path / "*.log", maxBytesPerBatch="8", bufferBytes="4", startAtEnd="true")
    at = r.initialOffset()
    with (tmp_path / "3.log").open("ab") as f:
        f.write(b"a00\na01\na02\n")
    end, got = step(r, at)
    assert got == [b"a00", b"a01"]
    r = reader(tmp_path / "*.log", maxBytesPerBatch="8", bufferBytes="4")
    assert [bytes(x[4]) for p in r.partitions(at, end) for x in r.read(p)] == got
    assert step(r, end)[1] == [b"a02"]


def test_lone_delimiters_of_streams(tmp_path):
    (tmp_path / "a.log").write_bytes(b"x\n\n\ny\n\n")
    r = reader(tmp_path / "*.log", skipLoneDelimiters="true")
    assert step(r, r.initialOffset())[1] == [b"x", b"y", b""]


def test_all_flows_start(spark, tmp_path):
    for n in "ab":
        (tmp_path / n).mkdir()
        (tmp_path / n / "x.log").write_text(f"{n}1\n{n}2\n")
    c = load('{"flows": [%s,\n{"filePattern": "/whole/*", "stream": "s", "isFileAppendable": false}]}' % ",".join('{"filePattern": "%s/*.log", "stream": "s"}' % (tmp_path / n) for n in "ab"))
    out = lambda f: str(tmp_path / f"out{c.flows.index(f)}")
    qs = flows.start_all(spark, c, lambda f: sink.parquet_sink(out(f)), str(tmp_path / "checkpoints"), once=True)
    assert sorted(qs) == sorted(f.id for f in c.flows[:2]) and all(q.awaitTermination(60) for q in qs.values())
    assert [sorted(bytes(r["data"]).decode() for r in spark.read.parquet(out(f)).collect()) for f in c.flows[:2]] == [["a1", "a2"], ["b1", "b2"]]


def test_flow_stream_restarts_without_loss(spark, tmp_path):
    logs, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    logs.mkdir()
    f = flow({"filePattern": f"{logs}/*.log", "stream": "s", "dataProcessingOptions": [{"optionName": "ADDBRACKETS"}], "partitionKeyOption": "FILE_NAME"})

    def run():
        q = flows.stream(spark, f).writeStream.foreachBatch(sink.parquet_sink(out)).option("checkpointLocation", checkpoint).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(bytes(r["data"]).decode() for r in spark.read.parquet(out).collect())

    (logs / "a.log").write_text("x\ny\n")
    assert run() == ["{x\n}", "{y\n}"]
    with (logs / "a.log").open("a") as g:
        g.write("z\n")
    (logs / "b.log").write_text("w\n")
    assert run() == ["{w\n}", "{x\n}", "{y\n}", "{z\n}"]


def test_flow_batch(spark, tmp_path):
    (tmp_path / "a.log").write_text("Oct 11 22:14:15 web01 sshd[4123]: Accepted\nnoise\n")
    f = flow({"filePattern": f"{tmp_path}/*.log", "stream": "s", "dataProcessingOptions": [{"optionName": "LOGTOJSON", "logFormat": "SYSLOG"}], "partitionKeyOption": "DETERMINISTIC"})
    got = flows.batch(spark, f).collect()
    assert [bytes(r["data"]).decode() for r in got] == ['{"timestamp":"Oct 11 22:14:15","hostname":"web01","program":"sshd","processid":"4123","message":"Accepted"}']


def test_flow_batch_falls_back(spark, tmp_path):
    """What a converter fails on goes as it came, what isn't UTF-8 ends nothing, old files stay."""
    (tmp_path / "a.log").write_bytes(b"12\nx\xff\n\n7")
    (tmp_path / "old.log").write_text("1\n")
    os.utime(tmp_path / "old.log", (1, 1))
    converters.register("HALVED", fails=lambda text, _: F.trim(text).try_cast("int").isNull())(lambda text, _: F.when(F.trim(text).cast("int") % 2 == 0, (F.trim(text).cast("int") / 2).cast("int").cast("string")))
    f = flow({"filePattern": f"{tmp_path}/*.log", "stream": "s", "ignoreNotUpdatedFileSeconds": 3600, "dataProcessingOptions": [{"optionName": "HALVED"}, {"optionName": "ADDBRACKETS"}]})
    got = flows.batch(spark, f).orderBy("start_offset").collect()
    assert [bytes(r["data"]).decode() for r in got] == ["{6}", "x\ufffd", ""]


def test_flow_batch_cuts_runaway_records(spark, tmp_path, monkeypatch):
    from logloom.operators import framing

    monkeypatch.setattr(framing, "READ_BUFFER", 4)
    (tmp_path / "a.log").write_text("abcd\nabcdefgh\nab\n")
    got = flows.batch(spark, flow({"filePattern": f"{tmp_path}/*.log", "stream": "s", "isRemainRecordDelimiter": True})).orderBy("start_offset").collect()
    assert [bytes(r["data"]).decode() for r in got] == ["abcd\n", "abcd", "ab\n"]


def test_flow_stream_counts(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("Oct 11 22:14:15 web01 sshd[4123]: Accepted\nnoise\nmore noise\n")
    f = flow({"filePattern": f"{logs}/*.log", "stream": "s", "dataProcessingOptions": [{"optionName": "LOGTOJSON", "logFormat": "SYSLOG"}]})
    q = flows.start(spark, f, sink.parquet_sink(str(tmp_path / "out")), str(tmp_path / "checkpoint"), once=True)
    assert q.awaitTermination(60)
    seen = [m for p in q.recentProgress for m in p.observedMetrics.values()]
    assert [tuple(sum(m[k] for m in seen) for k in ("processed", "skipped", "failed"))] == [(1, 2, 0)]


def test_newest_first(tmp_path):
    for n, name in enumerate(("a1", "a2", "a10")):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (n // 2, n // 2))
    names = lambda order: [os.path.basename(f["path"]) for f in tail.TailReader({"path": f"{tmp_path}/*", "order": order}).files().values()]
    assert names("oldest_first") == ["a1", "a2", "a10"]
    assert names("newest_first") == ["a10", "a2", "a1"]


class Flaky:
    def __init__(self):
        self.calls = 0

    def __call__(self, records):
        self.calls += 1
        return [("503", "busy") if self.calls == 1 and i % 2 else ("400", "bad") if r["data"] == b"bad" else None for i, r in enumerate(records)]


def test_retries():
    s, b = Flaky(), sink.Backoff(rng=lambda: 0.5)
    out = sink.send([{"data": x} for x in (b"a", b"b", b"c", b"bad")], s, b, attempts=3, sleep=lambda t: None)
    assert sorted((r["data"], x and x[0]) for r, x in out) == [(b"a", None), (b"b", None), (b"bad", "400"), (b"c", None)] and s.calls == 3
    b = sink.Backoff(rng=lambda: 0.5)
    assert b.next_ms() == 0
    for want in (100, 200, 400):
        b.failed()
        assert b.next_ms() == want
    b.succeeded()
    assert b.next_ms() == 0


def test_fatal_errors_are_not_retried():
    calls = []

    def sender(records):
        calls.append(1)
        raise ValueError("no")

    out = sink.send([{"data": b"a"}], sender, sink.Backoff(), sleep=lambda t: None)
    assert len(calls) == 1 and out[0][1] == ("ValueError", "no")


def test_delivery_keeps_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([("f", 1, "a", "k"), ("f", 2, "bad", "k")], "file_id string, end_offset long, data string, partition_key string").coalesce(1)
    d = sink.Delivery(lambda rs: [("400", "bad") if r["data"] == b"bad" else None for r in rs], str(tmp_path / "r"), attempts=1)
    d(df, 7)
    d(df, 7)
    got = {r["end_offset"]: (r["error_code"], r["data"] and bytes(r["data"])) for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert got == {1: (None, None), 2: ("400", b"bad")}


def test_copy_and_clean_up(spark, tmp_path):
    src = tmp_path / "x.log"
    src.write_text("data")
    got = sink.copy_files(spark.createDataFrame([(f"file:{src}",)], "path string"), str(tmp_path / "store"), "/dump/").collect()
    assert got[0]["object_key"] == "dump/x.log" and (tmp_path / "store/dump/x.log").read_text() == "data"
    assert sink.clean_up(str(src), "other") == str(src) and src.exists()
    done = sink.clean_up(str(src))
    assert done.endswith(".COMPLETED") and not src.exists()
    assert sink.clean_up(done, move_to=str(tmp_path / "old")) == str(tmp_path / "old/x.log.COMPLETED")
    assert sink.clean_up(str(tmp_path / "old/x.log.COMPLETED"), delete=True) is None


def test_config(tmp_path):
    text = """{ // flows
      "flows": [{"filePattern": "/a/*.log", "stream": "s", "maxBufferSizeRecords": "7", "isFileAppendable": "false", "recordDelimiter": ";x"},
                {"filePattern": "/b", "stream": "s", "enable": false}],
      "checkpointTimeToLiveDays": 3 /* days */, "url": "http://x//y" }"""
    c = load(text)
    f = c.flows[0]
    assert len(c.flows) == 1 and f.max_buffer_size_records == 7 and not f.file_appendable and f.record_delimiter == ";" and f.max_file_checking_millis == 5000
    assert c.options == {"checkpointTimeToLiveDays": 3, "url": "http://x//y"}
    (tmp_path / "c.yml").write_text("flows:\n- filePattern: /a\n  stream: s\n  resultLogLevel: 'off'\n")
    assert load(tmp_path / "c.yml").flows[0].log_level is None
    for bad in ({"filePattern": "/a"}, {"stream": "s"}, {"filePattern": "/a", "stream": "s", "maxBufferSizeRecords": 10_001}, {"filePattern": "/a", "stream": "s", "recordDelimiter": "é"}):
        with pytest.raises(ValueError):
            flow(bad)
    with pytest.raises(ValueError):
        load('{"flows": [{"filePattern": "/a", "stream": "s"}, {"filePattern": "/a", "stream": "s"}]}')


def test_whole_files_when_stable(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    f = flow({"filePattern": f"{logs}/*", "stream": "s", "isFileAppendable": False, "maxFileCheckingMillis": 1000, "dumpDirectory": "d"})
    (logs / "a.log").write_text("x")
    (logs / "e.log").write_text("")
    state, target = f"file://{tmp_path}/state", str(tmp_path / "store")
    names = lambda now, **k: sorted(r["data"] for r in whole.upload(spark, f, state, target, now, **k).collect())
    assert names(1_000) == []
    assert names(1_500) == []
    (logs / "b.log").write_text("y")
    assert names(3_000) == ["d/a.log"]
    assert names(9_000, clean=True) == ["d/b.log"]
    assert (logs / "b.log.COMPLETED").exists() and (tmp_path / "store/d/b.log").read_text() == "y"
    assert names(20_000) == []


def test_whole_files_survive_a_stop_between_any_two_steps(spark, tmp_path, monkeypatch):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("x")
    f = flow({"filePattern": f"{logs}/*", "stream": "s", "isFileAppendable": False, "maxFileCheckingMillis": 1000, "deletePolicy": "immediate"})
    state, target = f"file://{tmp_path}/state", str(tmp_path / "store")
    names = lambda now, **k: sorted(r["data"] for r in whole.upload(spark, f, state, target, now, **k).collect())
    assert names(1_000) == []
    # after the snapshot, before the copy
    assert [r["name"] for r in whole.poll(spark, f, state, 3_000).collect()] == ["a.log"]
    assert [r["name"] for r in whole.poll(spark, f, state, 4_000).collect()] == ["a.log"]
    # after the copy, before the notices
    with monkeypatch.context() as m:
        m.setattr(whole, "uploads", lambda state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            names(5_000)
    sink.copy_files(spark.createDataFrame([(str(logs / "a.log"),)], "path string"), target).collect()
    # after the notices, before the clean-up
    with monkeypatch.context() as m:
        m.setattr(sink, "clean_all", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            names(6_000, clean=True)
    assert (logs / "a.log").exists() and names(7_000) == [] and (tmp_path / "store/a.log").read_text() == "x"
    # written to again: taken anew, and cleaned up only as it was taken
    (logs / "a.log").write_text("xyz")
    assert names(8_000) == [] and names(10_000, clean=True) == ["a.log"]
    assert not (logs / "a.log").exists() and (tmp_path / "store/a.log").read_text() == "xyz"


def test_clean_up_leaves_what_changed(spark, tmp_path):
    a = tmp_path / "a.log"
    a.write_text("more than was taken")
    sink.clean_all(spark.createDataFrame([(str(a), 3, 1)], "path string, size long, mtime_ms long"), delete=True)
    assert a.exists()


def test_delivery_takes_the_flows_options():
    f = flow({"filePattern": "/a", "stream": "s", "maxBufferSizeRecords": 7, "maxBufferSizeBytes": 99, "sendingThreadSize": 3, "retryInitialBackoffMillis": 5, "retryMaxBackoffMillis": 50, "resultLogLevel": "OFF"})
    d = flows.delivery(f, lambda rs: [None] * len(rs), "/r")
    assert (d.max_records, d.max_bytes, d.threads, d.first_ms, d.most_ms, d.log_level) == (7, 99, 3, 5, 50, None)


def test_tailing_order_compares_names_before_numbers(tmp_path):
    for name in ("b1.log", "a10.log", "a2.log"):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (5, 5))
    assert [os.path.basename(f["path"]) for f in reader(tmp_path / "*").files().values()] == ["a2.log", "a10.log", "b1.log"]


def test_natural_order_of_long_numbers(spark):
    from pyspark.sql import functions as F

    from logloom.operators.snapshot import natural_key

    names = ["f9", "f10", "f" + "9" * 25, "f1" + "0" * 25, "f0" * 1 + "10x", "e99"]
    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(natural_key(F.col("n")), "n").collect()]
    assert got == ["e99", "f9", "f10", "f010x", "f" + "9" * 25, "f1" + "0" * 25]


def test_flow_with_running_buffers(spark, tmp_path):
    """Records of several lines and batches that span micro-batches, delivered buffer by buffer."""
    logs, results = tmp_path / "logs", str(tmp_path / "results")
    logs.mkdir()
    f = flow({"filePattern": f"{logs}/*.log", "stream": "s", "multiLineStartPattern": "E ", "maxBufferSizeRecords": 3, "maxBufferAgeMillis": 60_000})
    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    def sender(records):
        import uuid

        with open(f"{calls}/{uuid.uuid4().hex}", "wb") as out:
            out.write(b"|".join(r["data"] for r in records))
        return [None] * len(records)

    q = flows.start(spark, f, flows.delivery(f, sender, results), str(tmp_path / "checkpoint"), running=True)
    sent = lambda: sorted(open(f"{calls}/{n}", "rb").read() for n in os.listdir(calls))
    end = time.time() + 90
    try:
        for part in (b"E 1\n more\nE 2\n", b" of 2\nE 3\nE 4\n", b"E 5\nE 6\nE 7\n"):
            with (logs / "a.log").open("ab") as out:
                out.write(part)
            time.sleep(4)
        while len(sent()) < 2 and time.time() < end:
            assert q.exception() is None
            time.sleep(0.2)
    finally:
        q.stop()
    assert sent() == [b"E 1\n more|E 2\n of 2|E 3", b"E 4|E 5|E 6"]
    with pytest.raises(ValueError):
        flows.start(spark, f, flows.delivery(f, sender, results), str(tmp_path / "other"), once=True, running=True)


def test_pace_goes_on_in_the_next_batch(spark, tmp_path):
    rows = spark.createDataFrame([("f", i, b"x" * (10 if i else 6 << 20), "k") for i in range(6)], "file_id string, end_offset long, data binary, partition_key string").coalesce(2)
    d = sink.Delivery(lambda records: [("Busy", "later")] * len(records), str(tmp_path / "r"), attempts=2, first_ms=0)
    d(rows, 0)
    first = spark.read.parquet(f"{tmp_path}/r/batch_id=0")
    assert first.where("end_offset = 0").select("error_code").first()[0] == "TooLarge"  # a lone record beyond a call
    assert first.agg(F.max("pace")).first()[0] == 2.0 == d.pace_after(spark, 0)
    # another object, as after a restart, begins where those failures left
    again = sink.Delivery(lambda records: [("Busy", "later")] * len(records), str(tmp_path / "r"), attempts=1, first_ms=0)
    again(rows.where("end_offset = 1"), 1)
    assert again.pace_after(spark, 1) == 3.0 and again.pace_after(spark, 7) == 0.0
    sink.Delivery(lambda records: [None] * len(records), str(tmp_path / "r"), first_ms=0)(rows.where("end_offset = 1"), 2)
    assert again.pace_after(spark, 2) == 0.0  # a success divides the count by ten


def test_whole_file_flows_are_queries(spark, tmp_path):
    """Started with the others, they go on after a restart; a replay delivers its notices again."""
    logs, target, results = tmp_path / "logs", tmp_path / "target", str(tmp_path / "results")
    logs.mkdir()
    (logs / "a.bin").write_bytes(b"abc")
    c = load('{"flows": [{"filePattern": "%s/*", "stream": "s", "isFileAppendable": false, "maxFileCheckingMillis": 1, "minTimeBetweenFilePollsMillis": 100}]}' % logs)
    (f,) = c.flows
    assert flows.start_all(spark, c, lambda f: sink.parquet_sink(results), str(tmp_path / "checkpoints")) == {}
    told = lambda: sorted(r["data"] for r in spark.read.schema("data string").parquet(results).collect()) if os.path.isdir(results) else []

    def run(want):
        (q,) = flows.start_all(spark, c, lambda f: sink.parquet_sink(results), str(tmp_path / "checkpoints"), target=lambda f: str(target)).values()
        end = time.time() + 90
        try:
            while told() != want:
                assert time.time() < end and q.exception() is None
                time.sleep(0.3)
        finally:
            q.stop()

    run(["a.bin"])
    assert (target / "a.bin").read_bytes() == b"abc"
    (logs / "b.bin").write_bytes(b"defg")
    run(["a.bin", "b.bin"])
    # a stop between copying and delivering: the same micro-batch delivers its poll's notices
    made = whole.Uploads(f, str(tmp_path / "state"), str(target), lambda df, n: None)
    poll_row = lambda ms: spark.createDataFrame([(ms,)], "poll_ms long")
    now = int(time.time() * 1000) + 10_000
    made(poll_row(now), 0)
    made(poll_row(now + 60_000), 1)
    again = []
    whole.Uploads(f, str(tmp_path / "state"), str(target), lambda df, n: again.extend(r["data"] for r in df.collect()))(poll_row(now + 60_000), 1)
    assert sorted(again) == ["a.bin", "b.bin"]
