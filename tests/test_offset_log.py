import os
import random

import pytest

from logloom.plans import flow as flows
from logloom.plans.config import flow
from logloom.streaming import offset_log, sink, tail


def reader(path, log=None, **options):
    return tail.TailReader({"path": str(path), **({"offsetLog": str(log)} if log else {}), **options})


def step(r, before):
    after = r.latestOffset()
    got = [row for p in r.partitions(before, after) for row in r.read(p)]
    r.commit(after)
    return after, [bytes(row[4]) for row in got]


def counted(monkeypatch):
    opened = []

    def count(path, *args, **kwargs):
        opened.append(str(path))
        return open(path, *args, **kwargs)

    monkeypatch.setattr(tail, "open", count, raising=False)
    return opened


@pytest.mark.parametrize("logged", [True, False])
def test_opens_follow_changes(tmp_path, monkeypatch, logged):
    """Of 5000 files 10 grow: 10 are opened, and what the log gains are those 10."""
    logs = tmp_path / "logs"
    logs.mkdir()
    for n in range(5000):
        (logs / f"{n}.log").write_bytes(b"x" * 600 + b"\n")
        os.utime(logs / f"{n}.log", (1_000_000 + n, 1_000_000 + n))
    r = reader(logs / "*.log", tmp_path / "log" if logged else None)
    at, got = step(r, r.initialOffset())
    assert len(got) == 5000
    opened = counted(monkeypatch)
    for n in range(0, 5000, 500):
        with (logs / f"{n}.log").open("ab") as f:
            f.write(b"%d\n" % n)
    os.utime(logs / "7.log", (2_000_000, 2_000_000))  # touched, but as it was
    end = r.latestOffset()
    pieces = r.partitions(at, end)
    assert len(pieces) == 10 and sorted(opened) == sorted(str(logs / f"{n}.log") for n in [7, *range(0, 5000, 500)])
    assert sorted(bytes(x[4]) for p in pieces for x in r.read(p)) == sorted(b"%d" % n for n in range(0, 5000, 500))
    if logged:
        assert len(offset_log.OffsetLog(str(tmp_path / "log")).read(end["log"], "delta")) == 10


def test_a_write_within_the_same_tick_is_seen(tmp_path):
    """Same size and time, other content: times of less than two seconds ago prove nothing."""
    a = tmp_path / "a.log"
    a.write_bytes(b"one\n")
    s = os.stat(a)
    r = reader(tmp_path / "*.log")
    at, got = step(r, r.initialOffset())
    a.write_bytes(b"two\n")
    os.utime(a, ns=(s.st_atime_ns, s.st_mtime_ns))
    assert step(r, at)[1] == [b"two"]


def act(rng, folder, n):
    """One random thing that happens to log files: appended to, rotated, copied and truncated, deleted, begun anew."""
    names = sorted(p.name for p in folder.iterdir())
    name = rng.choice(names) if names else None
    what = rng.choice(["append", "append", "append", "new", "rename", "copytruncate", "delete", "anew"])
    if what == "new" or name is None:
        (folder / f"{n}.log").write_bytes(b"new %d\n" % n)
    elif what == "append":
        with (folder / name).open("ab") as f:
            f.write(b"line %d\n" % n + b"open %d" % n * rng.randrange(2))
    elif what == "rename":
        os.rename(folder / name, folder / f"{n}.log")
    elif what == "copytruncate":
        (folder / f"{n}.log").write_bytes((folder / name).read_bytes() + b"last %d\n" % n)
        os.truncate(folder / name, 0)
    elif what == "delete":
        os.remove(folder / name)
    else:
        (folder / name).write_bytes(b"anew %d\n" % n)


@pytest.mark.parametrize("seed", range(12))
def test_same_records_with_and_without_a_log(tmp_path, seed):
    """Random traces; the logged reader is thrown away now and then, also between a version and its batch."""
    rng, logs = random.Random(seed), tmp_path / "logs"
    logs.mkdir()
    options = {"startAtEnd": str(seed % 3 == 0).lower(), "bufferBytes": "64", "compactBytes": "600"}
    (logs / "first.log").write_bytes(b"first\n")
    plain, logged = reader(logs / "*", **options), reader(logs / "*", tmp_path / "log", **options)
    at, place = plain.initialOffset(), logged.initialOffset()
    for n in range(60):
        act(rng, logs, n)
        again = rng.random()
        if again < 0.2:
            logged = reader(logs / "*", tmp_path / "log", **options)
        elif again < 0.3:
            # planned and stopped before it was written to the checkpoint
            logged.latestOffset()
            logged = reader(logs / "*", tmp_path / "log", **options)
            act_plain = plain.latestOffset()
            end = logged.latestOffset()
            assert sorted(x[4] for p in plain.partitions(at, act_plain) for x in plain.read(p)) == sorted(x[4] for p in logged.partitions(place, end) for x in logged.read(p))
            at, place = act_plain, end
            continue
        at, want = step(plain, at)
        end = logged.latestOffset()
        if rng.random() < 0.2:  # planned, written, and run by another process
            logged = reader(logs / "*", tmp_path / "log", **options)
        got = [bytes(x[4]) for p in logged.partitions(place, end) for x in logged.read(p)]
        assert sorted(got) == sorted(want), n
        place = end
        logged.commit(end)
    log = offset_log.OffsetLog(str(tmp_path / "log"))
    assert len(log.versions("snapshot")) == 1 and 1 not in log.versions("delta")  # compacted on the way
    logged.latestOffset()
    assert log.load() == logged.last


def test_limit_holds_after_a_restart(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_bytes(b"".join(b"%03d\n" % i for i in range(10)))
    options = {"maxBytesPerBatch": "8", "bufferBytes": "4"}
    r = reader(logs / "*", tmp_path / "log", **options)
    at, got = step(r, r.initialOffset())
    assert got == [b"000", b"001"]
    assert step(reader(logs / "*", tmp_path / "log", **options), at)[1] == [b"002", b"003"]


def test_versions_that_are_gone_raise(tmp_path):
    log = offset_log.OffsetLog(str(tmp_path / "log"), compact_bytes=0)
    a, b = {"x": {"offset": 1}}, {"x": {"offset": 2}, "y": {"offset": 1}}
    assert log.append({}, a) == 1 and log.append(a, a) == 1 and log.append(a, b) == 2
    assert log.between(1, 2) == ({"x": {"offset": 1}}, b) and log.between(2, 2) == ({}, {})
    log.compact(1, b)
    again = offset_log.OffsetLog(str(tmp_path / "log"))
    assert again.load() == b and again.version == 2 and again.between(1, 2)[1] == b
    with pytest.raises(ValueError):
        again.between(0, 2)
    # a query that begins anew upon an old log doesn't skip what was compacted
    (tmp_path / "logs").mkdir()
    r = reader(tmp_path / "logs" / "*", tmp_path / "log")
    begin = r.initialOffset()
    with pytest.raises(ValueError):
        r.partitions(begin, r.latestOffset())


def test_a_query_without_a_log_goes_on_with_one(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_bytes(b"1\n2\n")
    (logs / "b.log").write_bytes(b"3\n")
    r = reader(logs / "*")
    at, _ = step(r, r.initialOffset())
    with (logs / "a.log").open("ab") as f:
        f.write(b"4\n")
    r = reader(logs / "*", tmp_path / "log", maxBytesPerBatch="2", bufferBytes="2")
    at, got = step(r, at)
    assert got == [b"4"] and "log" in at
    with pytest.raises(ValueError):
        reader(logs / "*").partitions(at, at)


def test_flows_keep_their_log_in_the_checkpoint(spark, tmp_path):
    logs, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), f"file://{tmp_path}/checkpoint"
    logs.mkdir()
    f = flow({"filePattern": f"{logs}/*.log", "stream": "s"})

    def run():
        q = flows.start(spark, f, sink.parquet_sink(out), checkpoint, once=True)
        assert q.awaitTermination(60)
        return sorted(bytes(r["data"]).decode() for r in spark.read.parquet(out).collect())

    (logs / "a.log").write_text("x\ny\n")
    assert run() == ["x", "y"]
    with (logs / "a.log").open("a") as g:
        g.write("z\n")
    os.rename(logs / "a.log", logs / "a.1.log")
    (logs / "a.log").write_text("w\n")
    assert run() == ["w", "x", "y", "z"]
    assert run() == ["w", "x", "y", "z"]
    # the last batch wasn't marked as done: it is run again with the same records
    commits = sorted(int(n) for n in os.listdir(tmp_path / "checkpoint/commits") if n.isdigit())
    for n in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        os.remove(tmp_path / "checkpoint/commits" / n)
    assert run() == ["w", "x", "y", "z"]
    assert offset_log.OffsetLog(f"{checkpoint}/tail").versions("delta")
    assert flows.offset_log("s3a://bucket/c") == "" and flows.offset_log("hdfs:/c") == ""
