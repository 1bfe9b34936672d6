import os

import pytest

from logloom.plans import flow as flows
from logloom.plans.config import flow
from logloom.streaming import published, sink


def accepting():
    """A sender that is pickled with its code, as workers can't import the tests."""
    return lambda records: [None] * len(records)


def rows(spark, results):
    return sorted(((r["end_offset"], r["error_code"]) for r in published.table(spark, results).collect()), key=str)


def folder(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    return logs, flow({"filePattern": f"{logs}/*.log", "stream": "s"}), str(tmp_path / "results"), f"file://{tmp_path}/checkpoint"


def run(spark, f, sender, results, checkpoint, **options):
    d = sink.Delivery(sender, results, attempts=1, first_ms=0)
    q = flows.start(spark, f, published.Published(d, **options), checkpoint, once=True)
    assert q.awaitTermination(90)


def test_killed_tasks_leave_neither_gap_nor_duplicate(spark, tmp_path):
    logs, f, results, checkpoint = folder(tmp_path)
    for name in "abc":
        (logs / f"{name}.log").write_text("".join(f"{name}{i}\n" for i in range(3)))
    once = str(tmp_path / "once")

    def dies(records):
        """One task's process ends in the middle of a call, the first time."""
        if any(r["data"] == b"b1" for r in records) and not os.path.exists(once):
            open(once, "w").close()
            os._exit(1)
        return [("503", "busy") if r["data"] == b"c2" else None for r in records]

    with pytest.raises(Exception):  # noqa: B017
        run(spark, f, dies, results, checkpoint)
    assert os.path.exists(once) and rows(spark, results) == []
    run(spark, f, dies, results, checkpoint)
    want = sorted([(3 * i, "503" if name == "c" and i == 3 else None) for name in "abc" for i in (1, 2, 3)], key=str)
    assert rows(spark, results) == want
    (total,) = published.summary(spark, results).collect()
    assert (total["n_records"], total["n_failed"], total["n_bytes"]) == (9, 1, 18)
    dead = published.table(spark, results).where("error_code is not null").first()
    assert bytes(dead["data"]) == b"c2"
    published.vacuum(results, 0)
    assert len(os.listdir(f"{results}/data")) == 3 and rows(spark, results) == want


def test_a_killed_driver_publishes_a_batch_once(spark, tmp_path):
    """Stopped after the manifest, before Spark's own mark: the batch is run again and replaces itself."""
    logs, f, results, checkpoint = folder(tmp_path)
    (logs / "a.log").write_text("1\n2\n")
    run(spark, f, accepting(), results, checkpoint)
    (n,) = published.published(results)
    for name in (f"{n}", f".{n}.crc"):
        os.remove(tmp_path / "checkpoint/commits" / name)
    assert rows(spark, results) == [(2, None), (4, None)]
    run(spark, f, accepting(), results, checkpoint)
    assert rows(spark, results) == [(2, None), (4, None)] and len(published.vacuum(results, 0)) == 1
    assert rows(spark, results) == [(2, None), (4, None)]


def message(results, name, n=1, pace=0.0):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{results}/data", exist_ok=True)
    row = {"file_id": name, "end_offset": n} | dict.fromkeys(sink.RESULT_FIELDS.names[2:])
    pq.write_table(pa.Table.from_pylist([row], schema=sink.RESULT_FIELDS), f"{results}/data/{name}.parquet")
    return published.Sent(f"{name}.parquet", 1, 0, 5, pace)


def test_manifests_are_compacted_and_aborts_leave_nothing(spark, tmp_path):
    results = str(tmp_path / "r")
    new = lambda: published.Writer(sink.Delivery(accepting(), results), compact_every=3)
    for n in range(10):
        new().commit([message(results, f"f{n}", n, pace=float(n)), None, published.Sent(None, 0, 0, 0, 0.0)], n)
        assert rows(spark, results) == [(i, None) for i in range(n + 1)]
    assert len(os.listdir(f"{results}/batches")) <= 5 and new().before == 9.0
    # the last batch is run again, also where it was the one that compacted
    new().commit([message(results, "again", 9)], 9)
    assert [r["file_id"] for r in published.table(spark, results).where("end_offset = 9").collect()] == ["again"]
    new().abort([message(results, "lost"), None, published.Sent(None, 0, 0, 0, 0.0)], 10)
    assert not os.path.exists(f"{results}/data/lost.parquet") and len(rows(spark, results)) == 10
    assert published.vacuum(results, 3600) == [] and published.vacuum(results, 0) == ["f9.parquet"]


def test_nothing_published(spark, tmp_path):
    results = str(tmp_path / "none")
    assert rows(spark, results) == [] and published.summary(spark, results).count() == 0 and published.vacuum(results, 0) == []
    with pytest.raises(ValueError):
        flows.start(spark, flow({"filePattern": "/a/*", "stream": "s"}), published.Published(sink.Delivery(accepting(), results)), str(tmp_path / "c"), running=True)
