import os
import time

import pytest

from logloom.plans import flow as flows
from logloom.plans.config import flow
from logloom.streaming import metric_log, sink
from logloom.streaming.offset_log import OffsetLog

QUERY = "0123abcd-0000-0000-0000-000000000000"


def sums(spark, folder):
    return {(r["flow"], r["name"]): (r["count"], r["sum"]) for r in metric_log.totals(spark, folder).collect()}


def test_totals_go_on_after_a_restart(spark, tmp_path):
    """Three runs of a flow, each with a new listener; lag is what the offsets leave."""
    logs, folder, checkpoint = tmp_path / "logs", str(tmp_path / "metrics"), f"file://{tmp_path}/checkpoint"
    logs.mkdir()
    f = flow({"filePattern": f"{logs}/*.log", "stream": "s", "dataProcessingOptions": [{"optionName": "LOGTOJSON", "logFormat": "SYSLOG"}]})
    line = "Oct 11 22:14:15 web01 sshd[4123]: Accepted\n"
    want = []
    for n, text in enumerate((line + "noise\n", line * 2, line + "open")):
        with (logs / "a.log").open("a") as out:
            out.write(text)
        log = metric_log.MetricLog(folder, {f.id: checkpoint})
        spark.streams.addListener(log)
        try:
            assert flows.start(spark, f, sink.parquet_sink(str(tmp_path / "out")), checkpoint, once=True).awaitTermination(60)
            end = time.time() + 30
            while len([x for x in os.listdir(folder) if ".batch." in x] if os.path.isdir(folder) else []) <= n and time.time() < end:
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(log)
        want.append(sums(spark, folder))
    assert [w[f.id, "processed"][1] for w in want] == [1, 3, 4] and want[-1][f.id, "skipped"] == (3, 1)
    assert want[-1][f.id, "bytes_behind"] == (3, 4) and want[-1][f.id, "files_behind"] == (3, 1)
    assert want[-1][f.id, "batch_duration"][1] > 0


@pytest.mark.parametrize("merge_every", [1, 3, 100])
def test_batches_that_run_again_and_merging_count_nothing_twice(spark, tmp_path, merge_every):
    folder = str(tmp_path)
    for n in range(8):
        for _ in range(2):  # each run twice, the second time by another listener
            metric_log.MetricLog(folder, merge_every=merge_every).record(QUERY, n, {"records f": {"processed": n, "skipped": None}, "other": {"x": 1}}, 5)
        assert sums(spark, folder)["f", "processed"] == (n + 1, sum(range(n + 1)))
    r = metric_log.totals(spark, folder).where("name = 'processed'").first()
    assert (r["min"], r["max"], r["unit"], r["avg"]) == (0, 7, "Count", 3.5)
    assert len(os.listdir(folder)) <= merge_every + 2
    # stopped after a merged file was written, before what it holds was deleted
    log = metric_log.MetricLog(folder)
    log.write(QUERY, 7, "merged", metric_log.merge([metric_log.one("f", "processed", "Count", n) for n in range(7)]))
    log.write(QUERY, 3, "batch", [metric_log.one("f", "processed", "Count", 3)])
    assert sums(spark, folder)["f", "processed"] == (8, 28)
    assert metric_log.MetricLog(folder).record(QUERY, 9, {}, 1) == []


def test_nothing_written(spark, tmp_path):
    assert metric_log.totals(spark, str(tmp_path / "none")).count() == 0


def test_lag_follows_the_log(tmp_path, caplog):
    log = OffsetLog(str(tmp_path / "tail"), compact_bytes=0)
    a = {"x": {"size": 10, "offset": 4}, "y": {"size": 5, "offset": 5}, "z": {"size": 9, "offset": 0, "gone": True}}
    log.append({}, a)
    lag = metric_log.Lag(str(tmp_path / "tail"))
    assert lag.behind() == (6, 1)
    b = {"x": {"size": 10, "offset": 10}, "w": {"size": 64 << 20, "offset": 1}}
    log.append(a, b)
    assert lag.behind() == ((64 << 20) - 1, 1)
    log.append(b, c := {"w": {"size": 64 << 20, "offset": 2}})
    log.compact(3, c)  # what wasn't followed yet is in the snapshot
    assert log.versions("delta") == [] and lag.behind() == ((64 << 20) - 2, 1) == metric_log.Lag(str(tmp_path / "tail")).behind()
    with caplog.at_level("DEBUG", "logloom.status"):
        metric_log.MetricLog(str(tmp_path / "m"), {"f": str(tmp_path)}).record(QUERY, 0, {"records f": {"processed": 1}}, 1)
    assert [r.levelname for r in caplog.records if r.name == "logloom.status"] == ["WARNING"]
