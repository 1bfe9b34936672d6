import pytest
from pyspark.sql import functions as F

from logloom import queries
from logloom.operators import batching, checkpoint, delivery, framing, metrics, snapshot


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_framing_is_lossless(spark):
    texts = {"a": "a\nb\n", "b": "a\nb", "c": "", "d": "é\n\nx\r\n", "e": "\n"}
    df = framing.lines(spark.createDataFrame(list(texts.items()), "f string, t string"), "f", "t")
    for f, t in texts.items():
        got = df.where(F.col("file_id") == f).orderBy("line_no").collect()
        assert "".join(r["raw"] + "\n" * r["terminated"] for r in got) == t
        at = 0
        for r in got:
            assert r["start_offset"] == at
            at = r["end_offset"]
        assert at == len(t.encode())
    held = framing.lines(spark.createDataFrame([("b", "a\nb")], "f string, t string"), "f", "t", keep_unterminated=False)
    assert rows(held, "raw") == [("a",)]


def test_multi_line_and_header(spark):
    df = framing.lines(spark.createDataFrame([("f", "ERR a\n  at x\nERR b\n  at y")], "f string, t string"), "f", "t")
    assert rows(framing.multi_line(df, "ERR"), "record_no", "raw", "end_offset") == [(0, "ERR a\n  at x", 13), (1, "ERR b\n  at y", 25)]
    assert rows(framing.skip_header(df, 3), "raw") == [("  at y",)]


def test_truncate_and_runaway(spark):
    df = spark.createDataFrame([("aaaa\n",), ("aé",), ("a",)], "t string")
    assert [bytes(r[0]) for r in df.select(framing.truncated(F.col("t"), 3, "\n")).collect()] == [b"aa\n", "aé".encode(), b"a"]
    assert rows(framing.runaway(df.withColumnRenamed("t", "raw"), 2), "discarded") == [(0,), (1,), (3,)]


SNAP = "file_id string, path string, name string, mtime_ms long, size long, last_offset long, header string, is_deleting boolean, last_check_ms long"


def snap(spark, *files):
    return spark.createDataFrame([(f[0], f[1], f[1], 0, f[2], f[3], f[4], False if len(f) < 6 else f[5], 0) for f in files], SNAP).withColumn("header", F.col("header").cast("binary"))


@pytest.mark.parametrize(
    ("old", "new", "want"),
    [
        ([("1", "a", 10, 10, "h")], [("1", "a", 20, 0, "h")], [("1", "Resume", 10)]),
        ([("1", "a", 10, 10, "h")], [("1", "a.1", 10, 0, "h"), ("2", "a", 5, 0, "x")], [("1", "Carry", 10), ("2", "New", 0)]),
        ([("1", "a", 10, 6, "hhh")], [("1", "a", 0, 0, ""), ("2", "a.1", 10, 0, "hhh")], [("1", "Shrink", 0), ("2", "CopyAndTruncate", 6)]),
        # of three originals with one header only one isn't larger than the copy; of two that aren't, neither is it
        ([("1", "a", 10, 6, "hhh"), ("3", "b", 20, 7, "hhh"), ("4", "c", 30, 8, "hhh")], [("1", "a", 0, 0, ""), ("3", "b", 0, 0, ""), ("4", "c", 0, 0, ""), ("2", "a.1", 12, 0, "hhh"), ("5", "b.1", 40, 0, "hhh")], [("1", "Shrink", 0), ("2", "CopyAndTruncate", 6), ("3", "Shrink", 0), ("4", "Shrink", 0), ("5", "New", 0)]),
        ([("1", "a", 10, 10, "h1")], [("1", "a", 10, 0, "h2")], [("1", "ReNew", 0)]),
        ([("1", "a", 10, 10, "h")], [("1", "a", 4, 0, "h")], [("1", "Shrink", 0)]),
        ([("1", "a", 10, 10, "h")], [], [("1", "Deleting", 10)]),
        ([("1", "a", 10, 10, "h", True)], [], [("1", "Deleted", 10)]),
        ([], [], []),
    ],
)
def test_appendable(spark, old, new, want):
    assert rows(snapshot.appendable_actions(snap(spark, *old), snap(spark, *new)), "file_id", "action", "offset") == want


def test_header_match(spark, tmp_path):
    """As SQL's = of the first 1 + doc_id % 20 characters of a text and of the one before it."""
    cases = [  # doc_id, text before, text, same
        (5, "abcdefg", "abcdefh", True),
        (46, "abcdefg", "abcdefh", False),
        (81, "éab", "éac", True),
        (139, "x" * 20 + "a", "x" * 20 + "b", True),
        # a text that ends within the head isn't equal to a longer one
        (165, "ab", "abc", False),
        (205, "abc", "ab", False),
        (245, "ab", "ab", True),
        (285, "", "a", False),
        (325, "a", "", False),
        (365, "", "", True),
        (401, "é", "éa", False),
        (459, "x" * 20, "x" * 19, False),
        # of a negative id no character is compared; where a text is missing, nothing is known
        (-5, "a", "b", True),
        (-45, None, "b", None),
        (485, None, "a", None),
        (525, "a", None, None),
        (565, None, None, None),
        (2**63 - 1, "abc", "abc", True),
    ]
    spark.createDataFrame([r for i, before, text, _ in cases for r in ((i - 1, before), (i, text))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["header_match"](spark, str(tmp_path))
    assert {r["doc_id"]: r["same"] for r in got.collect()} == {i: same for i, _, _, same in cases}


def test_natural_order(spark):
    names = ["a10", "a2", "a", "a2b", "b1", "a02"]
    df = spark.createDataFrame([(n,) for n in names], "name string").withColumn("directory", F.lit("d")).withColumn("mtime_ms", F.lit(0))
    got = [r["name"] for r in snapshot.positions(df).orderBy("position").collect()]
    assert got.index("a2") < got.index("a10") and got[0] == "a" and got[-1] == "b1"


def test_checkpoints(spark):
    c = "flow string, path string, file_id string, mtime_ms long, offset long, last_updated timestamp"
    mk = lambda *r: spark.createDataFrame([(*x[:5], __import__("datetime").datetime(2024, 1, x[5])) for x in r], c)
    old, new = mk(("f", "p", "1", 1, 50, 1), ("f", "q", "2", 1, 5, 1)), mk(("f", "p2", "1", 2, 20, 2), ("f", "r", "3", 2, 7, 2))
    assert rows(checkpoint.merge(old, new), "file_id", "path", "offset") == [("1", "p2", 50), ("2", "q", 5), ("3", "r", 7)]
    assert rows(checkpoint.merge(old, new, old.limit(0)), "file_id", "offset") == [("1", 50), ("2", 5)]
    assert rows(checkpoint.overwrite(old, new), "file_id", "offset") == [("1", 20), ("2", 5), ("3", 7)]
    assert rows(checkpoint.purge(old.unionByName(new), F.lit("2024-01-09").cast("timestamp")), "file_id") == [("1",), ("3",)]


def test_metrics(spark):
    df = spark.createDataFrame([("f", "a", "Count", 1.0), ("f", "a", "Count", 3.0)], "flow string, name string, unit string, value double")
    assert rows(metrics.statistics(df, ["flow"]), "min", "max", "count", "sum", "avg") == [(1.0, 3.0, 2, 4.0, 2.0)]
    with pytest.raises(Exception, match="units differ"):
        metrics.statistics(df.unionByName(df.withColumn("unit", F.lit("Bytes"))), ["flow"]).collect()


def test_delivery(spark):
    df = spark.createDataFrame([("/a/b",)], "n string")
    assert df.select(delivery.object_key("/x/y/", F.col("n"))).first()[0] == "x/y/a/b" and df.select(delivery.object_key("", F.col("n"))).first()[0] == "a/b"
    e = RuntimeError()
    assert delivery.retriable(e)
    e.status = 403
    assert not delivery.retriable(e)
    outer = RuntimeError()
    outer.__cause__ = ValueError()
    assert not delivery.retriable(outer)


def test_batches(spark):
    df = spark.range(7).withColumn("g", F.lit(1)).withColumn("n", F.lit(4))
    assert rows(batching.by_count(df, ["g"], ["id"], 3), "id", "batch_id") == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2)]
    assert rows(batching.by_bytes(df, ["g"], ["id"], "n", 8), "batch_id") == [(0,), (0,), (1,), (1,), (2,), (2,), (3,)]
    odd = spark.createDataFrame([(i, 1, n) for i, n in enumerate([3, 3, 3, 0, 8, 20, None, 5, 3])], "id long, g int, n int")
    # 9 bytes reach beyond the first 8, 17 beyond the next; 20 are more than a batch may have
    assert rows(batching.by_bytes(odd, ["g"], ["id"], "n", 8), "id", "batch_id") == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6), (8, 7)]
    with pytest.raises(ValueError):
        batching.check_size(6 << 20)
