import corpus_pipeline as p
import pyarrow as pa
import pytest
from logloom.llm import common, jaccard, pii
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in p.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        docs = p.staged(stage(spark, docs, DATA), f"test-{name}")
        assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} <= before
        if name == "ngram_jaccard_join":
            assert all(r["doc_id"] == r["component_id"] for r in jaccard.joined(docs, p.SHINGLE, p.SIMILARITY).collect())
        if name == "pii":
            assert not any(pii.base_spans(r["text"]) for r in docs.collect())
    assert 0 < docs.count() < n
    out = p.STAGES[-1][1](spark, docs, DATA)
    assert out.count() == docs.count() and all(r["n_tokens"] == len(r["ids"]) for r in out.collect())


def test_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "a text without an id", "en", "s", 0), (3, "one two three four five six", None, None, None), (4, "one two three four five six", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.limit(0)):
        for _, stage in p.STAGES:
            d = p.staged(stage(spark, d, DATA), "test-odd")
    assert d.count() == 0
    kept = p.one_of_near_copies(spark, docs, DATA)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("own", [None, "1m"])
@pytest.mark.parametrize("name, stage", p.STAGES)
def test_batches_to_python(spark, monkeypatch, name, stage, own):
    """Whatever rows a stage returns go to Python in small batches, a size set by the user stays."""
    for module, operator in ((p.toxicity, "train"), (p.toxicity, "not_toxic"), (p.jaccard, "joined"), (p.pii, "redacted"), (p.mixing, "select"), (p.bpe, "encode")):
        monkeypatch.setattr(module, operator, lambda docs, *_, **__: docs.withColumn("component_id", F.col("doc_id")))
    session = spark.newSession()
    if own:
        session.conf.set(common.BATCH, own)
    docs = session.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("four"), 1000).alias("text"))
    stage(session, docs, DATA)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    found = docs.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 4000
    assert max(r["bytes"] for r in found) < (1 << 20 if own else common.BATCH_BYTES) + 10_000
