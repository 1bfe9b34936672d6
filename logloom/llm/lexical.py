"""Ranked lexical search by a hierarchical max tree over document ranges.

A first pass over the texts keeps, for each document, its length and the counts of the terms
that the queries hold (the index, a staged table). Counts of documents and of terms come from the
index. Then each shard of it (a run of rows of one task, bounded by documents and by postings)
is searched where it lies: a term has for every document range the largest weight it reaches in
it, single documents at the bottom and `FAN` ranges below each higher one. A query opens the
range with the highest sum of its terms' maxima first; a document that comes first has its true
score as its sum and is the next of the k. Of equal sums ranges are opened before a document is
taken, as they may hold a tie with a smaller id. The shards' lists are merged by a window over
the query. Texts aren't shuffled.

Queries are taken in blocks bounded by rows and by terms; each block reads the documents anew.

Rows: null or empty texts and texts without a term are no documents and, as queries, have no
results; a null item_id or doc_id stays as it is. Rows that share an id are documents, or
queries, each on its own. Equal scores go to the smaller doc_id, a null one first. Very long texts are cut
between terms and counted piece by piece. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import slices, staged, table

#: Ranges below a higher one; the lowest hold one document each.
FAN = 8
#: A shard ends at so many documents or postings, whichever comes first.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 22
#: A block of queries has about so many rows and terms at most (one query at least).
BLOCK_QUERIES, BLOCK_TERMS = 2000, 200_000
#: Bytes of a text that are counted at a time.
PIECE = 4 << 20
#: Bytes of terms stand, A-Z becomes a-z, all others are spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "query int, doc_id long, score long"


def counted(text: bytes) -> Counter[bytes]:
    """The terms of a text in UTF-8, with their counts."""
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        out.update(text[at:end].translate(TERM_BYTES).split())
        at = end
    return out


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row for each document with a term: its length, and the numbers and counts of those of
    its terms that `vocabulary` holds. What is sent to tasks is the vocabulary of one block."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, 1):
                ids, lengths, ends, terms, counts = [], [], [0], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    words = counted(text or b"")
                    if words:
                        own = words.keys() & known.keys()
                        terms += [known[w] for w in own]
                        counts += [words[w] for w in own]
                        ids.append(doc_id)
                        lengths.append(words.total())
                        ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX)


class Shard:
    """The index of a run of documents, in order of their ids: by term the documents that hold it
    and its weights in them."""

    def __init__(self, rows: list[pa.RecordBatch], total: int, words: int, weights: np.ndarray):
        t = pa.Table.from_batches(rows).sort_by([("doc_id", "ascending")])
        none = t.column("doc_id").null_count
        t = pa.concat_tables([t.slice(t.num_rows - none), t.slice(0, t.num_rows - none)]).combine_chunks()
        self.ids = t.column("doc_id").to_pylist()
        n = t.column("n").to_numpy()
        m = 100 - 90 + (90 * n * total) // words
        lists = t.column("terms").combine_chunks()
        terms = lists.flatten().to_numpy()
        tf = t.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        docs = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        impacts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
        by_term = np.argsort(terms, kind="stable")
        self.docs, self.impacts = docs[by_term], impacts[by_term]
        self.starts = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))

    def trees(self, query: list[int]) -> list[np.ndarray]:
        """For each level, lowest first, the terms' largest weights by range: the lowest ranges
        are single documents."""
        own = [slice(self.starts[t], self.starts[t + 1]) for t in query if self.starts[t] < self.starts[t + 1]]
        if not own:
            return [np.zeros((1, 1), np.int64)]
        size = -(-len(self.ids) // FAN) * FAN
        levels = [np.zeros((size, len(own)), np.int64)]
        for i, at in enumerate(own):
            levels[0][self.docs[at], i] = self.impacts[at]
        while len(levels[-1]) > 1:
            level = levels[-1]
            level = np.pad(level, ((0, -len(level) % FAN), (0, 0))) if len(level) % FAN else level
            levels.append(level.reshape(-1, FAN, level.shape[1]).max(1))
        return levels

    def search(self, query: list[int], k: int) -> list[tuple[int, int]]:
        """The k best (score, place of the document), best first, ties by place."""
        levels = self.trees(query)
        top = len(levels) - 1
        # a document's sum is its score; among equal sums ranges go first, as they may hold a tie
        heap = [(-int(levels[top][0].sum()), -top, 0)]
        best: list[tuple[int, int]] = []
        while heap and len(best) < k:
            bound, level, node = heapq.heappop(heap)
            if not bound:
                break
            if not level:
                best.append((-bound, node))
                continue
            first = node * FAN
            for i, b in enumerate(levels[-level - 1][first : first + FAN].sum(1).tolist(), first):
                if b:
                    heapq.heappush(heap, (-b, level + 1, i))
        return best


def searched(rows: DataFrame, queries: list[list[int]], total: int, words: int, weights: np.ndarray, k: int) -> DataFrame:
    """The k best documents of each shard of the index for each query of a block."""
    sent = rows.sparkSession.sparkContext.broadcast((queries, weights))

    def answers(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        asked, w = sent.value
        shard, out = Shard(held, total, words, w), []
        for q, query in enumerate(asked):
            out += [{"query": q, "doc_id": shard.ids[place], "score": score} for score, place in shard.search(query, k)]
        return pa.RecordBatch.from_pylist(out, pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = postings = 0
        for batch in batches:
            held.append(batch)
            n, postings = n + batch.num_rows, postings + len(batch.column(2).flatten())
            if n >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield answers(held)
                held, n, postings = [], 0, 0
        if n:
            yield answers(held)

    return rows.mapInArrow(run, FOUND)


def distinct_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms, a row for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [{"item_id": i, "terms": sorted(counted(t.as_py() or b""))} for i, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("item_id", pa.int64()), ("terms", pa.list_(pa.binary()))]))

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "item_id long, terms array<binary>")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k highest-scoring rows of `docs` (doc_id, text) for each row of `items` (item_id,
    text): item_id, rank int from 1, doc_id, score."""
    spark = docs.sparkSession
    asked = staged(distinct_terms(items).where(F.size("terms") > 0).withColumn("block", F.rand(11)), "lexical-queries")
    n, terms = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_QUERIES), -(-terms // BLOCK_TERMS))
    found = []
    for b in range(blocks):
        own = asked.where(F.floor(F.col("block") * blocks) == b).select("item_id", "terms").collect()  # bounded: BLOCK_QUERIES, BLOCK_TERMS
        vocabulary = {w: i for i, w in enumerate(sorted({bytes(w) for r in own for w in r["terms"]}))}
        rows = staged(index(docs, vocabulary), "lexical-index")
        total, words = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term of the block
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        numbers = [[vocabulary[bytes(w)] for w in r["terms"]] for r in own]
        best = searched(rows, numbers, total, words, weights, k)
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], "query int, item_id long")
        found.append(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def op11(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), docs AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0
), sizes AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS words FROM docs
), asked AS (
  SELECT DISTINCT item_id, i, t FROM (
    SELECT item_id, row_number() OVER () AS i,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark)
), postings AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(total) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, sizes GROUP BY t
), scored AS (
  SELECT i, item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * total) // words))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (t) JOIN weights USING (t), sizes
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
