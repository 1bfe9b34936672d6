"""Exact top-k search by term-at-a-time accumulation.

Vectors become sparse integer rows, floor(scale * x). In a cell of the grid (see grid.py) each
term's postings (positions and weights of the candidates that hold it) are scattered, weighted
by the queries' own components, into dense score arrays; a partition selects each query's k best
and the cells' lists are merged.

Rows: a null vector, or one with a null or non-finite component, or a null id takes no part. An
empty or zero vector takes part with score 0. Shorter vectors count as padded with zeros. Rows
that share an id are candidates each; as queries they are one, with the smallest of the vectors,
and none of them is a candidate of their own id. Components of any size are exact: a cell whose
sums could leave 64 bits is summed in whole numbers of any length, and a score among the k best
that no long holds is an error, never another score. Ties go to the smaller id. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import grid

ROWS_AT_ONCE = 32


def postings(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the candidates that hold it, and their weights."""
    out = []
    for column in m.T:
        at = np.flatnonzero(column)
        out.append((at, column[at]))
    return out


def accumulate(q: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Dense scores of the query rows `q` against the n candidates behind `lists`."""
    scores = np.zeros((len(q), n), q.dtype)
    for t, (at, weights) in enumerate(lists):
        rows = np.flatnonzero(q[:, t])
        if not len(at) or not len(rows):
            continue
        if len(at) * 4 > n * 3 and len(rows) == len(q):
            dense = np.zeros(n, q.dtype)
            dense[at] = weights
            scores += q[:, t, None] * dense
        else:
            for r in rows:
                scores[r, at] += q[r, t] * weights
    return scores


def top_k(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 20, scale: int = 64, query_block: int = 1024, candidate_block: int = 8192) -> DataFrame:
    """The k rows of highest integer inner product for each row where `is_query` holds:
    query_id long, rank int from 1, vec_id long, score long."""
    rows = grid.usable(df, id_col, vector_col)
    # doubles from 2**52 on are whole, and floor() would not take those beyond a long
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < float(1 << 52), F.floor(x * scale).cast("double")).otherwise(x * scale))
    queries = grid.one_row_each(grid.usable(df.where(is_query), id_col, vector_col))

    def kernel(qi: np.ndarray, qm: np.ndarray, ci: np.ndarray, cm: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        bound = max(1.0, np.abs(qm).max(initial=0)) * max(1.0, np.abs(cm).max(initial=0)) * max(1, qm.shape[1])
        if bound < 2**63:
            kind = np.int32 if bound < 2**31 else np.int64
            q, c = qm.astype(kind), cm.astype(kind)
        else:
            q, c = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (qm, cm))
        lists = postings(c)
        for at in range(0, len(q), ROWS_AT_ONCE):
            scores = accumulate(q[at : at + ROWS_AT_ONCE], lists, len(ci))
            for i, row in enumerate(scores):
                other = np.flatnonzero(ci != qi[at + i])
                ids, s = ci[other], row[other]
                if s.dtype == object:
                    best = np.array(sorted(range(len(s)), key=lambda n: (-s[n], ids[n]))[:k], np.int64)
                    if any(abs(x) >= 2**63 for x in s[best]):
                        raise OverflowError(f"a score of query {int(qi[at + i])} doesn't fit a long")
                else:
                    best = grid.top(s, ids, k)
                yield int(qi[at + i]), ids[best], s[best].astype(np.int64)

    return grid.search(queries.withColumn("v", whole), rows.withColumn("v", whole), kernel, k, "long", query_block, candidate_block)


def op2(spark, sf_dir: str) -> DataFrame:
    from logloom.llm.common import table

    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, 1 + least(len(q.e), len(c.e))), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
