"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index: a candidate, less its block's mean, is turned by a seeded random rotation; the signs of
its components are its packed code, and two scalars correct it: its length, and the inner
product of its direction with the code's direction. Search: a query's inner product with the
code, divided by that second scalar, estimates the true one with an error bound; the best
estimates are computed exactly, and then every vector whose estimate plus bound reaches the
k-th best so far. Every row is indexed; there is no cap on what is reranked.

Rows: a null, empty or zero vector, one with a null or non-finite component and a null id take
no part. Shorter vectors count as padded with zeros. Rows that share an id are candidates each;
as queries they are one, with the smallest of the vectors, and none of them is a candidate of
their own id. Ties go to the smaller id. Fewer than k candidates are all returned. An empty
table gives no rows. Scores are sums in double precision in the order of the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import grid

ROWS_AT_ONCE = 64


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """The index of a block of candidates."""

    def __init__(self, m: np.ndarray, seed: int):
        self.bits = -(-m.shape[1] // 8) * 8
        self.turn = rotation(self.bits, seed)[: m.shape[1]]
        self.mean = m.mean(axis=0)
        turned = (m - self.mean) @ self.turn
        self.length = np.sqrt((turned**2).sum(axis=1))
        self.packed = np.packbits(turned > 0, axis=1)
        safe = np.where(self.length > 0, self.length, 1)
        self.agreement = np.abs(turned).sum(axis=1) / np.sqrt(self.bits) / safe
        self.agreement[self.agreement == 0] = 1

    def estimate(self, q: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with the rows of q, and their error bounds."""
        signs = np.unpackbits(self.packed, axis=1).astype(np.float32) * 2 - 1
        turned = (q @ self.turn).astype(np.float32)
        est = turned @ signs.T / np.sqrt(self.bits) * (self.length / self.agreement).astype(np.float32) + (q @ self.mean)[:, None]
        spread = self.length * np.sqrt(np.maximum(0, 1 - self.agreement**2)) / self.agreement * (width / np.sqrt(max(1, self.bits - 1)))
        return est, np.sqrt((q**2).sum(axis=1))[:, None] * (spread + 1e-5 * self.length) + 1e-6 * np.abs(est)


def exact(q: np.ndarray, columns: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at))
    for x, column in zip(q, columns, strict=True):
        out += x * column[at]
    return out


def nearest(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 20, width: float = 3.0, first: int = 64, seed: int = 7, query_block: int = 1024, candidate_block: int = 8192) -> DataFrame:
    """The k rows found of largest inner product for each row where `is_query` holds:
    query_id long, rank int from 1, vec_id long, score double. `width` scales the error
    bounds, `first` estimates are computed exactly before the bounds choose the rest."""
    rows = grid.usable(df, id_col, vector_col, nonzero=True)
    queries = grid.one_row_each(grid.usable(df.where(is_query), id_col, vector_col, nonzero=True))

    def kernel(qi: np.ndarray, qm: np.ndarray, ci: np.ndarray, cm: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        codes, columns = Codes(cm, seed), np.ascontiguousarray(cm.T)
        for at in range(0, len(qi), ROWS_AT_ONCE):
            est, err = codes.estimate(qm[at : at + ROWS_AT_ONCE], width)
            for i in range(len(est)):
                own, q = ci == qi[at + i], qm[at + i]
                upper = np.where(own, -np.inf, est[i] + err[i])
                likely = np.argpartition(np.where(own, np.inf, -est[i]), min(first, len(ci)) - 1)[:first]
                likely = likely[~own[likely]]
                scores = exact(q, columns, likely)
                bar = np.sort(scores)[-k] if len(scores) >= k else -np.inf
                chosen = np.flatnonzero((upper >= bar) & ~own)
                chosen = np.union1d(chosen, likely)
                scores = exact(q, columns, chosen)
                best = grid.top(scores, ci[chosen], k)
                yield int(qi[at + i]), ci[chosen][best], scores[best]

    return grid.search(queries, rows, kernel, k, "double", query_block, candidate_block)


def op7(spark, sf_dir: str) -> DataFrame:
    from logloom.llm.common import table

    return nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


#: Brute force: at the default width the bounds leave out a true neighbour about as rarely as
#: a normal variable strays by three of its deviations, which the tests measure.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_reduce(list_transform(range(1, 1 + least(len(q.e), len(c.e))), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
