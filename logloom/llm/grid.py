"""Blocks of vectors, and the grid that pairs every query block with every candidate block.

Rows are packed into blocks where they lie (no shuffle, so a vector or an id held by a third of
all rows makes no hot block). A block gets a hashed coordinate; each cell of the grid gathers
the few query and candidate blocks with its coordinates, so that what a task holds depends on
the block sizes and never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "block long, ids binary, vectors binary, n int, dim int"


def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool = False) -> DataFrame:
    """(id, v) of the rows whose id and vector are not null and whose components are all
    finite; with `nonzero` also without zero (or empty) vectors."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    if nonzero:
        out = out.where(F.exists(v, lambda x: x != 0))
    return out.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def pack(df: DataFrame, rows: int) -> DataFrame:
    """(id, v) rows as blocks of at most `rows` rows; shorter vectors are padded with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 24
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                column = part.column(1)
                lengths = np.diff(column.offsets.to_numpy())
                dim = int(lengths.max(initial=0))
                m = np.zeros((part.num_rows, dim))
                m[np.arange(dim)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_pylist(
                    [{"block": serial, "ids": ids.tobytes(), "vectors": m.tobytes(), "n": part.num_rows, "dim": dim}],
                    schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("n", pa.int32()), ("dim", pa.int32())]),
                )
                serial += 1

    return df.mapInArrow(run, BLOCK)


def unpack(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a cell's blocks of one kind."""
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["block"])
    dim = max((r["dim"] for r in rows), default=0)
    out = np.zeros((sum(r["n"] for r in rows), dim))
    at = 0
    for r in rows:
        out[at : at + r["n"], : r["dim"]] = np.frombuffer(r["vectors"]).reshape(r["n"], r["dim"])
        at += r["n"]
    ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
    return (np.concatenate(ids) if ids else np.zeros(0, np.int64)), out


def search(
    queries: DataFrame,
    candidates: DataFrame,
    kernel: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]],
    k: int,
    score_type: str,
    query_block: int,
    candidate_block: int,
) -> DataFrame:
    """Each query's k best: query_id, rank, vec_id, score. `kernel(query ids, query matrix,
    candidate ids, candidate matrix)` yields (query id, ids, scores), k at most, for a cell;
    the cells' lists are merged by a window over the query."""
    q_cells = max(1, -(-queries.count() // query_block))
    c_cells = max(1, -(-candidates.count() // candidate_block))
    at = lambda n, seed: F.pmod(F.xxhash64(F.col("block"), F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = pack(queries, query_block).select(F.lit(0).alias("kind"), "*", at(q_cells, 1).alias("qc"), every(c_cells).alias("cc"))
    c = pack(candidates, candidate_block).select(F.lit(1).alias("kind"), "*", every(q_cells).alias("qc"), at(c_cells, 2).alias("cc"))
    kind = pa.int64() if score_type == "long" else pa.float64()

    def cell(table: pa.Table) -> pa.Table:
        qi, qm = unpack(table, 0)
        ci, cm = unpack(table, 1)
        dim = max(qm.shape[1], cm.shape[1])
        qm, cm = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (qm, cm))
        found = list(kernel(qi, qm, ci, cm)) if len(qi) and len(ci) else []
        join = lambda parts, t: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), t)
        return pa.table({
            "query_id": join([np.full(len(ids), q) for q, ids, _ in found], pa.int64()),
            "vec_id": join([ids for _, ids, _ in found], pa.int64()),
            "score": join([s for *_, s in found], kind),
        })

    best = q.unionByName(c).groupBy("qc", "cc").applyInArrow(cell, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def one_row_each(queries: DataFrame) -> DataFrame:
    """A query id that several rows hold is one query, with the smallest of their vectors."""
    return queries.groupBy("id").agg(F.min("v").alias("v"))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, highest first, ties to the smaller id."""
    if len(scores) > k:
        where = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        where = np.arange(len(scores))
    return where[np.lexsort((ids[where], -scores[where]))[:k]]
