"""Documents linked by the Jaccard similarity of their word shingles: a size-aware join.

Two sets link when their intersection reaches `threshold` (a whole percentage) of their union.
Equal texts are first put together (but for ids that hold several), so that only different ones
are compared. Then:

* Small sets (light): a pair of sizes n and m links if and only if it shares c(n, m) shingles,
  so both list all their subsets of that fixed size and meet under a common one.
* Large sets (heavy): each is scanned against the inverted lists of its prefix, so long that a
  linked pair shares as many of its shingles as its size asks for. Shingles that repeat within
  slabs of all sets stand last in the order that makes the prefix, the commonest at the end, so
  that passages which many documents share drop out of it.
* The boundary between them is where the sizes' histogram makes the sum of both costs least.

Short lists (of at most `LONG_LIST` members) count, for each pair of fitting sizes, how many of
them it shares; with enough the pair is a candidate, and the smaller id its pivot. Long lists
never become pairs: the smallest member is the pivot of all. Every member is held against its
pivot, as rows that stream by in order, a pivot's rows dealt over many tasks. Members of long
lists that link with their pivot are connected through it; each other one (open) is held against
all members, in cells of bounded size. A pair that shares a long list is therefore compared,
unless both link with the pivot, and one that shares none has all its shared shingles counted;
so no link between different texts is lost, and g near copies cost g comparisons.

Rows: a null or empty text, or one without words, has an empty set and links with nothing; its
component is itself. Rows of equal doc_id are one node with all their links (its size is the
largest). A row with a null doc_id takes no part and has a null component. A very long text is
a large set like any other, held whole by one task at a time. An empty table gives no rows.
Shingles are counted by hashes of 64 bits and compared by 48 of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import slices, staged, table, unstaged

#: A shingle that repeats so often within slabs of so many shingles is common.
COMMON, SLAB = 8, 1 << 20
#: At most so many common shingles are sent to the tasks: with more, only the commonest.
COMMON_MOST = 1 << 20
#: One more shared prefix shingle is asked for with so many shingles of the larger set.
SHARED_STEP = 64
#: Longer lists than this aren't counted pair by pair.
LONG_LIST = 96
#: A block of a cell holds about so many shingles and documents; a pivot's rows are dealt out
#: in blocks of so many documents.
BLOCK_TOKENS, BLOCK_DOCS = 1 << 18, 1024
#: Up to so many ids, or digests of copied texts, are broadcast; more are joined by a shuffle,
#: in which each digest has so many keys.
BROADCAST_IDS, BROADCAST_DIGESTS, SALTS = 1 << 20, 1 << 17, 32
#: What a scanned entry of an inverted list costs, in subsets.
SCAN_COST = 4.0
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a UTF-8 text, lower-cased A-Z."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, raw.lower().split()), np.uint64)
    if not len(h):
        return h
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out * MIX + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes, 6 bytes each."""
    return np.ascontiguousarray((hashes >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def overlap(n: int, m: int, t: int) -> int:
    """The least intersection with which sets of sizes n and m link."""
    return -(-t * (n + m) // (100 + t))


def partner_sizes(n: int, t: int) -> range:
    return range(-(-t * n // 100), 100 * n // t + 1)


def common_least(n: int) -> int:
    """How many prefix shingles a pair must share whose larger set has size n."""
    return 1 + n // SHARED_STEP


def prefix_length(n: int, t: int) -> int:
    """So long that linked sets share as many shingles of their prefixes as is asked of them."""
    return min(n, n - -(-t * n // 100) + common_least(100 * n // t))


def subset_sizes(n: int, t: int, boundary: int) -> list[int]:
    return sorted({overlap(n, m, t) for m in partner_sizes(n, t) if m <= boundary}) if n <= boundary else []


def light_cost(n: int, t: int, boundary: int) -> float:
    return float(sum(comb(n, c) for c in subset_sizes(n, t, boundary)))


def best_boundary(sizes: dict[int, int], t: int) -> int:
    """The size up to which sets are small."""
    heavy = {n: prefix_length(n, t) * (1 + SCAN_COST) * c for n, c in sizes.items()}
    best, least = 0, sum(heavy.values())
    for b in range(1, 41):
        cost = sum(light_cost(n, t, b) * c for n, c in sizes.items() if n <= b) + sum(v for n, v in heavy.items() if 100 * n // t > b)
        if cost < least:
            best, least = b, cost
    return best


SETS = "doc_id long, n int, tokens binary"


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, tokens) of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                s = [shingles(t or b"", k) for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in s], pa.int32()), pa.array(list(map(packed, s)), pa.binary())], names=["doc_id", "n", "tokens"])

    return docs.mapInArrow(run, SETS)


def among(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of the rows with staged ids, broadcast behind a count."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def repeats(sets: DataFrame, t: int, boundary: int) -> DataFrame:
    """(token, count): shingles of the large sets that occur more than once within a slab of
    them, counted slab by slab. What occurs once stays in its task."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token[n > 1].view(np.int64)), pa.array(n[n > 1], pa.int64())], names=["token", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if n and 100 * n // t > boundary:
                    held.append(unpacked(raw.as_py()))
                    size += n
                    if size >= SLAB:
                        yield counted(held)
                        held, size = [], 0
        if held:
            yield counted(held)

    return sets.select("n", "tokens").mapInArrow(run, "token long, count long").groupBy("token").agg(F.sum("count").alias("count"))


def common_tokens(sets: DataFrame, t: int, boundary: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand last in the order, sorted, and their places among these by count; at
    most COMMON_MOST (any order gives the same links; a better one makes shorter lists)."""
    counts = staged(repeats(sets, t, boundary).where(F.col("count") >= COMMON), "jaccard-common")
    # the least power of two from which on there are few enough
    sizes = {r["power"]: r["n"] for r in counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}
    power = max(sizes, default=0) + 1
    while power > 0 and sum(n for p, n in sizes.items() if p >= power - 1) <= COMMON_MOST:
        power -= 1
    rows = counts.where(F.col("count") >= 1 << power).toArrow()
    unstaged(counts)
    token, n = (rows.column(c).to_numpy() for c in ("token", "count"))
    token = token[order := np.argsort(token)].astype(np.int64).view(np.uint64)
    rank = np.empty(len(token), np.int32)
    rank[np.lexsort((token, n[order]))] = np.arange(len(token))
    return token, rank


def keys(sets: DataFrame, t: int, boundary: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, doc_id, n): the lists that a set is in, and its size. Linked sets share a list."""
    late = sets.sparkSession.sparkContext.broadcast(common)

    def prefix(tokens: np.ndarray, p: int) -> list[np.ndarray]:
        common, rank = late.value
        if not len(common):
            return [tokens[:p]]
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        late_ones = common[at] == tokens
        first = tokens[~late_ones][:p]
        return [first, common[at[late_ones]][np.argsort(rank[at[late_ones]])][: p - len(first)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                out, ids, sizes = [], [], []
                for doc_id, n, raw in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if n:
                        tokens = unpacked(raw)
                        own = prefix(tokens, prefix_length(n, t)) if 100 * n // t > boundary else []
                        for c in subset_sizes(n, t, boundary):
                            own.append(np.fromiter((xxhash.xxh3_64_intdigest(tokens[list(x)].tobytes(), seed=c) for x in combinations(range(len(tokens)), c)), np.uint64))
                        out += own
                        ids.append(doc_id)
                        sizes.append((n, sum(map(len, own))))
                if out:
                    n, each = np.array(sizes).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), each)), pa.array(np.repeat(n, each), pa.int32())], names=["key", "doc_id", "n"])

    return sets.mapInArrow(run, "key long, doc_id long, n int")


def members_of(lists: DataFrame, t: int) -> DataFrame:
    """(pivot, doc_id, whole): what is to be held against a pivot. `whole` members come from long
    lists, so that any two of one pivot may link."""
    counted = lists.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("length")).where("length > 1")
    shared = staged(lists.join(counted, "key"), "jaccard-lists")
    long = shared.where(F.col("length") > LONG_LIST).where("doc_id <> pivot").select("pivot", "doc_id", F.lit(True).alias("whole")).distinct()
    short = shared.where(F.col("length") <= LONG_LIST).select("key", "doc_id", "n")
    pairs = short.toDF("key", "a", "na").join(short.toDF("key", "b", "nb"), "key")
    pairs = pairs.where("a < b").where(100 * F.least("na", "nb") >= t * F.greatest("na", "nb"))
    # by sizes too: an id's texts are counted apart, so that a large one doesn't ask more of a small one
    found = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
    found = found.where(F.col("shared") >= 1 + F.floor(F.greatest("na", "nb") / SHARED_STEP)).select(F.col("a").alias("pivot"), F.col("b").alias("doc_id"), F.lit(False).alias("whole"))
    out = staged(long.unionByName(found).groupBy("pivot", "doc_id").agg(F.max("whole").alias("whole")), "jaccard-members")
    unstaged(shared)
    return out


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links(sizes: np.ndarray, left: np.ndarray, sets: list[np.ndarray], t: int) -> Iterator[tuple[int, int]]:
    """Positions of linked sets, one of them in `left` and, if there are two blocks, one not.
    Shingles that only one of the sets has are dropped, then intersections are counted for a
    block of rows at a time."""
    tokens, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(where)
    keep = often[where] > 1
    where, owner = (np.cumsum(often > 1) - 1)[where[keep]], owner[keep]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    n, width = len(sets), int(where[-1]) + 1 if len(where) else 0
    right = np.flatnonzero(~left) if not left.all() else np.arange(n)
    rows = np.flatnonzero(left)
    shared = np.zeros((len(rows), len(right)), np.float32)
    row_of, col_of = np.full(n, -1), np.full(n, -1)
    row_of[rows], col_of[right] = np.arange(len(rows)), np.arange(len(right))
    step = max(1, min(width, (1 << 22) // max(1, n)))  # columns at a time
    for at in range(0, width, step):
        lo, hi = np.searchsorted(where, [at, at + step])
        o, w = owner[lo:hi], where[lo:hi] - at
        a, b = np.zeros((len(rows), step), np.float32), np.zeros((len(right), step), np.float32)
        mine = row_of[o] >= 0
        a[row_of[o[mine]], w[mine]] = 1
        other = col_of[o] >= 0
        b[col_of[o[other]], w[other]] = 1
        live_a, live_b = np.flatnonzero(a.any(axis=1)), np.flatnonzero(b.any(axis=1))
        if len(live_a) and len(live_b):
            shared[np.ix_(live_a, live_b)] += a[live_a] @ b[live_b].T
    need = (100 + t) * shared.astype(np.int64) >= t * (sizes[rows][:, None] + sizes[right][None, :])
    for i, j in zip(*np.nonzero(need), strict=True):
        if rows[i] != right[j]:
            yield int(rows[i]), int(right[j])


def linked(a: np.ndarray, b: np.ndarray, t: int) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < t * len(b):
        return False
    shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return (100 + t) * shared >= t * (len(a) + len(b))


def against_pivots(members: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """The members with `linked`, whether they link with their pivot; a row for each of an id's
    texts. A pivot's rows are dealt out in blocks, to each of which its sets go first; a task
    holds one pivot's sets at a time."""
    large = members.groupBy("pivot").count().where(F.col("count") > BLOCK_DOCS)
    large = staged(large.select("pivot", F.ceil(F.col("count") / BLOCK_DOCS).cast("int").alias("blocks")), "jaccard-large")
    if large.count() <= BROADCAST_IDS:
        large = F.broadcast(large)
    dealt = members.join(large, "pivot", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), F.lit(0))).drop("blocks")
    first = dealt.select("pivot", "block").distinct().withColumn("doc_id", F.col("pivot")).withColumn("whole", F.lit(False)).withColumn("role", F.lit(0))
    rows = first.unionByName(dealt.withColumn("role", F.lit(1))).join(sets, "doc_id")
    rows = rows.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "role").select("pivot", "doc_id", "whole", "role", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, []
        for batch in batches:
            for part in slices(batch, 4):
                out = []
                for p, doc_id, whole, role, raw in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if role:
                        tokens = unpacked(raw)
                        out.append((p, doc_id, whole, any(linked(x, tokens, t) for x in own)))
                    elif p == pivot and not after:
                        own.append(unpacked(raw))
                    else:
                        pivot, own = p, [unpacked(raw)]
                    after = role
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.bool_(), pa.bool_()), strict=True)], names=["pivot", "doc_id", "whole", "linked"])

    return rows.mapInArrow(run, "pivot long, doc_id long, whole boolean, linked boolean")


def edges(sets: DataFrame, lists: DataFrame, t: int) -> DataFrame:
    """(a, b): links enough to connect what is connected."""
    members = members_of(lists, t)
    wanted = staged(members.select("doc_id").unionByName(members.select(F.col("pivot").alias("doc_id"))).distinct(), "jaccard-wanted")
    needed = staged(among(sets, wanted, "left_semi"), "jaccard-sets")
    checked = staged(against_pivots(members, needed, t), "jaccard-checked")
    direct = checked.where("linked").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"))
    # what doesn't link with the pivot of a long list may link with any other of its members
    sizes = needed.groupBy("doc_id").agg(F.sum("n").alias("n"))
    open_ = checked.where("whole AND NOT linked").select("pivot", "doc_id").distinct()
    groups = staged(open_.join(sizes, "doc_id").groupBy("pivot").agg(F.sum("n").alias("tokens"), F.count("*").alias("size")), "jaccard-open")
    whole = checked.where("whole").select("pivot", "doc_id").distinct()
    of = groups.join(whole, "pivot").join(sizes, "doc_id").groupBy("pivot", "tokens", "size").agg(F.sum("n").alias("all_tokens"), F.count("*").alias("all"))
    blocks = lambda tokens, n: F.greatest(F.ceil(F.col(tokens) / BLOCK_TOKENS), F.ceil(F.col(n) / BLOCK_DOCS)).cast("int")
    of = staged(of.select("pivot", blocks("tokens", "size").alias("rows"), blocks("all_tokens", "all").alias("columns")), "jaccard-grid")
    of = F.broadcast(of) if of.count() <= BROADCAST_IDS else of
    place = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = open_.join(of, "pivot").select("pivot", "doc_id", F.lit(True).alias("left"), place("rows").alias("i"), every("columns").alias("j"))
    right = whole.join(of, "pivot").select("pivot", "doc_id", F.lit(False).alias("left"), every("rows").alias("i"), place("columns").alias("j"))
    cells = left.unionByName(right).join(needed, "doc_id")

    def run(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        ids, sizes = table.column("doc_id").to_numpy(), table.column("n").to_numpy().astype(np.int64)
        out, forest = [], Forest(len(ids))
        if left.any() and not left.all():
            for a, b in links(sizes, left, [unpacked(x) for x in table.column("tokens").to_pylist()], t):
                if ids[a] != ids[b] and forest.join(a, b):
                    out.append((ids[a], ids[b]))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return direct.unionByName(cells.groupBy("pivot", "i", "j").applyInArrow(run, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component): the smallest id reachable, for the ids that have links. Alternates
    large and small stars, each round written out, until nothing changes: every node comes to
    hang on the smallest node of its component in a number of rounds that is logarithmic."""
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = staged(both, "components")
    seen = None
    while True:
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours hang on the smallest neighbour or the node itself
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node hang on the smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, now = now, staged(small, "components")
        unstaged(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("doc_id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("doc_id"), F.col("v").alias("component")).distinct())
        seen = state


def copies_of(digest: DataFrame) -> DataFrame:
    """(doc_id, first) of the rows (doc_id, digest) that are copies of the text of a smaller id."""
    first = digest.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    first = staged(first, "jaccard-first")
    if first.count() <= BROADCAST_DIGESTS:
        found = digest.join(F.broadcast(first), "digest")
    else:  # a text that a third of all rows holds has many keys
        first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = digest.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(first, ["digest", "salt"])
    return staged(found.where("doc_id <> first").select("doc_id", "first"), "jaccard-copies")


def joined(docs: DataFrame, k: int = 3, t: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id IS NOT NULL")
    digest = staged(known.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest")), "jaccard-digests")
    # an id with several texts keeps them all: only ids with one text are copies, and have copies
    several = digest.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least < most")
    copies = copies_of(among(digest, staged(several.select("doc_id"), "jaccard-several"), "left_anti"))
    ids = staged(copies.select("doc_id").distinct(), "jaccard-copied")
    unstaged(digest)
    sets = staged(sets_of(among(known, ids, "left_anti"), k), "jaccard-sets-of")
    sizes = {r["n"]: r["count"] for r in sets.groupBy(F.least("n", F.lit(4096)).alias("n")).count().collect()}
    boundary = best_boundary(sizes, t)
    lists = keys(sets, t, boundary, common_tokens(sets, t, boundary))
    found = components(edges(sets, lists, t))
    of = sets.groupBy("doc_id").agg(F.max("n").alias("n"))
    nodes = of.join(found, "doc_id", "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    # an empty set links with nothing, not even with its copies
    same = copies.join(nodes.withColumnRenamed("doc_id", "first"), "first").select("doc_id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component"))
    out = nodes.unionByName(same).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
    nulls = sets_of(docs.where("doc_id IS NULL"), k).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nulls)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM t
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM t
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) m USING (doc_id)
"""
