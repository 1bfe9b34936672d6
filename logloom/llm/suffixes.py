"""Suffix-array dedup: bytes covered by a string of `LENGTH` bytes that also starts earlier.

Which windows of `LENGTH` bytes can repeat is found by anchors: of the 32-byte strings in a
window the one with the smallest hash (the leftmost of equal ones). Equal windows have equal
anchors at the same place, so only windows of anchors whose hash occurs twice are looked at, and
an anchor's windows (a run of starts) are treated together. Runs with equal bytes are one, kept
by its first start; all others are covered whole. What is left in the group of an anchor are runs
that differ somewhere: their bytes from the anchor on, and those before it read backwards, are
sorted as suffixes by deep-shallow sorting (multikey quicksort on eight bytes at a time down to
`SHALLOW` bytes, blind tries for the groups that are still equal there). The sorted orders with
their common prefixes say for each distance to the anchor which windows are equal; the smallest
start of each such class stays.

Groups of many different runs (one passage in a third of all documents, each time in another
place) aren't gathered: their windows become rows with a 128-bit hash each, so that a class is
only the minimum of its starts. Equal runs, too, are found by 128 bits (anchor and content).

Rows: a null text is empty. A null doc_id comes after all others. Rows that share a doc_id are
one document with several texts: a window is earlier if its (doc_id, start) is smaller, so equal
starts cover neither. Texts of any length are read whole, in slices that overlap. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import slices, staged, table, unstaged

LENGTH, GRAM = 100, 32
#: Anchor places of a window.
PLACES = LENGTH - GRAM + 1
#: Bytes that are hashed at a time, and bits for a place among them (a slice is no
#: longer). The hashes' other bits choose the anchors, so the bits are the same everywhere.
SLICE, PLACE_BITS = 1 << 20, np.uint64(20)
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 40
#: Runs of an anchor that are sorted together; more become rows for each window.
GROUP = 4096
#: Runs of a sorted bucket of anchors, about.
BUCKET = 16_384
#: Repeated anchors that may be broadcast.
BROADCAST_ANCHORS = 4_000_000

RUNS = pa.schema([("doc", pa.int64()), ("same", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64()), ("at", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
COVERED = pa.schema([("doc", pa.int64()), ("same", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
KEY = ["doc", "same"]


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int' if f.type == pa.int32() else 'boolean' if f.type == pa.bool_() else 'binary'}" for f in schema)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over documents laid end to end (`ends`: where each ends): for each run of windows with the
    same anchor its hash, its place, and the first and last start of the run."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    h = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(0xD6E8FEB86659FD93, size, 1 << 64)) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # hash above, place below: the smallest of a window is its anchor
    least = ((h >> PLACE_BITS) << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= PLACES:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(data) - LENGTH + 1
    least = np.minimum(least[:n], least[PLACES - size : PLACES - size + n])
    place = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    owner = np.searchsorted(ends, np.arange(n), side="right")
    inside = np.arange(n) + LENGTH <= ends[owner]
    first = np.flatnonzero(inside & np.concatenate([[True], (place[1:] != place[:-1]) | ~inside[:-1]]))
    last = np.flatnonzero(inside & np.concatenate([(place[1:] != place[:-1]) | ~inside[1:], [True]]))
    return h[place[first]], place[first], first, last


def keyed(docs: DataFrame) -> DataFrame:
    """doc (null ids last), same (tells rows of one id apart), doc_id, text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(doc.isNull(), text).alias("same"), doc.alias("doc_id"), text.cast("binary").alias("text"))


def laid_out(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes laid end to end, where each text ends, its row, and where in its text it starts: a
    long text comes in overlapping slices."""
    column = part.column(part.schema.get_field_index("text"))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    held: list[tuple[int, int, int]] = []
    size = 0

    def out() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        parts = [data[offsets[i] + a : offsets[i] + b] for i, a, b in held]
        return np.concatenate(parts), np.cumsum([b - a for _, a, b in held]), np.array([i for i, _, _ in held]), np.array([a for _, a, _ in held])

    for i, n in enumerate(np.diff(offsets).tolist()):
        for at in range(0, max(0, n - LENGTH + 1), SLICE - LENGTH):
            end = min(n, at + SLICE - 1)  # windows that start before the next slice does
            if size + end - at > SLICE:
                yield out()
                held, size = [], 0
            held.append((i, at, end))
            size += end - at
    if held:
        yield out()


def runs_of(docs: DataFrame, only_anchors: bool = False) -> DataFrame:
    """The runs of all texts (RUNS): `at` is the anchor's place, the windows start from low to
    high before it; or only the anchors' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, SLICE):
                doc, same = part.column(0).to_numpy(), part.column(1).to_numpy()
                for data, ends, row, start in laid_out(part):
                    h, place, first, last = anchors(data, ends)
                    if only_anchors:
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["anchor"])
                        continue
                    owner = np.searchsorted(ends, first, side="right")
                    begin = np.concatenate([[0], ends[:-1]])[owner]
                    low, high = place - first, place - last
                    view = memoryview(data)
                    content = np.array([xxhash.xxh3_64_intdigest(view[a : b + LENGTH], p - a) for a, b, p in zip(first.tolist(), last.tolist(), place.tolist(), strict=True)], np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[row[owner]], same[row[owner]], h.view(np.int64), content.view(np.int64), place - begin + start[owner], low.astype(np.int32), high.astype(np.int32))], schema=RUNS)

    return docs.mapInArrow(run, "anchor long" if only_anchors else ddl(RUNS))


def first_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest (doc, at) of each key, with how many rows it has."""
    return rows.groupBy(*keys).agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n"))


def is_first() -> Column:
    return (F.col("doc") == F.col("first.doc")) & (F.col("at") == F.col("first.at"))


# --- deep-shallow sorting


def blind_trie(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of `texts` (places; equal ones stand together), and the common prefix of each
    with the one before it. A node is [depth, {byte: child}] and looks only at the byte at its
    depth; a leaf is the list of the places of equal texts. -1 is the end of a text."""
    wide = max(map(len, texts)) + 1
    whole = [int.from_bytes(t.ljust(wide, b"\0")) for t in texts]
    byte = lambda t, at: t[at] if at < len(t) else -1
    root: list | None = None
    for i, t in enumerate(texts):
        if root is None:
            root = [-1, {0: (i, [i])}]
            continue
        node = root[1][0]
        while isinstance(node, list):  # blindly down to some leaf
            node = node[1].get(byte(t, node[0])) or next(iter(node[1].values()))
        other, same = node
        common = min(wide - (((whole[i] ^ whole[other]).bit_length() + 7) >> 3), len(t), len(texts[other]))
        if common == len(t) == len(texts[other]):
            same.append(i)
            continue
        above, way, node = root, 0, root[1][0]
        while isinstance(node, list) and node[0] < common:
            above, way = node, byte(t, node[0])
            node = node[1][way]
        if isinstance(node, list) and node[0] == common:
            node[1][byte(t, common)] = (i, [i])
        else:
            above[1][way] = [common, {byte(texts[other], common): node, byte(t, common): (i, [i])}]
    order: list[int] = []
    common_before: list[int] = []
    stack: list[tuple[object, int]] = [(root[1][0], 0)]
    while stack:
        node, depth = stack.pop()
        if isinstance(node, list):
            below = sorted(node[1].items(), reverse=True)
            for n, (_, child) in enumerate(below):
                # the first child takes the depth that its parent was reached with
                stack.append((child, depth if n == len(below) - 1 else node[0]))
        else:
            first, same = node
            order += same
            common_before += [depth, *[len(texts[first])] * (len(same) - 1)]
    return order, common_before


def deep_shallow(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of `texts`, and for each the common prefix with the one before it."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts])
    order, common = np.arange(n), np.zeros(n, np.int64)
    group = np.zeros(n, np.int64)  # of each place in `order`
    open_ = np.ones(n, bool)
    for depth in range(0, SHALLOW, 8):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        own = order[at]
        word = np.frombuffer(b"".join(texts[i][depth : depth + 8].ljust(8, b"\0") for i in own.tolist()), ">u8").astype(np.uint64)
        left = np.minimum(lengths[own] - depth, 8)
        by = np.lexsort((left, word, group[at]))
        own, word, left, g = own[by], word[by], left[by], group[at]
        order[at] = own
        same_group = np.concatenate([[False], g[1:] == g[:-1]])
        differs = np.concatenate([[True], (word[1:] != word[:-1]) | (left[1:] != left[:-1])])
        new = ~same_group | differs
        inner = np.flatnonzero(same_group & differs)
        xor = word[inner] ^ word[inner - 1]
        bits = np.zeros(len(inner), np.int64)
        for shift in (32, 16, 8):  # bytes of the words that differ
            high = (xor >> np.uint64(shift)) != 0
            xor = np.where(high, xor >> np.uint64(shift), xor)
            bits += np.where(high, shift // 8, 0)
        bytes_equal = np.where(word[inner] == word[inner - 1], 8, 7 - bits)
        common[at[inner]] = depth + np.minimum(bytes_equal, np.minimum(left[inner], left[inner - 1]))
        group[at] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        ended = left < 8  # equal ones among these are equal texts
        together = np.flatnonzero(ended & ~new)
        common[at[together]] = lengths[order[at[together]]]
        sizes = np.bincount(group[at], minlength=n)
        open_[at] = (sizes[group[at]] > 1) & ~ended
    at = np.flatnonzero(open_)
    if len(at):
        cuts = np.flatnonzero(np.concatenate([[True], group[at][1:] != group[at][:-1]]))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True):
            places = at[low:high]
            own = order[places]
            by, before = blind_trie([texts[i] for i in own.tolist()])
            order[places] = own[by]
            common[places[1:]] = before[1:]
    return order, common


def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """A number for each text, equal where the first `depth` bytes are."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeats(rows: list[tuple[int, int, int, int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """(doc, same, first and last start) of the covered windows among the runs (anchor, doc,
    same, at, low, high, bytes) of some anchors."""
    rows.sort(key=lambda r: (r[1], r[3]))
    doc, at, low, high = (np.array([r[i] for r in rows], np.int64) for i in (1, 3, 4, 5))
    rank = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])]))
    right = deep_shallow([r[6][r[4] :] for r in rows])
    left = deep_shallow([r[6][: r[4]][::-1] for r in rows])
    out = []
    for j in range(PLACES):  # windows that start j bytes before the anchor
        own = np.flatnonzero((high <= j) & (j <= low))
        if len(own) < 2:
            continue
        key = classes(*left, j)[own] * (len(rows) + 1) + classes(*right, LENGTH - j)[own]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        hit = own[rank[own] > rank[own[first]][which]]
        out.append(np.stack([hit, at[hit] - j]))
    if not out:
        return []
    hits = np.concatenate(out, 1)
    hits = hits[:, np.lexsort((hits[1], hits[0]))]
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(hits[0]) != 0) | (np.diff(hits[1]) != 1)])) if hits.shape[1] else np.zeros(0, int)
    end = np.concatenate([begin[1:], [hits.shape[1]]]) - 1 if len(begin) else begin
    return [(rows[i][1], rows[i][2], a, b) for i, a, b in zip(hits[0][begin].tolist(), hits[1][begin].tolist(), hits[1][end].tolist(), strict=True)]


# --- the search for covered windows


def with_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The runs of `wanted` with the bytes of their windows: all in one pass, as each shuffles the texts."""
    each = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "at", "low", "high", "many")).alias("runs"))
    schema = pa.schema([("anchor", pa.int64()), *((c, pa.int64()) for c in KEY), ("at", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("bytes", pa.binary()), ("many", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                out = []
                for doc, same, text, runs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for r in runs:
                        out.append((r["anchor"], doc, same, r["at"], r["low"], r["high"], text[r["at"] - r["low"] : r["at"] - r["high"] + LENGTH], r["many"]))
                        if len(out) == BUCKET:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    # rows that share an id and a text are one here, as their runs are
    one = texts.select(*KEY, "text").join(each, KEY)
    return one.mapInArrow(run, ddl(schema))


def sorted_repeats(rows: DataFrame, buckets: int) -> DataFrame:
    """COVERED of runs with bytes, bucket by bucket of anchors."""
    rows = rows.drop("many")

    def run(t: pa.Table) -> pa.Table:
        found = repeats(list(zip(*(t.column(c).to_pylist() for c in ("anchor", *KEY, "at", "low", "high", "bytes")), strict=True)))
        return pa.Table.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], schema=COVERED)

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets))
    return rows.groupBy(bucket.alias("bucket")).applyInArrow(run, ddl(COVERED))


def window_repeats(rows: DataFrame) -> DataFrame:
    """COVERED of runs with bytes, each window a row of its own."""
    schema = pa.schema([("one", pa.int64()), ("two", pa.int64()), *((c, pa.int64()) for c in KEY), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 6, SLICE):
                out = []
                for _, doc, same, at, low, _, data, _ in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for i in range(len(data) - LENGTH + 1):
                        h = xxhash.xxh3_128_digest(data[i : i + LENGTH])
                        out.append((int.from_bytes(h[:8], signed=True), int.from_bytes(h[8:], signed=True), doc, same, at - low + i))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], schema=schema)

    windows = staged(rows.mapInArrow(run, ddl(schema)), "suffixes-windows")
    firsts = first_of(windows, ["one", "two"]).where("n > 1")
    return windows.join(firsts, ["one", "two"]).where(~is_first()).select(*KEY, F.col("at").alias("low"), F.col("at").alias("high"))


def covered(texts: DataFrame) -> DataFrame:
    """COVERED: starts (first to last) of the windows that also start earlier."""
    often = staged(runs_of(texts, only_anchors=True).groupBy("anchor").count().where("count > 1").select("anchor"), "suffixes-anchors")
    repeated = F.broadcast(often) if often.count() <= BROADCAST_ANCHORS else often
    runs = staged(runs_of(texts).join(repeated, "anchor", "left_semi").select(*RUNS.names), "suffixes-runs")
    unstaged(often)
    firsts = staged(first_of(runs, ["anchor", "content"]), "suffixes-firsts")
    # anchors with several different runs; of each run the row (or rows) that starts first is open
    several = staged(firsts.groupBy("anchor").count().where("count > 1"), "suffixes-several")
    n, most = several.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    known = firsts.join(several, "anchor", "left").where("n > 1 OR count IS NOT NULL").select("anchor", "content", "first", "count")
    # `many` is null for copies of an earlier run: runs meet their firsts once for both
    judged = runs.join(known, ["anchor", "content"]).where(~is_first() | F.col("count").isNotNull())
    judged = staged(judged.select("anchor", *KEY, "at", "low", "high", F.when(is_first(), F.col("count") > GROUP).alias("many")), "suffixes-judged")
    for done in (runs, firsts, several):
        unstaged(done)
    copies = judged.where("many IS NULL").select(*KEY, (F.col("at") - F.col("low")).alias("low"), (F.col("at") - F.col("high")).alias("high"))
    found = staged(with_bytes(texts, judged.where("many IS NOT NULL")), "suffixes-bytes")
    out = sorted_repeats(found.where(~F.col("many")), max(1, -(-n // BUCKET)))
    if most > GROUP:
        out = out.unionByName(window_repeats(found.where("many")))
    out = staged(copies.unionByName(out), "suffixes-covered")
    for done in (judged, found):
        unstaged(done)
    return out


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes."""
    texts = keyed(docs)
    marks = covered(texts).groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("marks"))

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for doc_id, text, marks in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    removed = spans = 0
                    if marks:
                        step = np.zeros(len(text) + 1, np.int32)
                        np.add.at(step, [m["low"] for m in marks], 1)
                        np.add.at(step, [m["high"] + LENGTH for m in marks], -1)
                        gone = np.cumsum(step[:-1]) > 0
                        removed = int(gone.sum())
                        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    else:
                        kept = text
                    out.append((doc_id, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return texts.join(marks, KEY, "left").select("doc_id", "text", "marks").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op13(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept")
