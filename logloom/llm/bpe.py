"""Byte-level BPE encoding and decoding.

Every text is cut into overlapping chunks which are pre-tokenised apart. The pattern looks only
ahead, so once a boundary of one chunk is also one of the next, both agree from there on: chunks
are stitched at the first such place, and where an overlap has none (a piece is longer than it),
the pattern runs on from the last sure boundary until it meets one of the next chunk. Each piece
is then encoded by merging its bytes in the order of the ranks; decoding concatenates the ids'
bytes. Texts of up to `long_chars` characters have their chunks in one task; a longer one becomes
rows of `part` characters, pre-tokenised by whichever tasks get them and stitched by one task
(its text column is read a second time for that).

Rows: a null text counts as empty; an empty text has no ids, and both digests are those of no
bytes. A null or repeated doc_id is a row like any other. Very long texts, also of a single
piece, take time in proportion to their length (times its logarithm within a piece). An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Characters of a chunk, of what it shares with the next, of a text that is dealt over tasks,
#: and of the rows that it is dealt in.
CHUNK, OVERLAP, LONG, PART = 1024, 32, 1 << 20, 1 << 16
#: A boundary is sure if this many characters beyond it were seen: the pattern's contractions
#: look at two characters after the first, all else at one.
AHEAD = 3
#: Pieces of up to so many characters are remembered with their ids: the latest, so many of them
#: at least and twice as many at most.
KNOWN_CHARS, KNOWN = 32, 1 << 16
#: The rank of a pair that is no token.
NONE = 1 << 40
#: Longer pieces, in bytes, are merged by a heap.
HEAP = 48


@lru_cache(1)
def splitter() -> regex.Pattern:
    # \s of the tokenizers' library is the Unicode property, without the control characters 1C to 1F
    return regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


#: Characters that `quick_splitter` doesn't know.
ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(1)
def quick_splitter() -> re.Pattern:
    """The same pattern for texts without ASTRAL characters, its classes spelled out as ranges."""

    def ranges(kind: str) -> str:
        runs = regex.compile(rf"\p{{{kind}}}+").finditer("".join(map(chr, range(1 << 16))))
        return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in runs)

    letter, number, space = ranges("L"), ranges("N"), ranges("White_Space")
    pattern = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    for name, members in ((r"\p{L}", letter), (r"\p{N}", number), (r"\s", space)):
        pattern = pattern.replace(name, f"[{members}]")
    return re.compile(pattern.replace(r"\S", f"[^{space}]"))


def chunk_starts(length: int, chunk: int, overlap: int) -> range:
    return range(0, max(1, length - overlap), chunk - overlap)


def stitch(text: str, chunks: Iterable[tuple[int, int, list[str]]]) -> tuple[list[str], int]:
    """The pieces of `text` from (start, end, own pieces) of its chunks in order, and how many
    chunks were joined at a boundary that both had."""
    out: list[str] = []
    ends: list[int] = []  # of the pieces in `out`
    seen = sure = joined = 0  # up to where chunks were seen, up to where boundaries are sure
    for start, end, own in chunks:
        if not out:
            out, ends = list(own), list(accumulate(map(len, own)))
        elif end > sure:
            at = list(accumulate(map(len, own), initial=start))
            known = range(bisect_left(ends, start), bisect_right(ends, sure))
            here = {b: i for i, b in enumerate(at[: bisect_right(at, max(seen, sure))])}
            place = next((k for k in known if ends[k] in here), None)
            if place is not None:
                i = here[ends[place]]
                joined += 1
            else:  # on from the last sure boundary until one is met
                place, i = bisect_right(ends, sure) - 1, len(own)
                del out[place + 1 :], ends[place + 1 :]
                here = {b: i for i, b in enumerate(at)}
                for m in splitter().finditer(text, ends[place] if place >= 0 else 0):
                    out.append(m[0])
                    ends.append(m.end())
                    if m.end() in here or m.end() >= end:
                        i = here.get(m.end(), len(own))
                        break
                place = len(out) - 1
                sure = ends[place]
            del out[place + 1 :], ends[place + 1 :]
            out += own[i:]
            ends += at[i + 1 :]
        seen, sure = end, max(sure, end - AHEAD)
    return out, joined


def split(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list[str], int]:
    """The pieces of a text, and how many of its chunks were stitched."""
    find = (splitter() if ASTRAL.search(text) else quick_splitter()).findall
    if len(text) <= chunk:
        return find(text), 0
    return stitch(text, ((s, min(len(text), s + chunk), find(text[s : s + chunk])) for s in chunk_starts(len(text), chunk, overlap)))


class Coder(dict):
    """Encodes pieces by the ranks of a file, and decodes ids.

    As a mapping: a short piece -> (its ids as text, their number, the decoded bytes), worked out
    when first asked for, and kept until `KNOWN` later ones have come twice over.
    """

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[str, tuple[str, int, bytes]] = {}
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {v: k for k, v in self.ranks.items()}

    def merge(self, raw: bytes) -> list[int]:
        """The ids of a piece: of all neighbours that make a token those of the lowest rank are
        merged, the leftmost first, until none is left."""
        rank = self.ranks.get
        if (whole := rank(raw)) is not None:
            return [whole]
        if len(raw) > HEAP:
            return self.merge_long(raw)
        cuts = list(range(len(raw) + 1))
        pairs = [rank(raw[i : i + 2], NONE) for i in range(len(raw) - 1)]
        while pairs and (low := min(pairs)) < NONE:
            i = pairs.index(low)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(raw[cuts[i] : cuts[i + 2]], NONE)
            if i:
                pairs[i - 1] = rank(raw[cuts[i - 1] : cuts[i + 1]], NONE)
        return [self.ranks[raw[a:b]] for a, b in pairwise(cuts)]

    def merge_long(self, raw: bytes) -> list[int]:
        """The same with a heap of pairs; `after[i]` is where the part at i ends, `before[i]`
        where the one before it begins."""
        n, rank = len(raw), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1") * n

        def pair(i: int) -> int | None:
            return rank(raw[i : after[after[i]]]) if i >= 0 and after[i] < n else None

        heap = [(r, i) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or pair(i) != r:
                continue  # one of the two was merged with another since
            gone = after[i]
            after[i] = after[gone]
            alive[gone] = 0
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [self.ranks[raw[i : after[i]]] for i in range(n) if alive[i]]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def __missing__(self, piece: str) -> tuple[str, int, bytes]:
        out = self.older.get(piece)
        if out is None:
            ids = self.merge(piece.encode())
            out = ",".join(map(str, ids)), len(ids), self.decode(ids)
        if len(piece) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out

    def coded(self, pieces: list[str]) -> tuple[str, int, bytes]:
        """The pieces' ids as text, their number, and the decoded bytes."""
        if not pieces:
            return "", 0, b""
        ids, n, raw = zip(*map(self.__getitem__, pieces), strict=True)
        return ",".join(ids), sum(n), b"".join(raw)


@lru_cache(2)
def coder(path: str) -> Coder:
    return Coder(path)


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
FIELDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, path: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP, long_chars: int = LONG, part: int = PART, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with `with_ids` also ids array<int>."""
    if not AHEAD < overlap < min(chunk, part):
        raise ValueError("the overlap must be shorter than a chunk and longer than the pattern looks ahead")
    out = OUT + (", ids array<int>" if with_ids else "")
    fields = FIELDS.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else FIELDS
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def row(doc_id: int | None, pieces: list[str]) -> dict:
        ids, n, raw = coder(path).coded(pieces)
        out = {"doc_id": doc_id, "n_tokens": n, "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(), "decoded_sha256": hashlib.sha256(raw).hexdigest()}
        return out | ({"ids": np.array(ids.split(",") if ids else [], np.int32)} if with_ids else {})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1, 1 << 20):
                yield pa.RecordBatch.from_pylist([row(i, split(t, chunk, overlap)[0]) for i, t in zip(some[0].to_pylist(), some[1].to_pylist(), strict=True)], schema=fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc", "doc_id", "start", "part")
        kinds = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)))
        for batch in batches:
            for doc, i, t in zip(*batch.columns, strict=True):
                t = t.as_py()
                for s in chunk_starts(len(t), part, overlap):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (doc.as_py(), i.as_py(), s, t[s : s + part]), strict=True))], schema=kinds)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.array([np.array([len(p) for p in split(t.as_py(), chunk, overlap)[0]], np.int32).tobytes() for t in batch.column("part")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths], names=[*batch.schema.names, "lengths"])

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        text = "".join(r["part"][: part - overlap] for r in rows[:-1]) + rows[-1]["part"]

        def own(r: dict) -> list[str]:
            ends = np.cumsum(np.frombuffer(r["lengths"], np.int32)).tolist()
            return [r["part"][a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

        pieces, _ = stitch(text, ((r["start"], r["start"] + len(r["part"]), own(r)) for r in rows))
        return pa.Table.from_pylist([row(rows[0]["doc_id"], pieces)], schema=fields)

    is_long = F.length("text") > long_chars
    short = docs.where(~is_long).mapInArrow(whole, out)
    parts = docs.where(is_long).select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text").mapInArrow(cut, "doc long, doc_id long, start long, part string")
    marked = parts.repartition("doc", "start").mapInArrow(mark, parts.schema.add("lengths", "binary"))
    return short.unionByName(marked.groupBy("doc").applyInArrow(join, out))


def op4(spark, sf_dir: str) -> DataFrame:
    from logloom.llm.common import table

    return encode(table(spark, sf_dir, "documents"))
