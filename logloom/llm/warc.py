"""WARC archives with an external index: write, merge the index, read back by it.

Each task writes its pages into archives (a gzip member a record) in the shared folder and sorts
the captures of each archive by URL key, time and page: a run. The runs are dealt out by ranges
of that order and merged range by range in a loser tree, so that the histories are globally
ordered; each capture is then read from its archive by its offset. A task's archive has a name
of its own attempt, and only the index says which archives count, so a task that is run again
after its executor was lost leaves nothing wrong behind.

Of captures with equal payloads of at least `REVISIT_BYTES` bytes, that of the largest page_id
is stored in full (all rows of that page_id are, if it is repeated), the others as revisits.

Rows: a null html is an empty payload; a null url has an empty key and no target; a null page_id
is kept, never referred to, and a revisit if a row with an id has the same payload. An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import shared_dir, staged, table

REVISIT_BYTES = 1000
RECORDS_PER_ARCHIVE = 20_000
CAPTURES_PER_TASK = 2048
#: Up to so many payloads that occur more than once are broadcast; more are joined by a shuffle.
BROADCAST_PAYLOADS = 200_000
EPOCH = 1704067200
URN = "urn:page:"


def url_key(url: str | None) -> str:
    """Host backwards, then path and sorted query in lower case."""
    if not url:
        return ""
    try:
        u = urlsplit(url)
        host = (u.hostname or "").split(".")
    except ValueError:
        return url.lower()
    query = "&".join(sorted(u.query.split("&"))) if u.query else ""
    return (",".join(reversed(host)) + ")" + (u.path or "/") + ("?" + query if query else "")).lower()


def opened(path: str, mode: str):
    """A file in the shared folder: of this machine's tree, or of any file system of pyarrow."""
    if path.startswith("file:") or path.startswith("/"):
        path = re.sub(r"^file:/+", "/", path)
        if mode == "wb":
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    return where.open_output_stream(name) if mode == "wb" else where.open_input_file(name)


def record(page_id: int | None, url: str | None, date: str, payload: bytes, digest: bytes, response: int | None) -> bytes:
    """A record, as a gzip member. `response`: the page that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if response is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode(),
        "Content-Type: application/http; msgtype=response",
    ]
    if response is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{response}>"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """What a record says: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: int(x) if (x := fields.get(name, "")[1 + len(URN) : -1]) else None
    if fields["WARC-Type"] == "revisit":
        n = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    else:
        n, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {"page_id": page("WARC-Record-ID"), "payload_bytes": n, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To")}


class LoserTree:
    """Merges sorted runs; each inner node keeps the loser of its match, so that the next
    winner takes one comparison a level."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.k = len(runs)
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self.play(leaf)

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self.beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and (head := self.heads[at := self.losers[0]]) is not None:
            yield head
            self.heads[at] = next(self.runs[at], None)
            self.play(at)


INDEX = "urlkey string, ts string, page_id long, archive string, offset long, length long"
INDEX_FIELDS = pa.schema([("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write(pages: DataFrame, folder: str, per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """Write archives of (page_id, url, html) and return the staged index of their runs."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload")).withColumn("digest", F.sha1("payload"))
    twice = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").select("digest", "response")
    twice = staged(twice, "warc-payloads")
    if twice.count() <= BROADCAST_PAYLOADS:
        twice = F.broadcast(twice)
    rows = rows.join(twice, "digest", "left").select("page_id", "url", "payload", "digest", "response")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import datetime

        out, captures, name, offset = None, [], "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist(sorted(captures, key=lambda c: (c["urlkey"], c["ts"], -1 if c["page_id"] is None else c["page_id"])), schema=INDEX_FIELDS)

        for batch in batches:
            for page_id, url, payload, digest, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, captures, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", [], 0
                    out = opened(name, "wb")
                at = datetime.datetime.fromtimestamp(EPOCH + (page_id or 0) % 2**31, datetime.UTC)
                refers = response if response is not None and response != page_id else None
                member = record(page_id, url, at.strftime("%Y-%m-%dT%H:%M:%SZ"), payload, bytes.fromhex(digest), refers)
                out.write(member)
                captures.append({"urlkey": url_key(url), "ts": at.strftime("%Y%m%d%H%M%S"), "page_id": page_id, "archive": name, "offset": offset, "length": len(member)})
                offset += len(member)
                if len(captures) >= per_archive:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(rows.mapInArrow(run, INDEX), "warc-index")


OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, urlkey string, ts string, capture int"
OUT_FIELDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("urlkey", pa.string()), ("ts", pa.string()), ("capture", pa.int32())])


def histories(index: DataFrame, per_task: int = CAPTURES_PER_TASK) -> DataFrame:
    """Merge the runs and read every capture, in the order of URL key, time and page. `capture`
    counts a key's captures within its range."""
    tasks = max(1, -(-index.count() // per_task))
    # the page is part of the range's key, so that a URL with many captures is split too
    dealt = index.repartitionByRange(tasks, "urlkey", "ts", "page_id").sortWithinPartitions("archive", "urlkey", "ts", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                runs.setdefault(r["archive"], []).append((r["urlkey"], r["ts"], -1 if r["page_id"] is None else r["page_id"], r["archive"], r["offset"], r["length"]))
        rows, files, last, capture = [], {}, None, 0
        for key, ts, _, archive, offset, length in LoserTree([iter(v) for v in runs.values()]):
            if archive not in files:
                if len(files) >= 64:
                    files.pop(next(iter(files))).close()
                files[archive] = opened(archive, "rb")
            files[archive].seek(offset)
            capture = capture + 1 if key == last else 1
            last = key
            rows.append(parsed(files[archive].read(length)) | {"urlkey": key, "ts": ts, "capture": capture})
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=OUT_FIELDS)
                rows = []
        for f in files.values():
            f.close()
        yield pa.RecordBatch.from_pylist(rows, schema=OUT_FIELDS)

    return dealt.mapInArrow(run, OUT)


def op3(spark, sf_dir: str) -> DataFrame:
    return histories(write(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")).drop("urlkey", "ts", "capture")


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), w AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN NULL ELSE top END AS refers_to
FROM w
"""
