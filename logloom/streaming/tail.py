"""A streaming source that tails growing files.

Its offset maps each file id (device and inode, so that a renamed file stays itself) to path,
byte offset and a digest of its first bytes. A batch reads only whole records between two
offsets, so that a replay reads the same bytes; a file whose beginning changed is read anew.

Rotation: a renamed file goes on from its offset; a copied-and-truncated one is found by its
header among files that shrank; a file that shrank or begins otherwise starts at 0; one that is
gone is forgotten after the second miss. A record without its delimiter is held until it has
one, or with `release_ms` until the file hasn't changed for so long. A record larger than the
buffer becomes its first part, and what follows up to the next delimiter is discarded.

A trigger lists the directory, but opens only files that changed since the trigger before (or less
than two seconds before it, as their times can't tell then). With `offsetLog`, a shared folder of
this query alone, an offset is the number of a version in a log of deltas (see offset_log), so
that what is written and compared follows the changes too, and a restarted reader knows where it stands.

Options: path (directory and glob), delimiter, startAtEnd, recursive, suffix, skipHeaderLines,
releaseMs, bufferBytes, maxBytesPerBatch (over all files), headerBytes, multiLineStart,
ignoreOlderSeconds, order, skipLoneDelimiters (an empty record that others follow is left out),
offsetLog, compactBytes.
"""

from __future__ import annotations

import fnmatch
import hashlib
import json
import os
import re
import stat
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from logloom.streaming.offset_log import OffsetLog

SCHEMA = "file_id string, file_path string, start_offset long, end_offset long, raw binary, terminated boolean, oversized boolean"
ARCHIVES = (".gz", ".bz2", ".zip", ".tar")
#: Seconds after which another write is sure to give a file another time.
SETTLED_AFTER = 2


class Piece(InputPartition):
    def __init__(self, file_id: str, path: str, start: int, end: int, header: str, header_len: int, skip: int):
        self.file_id, self.path, self.start, self.end, self.header, self.header_len, self.skip = file_id, path, start, end, header, header_len, skip


def header(path: str, length: int) -> tuple[str, int]:
    with open(path, "rb") as f:
        head = f.read(length)
    return hashlib.sha256(head).hexdigest(), len(head)


def same_file(path: str, digest: str, length: int) -> bool:
    """Whether a file still begins as it did; nothing known agrees with all."""
    return length <= 0 or header(path, length) == (digest, length)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        get = lambda k, d: options.get(k, options.get(k.lower(), d))
        path = get("path", "")
        self.directory, self.glob = os.path.split(path.removeprefix("file://"))
        self.glob = self.glob or "*"
        self.delimiter = get("delimiter", "\n").encode("ascii")[:1]
        self.at_end = get("startAtEnd", "false").lower() == "true"
        self.recursive = get("recursive", "false").lower() == "true"
        self.suffix = get("suffix", ".COMPLETED")
        self.skip = int(get("skipHeaderLines", "0"))
        self.release_ms = int(get("releaseMs", "-1"))
        self.buffer = int(get("bufferBytes", str(6 << 20)))
        self.most = int(get("maxBytesPerBatch", str(256 << 20)))
        self.header_bytes = int(get("headerBytes", "512"))
        self.begins = re.compile(get("multiLineStart", "").encode()) if get("multiLineStart", "") else None
        self.older = int(get("ignoreOlderSeconds", "-1"))
        self.newest_first = get("order", "oldest_first") == "newest_first"
        self.skip_lone = get("skipLoneDelimiters", "false").lower() == "true"
        self.last: dict[str, dict] = {}
        self.known = False  # whether `last` is where the query stands
        self.waiting: dict[str, int] = {}  # batches for which a file had to wait
        self.keys: dict[str, list] = {}  # natural order of paths
        self.settled: dict[str, tuple] = {}  # path, size and time of files of which `last` is all there is to know
        self.log = OffsetLog(get("offsetLog", ""), int(get("compactBytes", str(1 << 20)))) if get("offsetLog", "") else None

    def files(self) -> dict[str, dict]:
        """The candidates by id, in the order of time and name."""
        found = {}
        walk = os.walk(self.directory) if self.recursive else [(self.directory, [], os.listdir(self.directory) if os.path.isdir(self.directory) else [])]
        for where, _, names in walk:
            for name in names:
                if not fnmatch.fnmatchcase(name, self.glob) or name.startswith(".") or name.endswith(self.suffix) or name.lower().endswith(ARCHIVES):
                    continue
                path = os.path.join(where, name)
                try:
                    s = os.stat(path)
                except FileNotFoundError:
                    continue
                if stat.S_ISREG(s.st_mode) and not 0 <= self.older < time.time() - s.st_mtime:
                    found[f"{s.st_dev}-{s.st_ino}"] = {"path": path, "size": s.st_size, "mtime": s.st_mtime, "mtime_ns": s.st_mtime_ns}
        # names are taken apart once, not on every trigger
        keys = self.keys
        self.keys = {p: keys.get(p) or [int(part) if n % 2 else part for n, part in enumerate(re.split(r"([0-9]+)", p))] for p in (f["path"] for f in found.values())}
        return dict(sorted(found.items(), key=lambda x: (x[1]["mtime"], self.keys[x[1]["path"]], x[1]["path"]), reverse=self.newest_first))

    def state(self, f: dict, limit_from: int | None = None, held: bool = False, most: int | None = None) -> dict:
        """What is known of a file; with `most` 0 it stays where it is."""
        with open(f["path"], "rb") as file:
            head = file.read(self.header_bytes)
            offset = limit_from if most == 0 else self.complete(f, file, limit_from, held, self.most if most is None else most)
        return {"path": f["path"], "offset": offset, "sha": hashlib.sha256(head).hexdigest(), "len": len(head), "size": f["size"]}

    def initialOffset(self) -> dict:
        # at the end: what is there is skipped, but for a record that isn't complete
        if self.log and (self.log.versions("delta") or self.log.versions("snapshot")):
            return {"log": int(self.at_end)}  # asked again before the first batch was done
        now = {k: self.state(f, held=True) for k, f in self.files().items()} if self.at_end else {}
        if self.log:
            if self.at_end:
                # version 1 is the beginning also where no file is there yet
                self.log.write(1, "delta", {k: [None, f] for k, f in now.items()})
            self.log.version = int(self.at_end)
        self.last, self.known = now, True
        return {"log": self.log.version} if self.log else {"files": json.dumps(now)}

    def end_of(self, size: int, limit_from: int | None, most: int) -> int:
        return size if limit_from is None or limit_from > size else min(size, limit_from + most)

    def complete(self, f: dict, file, limit_from: int | None, held: bool, most: int) -> int:
        """The end of the last whole record, at most `most` bytes after `limit_from`."""
        size = f["size"]
        end = self.end_of(size, limit_from, most)
        if end == size and not held and 0 <= self.release_ms <= (time.time() - f["mtime"]) * 1000:
            return end
        at, found = end, 0
        while at > 0 and end - at < self.buffer:
            lo = max(0, at - (1 << 20))
            file.seek(lo)
            # one more byte, so that a beginning right after the block's last delimiter is seen
            block = file.read(min(end, at + 4096) - lo)
            found = self.last_start(block) if self.begins else block.rfind(self.delimiter, 0, at - lo) + 1
            if found > 0:
                return lo + found
            at = lo
        # no end of a record: all of a full buffer is taken, less is held
        return end if end >= self.buffer else 0

    def last_start(self, block: bytes) -> int:
        """Where the last record of several lines begins, which is still open."""
        at = len(block)
        while (at := block.rfind(self.delimiter, 0, at)) >= 0:
            if self.begins.match(block, at + 1):
                return at + 1
        return 0

    def latestOffset(self) -> dict:
        """Offsets after the whole records that are there now. They depend on the files alone,
        so that a restarted query sees the same; what is known only limits a batch, and keeps
        a file that is missing for the first time. A log knows it also after a restart."""
        if self.log and not self.known:
            self.last = self.log.load()
            self.known = self.log.version > 0
        now, files, left = time.time(), self.files(), self.most
        # where a file shrank or is gone, a new one may be its copy and go on from its offset
        copied = not self.known or any(k not in files or files[k]["size"] < o["size"] for k, o in self.last.items())
        out, waiting, settled = {}, {}, {}
        # those that had to wait longest come first; what is left must hold a buffer, or a file would
        # get too little for a record
        for k in sorted(files, key=lambda k: -self.waiting.get(k, 0)):
            f, at = files[k], self.last[k]["offset"] if k in self.last else None if copied else 0
            mark = (f["path"], f["size"], f["mtime_ns"])
            if k in self.last and self.settled.get(k) == mark:
                out[k], settled[k] = self.last[k], mark
                continue
            grown = at is not None and at <= f["size"]
            if grown and left < min(self.buffer, self.most) and at < f["size"]:
                waiting[k] = self.waiting.get(k, 0) + 1
            most = (0 if k in waiting else left) if grown else self.most
            out[k] = self.state(f, at, most=most)
            left = max(0, left - max(0, out[k]["offset"] - (at if grown else 0)))
            # all of it was seen, and nothing of it is due later by the clock alone
            if self.end_of(f["size"], at, most) == f["size"] and (self.release_ms < 0 or out[k]["offset"] == f["size"]) and now - f["mtime"] > SETTLED_AFTER:
                settled[k] = mark
        self.waiting, self.settled = waiting, settled
        for k, o in self.last.items():
            if k not in files and not o.get("gone"):
                out[k] = o | {"gone": True}
        offset = {"log": self.log.append(self.last, out)} if self.log else {"files": json.dumps(out)}
        self.last, self.known = out, True
        return offset

    def start_of(self, old: dict | None, now: dict, left: dict[int, dict[str, list[dict]]]) -> int:
        """From where a file is to be read: its old offset, that of the file it was copied from
        before that was truncated, or 0. What is known of both is compared first; a file is opened
        only where one header is longer than the other."""
        if old is not None:
            if now["size"] < old["size"]:
                return 0
            same = old["sha"] == now["sha"] if old["len"] == now["len"] else same_file(now["path"], old["sha"], old["len"])
            return old["offset"] if same else 0
        origins = []
        for length, by_digest in left.items():
            if length <= now["size"]:
                digest = now["sha"] if length == now["len"] else header(now["path"], length)[0]
                origins += [o for o in by_digest.get(digest, []) if o["size"] <= now["size"]]
        return origins[0]["offset"] if len(origins) == 1 else 0

    def planned(self, start: dict, end: dict) -> tuple[dict, dict]:
        """What was known at two offsets, at least of the files that changed between them."""
        if "log" not in end:
            return json.loads(start["files"]), json.loads(end["files"])
        if self.log is None:
            raise ValueError("the query's offsets are in an offset log, which the option offsetLog has to name")
        if "files" in start:  # the query had no log before
            return json.loads(start["files"]), self.log.between(0, end["log"])[1]
        return self.log.between(start["log"], end["log"])

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        before, after = self.planned(start, end)
        if not self.last and not self.log:
            self.last, self.known = after, True  # a batch that is run again after a restart
        # files that a new one may be a copy of, by the length and the digest of their header
        left: dict[int, dict[str, list[dict]]] = {}
        for k, o in before.items():
            if o["len"] > 0 and (k not in after or after[k].get("gone") or after[k]["size"] < o["size"]):
                left.setdefault(o["len"], {}).setdefault(o["sha"], []).append(o)
        out = []
        for file_id, now in after.items():
            if not now.get("gone") and now != before.get(file_id) and os.path.exists(now["path"]):
                at = self.start_of(before.get(file_id), now, left)
                if now["offset"] > at:
                    out.append(Piece(file_id, now["path"], at, now["offset"], now["sha"], now["len"], self.skip if at == 0 else 0))
        return out

    def resolved(self, p: Piece) -> str:
        """Where a file is now, which may have been renamed since."""
        here = lambda path: os.path.exists(path) and "{0.st_dev}-{0.st_ino}".format(os.stat(path)) == p.file_id
        if here(p.path):
            return p.path
        for f in os.scandir(os.path.dirname(p.path)):
            if here(f.path):
                return f.path
        raise FileNotFoundError(f"{p.path} is gone before its bytes {p.start} to {p.end} were read")

    def read(self, partition: Piece) -> Iterator[tuple]:
        path = self.resolved(partition)
        if not same_file(path, partition.header, partition.header_len):
            raise OSError(f"{path} no longer begins as when bytes {partition.start} to {partition.end} were planned")
        with open(path, "rb") as f:
            f.seek(partition.start)
            yield from self.framed(partition, f)

    def framed(self, p: Piece, f) -> Iterator[tuple]:
        """Records of bytes start to end; memory is bounded by the buffer."""
        at, left, tail, skip, discarding, opened = p.start, p.end - p.start, b"", p.skip, False, []
        d = self.delimiter

        def record(raw: bytes, start: int, terminated: bool, oversized: bool = False) -> tuple:
            body = raw[: -len(d)] if terminated else raw
            return (p.file_id, p.path, start, start + len(raw), body, terminated, oversized)

        while left or tail:
            block = f.read(min(left, 1 << 20)) if left else b""
            left -= len(block)
            if not block:
                left = 0
            tail += block
            while True:
                n = tail.find(d, 0, self.buffer)
                if n < 0 and len(tail) < self.buffer and (left or not tail):
                    break
                whole = n >= 0
                size = n + 1 if whole else min(len(tail), self.buffer)
                raw, tail = tail[:size], tail[size:]
                start, at = at, at + size
                if discarding:
                    discarding = not whole
                elif skip and whole:
                    skip -= 1
                else:
                    over = not whole and left + len(tail) > 0
                    discarding = over
                    if self.begins:
                        if opened and self.begins.match(raw):
                            yield record(b"".join(opened), start - sum(map(len, opened)), True)
                            opened = []
                        opened.append(raw)
                        if sum(map(len, opened)) >= self.buffer:
                            yield record(b"".join(opened), at - sum(map(len, opened)), whole, True)
                            opened = []
                    elif not (self.skip_lone and raw == d and (tail or left)):
                        yield record(raw, start, whole, over)
                if not tail and not left:
                    break
            if not left and not tail:
                break
        if opened:
            raw = b"".join(opened)
            yield record(raw, at - len(raw), raw.endswith(d))

    def commit(self, end: dict) -> None:
        """The batch is done: what no later one needs may go from the log."""
        if self.log and self.known and "log" in end:
            self.log.compact(end["log"], self.last)


class TailSource(DataSource):
    """spark.readStream.format("tail").option("path", "/var/log/*.log").load()"""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(TailSource)
