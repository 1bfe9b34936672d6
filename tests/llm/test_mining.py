"""Lexical search, phrase mining and suffix dedup against brute force, and over odd rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logloom.llm import common, lexical, phrases, suffixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, key long, weight long"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def frame(spark, rows):
    """rows: (doc_id, text, lang); the other columns clash with the operators' own names."""
    return spark.createDataFrame([(i, t, lang, "s", 0, 0.5, 1, 9, 3) for i, t, lang in rows], DOCS)


def made(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "red", "é", "ÉTÉ", "house", "of", "cards", "x1", "日本", "new", "york", "a-b", " ", "tab\tbed", "\x00"]
    fixed = ["new york city is big", "the house of cards", "one two three four five six"]
    return [(i, " ".join(r.choice(fixed) if r.random() < 0.15 else r.choice(words) + r.choice(["", "", "", ",", ".", "\n", "\x0b", "  "]) for _ in range(r.randint(0, 80))), r.choice(["en", "de", None])) for i in range(n)]


ODD = [(None, "the house of cards of a null id", "en"), (5000, None, "en"), (5001, "", None), (5002, " .,\t\n", "und"), (5003, "the red house", "und"), (5003, "the red house", "und"), (5003, "a red house", "en"), (5004, "word " * 30_000, "en"), (5005, "x" * 100_000, "en")]


# --- 11 lexical search


def best(docs, items, k):
    term = re.compile(lexical_pattern)
    words = [(i, Counter(term.findall((t or "").translate(LOW)))) for i, t, _ in docs]
    words = [(i, c) for i, c in words if c]
    n, total = len(words), sum(c.total() for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in words:
            m = 100 - 90 + (90 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(term.findall((text or "").translate(LOW))) if c[t])
            if s > 0:
                scored.append((-s, -math.inf if i is None else i))
        out += [(item, rank, None if i == -math.inf else i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


lexical_pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("blocks", [False, True])
def test_lexical_search(spark, monkeypatch, blocks):
    if blocks:  # several blocks of queries, small shards, texts cut into pieces
        for name, value in (("BLOCK_QUERIES", 3), ("SHARD_DOCS", 40), ("PIECE", 50)):
            monkeypatch.setattr(lexical, name, value)
    docs = made(1, 300) + ODD
    items = [(1, "New York, the house"), (2, None), (3, ""), (None, "red cards 日本 x1"), (4, "nowhere"), (5, "the the THE of"), (5, "city"), (6, "x" * 100_000), (7, "ÉTÉ word")]
    found = lexical.search(frame(spark, docs), spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"))
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(best(docs, items, 10), key=key)


def test_lexical_search_of_nothing(spark):
    none, some = frame(spark, []), frame(spark, made(2, 5))
    items = spark.createDataFrame([(1, "the house")], "item_id long, text string")
    assert lexical.search(none, items).count() == 0 and lexical.search(some, items.limit(0)).count() == 0
    assert lexical.search(frame(spark, [(1, None, "en"), (2, "...", "en")]), items).count() == 0


# --- 12 phrase mining


def mined(docs, least, most):
    n, f = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        if any(lang == o and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= 100 * a for (o, q), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:c]] * f[lang, p[c:]]), c) for c in range(1, len(p))]
        score, c = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:c]], f[lang, p[c:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:most], 1))


@pytest.mark.parametrize("shuffled", [False, True])
def test_phrases(spark, monkeypatch, shuffled):
    if shuffled:  # requests instead of a sent set, sums passed on early, many buckets
        for name, value in (("SENT_ROWS", -1), ("HELD", 100), ("BUCKET_POSITIONS", 20_000)):
            monkeypatch.setattr(phrases, name, value)
    docs = made(3, 400) + ODD
    found = phrases.collocations(frame(spark, docs), least=12, most=30)
    assert found.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]
    want = mined(docs, 12, 30)
    assert sorted(map(tuple, found.collect())) == want and {w[0] for w in want} == {"en", "de", "und"} and len(want) > 40


def test_phrases_in_small_gathers(spark, monkeypatch):
    monkeypatch.setattr(phrases, "GATHERED", 300)  # pairs and runs end with their phrase, whatever is gathered
    docs = made(7, 120) + [(8000, "x1 é. é x1, x1 é", "de"), (8001, "日本 x1 日本 x1", "und")] * 9
    assert sorted(map(tuple, phrases.collocations(frame(spark, docs), least=6, most=40).collect())) == mined(docs, 6, 40)


def test_pairs_stay_in_their_phrase():
    words, starts = phrases.pa.array(["a", "b", "a", "b", "c"], phrases.pa.large_string()), phrases.np.array([0, 2, 3, 5])
    assert phrases.pair_codes(words, starts, phrases.pa.array(["a", "b"], phrases.pa.large_string())).tolist() == [1, -1, -1, -1]
    values, sums = phrases.totalled(phrases.np.array([7, 3, 7]), phrases.np.array([1, 2, 1 << 60]))
    assert values.tolist() == [3, 7] and sums.tolist() == [2, (1 << 60) + 1]


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, "a b. a b", "en")])).count() == 0


def test_runs_of_good_phrases():
    words = [b"a", b"b", b"c", b"d", b"e"]
    assert phrases.runs(words, {b"a", b"b", b"d", b"e"}, 2) == [[b"a", b"b"], [b"d", b"e"]]
    assert phrases.runs(words, {b"a b", b"b c", b"d e"}, 3) == [[b"a", b"b", b"c"]] == phrases.runs(words, {0, 1, 3}, 3, places=True)
    assert phrases.runs([*words[:3], phrases.BETWEEN, *words[1:]], {b"a": {b"b"}, b"b": {b"c"}, b"d": {b"e"}}, 3) == [[b"a", b"b", b"c"]]
    assert phrases.runs(words, {0, 1, 2, 3}, 3, places=True) == [words] and phrases.runs([b"a"], {b"a"}, 2) == []


# --- 13 suffix dedup


def deduplicated(docs):
    seen = {}
    rows = [(math.inf if i is None else i, (t or "").encode()) for i, t, _ in docs]
    for d, b in rows:
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            seen[w] = min(seen.get(w, (math.inf, math.inf)), (d, i))
    out = []
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if seen[b[i : i + 100]] < (d, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((None if d == math.inf else d, len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=key)


def repeating(seed, n):
    r = random.Random(seed)
    some = ["".join(r.choice("abcde é\n") for _ in range(r.randint(30, 400))) for _ in range(8)]
    out = []
    for i in range(n):
        text = "".join(r.choice(some)[r.randint(0, 60) :] if r.random() < 0.6 else "".join(r.choice("abc ") for _ in range(r.randint(1, 120))) for _ in range(r.randint(0, 6)))
        out.append((r.choice([i, i, i, i - 1, None]), text, "en"))
    return [*out, out[5], out[6], (9000, "ab" * 3000, "en"), (9001, "z" * 5000 + some[0] * 3, "en"), (9002, "z" * 99, "en"), (9003, "z" * 100, "en")]


@pytest.mark.parametrize("way", ["sorted", "windows", "slices"])
def test_suffix_dedup(spark, monkeypatch, way):
    if way == "windows":  # groups of several runs become rows of windows, anchors are joined by a shuffle
        monkeypatch.setattr(suffixes, "GROUP", 2)
        monkeypatch.setattr(suffixes, "BROADCAST_ANCHORS", -1)
    if way == "slices":  # long texts in overlapping slices
        monkeypatch.setattr(suffixes, "SLICE", 700)
        monkeypatch.setattr(suffixes, "BUCKET", 50)
    docs = repeating(4, 150) + ODD[:7]
    found = suffixes.dedup(frame(spark, docs))
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), ("kept", "binary")]
    got = sorted(((*r[:5], bytes(r[5])) for r in found.collect()), key=key)
    assert got == deduplicated(docs) and sum(r[2] for r in got) > 1000


def test_suffix_dedup_takes_bytes_in_one_pass(spark, monkeypatch):
    passes, with_bytes = [], suffixes.with_bytes
    monkeypatch.setattr(suffixes, "GROUP", 3)  # groups of both kinds
    monkeypatch.setattr(suffixes, "with_bytes", lambda texts, wanted: passes.append({r[0] for r in wanted.select("many").distinct().collect()}) or with_bytes(texts, wanted))
    docs = repeating(6, 120)
    got = sorted(((*r[:5], bytes(r[5])) for r in suffixes.dedup(frame(spark, docs)).collect()), key=key)
    assert got == deduplicated(docs) and passes == [{True, False}]


def test_staged_tables_leave_no_shuffle_files(spark):
    blocks = lambda: {str(b) for b in scala(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if str(b).startswith("shuffle_")}
    scala = lambda xs: (xs.apply(i) for i in range(xs.size()))
    was, setting = blocks(), spark.conf.get(common.SHUFFLES_END, None)
    table = common.staged(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "some")
    for _ in range(100):
        if not (left := blocks() - was):
            break
        time.sleep(0.1)
    assert not left and table.count() == 7 and spark.conf.get(common.SHUFFLES_END, None) == setting


def test_suffix_dedup_of_nothing(spark):
    assert suffixes.dedup(frame(spark, [])).count() == 0
    assert [tuple(r)[:4] for r in suffixes.dedup(frame(spark, [(1, None, "en"), (2, "short", None)])).orderBy("doc_id").collect()] == [(1, 0, 0, 0), (2, 5, 0, 0)]


def test_deep_shallow_sorting():
    r = random.Random(5)
    for _ in range(200):
        base = [bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 70))) for _ in range(5)]
        texts = [r.choice(base)[: r.randint(0, 70)] + bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 3))) for _ in range(r.randint(1, 60))]
        order, common = suffixes.deep_shallow(texts)
        got = [texts[i] for i in order]
        assert got == sorted(texts) and sorted(order) == list(range(len(texts)))
        for a, b, c in zip(got, got[1:], common[1:], strict=False):
            assert a[:c] == b[:c] and (a[c : c + 1] != b[c : c + 1] or a == b and c == len(a))
        by, _ = suffixes.blind_trie(texts)
        assert [texts[i] for i in by] == sorted(texts)
