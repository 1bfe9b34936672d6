"""Phrase collocation mining: repeated phrases scored by their least surprising cut.

Texts are cut into pieces, and identical pieces of a language become one with a multiplicity.
Phrases are then counted level by level: the k words of a phrase that occurs often enough hold
two phrases of k-1 words that do, so each level looks only at runs of words whose shorter
phrases all passed (exact, as a count never exceeds that of a part). A level's weighted phrases,
summed per task, go to hash buckets, where duckdb counts them out of core: its table and its
spill lie in a folder of the task that is removed with it; nothing else reads them. The counts
of the parts of a phrase meet it by requests that are shuffled to where the counts lie.

Words, pairs and the runs of good pairs are found over many pieces at once in arrays, pairs as
numbers. Which phrases of the level before passed is sent to the tasks up to a bound (`SENT_ROWS`,
`SENT_BYTES`, counted first); beyond it each position of a piece asks for its phrase by a
shuffled request. Both ways give the same rows.

Rows: a null text is empty and has no pieces; a null lang is `und`, also as a name given in the
table; doc_id plays no part, so repeated rows count each time. Texts of any length are cut
whole; a task holds the words of one piece at a time. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import re
import shutil
import tempfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import slices, staged, table, unstaged
from logloom.llm.folds import let

LONGEST = 5
#: A-Z becomes a-z, tabs are spaces, and what separates pieces is a line feed.
TEXT_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
#: No word of a piece, as it separates pieces.
BETWEEN = b"\n"
#: Sums that a task holds before it passes them on.
HELD = 1_000_000
#: Phrases of a level that are sent to all tasks at most, and their bytes.
SENT_ROWS, SENT_BYTES = 400_000, 16 << 20
#: Memory of duckdb in a task, and positions that a bucket should have at most.
DUCKDB_MEMORY, BUCKET_POSITIONS = "256MB", 4_000_000

#: Bytes of phrases that a task takes apart at a time.
GATHERED = 16 << 20

COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("weight", pa.int64())])
SCHEMA = "lang string, phrase string, weight long"


def summed(rows: Iterator[tuple[str, list[bytes], int]]) -> Iterator[pa.RecordBatch]:
    """(lang, phrases, weight) -> batches of lang, phrase and the weights' sum, partly summed."""

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], schema=COUNTED)
        held.clear()

    held: dict[str, Counter[bytes]] = {}
    for n, (lang, found, weight) in enumerate(rows):
        counts = held.setdefault(lang, Counter())
        if weight == 1:
            counts.update(found)
        else:
            for p in found:
                counts[p] += weight
        if (n % 256 == 255 or len(found) > 1000) and sum(map(len, held.values())) > HELD:
            yield from out()
    yield from out()


def pieces(docs: DataFrame) -> DataFrame:
    """id, lang, phrase (the words of a piece between single spaces) and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (row for batch in batches for part in slices(batch, 1) for row in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True))
        cut = lambda text: [b" ".join(w) for piece in text.translate(TEXT_BYTES).split(b"\n") if (w := piece.split())]
        return summed((lang, cut(text), 1) for lang, text in texts)

    found = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
    return staged(found.groupBy("lang", "phrase").agg(F.sum("weight").alias("weight")).withColumn("id", F.monotonically_increasing_id()), "phrases-pieces")


def phrases(words: list[bytes], k: int) -> list[bytes]:
    """All phrases of k words."""
    if k == 1:
        return words
    if k == 2:
        return [a + b" " + b for a, b in pairwise(words)]
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def runs(words: list[bytes], good: set[bytes] | set[int] | dict[bytes, set[bytes]], k: int, places: bool = False) -> list[list[bytes]]:
    """The longest runs of at least k words whose phrases of k-1 words are all good (with
    `places`, `good` has the good positions; pairs may be given as first word -> second words)."""
    if places:
        flags = bytes(i in good for i in range(len(words) - k + 2))
    elif isinstance(good, dict):
        none: set[bytes] = set()
        flags = bytes([b in good.get(a, none) for a, b in pairwise(words)])
    else:
        flags = bytes([p in good for p in phrases(words, k - 1)])
    return [words[m.start() : m.end() + k - 2] for m in re.finditer(rb"\x01{2,}", flags)]


def each(df: DataFrame, use: Callable[..., Iterable[tuple[str, list[bytes], int]]], together: bool = False) -> DataFrame:
    """The partly summed phrases of what `use` makes of (lang, words, weight, *more) of each row;
    with `together` of the rows of a slice that agree in lang and weight, with BETWEEN as a word
    between two rows."""
    rows = df.select("lang", "phrase", "weight", *[c for c in df.columns if c not in ("id", "lang", "phrase", "weight")])

    def of(part: pa.RecordBatch) -> Iterator[tuple]:
        columns = [part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), *(c.to_pylist() for c in part.columns[2:])]
        if not together:
            for lang, phrase, *more in zip(*columns, strict=True):
                yield lang, phrase.split(b" "), *more
            return
        alike: dict[tuple[str, int], list[bytes]] = {}
        for lang, phrase, weight in zip(*columns, strict=True):
            alike.setdefault((lang, weight), []).append(phrase)
        for (lang, weight), found in alike.items():
            yield lang, (b" " + BETWEEN + b" ").join(found).split(b" "), weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed(x for batch in batches for part in slices(batch, 1) for row in of(part) for x in use(*row))

    return rows.mapInArrow(run, SCHEMA)


def asked(source: DataFrame, passed: DataFrame, k: int) -> DataFrame:
    """Each row of `source` (id, lang, phrase, weight) with `places`: those of its phrases of k-1
    words that are in `passed`. A request for each position goes to where its phrase is kept,
    and the answers go back to the row."""
    words = F.split("phrase", " ")
    every = let(words, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (k - 2)), lambda i: F.array_join(F.slice(w, i, k - 1), " ")))
    requests = source.where(F.size(words) >= k - 1).select("id", "lang", F.posexplode(every).alias("place", "phrase"))
    answers = requests.join(passed.select("lang", "phrase").hint("merge"), ["lang", "phrase"]).groupBy("id").agg(F.collect_list("place").alias("places"))
    return source.join(answers, "id")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, pa.Array, np.ndarray]]:
    """Rows of (lang, phrase, weight) some `GATHERED` bytes at a time, by lang: the lang, its
    phrases and weights, all their words end to end, and where each phrase's words start there."""

    def out() -> Iterator[tuple[str, pa.Array, np.ndarray, pa.Array, np.ndarray]]:
        rows = pa.Table.from_batches(held).select(["lang", "phrase", "weight"])
        for lang in pc.unique(rows.column("lang")).to_pylist():
            own = rows.filter(pc.equal(rows.column("lang"), lang)).combine_chunks()
            phrase = own.column("phrase").cast(pa.large_string()).combine_chunks()
            lists = pc.split_pattern(phrase, " ")
            starts = lists.offsets.to_numpy()
            yield lang, phrase, own.column("weight").to_numpy(), lists.flatten(), starts - starts[0]

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, 1, GATHERED):
            held.append(part)
            size += part.nbytes
            if size >= GATHERED:
                yield from out()
                held, size = [], 0
    if held:
        yield from out()


def totalled(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once, with the sum of its weights."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


def word_counts(source: DataFrame) -> DataFrame:
    """The partly summed words of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, weights, words, starts in gathered(batches):
            found = words.dictionary_encode()
            value, weight = totalled(found.indices.to_numpy(), np.repeat(weights, np.diff(starts)))
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(value)), found.dictionary.take(pa.array(value)).cast(pa.string()), pa.array(weight)], schema=COUNTED)

    return source.select("lang", "phrase", "weight").mapInArrow(run, SCHEMA)


def pair_codes(words: pa.Array, starts: np.ndarray, names: pa.Array) -> np.ndarray:
    """For each word and the next a number, from their places in `names`; -1 where one has none or
    the next belongs to another phrase."""
    place = pc.fill_null(pc.index_in(words, value_set=names), -1).to_numpy().astype(np.int64)
    code = np.where((place[:-1] >= 0) & (place[1:] >= 0), place[:-1] * len(names) + place[1:], -1)
    code[starts[1:-1] - 1] = -1
    return code


def by_lang(passed: DataFrame) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in passed.select("lang", "phrase").toLocalIterator():
        out.setdefault(r[0], []).append(r[1])
    return out


def pair_counts(source: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """lang, phrase, f of the pairs of `words` that occur `least` times or more: counted as numbers."""
    sent = source.sparkSession.sparkContext.broadcast({lang: pa.array(w, pa.large_string()) for lang, w in by_lang(words).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, weights, found, starts in gathered(batches):
            if lang in sent.value:
                code = pair_codes(found, starts, sent.value[lang])
                there = np.flatnonzero(code >= 0)
                value, weight = totalled(code[there], np.repeat(weights, np.diff(starts))[there])
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(value)), pa.array(value), pa.array(weight)], names=["lang", "code", "weight"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, code, f = (c.to_pylist() for c in batch.columns)
            names = [sent.value[x] for x in lang]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f"{n[c // len(n)]} {n[c % len(n)]}" for n, c in zip(names, code, strict=True)], pa.string()), batch.column(2)], names=["lang", "phrase", "f"])

    coded = source.select("lang", "phrase", "weight").mapInArrow(run, "lang string, code long, weight long")
    return coded.groupBy("lang", "code").agg(F.sum("weight").alias("f")).where(F.col("f") >= least).mapInArrow(named, "lang string, phrase string, f long")


def pair_runs(source: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, phrase, weight: the longest runs of at least three words whose pairs are all in `pairs`."""
    good = {}
    for lang, found in by_lang(pairs).items():
        names = sorted({w for p in found for w in p.split(" ")})
        place = {w: i for i, w in enumerate(names)}
        good[lang] = pa.array(names, pa.large_string()), pa.array([place[a] * len(names) + place[b] for a, b in (p.split(" ") for p in found)], pa.int64())
    sent = source.sparkSession.sparkContext.broadcast(good)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, phrase, weights, words, starts in gathered(batches):
            if lang not in sent.value:
                continue
            names, codes = sent.value[lang]
            flags = pc.is_in(pa.array(pair_codes(words, starts, names)), value_set=codes).to_numpy(zero_copy_only=False)
            step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
            first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)  # words of each run
            long = last - first >= 2
            first, last = first[long], last[long]
            row = np.searchsorted(starts, first, side="right") - 1
            # words stand in their phrase with a space between
            at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
            begin = np.frombuffer(phrase.buffers()[1], np.int64)[phrase.offset : phrase.offset + len(phrase) + 1][row] - at[starts[row]] - starts[row]
            data = memoryview(phrase.buffers()[2])
            texts = [bytes(data[a:b]) for a, b in zip((begin + at[first] + first).tolist(), (begin + at[last + 1] + last).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(texts)), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(weights[row])], schema=COUNTED)

    return source.select("lang", "phrase", "weight").mapInArrow(run, SCHEMA)


def few(passed: DataFrame) -> bool:
    """Whether a level may be sent to all tasks."""
    n, size = passed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    return n <= SENT_ROWS and size <= SENT_BYTES


def kept(source: DataFrame, passed: DataFrame, k: int) -> tuple[DataFrame, Callable[..., list[list[bytes]]], bool]:
    """The rows of `source`, what gives the runs of a row whose phrases of k-1 words all passed,
    and whether rows may be taken together."""
    if not few(passed):
        return asked(source, passed, k), lambda lang, words, places: runs(words, set(places), k, places=True), False
    good = {lang: {p.encode() for p in found} for lang, found in by_lang(passed).items()}
    sent = source.sparkSession.sparkContext.broadcast(good)
    return source, lambda lang, words: runs(words, sent.value.get(lang, set()), k), True


def counts(partial: DataFrame, least: int, buckets: int) -> DataFrame:
    """lang, phrase, f of those whose weights come to `least` or more: a bucket is a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        folder = tempfile.mkdtemp(prefix="phrases-")
        try:
            db = duckdb.connect(f"{folder}/bucket.db", config={"memory_limit": DUCKDB_MEMORY, "threads": 1, "temp_directory": f"{folder}/spill", "preserve_insertion_order": False})
            db.execute("CREATE TABLE part (lang VARCHAR, phrase VARCHAR, weight BIGINT)")
            for batch in batches:
                if batch.num_rows:
                    db.register("batch", pa.Table.from_batches([batch]))
                    db.execute("INSERT INTO part SELECT lang, phrase, weight FROM batch")
                    db.unregister("batch")
            found = db.execute("SELECT lang, phrase, CAST(sum(weight) AS BIGINT) AS f FROM part GROUP BY lang, phrase HAVING sum(weight) >= ?", [least])
            while rows := found.fetchmany(50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "phrase", "f"])
            db.close()
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return partial.repartition(buckets, "lang", "phrase").mapInArrow(run, "lang string, phrase string, f long")


def frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, k, f of all phrases of up to `LONGEST` words with f >= least, and lang, n."""
    spark = docs.sparkSession
    source = pieces(docs)
    size = F.size(F.split("phrase", " "))
    totals = staged(source.groupBy("lang").agg(F.sum(F.col("weight") * size).alias("n"), F.sum(size).alias("positions")), "phrases-totals")
    positions = totals.agg(F.coalesce(F.sum("positions"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-positions // BUCKET_POSITIONS))
    levels = [staged(counts(word_counts(source), least, buckets), "phrases-1")]
    for k in range(2, LONGEST + 1):
        if k == 2 and few(levels[-1]):
            levels.append(staged(pair_counts(source, levels[-1], least), "phrases-2"))
            continue
        alone = k == 3 and few(levels[-1])
        rows, good, together = (None, None, True) if alone else kept(source, levels[-1], k)
        if k == 2:
            partial = each(rows, lambda lang, words, weight, *places, good=good: ((lang, phrases(r, 2), weight) for r in good(lang, words, *places)), together)
        else:  # what is left is little: identical runs become one
            left = pair_runs(source, levels[-1]) if alone else each(rows, lambda lang, words, weight, *places, good=good: ((lang, [b" ".join(r) for r in good(lang, words, *places)], weight),), together)
            before, source = source, staged(left.groupBy("lang", "phrase").agg(F.sum("weight").alias("weight")).withColumn("id", F.monotonically_increasing_id()), f"phrases-runs-{k}")
            unstaged(before)
            partial = each(source, lambda lang, words, weight, k=k: ((lang, phrases(words, k), weight),))
        levels.append(staged(counts(partial, least, buckets), f"phrases-{k}"))
    unstaged(source)
    every = levels[0].withColumn("k", F.lit(1))
    for k, level in enumerate(levels[1:], 2):
        every = every.unionByName(level.withColumn("k", F.lit(k)))
    return every, totals.select("lang", "n")


def joined_words(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `most` phrases of each language."""
    known, totals = frequent(docs, least)
    found = known.where("k > 1").withColumn("words", F.split("phrase", " "))
    # requests: for each cut its two parts; both occur at least as often as the phrase, so are known
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "words", "k")
    cuts = cuts.select("lang", "phrase", "a", "cut", joined_words(F.col("words"), F.lit(1), F.col("cut")).alias("left"), joined_words(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    answer = lambda side, name: known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(answer("left", "l"), ["lang", "left"]).join(answer("right", "r"), ["lang", "right"])
    if totals.count() <= 10_000:  # a row for each language
        totals = F.broadcast(totals)
    cuts = cuts.join(totals, "lang")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumn("over", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("under", exact("l") * exact("r")).withColumn("score", F.expr("over div under"))
    scored = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")
    # phrases inside longer ones that occur as often
    k, w = F.col("k"), F.col("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda n: F.transform(F.sequence(F.lit(1), k - n + 1), lambda i: joined_words(w, i, n))))
    inside = found.where("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts of a language, so that no task sorts all of one
    part = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), known AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, i, x.f AS l, y.f AS r, n,
    CAST((1000 * CAST(c.f AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i, string_split(phrase, ' ') AS w FROM known WHERE k > 1) c
  JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:i], ' ')
  JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(w[i + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), left_over AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM known o WHERE o.lang = b.lang AND o.k > len(string_split(b.phrase, ' ')) AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * o.f >= 100 * b.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_over QUALIFY rank <= 2000
"""
