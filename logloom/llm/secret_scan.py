"""Secret scans: fixed patterns, and character Markov models, with DataFrame functions only.

Two first-order models over the alphabet of keys are trained from labelled samples, one of
random strings, one of ordinary identifiers (words, and words joined as in code, paths and
names of constants). Each transition of a run of such characters has a log-likelihood ratio, in
thousandths of a nat. The part of a run, of at least `MIN_RUN` characters, whose transitions
exceed the threshold by the largest sum is a span of kind `random`, so that a key is also found
inside a path or query; with what adjoins it up to the next separators. Unless the sum is below `EXCESS`, the part lacks letters or digits, or
it overlaps a span of the patterns.

Rows: a null text counts as empty; an empty text has no spans (the digest is that of no bytes).
A very long text takes time in proportion to its length and matches. Repeated rows and null ids
are rows like any other; rows with a null id teach nothing. An empty table gives no rows.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.folds import let, running, sums_before

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 20
RUN = r"[A-Za-z0-9+/_=-]{20,}"
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: A maximal run that is long enough is found at its start, as no shorter run passes at all.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
SPAN = "array<struct<start:int,kind:int,end:int>>"
#: How many documents, those of smallest digest of the id, teach ordinary words, and how many
#: random strings of each sort are drawn.
SAMPLE_DOCS, SAMPLE_STRINGS = 100, 2000
#: Thousandths of a nat: what a transition must exceed, and by how much the whole part must.
THRESHOLD, EXCESS = 500, 12_000
#: What a transition from or to a separator must exceed besides, so that parts end there.
SEPARATORS, BESIDES = "+/=_-", 6000


def places(text: Column, regex: str, kind: int, value: Column | None = None) -> Column:
    """Spans of the matches in order; `value`: of each match what must have 6 characters."""
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    parts = F.arrays_zip(F.split(text, regex, -1).alias("before"), found.alias("found"), (value if value is not None else found).alias("value"))
    sized = F.transform(F.filter(parts, lambda p: p["found"].isNotNull()), lambda p: F.struct(F.length(p["before"]).alias("before"), F.length(p["found"]).alias("found"), (F.length(p["value"]) >= 6).alias("ok")))

    def place(p: Column, at: Column) -> Column:
        start = (at + p["before"]).cast("int")
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + p["found"]).alias("end"), p["ok"].alias("ok"))

    spans = let(sized, lambda s: F.zip_with(s, sums_before(F.transform(s, lambda p: p["before"] + p["found"])), place))
    return F.transform(F.filter(spans, lambda p: p["ok"]), lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))


def joined_words(w: Column) -> Column:
    """Identifiers of a list of words: each three in a row, as in code, constants and paths."""
    lower = lambda x: F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    upper = lambda x: F.translate(x, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    title = lambda x: F.concat(upper(F.substring(x, 1, 1)), F.substr(lower(x), F.lit(2)))

    def forms(i: Column) -> Column:
        a, b, c = (F.element_at(w, i + k) for k in range(3))
        number = lambda first, n: (first + i % n).cast("string")
        return F.array(
            F.concat(lower(a), title(b), title(c)), F.concat(title(a), title(b), title(c)), F.concat_ws("_", lower(a), lower(b), lower(c)), F.concat_ws("_", upper(a), upper(b), upper(c)),
            F.concat(F.lit("/"), F.concat_ws("/", lower(a), lower(b), lower(c))), F.concat_ws("-", lower(a), lower(b), lower(c)), F.concat(lower(a), F.lit("="), lower(b)), F.concat_ws("/", lower(a), number(2000, 30), number(10, 20), F.concat(lower(b), number(1, 9))),
        )

    return F.when(F.size(w) >= 3, F.flatten(F.transform(F.sequence(F.lit(1), F.size(w) - 2, F.lit(3)), forms))).otherwise(F.array().cast("array<string>"))


def samples(docs: DataFrame, n_docs: int = SAMPLE_DOCS, n_strings: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled samples (text, random): seeded strings of the two usual sorts; and the words of
    at most `n_docs` documents and identifiers made of them, of which those that the patterns
    find are left out."""
    spark = docs.sparkSession
    seeds = spark.range(n_strings).select(F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256).alias("h"))
    drawn = seeds.select(F.explode(F.array(F.substring("h", 1, 40), F.substring(F.base64(F.unhex("h")), 1, 40))).alias("text"))
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(n_docs)
    found = docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id").select(F.regexp_extract_all("text", F.lit(r"[A-Za-z][A-Za-z_-]{3,}"), F.lit(0)).alias("w"))
    words = found.select(F.explode(F.concat("w", joined_words(F.col("w")))).alias("text"))
    return drawn.select("text", F.lit(True).alias("random")).unionByName(words.where(~F.col("text").rlike(f"{ACCESS}|{HEX}")).select("text", F.lit(False).alias("random")))


def ratios(labelled: DataFrame) -> list[int]:
    """The models, as the log-likelihood ratio of each transition in thousandths of a nat. What
    comes to the driver is bounded by the alphabet."""
    pairs = labelled.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.substr("text", i, F.lit(2)))).alias("pair")).groupBy("random", "pair").count()
    counts = {(r["random"], r["pair"]): r["count"] for r in pairs.collect()}
    size, out = len(ALPHABET), []
    rows = {k: {a: sum(counts.get((k, a + b), 0) for b in ALPHABET) for a in ALPHABET} for k in (True, False)}
    for a in ALPHABET:
        for b in ALPHABET:
            p, q = ((counts.get((k, a + b), 0) + 0.5) / (rows[k][a] + 0.5 * size) for k in (True, False))
            out.append(round(1000 * math.log(p / q)))
    return out


def best_part(run: Column, table: Column, threshold: int) -> Column:
    """struct<score, minus_end, start> of the part of a run whose transitions exceed the
    threshold by the largest sum: of equal ones the first to end, and of those the longest."""
    least = MIN_RUN - 1  # transitions

    def scored(codes: Column) -> Column:
        n = F.size(codes)
        over = F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), lambda a, b: F.get(table, (a - 1) * len(ALPHABET) + b - 1) - threshold)
        return let(sums_before(F.concat(over, F.array(F.lit(0)))), parts)

    def parts(sums: Column) -> Column:
        numbered = F.transform(sums, lambda s, i: F.struct(s.alias("sum"), i.alias("at")))
        lowest = running(numbered, F.struct(F.lit(1 << 60).alias("sum"), F.lit(0).alias("at")), F.least, "struct<sum:bigint,at:int>")
        n = F.size(sums)
        # the sums from the first possible end on, each with the lowest that is far enough before it
        ends, starts = F.slice(numbered, F.lit(least + 1), n - least), F.slice(lowest, F.lit(2), n - least)
        return F.array_max(F.zip_with(ends, starts, lambda e, s: F.struct((e["sum"] - s["sum"]).alias("score"), (-e["at"]).alias("minus_end"), s["at"].alias("start"))))

    return let(F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c)), scored)


def scan(docs: DataFrame, model: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and the spans as an array of
    (start, kind by its place in KINDS, end)."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast(SPAN)
    text = F.col("text")
    found = {
        "assign": F.when(text.rlike(r"(?i)password|passwd|secret|token|api_?key"), places(text, ASSIGN, 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))),
        "access": F.when(F.contains(text, F.lit("AKIA")), places(text, ACCESS, 1)),
        "hex": F.when(text.rlike(r"[0-9a-f]{24}"), places(text, HEX, 2)),
        "runs": F.when(text.rlike(RUN), F.arrays_zip(places(text, RUN, 3).alias("at"), F.regexp_extract_all(text, F.lit(RUN), F.lit(0)).alias("run"))),
    }
    out = out.select("doc_id", *[F.coalesce(v, none if k != "runs" else F.array().cast(f"array<struct<at:struct<start:int,kind:int,end:int>,run:string>>")).alias(k) for k, v in found.items()])
    out = out.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    pairs = (a + b for a in ALPHABET for b in ALPHABET)
    weights = [w - BESIDES * any(c in SEPARATORS for c in pair) for w, pair in zip(model, pairs, strict=True)]
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    cut = lambda r: F.substring(r["run"], r["best"]["start"] + 1, 1 - r["best"]["minus_end"] - r["best"]["start"])
    parts = F.filter(F.transform("runs", lambda r: F.struct(r["at"]["start"].alias("at"), best_part(r["run"], table, threshold).alias("best"), r["run"].alias("run"))), lambda r: (r["best"]["score"] >= EXCESS) & (cut(r).rlike("[0-9]")) & cut(r).rlike("[A-Za-z]"))
    same = lambda x: F.translate(x, "=_+-", "////")
    left = lambda r: F.length(F.substring_index(same(F.substring(r["run"], F.lit(1), r["best"]["start"])), "/", -1))
    right = lambda r: F.length(F.substring_index(same(F.substr(r["run"], F.lit(2) - r["best"]["minus_end"])), "/", 1))
    odd = F.transform(parts, lambda r: F.struct((r["at"] + r["best"]["start"] - left(r)).alias("start"), F.lit(3).alias("kind"), (r["at"] + 1 - r["best"]["minus_end"] + right(r)).alias("end")))
    clear = F.when(F.size("base") == 0, odd).otherwise(F.filter(odd, lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))))
    out = out.withColumn("found", F.array_sort(F.concat("base", clear)))
    names = F.array(*map(F.lit, KINDS))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return out.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
        "found",
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return scan(docs, ratios(samples(docs))).drop("found")


def oracle() -> str:
    """The same models and spans by joins over exploded transitions."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hex_run = HEX.removeprefix("(?<![0-9a-f])")

    def placed(kind: int, regex: str, source: str = "t") -> str:
        return f"""SELECT r, {kind} AS kind, string_split_regex(x, {quote(regex)}) AS seg, regexp_extract_all(x, {quote(regex)}) AS m,
    regexp_extract_all(x, {quote(regex)}, {2 if kind == 0 else 0}) AS v FROM {source}"""

    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
drawn AS (SELECT sha256('sample' || i) AS h FROM range({SAMPLE_STRINGS}) s(i)),
picked AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {SAMPLE_DOCS})),
sample AS (
  SELECT substr(h, 1, 40) AS s, true AS random FROM drawn
  UNION ALL SELECT substr(to_base64(from_hex(h)), 1, 40), true FROM drawn
  UNION ALL
  SELECT s, false FROM (
    SELECT unnest(list_concat(w, flatten(list_transform(range(1, len(w) - 1, 3), lambda i: [
      lower(w[i]) || upper(w[i+1][1]) || lower(w[i+1][2:]) || upper(w[i+2][1]) || lower(w[i+2][2:]), upper(w[i][1]) || lower(w[i][2:]) || upper(w[i+1][1]) || lower(w[i+1][2:]) || upper(w[i+2][1]) || lower(w[i+2][2:]),
      lower(w[i] || '_' || w[i+1] || '_' || w[i+2]), upper(w[i] || '_' || w[i+1] || '_' || w[i+2]), lower('/' || w[i] || '/' || w[i+1] || '/' || w[i+2]), lower(w[i] || '-' || w[i+1] || '-' || w[i+2]),
      lower(w[i] || '=' || w[i+1]), lower(w[i]) || '/' || (2000 + i % 30) || '/' || (10 + i % 20) || '/' || lower(w[i+1]) || (1 + i % 9)])))) AS s
    FROM (SELECT regexp_extract_all(text, '[A-Za-z][A-Za-z_-]{{3,}}') AS w FROM documents JOIN picked USING (doc_id))
  ) WHERE NOT regexp_matches(s, '{ACCESS}|{hex_run}')
),
pair AS (SELECT random, substr(s, i, 2) AS p, count(*) AS n FROM (SELECT random, s, unnest(range(1, len(s))) AS i FROM sample) GROUP BY ALL),
sign AS (SELECT unnest(string_split({quote(ALPHABET)}, '')) AS c),
whole AS (SELECT random, substr(p, 1, 1) AS a, sum(n) AS n FROM pair WHERE substr(p, 1, 1) IN (SELECT c FROM sign) AND substr(p, 2, 1) IN (SELECT c FROM sign) GROUP BY ALL),
prob AS (
  SELECT k.random, a.c || b.c AS p, (coalesce(pair.n, 0) + 0.5::DOUBLE) / (coalesce(whole.n, 0) + 0.5::DOUBLE * {len(ALPHABET)}) AS q
  FROM sign a CROSS JOIN sign b CROSS JOIN (SELECT unnest([true, false]) AS random) k
  LEFT JOIN pair ON pair.random = k.random AND pair.p = a.c || b.c LEFT JOIN whole ON whole.random = k.random AND whole.a = a.c
),
model AS (SELECT p, CAST(round(1000 * ln(max(q) FILTER (WHERE random) / max(q) FILTER (WHERE NOT random))) AS BIGINT) AS w FROM prob GROUP BY p),
hit AS ({placed(0, ASSIGN)} UNION ALL {placed(1, ACCESS)} UNION ALL {placed(2, hex_run)} UNION ALL {placed(3, RUN)}),
place AS (
  SELECT r, kind, m[i] AS found, v[i] AS v,
    CAST(list_sum(list_transform(seg[1:i], lambda s: len(s))) + coalesce(list_sum(list_transform(m[1:i-1], lambda s: len(s))), 0) AS BIGINT) AS a
  FROM (SELECT *, unnest(range(1, 1 + len(m))) AS i FROM hit WHERE len(m) > 0)
),
span AS (SELECT r, kind, found, a, a + len(found) AS b FROM place WHERE kind <> 0 OR len(v) >= 6),
step AS (
  SELECT r, a, found, i AS j, coalesce(w, 0) - {THRESHOLD} - CASE WHEN regexp_matches(substr(found, i, 2), '[+/=_-]') THEN {BESIDES} ELSE 0 END AS w FROM (SELECT r, a, found, unnest(range(1, len(found))) AS i FROM span WHERE kind = 3) LEFT JOIN model ON p = substr(found, i, 2)
  UNION ALL SELECT r, a, found, 0, 0 FROM span WHERE kind = 3
), upto AS (SELECT r, a, found, j, CAST(sum(w) OVER (PARTITION BY r, a ORDER BY j ROWS UNBOUNDED PRECEDING) AS BIGINT) AS p FROM step),
lowest AS (SELECT r, a, found, j, p, min(p * 1000000 + j) OVER (PARTITION BY r, a ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND {MIN_RUN - 1} PRECEDING) AS low FROM upto),
part AS (SELECT r, a, found, j, p, ((low % 1000000) + 1000000) % 1000000 AS i, low FROM lowest WHERE low IS NOT NULL),
odd AS (
  SELECT r, 3 AS kind, a + i - len(string_split(translate(substr(found, 1, i), '=_+-', '////'), '/')[-1]) AS a, a + j + 1 + len(string_split(translate(substr(found, j + 2), '=_+-', '////'), '/')[1]) AS b FROM (
    SELECT *, p - (low - i) // 1000000 AS score FROM part QUALIFY row_number() OVER (PARTITION BY r, a ORDER BY p - (low - i) // 1000000 DESC, j) = 1
  ) WHERE score >= {EXCESS} AND regexp_matches(substr(found, i + 1, j - i + 1), '[0-9]') AND regexp_matches(substr(found, i + 1, j - i + 1), '[A-Za-z]')
),
kept AS (
  SELECT r, kind, a, b FROM span WHERE kind < 3
  UNION ALL
  SELECT * FROM odd WHERE NOT EXISTS (SELECT 1 FROM span s WHERE s.kind < 3 AND s.r = odd.r AND s.a < odd.b AND odd.a < s.b)
),
named AS (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || a || ':' || b AS s FROM kept),
doc AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    coalesce(string_agg(s, ',' ORDER BY a, kind) FILTER (WHERE kind < 3), '') AS base, string_agg(s, ',' ORDER BY a, kind) AS spans
  FROM named GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN doc USING (r)
"""
