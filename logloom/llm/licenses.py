"""License scans by ordered signature rules, with DataFrame functions only.

A text is lower-cased (A-Z) and becomes words, each between two spaces, so that a rule's regex
matches whole words without looking around. Only texts that hold a literal of the gate could
match any rule; in those, a rule runs only where its keyword and the longest literal part of its
pattern occur. A rule's matches are intervals of words. An interval inside another (or equal to
one of a rule that stands earlier) is suppressed, so that a full notice outranks the names it
holds, and a denial outranks the notice it denies. Sentences that several licenses share have a
general label, which stands only in texts where no license is named.

Rows: a null text counts as empty; a text without words or without matches has no labels (empty
strings), score 0 and null places. A very long text takes time in proportion to its length and
matches. Repeated rows and null ids are rows like any other. An empty
table gives no rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.folds import let, running, sums_before
from logloom.llm.license_notices import GENERAL, NOTICES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The phrases whose places are counted, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label, keyword (a word of each of the name's alternatives; a family without such a word has a
#: row for each), name as it stands before "license", identifiers (words of the short form).
FAMILIES = [
    ("agpl", "affero", "(?:gnu )?affero(?: general)?(?: public)?", "agpl"),
    ("lgpl", "lesser", "(?:gnu )?lesser(?: general)?(?: public)?", "lgpl"),
    ("lgpl", "library", "(?:gnu )?library(?: general)?(?: public)?", "lgpl"),
    ("gpl", "gnu", "gnu(?: general)?(?: public)?", "gpl"),
    ("fdl", "documentation", "(?:gnu )?free documentation", "gfdl"),
    ("apache", "apache", "apache(?: software)?(?: foundation)?", "apache"),
    ("mit", "mit", "(?:the )?mit(?: x11)?", "mit"),
    ("mit", "expat", "expat", "expat"),
    ("x11", "x11", "x11", "x11"),
    ("bsd", "bsd", "(?:[0-9] clause |new |modified |simplified |revised )?bsd(?: [0-9] clause)?(?: style)?", "bsd"),
    ("isc", "isc", "isc", "isc"),
    ("mpl", "mozilla", "mozilla(?: public)?", "mpl"),
    ("epl", "eclipse", "eclipse(?: public)?", "epl"),
    ("edl", "eclipse", "eclipse distribution", "edl"),
    ("cddl", "distribution", "common development and distribution", "cddl"),
    ("cpl", "common", "common public", "cpl"),
    ("eupl", "european", "european union(?: public)?", "eupl"),
    ("artistic", "artistic", "(?:perl )?artistic", "artistic"),
    ("python", "python", "python(?: software foundation)?", "psf"),
    ("php", "php", "php", "php"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("libpng", "libpng", "libpng", "libpng"),
    ("boost", "boost", "boost(?: software)?", "bsl"),
    ("wtfpl", "wtfpl", "(?:do what the fuck you want to )?wtfpl", "wtfpl"),
    ("wtfpl", "fuck", "do what the fuck you want to public", "wtfpl"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("ms-pl", "microsoft", "microsoft public", "ms pl"),
    ("ms-rl", "reciprocal", "microsoft reciprocal", "ms rl"),
    ("sil-ofl", "font", "(?:sil )?open font", "ofl"),
    ("odbl", "open", "open (?:database|data commons)(?: attribution)?", "odbl"),
    ("ncsa", "ncsa", "(?:university of illinois )?(?:open source )?ncsa(?: open source)?", "ncsa"),
    ("afl", "academic", "academic free", "afl"),
    ("osl", "open", "open software", "osl"),
    ("upl", "universal", "universal permissive", "upl"),
    ("vim", "vim", "vim", "vim"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)?", "w3c"),
    ("cecill", "cecill", "cecill(?: free software)?", "cecill"),
    ("latex", "latex", "latex project(?: public)?", "lppl"),
    ("sspl", "server", "server side public", "sspl"),
    ("busl", "business", "business source", "busl"),
    ("elastic", "elastic", "elastic", "elastic"),
    ("commons-clause", "commons", "commons clause", "commons clause"),
    ("openrail", "rail", "(?:creativeml )?open rail(?: m)?", "openrail"),
    ("openrail", "openrail", "(?:creativeml )?openrail(?: m)?", "openrail"),
]
VERSION = "(?: (?:version |v)?[0-9]+(?: [0-9]+)*)?"
LATER = "(?: or (?:any )?later(?: version)?)?"
#: What a family's rules say around its name N or its identifier I: a denial first, then whole
#: notices, then the bare name; with the confidence of the label.
SHAPES = [
    ("deny", "(?:not|never|nor|no longer) (?:be )?(?:licensed|released|distributed|available|covered) (?:under|by) (?:the |an? )?N licen[sc]e" + VERSION, 0.0),
    ("notice", "(?:dual )?licensed (?:to you )?under (?:the )?(?:terms of )?(?:the |an? )?N licen[sc]e" + VERSION + LATER, 1.0),
    ("release", "(?:released|distributed|published|available|provided|made available) under (?:the )?(?:terms of )?(?:the |an? )?N licen[sc]e" + VERSION + LATER, 1.0),
    ("terms", "(?:under|subject to|accept|per) the (?:terms|conditions|terms and conditions) (?:of|in) (?:the )?N licen[sc]e" + VERSION + LATER, 0.95),
    ("see", "(?:see|copy of|consult|read) the N licen[sc]e(?: for)?", 0.85),
    ("spdx", "spdx license identifier I" + VERSION + "(?: only| or later)?", 1.0),
    ("short", "licensed under (?:the )?I" + VERSION, 0.9),
    ("name", "N licen[sc]e" + VERSION, 0.8),
]
#: Rules that follow no shape: label, keyword, pattern, confidence.
OTHERS = [
    ("", "under", "(?:not|never|nor|no longer) (?:be )?(?:licensed|released|distributed|available) under (?:a |the )?(?:cc|creative commons)(?: by)?", 0.0),
    ("cc-by-nc-nd", "cc", "(?:licensed under )?(?:the )?cc by nc nd" + VERSION, 0.9),
    ("cc-by-nc-sa", "cc", "(?:licensed under )?(?:the )?cc by nc sa" + VERSION, 0.9),
    ("cc-by-nc", "cc", "(?:licensed under )?(?:the )?cc by nc" + VERSION, 0.9),
    ("cc-by-nd", "cc", "(?:licensed under )?(?:the )?cc by nd" + VERSION, 0.9),
    ("cc-by-sa", "cc", "(?:licensed under )?(?:the )?cc by sa" + VERSION, 0.9),
    ("cc-by", "cc", "(?:licensed under )?(?:the )?cc by" + VERSION, 0.8),
    ("cc0", "cc0", "(?:licensed under |released under )?(?:the )?cc0" + VERSION + "(?: universal)?", 0.9),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)(?: licen[sc]e)?" + VERSION, 1.0),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?" + VERSION, 1.0),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: licen[sc]e)?" + VERSION, 1.0),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:s|atives|ative works)(?: licen[sc]e)?" + VERSION, 1.0),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: licen[sc]e)?" + VERSION, 1.0),
    ("cc-by", "creative", "creative commons attribution(?: licen[sc]e)?" + VERSION, 1.0),
    ("creative-commons", "creative", "creative commons(?: licen[sc]e)?" + VERSION, 0.6),
    ("public-domain", "domain", "(?:dedicated to|released into|placed in|in) the public domain", 0.9),
    ("mit-notice", "granted", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
    ("isc", "granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", 1.0),
    ("license-notice", "compliance", "you may not use this file except in compliance with the (?:apache )?license", 0.9),
    ("proprietary", "reserved", "all rights reserved", 0.5),
    ("copyleft", "copyleft", "copyleft", 0.5),
]
#: Parts of words of which the gate takes the first that a rule's literals hold; else its keyword.
HUBS = ("licen", "software", "copyright", "redistribut")


def literals(pattern: str) -> list[str]:
    """The parts of a pattern that every match holds as they stand, outside groups and classes."""
    out, depth, i = [""], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[":
            i = pattern.index("]", i)
            out.append("")
        elif c in "()":
            depth += 1 if c == "(" else -1
            out.append("")
        elif c in "?*+{":
            out[-1] = out[-1][:-1]
            out.append("")
        elif depth == 0:
            out[-1] += c
        i += 1
    return [x for x in out if x]


def spaced(pattern: str) -> str:
    """Words of a rule between single spaces -> each between two, as in a prepared text."""
    return f" {pattern.replace(' ?', '(?:  )?').replace(' ', '  ').replace('(?:    )?', '(?:  )?')} "


@cache
def rules() -> list[tuple[int, str, str, str, float]]:
    """(rank, label, keyword, regex, confidence) of all rules, the strongest first."""
    out = [("" if shape == "deny" else label, key if "N" in pattern else name.split()[0], pattern.replace("N", f"(?:{full})").replace("I", name), sure) for shape, pattern, sure in SHAPES for label, key, full, name in FAMILIES]
    out = [r for r in out if not r[3]] + [r for r in OTHERS if not r[3]] + [r for r in OTHERS if r[3]] + NOTICES + [r for r in out if r[3]]
    return [(n, label, f" {key} ", spaced(pattern), sure) for n, (label, key, pattern, sure) in enumerate(out)]


@cache
def gate() -> list[str]:
    """Every rule needs one of these in a prepared text."""
    held = [(key[1:], literals(regex)) for _, _, key, regex, _ in rules()]
    return sorted({next((hub for hub in HUBS if any(hub in x for x in parts)), key) for key, parts in held})


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, and nothing else changed."""
    ascii = F.length(text) == F.octet_length(text)
    return F.when(ascii, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(lower: Column) -> Column:
    """A lower-cased text's words, each between two spaces."""
    joined = F.trim(F.regexp_replace(lower, BREAK, "  "))
    return F.when(joined == "", "").otherwise(F.concat(F.lit(" "), joined, F.lit(" ")))


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def cut(text: Column, regex: str, rank: int) -> Column:
    """What stands before each match, and the matches."""
    return F.struct(F.lit(rank).alias("rank"), F.split(text, regex, -1).alias("before"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("found"))


def intervals(cuts: Column) -> Column:
    """Words from first to last of each match, in order: array<struct<first, last, rank>>."""
    pairs = F.arrays_zip(cuts["before"].alias("before"), cuts["found"].alias("found"))
    sized = F.transform(F.filter(pairs, lambda p: p["found"].isNotNull()), lambda p: F.struct(spaces(p["before"]).alias("before"), spaces(p["found"]).alias("found")))

    def place(p: Column, at: Column) -> Column:
        first = at + p["before"]
        return F.struct((first / 2).cast("int").alias("first"), ((first + p["found"]) / 2 - 1).cast("int").alias("last"), cuts["rank"].alias("rank"))

    return let(sized, lambda s: F.zip_with(s, sums_before(F.transform(s, lambda p: p["before"] + p["found"])), place))


def matched(name: str) -> Column:
    """Cuts of all rules that match the text in column `name`. Each pattern stands as a literal
    of its own, compiled once a task, and is tried only behind its keyword and longest literal
    (both without the spaces before them, which are everywhere and slow the search down)."""
    tried: dict[str, list[str]] = {}
    for rank, _, key, regex, _ in rules():
        longest = max(literals(regex), key=len).lstrip()
        found = f"named_struct('rank', {rank}, 'before', split(x, r'{regex}', -1), 'found', regexp_extract_all(x, r'{regex}', 0))"
        tried.setdefault(key, []).append(f"CASE WHEN contains(x, '{longest}') AND x RLIKE r'{regex}' THEN {found} END")
    keyed = [f"CASE WHEN contains(x, '{key.lstrip()}') THEN array({', '.join(some)}) END" for key, some in tried.items()]
    # the text is named once, so that a constant one isn't copied into each condition of the plan
    return F.expr(f"filter(flatten(filter(transform(array({name}), x -> array({', '.join(keyed)}))[0], k -> k IS NOT NULL)), c -> c IS NOT NULL)")


def detections(name: str) -> Column:
    """The intervals of all rules that match, without those inside others."""
    found = F.flatten(F.transform(matched(name), intervals))
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["first"].alias("first"), (-d["last"]).alias("minus_last"), d["rank"].alias("rank"))))
    # inside another: what comes before it in this order reaches at least as far
    reach = lambda o: running(F.transform(o, lambda d: -d["minus_last"]), F.lit(-1), F.greatest, "int")
    marked = let(order, lambda o: F.zip_with(o, reach(o), lambda d, r: F.struct(d["first"].alias("first"), (-d["minus_last"]).alias("last"), d["rank"].alias("rank"), r.alias("reach"))))
    return F.transform(F.filter(marked, lambda d: d["last"] > d["reach"]), lambda d: F.struct(d["first"].alias("first"), d["last"].alias("last"), d["rank"].alias("rank")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the
    detections: array<struct<first, last, rank>> by words and rank of the rule."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    out = out.withColumn("lower", lowered(F.col("text")))
    out = out.withColumn("words", words(F.col("lower")))
    out = out.withColumn("n_words", (spaces(F.col("words")) / 2).cast("long"))
    open_to = F.expr("exists(array(words), x -> " + " OR ".join(f"contains(x, '{part}')" for part in gate()) + ")")
    out = out.withColumn("prepared", F.when(open_to, F.col("words")))
    prepared = F.col("prepared")
    base = " (?:" + "|".join(BASE).replace(" ", "  ") + ") "
    out = out.withColumn("cuts", F.when(prepared.isNotNull(), cut(prepared, base, -1)))
    out = out.withColumn("base", F.when(prepared.isNotNull(), intervals(F.col("cuts"))))
    out = out.withColumn("phrases", F.col("cuts")["found"])
    out = out.withColumn("detections", F.when(prepared.isNotNull(), detections("prepared")))
    label_of = F.split(F.lit("|".join(r[1] for r in rules())), "\\|", -1)
    sure_of = F.split(F.lit("|".join(str(r[4]) for r in rules())), "\\|", -1).cast("array<double>")
    base_of = F.create_map(*[F.lit(x) for k, v in BASE.items() for x in (f" {k.replace(' ', '  ')} ", v)])
    base_labels = F.coalesce(F.array_distinct(F.transform("phrases", lambda p: base_of[p])), F.array().cast("array<string>"))
    own = F.coalesce(F.array_distinct(F.transform("detections", lambda d: F.get(label_of, d["rank"]))), F.array().cast("array<string>"))
    sure = F.array_max(F.transform("detections", lambda d: F.get(sure_of, d["rank"])))
    n = F.coalesce(F.size("base"), F.lit(0))
    every = F.filter(F.array_union(base_labels, own), lambda x: x != "")
    named = F.array_except(every, F.array(*map(F.lit, GENERAL)))
    return out.select(
        "doc_id",
        "n_words",
        F.greatest(n, F.lit(0)).cast("long").alias("n_base"),
        F.get("base", F.lit(0))["first"].cast("long").alias("first_word"),
        F.get("base", n - 1)["first"].cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.when(F.size(named) > 0, named).otherwise(every)), ",").alias("labels"),
        F.coalesce(F.greatest(sure, F.when(n > 0, 0.5)), F.lit(0.0)).alias("score"),
        F.coalesce("detections", F.array().cast("array<struct<first:int,last:int,rank:int>>")).alias("detections"),
    )


def op1(spark, sf_dir: str) -> DataFrame:
    from logloom.llm.common import table

    return scan(table(spark, sf_dir, "documents")).drop("detections")


def oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({n}, {quote(label)}, {quote(key)}, {quote(regex)}, {sure}::DOUBLE)" for n, label, key, regex, sure in rules())
    phrases = ", ".join(f"({quote(f' {k} '.replace(' ', '  ')[1:-1])}, {quote(v)})" for k, v in BASE.items())
    general = ", ".join(map(quote, GENERAL))
    return f"""
WITH rule(rank, label, kw, re, sure) AS (VALUES {values}),
phrase(p, label) AS (VALUES {phrases}),
raw AS (
  SELECT row_number() OVER () AS r, doc_id,
    trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g'), ' ') AS j
  FROM documents
), t AS (SELECT r, doc_id, CASE WHEN j = '' THEN '' ELSE ' ' || j || ' ' END AS x FROM raw),
hit AS (
  SELECT r, rank, label, sure, string_split_regex(x, re) AS seg, regexp_extract_all(x, re) AS m FROM t JOIN rule ON contains(x, kw)
  UNION ALL
  SELECT r, -1, label, 0.5, string_split(x, p) AS seg, list_transform(range(len(string_split(x, p)) - 1), lambda i: p) AS m FROM t JOIN phrase ON contains(x, p)
), place AS (
  SELECT r, rank, label, sure, m[i] AS found,
    (list_sum(list_transform(seg[1:i], lambda s: len(s) - len(replace(s, ' ', '')))) + coalesce(list_sum(list_transform(m[1:i-1], lambda s: len(s) - len(replace(s, ' ', '')))), 0)) // 2 AS a
  FROM (SELECT *, unnest(range(1, 1 + len(m))) AS i FROM hit WHERE len(m) > 0)
), det AS (SELECT *, a + (len(found) - len(replace(found, ' ', ''))) // 2 - 1 AS b FROM place),
kept AS (
  SELECT * FROM det WHERE rank >= 0
  QUALIFY b > coalesce(max(b) OVER (PARTITION BY r ORDER BY a, b DESC, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)
), base AS (
  SELECT r, count(*) AS n, min(a) AS f, max(a) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM det WHERE rank = -1 GROUP BY r
), alls AS (
  SELECT r, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE label NOT IN ({general})), string_agg(DISTINCT label, ',' ORDER BY label)) AS labels FROM (SELECT r, label FROM kept UNION ALL SELECT r, label FROM det WHERE rank = -1) WHERE label <> '' GROUP BY r
), best AS (SELECT r, max(sure) AS sure FROM (SELECT r, sure FROM kept UNION ALL SELECT r, sure FROM det WHERE rank = -1) GROUP BY r)
SELECT doc_id, CAST((len(x) - len(replace(x, ' ', ''))) // 2 AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(f AS BIGINT) AS first_word, CAST(l AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels,
  coalesce(alls.labels, '') AS labels, CAST(coalesce(sure, 0) AS DOUBLE) AS score
FROM t LEFT JOIN base USING (r) LEFT JOIN alls USING (r) LEFT JOIN best USING (r)
"""
