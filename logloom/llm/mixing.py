"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

Documents hang in a tree of domain, language and source. A budget of tokens flows down: at each
node it is shared among the children by weight, each up to what its subtree can give (its tokens
times `max_epochs`); what some cannot give goes to their siblings, and only what a whole subtree
cannot give reaches the siblings of its root. A leaf's documents stand in a seeded order, anew
for each epoch; it gives whole epochs and then the shortest prefix of the next one that reaches
its budget.

The prefix is found in two steps: tokens are summed by leaf and bucket of the order (4096 a
leaf), and only the bucket in which the budget is reached is looked at by document, so that a
leaf with a third of all rows is never sorted by one task. Shares are found by sorting the
children by capacity a weight: those with the least are full, the rest share evenly by weight.

Rows: null levels are a value of their own (""); a null text has no tokens. Documents without
tokens, with a null id, or in a leaf without budget aren't selected. Documents of equal id have
equal places in the order; they stand or fall together. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import staged, table

LEVELS = ("domain", "lang", "source")
SEED = "mix-1"
MAX_EPOCHS = 4
#: Up to so many leaves are broadcast; more are joined by a shuffle over salted keys.
BROADCAST_LEAVES, SALTS = 20_000, 64
#: Target weights by value of a level; values that aren't named weigh `OTHER`.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {}}
OTHER = 1


def domain(source: Column) -> Column:
    """The domain of a source, by the remainder of its number."""
    n = F.coalesce(F.try_to_number(F.regexp_extract(source, r"([0-9]{1,9})$", 1), F.lit("999999999")).cast("int"), F.lit(0)) % 3
    return F.when(n == 0, "web").when(n == 1, "books").otherwise("code")


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def order(seed: str, epoch: Column, doc_id: Column) -> Column:
    """Place in an epoch's order: hexadecimal digits of a digest."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), doc_id.cast("string")))


def shared(df: DataFrame, parent: list[str], weight: str = "weight", cap: str = "cap", budget: str = "budget") -> DataFrame:
    """`got` for each child: its parent's budget by weight, up to its cap. In order of cap a
    weight, a child is full if the budget that is left, shared by the weights that are left,
    reaches its cap; the first that isn't full sets the level for the rest."""
    before = Window.partitionBy(*parent).orderBy((F.col(cap) / F.col(weight)), *[c for c in LEVELS if c in df.columns and c not in parent]).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    df = df.withColumn("_left", F.col(budget) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
    df = df.withColumn("_weights", F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0)))
    df = df.withColumn("_level", F.col("_left").cast("double") / F.col("_weights"))
    df = df.withColumn("_full", F.col("_level") * F.col(weight) >= F.col(cap))
    df = df.withColumn("_open", F.min(F.when(~F.col("_full"), F.struct((F.col(cap) / F.col(weight)).alias("r"), F.col("_level").alias("level")))).over(whole)["level"])
    share = F.floor(F.coalesce(F.col("_open"), F.lit(0.0)) * F.col(weight)).cast("long")
    return df.withColumn("got", F.when(F.col("_full"), F.col(cap)).otherwise(F.least(share, F.col(cap)))).drop("_left", "_weights", "_level", "_full", "_open")


def weight(level: str) -> Column:
    out = F.lit(OTHER)
    for value, w in WEIGHTS[level].items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("long").alias("weight")


def budgets(leaves: DataFrame, share: float | None, total: int | None, max_epochs: int) -> DataFrame:
    """(domain, lang, source, supply) -> with `budget`, the tokens a leaf shall give."""
    cap = F.col("supply") * max_epochs
    whole = Window.partitionBy(F.lit(0))
    top = leaves.groupBy("domain").agg(F.sum(cap).alias("cap"), F.sum("supply").alias("all"))
    top = top.select("domain", "cap", weight("domain"), (F.lit(total).cast("long") if total is not None else F.floor(F.sum("all").over(whole) * share).cast("long")).alias("budget"), F.lit(0).alias("root"))
    a = shared(top, ["root"]).select("domain", F.col("got").alias("budget"))
    mid = leaves.groupBy("domain", "lang").agg(F.sum(cap).alias("cap")).join(a, "domain").select("domain", "lang", "cap", weight("lang"), "budget")
    b = shared(mid, ["domain"]).select("domain", "lang", F.col("got").alias("budget"))
    low = leaves.join(b, ["domain", "lang"]).select(*LEVELS, "supply", cap.alias("cap"), weight("source"), "budget")
    return shared(low, ["domain", "lang"]).select(*LEVELS, "supply", F.col("got").alias("budget"))


def select(docs: DataFrame, share: float | None = 0.5, total: int | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, domain, lang, source, tokens, epochs: the documents selected and how many times
    each is taken. The budget is `total` tokens, or else `share` of all."""
    spark = docs.sparkSession
    level = {"domain": domain(F.coalesce("source", F.lit(""))), "lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[level[k].alias(k) for k in LEVELS], tokens(F.col("text")).alias("tokens")).where("doc_id IS NOT NULL AND tokens > 0")
    rows = staged(rows, "mixing-rows")
    leaves = staged(budgets(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply")), share, total, max_epochs), "mixing-leaves")
    small = leaves.count() <= BROADCAST_LEAVES
    leaves = leaves.withColumn("whole", F.expr("budget div supply")).withColumn("rest", F.expr("budget % supply"))

    def to_leaf(left: DataFrame, right: DataFrame) -> DataFrame:
        if small:
            return left.join(F.broadcast(right), list(LEVELS))
        right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return left.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(right, [*LEVELS, "salt"]).drop("salt")

    rows = to_leaf(rows, leaves.select(*LEVELS, "whole", "rest")).withColumn("place", order(seed, F.col("whole"), F.col("doc_id"))).withColumn("bucket", F.conv(F.substring("place", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cut = sums.where("before < rest AND before + n >= rest").select(*LEVELS, F.col("bucket").alias("cut"), F.col("before").alias("cut_before"))
    cut = staged(cut, "mixing-cuts")  # a row a leaf at most
    rows = to_leaf(rows, leaves.select(*LEVELS).join(cut, list(LEVELS), "left"))
    run = Window.partitionBy(*LEVELS).orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(F.col("bucket") == F.col("cut")).withColumn("so_far", F.col("cut_before") + F.coalesce(F.sum("tokens").over(run), F.lit(0)))
    edge = edge.withColumn("so_far", F.min("so_far").over(Window.partitionBy(*LEVELS, "place"))).withColumn("more", (F.col("so_far") < F.col("rest")).cast("int")).drop("so_far")
    rest = rows.where(F.col("cut").isNull() | (F.col("bucket") != F.col("cut"))).withColumn("more", F.coalesce((F.col("bucket") < F.col("cut")).cast("int"), F.lit(0)))
    out = edge.unionByName(rest).withColumn("epochs", (F.col("whole") + F.col("more")).cast("int"))
    return out.where("epochs > 0").select("doc_id", *LEVELS, "tokens", "epochs")


def op10(spark, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "documents"))


def oracle(share: float = 0.5, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> str:
    def weigh(level: str) -> str:
        cases = " ".join(f"WHEN '{v}' THEN {w}" for v, w in WEIGHTS[level].items())
        return f"CASE {level} {cases} ELSE {OTHER} END" if cases else str(OTHER)

    def share_out(name: str, source: str, parent: str, tie: str, keep: str) -> str:
        over = f"PARTITION BY {parent}" if parent else ""
        return f"""
{name}_a AS (SELECT *, budget - coalesce(sum(cap) OVER b, 0) AS lft, sum(w) OVER ({over}) - coalesce(sum(w) OVER b, 0) AS ws FROM {source}
  WINDOW b AS ({over} ORDER BY cap / w, {tie} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_b AS (SELECT *, CAST(lft AS DOUBLE) / CAST(ws AS DOUBLE) AS lvl, CAST(lft AS DOUBLE) / CAST(ws AS DOUBLE) * w >= cap AS is_full FROM {name}_a),
{name}_c AS (SELECT *, arg_min(CASE WHEN NOT is_full THEN lvl END, CASE WHEN NOT is_full THEN cap / w END) OVER ({over}) AS op FROM {name}_b),
{name} AS (SELECT {keep}, CASE WHEN is_full THEN cap ELSE least(CAST(floor(coalesce(op, 0) * w) AS BIGINT), cap) END AS budget FROM {name}_c)"""

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS INT), 0) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'code' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\t\\n\\x0B\\f\\r ]+')) AS tokens
  FROM documents WHERE doc_id IS NOT NULL
), r AS (SELECT * FROM d WHERE tokens > 0),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply FROM r GROUP BY ALL),
t AS (SELECT domain, CAST(sum(supply) * {max_epochs} AS BIGINT) AS cap, {weigh("domain")} AS w, (SELECT CAST(floor(CAST(sum(supply) AS DOUBLE) * {share}) AS BIGINT) FROM leaf) AS budget FROM leaf GROUP BY domain),
{share_out("a", "t", "", "domain", "domain")},
m AS (SELECT domain, lang, CAST(sum(supply) * {max_epochs} AS BIGINT) AS cap, {weigh("lang")} AS w, any_value(a.budget) AS budget FROM leaf JOIN a USING (domain) GROUP BY domain, lang),
{share_out("b", "m", "domain", "lang", "domain, lang")},
l AS (SELECT domain, lang, source, supply, supply * {max_epochs} AS cap, {weigh("source")} AS w, b.budget FROM leaf JOIN b USING (domain, lang)),
{share_out("c", "l", "domain, lang", "source", "domain, lang, source, supply")},
o AS (
  SELECT r.*, budget // supply AS whole, budget % supply AS rest,
    md5('{seed}:' || (budget // supply) || ':' || doc_id) AS place
  FROM r JOIN c USING (domain, lang, source)
), p AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM o
), q AS (SELECT *, whole + CASE WHEN min(so_far) OVER (PARTITION BY domain, lang, source, place) < rest THEN 1 ELSE 0 END AS e FROM p)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(e AS INTEGER) AS epochs FROM q WHERE e > 0
"""
