"""Toxicity scores from a lexicon matched up to misspellings.

The lexicon's trie is intersected with the Levenshtein automata of its terms: a state is a set
of (trie node, edits so far), made when first reached and kept, so that a word costs one lookup
a byte and most words die after two or three. Each match counts for its term as exact or
misspelled, and its window of words tells quotation (quote marks on both sides, or words about
words) from abuse (words that address or point at someone). The lexicon has hand-written terms,
and stems learnt from labelled rows: beginnings of words that occur in toxic texts and hardly in
others. A logistic model over the counts, fitted on the same rows, gives the score.

Rows: a null text counts as empty and gets the score of a text without matches; so does any text
without matches. A null doc_id is scored, is not held out, and is never learnt from. Repeated
rows are scored each; of a labelled doc_id only the smallest text is learnt from. Labels that
are null, or of documents that aren't there, teach nothing; with labels of one class only, or
none, every score is the share of toxic rows (0 without rows). A very long text takes time and
memory in proportion to its length. An empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import staged, table

#: Abusive terms in the corpus's languages, in lower case without accents.
LEXICON = """
idiot moron scum clown trash loser worthless pathetic disgusting stupid dumb fool imbecile cretin
vermin filth filthy garbage jerk creep liar coward parasite swine degenerate brainless freak
weirdo hate ugly disgrace useless bastard subhuman
idiote imbecile connard salaud ordure abruti debile
dummkopf abschaum arschloch trottel versager schwachkopf
idiota estupido basura escoria payaso perdedor asqueroso
""".split()
#: Words about words, and words that address or point at someone.
MENTION = frozenset(b"word words term said says called quote quoted wrote insult slur mot dit wort sagte palabra dijo".split())
ADDRESS = frozenset(b"you your youre u are he she they this these such tu vous du ihr ist bist eres usted".split())
WINDOW = 6
SAMPLE = 8192
#: A stem has 4 to 7 characters, occurs in so many different toxic texts and so large a part of
#: them (fewer hold what is only common to a text and its near copies), and so large a share of
#: the texts that it occurs in are toxic. Of the parts the one is taken that is wrong least often
#: on a fifth of the rows learnt from (none held out), with stems of the other four.
STEM, STEM_TEXTS, STEM_PARTS, STEM_SHARE = range(4, 8), 5, (0.0, 0.005, 0.02), 0.85
#: An automaton keeps at most so many states; with more it starts anew.
STATES = 1 << 16
WORD_BYTES = bytes(c if c > 127 or chr(c) in "0123456789@$abcdefghijklmnopqrstuvwxyz" else ord(chr(c).lower()) if 65 <= c <= 90 else 32 for c in range(256))
TOKEN = re.compile(rb"[0-9@$a-z\x80-\xff]+|\"", re.I)
QUOTE = b'"'
QUOTES = "\u201c\u201d\u201e\u00ab\u00bb"


#: Characters that may be such marks; neither ASCII nor Latin letters are looked up one by one.
UNUSUAL = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]")
BETWEEN = frozenset("Pc Pd Pe Pf Pi Po Ps Sc Sk Sm So Zl Zp Zs Cc Cf".split())


class Separators(dict[str, str]):
    """What a character becomes: quotes are ASCII ones, punctuation, symbols, spaces and what else
    stands unseen between words are blanks (not the soft hyphen and the joiners inside words)."""

    def __missing__(self, c: str) -> str:
        between = unicodedata.category(c) in BETWEEN and c not in "\u00ad\u200c\u200d" or "\ufe00" <= c <= "\ufe0f"
        out = self[c] = '"' if c in QUOTES else " " if between else c
        return out


SEPARATORS = Separators()


def separated(raw: bytes) -> bytes:
    if raw.isascii():
        return raw
    return UNUSUAL.sub(lambda m: SEPARATORS[m[0]], raw.decode(errors="surrogateescape")).encode(errors="surrogateescape")


class Automaton:
    """The lexicon's trie intersected with the automata of all words within so many edits."""

    def __init__(self, terms: list[str], stems: tuple[str, ...] = ()):
        own = sorted(set(terms))
        self.terms, self.n_own = own + sorted(set(stems) - set(own)), len(own)
        self.children: list[dict[int, int]] = [{}]
        self.term: list[int] = [-1]
        self.below: list[int] = [0]  # edits that the most lenient term below a node bears
        for n, t in enumerate(self.terms):
            at, bears = 0, self.edits(n)
            self.below[0] = max(self.below[0], bears)
            for c in t.encode():
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.below.append(0)
                at = self.children[at][c]
                self.below[at] = max(self.below[at], bears)
            self.term[at] = n
        self.restart()

    def restart(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[int, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.stems: list[tuple[int, int] | None] = []
        self.start = self.state({(0, 0)})

    def edits(self, n: int) -> int:
        term = self.terms[n]
        return 0 if n >= self.n_own else 2 if len(term) >= 9 else 1 if len(term) >= 4 else 0

    def state(self, found: set[tuple[int, int]]) -> int:
        """The state of these (node, edits): closed under skipping a term's letter, fewest edits kept."""
        least: dict[int, int] = {}
        todo = sorted(found, key=lambda x: x[1])
        while todo:
            node, e = todo.pop()
            if e > self.below[node] or least.get(node, 9) <= e:
                continue
            least[node] = e
            todo += [(child, e + 1) for child in self.children[node].values()]
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e in key if self.term[n] >= 0 and e <= self.edits(self.term[n])]
            self.ends.append(min(ends) if ends else None)
            self.stems.append(next((x for x in ends if x[1] >= self.n_own), None))
        return self.states[key]

    def step(self, state: int, byte: int) -> int:
        found = set()
        for node, e in self.sets[state]:
            found.add((node, e + 1))  # a letter too many
            for c, child in self.children[node].items():
                found.add((child, e + (c != byte)))
        to = self.state({x for x in found if x[1] <= self.below[x[0]]})
        out = self.steps[state][byte] = to if self.sets[to] else -1
        return out

    def match(self, word: bytes) -> tuple[int, int] | None:
        """(edits, number of the term) of the nearest term, or None."""
        if len(self.sets) > STATES:
            self.restart()
        at, steps, stems = self.start, self.steps, self.stems
        for byte in word:
            to = steps[at].get(byte)
            at = self.step(at, byte) if to is None else to
            if at < 0:
                return None
            if stems[at]:
                return stems[at]
        return self.ends[at]


@lru_cache(4)
def automaton(stems: tuple[str, ...] = ()) -> Automaton:
    return Automaton(LEXICON, stems)


N_FEATURES = 3 * len(set(LEXICON)) + 7


def matches(raw: bytes, stems: tuple[str, ...] = ()) -> list[tuple[int, int, bool, bool]]:
    """(edits, term, quoted, addressed) of each match in a text."""
    a, raw = automaton(stems), separated(raw)
    hits = {w: m for w in set(raw.translate(WORD_BYTES).split()) if (m := a.match(w))}
    if not hits:
        return []
    tokens = [t.lower() for t in TOKEN.findall(raw)]
    out = []
    for i, t in enumerate(tokens):
        if t in hits:
            before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
            quoted = (QUOTE in before and QUOTE in after) or not MENTION.isdisjoint(before)
            out.append((*hits[t], quoted, not ADDRESS.isdisjoint(before + after)))
    return out


def features(raw: bytes, stems: tuple[str, ...] = ()) -> np.ndarray | None:
    """Counts of a text's matches: of each term exact, misspelled and quoted, then over all
    terms the distinct ones, the addressed, the quoted, the density, and of stems the distinct
    words' stems, all matches and the quoted. None without matches."""
    found = matches(raw, stems)
    if not found:
        return None
    n = automaton(stems).n_own
    x = np.zeros(N_FEATURES)
    for edits, term, quoted, addressed in found:
        if term < n:
            x[term + n * (2 if quoted else 1 if edits else 0)] += 1
            x[3 * n + 3] += 1000 / max(50, len(raw))
        else:
            x[3 * n + (6 if quoted else 5)] += 1
        x[3 * n + 1] += addressed
        x[3 * n + 2] += quoted
    x[3 * n] = len({m[1] for m in found if m[1] < n and not m[0] and not m[2]})
    x[3 * n + 4] = len({m[1] for m in found if m[1] >= n and not m[2]})
    return np.log1p(x)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method with a ridge on all but the intercept."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return np.zeros(x.shape[1]), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x1.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        move = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty), x1.T @ (p - y) + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


class Model:
    """Learnt stems, weights and intercept."""

    def __init__(self, stems: tuple[str, ...], weights: np.ndarray, intercept: float):
        self.stems, self.weights, self.intercept = stems, weights, intercept

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, list[int]]:
        """The texts' scores, and how many terms each has."""
        n, z, terms = 3 * automaton().n_own, np.full(len(texts), self.intercept), [0] * len(texts)
        for i, t in enumerate(texts.cast(pa.binary())):
            x = features(t.as_py() or b"", self.stems)
            if x is not None:
                z[i] += float(x @ self.weights)
                terms[i] = int((x[:n] > 0).sum() + round(np.expm1(x[-3])))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), terms


def beginnings(raw: bytes) -> set[str]:
    words = {w.decode(errors="replace") for w in separated(raw).translate(WORD_BYTES).split()}
    return {w[:n] for w in words for n in STEM if len(w) >= n}


def choose_stems(toxic: dict[str, int], clean: dict[str, int], texts: int = 0, part: float = 0.0) -> tuple[str, ...]:
    """Of the beginnings that occur in the toxic `texts` and hardly in others, those without a
    shorter one."""
    good = {s for s, n in toxic.items() if n >= max(STEM_TEXTS, part * texts) and n / (n + clean.get(s, 0)) >= STEM_SHARE}
    return tuple(sorted(s for s in good if not any(s[:n] in good for n in range(min(STEM), len(s)))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most `sample` labelled rows, those of smallest hash, none of them held
    out. The sample bounds what is broadcast, staged, and what comes to the driver."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    # one text an id, however many rows hold it; the fold is drawn by another hash than the sample
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = staged(own.select("text", "y", (F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))) % 5 == 0).alias("asked")), "toxicity-sample")

    def count(rows: DataFrame, y: int, only: frozenset[str] | None) -> dict[str, int]:
        """In how many different texts of this label each beginning occurs."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for batch in batches:
                for t in batch.column(0).cast(pa.binary()):
                    raw = t.as_py() or b""
                    found.update(beginnings(raw) if only is None else beginnings(raw) & only)
            if found:
                yield pa.RecordBatch.from_pydict({"s": list(found), "n": list(found.values())}, schema=pa.schema([("s", pa.string()), ("n", pa.int64())]))

        own = rows.where(F.col("y") == y).select("text").distinct()
        total = own.mapInArrow(run, "s string, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= (STEM_TEXTS if only is None else 1))
        return {r["s"]: r["n"] for r in total.collect()}

    def described(stems: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, labels and fold of the rows."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = [features(t.as_py() or b"", stems) for t in batch.column(0).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([None if r is None else r.tolist() for r in x], pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "y", "asked"])

        got = rows.mapInArrow(run, "x array<double>, y int, asked boolean").collect()
        x = np.array([r["x"] or [0.0] * N_FEATURES for r in got]).reshape(len(got), N_FEATURES)
        return x, np.array([r["y"] for r in got], float), np.array([r["asked"] for r in got], bool)

    def stems_of(rows: DataFrame, parts: tuple[float, ...]) -> list[tuple[str, ...]]:
        toxic = count(rows, 1, None)
        clean, texts = count(rows, 0, frozenset(toxic)), rows.where("y = 1").select("text").distinct().count()
        return [choose_stems(toxic, clean, texts, p) for p in parts]

    wrong = {}
    for part, stems in zip(STEM_PARTS, stems_of(rows.where("NOT asked"), STEM_PARTS), strict=True):
        x, y, asked = described(stems)
        weights, intercept = fit(x[~asked], y[~asked])
        wrong[part] = int(((x[asked] @ weights + intercept >= 0) != y[asked]).sum())
    best = min(STEM_PARTS, key=lambda p: (wrong[p], -p))
    (stems,) = stems_of(rows, (best,))
    x, y, _ = described(stems)
    return Model(stems, *fit(x, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = model.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(n, pa.int32())], names=["doc_id", "held_out", "score", "predicted", "n_terms"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_terms int")


def not_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns; of a row only the text
    goes to Python, and only the decision comes back."""
    stays = F.arrow_udf(lambda text: pa.array(model.scores(text)[0] < 0.5), "boolean")
    return docs.where(stays(F.col("text").cast("string")))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
