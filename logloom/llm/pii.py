"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions.

The tagger is trained here, in numpy, from labelled spans that a seeded generator writes in many
more shapes than the patterns know: addresses of the next protocol, cards of other lengths and
separators, national phone numbers, accounts, spelt-out e-mail addresses, names after a form of
address, and postal addresses; beside numbers that are none of these (orders, ISBNs, DOIs,
versions, dates). It reads classes of characters; forms of address, words for streets and
bracketed "at"s are classes too. A span counts only with a trigger (a digit, an @, a bracketed
"at") among its first characters, or as a name right after a form of address, and only if it can
be what its kind says (see `plausible`). So windows without a trigger can't add a span and
aren't read; the others, overlapping by half, are decoded by Viterbi in batches. A span is
decided in the window whose middle half it starts in, so that each place is decided once for the
text as a whole; one that reaches its window's end goes on in the windows after it for as long
as these continue it. Where spans still overlap the longer stays. The patterns' spans always
stay; the tagger's are added where they overlap none of these.

Rows: a null text counts as empty; an empty text has no spans (the digest is that of no bytes).
Repeated rows and null ids are rows like any other. A very long text takes time and memory in
proportion to its length. An empty table gives no rows. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import slices, table

KINDS = ("email", "ip", "card", "phone", "account", "name", "address")
#: Forms of address, words for streets, and what stands for @ and the dot.
TITLE = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Herrn|Frau|Señor|Señora|Monsieur|Madame|Mme|Mlle)(?![A-Za-z])"
STREET = r"(?i:(?<![a-z])(?:street|road|avenue|lane|boulevard|square|rue|calle|avenida|plaza|platz|allee)(?![a-z])|stra(?:ß|ss)e(?![a-z])|[a-z]str\.)"
SPELT = r"[(\[] ?(?:at|dot|AT|DOT) ?[)\]]"
#: Java's and Python's alike.
TRIGGERS = rf"[0-9@]|{TITLE}|{SPELT}"
TRIGGER = re.compile(TRIGGERS)
MARKS = [re.compile(x) for x in (TITLE, STREET, SPELT)]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of local@domain: from each @ back over what may stand before it, so
    that long runs of such characters aren't tried from each of their places."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(DIGITS.sub("", m[0])) <= 15]
    return out


# --- the tagger ---------------------------------------------------------------------------

WINDOW, STRIDE = 96, 48
TAGS = 1 + 2 * len(KINDS)
#: Characters that are classes of their own; then lower, upper, digit, other letter, space, rest.
OWN = "@.-+()_/:,'\"|=;#"
#: Then a mark each of the three sorts; the last is no character.
CLASSES = len(OWN) + 10


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = class_table()[np.minimum(codes, 0x2FFF)]
    for n, mark in enumerate(MARKS):
        for m in mark.finditer(text):
            out[m.start() : m.end()] = len(OWN) + 6 + n
    return out


@lru_cache(1)
def class_table() -> np.ndarray:
    out = np.full(0x3000, len(OWN) + 5, np.int8)
    for i in range(0x2FFF):
        c = chr(i)
        out[i] = OWN.index(c) if c in OWN else len(OWN) + (2 if "0" <= c <= "9" else 4 if c.isspace() else 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 3 if c.isalpha() else 5)
    return out


def check_digit(body: str) -> str:
    return next(body + c for c in "0123456789" if luhn(body + c))


def made(seed: int, n: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled samples: n texts with (kind, start, end)."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(["an", "the", "ti", "on", "er", "re", "é", "ß", "qu", "in", "la", "st", "o"]) for _ in range(r.randint(1, 4)))
    x = lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.randint(1, 4)))
    cap = lambda: word().capitalize()

    def card() -> str:
        if r.random() < 0.25:
            digits, sep = check_digit("3" + d(13)), r.choice(["", " ", "-"])
            return sep.join((digits[:4], digits[4:10], digits[10:]))
        digits, sep = check_digit(d(15)), r.choice(["", " ", "-", ".", "/", "\u00a0", "  "])
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    def address() -> str:
        street = r.choice([f"{cap()} {r.choice(['Street', 'Road', 'Avenue', 'Lane', 'Square', 'Platz', 'Allee'])}", f"{cap()}straße", f"{cap()}strasse", f"{r.choice(['rue', 'Rue', 'Calle', 'calle', 'Avenida', 'Plaza'])} {r.choice(['', 'de ', 'del ', 'de la '])}{cap()}"])
        number = d(r.randint(1, 3)).lstrip("0") or "7"
        first = r.choice([f"{number} {street}", f"{street} {number}", f"{street}, {number}"])
        return first + r.choice(["", "", f", {d(5)} {cap()}"])

    def span(kind: int) -> str:
        if kind == 0:
            local = r.choice([f"{word()}.{d(2)}", word() + d(r.randint(0, 3)), f"{word()}_{word()}", f"{word()}+{word()}"])
            if r.random() < 0.4:
                at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[AT]", ".")])
                return f"{local}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de'])}"
            return f"{local}@{r.choice(['mail', 'host', word()])}{d(r.randint(0, 1))}.{r.choice(['example.com', 'example.org', 'co.uk', 'net', 'de'])}"
        if kind == 1:
            return r.choice([".".join(str(r.randint(0, 255)) for _ in range(4)), ":".join(x() for _ in range(8)), f"2001:{x()}:{x()}::{x()}", f"fe80::{x()}:{x()}:{x()}"])
        if kind == 2:
            return card()
        if kind == 3:
            a, b, c = d(3), d(3), d(4)
            return r.choice([f"+1 ({a}) {b}-{c}", f"+{d(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{d(2)} {a} {b}{c}", f"0{d(2)}/{b} {c}"])
        if kind == 4:
            return r.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{r.choice(['DE', 'FR', 'ES', 'GB'])}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", f"{r.choice(['DE', 'FR', 'ES'])}{d(20)}"])
        if kind == 5:
            return r.choice([f"{cap()} {cap()}", cap(), f"{cap()} {r.choice('ABCDEFG')}. {cap()}", f"{cap()}-{cap()} {cap()}", f"{cap()} {r.choice(['von', 'de', 'van'])} {cap()}"])
        return address()

    def plain() -> str:
        return r.choice([
            d(r.randint(1, 4)), f"{d(1)}.{d(r.randint(1, 2))}", f"{d(2)}:{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{r.randint(1990, 2030)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{r.randint(1990, 2030)}", f"{d(2)}.{d(2)}.{r.randint(1990, 2030)}", f"{d(r.randint(1, 3))},{d(3)}", f"{d(2)}%",
            f"v{d(1)}.{d(1)}.{d(1)}", f"Version {d(1)}.{d(1)}", f"version {d(1)}.{d(2)}.{d(1)}", f"{r.choice(['CC BY-NC', 'CC BY', 'ISO', 'RFC', 'EN', 'BY-SA'])} {d(1)}.{d(1)}", f"{r.choice(['DE', 'ES', 'A', 'X'])}-{d(r.randint(1, 4))}", f"{word().upper()} {d(2)}", f"#{d(3)}", f"{word()}@{word()}",
            f'"{hashlib.md5(d(9).encode()).hexdigest()}"', hashlib.md5(d(9).encode()).hexdigest()[: r.randint(8, 32)], "@", d(r.randint(5, 8)), d(r.randint(8, 14)), f"#{d(r.randint(5, 9))}", f"{word()} {d(8)}", f"No. {d(r.randint(4, 10))}", f"{word().upper()}-{d(4)}-{d(5)}",
            f"ISBN 97{r.choice('89')}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"97{r.choice('89')}-{d(1)}-{d(3)}-{d(5)}-{d(1)}", f"ISBN {d(1)}-{d(3)}-{d(5)}-{d(1)}", f"97{r.choice('89')}{d(10)}", f"10.{d(4)}/{d(3)}", f"doi:10.{d(4)}/{word()}.{d(r.randint(3, 7))}", f"10.{d(4)}/{word()}-{d(4)}-{d(3)}",
            f"{d(4)}-{d(3)}X", f"{d(3)}-{d(3)}", f"{d(2)}-{d(2)}", f"${d(2)},{d(3)}.{d(2)}", f"{d(4)} {word()} {d(4)}", f"{cap()} {cap()}", f"{cap()} {d(2)}", f"{r.choice(['the', 'a'])} {r.choice(['street', 'road', 'square', 'rue'])}", f"({word()} at {word()})",
        ])

    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < WINDOW + 40:
            p = r.random()
            ends = [" ", " ", " ", ", ", ".\n", " | ", ". "]
            if p < 0.25:
                kind = r.randrange(len(KINDS))
                if kind == 5:
                    text += r.choice(["Mr. ", "Mrs ", "Ms. ", "Dr. ", "Prof. ", "Herr ", "Frau ", "Señora ", "Mme "])
                s = span(kind)
                spans.append((kind, len(text), len(text) + len(s)))
                text += s
                ends = ends[4:] + [f" {word()} "] if kind >= 5 else ends
            elif p < 0.5:
                text += plain()
            else:
                text += " ".join(word() if r.random() < 0.8 else cap() for _ in range(r.randint(1, 5)))
            text += r.choice(ends)
        out.append((text, spans))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Emissions by a bidirectional LSTM over character classes, transitions by a linear-chain
    CRF. Inputs are classes of shape (batch, time)."""

    def __init__(self, hidden: int = 24, seed: int = 11):
        g = np.random.default_rng(seed)
        self.h = hidden
        init = lambda *s: (g.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"out": init(2 * hidden, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
        for s in ("f", "b"):
            self.p |= {s + "x": init(CLASSES, 4 * hidden), s + "h": init(hidden, 4 * hidden), s + "c": np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)].astype(np.float32)}

    def stacked(self, what: str) -> np.ndarray:
        """A weight of both directions."""
        return np.stack([self.p["f" + what], self.p["b" + what]])

    def emissions(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """(time, batch, tags), and with `keep` what the gradient needs. Both directions take
        their steps together."""
        n, steps = self.h, x.shape[1]
        wx = (self.stacked("x") + self.stacked("c")[:, None, :]).reshape(2 * CLASSES, 4 * n)
        wh = self.stacked("h")
        at = np.stack([x.T.astype(np.int64), x[:, ::-1].T + CLASSES], axis=1)  # (time, 2, batch)
        h = np.zeros((2, len(x), n), wh.dtype)
        c, kept, out = np.zeros_like(h), [], np.empty((steps, 2, len(x), n), wh.dtype)
        for t in range(steps):
            z = wx[at[t]] + h @ wh
            gates, g = sigmoid(z[:, :, : 3 * n]), np.tanh(z[:, :, 3 * n :])
            i, f, o = gates[:, :, :n], gates[:, :, n : 2 * n], gates[:, :, 2 * n :]
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep:
                kept.append((h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        both = np.concatenate([out[:, 0], out[::-1, 1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (both, kept)

    def back(self, x: np.ndarray, dh_out: np.ndarray, kept: list) -> dict:
        """Gradients of the two LSTMs from those of their outputs (time, 2, batch, hidden)."""
        n, steps = self.h, x.shape[1]
        dh = np.zeros_like(kept[0][0])
        dc, wh = np.zeros_like(dh), self.stacked("h").transpose(0, 2, 1)
        gh, dzs = np.zeros((2, n, 4 * n), dh.dtype), np.empty((2, steps, len(x), 4 * n), dh.dtype)
        for t in range(steps - 1, -1, -1):
            h, before, i, f, o, g, tc = kept[t]
            dh = dh + dh_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=2)
            gh += h.transpose(0, 2, 1) @ dz
            dzs[:, t] = dz
            dh, dc = dz @ wh, dc * f
        grads = {}
        for k, s in enumerate("fb"):
            own = (x if s == "f" else x[:, ::-1]).T.ravel()
            dz = dzs[k].reshape(-1, 4 * n)
            grads |= {s + "x": (own[None, :] == np.arange(CLASSES)[:, None]).astype(dz.dtype) @ dz, s + "h": gh[k], s + "c": dz.sum(axis=0)}
        return grads

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Negative log-likelihood a text, and its gradient."""
        e, (both, kept) = self.emissions(x, keep=True)
        steps, n, trans = len(e), len(x), self.p["trans"]

        def lse(z: np.ndarray, axis: int) -> np.ndarray:
            m = z.max(axis=axis, keepdims=True)
            return (m + np.log(np.exp(z - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, steps):
            a[t] = e[t] + lse(a[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            b[t] = lse(trans + (e[t + 1] + b[t + 1])[:, None, :], 2)
        z = lse(a[-1], 1)
        de = np.exp(a + b - z[:, None])
        dt = np.exp(a[:-1, :, :, None] + trans + (e[1:] + b[1:])[:, :, None, :] - z[:, None, None]).sum(axis=(0, 1))
        rows = np.arange(n)
        gold = e[np.arange(steps)[:, None], rows, y.T].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        de[np.arange(steps)[:, None], rows, y.T] -= 1
        np.subtract.at(dt, (y[:, :-1], y[:, 1:]), 1)
        de, dt = (de / n).astype(np.float32), (dt / n).astype(np.float32)
        grads = {"trans": dt, "out": np.tensordot(both, de, ((0, 1), (0, 1))), "bias": de.sum(axis=(0, 1))}
        d = de @ self.p["out"].T
        grads |= self.back(x, np.stack([d[:, :, : self.h], d[::-1, :, self.h :]], axis=1), kept)
        return float((z.sum() - gold) / n), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 260, batch: int = 96, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam; the rate falls to a tenth. Returns the losses."""
        g, m, v, losses = np.random.default_rng(seed), {}, {}, []
        for step in range(1, steps + 1):
            rows = g.choice(len(x), batch, replace=False)
            loss, grads = self.gradient(x[rows], y[rows])
            losses.append(loss)
            norm = np.sqrt(sum(float((k * k).sum()) for k in grads.values()))
            for k, d in grads.items():
                d = d * min(1, 5 / (norm + 1e-9))
                m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                v[k] = 0.999 * v.get(k, 0) + 0.001 * d * d
                self.p[k] -= (rate * 0.1 ** (step / steps) * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Tags (batch, time) of the best paths."""
        e, _ = self.emissions(x)
        score, came = e[0], np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            all_ = score[:, :, None] + self.p["trans"]
            came[t] = all_.argmax(axis=1)
            score = all_.max(axis=1) + e[t]
        tags = np.empty((len(x), len(e)), np.int8)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            tags[:, t - 1] = came[t][np.arange(len(x)), tags[:, t]]
        return tags


def labelled(samples: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of labelled texts, as classes and tags."""
    r, xs, ys = random.Random(seed), [], []
    for text, spans in samples:
        y = np.zeros(len(text), np.int8)
        for kind, a, b in spans:
            y[a:b], y[a] = 2 + 2 * kind, 1 + 2 * kind
        at = r.randrange(0, max(1, len(text) - WINDOW))
        x = classes(text)[at : at + WINDOW]
        xs.append(np.pad(x, (0, WINDOW - len(x)), constant_values=CLASSES - 1))
        ys.append(np.pad(y[at : at + WINDOW], (0, WINDOW - len(x))))
    return np.array(xs), np.array(ys)


@lru_cache(2)
def trained(seed: int = 1, samples: int = 4000, steps: int = 450) -> Tagger:
    out = Tagger()
    out.fit(*labelled(made(seed, samples)), steps=steps)
    return out


#: A span's trigger stands among so many of its first characters.
NEAR = WINDOW - STRIDE // 2 - STRIDE // 2


def windows(text: str) -> list[int]:
    """Starts of the windows that can decide on a span: those that a trigger stands in, and the
    one before them."""
    at = {m.start() // STRIDE for m in TRIGGER.finditer(text)}
    return sorted({k * STRIDE for i in at for k in (i, i - 1, i - 2) if k >= 0})


AFTER_TITLE = re.compile(rf"(?:{TITLE})\.?[ \u00a0]$")


def triggered(text: str, start: int, end: int) -> bool:
    """Whether a span has a trigger among its first characters, or a form of address before it."""
    return TRIGGER.search(text, start, min(end, start + NEAR)) is not None or AFTER_TITLE.search(text, max(0, start - 12), start) is not None


def plausible(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a tagged span can be what it says: it has digits, a check digit or neighbours as
    its kind has them."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    if KINDS[kind] == "name":
        return AFTER_TITLE.search(text, max(0, start - 12), start) is not None and span[0].isupper()
    if KINDS[kind] == "email":
        return len(span) >= 6 and (MARKS[2].search(span) is not None or "@" in span[1:-1] and "." in span)
    if KINDS[kind] == "ip":
        try:
            return span.count(":") >= 2 and bool(ipaddress.IPv6Address(span))
        except ValueError:
            return False
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if KINDS[kind] == "phone":
        return 9 <= len(digits) <= 15
    if KINDS[kind] == "account":
        return len(digits) >= 9 and sum(c.isalnum() for c in span) - len(digits) <= 4
    return MARKS[1].search(span) is not None and bool(digits)


def tagged(texts: list[str], tagger: Tagger, batch: int = 512, every: bool = False) -> list[list[tuple[int, int, int]]]:
    """The tagger's spans of each text; `every`: by all windows, with the same result."""
    jobs = [(n, at) for n, t in enumerate(texts) for at in (range(0, max(1, len(t)), STRIDE) if every else windows(t))]
    coded = {n: classes(texts[n]) for n in {n for n, _ in jobs}}
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def decoded(jobs: list[tuple[int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
        for k in range(0, len(jobs), batch):
            part = jobs[k : k + batch]
            x = np.full((len(part), WINDOW), CLASSES - 1, np.int8)
            for row, (n, at) in zip(x, part, strict=True):
                c = coded[n][at : at + WINDOW]
                row[: len(c)] = c
            for (n, at), tags in zip(part, tagger.decode(x), strict=True):
                yield n, at, tags

    def add(n: int, kind: int, start: int, end: int) -> None:
        if end > start and triggered(texts[n], start, end):
            found[n].append((kind, start, end))

    cut: list[tuple[int, int, int, int]] = []
    for n, at, tags in decoded(jobs):
        # a window decides on what starts in its middle half; the first also on what is before
        lo, hi = (0 if at == 0 else STRIDE // 2), STRIDE + STRIDE // 2
        for start in np.flatnonzero((tags % 2 == 1)[:hi]):
            if start >= lo:
                kind, end = int(tags[start] - 1) // 2, int(start) + 1
                while end < WINDOW and tags[end] == 2 + 2 * kind:
                    end += 1
                if end == WINDOW and at + end < len(texts[n]):
                    cut.append((n, kind, at + int(start), at + end))
                else:
                    add(n, kind, at + int(start), min(at + end, len(texts[n])))
    # the window that sees both sides of where a span was cut says how far it goes on
    while cut:
        more = {(n, at): tags for n, at, tags in decoded(sorted({(n, end - STRIDE) for n, _, _, end in cut}))}
        again = []
        for n, kind, start, end in cut:
            tags, i = more[n, end - STRIDE], STRIDE
            while i < WINDOW and tags[i] == 2 + 2 * kind:
                i += 1
            # nor does a blank or mark belong to it that only looked so at the window's end
            while end + i - STRIDE > start + 1 and i in range(1, STRIDE + 1) and tags[i - 1] == 0 and not texts[n][end + i - STRIDE - 1].isalnum():
                i -= 1
            if i == WINDOW and end + STRIDE < len(texts[n]):
                again.append((n, kind, start, end + STRIDE))
            else:
                add(n, kind, start, min(end + i - STRIDE, len(texts[n])))
        cut = again
    out = []
    for spans in found:
        kept: list[tuple[int, int, int]] = []  # (start, end, kind), none over another
        for kind, a, b in sorted(spans, key=lambda s: (s[1] - s[2], s[1])):
            at = bisect_left(kept, (a,))
            if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or b <= kept[at][0]):
                kept.insert(at, (a, b, kind))
        out.append(sorted((kind, a, b) for a, b, kind in kept))
    return out


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(the patterns' spans, these and the tagger's) of each text."""
    out = []
    for text, own in zip(texts, tagged(texts, tagger), strict=True):
        base = base_spans(text)
        ends: list[int] = []  # what the patterns take, as places where it begins and ends in turn
        for a, b in sorted((a, b) for _, a, b in base):
            if ends and a < ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                ends += [a, b]
        free = lambda a, b: (at := bisect_right(ends, a)) % 2 == 0 and (at == len(ends) or b <= ends[at])
        out.append((base, sorted(base + [s for s in own if plausible(text, *s) and free(s[1], s[2])])))
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
FIELDS = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:4]], ("base_sha256", pa.string()), ("spans", pa.string())])
#: Characters that are tagged at a time in a task, in bytes of UTF-8.
AT_ONCE = 1 << 20


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans. A text without a trigger
    can't hold a span and isn't sent to Python."""
    tagger = tagger or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                rows = []
                for doc_id, (base, spans) in zip(part.column(0).to_pylist(), all_spans(part.column(1).to_pylist(), tagger), strict=True):
                    counts = [sum(s[0] == k for s in base) for k in range(4)]
                    rows.append({"doc_id": doc_id, "base_sha256": hashlib.sha256(written(base).encode()).hexdigest(), "spans": written(spans)} | {f"n_{KINDS[k]}": counts[k] for k in range(4)})
                yield pa.RecordBatch.from_pylist(rows, schema=FIELDS)

    text = F.when(F.col("text").rlike(TRIGGERS), F.col("text")).otherwise("")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, OUT)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of two that overlap the second
    vanishes into the first."""
    end, out = 0, []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{KINDS[kind].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """The documents with each span replaced by its kind in brackets, n_chars anew. Only texts
    with a trigger go to Python."""
    tagger = tagger or trained()

    def run(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, AT_ONCE):
            some = part.column(0).to_pylist()
            found = iter(all_spans([t for t in some if t is not None], tagger))
            out += [None if t is None else masked(t, next(found)[1]) for t in some]
        return pa.array(out, pa.string())

    touched = F.when(F.col("text").rlike(TRIGGERS), F.col("text").cast("string"))
    text = F.coalesce(F.arrow_udf(run, "string")(touched), F.col("text"))
    out = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op5(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
