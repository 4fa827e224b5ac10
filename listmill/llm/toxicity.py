"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers case, turns full-width and mathematical forms and look-alike letters of other scripts into plain Latin ones, drops accents and invisible characters,
reads digits and signs inside words as the letters they stand for, and turns the rest into spaces. Lexicon entries are whole words
or beginnings of words, each with a weight; matches inside an exception phrase don't count. A text's matches are summed, and
the sum and the sum by length give a score by a logistic function.

Entries, weights, exception phrases and the function's coefficients are learned from labelled rows: at most SAMPLE of them, taken in
hash order (a documented bound); each row's own words decide, never its labels, lang, source or doc_id.

Defined results: null and empty texts have no match and get the score of such a text; repeated rows get the same score; of rows that share a doc_id, the least
text is learned from; without labelled rows of both kinds all scores are 0; an empty table gives an empty table; extra columns of the input, whatever their names, are
ignored (scores) or kept (clean).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows that entries and weights are learned from, at most, and entries and exception phrases in the lexicon, at most.
SAMPLE, ENTRIES, EXCEPTIONS = 10_000, 5_000, 1_000
#: Shortest and longest beginning of a word that may be an entry, and the longest whole word.
SHORT, LONG, WORD = 4, 10, 24
#: Least documents of the toxic kind with an entry, and its least log odds.
LEAST_DOCS, LEAST_ODDS = 4, 2.5

#: Letters of Cyrillic and Greek, and Latin variants, that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y",
}
#: What digits and signs inside a word stand for.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"

_FOLD = {ord(a): b for a, b in LOOKALIKES.items()} | {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)} | dict.fromkeys(map(ord, INVISIBLE)) | {ord("$"): "$", ord("@"): "@"}
_REST = re.compile(r"[^\w$@!]+|_")
_SIGNED = re.compile(r"(?<![^ ])(?=[^ ]*[^\W\d_])[^ ]*[0-9$@!][^ ]*")
_TO_LETTERS = str.maketrans(SIGNS)


def _letters(m: re.Match) -> str:
    word = m[0].rstrip("!").lstrip("!")
    if word[-1:].isdigit() and word.rstrip("0123456789").isalpha():  # a name with a number, as in covid19
        return f"{word} "
    return re.sub(r"[$@!]", " ", word.translate(_TO_LETTERS)) + " "


def fold(text: str) -> str:
    """Words parted and enclosed by single spaces."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    text = _REST.sub(" ", text.lower().translate(_FOLD))
    text = _SIGNED.sub(_letters, text) if any(s in text for s in "013457$@!") else text
    return f" {' '.join(text.replace('$', ' ').replace('@', ' ').replace('!', ' ').split())} "


@dataclass(frozen=True)
class Lexicon:
    """weights: by entry, " word " or " beginning"; exceptions: " words " in which matches don't count; coefficients: of 1, log(1 + sum), sum per 100 words."""

    weights: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, float, float] = (-1e3, 0.0, 0.0)

    def matches(self, text: str) -> list[tuple[int, int, str, float]]:
        """start, end, entry, weight of every match in a folded text that counts."""
        a = automaton(self)
        if a is None:
            return []
        found, free = [], []
        for end, (entry, weight) in a.iter(text):
            (found if weight is not None else free).append((end + 1 - len(entry), end + 1, entry, weight))
        if free:
            found = [m for m in found if not any(s <= m[0] and m[1] <= e for s, e, *_ in free)]
        return found

    def facts(self, text: str) -> tuple[float, int]:
        """The sum of the weights of the matches, and the number of words. Where entries start at one place, the heaviest counts."""
        text = fold(text)
        best: dict[int, float] = {}
        for start, _, _, weight in self.matches(text):
            best[start] = max(best.get(start, 0.0), weight)
        return sum(best.values()), text.count(" ") - 1

    def score(self, text: str) -> float:
        total, words = self.facts(text)
        x = float(np.dot(self.coefficients, features(total, words)))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def features(total, words):
    return 1.0, np.log1p(total), np.minimum(100 * total / np.maximum(words, 1), 100.0)


@lru_cache(maxsize=4)
def automaton(lexicon: Lexicon):
    a = ahocorasick.Automaton()
    for entry, weight in lexicon.weights:
        a.add_word(entry, (entry, weight))
    for phrase in lexicon.exceptions:
        a.add_word(phrase, (phrase, None))
    if not len(a):
        return None
    a.make_automaton()
    return a


def terms(text: str) -> set[str]:
    """Candidate entries of a text: words and beginnings of words."""
    out = set()
    for w in set(fold(text).split()):
        if not w.isdigit():
            out.add(f" {w[:WORD]} " if len(w) <= WORD else f" {w[:WORD]}")
            out.update(f" {w[:n]}" for n in range(SHORT, min(LONG, len(w)) + 1))
    return out


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries and weights from (term, toxic documents with it, clean documents with it). A beginning gives way to a longer one, or to the whole word, that stands for nine tenths of its documents."""
    odds = {t: math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1)) for t, p, n in counts}
    of = {t: p for t, p, _ in counts}
    heir: dict[str, int] = Counter()
    for t, p in of.items():
        if t.endswith(" "):
            heir[t[:-1]] = max(heir[t[:-1]], p)
        elif len(t) > SHORT + 1:
            heir[t[:-1]] = max(heir[t[:-1]], p)
    kept = {t: odds[t] for t, p in of.items() if p >= LEAST_DOCS and odds[t] >= LEAST_ODDS and (t.endswith(" ") or heir[t] < 0.9 * p)}
    # what goes on from an entry adds nothing
    out = {}
    for t in sorted(kept, key=len):
        if not any(t[:n] in out and out[t[:n]] > kept[t] - 1 for n in range(SHORT + 1, len(t))):
            out[t] = kept[t]
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:ENTRIES])


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method, with a small ridge. Columns after the first are held at slopes of zero or more: the one that falls furthest below is left out, and the rest fitted again."""
    ridge, used = np.array([1e-3, *[1e-2] * (x.shape[1] - 1)]), list(range(x.shape[1]))
    while True:
        part, w = x[:, used], np.zeros(len(used))
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            g, h = part.T @ (p - y) + ridge[used] * w, (part * (p * (1 - p))[:, None]).T @ part + np.diag(ridge[used])
            step = np.linalg.solve(h, g)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        if len(w) == 1 or w[1:].min() >= 0:
            out = np.zeros(x.shape[1])
            out[used] = w
            return tuple(map(float, out))
        del used[1 + int(w[1:].argmin())]


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE) -> DataFrame:
    """doc_id, text, y of at most bound labelled documents in hash order; labels that contradict each other count as the larger."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    picked = common.cut(common.in_hash_order(rows, "doc_id", bound))  # 16 bytes a row
    return common.one_text(docs, picked, "y")


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Lexicon:
    """labels: doc_id, toxic; only rows to learn from."""
    rows = common.cut(sample(docs, labels, "toxic", bound).repartition(max(2, docs.sparkSession.sparkContext.defaultParallelism)))
    sides = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sides) < 2:
        return Lexicon()

    def counted(batch):
        toxic, clean = Counter(), Counter()
        for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            (toxic if y else clean).update(terms(text.decode("utf-8", "replace")))
        both = list(toxic.keys() | clean.keys())
        yield pa.record_batch({"term": pa.array(both, pa.string()), "p": pa.array([toxic[t] for t in both], pa.int64()), "n": pa.array([clean[t] for t in both], pa.int64())})

    total = common.mapped(rows, counted, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    odds = F.log((F.col("p") + 0.5) / (sides[1] + 1)) - F.log((F.col("n") + 0.5) / (sides[0] + 1))
    top = total.where((F.col("p") >= LEAST_DOCS) & (odds >= LEAST_ODDS)).orderBy(odds.desc(), "term").limit(20 * ENTRIES)
    weights = choose([(r.term, r.p, r.n) for r in top.collect()], sides[1], sides[0])
    first = Lexicon(tuple(weights.items()))

    def neighbours(batch):
        toxic, clean = Counter(), Counter()
        for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            folded, found = fold(text.decode("utf-8", "replace")), set()
            for start, end, _, _ in first.matches(folded):
                stop = folded.index(" ", max(end - 1, start + 1))
                after, before = folded.find(" ", stop + 1), folded.rfind(" ", 0, start) if start else -1
                found.update(x for x in (folded[start : after + 1] if after > 0 else "", folded[before : stop + 1] if before >= 0 else "") if x)
            (toxic if y else clean).update(found)
        both = list(clean)
        yield pa.record_batch({"term": pa.array(both, pa.string()), "p": pa.array([toxic[t] for t in both], pa.int64()), "n": pa.array([clean[t] for t in both], pa.int64())})

    phrases = common.mapped(rows, neighbours, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    phrases = phrases.where("n >= 3 and n >= 3 * p").orderBy(F.desc("n"), "term").limit(EXCEPTIONS).collect()
    lexicon = Lexicon(first.weights, tuple(r.term for r in phrases))

    def measured(batch):
        facts = [lexicon.facts(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
        yield pa.record_batch({"total": pa.array([f[0] for f in facts], pa.float64()), "words": pa.array([f[1] for f in facts], pa.int64()), "y": batch.column(2)})

    got = common.mapped(rows, measured, "total double, words long, y int").toPandas()  # bound rows of 3 numbers
    x = np.stack(np.broadcast_arrays(*features(got.total.to_numpy(), got.words.to_numpy())), 1)
    return Lexicon(lexicon.weights, lexicon.exceptions, fit(x, got.y.to_numpy(float)))


def scores(docs: DataFrame, lexicon: Lexicon, *keep: str) -> DataFrame:
    """doc_id, score of every row. The lexicon is sent along: ENTRIES and EXCEPTIONS bound it."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def each(batch):
        lex = shared.value
        yield pa.record_batch({"doc_id": batch.column(0).cast(pa.int64()), "score": pa.array([lex.score(t.as_py().decode("utf-8", "replace")) for t in batch.column(1)], pa.float64())})

    return common.mapped(common.docs_of(docs), each, "doc_id long, score double")


def clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score stays below the threshold, with all their columns, in one pass over them."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def each(batch):
        lex = shared.value
        texts = batch.column(batch.schema.get_field_index("text"))
        keep = pa.array([lex.score(t.as_py() or "") < threshold for t in texts], pa.bool_())
        yield batch.filter(keep)

    return common.mapped(docs, each, docs.schema)
