"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are labelled rows of quality 1; the unlabelled set is plain web text, whatever its quality. With the class prior p the
risk is p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)): the negative part is estimated from both sets and held at or above
zero, so a flexible model can't drive it below what is possible. The prior is estimated from the labelled rows to learn from (share of
quality 1, smoothed). The model is one hidden layer over measures of a text's form; its loss is the logistic one, so its output estimates
the probability of quality.

At most SAMPLE positives, SAMPLE labelled rows (for the prior) and twice SAMPLE unlabelled rows are used, taken in hash order (a documented bound);
their measures, some numbers a row, go to the driver. Scoring is one pass over all rows.

Defined results: null and empty texts are measured as empty and get that text's score; repeated rows get the same score; without positives or
unlabelled rows every score is the prior (1/2 without labels); of rows that share a doc_id, the least text is learned from; an empty table gives an empty table; extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 6_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 60, 512, 5e-3, 1e-4, 7
#: How far below zero the negative part of a batch may go before its gradient is turned round.
SLACK = 0.0
CHUNK = 1 << 15

_LINK = re.compile(rb"https?://|www\.")


def measures(text: bytes) -> list[float]:
    """Form of a whole text: sizes, repetition, and shares of kinds of characters and lines."""
    n = max(len(text), 1)
    words = text.split()
    w = max(len(words), 1)
    lines = [x.strip() for x in text.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    counts = Counter(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = lambda chars: float(kinds[list(chars)].sum()) / n
    line_counts = Counter(lines)
    lengths = [len(x) for x in lines]
    packed = sum(len(zlib.compress(text[i : i + CHUNK], 1)) for i in range(0, len(text), CHUNK))
    top = counts.most_common(1)[0][1] if words else 0
    vowels = kinds[list(b"aeiouAEIOU")].sum() + kinds[0xC3]
    letters = kinds[65:91].sum() + kinds[97:123].sum() + kinds[0xC3]
    return [
        math.log1p(len(words)), math.log1p(len(text)), sum(map(len, words)) / w, len(counts) / w, top / w, same / w, pairs / w,
        share(b"0123456789"), share(range(65, 91)), share(b".,;:"), share(b".?!") * n / w, share(b"#$%&*@^~=+<>\\/_{}[]"), share(b"|"), share(b"?!"), share(b"\"'()"), share(range(0, 9)),
        float(letters) / n, float(vowels) / max(float(letters), 1.0), share(range(128, 256)), share(b" "), share(b"\n") * 100,
        math.log1p(len(lines)), sum(v for v in line_counts.values() if v > 1) / k, sum(x < 30 for x in lengths) / k, math.log1p(sum(lengths) / k),
        sum(x[-1:] in b".!?" for x in lines) / k, sum(x[:1] in b"-*|0123456789\xe2" for x in lines) / k, packed / n, packed / n * math.log1p(n), len(_LINK.findall(text)) / w,
        sum(v == 1 for v in counts.values()) / w, math.log1p(top),
    ]


class Model:
    """Standardised measures, one hidden layer, one output."""

    def __init__(self, prior: float):
        self.prior, self.layers = prior, None

    def raw(self, x: np.ndarray) -> np.ndarray:
        mean, scale, a, b, c, d = self.layers
        return np.tanh(np.clip((x - mean) / scale, -6, 6) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -50, 50)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    model = Model(prior)
    if not len(positive) or not len(unlabelled):
        return model
    rng = np.random.default_rng(SEED)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    d = p.shape[1]
    weights = [rng.normal(0, 1 / math.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.array([math.log(prior / (1 - prior))])]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    steps = max(1, len(u) // BATCH)
    for epoch in range(EPOCHS):
        pu, uu = rng.permutation(len(p)), rng.permutation(len(u))
        for i in range(steps):
            xp = p[np.take(pu, range(i * BATCH, (i + 1) * BATCH), mode="wrap")]
            xu = u[uu[i * BATCH : (i + 1) * BATCH]]
            a, b, c, e = weights
            hp, hu = np.tanh(xp @ a + b), np.tanh(xu @ a + b)
            fp, fu = hp @ c + e, hu @ c + e
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            gp, gu = np.zeros(len(fp)), np.zeros(len(fu))
            if negative >= -SLACK:
                gp += -prior * sigmoid(-fp) / len(fp) - prior * sigmoid(fp) / len(fp)
                gu += sigmoid(fu) / len(fu)
            else:  # step back up from an impossible negative part
                gp += prior * sigmoid(fp) / len(fp)
                gu -= sigmoid(fu) / len(fu)
            dp, du = np.outer(gp, c) * (1 - hp * hp), np.outer(gu, c) * (1 - hu * hu)
            grads = [xp.T @ dp + xu.T @ du + DECAY * a, dp.sum(0) + du.sum(0), hp.T @ gp + hu.T @ gu + DECAY * c, np.array([gp.sum() + gu.sum()])]
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.layers = (mean, scale, *weights)
    return model


def _measured(docs: DataFrame) -> DataFrame:
    def each(batch):
        m = [measures(t.as_py()) for t in batch.column(1)]
        yield pa.record_batch({"side": batch.column(2), "m": pa.array(m, pa.list_(pa.float64()))})

    return common.mapped(docs, each, "side int, m array<double>")


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """labels: doc_id, quality; only rows to learn from."""
    rows = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    rows = common.cut(rows)
    seen = rows.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    prior = (float(seen.p or 0) + 1) / (seen.n + 2)
    if not seen.p:
        return Model(prior)
    positive = common.in_hash_order(rows.where("y = 1").select("doc_id"), "doc_id", bound)
    others = docs.select("doc_id").where("doc_id is not null").join(rows.select("doc_id"), "doc_id", "left_anti").distinct()
    others = common.in_hash_order(common.cut(others), "doc_id", 2 * bound)
    picked = common.cut(positive.withColumn("side", F.lit(1)).unionByName(others.withColumn("side", F.lit(0))))  # 3 * bound rows of 12 bytes
    got = _measured(common.one_text(docs, picked, "side")).collect()  # bounded like picked, 32 numbers a row
    side, x = np.array([r.side for r in got]), np.array([r.m for r in got], float)
    order = np.lexsort((*x.T, side)) if len(x) else []
    side, x = side[order], x[order]
    return train(x[side == 1], x[side == 0], prior) if len(x) else Model(prior)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batch):
        x = np.array([measures(t.as_py()) for t in batch.column(1)], float)
        yield pa.record_batch({"doc_id": batch.column(0).cast(pa.int64()), "score": shared.value.scores(x)})

    return common.mapped(common.docs_of(docs), each, "doc_id long, score double")
