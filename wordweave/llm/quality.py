"""Quality by positive-unlabelled learning.

A small network is fitted by minimising the non-negative unbiased risk: trusted positives
(``quality`` 1), unlabelled web text, and a class prior estimated from the labelled rows
outside the held-out fold.  With the logistic loss its output is a calibrated logit.
Inputs are statistics of the bytes, words and lines of the whole text, which take one
pass over it.

At most about ``MAX_TRAIN`` positives and as many unlabelled documents are taken for the
fit.  Null and empty texts have statistics like any other.  Without a positive label
every score is the prior.  Labels, ``lang``, ``source`` and ``doc_id`` are no inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import bernoulli, fold, labelled_ids, map_rows, utf8

# Parameters of the fit.
MAX_TRAIN = 20_000
HIDDEN = 24
STEPS = 3000
BATCH = 1024
RATE = 0.005
DECAY = 1e-4

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    """A row per class of bytes, to be multiplied with a text's byte counts."""
    member = [range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" \t\n\r\x0b\x0c", range(0x80, 0x100), PUNCTUATION]
    member += [bytes([c]) for c in b"\n.,!?|#$%&*<>{}()=/\\:;_-'\"@"]
    rows = np.zeros((len(member), 256))
    for row, codes in zip(rows, member, strict=True):
        row[list(codes)] = 1
    return rows


CLASSES = _classes()


def statistics(raw: bytes) -> np.ndarray:
    """What the model sees of a text."""
    n = len(raw)
    shares = CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(1, n)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    mean = lengths.mean() if len(words) else 0.0
    extra = [
        np.log1p(n) / 10,
        np.log1p(len(words)) / 10,
        min(mean, 40.0) / 10,
        min(lengths.std(), 40.0) / 10 if len(words) else 0.0,
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))) / 10,
        # Repeats within the text: distinct pairs of words against pairs.
        len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1),
    ]
    # Square roots spread the many shares near zero.
    return np.concatenate([np.sqrt(shares), extra])


N_FEATURES = len(statistics(b""))


@dataclass(frozen=True)
class Model:
    """One hidden layer over standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, raw: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logits(statistics(raw)[None])[0], -30, 30))))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> Model:
    """Minimise ``prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)])`` by Adam.

    Where the second term of a batch is negative, its gradient is followed upwards, as
    the non-negative estimator has it.
    """
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    d = both.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    for step in range(1, STEPS + 1):
        xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        x = np.vstack([xp, xu])
        hidden = np.tanh(x @ params[0] + params[1])
        z = hidden @ params[2] + params[3][0]
        sigma = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        negative = np.logaddexp(0, z)  # the loss of calling it negative
        rest = negative[BATCH:].mean() - prior * negative[:BATCH].mean()
        slope = np.empty(2 * BATCH)
        if rest >= 0:
            slope[:BATCH] = prior * (sigma[:BATCH] - 1) - prior * sigma[:BATCH]
            slope[BATCH:] = sigma[BATCH:]
        else:
            slope[:BATCH] = prior * sigma[:BATCH]
            slope[BATCH:] = -sigma[BATCH:]
        slope /= BATCH
        back = np.outer(slope, params[2]) * (1 - hidden**2)
        grads = [x.T @ back + DECAY * params[0], back.sum(0), hidden.T @ slope + DECAY * params[2], np.array([slope.sum()])]
        rate = RATE * (1 - step / (STEPS + 1))
        for a, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, params[0], params[1], params[2], float(params[3][0]), prior)


def _table(rows: DataFrame) -> np.ndarray:
    def start():
        return lambda r: [(statistics(r["raw"]).tolist(),)]

    found = map_rows(rows.select(utf8().alias("raw")), "x array<double>", start).collect()
    return np.array([r["x"] for r in found], float).reshape(-1, N_FEATURES)


def _constant(prior: float) -> Model:
    zero = np.zeros
    logit = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    return Model(zero(N_FEATURES), np.ones(N_FEATURES), zero((N_FEATURES, 1)), zero(1), zero(1), logit, prior)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN, seed: int = 0) -> Model:
    """Learn from positives outside fold 2 of 4 and from documents without a label."""
    learn = fold(4) != 2
    counts = labels.where(learn & F.col("quality").isNotNull()).agg(F.avg("quality").alias("prior")).first()
    prior = 0.5 if counts["prior"] is None else min(0.98, max(0.02, float(counts["prior"])))
    ids = labelled_ids(labels.where(F.col("quality") == 1), "quality", learn, max_rows, seed)
    free = docs.select("doc_id").where("doc_id is not null").join(labels.select("doc_id"), "doc_id", "left_anti")
    some = bernoulli(free, free.count(), max_rows, seed + 1).distinct()
    # About ``max_rows`` ids each, so they can be broadcast.
    positive = _table(docs.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi"))
    unlabelled = _table(docs.join(F.broadcast(some), "doc_id", "left_semi"))
    if not len(positive) or not len(unlabelled):
        return _constant(prior)
    return fit_pu(positive, unlabelled, prior, seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, quality_score)``, one row per document."""

    def start():
        return lambda r: [(r["doc_id"], model.score(r["raw"]))]

    return map_rows(docs.select(F.col("doc_id").cast("long"), utf8().alias("raw")), "doc_id long, quality_score double", start)


def op8_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.7).cast("int").alias("predicted"),
    )
