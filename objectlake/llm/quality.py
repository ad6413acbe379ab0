"""Quality by positive-unlabelled learning.

Trusted positives are rows labelled 1; the unlabelled sample is web text without
a label.  Texts are described by shares of character kinds, word and line shapes
and repetition; each is cut at quantiles, so that an additive model can bend.
The class prior of the unlabelled texts is estimated by the best bin: the least
ratio of unlabelled to positive texts above a score of a first model.  The
weights minimise the non-negative unbiased risk: the positives' loss times the
prior, plus the unlabelled texts' loss as negatives less the positives' part in
it, never below zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pick
from .labelled import fit_logistic, held_out, learnable, logistic, some
from .shingles import mixed, text_bytes, word_hashes

#: the sample: trusted positives and unlabelled texts, and texts labelled 0 to set the scale, at most
POSITIVES, UNLABELLED, NEGATIVES = 4000, 6000, 2000
BINS = 10

_KIND = np.zeros((9, 256), np.int64)    # upper, lower, digit, stop, mark, symbol, space, line end, beyond ASCII
for _row, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"()-", b"!?",
                               b"#%&*$|<>{}[]=_~^\\@+/`", b" \t", b"\n\r")):
    _KIND[_row, list(_chars)] = 1
_KIND[8, 128:] = 1
N_FEATURES = 20


def distinct_in(keys: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many different keys it has, and how often its most frequent occurs."""
    n = len(begins) - 1
    owner = np.repeat(np.arange(n), np.diff(begins))
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))) if len(k) else np.zeros(0, int)
    runs = np.diff(np.append(new, len(k)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, o[new], runs)
    return np.bincount(o[new], minlength=n), most


def features(column: pa.Array) -> np.ndarray:
    """A row of ``N_FEATURES`` numbers for each text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    sums = np.zeros((9, n))
    for r in range(9):
        run = np.concatenate([[0], np.cumsum(_KIND[r][data])])
        sums[r] = run[offsets[1:]] - run[offsets[:-1]]
    hashes, begins = word_hashes(data, offsets, lower=False)
    words = np.diff(begins)
    distinct, most = distinct_in(hashes, begins)
    pairs = mixed(hashes[:-1] + hashes[1:] * np.uint64(3)) if len(hashes) > 1 else hashes[:0]
    triples = mixed(pairs[:-1] + hashes[2:] * np.uint64(5)) if len(hashes) > 2 else hashes[:0]
    inside = np.ones(len(triples), bool)
    for back in (1, 2):     # triples that reach into the next text
        at = begins[1:-1] - back
        inside[at[(at >= 0) & (at < len(triples))]] = False
    owner_begin = np.searchsorted(np.flatnonzero(inside), np.concatenate([begins[:-1], [len(triples)]]))
    rare, often = distinct_in(triples[inside], owner_begin)
    n_triples = np.diff(owner_begin)
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(breaks + 1, offsets[:-1][size > 0])
    starts = starts[starts < len(data)].astype(np.int64)
    line_ends = np.append(starts[1:], len(data))
    if len(starts):
        codes = mixed(data.astype(np.uint64) + np.uint64(1)) * (np.arange(len(data), dtype=np.uint64) - np.repeat(starts, line_ends - starts).astype(np.uint64) + np.uint64(7))
        codes[data == 10] = 0
        lines = mixed(np.add.reduceat(codes, starts))
    else:
        lines = np.zeros(0, np.uint64)
    line_begin = np.searchsorted(starts, offsets)
    n_lines = np.diff(line_begin)
    kinds, _ = distinct_in(lines, line_begin)
    letters = sums[0] + sums[1] + sums[8]

    def share(a, b):
        return a / np.maximum(1, b)
    return np.column_stack([
        np.log1p(size), share(sums[0], letters), share(sums[2], size), share(sums[3], size), share(sums[4], size),
        share(sums[5], size), share(sums[6], size), share(sums[7], size), share(sums[8], size),
        share(size - sums[6] - sums[7], words), share(distinct, words), share(most, words), share(rare, n_triples),
        share(often, n_triples), share(kinds, n_lines), share(words, n_lines), np.log1p(words), np.log1p(n_lines),
        share(sums[4] + sums[5], words), share(sums[3], words)])


def onehot(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.searchsorted(c, x[:, i], side="right")[:, None] == np.arange(len(c) + 1) for i, c in enumerate(cuts)], 1).astype(float)


@dataclass
class QualityModel:
    cuts: list[np.ndarray]
    weights: np.ndarray | None
    prior: float
    level: np.ndarray | None = None     # from the risk's score to a probability

    def raw(self, x: np.ndarray) -> np.ndarray:
        return onehot(x, self.cuts) @ self.weights[:-1] + self.weights[-1]

    def score(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(column), self.prior)
        z = self.raw(features(column))
        return logistic(z[:, None], np.array([1.0, 0.0]) if self.level is None else self.level)


def calibrate(model: QualityModel, x: np.ndarray, y: np.ndarray, share: float) -> None:
    """Sets the scale on which 0.5 is even odds, by labelled texts of both
    classes of which ``share`` is positive; with one class it stays as it is."""
    if model.weights is not None and 0 < y.sum() < len(y):
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        level = fit_logistic(model.raw(x)[:, None], y, weight, ridge=0.1)
        if level[0] > 0:
            model.level = level


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled texts from both kinds' scores."""
    levels = np.unique(np.quantile(positive, np.linspace(0, 0.95, 96)))
    p = np.array([(positive >= c).mean() for c in levels])
    u = np.array([(unlabelled >= c).mean() for c in levels])
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    at = int(np.argmin((u + slack) / p))
    return float(np.clip(u[at] / p[at], 0.05, 0.98))


def nonnegative_risk(p: np.ndarray, u: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.05, hold: float = 1e-4) -> np.ndarray:
    """Weights (the last the constant) that minimise the non-negative risk with the logistic loss, by Adam."""
    p, u = np.column_stack([p, np.ones(len(p))]), np.column_stack([u, np.ones(len(u))])
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        zp, zu = np.clip(p @ w, -30, 30), np.clip(u @ w, -30, 30)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope_n = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        slope = prior * (p.T @ (sp - 1)) / len(p) + slope_n if negative >= 0 else -slope_n
        slope = slope + hold * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel:
    """The model of the features of trusted positives and of unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        return QualityModel([], None, 1.0 if len(positive) else 0.0)
    both = np.concatenate([positive, unlabelled])
    cuts = [np.unique(np.quantile(both[:, i], np.concatenate([[0.01, 0.03], np.linspace(0, 1, BINS + 1)[1:-1], [0.97, 0.99]]))) for i in range(both.shape[1])]
    p, u = onehot(positive, cuts), onehot(unlabelled, cuts)
    # a first model of one half of each, its scores on the other half for the prior
    a, b = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    prior = 0.5
    if a.sum() and (~a).sum() and b.sum() and (~b).sum():
        x, y = np.concatenate([p[a], u[b]]), np.concatenate([np.ones(a.sum()), np.zeros(b.sum())])
        first = fit_logistic(x, y, np.ones(len(y)), ridge=5.0)
        prior = best_bin(logistic(p[~a], first), logistic(u[~b], first))
    return QualityModel(cuts, nonnegative_risk(p, u, prior), prior)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> QualityModel:
    """The model from at most ``POSITIVES`` rows labelled 1 outside the held-out
    fold and ``UNLABELLED`` texts without a label outside the fold (what is
    labelled inside it isn't looked at; if all have one, learnable ones, their
    labels unseen); their features (not their
    texts) come to the driver, which fits the weights.  At most ``NEGATIVES``
    rows labelled 0 outside the fold then set the scale of the score."""
    known = learnable(labels, "quality", folds, fold)
    count = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    good = some(known.where("label = 1").select("doc_id"), POSITIVES).withColumn("kind", F.lit(1))
    bad = some(known.where("label = 0").select("doc_id"), NEGATIVES).withColumn("kind", F.lit(2))
    rows = pick(docs, "doc_id", "text")
    bare = rows.select("doc_id").where("doc_id is not null").distinct().join(known.select("doc_id"), "doc_id", "left_anti")
    if bare.isEmpty():      # every text has a label: learnable ones without it
        bare = known.select("doc_id")
    chosen = good.unionByName(some(bare, UNLABELLED).withColumn("kind", F.lit(0))).unionByName(bad)
    sample = rows.join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for b in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("kind"), pa.array(list(features(b.column("text"))), pa.list_(pa.float64()))],
                                             names=["doc_id", "kind", "x"])
    found = sample.mapInArrow(run, "doc_id long, kind int, x array<double>").groupBy("doc_id", "kind").agg(F.min("x").alias("x"))
    found = sorted((r["kind"], r["doc_id"], r["x"]) for r in found.collect())
    x = np.array([r[2] for r in found]).reshape(len(found), N_FEATURES)
    kind = np.array([r[0] for r in found], int)
    model = fit(x[kind == 1], x[kind == 0])
    calibrate(model, x[kind > 0], (kind[kind > 0] == 1).astype(int), count.get(1, 0) / max(1, sum(count.values())))
    return model


def score_quality(docs: DataFrame, model: QualityModel, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``,
    ``held_out``, ``score`` (0 to 1, of the whole text; null as empty) and
    ``predicted``.  Rows with null ids are never held out; repeated rows give
    repeated rows with equal scores, an empty table none; other columns are ignored."""
    def run(batches):
        for b in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(b.column("text")), pa.float64())], names=["doc_id", "score"])
    scored = pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
