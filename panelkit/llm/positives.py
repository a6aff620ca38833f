"""Quality classifier learned from positives and unlabelled texts.

Trusted positives are documents labelled good; every other document that may be learned from is unlabelled web text, whatever
it holds. Each text becomes a few dozen numbers, once. A logistic model on them minimises the unbiased risk
pi * R+(positives, good) + max(0, R-(unlabelled, bad) - pi * R-(positives, bad)), where pi is the share of good texts: the second
part estimates the loss on bad texts and must not fall below zero, so a step that takes it there is shortened. The risk and its
derivatives are sums over all documents that Spark adds up; the driver holds one vector and solves for one Newton step a round.

The prior pi is estimated from the same two samples: a first model, fitted to one half of them, tells positives from unlabelled
texts, and in the other half the least ratio of unlabelled to positive documents above a score is the share of good texts among
the unlabelled ones (best bin estimation).

Defined results: null and empty texts have all-zero counts and get a score as others do; repeated rows count and are scored
each by itself; without any positive or any unlabelled row every score is 1/2; a row without
id is never learned from by a label, as it has none; an empty table gives an empty table; only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import text_pieces
from panelkit.session import materialize

PIECE_BYTES = 1 << 20
ROUNDS, STEPS = 12, (1.0, 0.5, 0.25, 0.1)
RIDGE, RIDGE_ROWS = 3e-3, 5.0  # penalty, and what it grows by over the number of positives
WIDEST = 4.0  # deviations at which a number is held
BINS = 400
LEAST_SHARE = 0.05  # of the positives above a score that may give the prior
SYMBOLS = b"#*$%&|<>"
CLASSES = np.zeros(256, np.int64)
for _code in range(256):
    CLASSES[_code] = (1 if 65 <= _code <= 90 else 2 if 97 <= _code <= 122 else 3 if 48 <= _code <= 57 else 4 if _code == 10 else 5 if _code in (9, 11, 12, 13, 32)
                      else 6 if _code in SYMBOLS else 7 if _code in b"!?" else 8 if _code in b".," else 9 if _code >= 128 else 0)
NAMES = ("bytes", "words", "word_length", "capitals", "digits", "lines", "symbols", "shouts", "stops", "other_marks", "wide", "distinct_words", "top_word",
         "distinct_lines", "repeats", "ends_marked", "one_letter", "long_words", "doubled_words")


def _numbers(text: str | None) -> list[float]:
    """Counts and shares of one text, each in a small range."""
    raw = text.encode() if text else b""
    kinds = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=10) if raw else np.zeros(10, np.int64)
    words = raw.split()
    n = len(words)
    distinct, counts = np.unique(np.fromiter(map(hash, words), np.int64, n), return_counts=True) if n else ((), np.zeros(1))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters, size = max(1, kinds[1] + kinds[2]), max(1, len(raw) - kinds[4] - kinds[5])
    lengths = np.fromiter(map(len, words), np.int64, n)
    triples = len({tuple(words[i:i + 3]) for i in range(n - 2)}) / (n - 2) if n > 2 else 1.0
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in b"!?#*$%&|" for w in words)
    share = lambda x, whole: float(np.sqrt(x / whole))  # noqa: E731  small shares stay apart
    return [np.log1p(len(raw)), np.log1p(n), np.log1p(size / n if n else 0), share(kinds[1], letters), share(kinds[3], size), share(kinds[4], max(1, len(raw))),
            share(kinds[6], size), share(kinds[7], size), share(kinds[8], size), share(kinds[0], size), share(kinds[9], size),
            len(distinct) / max(1, n), share(counts.max(), max(1, n)), len(set(lines)) / max(1, len(lines)), 1 - triples, share(ends, max(1, n)),
            share(int((lengths == 1).sum()), max(1, n)), share(int((lengths > 15).sum()), max(1, n)),
            share(doubled, max(1, n))]


def numbers(text: Column | str) -> Column:
    """``NAMES`` of a whole text as an array of floats."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [_numbers(t) for part in text_pieces(batch, PIECE_BYTES) for t in part]
            yield pa.array([np.asarray(r, np.float32) for r in rows], pa.list_(pa.float32()))

    return F.arrow_udf(run, "array<float>")(text)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES)).astype(np.float64)


@dataclass
class Scale:
    """Centres and widths of the numbers over all documents."""

    mean: np.ndarray
    width: np.ndarray

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """Constant, scaled numbers and their squares, all held within a range."""
        z = np.clip((x - self.mean) / self.width, -WIDEST, WIDEST)
        return np.column_stack([np.ones(len(z)), z, z * z / WIDEST])


@dataclass
class Model:
    scale: Scale
    weights: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale.inputs(x) @ self.weights, -40, 40)))


def _summed(rows: DataFrame, of) -> dict[int, float]:
    """Sums by place of the vectors that ``of`` gives for (numbers, positive) of a batch; Spark adds those of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                here = of(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    parts = rows.select("numbers", "positive").mapInArrow(run, "at bigint, value double")
    return {r.at: r.value for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}  # one row per place of a vector


def _vector(sums: dict[int, float], size: int) -> np.ndarray:
    return np.array([sums.get(k, 0.0) for k in range(size)])


def fit_scale(rows: DataFrame) -> Scale:
    d = len(NAMES)
    s = _vector(_summed(rows, lambda x, _: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])), 1 + 2 * d)
    n = max(1.0, s[0])
    mean = s[1:1 + d] / n
    return Scale(mean, np.sqrt(np.maximum(s[1 + d:] / n - mean * mean, 1e-6)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _risk_sums(x: np.ndarray, positive: np.ndarray, scale: Scale, tried: list[np.ndarray]) -> np.ndarray:
    """Losses at each of the weights tried: positives as good and as bad, unlabelled as bad; then derivatives at each."""
    z = scale.inputs(x)
    p, u = z[positive], z[~positive]
    out = [np.array([len(p), len(u)], float), p.sum(axis=0)]
    for w in tried:
        a, b = p @ w, u @ w
        s, t = 1 / (1 + np.exp(-np.clip(b, -40, 40))), 1 / (1 + np.exp(-np.clip(a, -40, 40)))
        out += [np.array([_softplus(-a).sum(), _softplus(a).sum(), _softplus(b).sum()]), u.T @ s, ((u * (s * (1 - s))[:, None]).T @ u).ravel(),
                p.T @ t, ((p * (t * (1 - t))[:, None]).T @ p).ravel()]
    return np.concatenate(out)


def _fit(rows: DataFrame, scale: Scale, prior: float | None) -> np.ndarray:
    """Newton steps on the non-negative unbiased risk; without a prior, on the plain loss of positives against unlabelled."""
    d = 1 + 2 * len(NAMES)
    block = 3 + 2 * (d + d * d)
    tried, best, best_risk, best_step, shrink = [np.zeros(d)], None, np.inf, None, 1.0
    for _ in range(ROUNDS):
        s = _vector(_summed(rows, lambda x, y: _risk_sums(x, y, scale, tried)), 2 + d + block * len(tried))
        n_p, n_u = max(1.0, s[0]), max(1.0, s[1])
        before = best_risk
        for k, w in enumerate(tried):
            part = s[2 + d + k * block:2 + d + (k + 1) * block]
            good, bad, unlabelled = part[0] / n_p, part[1] / n_p, part[2] / n_u
            g_u, h_u = part[3:3 + d] / n_u, part[3 + d:3 + d + d * d].reshape(d, d) / n_u
            g_p, h_p = part[3 + d + d * d:3 + 2 * d + d * d] / n_p, part[3 + 2 * d + d * d:].reshape(d, d) / n_p
            ridge = np.full(d, RIDGE + RIDGE_ROWS / n_p)
            ridge[0] = 1e-9
            mean_p = s[2:2 + d] / n_p
            if prior is None:
                risk, grad, hess = good + unlabelled, g_u + g_p - mean_p, h_u + h_p
            else:
                negative = unlabelled - prior * bad
                risk = prior * good + max(0.0, negative)
                grad, hess = g_u - prior * mean_p, h_u  # the difference of the positives' losses is linear
                if negative < 0 and w.any():
                    risk = np.inf  # the step went where the estimate of the bad texts' loss is no loss any more
            risk += 0.5 * (ridge * w * w).sum()
            if risk < best_risk - 1e-9:
                best, best_risk = w, risk
                best_step = -np.linalg.solve(hess + np.diag(ridge + 1e-9), grad + ridge * w)
        shrink = 1.0 if best_risk < before else shrink / 10
        if before - best_risk < 1e-7 and (best_risk < before or shrink < 1e-3):
            break
        tried = [best + shrink * t * best_step for t in STEPS]
    return best


def estimate_prior(rows: DataFrame, scale: Scale, weights: np.ndarray) -> float:
    """Least ratio of the unlabelled to the positive documents above a score, over scores with enough positives above."""

    def binned(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        score = 1 / (1 + np.exp(-np.clip(scale.inputs(x) @ weights, -40, 40)))
        at = np.minimum((score * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(at[positive], minlength=BINS), np.bincount(at[~positive], minlength=BINS)]).astype(float)

    s = _vector(_summed(rows, binned), 2 * BINS)
    above = lambda v: np.cumsum(v[::-1])[::-1]
    p, u = above(s[:BINS]), above(s[BINS:])
    if not p[0] or not u[0]:
        return 0.5
    share_p, share_u = p / p[0], u / u[0]
    enough = share_p >= max(LEAST_SHARE, min(1.0, 20 / p[0]))
    slack = np.sqrt(np.log(100) / (2 * u[0])) + np.sqrt(np.log(100) / (2 * p[0]))  # chance deviation of both shares
    ratio = np.where(enough, (share_u + slack) / np.maximum(share_p, 1e-12), np.inf)
    at = int(ratio.argmin())
    return float(np.clip(share_u[at] / share_p[at], 0.01, 0.99))


def learn(rows: DataFrame) -> Model:
    """Model from rows (numbers, positive, half): positive is true for trusted positives, false for unlabelled rows."""
    scale = fit_scale(rows)
    known = _vector(_summed(rows, lambda x, y: np.array([y.sum(), (~y).sum()], float)), 2)
    if not known.all():
        return Model(scale, np.zeros(1 + 2 * len(NAMES)), 0.5)
    # The first model must not be asked about rows that it was fitted to; equal texts are in one half.
    prior = estimate_prior(rows.where("half = 1"), scale, _fit(rows.where("half = 0"), scale, None))
    return Model(scale, np.round(_fit(rows, scale, prior), 9), prior)


def quality_scores(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``.

    ``labels`` (doc_id, quality) marks good documents by 1; ``may_learn`` (of doc_id) says which rows may be learned from, by
    label or as unlabelled text. Documents with label 0 are unlabelled text like others.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("good_id")).distinct()
    measured = docs.select(F.col(doc_id).alias("doc_id"), numbers(text).alias("numbers"))
    marked = measured.join(good, F.col("doc_id") == F.col("good_id"), "left").select(
        "doc_id", "numbers", F.col("good_id").isNotNull().alias("positive"), F.coalesce(may_learn, F.lit(False)).alias("may_learn"),
        F.pmod(F.xxhash64("numbers"), F.lit(2)).alias("half"))
    rows = materialize(marked)
    model = learn(rows.where("may_learn"))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.scores(_matrix(batch)) if len(batch) else [], pa.float64())

    scored = rows.select("doc_id", F.arrow_udf(run, "double")("numbers").alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
