import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import positives as P


def good(rng):
    words = ["".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 120))]
    return (" ".join(words)).capitalize() + "."


def bad(rng):
    return " ".join("".join(rng.choice("ETAO") for _ in range(5)) + "!!" for _ in range(rng.randint(20, 90)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, good(rng) if rng.random() < 0.6 else bad(rng)) for i in range(900)]


def test_learns_from_positives_and_unlabelled_only(spark, texts_frame, corpus):
    truth = {i: int(not t.endswith("!!")) for i, t in corpus}
    labels = spark.createDataFrame([(i, truth[i], 0) for i in range(0, 900, 4)] + [(None, 1, 0), (5000, 1, 0), (4, 1, 1) if truth[4] else (4, 0, 1)], "doc_id long, quality int, toxic int")
    docs = texts_frame([*corpus, (None, corpus[0][1]), (902, None), (903, ""), (904, "x " * 200_000), (0, corpus[0][1])])
    got = P.quality_scores(docs, labels, F.col("doc_id") % 5 != 0).collect()
    assert len(got) == 905 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(truth[r.doc_id], r.score) for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 5 == 0]
    assert np.mean([(s >= 0.3) == y for y, s in held]) > 0.97
    # What label-0 rows say is not used: without them all scores stay.
    again = P.quality_scores(docs, labels.where("quality = 1"), F.col("doc_id") % 5 != 0).collect()
    close = {(r.doc_id, round(r.score, 6)) for r in got}
    assert {(r.doc_id, round(r.score, 6)) for r in again} == close


def test_prior_and_no_negative_risk():
    rng = np.random.default_rng(0)
    d = len(P.NAMES)
    x = rng.normal(size=(6000, d))
    truth = rng.random(6000) < 0.4
    x[truth] += 1.2
    positive = truth & (rng.random(6000) < 0.3)

    class Rows:
        def __init__(self, kept):
            self.kept = kept

        def where(self, half):
            return Rows(self.kept & (np.arange(6000) % 2 == int(half[-1])))

    original = P._summed
    P._summed = lambda rows, of: dict(enumerate(of(x[rows.kept], positive[rows.kept])))
    try:
        model = P.learn(Rows(np.ones(6000, bool)))
    finally:
        P._summed = original
    share = (truth & ~positive).sum() / (~positive).sum()
    assert abs(model.prior - share) < 0.08
    s = _sums(model, x, positive)
    assert s[2] / (~positive).sum() - model.prior * s[1] / positive.sum() >= 0
    assert np.mean((model.scores(x) >= 0.5) == truth) > 0.95


def _sums(model, x, positive):
    return P._risk_sums(x, positive, model.scale, [model.weights])[2 + len(model.weights):][:3]


def test_without_either_side_every_score_is_a_half(spark, texts_frame):
    docs = texts_frame([(1, "a b c"), (2, "d")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    both = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    for labels, may_learn in ((none, True), (both, True), (both, False)):
        assert {r.score for r in P.quality_scores(docs, labels, F.lit(may_learn)).collect()} == {0.5}
    assert P.quality_scores(texts_frame([]), none, F.lit(True)).count() == 0


def test_numbers_of_a_text():
    n = dict(zip(P.NAMES, P._numbers("AB cd\ncd #!")))
    assert n["words"] == np.log1p(4) and n["capitals"] == np.sqrt(2 / 6) and n["distinct_words"] == 3 / 4
    assert n["doubled_words"] == np.sqrt(1 / 4) and n["ends_marked"] == np.sqrt(1 / 4) and n["distinct_lines"] == 1
    assert P._numbers(None) == P._numbers("")
