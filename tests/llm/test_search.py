import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=20):
    words = [TERM.findall((t or "").translate(LOW)) for _, t in docs]
    n, total = sum(map(bool, words)), max(1, sum(map(len, words)))
    df = Counter(w for x in words for w in set(x))
    out = []
    for item, text in items:
        found = []
        for (doc, _), own in zip(docs, words):
            tf, m = Counter(own), 75 + 25 * len(own) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * tf[w] // (1000 * tf[w] + 12 * m)) for w in TERM.findall((text or "").translate(LOW)))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found)[:top])]
    return Counter(out)


def made(seed, n):
    random.seed(seed)
    words = ["Ana", "b2", "cé", "D", "ñu", "x_y", "ZZ", "it's", "日本", "é", "q", "the", "the", "the"]
    return [" ".join(random.choice(words) for _ in range(random.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def items_frame(spark):
    return lambda rows: spark.createDataFrame([(i, t, "n", 1, 2) for i, t in rows], "item_id long, text string, number string, item int, score int")


@pytest.mark.parametrize("index_bytes,top", [(S.INDEX_BYTES, 20), (300, 3)])
def test_equal_to_brute_force(texts_frame, items_frame, monkeypatch, index_bytes, top):
    monkeypatch.setattr(S, "INDEX_BYTES", index_bytes)
    docs = [*enumerate(made(1, 150)), (None, "Ana q ZZ"), (None, None), (5, "q q q"), (5, "q q q"), (900, ""), (901, "\x00 \x7f ..."), (902, "ana " * 100_000)]
    items = [*enumerate(made(2, 9)), (3, "q q"), (3, "q q"), (None, "zz"), (77, None), (78, "unknown terms only"), (79, "")]
    got = S.search(texts_frame(docs).repartition(7), items_frame(items), top=top)
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == brute(docs, items, top)


def test_empty_tables(texts_frame, items_frame):
    assert S.search(texts_frame([]), items_frame([(1, "a")])).count() == 0
    assert S.search(texts_frame([(1, "a")]), items_frame([])).count() == 0
    assert S.search(texts_frame([(1, None)]), items_frame([(1, "a")])).count() == 0


def test_heaps_keep_the_best_in_any_order():
    entries = [(random.Random(3).randint(1, 5), i) for i in range(60)] + [(2, None)] * 3
    want = sorted(entries, key=lambda e: (-e[0], e[1] is None, e[1] or 0))[:7]
    for seed in range(5):
        random.Random(seed).shuffle(entries)
        h = S.Heaps(1, 7)
        for score, i in entries:
            h.push(0, score, i)
        assert sorted((-s, -x) for s, x in h.heaps[0]) == [(-s, S.NO_ID if i is None else i) for s, i in want]
        assert h.least[0] == want[-1][0] and isinstance(h.least, np.ndarray)


def test_merge_of_heaps_has_two_levels(texts_frame, items_frame):
    out = S.search(texts_frame(list(enumerate(made(5, 30)))), items_frame([(1, "q zz")]), top=2)
    plan = out._jdf.queryExecution().toString()
    assert "task" in plan and out.agg(F.max("rank")).first()[0] == 2
