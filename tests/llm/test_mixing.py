import random
import re
from collections import Counter, defaultdict

import numpy as np

from panelkit.llm import mixing


def brute_targets(sizes):
    out, full = [0.0] * len(sizes), set()
    while True:
        rest = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in full)
        weights = {i: (3, 1, 2)[i % 3] for i in range(len(sizes)) if i not in full}
        out = [2.0 * s if i in full else rest * weights[i] / sum(weights.values()) for i, s in enumerate(sizes)]
        more = {i for i in weights if out[i] > 2 * sizes[i]}
        if not more:
            return out
        full |= more


def test_targets():
    random.seed(1)
    for _ in range(300):
        sizes = [random.choice([0, random.randint(1, 50), random.randint(1, 5000)]) for _ in range(random.randint(1, 12))]
        got = mixing.targets(sizes)
        assert np.allclose(got, brute_targets(sizes)) and abs(sum(got) - 1.5 * sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert mixing.targets([]) == []


def test_permutations():
    for size in (1, 2, 3, 5, 64, 1000, 4097):
        images = [mixing.permuted(np.arange(size), size, key) for key in (0, 1, 2)]
        assert all(sorted(i) == list(range(size)) for i in images)
    assert not (images[0] == images[1]).all() and not (images[0] == np.arange(4097)).all()


def _rows():
    random.seed(8)
    rows = []
    for i in range(300):
        source = random.choice(["a", "a", "a", "b", "É", "c", None])
        rows.append((i, " ".join(f"w{i}.{k}" for k in range(random.choice([0, 3, 40, 400]))), source, "x", 1))
    rows += [(7, None, "a", "x", 1), (8, "same text", "b", "x", 1), (8, "same text", "b", "y", 1), (None, "no id", None, "x", 1), (9, "\n\t", "empty", "x", 1)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, sid string, bucket int").repartition(5)


def test_taken_words(spark):
    rows = _rows()
    got = mixing.taken_words(_frame(spark, rows), block_words=16).collect()
    again = mixing.taken_words(_frame(spark, rows).repartition(3), block_words=16).collect()
    assert Counter(got) == Counter(again) and len(got) == len(rows)
    sizes = defaultdict(int)
    count = lambda t: len(re.findall("[^ \t-\r]+", t or ""))
    for i, t, s, *_ in rows:
        sizes[s] += count(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, brute_targets([sizes[s] for s in order])))
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == Counter((i, count(t), sizes[s], round(wanted[s], 6)) for i, t, s, *_ in rows)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source_size] += r.taken
    for s in order:
        assert abs(taken[sizes[s]] - wanted[s]) <= 32, s


def test_shards_and_blocks(spark):
    slots = mixing.drawn_slots(spark, [1000, 160, 5], [90, 20, 2], block_words=16, shard_blocks=10).collect()
    by = defaultdict(list)
    for s in slots:
        by[s.sid].append((s.block, s.turn))
    assert [len(by[k]) for k in range(3)] == [90, 20, 2]
    assert sorted(by[1]) == [(b, t) for b in range(10) for t in range(2)] and sorted(by[2]) == [(0, 0), (0, 1)]
    assert len(set(by[0])) == 90 and max(b for b, _ in by[0]) == 62
    assert len({s.shard for s in slots}) > 5 and len({(s.sid, s.shard, s.slot) for s in slots}) == 112


def test_mixed_texts_are_what_is_taken(spark):
    rows = [(i, t, s) for i, t, s, *_ in _rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mixed_texts(docs, block_words=16).collect()
    words = lambda t: re.findall("[^ \t-\r]+", t or "")
    own = {i: words(t) for i, t, _ in rows if i not in (7, 8, 9)}
    got = Counter()
    for r in mixed:
        if r.doc_id in own:
            assert set(words(r.text)) <= set(own[r.doc_id])
        got[r.doc_id] += len(words(r.text))
    want = Counter()
    for r in mixing.taken_words(docs, block_words=16).collect():
        want[r.doc_id] += r.taken
    assert {k: v for k, v in want.items() if v} == dict(got)


def test_empty_table(spark):
    assert mixing.taken_words(_frame(spark, [])).count() == 0
    assert mixing.mixed_texts(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_cut_keeps_white_space_inside_runs():
    assert mixing.cut("  a \n b\tc  d ", [(2, 1), (0, 2)]) == "a \n b\tc"
    assert mixing.cut("a b c d", [(3, 1), (0, 1)]) == "a\nd" and mixing.cut("", []) == ""


def test_rows_that_differ_in_other_columns_keep_them(spark):
    text = " ".join(f"w{k}" for k in range(64))
    rows = [(1, text, None, "en"), (1, text, "", "en"), (1, text, "", "de"), (1, text, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = Counter()
    for r in mixing.mixed_texts(docs, block_words=16).collect():
        got[r.source, r.lang] += len(r.text.split())
    assert set(got) == {r[2:] for r in rows} and all(n <= 128 for n in got.values())
