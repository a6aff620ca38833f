import random
import re
from collections import Counter

from panelkit.llm import quality

WORD = "[^\x20\x09-\x0d]+"


def brute(text):
    w = re.findall(WORD, text or "")
    windows, inside, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            inside |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_counts_equal_brute_force(texts_frame):
    random.seed(9)
    rows = [(i, "".join(random.choice(["a", "b", "é", " ", " ", "\n", "\n", "\t", "#", "<", "ab c", "\x0b", "\x1f"]) for _ in range(random.randint(0, 200)))) for i in range(400)]
    rows += [(1, None), (1, ""), (2, "x y z " * 5_000), (None, "w " * 49), (3, "one two three four " * 13), (3, "one two three four " * 13), (4, "v" * 200_000), (5, " \n \n")]
    rows += [(6, " ".join(f"u{k}" for k in range(30_000)) + " u1 u2 u3")]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    out = quality.judge(texts_frame(rows), []).select("text", "words", *[f"quality_stats.{n}" for n in names]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r[n] for n in names[:6]) == brute(r.text), (r.text or "")[:80]
        assert r.kept == (not r.base_failed) and r.words == "w"
    assert quality.judge(texts_frame([]), []).count() == 0


def _labelled(n=900, noise=0.02):
    random.seed(4)
    out = []
    for i in range(n):
        row = dict.fromkeys(quality.FEATURES, 0.0) | {"n_words": float(random.randint(50, 900)), "mean_word": random.gauss(5, 0.4)}
        kind = random.random()
        if kind < 0.1:
            row["symbols_per_word"] = random.uniform(0.3, 3)
        elif kind < 0.2:
            row["upper_per_char"], row["mean_word"] = random.uniform(0.5, 1), random.gauss(7, 0.5)
        bad = kind < 0.2
        out.append(row | {"bad": int(bad != (random.random() < noise)), "truth": bad})
    return out


def test_learned_list_finds_the_rules():
    rows = _labelled()
    rules = quality.learn_list(rows)
    rejected = [any(all(t.holds(r) for t in rule) for rule in rules) for r in rows]
    assert sum(a != r["truth"] for a, r in zip(rejected, rows)) <= 0.01 * len(rows)
    assert all(len(rule) <= 3 for rule in rules) and len(rules) <= 8


def test_nothing_to_learn():
    rows = _labelled(60)
    assert quality.learn_list([]) == []
    assert quality.learn_list([r | {"bad": 0} for r in rows]) == [] == quality.learn_list([r | {"bad": 1} for r in rows])


def test_expressions_agree_with_rules(texts_frame):
    rules = [(quality.Test("symbols_per_word", True, 0.5),), (quality.Test("n_words", False, 60.0), quality.Test("mean_word", True, 3.0))]
    rows = [(1, "word " * 70), (2, "# " * 70), (3, " ".join(f"longer{k}" for k in range(55))), (4, " ".join(f"w{k}" for k in range(200))), (5, None)]
    got = {r.doc_id: r.kept for r in quality.judge(texts_frame(rows), rules).select("doc_id", "quality_stats.kept").collect()}
    assert got == {1: False, 2: False, 3: False, 4: True, 5: False}


def test_labelled_rows_are_bounded_and_clean(texts_frame, spark):
    docs = texts_frame([(i, f"text {i}") for i in range(50)] + [(3, "text again"), (None, "x"), (60, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, None), (5, 0), (None, 1), (60, 0), (99, 0)], "doc_id long, quality int")
    rows = quality.labelled(docs, labels, max_labelled=20)
    assert len(rows) <= 20 and len({r["__id"] for r in rows}) == len(rows)
    assert len(quality.labelled(docs, labels)) == 50
    again = quality.labelled(docs.repartition(7), labels, max_labelled=20)
    assert [r["__id"] for r in rows] == [r["__id"] for r in again]
    assert quality.labelled(docs.limit(0), labels) == [] == quality.labelled(docs, labels.limit(0))
