"""Quality rules: a decision list learned by sequential covering, applied as conditional expressions. DataFrame functions only.

Statistics of a text are computed inside its row, without a shuffle. The list is learned from the labelled documents with
the smallest hashes of their ids, at most ``max_labelled`` (a documented bound): rules are conjunctions of thresholds, grown
on two thirds of these rows by information gain, pruned on the rest, and kept while they are right often enough there.

Defined results: a null or empty text has no words and fails the base; texts without labels are only judged; labels that
are null, and documents without text, teach nothing; one class alone gives an empty list, which keeps all; repeated rows are
judged alike; an empty table gives an empty table; all other columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.chat import let

WHITE = "[ \\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MAX_LABELLED = 4_000
MIN_WORDS = 50
FEATURES = ("n_words", "mean_word", "symbols_per_word", "upper_per_char", "repeated_share", "dup_lines_per_line")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def repeated_words(hashes: Column) -> Column:
    """Words inside a three-word window that the text has more than once, from the windows' hashes in order."""
    def flagged(ordered):
        same = lambda s, i: (F.get(ordered, i - 1)["h"] == s["h"]) | (F.get(ordered, i + 1)["h"] == s["h"])
        at = F.transform(ordered, lambda s, i: F.when(F.coalesce(same(s, i), F.get(ordered, i + 1)["h"] == s["h"], F.get(ordered, i - 1)["h"] == s["h"],
                                                                 F.lit(False)), s["i"]))
        return F.array_sort(F.array_compact(at))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    spans = let(let(ordered, flagged), lambda at: F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))))
    count = F.aggregate(spans, F.lit(0), lambda a, x: a + x)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count).otherwise(0)


def _stats(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))

    def counted(w):
        n = F.size(w)
        hashes = F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        let(hashes, repeated_words).cast("long").alias("n_repeat_words"))

    full = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^ \\x09-\\x0D]"))
    lines = let(full, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return F.struct(let(words(text), counted).alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_upper"))


def text_stats(text: Column) -> Column:
    """Struct of a text's counts."""
    return let(_stats(text), lambda s: F.struct(
        s["w"]["n_words"].alias("n_words"), s["w"]["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"),
        s["l"]["dup"].alias("n_dup_lines"), s["w"]["n_repeat_words"].alias("n_repeat_words"), s["n_upper"].alias("n_upper"), s["l"]["n"].alias("n_lines")))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    at_least_one = lambda c: F.greatest(c, F.lit(1))
    n, chars = at_least_one(s["n_words"]), at_least_one(s["word_chars"])
    return {"n_words": s["n_words"].cast("double"), "mean_word": s["word_chars"] / n, "symbols_per_word": s["n_symbols"] / n,
            "upper_per_char": s["n_upper"] / chars, "repeated_share": s["n_repeat_words"] / n, "dup_lines_per_line": s["n_dup_lines"] / at_least_one(s["n_lines"])}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.threshold) == self.above

    def column(self, f: dict[str, Column]) -> Column:
        return f[self.feature] > self.threshold if self.above else f[self.feature] <= self.threshold


Conjunction = tuple[Test, ...]


def _covered(rule: Conjunction, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(t.holds(r) for t in rule)]


def _counts(rows: list[dict]) -> tuple[int, int]:
    bad = sum(r["bad"] for r in rows)
    return bad, len(rows) - bad


def _thresholds(values: list[float], most: int = 24) -> list[float]:
    distinct = sorted(set(values))
    middles = [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
    step = max(1, len(middles) // most)
    return middles[::step]


def _grow(rows: list[dict], most: int, barred: set[str] = frozenset()) -> Conjunction:
    """A conjunction grown by information gain; its first test uses none of the ``barred`` features."""
    rule: Conjunction = ()
    bad, good = _counts(rows)
    while good and len(rule) < most:
        before, best = math.log2(bad / (bad + good)), (1e-9, None)
        for f in FEATURES:
            if not rule and f in barred:
                continue
            for threshold in _thresholds([r[f] for r in rows]):
                over = [r["bad"] for r in rows if r[f] > threshold]
                for above, b, n in ((True, sum(over), len(over)), (False, bad - sum(over), len(rows) - len(over))):
                    gain = b * (math.log2(b / n) - before) if b else 0.0
                    if gain > best[0]:
                        best = (gain, Test(f, above, threshold))
        if best[1] is None:
            break
        rule, rows = (*rule, best[1]), _covered((best[1],), rows)
        bad, good = _counts(rows)
    return rule


def _worth(rule: Conjunction, rows: list[dict]) -> float:
    bad, good = _counts(_covered(rule, rows))
    return (bad - good) / (bad + good) if bad + good else -1.0


def _prune(rule: Conjunction, rows: list[dict]) -> Conjunction:
    """The shortest of the best prefixes."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(r, rows), -len(r)), default=())


def learn_list(rows: list[dict], least_right: float = 0.9, most_rules: int = 8, most_tests: int = 3) -> list[Conjunction]:
    """Ordered rules that reject. ``rows``: the features by name and ``bad``; bounded by the caller."""
    held, grown = rows[::3], [r for i, r in enumerate(rows) if i % 3]
    out: list[Conjunction] = []
    barred: set[str] = set()  # features whose rules don't hold on the rows kept back
    while len(out) < most_rules and all(_counts(grown)):
        rule = _prune(_grow(grown, most_tests, barred), held)
        bad, good = _counts(_covered(rule, held))
        if not rule:
            break
        if bad < 3 or bad < least_right * (bad + good):
            barred.add(rule[0].feature)
            continue
        out.append(rule)
        grown = [r for r in grown if not all(t.holds(r) for t in rule)]
        held = [r for r in held if not all(t.holds(r) for t in rule)]
    return out


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
             max_labelled: int = MAX_LABELLED) -> list[dict]:
    """Features and label of at most ``max_labelled`` documents, those with the smallest hash of their id."""
    known = labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.min(quality).alias("__q"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)  # bounded, hence broadcast
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    joined = texts.join(F.broadcast(chosen), "__id").select("__id", "__q", text_stats(F.col("__text")).alias("s"))
    one = joined.groupBy("__id", "__q").agg(F.first("s").alias("s"))
    rows = one.select("__id", (F.col("__q") == 0).cast("int").alias("bad"), *[c.alias(n) for n, c in features(F.col("s")).items()])
    return [r.asDict() for r in rows.orderBy(F.xxhash64("__id"), "__id").collect()]


def verdict(rules: list[Conjunction], stats: Column) -> Column:
    """False where a rule of the list rejects, else true."""
    out, f = F, features(stats)
    for rule in rules:
        out = out.when(reduce(lambda a, b: a & b, [t.column(f) for t in rule]), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def judge(docs: DataFrame, rules: list[Conjunction], text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the struct ``quality_stats`` (counts, base_failed, kept); it replaces a column so named."""
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "quality_stats"]
    with_stats = docs.select(*own, text_stats(F.col(text)).alias("__stats"))
    failed = F.coalesce(base_failed(F.col("__stats")), F.lit(True))
    kept = ~failed & verdict(rules, F.col("__stats"))
    return with_stats.select(*own, F.struct("__stats.*", failed.alias("base_failed"), kept.alias("kept")).alias("quality_stats"))
