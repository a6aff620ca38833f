import math
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np

from panelkit.llm import lm
from panelkit.session import checkpoint_dir

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [w.encode() for w in (text or "").translate(LOW).replace("\n", " ").replace("\t", " ").split(" ") if w] + [b""]


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def check(got, rows):
    counts = Counter(w for i, t in rows if not is_held_out(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), is_held_out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score <= 1e-9 and math.isfinite(r.score) for r in got)


def test_base_score_and_edge_rows(texts_frame):
    rows = [(i, f"The cat {i} sat\n on a MAT {'again ' * (i % 5)}") for i in range(60)] + [(None, "cat É é"), (4, None), (5, ""), (5, ""), (70, "unheard " * 9_000)]
    check(lm.score_documents(texts_frame(rows)).collect(), rows)
    assert lm.score_documents(texts_frame([])).count() == 0


def test_rare_words_are_joined(texts_frame, monkeypatch):
    monkeypatch.setattr(lm, "HOT_SHARE", 20)
    rows = [(i, f"common common word{i % 7} word{i}") for i in range(80)]
    check(lm.score_documents(texts_frame(rows)).collect(), rows)


def test_only_held_out_rows(texts_frame):
    held = [i for i in range(200) if is_held_out(i)][:3]
    check(lm.score_documents(texts_frame([(i, "a b") for i in held])).collect(), [(i, "a b") for i in held])


def test_filter_never_misses_and_rarely_lies():
    rng = np.random.default_rng(4)
    grams = np.unique(rng.integers(1, 2**63, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 40, len(grams))
    field = lm.build_segment(grams, counts, 1 << 30)
    model = lm.BloomCounts(field.tobytes(), np.array([0, len(field)]))
    got, true = model.levels(grams), np.floor(np.log2(counts)).astype(int) + 1
    assert (got >= true).all() and (got > true).mean() < 0.05
    assert (model.levels(np.unique(rng.integers(1, 2**63, 20_000, dtype=np.uint64))) > 0).mean() < 0.05


def test_small_filter_keeps_all_grams():
    grams = np.unique(np.random.default_rng(5).integers(1, 2**63, 5_000, dtype=np.uint64))
    field = lm.build_segment(grams, np.ones(len(grams), int), 8_000)
    assert len(field) <= 1_000
    assert (lm.BloomCounts(field.tobytes(), np.array([0, len(field)])).levels(grams) > 0).all()


def test_model_beats_base_on_unseen_texts(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    got = lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_false_probes_stay_rare_beyond_one_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 2_000)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 900)
    rows = [(i, " ".join(f"w{i * 31 + k * k}" for k in range(60))) for i in range(400)] + [(None, None), (7, "one two"), (7, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted((str(r.doc_id), r.score, r.base_score) for r in lm.score_documents(docs).collect())
    split = lm.score_documents(docs, most_bytes=2_000)  # 16,000 bits for more than 20,000 items
    assert sorted((str(r.doc_id), r.score, r.base_score) for r in split.collect()) == whole
    check(split.collect(), rows)

    train = docs.where("doc_id < 350").select("text")
    fields = lm.build_filter(lm.count_grams(train, 12), 12).collect()
    assert sum(len(r.field) for r in fields) > 10 * 2_000
    unseen = np.random.default_rng(8).integers(1, 2**48, 20_000, dtype=np.uint64)
    by_segment = {r.segment: r.field for r in fields}
    bounds = np.append(0, np.cumsum([len(by_segment.get(s, b"")) for s in range(12)]))
    model = lm.BloomCounts(b"".join(by_segment.get(s, b"") for s in range(12)), bounds)
    assert (model.levels(unseen) > 0).mean() < 0.03


def test_packing_gives_back_what_it_took():
    rng = np.random.default_rng(2)
    for n, segments, s in ((1, 1, 0), (1, 7, 3), (5_000, 7, 3), (400, 1, 0)):
        grams = np.unique(rng.integers(0, 2**48 // segments, n, dtype=np.uint64)) * np.uint64(segments) + np.uint64(s)
        data = lm.pack_sorted(grams, segments, s)
        assert (lm.unpack_sorted(data, segments, s) == grams).all() and len(data) <= 1 + 6 * len(grams)
    words = rng.integers(0, 2**48, 900, dtype=np.uint64)
    one = words[(rng.pareto(1.0, 50_000) * 5).astype(int) % 900]
    data = lm.encode_words(one)
    assert (lm.decode_words(data) == one).all() and len(data) < 2 * len(one)
    assert (lm.decode_words(lm.encode_words(one[:1])) == one[:1]).all()


def test_blocks_give_exact_counts_and_keep_little(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 9_000)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 20_000)
    monkeypatch.setattr(lm, "HOT_SHARE", 20)  # most words are rare, as in a large corpus
    rows = [(i, " ".join(f"word{(i * 131 + k * k) % 30_011}" if k % 3 else "The" for k in range(150))) for i in range(900)]
    odd = [(None, "cat É é"), (4, None), (5, ""), (5, ""), (70, "unheard " * 9_000), (71, " \x0b two\x0clines \r\n"), (72, "\x1cone\x1fword É"), (1_000, "a\x00b a\x00b")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").repartition(3).localCheckpoint()
    kept = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = {p for p in kept.rglob("*") if p.is_file()}
    got = lm.score_documents(docs, most_bytes=0)
    size = sum(p.stat().st_size for p in kept.rglob("*") if p.is_file() and p not in before)
    assert 0 < size < sum(len(t or "") for _, t in rows + odd)
    got = got.collect()
    whole = lm.score_documents(docs).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(r.doc_id), round(r.score, 6)) for r in whole)
    counts = Counter(w for i, t in rows + odd if not is_held_out(i) for w in (t or "").encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows + odd:
        own = (t or "").encode().lower().split() + [b""]
        want.append((str(i), is_held_out(i), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 5)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == sorted(want)


def test_blocks_keep_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", None), (None, "two"), ("a", "one two")], "doc_id string, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(lm.score_documents(docs, most_bytes=0).collect(), rows)
    assert lm.score_documents(docs.limit(0), most_bytes=0).count() == 0
    held = [(i, "a b") for i in range(200) if is_held_out(i)][:3]
    check(lm.score_documents(spark.createDataFrame(held, "doc_id long, text string"), most_bytes=-1).collect(), held)
