import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline as P
from conftest_llm import SF_DIR


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base, docs, out = str(tmp_path_factory.mktemp("stages")), spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in P.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out.append([r.asDict() for r in docs.collect()])
        if name != P.STAGES[-1][0]:
            assert docs.columns == P.COLUMNS
    return out


def test_quality_stage(stages):
    from test_quality import brute

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    kept = Counter(r["doc_id"] for r in stages[0])
    assert kept and all(kept[i] == 0 for i, t in docs if brute(t)[5])
    good = {i for i, q in duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall() if q == 1}
    clean = [i for i, t in docs if i in good and not brute(t)[5]]
    assert sum(kept[i] for i in clean) >= 0.95 * len(clean)


def test_one_of_each_group_stays(stages):
    from test_superminhash import brute

    rows = [(r["doc_id"], r["text"]) for r in stages[0]]
    assert sorted(r["doc_id"] for r in stages[1]) == sorted({c for _, _, c in brute(rows, 5, 80)})
    before = {r["doc_id"]: r for r in stages[0]}
    assert all(before[r["doc_id"]] == r for r in stages[1])


def test_secrets_are_hidden_and_the_rest_stays(stages):
    from test_secrets import brute

    after = {r["doc_id"]: r for r in stages[2]}
    assert len(stages[2]) == len(stages[1])
    for r in stages[1]:
        found = brute(r["text"])
        assert not found or not brute(after[r["doc_id"]]["text"])
        if not found:
            assert after[r["doc_id"]]["text"] == r["text"]
        assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])


def test_mix_takes_its_targets(stages):
    from test_mixing import brute_targets

    words = lambda t: re.findall("[^ \t-\r]+", t or "")
    sizes, taken = Counter(), Counter()
    for r in stages[2]:
        sizes[r["source"]] += len(words(r["text"]))
    for r in stages[3]:
        taken[r["source"]] += len(words(r["text"]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s, t in zip(order, brute_targets([sizes[s] for s in order])):
        assert abs(taken[s] - t) <= 128 + 0.01 * t
    assert max(Counter(r["doc_id"] for r in stages[3]).values()) == 2


def test_encoding_restores_all(stages):
    import hashlib

    assert all(r["restored"] for r in stages[4])
    digest = lambda r: (r["doc_id"], hashlib.md5(r["text"].encode()).hexdigest())
    assert Counter((r["doc_id"], r["text_md5"]) for r in stages[4]) == Counter(map(digest, stages[3]))


def test_edge_rows_pass_every_stage(spark, tmp_path):
    long = " ".join(f"word{k}" for k in range(60))
    rows = [(1, long, "en", "a", 1), (1, long, "en", "a", 1), (None, long + " more", None, None, None), (2, None, "en", "b", None), (3, "", "en", None, 0),
            (4, long.replace("word", "other") + " token=abcdefghijklmnop", "en", None, 5), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (frame, frame.limit(0)):
        for k, (name, stage) in enumerate(P.STAGES):
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), stage(spark, docs, str(tmp_path)).schema)
            if name == "near_duplicates" and docs.count():
                assert sorted((str(r.doc_id) for r in docs.collect())) == ["1", "4"]
        assert docs.where("not restored").count() == 0
