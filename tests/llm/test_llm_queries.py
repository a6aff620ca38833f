"""Registered queries against SQL or brute force over whole tables."""

import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

from compare import compare, connect
from conftest_llm import SF_DIR
from panelkit.llm import bpe, queries, sharding
from panelkit.llm.queries import ORACLES, QUERIES

SHA = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_sharding_matches_sql_with_a_small_limit(spark):
    small = lambda s, d: queries.op6_sharding(s, d, limit=20_000)
    assert compare(spark, connect(SF_DIR), "op6", small, queries.shard_sql(20_000), SF_DIR) is None
    assert sharding.SHARD_BYTES > 20_000


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_positive_unlabelled(spark, documents):
    import zlib

    got = QUERIES["op12_positive_unlabelled"](spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in documents)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    larger = "/root/testdata/sf0.01"  # 60 positives, as in the smallest table, say little
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    held = [(labels[r.doc_id], r.score, r.predicted) for r in QUERIES["op12_positive_unlabelled"](spark, larger).collect() if r.held_out and r.doc_id in labels]
    assert sum(q == p for q, _, p in held) >= 0.9 * len(held)
    good, bad = ([s for q, s, _ in held if q == k] for k in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_bpe(spark, documents):
    data = bpe.read_vocabulary(public_tokenizers.path(queries.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})
    want = Counter()
    for i, t in documents:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), SHA(",".join(map(str, ids))), SHA(t or "")] += 1
    assert Counter(tuple(r) for r in QUERIES["op1_byte_bpe"](spark, SF_DIR).collect()) == want


def test_pii(spark, documents):
    from test_pii import brute

    want = Counter()
    for i, t in documents:
        s = brute(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want[(i, *[sum(x[0] == k for x in s) for k in ("email", "ip", "card", "phone")], SHA(joined))] += 1
    got = QUERIES["op2_pii_anchors"](spark, SF_DIR).collect()
    assert Counter(tuple(r)[:6] for r in got) == want and sum(r.n_email for r in got) > 0
    assert all(r.spans.startswith("") and SHA(r.spans) == r.base_sha256 for r in got if "url" not in r.spans and "account" not in r.spans)


def test_secrets(spark, documents):
    from test_secrets import brute

    want = Counter()
    for i, t in documents:
        s = brute(t)
        want[(i, *[sum(x[1] == k for x in s) for k in ("assign", "access", "hex")], SHA(",".join(f"{k}:{a}:{b}" for a, k, b in s)))] += 1
    got = QUERIES["op7_secret_scan"](spark, SF_DIR).collect()
    assert Counter(tuple(r)[:5] for r in got) == want and sum(r.n_hex for r in got) > 0


def test_quality(spark, documents):
    from test_quality import brute

    got = QUERIES["op10_quality_rules"](spark, SF_DIR).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((i, *brute(t)) for i, t in documents)
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    judged = [(labels[r.doc_id], r.kept) for r in got if r.doc_id in labels and not r.base_failed]
    assert sum(k for q, k in judged if q == 1) >= 0.95 * sum(q == 1 for q, _ in judged)
    assert not any(r.kept and r.base_failed for r in got)


def test_lm(spark, documents):
    from test_lm import check

    check(QUERIES["op4_lm_scoring"](spark, SF_DIR).collect(), documents)


def test_mixing(spark):
    got = QUERIES["op5_mixing"](spark, SF_DIR).collect()
    rows = duckdb.sql(f"SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) FROM '{SF_DIR}/documents.parquet'").fetchall()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, n) for i, _, n in rows)
    source, taken, target = {i: s for i, s, _ in rows}, Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r["size"]
    assert all(abs(taken[s] - t) <= 128 + 0.01 * t for s, t in target.items())
