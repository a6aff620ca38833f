import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, leaf int, shard int, pos string"


def brute(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        paths[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + v[h:]) if rebuild else tuple(v)
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = set()
    words = lambda p: len(p[-1][1].split()) if p else 0
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = sum(len(q) == len(p) + 1 for q in below)
        leaves = sum(not any(len(r) == len(q) + 1 and r[:-1] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * words(q) for q in below)
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(seed, convs=60):
    rng = random.Random(seed)
    say = lambda: rng.choice(["hi", "hi there", "ok", "a b c d", ""])
    rows = []
    for c in rng.sample(range(-30, 150), convs):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 1 else "user", say() if rng.random() < 0.9 else None))
    rows += [(1000 + k, t, "user", "same") for k in range(12) for t in range(5)]
    rows += [(None, 1, "user", "lost"), (2000, None, "user", "first"), (2000, 0, None, None), (2000, 1, "b", "tie"), (2000, 1, "a", "tie"), (2000, 1, "a", "tie"), (2000, 1, "a", "aa")]
    return rows


@pytest.fixture(scope="module")
def turns_frame(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "x", 2, 3, "p") for r in rows], SCHEMA)


def built(df, rebuild=True):
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4 if rebuild else F.lit(0)
    return T.rebuilt(T.number_turns(df), h, F.col("conv_id") - F.col("conv_id") % 20, most_heads=3)


def collected(df):
    return {tuple(r)[:8] for r in df.collect()}


@pytest.mark.parametrize("seed,shard_rows,block", [(1, T.SHARD_ROWS, T.BLOCK), (2, 10, 2)])
def test_equal_to_brute_force(turns_frame, monkeypatch, seed, shard_rows, block):
    monkeypatch.setattr(T, "BLOCK", block)
    rows = made(seed)
    got = T.prefix_trie(built(turns_frame(rows)), shard_rows=shard_rows)
    assert got.columns[:8] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collected(got) == brute(rows)


def test_long_conversations_and_one_that_extends_another(turns_frame):
    rows = [(c, t, "u", f"w {t}") for c, n in ((1, 2500), (2, 2500), (3, 1200), (4, 1201)) for t in range(n)] + [(4, 1300, "u", "other")]
    got = {(r.conv_id, r.depth): r for r in T.prefix_trie(built(turns_frame(rows), rebuild=False)).collect()}
    assert len(got) == 2501 + 1
    assert got[1, 0].n_convs == 4 and got[1, 0].n_leaves == 2 and got[1, 0].saved_tokens == 2 * (3 * 1200 + 2 + 1299)
    assert got[1, 2500].n_children == 0 and got[1, 1201].n_children == 2 and got[4, 1202].parent_conv_id == 1
    assert got[1, 1200].ends_sha256 == hashlib.sha256(b"3").hexdigest() and got[1, 2500].ends_sha256 == hashlib.sha256(b"1,2").hexdigest()


def test_empty_table(turns_frame):
    assert T.prefix_trie(built(turns_frame([]))).count() == 0


@pytest.mark.parametrize("n,bias", [(1, 0.5), (40, 0.5), (3000, 0.5), (20000, 0.52)])
def test_find_close_against_a_stack(n, bias):
    rng = random.Random(n)
    bits, open_ = [1], 1
    while len(bits) < n or open_ > 1:
        step = 1 if len(bits) < n and (open_ == 1 or rng.random() < bias) else -1
        bits.append(step)
        open_ += step
    bits.append(-1)
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b == 1:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.array(sorted(want))
    assert T.find_close(opens, np.cumsum(np.array(bits, np.int8), dtype=np.int32)).tolist() == [want[i] for i in opens.tolist()]
