import random

import numpy as np
import pandas as pd
import pytest

from panelkit.llm import superminhash as S
from panelkit.llm.graph import union_find

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    w = [x for x in (text or "").translate(LOW).replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root, least = union_find(edges), {}
    for k, (i, _) in enumerate(rows):
        g = root.get(k, k)
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return sorted(((i, len(sets[k]), least[root.get(k, k)]) for k, (i, _) in enumerate(rows)), key=str)


def made_rows(seed=1):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcde") for _ in range(4))
    rows, passage = [], [word() for _ in range(60)]
    for _ in range(25):
        base = [word() for _ in range(random.randint(4, 90))]
        rows.append(" ".join(base))
        for _ in range(random.randint(0, 5)):
            base = list(base)
            for _ in range(random.randint(0, 3)):
                base[random.randrange(len(base))] = word()
            rows.append(" ".join(base).upper() if random.random() < 0.3 else " \n".join(base))
    rows += [" ".join(passage + [word() for _ in range(random.randint(0, 40))]) for _ in range(14)]
    rows += ["one", "One", "one two", "one  two", "", None, "\n \t"]
    return list(enumerate(rows))


@pytest.mark.parametrize("width,percent,block", [(3, 85, 4096), (5, 80, 3)])
def test_groups_equal_brute_force(texts_frame, monkeypatch, width, percent, block):
    monkeypatch.setattr(S, "BLOCK_NODES", block)
    rows = made_rows(width)
    got = S.near_duplicates(texts_frame(rows), width=width, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def strays(seed, n=90):
    """Near copies of one text, many of which link with some others only."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8])):
            own[rng.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("block,hits", [(4096, S.CHUNK_HITS), (16, 40)])
def test_strays_of_a_large_group_find_their_links(texts_frame, monkeypatch, block, hits):
    monkeypatch.setattr(S, "BLOCK_NODES", block)
    monkeypatch.setattr(S, "CHUNK_HITS", hits)
    rows = strays(block)
    want = brute(rows, 3, 85)
    got = S.near_duplicates(texts_frame(rows), width=3, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert 1 < len({c for _, _, c in want}) < len(want)


@pytest.mark.parametrize("near", [True, False])
def test_blocks_compare_all_pairs_by_differences(near):
    rng = np.random.default_rng(3)
    centre = np.unique(rng.integers(1, 2**63, 100, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(centre, 92 if near else 25, replace=False), rng.integers(1, 2**63, 4, dtype=np.uint64)])) for _ in range(60)]
    sets += [np.append(s[:-1], np.uint64(2**63 + k)) for k, s in enumerate(sets[:20])]
    rows = pd.DataFrame({"a": 0, "b": 1, "side": [k % 2 for k in range(len(sets))], "node": [bytes([k]) for k in range(len(sets))], "label": [bytes([k]) for k in range(len(sets))],
                         "n_shingles": [len(s) for s in sets], "centre_size": len(centre), "added": [np.setdiff1d(s, centre).tobytes() for s in sets],
                         "removed": [np.flatnonzero(~np.isin(centre, s)).astype(np.uint32).tobytes() for s in sets]})
    got = union_find(S.compare_blocks(rows, 85).itertuples(index=False))
    links = [(bytes([i]), bytes([j])) for i in range(len(sets)) for j in range(len(sets)) if i % 2 < j % 2 and
             100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
    assert got == union_find(links) and (near or not links)


def test_null_and_repeated_ids_and_empty_table(texts_frame):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2
    rows = [(None, text), (7, text + " end"), (7, "other words in here"), (3, text), (3, text), (None, "x y z nothing like it at all"), (9, None),
            (None, "only rows without id say this one thing"), (None, "Only rows without id say this one thing")]
    got = S.near_duplicates(texts_frame(rows), width=3, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 85)
    assert sorted(r.n_shingles for r in got if r.doc_id is None and r.group is not None and r.component_id is None) == [6, 6, 6]
    assert len({bytes(r.group) for r in got if r.doc_id is None and r.component_id is None and r.group is not None}) == 2
    assert S.near_duplicates(texts_frame([])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    worst = 0
    for _ in range(30):
        pool = rng.integers(1, 2**63, 400, dtype=np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[60:360])
        s = S.signatures([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        worst = max(worst, abs((s[0] == s[1]).mean() - true))
    assert worst < 0.15


def test_signature_does_not_depend_on_company():
    sets = [np.unique(np.random.default_rng(k).integers(1, 2**63, 1 + 37 * k, dtype=np.uint64)) for k in range(8)]
    together = S.signatures(sets)
    for k, s in enumerate(sets):
        assert (S.signatures([s])[0] == together[k]).all()
        assert (together[k] != S.EMPTY).all()
