from collections import defaultdict

from panelkit.llm import sharding


def _run(frame, limit):
    return sharding.assign_shards(frame, limit=limit).select("doc_id", "text", "node", "shard.*").collect()


def _check(out, limit):
    sums, depth = defaultdict(lambda: [0, 0]), {}
    for r in out:
        assert r.row_bytes == len((r.text or "").encode())
        sums[r.name][0] += r.row_bytes
        sums[r.name][1] += 1
        depth[r.name] = r.depth
    for r in out:
        assert [r.shard_bytes, r.shard_rows] == sums[r.name]
        assert sums[r.name][0] <= limit or sums[r.name][1] == 1
    names = sorted(n for n in sums if "-" not in n)
    assert all(not b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # a bucket is only split where it has to be: its parent is too large
        if name:
            assert sum(sums[n][0] for n in sums if n.startswith(name[:-1])) > limit
    return sums


def _no_shard_column(texts_frame, rows):
    return texts_frame(rows).drop("shard")


def test_every_shard_fits(texts_frame):
    rows = [(i, "x" * (i % 97)) for i in range(1500)] + [(None, None), (1, ""), (2, "é" * 3_000)]
    out = _run(_no_shard_column(texts_frame, rows), 2_000)
    assert len(out) == len(rows) and len(_check(out, 2_000)) > 30
    assert set(_check(_run(_no_shard_column(texts_frame, rows), 1 << 30), 1 << 30)) == {""}


def test_deeper_than_one_histogram(texts_frame, monkeypatch):
    monkeypatch.setattr(sharding, "STEP", 3)
    rows = [(i, "x" * 50) for i in range(400)]
    assert len(_check(_run(_no_shard_column(texts_frame, rows), 400), 400)) > 40


def test_equal_rows_are_parted(texts_frame):
    rows = [(1, "same text")] * 40 + [(2, "other")]
    sums = _check(_run(_no_shard_column(texts_frame, rows), 90), 90)
    assert sorted(n for _, n in sums.values()) == [1, 10, 10, 10, 10]


def test_empty_table_and_files(texts_frame, spark, tmp_path):
    assert _run(_no_shard_column(texts_frame, []), 100) == []
    out = sharding.assign_shards(_no_shard_column(texts_frame, [(i, "x" * 30) for i in range(50)]), limit=200)
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 50
