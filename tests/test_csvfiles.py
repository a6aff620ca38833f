import random

import pytest

from panelkit.sources import csvfiles as V
from panelkit.sources import tables as S


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def made(seed, n):
    rng = random.Random(seed)
    cell = lambda: rng.choice(["x", "a,b", 'say ""hi""', "line\nbreak", "\r\n", "ñandú", "", "long " * rng.randint(0, 90), "tail\n" * rng.randint(0, 300)])
    return [(str(i), cell(), cell()) for i in range(n)]


def text(rows):
    return "id,a,b\n" + "".join(f'{i},"{a}","{b}"\n' for i, a, b in rows)


def plain(rows):
    return {(i, a.replace('""', '"'), b.replace('""', '"')) for i, a, b in rows}


def test_one_file_in_many_tasks_with_quoted_breaks(spark, tmp_path, small_splits):
    rows = made(1, 300)
    (tmp_path / "big.csv").write_bytes(text(rows).encode())
    got = V.read_csv(spark, str(tmp_path / "big.csv"))
    found = V.splits(spark, str(tmp_path / "big.csv"), ["UTF-8", "ISO-8859-1"]).collect()
    assert len(found) > 50 and any(r.inside for r in found) and not all(r.inside for r in found)
    assert got.rdd.getNumPartitions() > 8
    data = [(r.id, r.a or "", r.b or "") for r in got.collect()]
    assert len(data) == 300 and set(data) == plain(rows)


def test_encodings_are_judged_by_bytes(spark, tmp_path, small_splits):
    (tmp_path / "utf.csv").write_bytes("id,a,b\n1,pe�a,ñ\n".encode())
    (tmp_path / "latin.csv").write_bytes(("id,a,b\n" + "".join(f"{i},peña,año\n" for i in range(2, 400))).encode("latin-1"))
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbfid,a,b\n1000,x,\xc3\xb1")
    (tmp_path / "none.csv").write_bytes(b"")
    got = {r.id: (r.a, r.b) for r in V.read_csv(spark, str(tmp_path)).collect()}
    assert got == {"1": ("pe�a", "ñ"), "1000": ("x", "ñ"), **{str(i): ("peña", "año") for i in range(2, 400)}}
    other = V.read_csv(spark, str(tmp_path / "latin.csv"), ["US-ASCII", "UTF-8", "windows-1252"]).first()
    assert other.a == "peña"


def test_bad_rows_and_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception):
        V.read_csv(spark, str(tmp_path / "a.csv")).collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.csv").write_text("a,b\n1,2\n\n3,4\n")
    assert sorted(map(tuple, V.read_csv(spark, str(tmp_path / "d")).collect())) == [("1", "2"), ("3", "4")]
    (tmp_path / "d" / "y.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header differs"):
        V.read_csv(spark, str(tmp_path / "d")).collect()
    (tmp_path / "empty.csv").write_text("")
    assert V.read_csv(spark, str(tmp_path / "empty.csv")).columns == []
    (tmp_path / "same.csv").write_text("a,A,\n1,2,3\n")
    assert V.read_csv(spark, str(tmp_path / "same.csv")).columns == ["a0", "A1", "_c2"]


def test_types_are_the_least_that_hold_all_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,f,m,b,t,e,big,ciclo\n1,1.5,1,true,x,,1,2019\n-2,1e3,2.5,False,2,,99999999999999999999,x\nNA,nan,,,3,,2,2020\n")
    df = S.read_facts(spark, str(tmp_path / "t.csv"), infer=True)
    assert dict(df.dtypes) == {"n": "bigint", "f": "double", "m": "double", "b": "boolean", "t": "string", "e": "string", "big": "double", "ciclo": "int"}
    assert [tuple(r)[:4] for r in df.collect()] == [(1, 1.5, 1.0, True), (-2, 1000.0, 2.5, False), (None, None, None, None)]


def test_slices_are_dealt_by_digest(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a b' WHEN id % 3 = 1 THEN 'A-b' END AS k")
    for name in ("x", "y"):
        S.write_slices(df, "k", str(tmp_path / name), fmt="parquet", rows_per_file=500)
    files = lambda name: {p.parent.name: len(list(p.parent.glob("*.parquet"))) for p in (tmp_path / name).glob("*/*.parquet")}
    assert files("x") == files("y") and len(files("x")) == 3 and all(1 <= n <= 4 for n in files("x").values())
    back = spark.read.parquet(str(tmp_path / "x"))
    assert back.count() == 5000 and back.where("k IS NULL").count() == 1666
