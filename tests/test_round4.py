"""Findings of the fourth round."""

import itertools
import math
from collections import Counter

import duckdb
import numpy as np
from compare import compare

from panelkit.operators import clustering as C
from panelkit.plans import ORACLES, QUERIES


def _entropy(labels):
    return -sum(v / len(labels) * math.log(v / len(labels)) for v in Counter(labels).values())


def _adjusted_mutual(t, c):
    """From all rearrangements of the rows, without a formula of the expected value."""
    mutual = lambda u: _entropy(u) + _entropy(c) - _entropy(list(zip(u, c)))
    expected = np.mean([mutual(u) for u in itertools.permutations(t)])
    return (mutual(t) - expected) / ((_entropy(t) + _entropy(c)) / 2 - expected)


def test_adjusted_mutual_information_against_all_rearrangements(spark, monkeypatch):
    t, c = list("aabbbcc"), [0, 0, 0, 1, 1, 2, 1]
    rows = [*zip(t, c), (None, 1), ("a", None), (None, None)]  # rows without a label are left out
    df = spark.createDataFrame(rows, "t string, c int")
    for block in (256, 1):
        monkeypatch.setattr(C, "SIZE_BLOCK", block)
        assert np.isclose(C.adjusted_mutual_info(df, "t", "c").first()[0], _adjusted_mutual(t, c), rtol=1e-9)


def test_summary_of_own_rows_matches_sql(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT i AS l_orderkey, 1 + (i * 7 % 50)::DOUBLE AS l_quantity, 1000 + (i * i * 37 % 90001)::DOUBLE AS l_extendedprice, (i % 11) / 100::DOUBLE AS l_discount,
        ['A', 'N', 'R'][1 + i % 3] AS l_returnflag, ['F', 'O'][1 + i // 3 % 2] AS l_linestatus, TIMESTAMP '1997-01-03' + to_months((i // 18)::INT) AS l_shipdate
      FROM range(18 * 56) t(i)) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)""")  # 56 months, three rows a group
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet')")
    assert compare(spark, con, "cluster_summary", QUERIES["cluster_summary"], ORACLES["cluster_summary"], str(tmp_path)) is None


def test_summary_gives_the_measures_of_each_part(spark):
    t, c = list("aabbbcc"), [0, 0, 0, 1, 1, 2, 1]
    x = [[float(4 * k + i % 2), float(i)] for i, k in enumerate(c)]
    df = spark.createDataFrame(list(zip(range(7), x, c, t)), "id long, x array<double>, cluster int, t string")
    alike = df.withColumn("t", df.cluster)
    out = {(r.part, r.metric): r.value for r in C.cluster_summary({"train": df, "test": alike}, "t").collect()}
    joint = _entropy(t) + _entropy(c) - _entropy(list(zip(t, c)))
    assert len(out) == 12
    assert np.isclose(out["train", "adjusted_mutual_info"], _adjusted_mutual(t, c), rtol=1e-9)
    assert np.isclose(out["train", "v_measure"], 2 * joint / (_entropy(t) + _entropy(c)), rtol=1e-9)
    assert all(np.isclose(out["test", m], 1) for m in ("adjusted_rand", "adjusted_mutual_info", "v_measure"))
    assert all(np.isclose(out["train", m], out["test", m], rtol=1e-12) for m in ("silhouette", "calinski_harabasz", "davies_bouldin"))
