import random

import pytest

from panelkit.llm import graph
from panelkit.llm.graph import components, union_find


@pytest.mark.parametrize("edges_a_task", [1_000_000, 60])
def test_components_equal_union_find(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(graph, "TASK_EDGES", edges_a_task)
    random.seed(2)
    edges = [(random.randint(0, 900), random.randint(0, 900)) for _ in range(500)] + [(k, k + 1) for k in range(1000, 1200)] + [(2000, k) for k in range(2001, 2300)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long").repartition(7)).collect()}
    want = union_find([e for e in edges if e[0] != e[1]])
    assert got == want


def test_no_edges_and_binary_names(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0
    got = components(spark.createDataFrame([(b"b", b"a"), (b"b", b"c")], "src binary, dst binary")).collect()
    assert sorted((bytes(r.node), bytes(r.component)) for r in got) == [(b"a", b"a"), (b"b", b"a"), (b"c", b"a")]
