"""Connected components of an edge table, for identifiers of any ordered type."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialize

TASK_EDGES = 200_000


def union_find(pairs) -> dict:
    """Root (the smallest member) of every node of ``pairs``."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root.setdefault(a, a)
        root.setdefault(b, b)
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task as (node, root of the node's group here)."""
    kind, stars = None, {}
    for batch in batches:
        kind = batch.schema.field(0).type
        stars = union_find(chain(stars.items(), zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
    found = [(x, r) for x, r in stars.items() if x != r]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k in (0, 1)], names=["u", "v"])


def shuffled_again(key: str) -> Column:
    """The same key as an expression that no earlier partitioning covers.

    A join on it shuffles both sides plainly, so that Spark may split a hot key; a side partitioned by its own aggregate can't be split.
    """
    return F.element_at(F.array(F.col(key), F.col(key)), 2)


def _attach(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows`` (u, v) with m, the least neighbour of u."""
    return rows.join(least.select(shuffled_again("u").alias("lu"), "m").hint("merge"), F.col("u") == F.col("lu")).select("u", "v", "m")


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of all nodes with an edge; the component is its smallest node.

    Edges are dealt to tasks of at most ``TASK_EDGES``, each of which reduces its own to stars by union-find; one task's are
    the result. Else large-star and small-star steps alternate (each node's neighbours are tied to its least neighbour) until
    nothing changes; every step is joins and least values, never a list of neighbours.
    """
    kind = edges.schema[src].dataType.simpleString()
    pairs = edges.where(F.col(src) != F.col(dst)).select(F.col(src).alias("u"), F.col(dst).alias("v"))
    tasks = max(1, -(-pairs.count() // TASK_EDGES))
    now = materialize(pairs.repartition(tasks).mapInArrow(_local_stars, f"u {kind}, v {kind}"))
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() if tasks > 1 else seen
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _attach(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _attach(large, least).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = materialize(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct())
