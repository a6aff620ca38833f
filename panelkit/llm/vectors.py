"""Embedding near-duplicates: an exact metric range join on the angle between vectors.

Equal vectors make one node. Sampled pivots (a bounded number) part the nodes into cells by the nearest pivot. A node also
visits another cell only if the triangle inequality allows a partner there: its angle to that pivot is at most the cell's
radius plus the limit, and exceeds the angle to its own pivot by at most twice the limit. Of two cells one is chosen as the
place where their pairs meet. Cells are cut into blocks of bounded size; each unit of two blocks is compared by itself and
gives link counts and a spanning forest, never pairs.

Pruning depends on the data: on vectors without structure in many dimensions nearly all cells are within reach, and the
join then compares all nodes in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite parts link with nothing; vectors of
different lengths are never compared; repeated rows and equal vectors are links of each other; rows without id count as
partners but name no group; an empty table gives an empty table; only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.graph import components, shuffled_again, union_find
from panelkit.session import materialize

CELL_NODES, MOST_PIVOTS, BLOCK = 4096, 1024, 8192
EPS = 1e-9  # slack of angles for rounding
VISIT = "cell int, guest boolean, node binary, copies bigint, embedding array<double>"


def normalised(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def _by_length(batch: pa.RecordBatch):
    """Row numbers and normalised vectors of a batch, by length of the vectors."""
    vectors = batch.column("embedding")
    lengths = np.diff(vectors.offsets.to_numpy())
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), at, normalised(np.array([vectors[i].values.to_numpy() for i in at.tolist()]))


def nearest_pivot(nodes: DataFrame, pivots: dict[int, tuple[list[int], np.ndarray]]) -> DataFrame:
    """Adds cell and angle; ``pivots``: by length, cell numbers and vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, angle = np.full(len(batch), -1, np.int32), np.zeros(len(batch))
            for n, at, x in _by_length(batch):
                cells, own = pivots[n]
                angles = _angles(x, own)
                near = angles.argmin(axis=1)
                cell[at], angle[at] = np.array(cells, np.int32)[near], angles[np.arange(len(at)), near]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    return nodes.mapInArrow(run, "node binary, embedding array<double>, copies bigint, cell int, angle double")


def visits(placed: DataFrame, pivots: dict, radius: dict[int, float], limit: float) -> DataFrame:
    """One row for each node in its own cell, and one for each other cell where it may find a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.select(["node", "embedding", "copies", "cell"])
            home = batch.column("cell").to_numpy()
            rows, cells, guests = [np.arange(len(batch))], [home], [np.zeros(len(batch), bool)]
            for n, at, x in _by_length(batch):
                own, vectors = np.array(pivots[n][0]), pivots[n][1]
                angles = _angles(x, vectors)
                mine = home[at][:, None]
                reach = np.array([radius.get(c, -np.inf) for c in own.tolist()])
                near = (angles <= reach + limit + EPS) & (angles <= angles.min(axis=1, keepdims=True) + 2 * limit + EPS)
                there = np.where((own + mine) % 2 == 0, mine < own, mine > own)
                r, c = np.nonzero(near & there)
                rows.append(at[r])
                cells.append(own[c])
                guests.append(np.ones(len(r), bool))
            take = np.concatenate(rows)
            for k in range(0, len(take), 4096):
                part = slice(k, k + 4096)
                own = batch.take(pa.array(take[part]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)[part].astype(np.int32)), pa.array(np.concatenate(guests)[part]), own.column("node"),
                     own.column("copies"), own.column("embedding")], names=["cell", "guest", "node", "copies", "embedding"])

    return placed.mapInArrow(run, VISIT)


def _units(visiting: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows with the unit (cell, a, b) where two blocks meet and their side in it.

    ``sizes``: blocks of members and of guests by cell, at most one row per pivot, hence broadcast.
    """
    rows = visiting.join(F.broadcast(sizes), "cell")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.col("guest_blocks")).otherwise(F.col("member_blocks"))).cast("int")
    rows = rows.withColumn("own", own)
    unit = lambda a, b, side: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(side).alias("side"))
    o, members, guests = F.col("own"), F.col("member_blocks"), F.col("guest_blocks")
    among = F.transform(F.sequence(F.lit(0), members - 1), lambda k: unit(F.least(o, k), F.greatest(o, k), 0).withField("side", (o > k).cast("int")))
    with_guests = F.when(guests > 0, F.transform(F.sequence(F.lit(1), F.greatest(guests, F.lit(1))), lambda k: unit(o, -k, 0))).otherwise(F.array().cast("array<struct<a:int,b:int,side:int>>"))
    as_guest = F.transform(F.sequence(F.lit(0), members - 1), lambda k: unit(k, -1 - o, 1))
    places = F.when(F.col("guest"), as_guest).otherwise(F.concat(among, with_guests))
    return rows.select("cell", "node", "copies", "embedding", F.explode(places).alias("u")).select("cell", "u.*", "node", "copies", "embedding")


def compare_unit(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of each node met in this unit, and the root of its group here."""
    left, right = rows[rows.side == 0], rows[rows.side == 1]
    same = int(rows.a.iloc[0]) == int(rows.b.iloc[0])
    right = left if same else right
    links: dict[bytes, int] = {}
    edges = []
    if len(left) and len(right):
        lx, rx = normalised(np.stack(left.embedding.to_list())), normalised(np.stack(right.embedding.to_list()))
        ln, rn = left.node.to_numpy(), right.node.to_numpy()
        lc, rc = left.copies.to_numpy(), right.copies.to_numpy()
        for k in range(0, len(lx), 256):
            hit = lx[k:k + 256] @ rx.T >= cosine
            if same:
                hit &= np.arange(len(rx)) > np.arange(k, min(k + 256, len(lx)))[:, None]
            if not hit.any():
                continue
            for nodes, sums in ((ln[k:k + 256], hit @ rc), (rn, lc[k:k + 256] @ hit)):
                for i in np.flatnonzero(sums):
                    links[nodes[i]] = links.get(nodes[i], 0) + int(sums[i])
            a, b = np.nonzero(hit)
            edges += union_find(zip(ln[k + a], rn[b])).items()
    root = union_find(edges)
    return pd.DataFrame({"node": list(links), "links": list(links.values()), "root": [root[x] for x in links]})


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9,
                    most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    e = F.transform(F.col(embedding), lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    finite = F.forall(e, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    good = F.coalesce(finite & F.exists(e, lambda x: x != 0.0), F.lit(False))
    node = F.when(good, F.unhex(F.md5(e.cast("string").cast("binary"))))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), e.alias("embedding"), node.alias("node"))
    nodes = materialize(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id")))

    count = nodes.count()
    wanted = min(most_pivots, -(-count // CELL_NODES))
    sample = nodes.orderBy("node").limit(wanted).union(  # digests are random; one pivot at least of each length
        nodes.groupBy(F.size("embedding").alias("n")).agg(F.min_by(F.struct(*nodes.columns), "node").alias("s")).select("s.*"))
    chosen = {bytes(r.node): np.array(r.embedding) for r in sample.select("node", "embedding").collect()}
    pivots: dict[int, tuple[list[int], np.ndarray]] = {}
    for cell, vector in enumerate(chosen[k] for k in sorted(chosen)):
        cells, own = pivots.setdefault(len(vector), ([], []))
        cells.append(cell)
        own.append(vector)
    pivots = {n: (cells, normalised(np.stack(own))) for n, (cells, own) in pivots.items()}

    limit = float(np.arccos(cosine))
    placed = materialize(nearest_pivot(nodes.select("node", "embedding", "copies"), pivots))
    radius = {r.cell: r.radius for r in placed.groupBy("cell").agg(F.max("angle").alias("radius")).collect()}  # one row per pivot
    visiting = visits(placed, pivots, radius, limit)
    blocks = lambda guest: F.ceil(F.sum((F.col("guest") == guest).cast("long")) / BLOCK).cast("int")
    sizes = visiting.select("cell", "guest").groupBy("cell").agg(blocks(False).alias("member_blocks"), blocks(True).alias("guest_blocks"))
    units = _units(visiting, sizes.where("member_blocks > 0"))
    met = units.groupBy("cell", "a", "b").applyInPandas(lambda rows: compare_unit(rows, cosine), "node binary, links bigint, root binary")
    met = materialize(met)

    linked = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met, "node", "root")
    known = nodes.select("node", "copies", "least_id").join(linked, "node", "left").join(
        groups.select(F.col("node").alias("member"), "component"), F.col("node") == F.col("member"), "left")
    known = known.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"), "least_id")
    least = known.groupBy("component").agg(F.min("least_id").alias("component_id")).select(shuffled_again("component").alias("c2"), "component_id")
    named = materialize(known.join(least.hint("merge"), F.col("component") == F.col("c2")).select(F.col("node").alias("named"), "n_links", "component_id"))
    out = rows.select("vec_id", "node").join(named.hint("merge"), F.col("node") == F.col("named"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
