"""Exact nearest neighbours and exact pairwise sums, in blocks of bounded size.

Training rows are parted into cells around sampled pivots. Of each cell the least and greatest distance of its rows to its own
pivot and to some reference pivots far from each other are kept, so that the triangle inequality bounds a query's distance to
the cell from several sides. A query visits cells best first, in a few rounds: each round lets it visit the next cells in the
order of their lower bounds, and its k-th best distance so far shrinks the bound for the next round, until no cell lies
within it. On rows without any clusters few cells can be left out. Cells are cut into blocks by a hash of the row key; two
blocks meet in one task as two small matrices, and what leaves a task is k rows per query, never all pairs. Rows of one key
share a block. Euclidean distances come from a matrix product first, with a bound of its error; only pairs that can be among the
nearest are measured one by one.

A row with a null, NaN or infinite part (or without parts) has no distance to any row: as training row it is nobody's
neighbour, as query it has no neighbours; other rows are not affected by it. A null level counts as a level that no column of
the 0/1 coding stands for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.operators.metrics import roc_auc
from panelkit.operators.preprocess import Preprocessor
from panelkit.session import materialize

BLOCK_ROWS = 16_384
MOST_PIVOTS = 1_024
REFERENCES = 24
FIRST_CELLS, MORE_CELLS = 1, 4  # cells a query visits in the first round, and the growth of that number from round to round
MATRIX_CELLS = 4_000_000
PRODUCT_CELLS = 2_000_000  # of a matrix product
MOST_SQUARE = 1e300
MANY = 16  # times k: candidates per query beyond which the k-th best of a block is looked for
SLACK = 1e-9
MOST_TASKS = 2_000


def _block_count(n: int, rows: int) -> int:
    return max(1, math.ceil(n / rows))


def _blocked(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Own block number by key hash, and one copy of the row per block of the other side."""
    copies = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"))
    return copies.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _own_names(df: DataFrame) -> DataFrame:
    """Columns under a ``q_`` prefix, so that a table can meet itself."""
    return df.select(*[F.col(c).alias(f"q_{c}") for c in df.columns])


def cogroups(t: DataFrame, q: DataFrame, on: Sequence[str], q_on: Sequence[str], pairs: int):
    """Blocks that meet. The bytes of a pair do not tell its work, so that tasks are not merged by bytes: about one pair each, while they are few."""
    tasks = min(MOST_TASKS, max(2 * pairs, t.sparkSession.sparkContext.defaultParallelism))
    return t.repartition(tasks, *on).groupBy(*on).cogroup(q.repartition(tasks, *q_on).groupBy(*q_on))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in col])


def _codes(train: pd.Series, query: pd.Series) -> tuple[np.ndarray, np.ndarray] | None:
    width = len(train.iloc[0])
    if not width:
        return None
    both = np.array([list(v) for v in train] + [list(v) for v in query], dtype=object)
    out = np.column_stack([pd.factorize(both[:, j])[0] for j in range(width)])  # null becomes -1
    return out[: len(train)], out[len(train):]


def distances(x: np.ndarray, y: np.ndarray, p: int, codes=None) -> np.ndarray:
    """Distances of every row of ``x`` to every row of ``y``; unequal levels count as in 0/1 coding."""
    diff = np.abs(x[:, None, :] - y[None, :, :])
    total = diff.sum(axis=2) if p == 1 else (diff * diff).sum(axis=2)
    if codes is not None:
        cx, cy = codes
        for j in range(cx.shape[1]):
            unknown = (cx[:, j] < 0)[:, None] | (cy[:, j] < 0)[None, :]
            total += np.where(cx[:, j][:, None] == cy[:, j][None, :], 0, np.where(unknown, 1, 2))
    return total if p == 1 else np.sqrt(total)


def products(y: np.ndarray):
    """Function that gives the squared Euclidean distances of some rows to ``y`` by one matrix product, and for each of these rows
    how far they can be off.

    Both sides are moved to the middle of ``y`` first, so that lengths, and with them the error, stay near the distances. The
    error is infinite where numbers are too large to be squared.
    """
    with np.errstate(all="ignore"):
        middle = y.mean(axis=0)
        moved = y - middle
        yy = np.einsum("ij,ij->i", moved, moved)
        other = np.column_stack([-2 * moved, np.ones(len(y)), yy]).T
        most = yy.max(initial=0.0) + y.shape[1] * np.square(np.abs(middle).max(initial=0.0))

    def squares(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(all="ignore"):
            x = x - middle
            xx = np.einsum("ij,ij->i", x, x)
            # A sum of n products errs by n rounding steps of its terms' sizes at most; moving the rows adds some of the middle's size.
            off = 8 * (x.shape[1] + 4) * np.finfo(float).eps * (xx + most) + np.finfo(float).tiny
            return np.column_stack([x, xx, np.ones(len(x))]) @ other, np.where(xx + most < MOST_SQUARE, off, np.inf)

    return squares


def pairs_where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def pair_distances(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Euclidean distances of single pairs, bit by bit those of ``distances``."""
    out, step = np.empty(len(rows)), max(1, MATRIX_CELLS // max(1, x.shape[1]))
    for a in range(0, len(rows), step):
        diff = x[rows[a:a + step]] - y[cols[a:a + step]]
        out[a:a + step] = np.sqrt((diff * diff).sum(axis=1))
    return out


def _tiles(n_query: int, n_train: int, width: int, cells: int = MATRIX_CELLS):
    step = max(1, cells // max(1, n_train * width))
    return ((i, min(i + step, n_query)) for i in range(0, n_query, step))


def _measurable(c: str) -> Column:
    """Whether an array of numbers has parts, and only finite ones."""
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)), F.lit(False))


def knn_neighbors(train: DataFrame, query: DataFrame, k: int, ps: Sequence[int] = (2,), key: str = "id",
                  label: str = "label", by: Sequence[str] = (), exclude_self: bool = False,
                  block_rows: int = BLOCK_ROWS, tally: list | None = None) -> DataFrame:
    """The ``k`` nearest training rows of every query, for every metric in ``ps``, ordered by distance then key.

    Both sides carry ``key``, ``x`` (array of numbers) and optionally ``levels`` (array of categories); train also
    carries ``label``. With ``by`` the search stays inside equal groups. ``exclude_self`` skips the row's own key. Rows without
    a distance are left out, see the module. ``tally`` gets the number of cells visited in each round.
    """
    by = list(by)
    has_levels = "levels" in train.columns and "levels" in query.columns
    levels = F.col("levels") if has_levels else F.array().cast("array<string>")

    def side(df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(*by, F.col(key).alias("id"), F.col("x").cast("array<double>").alias("x"), levels.alias("levels"), *extra).where(_measurable("x"))

    left, right = side(train, F.col(label).alias("label")), side(query)
    types = {**{f.name: f.dataType.simpleString() for f in query.schema}, **{f.name: f.dataType.simpleString() for f in train.schema}}
    schema = ", ".join([f"`{b}` {types[b]}" for b in by] + [
        "p int", f"id {types[key]}", f"neighbor {types[key]}", "distance double", f"label {types[label]}"])

    def nearest(t: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if t.empty or q.empty:
            return pd.DataFrame(columns=[*by, "p", "id", "neighbor", "distance", "label"])
        xt, xq = _matrix(t["x"]), _matrix(q["q_x"])
        codes = _codes(t["levels"], q["q_levels"])
        ids, qids, labels = t["id"].to_numpy(), q["q_id"].to_numpy(), t["label"].to_numpy()
        place = pd.factorize(ids, sort=True)[0]
        parts, p = [], int(t["p"].iloc[0])
        known = q["q_bound"].to_numpy() if "q_bound" in q else np.full(len(q), np.inf)
        squares = products(xt) if p == 2 and codes is None else None
        few = min(k, len(t)) - 1
        for a, z in _tiles(len(q), len(t), 1, PRODUCT_CELLS) if squares else _tiles(len(q), len(t), xt.shape[1]):
            limit, swift = known[a:z] + SLACK * (1 + known[a:z]), False  # no farther row is among the nearest
            if squares:  # the product finds the few candidates, which are then measured as all pairs would be
                d, off = squares(xq[a:z])
                swift = bool(np.isfinite(off).all())
            if swift:
                limit = np.square(limit)
            else:
                d, off = np.concatenate([distances(xq[i:j], xt, p, (codes[1][i:j], codes[0]) if codes else None)
                                         for i, j in ((a + i, a + j) for i, j in _tiles(z - a, len(t), xt.shape[1]))]), np.zeros(z - a)
            near = d <= (limit + 2 * off)[:, None]
            if np.count_nonzero(near) > MANY * k * (z - a):
                if exclude_self:
                    d[qids[a:z, None] == ids[None, :]] = np.inf
                near = d <= (np.minimum(limit, np.partition(d, few, axis=1)[:, few]) + 2 * off)[:, None]
            rows, cols = pairs_where(near)
            exact = pair_distances(xq[a:z], xt, rows, cols) if swift else d[rows, cols]
            other = np.isfinite(exact) & ((qids[a:z][rows] != ids[cols]) if exclude_self else True)
            rows, cols, exact = rows[other], cols[other], exact[other]
            order = np.lexsort((place[cols], exact, rows))
            rows, cols, exact = rows[order], cols[order], exact[order]
            first = np.searchsorted(rows, rows, side="left")
            keep = np.arange(len(rows)) - first < k
            rows, cols = rows[keep], cols[keep]
            parts.append(pd.DataFrame({"p": p, "id": qids[a:z][rows], "neighbor": ids[cols],
                                       "distance": exact[keep], "label": labels[cols]}))
        out = pd.concat(parts)
        for b in by:
            out[b] = t[b].iloc[0]
        return out[[*by, "p", "id", "neighbor", "distance", "label"]]

    def meet(t: DataFrame, q: DataFrame, group: list[str], pairs: int) -> DataFrame:
        return cogroups(t, _own_names(q), group, [f"q_{g}" for g in group], pairs).applyInPandas(nearest, schema)

    def ranked(found: DataFrame) -> DataFrame:
        order = W.partitionBy(*by, "p", "id").orderBy("distance", "neighbor")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    rows, asking = left.count(), right.count()
    if rows > block_rows:
        return _best_first(left, right, rows, asking, k, k + exclude_self, ps, by, block_rows, meet, ranked, tally)
    blocks = _block_count(asking, block_rows)
    left = left.withColumn("p", F.explode(F.array(*[F.lit(p) for p in ps])))
    right = right.withColumn("p", F.explode(F.array(*[F.lit(p) for p in ps])))
    left, right = _blocked(left, "id", "__tb", 1, "__qb", blocks), _blocked(right, "id", "__qb", blocks, "__tb", 1)
    return ranked(meet(left, right, [*by, "p", "__tb", "__qb"], len(ps) * blocks))


def _pivot_distances(frame: pd.DataFrame, px: np.ndarray, plevels: pd.Series, p: int) -> np.ndarray:
    x = _matrix(frame["x"])
    codes = _codes(plevels, frame["levels"])
    return np.concatenate([distances(x[a:z], px, p, (codes[1][a:z], codes[0]) if codes else None)
                           for a, z in _tiles(len(x), len(px), px.shape[1])])


def _far_apart(d: np.ndarray, wanted: int) -> list[int]:
    """Rows of a distance matrix that lie far from each other: each next one is the farthest from those taken."""
    taken = [0]
    near = d[0].copy()
    while len(taken) < min(wanted, len(d)):
        taken.append(int(near.argmax()))
        near = np.minimum(near, d[taken[-1]])
    return sorted(set(taken))


def _equal(left: str, right: str, names: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in names:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def _joined(rows: DataFrame, table: DataFrame, names: Sequence[str], how: str = "inner", columns: Sequence[str] = ()) -> DataFrame:
    """``rows`` with further columns of ``table``; null keys are equal."""
    return rows.alias("l").join(table.alias("r"), _equal("l", "r", names), how).select("l.*", *[f"r.{c}" for c in columns])


def _best_first(left: DataFrame, right: DataFrame, rows: int, asking: int, k: int, enough: int, ps: Sequence[int], by: list[str],
                block_rows: int, meet, ranked, tally: list | None) -> DataFrame:
    """Rounds of visits: the next cells of every query by lower bound, as long as one lies within its k-th best distance."""
    sample = left.orderBy(F.xxhash64("id"), "id").limit(min(MOST_PIVOTS, _block_count(rows, block_rows))).select("x", "levels").toPandas()
    px, plevels = _matrix(sample["x"]), sample["levels"]
    refs = {p: _far_apart(_pivot_distances(sample, px, plevels, p), REFERENCES) for p in ps}
    width = max(map(len, refs.values()))
    group = [*by, "p"]

    def place(frames):
        for frame in frames:
            for p in ps if len(frame) else ():
                d = _pivot_distances(frame, px, plevels, p)
                out = frame.assign(p=p, __cell=d.argmin(axis=1), __refs=list(np.column_stack([d.min(axis=1), d[:, refs[p]]])))
                yield out[np.isfinite(d.min(axis=1))]

    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)
    placed = materialize(left.mapInPandas(place, f"{declared}, p int, __cell int, __refs array<double>"))
    bound = lambda fn: F.array(*[fn(F.try_element_at("__refs", F.lit(j + 1))) for j in range(width + 1)])
    cells = materialize(placed.groupBy(*group, "__cell").agg(F.count(F.lit(1)).alias("n"), bound(F.min).alias("low"), bound(F.max).alias("high")))

    blocks = _block_count(asking, block_rows)
    queries = right.withColumn("p", F.explode(F.array(*[F.lit(p) for p in ps]))).withColumn("__qb", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    near = cells.withColumn("__qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))  # bounds of at most MOST_PIVOTS cells to each block of queries
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema if f.name != "__qb")

    def order(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        names = [x for x in q.columns if x != "__qb"]
        if q.empty or c.empty:
            return pd.DataFrame(columns=[*names, "cells", "lows", "bound"])
        p = int(q["p"].iloc[0])
        d = _pivot_distances(q, px, plevels, p)
        cell, n = c["__cell"].to_numpy(), c["n"].to_numpy()
        low, high = (np.array([list(v)[:len(refs[p]) + 1] for v in c[s]], float) for s in ("low", "high"))
        least, most = np.maximum(d[:, cell] - high[:, 0], low[:, 0] - d[:, cell]), d[:, cell] + high[:, 0]
        for j, ref in enumerate(refs[p], 1):
            own = d[:, [ref]]
            least = np.maximum(least, np.maximum(own - high[:, j], low[:, j] - own))
            most = np.minimum(most, own + high[:, j])
        far = np.argsort(most, axis=1)
        at = (np.cumsum(n[far], axis=1) < enough).sum(axis=1)
        first = np.where(at < len(cell), np.take_along_axis(most, far, 1)[np.arange(len(q)), np.minimum(at, len(cell) - 1)], np.inf)
        least = np.maximum(least, 0.0)
        by_low = np.argsort(least, axis=1, kind="stable")
        lows = np.take_along_axis(least, by_low, 1)
        within = (lows <= (first + SLACK * (1 + np.abs(first)))[:, None]).sum(axis=1)
        return q[names].assign(cells=[cell[o[:w]].tolist() for o, w in zip(by_low, within)], lows=[o[:w].tolist() for o, w in zip(lows, within)], bound=first)

    keys = [*group, "__qb"]
    todo = materialize(queries.groupBy(*keys).cogroup(near.groupBy(*keys)).applyInPandas(order, f"{types}, cells array<int>, lows array<double>, bound double"))
    best, take, on = None, FIRST_CELLS, [*group, "__cell"]
    inside = lambda v: v <= F.col("bound") + SLACK * (1 + F.abs("bound"))
    while True:
        zipped = F.arrays_zip(F.slice("cells", 1, take).alias("cell"), F.slice("lows", 1, take).alias("low"))
        visits = materialize(todo.select(*right.columns, "p", F.explode(F.filter(F.transform(zipped, lambda z: F.struct(z["cell"].alias("cell"), z["low"].alias("low"))),
                                                                               lambda z: inside(z["low"]))).alias("v"), "bound").select(*right.columns, "p", "bound", F.col("v.cell").alias("__cell")))
        if tally is not None:
            tally.append(visits.count())
        met = _joined(visits.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("__nq")), cells.withColumn(
            "__nt", F.ceil(F.col("n") / block_rows).cast("int")), on, columns=["__nt"])
        block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        own = _joined(placed.drop("__refs"), met, on, columns=["__nt", "__nq"]).withColumn("__tb", block("__nt")).withColumn("__qb", every("__nq"))
        ask = _joined(visits, met, on, columns=["__nt", "__nq"]).withColumn("__qb", block("__nq")).withColumn("__tb", every("__nt"))
        pairs = met.agg(F.coalesce(F.sum(F.col("__nt").cast("long") * F.col("__nq")), F.lit(0))).first()[0]
        found = meet(own.drop("__nt", "__nq"), ask.drop("__nt", "__nq"), [*on, "__tb", "__qb"], pairs)
        best = materialize(ranked(found if best is None else best.drop("rank").unionByName(found)))
        reached = best.groupBy(*group, "id").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("kth"))
        rest = _joined(todo, reached, [*group, "id"], "left", ["kth"]).withColumn("bound", F.least("bound", "kth")).drop("kth")
        size = F.greatest(F.size("cells") - take, F.lit(0))
        rest = rest.withColumns({"cells": F.slice("cells", take + 1, size), "lows": F.slice("lows", take + 1, size)})
        todo = materialize(rest.where((F.size("lows") > 0) & inside(F.try_element_at("lows", F.lit(1)))))
        if todo.isEmpty():
            return best
        take *= MORE_CELLS


def _weights(weights: str, nearest: Column) -> Column:
    if weights == "uniform":
        return F.lit(1.0)
    d = F.col("distance")
    return F.when(nearest == 0, (d == 0).cast("double")).otherwise(1 / F.nullif(d, F.lit(0.0)))


def knn_vote(neighbors: DataFrame, weights: str = "uniform", by: Sequence[str] = ()) -> DataFrame:
    """Class shares of every query, and the winning class (ties to the smallest)."""
    q = [*by, "id"]
    closest = F.min("distance").over(W.partitionBy(*q))
    voted = neighbors.withColumn("__w", _weights(weights, closest))
    shares = voted.groupBy(*q, "label").agg(F.sum("__w").alias("__w"))
    share = F.col("__w") / F.sum("__w").over(W.partitionBy(*q))
    return shares.withColumn("proba", share).drop("__w")


def knn_classify(train: DataFrame, query: DataFrame, k: int, weights: str = "uniform", p: int = 2, key: str = "id",
                 label: str = "label", exclude_self: bool = False) -> DataFrame:
    """Predicted class per query with its share of the (weighted) votes."""
    found = knn_neighbors(train, query, k, (p,), key, label, exclude_self=exclude_self)
    shares = knn_vote(found, weights)
    best = W.partitionBy("id").orderBy(F.desc("proba"), "label")
    return shares.withColumn("__place", F.row_number().over(best)).where(F.col("__place") == 1).select(
        "id", F.col("label").alias("pred"), "proba")


def knn_probability(neighbors: DataFrame, positive, weights: str = "uniform", by: Sequence[str] = ()) -> DataFrame:
    """Share of the votes that the positive class gets, per query."""
    shares = knn_vote(neighbors, weights, by)
    hit = F.sum(F.when(F.col("label") == F.lit(positive), F.col("proba")).otherwise(0.0))
    return shares.groupBy(*by, "id").agg(hit.alias("proba"))


def knn_grid_search(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, positive,
                    fold: str = "fold", key: str = "id", ks: Sequence[int] = DEFAULTS.knn_k,
                    weights: Sequence[str] = DEFAULTS.knn_weights, ps: Sequence[int] = DEFAULTS.knn_p,
                    folds: int = DEFAULTS.folds) -> DataFrame:
    """Mean validation AUC of every (k, weights, p) over expanding folds, best first.

    One neighbour search per fold at the largest k serves all settings: a smaller k is a prefix of the sorted
    list. All folds and metrics run in a single job. Scaling is fitted per fold on that fold's training rows.
    A fold with fewer training rows than k, or with one class, makes the setting's score null.
    """
    truth = F.col(target) == F.lit(positive)
    base = df.withColumn("__truth", truth.cast("int"))
    preps = {}
    sides = []
    for f in range(1, folds + 1):
        train, test = base.where(F.col(fold) < f), base.where(F.col(fold) == f)
        preps[f] = Preprocessor(numeric, categorical).fit(train)
        sides.append(tuple(preps[f].parts(s).select(key, "x", "levels", "__truth", F.lit(f).alias("__fold"))
                           for s in (train, test)))
    train, test = sides[0]
    for a, b in sides[1:]:
        train, test = train.unionByName(a), test.unionByName(b)
    found = knn_neighbors(train, test, max(ks), ps, key, "__truth", by=["__fold"])

    q = ["__fold", "p", "id"]
    nearest = F.min("distance").over(W.partitionBy(*q))
    weighted = found.select(*q, "rank", "label", *[_weights(w, nearest).alias(f"__{w}") for w in weights])
    shares = weighted.groupBy(*q).agg(*[
        (F.sum(F.when(F.col("rank") <= k, F.col(f"__{w}") * F.col("label")))
         / F.sum(F.when(F.col("rank") <= k, F.col(f"__{w}")))).alias(f"{w}_{k}") for w in weights for k in ks])
    settings = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights"), F.lit(i).alias("__wi"), F.col(f"{w}_{k}").alias("proba"))
        for i, w in enumerate(weights) for k in ks]))
    long = shares.select(*q, settings.alias("s")).select(*q, "s.k", "s.weights", "s.__wi", "s.proba")
    truths = test.select("__fold", F.col(key).alias("id"), "__truth")
    scored = long.join(truths, ["__fold", "id"])
    group = ["__fold", "p", "k", "weights", "__wi"]
    aucs = roc_auc(scored, "__truth", "proba", by=group)
    sizes = F.broadcast(train.groupBy("__fold").agg(F.count(F.lit(1)).alias("__n")))  # one row per fold
    checked = aucs.join(sizes, "__fold").withColumn("auc", F.when(F.col("k") <= F.col("__n"), F.col("auc")))
    mean = F.when(F.count("auc") == folds, F.avg("auc"))
    table = checked.groupBy("k", "weights", "p", "__wi").agg(mean.alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"))
    return table.orderBy(F.desc_nulls_last("mean_auc"), "k", "p", "__wi").drop("__wi")


def prediction_table(test: DataFrame, predicted: DataFrame, target: str, keep: Sequence[str], key: str = "id",
                     probability: str = "proba_positive") -> DataFrame:
    """Test rows with predicted class, correctness flag and positive-class probability."""
    out = test.select(key, *keep, target).join(predicted, test[key] == predicted["id"], "left")
    cols = [F.col("pred").alias(f"pred_{target}"), (F.col(target) == F.col("pred")).cast("int").alias("is_correct")]
    if "proba" in predicted.columns:
        cols.append(F.col("proba").alias(probability))
    return out.select(*keep, target, *cols)
