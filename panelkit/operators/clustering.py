"""K-means, its quality measures, and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.scalars import ratio
from panelkit.operators.neighbors import BLOCK_ROWS, PRODUCT_CELLS, _block_count, _blocked, _matrix, _own_names, _tiles, cogroups, pair_distances, pairs_where, products
from panelkit.operators.sampling import sample_cap
from panelkit.operators.scan import attach_by_value
from panelkit.session import materialize


CLOSE = 1e9  # squared distances less than this many times their error are measured pair by pair


@dataclass(frozen=True)
class Centres:
    """A k-means fit: centres in lexicographic order, which is the number of their cluster, and the squared distances to them."""

    vectors: np.ndarray
    cost: float
    rounds: int


def _numbers(df: DataFrame, features: str) -> Column:
    kind = df.schema[features].dataType.simpleString()
    return vector_to_array(features) if kind == "vector" else F.col(features).cast("array<double>")


def _literal(vector: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in vector])


def start_centres(rows: DataFrame, k: int, seed: int = DEFAULTS.seed) -> np.ndarray:
    """k-means++ centres of rows (key, x): each next one is drawn with a chance in proportion to its squared distance to those taken.

    The draw is a race: -ln(u) / distance is least for the row drawn, where u is a number in (0, 1) from a digest of seed, step
    and key. So it depends on the rows alone, and ties go to the smaller key. Fewer different rows than k give fewer centres.
    """
    taken: list[np.ndarray] = []
    for step in range(k):
        digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{step}"), F.col("key").cast("string")).cast("binary"))
        u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)
        far = F.least(*[_squared(F.col("x"), _literal(c)) for c in taken]) if len(taken) > 1 else (_squared(F.col("x"), _literal(taken[0])) if taken else F.lit(1.0))
        drawn = rows.select("key", "x", far.alias("d"), (-F.log(u) / F.nullif(far, F.lit(0.0))).alias("race")).where("d > 0")
        won = drawn.agg(F.min_by("x", F.struct("race", "key"))).first()[0]
        if won is None:
            break
        taken.append(np.array(won, float))
    return np.array(taken)


def _lloyd_sums(rows: DataFrame, fits: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For every set of centres the rows per nearest centre, their sums and the squared distances in all, from one pass.

    Spark adds what each task found.
    """
    d = fits[0].shape[1]
    first = np.cumsum([0, *[len(c) for c in fits]])

    def run(batches):
        total = np.zeros((first[-1], d + 2))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for begin, centres in zip(first, fits):
                for a, z in _tiles(len(x), len(centres), d):
                    far = ((x[a:z, None, :] - centres[None]) ** 2).sum(axis=2)
                    near = far.argmin(axis=1)
                    np.add.at(total, begin + near, np.column_stack([np.ones(z - a), far[np.arange(z - a), near], x[a:z]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    sums = rows.select("x").mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # one row per centre and dimension
    out = np.zeros(first[-1] * (d + 2))
    out[[r["at"] for r in sums]] = [r["v"] for r in sums]
    parts = np.split(out.reshape(-1, d + 2), first[1:-1])
    return [(part[:, 0], part[:, 2:], float(part[:, 1].sum())) for part in parts]


def kmeans_fits(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = DEFAULTS.seed, max_iter: int = 300, key: str = "id",
                start: np.ndarray | None = None) -> dict[int, Centres]:
    """Lloyd's steps for several numbers of centres at once, from the first k of ``start`` or of ``start_centres``.

    Every round is one pass for all fits whose centres still move. A row belongs to the nearest centre, ties to the first one;
    a centre without rows stays where it is. Rows with a null, NaN or infinite part are left out. Only sums per centre reach
    the driver.
    """
    rows = materialize(df.select(F.col(key).alias("key"), _numbers(df, features).alias("x")).where(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))))
    first = start_centres(rows, max(ks), seed) if start is None else np.array(start, float)
    if not len(first):
        raise ValueError("k-means needs at least one row")
    now, done, rounds = {k: first[:k] for k in ks}, {}, 0
    while now:
        for (k, centres), (n, sums, cost) in zip(list(now.items()), _lloyd_sums(rows, list(now.values()))):
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
            if rounds == max_iter or np.allclose(moved, centres, rtol=1e-12, atol=1e-12):
                done[k] = Centres(np.array(sorted(map(tuple, centres))), cost, rounds)
                del now[k]
            else:
                now[k] = moved
        rounds += 1
    return done


def kmeans_fit(df: DataFrame, k: int, features: str = "features", seed: int = DEFAULTS.seed, max_iter: int = 300, key: str = "id",
               start: np.ndarray | None = None) -> Centres:
    """``kmeans_fits`` for one number of centres."""
    return kmeans_fits(df, [k], features, seed, max_iter, key, start)[k]


def assign(df: DataFrame, model: Centres, features: str = "features") -> DataFrame:
    """Rows with their cluster: the nearest centre, ties to the smaller number."""
    x = _numbers(df, features)
    near = F.array(*[F.struct(_squared(x, _literal(c)).alias("d"), F.lit(i).alias("l")) for i, c in enumerate(model.vectors)])
    return df.withColumn("cluster", F.array_min(near)["l"])


def assign_to_centres(df: DataFrame, centres: DataFrame, x: str = "x", label: str = "cluster") -> DataFrame:
    """Nearest given centre of every row: ``centres`` has one row per cluster, ties go to the smaller label."""
    packed = centres.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), F.col(x).alias("c"))))).scalar()
    near = F.transform("__centres", lambda s: F.struct(_squared(F.col(x), s["c"]).alias("d"), s["l"].alias("l")))
    return df.withColumn("__centres", packed).withColumn(label, F.array_min(near)["l"]).drop("__centres")


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda acc, v: acc + v)


def silhouette_points(df: DataFrame, key: str = "id", x: str = "x", cluster: str = "cluster",
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Silhouette of every row with Euclidean distance, over all rows given.

    Blocks of rows meet in pairs, each pair once: its distances count for the rows of both sides.
    """
    side = df.select(F.col(key).alias("id"), F.col(x).alias("x"), F.col(cluster).alias("cluster"))
    types = {f.name: f.dataType.simpleString() for f in side.schema}
    blocks = _block_count(side.count(), block_rows)
    own_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = side.withColumn("__tb", own_block).withColumn("__qb", F.explode(F.sequence("__tb", F.lit(blocks - 1))))
    right = _own_names(side.withColumn("__qb", own_block).withColumn("__tb", F.explode(F.sequence(F.lit(0), "__qb"))))

    def members(clusters: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        code, names = pd.factorize(clusters)
        return names, np.eye(len(names) + 1)[code][:, :-1]  # a null cluster is nobody's

    def wide(ids, clusters, names, total: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"id": np.repeat(ids, len(names)), "cluster": np.repeat(clusters, len(names)),
                             "other": np.tile(names, len(ids)), "total": total.ravel()})

    def sums(t: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if t.empty or q.empty:
            return pd.DataFrame(columns=["id", "cluster", "other", "total"])
        xt, xq = _matrix(t["x"]), _matrix(q["q_x"])
        (t_names, t_member), (q_names, q_member) = members(t["cluster"]), members(q["q_cluster"])
        twice = t["__tb"].iloc[0] != q["q___qb"].iloc[0]
        back, parts, squares = np.zeros((len(t), len(q_names))), [], products(xt)
        for a, z in _tiles(len(q), len(t), 1, PRODUCT_CELLS):
            d, off = squares(xq[a:z])
            rows, cols = pairs_where(~(d > CLOSE * off[:, None]))  # near each other, or not finite
            with np.errstate(all="ignore"):
                np.sqrt(d, out=d)
            d[rows, cols] = pair_distances(xq[a:z], xt, rows, cols)
            parts.append(wide(q["q_id"].to_numpy()[a:z], q["q_cluster"].to_numpy()[a:z], t_names, d @ t_member))
            if twice:
                back += d.T @ q_member[a:z]
        return pd.concat([*parts, wide(t["id"].to_numpy(), t["cluster"].to_numpy(), q_names, back)] if twice else parts)

    found = cogroups(left, right, ["__tb", "__qb"], ["q___tb", "q___qb"], blocks * (blocks + 1) // 2).applyInPandas(
        sums, f"id {types['id']}, cluster {types['cluster']}, other {types['cluster']}, total double")
    per = found.groupBy("id", "cluster", "other").agg(F.sum("total").alias("total"))
    sizes = side.groupBy(F.col("cluster").alias("other")).agg(F.count(F.lit(1)).alias("size"))
    own = F.col("cluster") == F.col("other")
    mean = F.when(own, ratio("total", F.col("size") - 1)).otherwise(ratio("total", "size"))
    scored = attach_by_value(per, sizes, ["other"], "size").groupBy("id", "cluster").agg(
        F.max(F.when(own, mean)).alias("a"), F.min(F.when(~own, mean)).alias("b"))
    value = F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(ratio(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return scored.select("id", "cluster", F.when(F.col("b").isNotNull(), value).alias("silhouette"))


def silhouette(df: DataFrame, key: str = "id", x: str = "x", cluster: str = "cluster",
               max_rows: int | None = None, seed: int = DEFAULTS.seed) -> DataFrame:
    """Mean silhouette with Euclidean distance; null for a single cluster.

    It compares all pairs. ``max_rows`` asks for a sample of that many rows; ``silhouette_linear`` takes all rows in linear time.
    """
    rows = sample_cap(df, [key], max_rows, seed) if max_rows else df
    return silhouette_points(rows, key, x, cluster).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_linear(df: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance over all rows, in linear time; null for a single cluster.

    The mean squared distance of a point to a cluster follows from the cluster's size, centre and mean squared length.
    One row per cluster travels with every row, as in an assignment to centres.
    """
    rows = df.select(F.col(x).alias("x"), F.col(cluster).alias("cluster"))
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    lengths = rows.groupBy("cluster").agg(F.avg(square).alias("q"))
    parts = cluster_spreads(rows, "x", "cluster").join(lengths, "cluster")
    packed = parts.agg(F.collect_list(F.struct("cluster", F.col("n").cast("double").alias("n"), "centre", "q"))).scalar()
    dot = lambda c: F.aggregate(F.zip_with("x", c, lambda u, v: u * v), F.lit(0.0), lambda a, v: a + v)
    scored = rows.withColumn("__all", packed).withColumn("__q", square)
    mean = F.transform("__all", lambda s: F.struct(
        (s["cluster"] == F.col("cluster")).alias("own"), s["n"].alias("n"), F.greatest(F.col("__q") + s["q"] - 2 * dot(s["centre"]), F.lit(0.0)).alias("d")))
    scored = scored.select(mean.alias("m"))
    own = F.get(F.filter("m", lambda s: s["own"]), F.lit(0))
    scored = scored.select(own.alias("o"), F.array_min(F.transform(F.filter("m", lambda s: ~s["own"]), lambda s: s["d"])).alias("b"))
    a = F.col("o.d") * F.col("o.n") / F.nullif(F.col("o.n") - 1, F.lit(0.0))
    value = F.when(a.isNull(), 0.0).otherwise(F.coalesce(ratio(F.col("b") - a, F.greatest(F.col("b"), a)), F.lit(0.0)))
    return scored.agg(F.avg(F.when(F.col("b").isNotNull(), value)).alias("silhouette"))


def cluster_spreads(df: DataFrame, x: str, cluster: str) -> DataFrame:
    """Size, centre and within-cluster squared deviation per cluster, from one pass over (cluster, dimension)."""
    cells = df.select(F.col(cluster).alias("cluster"), F.posexplode(x).alias("dim", "v"))
    dims = cells.groupBy("cluster", "dim").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var"))
    return dims.groupBy("cluster").agg(
        F.max("n").alias("n"), F.sum(F.col("n") * F.col("var")).alias("within"),
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda s: s["mean"]).alias("centre"))


def calinski_harabasz(df: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Between to within dispersion ratio, null for a single cluster."""
    per = cluster_spreads(df, x, cluster)
    dims = per.select("cluster", "n", F.posexplode("centre").alias("dim", "c"))
    overall = dims.groupBy("dim").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("c")) / F.sum("n")).alias("g"),
                                      F.sum(F.col("n") * F.col("c") * F.col("c")).alias("s"))
    between = overall.agg(F.sum(F.col("s") - F.col("n") * F.col("g") * F.col("g"))).scalar()
    size = per.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("within").alias("w"))
    k = F.col("k")
    return size.select(F.when(k > 1, ratio(between * (F.col("n") - k), F.col("w") * (k - 1))).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centre distance, null for a single cluster."""
    centres = cluster_spreads(df, x, cluster).select("cluster", "centre", "n")
    rows = attach_by_value(df.select(F.col(cluster).alias("cluster"), F.col(x).alias("x")), centres, ["cluster"])
    spread = rows.groupBy("cluster", "centre").agg(F.avg(F.sqrt(_squared(F.col("x"), F.col("centre")))).alias("s"))
    packed = spread.agg(F.collect_list(F.struct("cluster", "centre", "s")).alias("all"))
    gap = lambda u, v: F.sqrt(_squared(u["centre"], v["centre"]))
    worst = lambda u: F.array_max(F.transform(
        F.filter(F.col("all"), lambda v: v["cluster"] != u["cluster"]),
        lambda v: F.coalesce(ratio(u["s"] + v["s"], gap(u, v)), F.lit(0.0))))
    ratios = F.transform(F.col("all"), worst)
    mean = F.aggregate(ratios, F.lit(0.0), lambda acc, v: acc + v) / F.size("all")
    return packed.select(F.when(F.size("all") > 1, mean).alias("davies_bouldin"))


def contingency(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Cell counts with both margins and the grand total, by grouping level."""
    cells = df.dropna(subset=[truth, cluster]).groupBy(F.col(truth).alias("a"), F.col(cluster).alias("b")).agg(
        F.count(F.lit(1)).alias("c"))
    return cells.cube("a", "b").agg(F.sum("c").alias("n"), F.grouping_id().alias("level"))


_CELL, _ROW, _COL, _ALL = 0, 1, 2, 3


def adjusted_rand(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Agreement of two partitions over pairs, corrected for chance; 1 when both are trivial alike."""
    n = F.col("n").cast("double")
    pairs = lambda lv: F.sum(F.when(F.col("level") == lv, n * (n - 1) / 2))
    s = contingency(df, truth, cluster).agg(*[pairs(lv).alias(f"p{lv}") for lv in (_CELL, _ROW, _COL, _ALL)])
    expected = ratio(F.col("p1") * F.col("p2"), "p3")
    top = (F.col("p1") + F.col("p2")) / 2
    return s.select(F.coalesce(ratio(F.col("p0") - expected, top - expected), F.lit(1.0)).alias("adjusted_rand"))


def _entropies(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Entropies of both margins and of the cells, and the row count."""
    n = F.col("n").cast("double")
    part = lambda lv: F.sum(F.when(F.col("level") == lv, n * F.log(n)))
    total = F.max(F.when(F.col("level") == _ALL, n))
    s = contingency(df, truth, cluster).agg(total.alias("n"), *[part(lv).alias(f"e{lv}") for lv in (_CELL, _ROW, _COL)])
    h = lambda lv: F.greatest(F.log("n") - F.col(f"e{lv}") / F.col("n"), F.lit(0.0))
    return s.select("n", h(_ROW).alias("h_truth"), h(_COL).alias("h_cluster"), h(_CELL).alias("h_joint"))


def v_measure(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Homogeneity, completeness and their harmonic mean."""
    e = _entropies(df, truth, cluster)
    mutual = F.greatest(F.col("h_truth") + F.col("h_cluster") - F.col("h_joint"), F.lit(0.0))
    part = lambda h: F.when(F.col(h) > 0, mutual / F.nullif(F.col(h), F.lit(0.0))).otherwise(1.0)
    out = e.select(part("h_truth").alias("homogeneity"), part("h_cluster").alias("completeness"))
    both = F.col("homogeneity") + F.col("completeness")
    return out.withColumn("v_measure", F.coalesce(ratio(2 * F.col("homogeneity") * F.col("completeness"), both), F.lit(0.0)))


def overlap_information(a: float, b: float, n: float) -> float:
    """Expected share in the mutual information of two sets of sizes a and b among n rows, placed at random.

    Their overlap is hypergeometric. Its probabilities follow from the most likely overlap by their ratios, in both directions
    until they vanish beside it, and are then scaled to 1; no factorials are needed.
    """
    low, high = max(0.0, a + b - n), min(a, b)
    mode = min(max(np.floor((a + 1) * (b + 1) / (n + 2)), low), high)

    def side(first: float, end: float, step: int) -> tuple[np.ndarray, np.ndarray]:
        at, weight, last = [], [], 1.0
        while (end - first) * step >= 0 and last > 1e-30:
            k = np.arange(first, min(first + 256 * step, end + step) if step > 0 else max(first + 256 * step, end + step), step)
            ratio_ = (a - k + 1) * (b - k + 1) / (k * (n - a - b + k)) if step > 0 else (k + 1) * (n - a - b + k + 1) / ((a - k) * (b - k))
            w = last * np.cumprod(ratio_)
            at.append(k)
            weight.append(w)
            first, last = k[-1] + step, float(w[-1])
        return (np.concatenate(at), np.concatenate(weight)) if at else (np.empty(0), np.empty(0))

    up, down = side(mode + 1, high, 1), side(mode - 1, low, -1)
    k, w = np.concatenate([[mode], up[0], down[0]]), np.concatenate([[1.0], up[1], down[1]])
    some = k > 0
    return float((w[some] * k[some] / n * np.log(n * k[some] / (a * b))).sum() / w.sum())


SIZE_BLOCK = 256


def _expected_mutual(margins: DataFrame, n: float) -> float:
    """Expected mutual information of random partitions: one sum over pairs of distinct sizes of both margins.

    ``margins``: level, n (size), times. Blocks of sizes meet in tasks by their numbers; a task sends on one sum.
    """
    side = lambda lv: margins.where(F.col("level") == lv).select(F.col("n").cast("double").alias("id"), "times")
    rows, cols = side(_ROW), side(_COL)
    count = {r["level"]: r["c"] for r in margins.groupBy("level").agg(F.count(F.lit(1)).alias("c")).collect()}
    blocks = {lv: _block_count(count.get(lv, 0), SIZE_BLOCK) for lv in (_ROW, _COL)}
    left = _blocked(rows, "id", "__rb", blocks[_ROW], "__cb", blocks[_COL])
    right = _own_names(_blocked(cols, "id", "__cb", blocks[_COL], "__rb", blocks[_ROW]))

    def total(r: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        value = sum(ta * tb * overlap_information(a, b, n) for a, ta in zip(r["id"], r["times"]) for b, tb in zip(c["q_id"], c["q_times"]))
        return pd.DataFrame({"value": [float(value)]})

    met = left.groupBy("__rb", "__cb").cogroup(right.groupBy("q___rb", "q___cb")).applyInPandas(total, "value double")
    return float(met.agg(F.coalesce(F.sum("value"), F.lit(0.0))).first()[0])


def adjusted_mutual_info(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Mutual information corrected for chance, over the mean of both entropies."""
    spark = df.sparkSession
    e = _entropies(df, truth, cluster).first()
    margins = materialize(contingency(df, truth, cluster).where(F.col("level").isin(_ROW, _COL)).groupBy("level", "n").agg(
        F.count(F.lit(1)).alias("times")))
    values = {r["level"]: r["values"] for r in margins.groupBy("level").agg(F.sum("times").alias("values")).collect()}
    mutual = max(e["h_truth"] + e["h_cluster"] - e["h_joint"], 0.0)
    expected = _expected_mutual(margins, e["n"])
    spread = (e["h_truth"] + e["h_cluster"]) / 2 - expected
    tiny = float(np.finfo("float64").eps)
    spread = min(spread, -tiny) if spread < 0 else max(spread, tiny)
    value = 1.0 if values.get(_ROW) == values.get(_COL) == 1 else (mutual - expected) / spread
    return spark.createDataFrame([(float(value),)], "adjusted_mutual_info double")


def kmeans_select(df: DataFrame, ks: Sequence[int] = DEFAULTS.cluster_k, key: str = "id", features: str = "features",
                  seed: int = DEFAULTS.seed, max_rows: int | None = None) -> DataFrame:
    """Inertia and silhouette for every number of clusters, with the best (first highest silhouette) marked.

    The silhouette is the linear one over all rows; with ``max_rows`` the Euclidean one on one sample of that many rows.
    """
    rows = materialize(df.select(key, features))
    table = []
    for k, model in sorted(kmeans_fits(rows, ks, features, seed, key=key).items()):
        scored = assign(rows, model, features).withColumn("x", _numbers(rows, features))
        score = (silhouette(scored, key, "x", "cluster", max_rows, seed) if max_rows else silhouette_linear(scored)).first()[0]
        table.append((int(k), model.cost, score))
    best = max((s for _, _, s in table if s is not None), default=None)
    chosen = next((k for k, _, s in table if s is not None and s == best), None)
    return df.sparkSession.createDataFrame([(*r, r[0] == chosen) for r in table],
                                           "k int, inertia double, silhouette double, best boolean")


def cluster_summary(parts: dict[str, DataFrame], truth: str, key: str = "id", x: str = "x", cluster: str = "cluster",
                    max_rows: int | None = None) -> DataFrame:
    """Internal and external quality of every named part, long form; ``max_rows`` as in ``kmeans_select``."""
    out = None
    for name, df in parts.items():
        tables = [silhouette(df, key, x, cluster, max_rows) if max_rows else silhouette_linear(df, x, cluster), calinski_harabasz(df, x, cluster), davies_bouldin(df, x, cluster),
                  adjusted_rand(df, truth, cluster), adjusted_mutual_info(df, truth, cluster),
                  v_measure(df, truth, cluster).select("v_measure")]
        for t in tables:
            metric = t.columns[0]
            row = t.select(F.lit(name).alias("part"), F.lit(metric).alias("metric"), F.col(metric).alias("value"))
            out = row if out is None else out.unionByName(row)
    return out


def pca_2d(train: DataFrame, apply_to: DataFrame | None = None, features: str = "features", k: int = 2) -> DataFrame:
    """Coordinates on the first components of ``train`` with the share of variance they explain.

    Data is centred first. The sign of a component makes its largest loading positive. ``apply_to`` defaults to
    ``train``; pass another table to see it on the same axes. Vectors of ``k`` values or fewer come back as they are.
    """
    width = train.select(F.size(vector_to_array(features))).first()
    if width is None or width[0] <= k:  # nothing to reduce: the columns as they are
        out = train if apply_to is None else apply_to
        own = {f"pc{j + 1}": F.get(vector_to_array(features), F.lit(j)) for j in range(k)}
        return out.withColumns(own).withColumn("explained", F.lit(1.0))
    centre = StandardScaler(inputCol=features, outputCol="__centred", withMean=True, withStd=False).fit(train)
    model = PCA(k=k, inputCol="__centred", outputCol="__pc").fit(centre.transform(train))
    load = model.pc.toArray()
    signs = [1.0 if load[np.argmax(np.abs(load[:, j])), j] >= 0 else -1.0 for j in range(k)]
    share = float(model.explainedVariance.toArray().sum())
    rows = model.transform(centre.transform(train if apply_to is None else apply_to))
    pc = vector_to_array("__pc")
    named = {f"pc{j + 1}": pc[j] * s for j, s in enumerate(signs)}
    return rows.withColumns(named).withColumn("explained", F.lit(share)).drop("__centred", "__pc")


def as_vectors(df: DataFrame, x: str = "x", features: str = "features") -> DataFrame:
    return df.withColumn(features, array_to_vector(F.col(x).cast("array<double>")))
