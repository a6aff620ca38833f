import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.operators import clustering as C
from panelkit.operators import metrics as M
from panelkit.operators import neighbors as N
from panelkit.operators.preprocess import Preprocessor, fit_medians, fit_modes


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(4)
    n = 90
    pdf = pd.DataFrame({"id": range(n), "x": list(rng.normal(size=(n, 3)).round(1)), "cat": rng.choice(["u", "v", "w"], n),
                        "label": rng.choice(["p", "q"], n)})
    pdf.at[1, "x"] = pdf.at[0, "x"]  # duplicate point
    df = spark.createDataFrame([(int(r.id), [float(v) for v in r.x], [r["cat"]], r.label) for _, r in pdf.iterrows()],
                               "id long, x array<double>, levels array<string>, label string")
    return pdf, df


def _brute(pdf, train, query, k, p):
    out = {}
    for i in query:
        d = []
        for j in train:
            diff = np.abs(pdf.x[i] - pdf.x[j])
            level = pdf["cat"][i] != pdf["cat"][j]
            value = diff.sum() + 2 * level if p == 1 else math.sqrt((diff**2).sum() + 2 * level)
            d.append((round(value, 9), j))
        out[i] = sorted(d)[:k]
    return out


@pytest.mark.parametrize("block", [7, 4096])
def test_neighbours_match_brute_force_for_any_block_size(cloud, block):
    pdf, df = cloud
    train, query = df.where("id >= 30"), df.where("id < 30")
    got = N.knn_neighbors(train, query, 5, (1, 2), block_rows=block).collect()
    for p in (1, 2):
        want = _brute(pdf, range(30, 90), range(30), 5, p)
        for i in range(30):
            mine = sorted((r["rank"], round(r.distance, 9), r.neighbor) for r in got if r.id == i and r.p == p)
            assert [m[1] for m in mine] == [w[0] for w in want[i]]
            assert {m[2] for m in mine if m[1] < want[i][-1][0]} == {w[1] for w in want[i] if w[0] < want[i][-1][0]}


def test_fewer_rows_than_k_and_self_exclusion(cloud):
    _, df = cloud
    few = df.where("id < 4")
    assert N.knn_neighbors(few, few, 10, exclude_self=True).count() == 12
    first = N.knn_neighbors(df, df, 1, exclude_self=True).where("id = 0").first()
    assert first.neighbor == 1 or first.distance > 0


def test_unseen_level_counts_as_all_zero_code():
    x = np.zeros((1, 1))
    codes = (np.array([[-1]]), np.array([[0]]))
    assert N.distances(x, x, 1, codes)[0, 0] == 1 and N.distances(x, x, 2, codes)[0, 0] == 1
    known = (np.array([[1]]), np.array([[0]]))
    assert N.distances(x, x, 1, known)[0, 0] == 2 and np.isclose(N.distances(x, x, 2, known)[0, 0], math.sqrt(2))


def test_votes_with_zero_distance(spark):
    df = spark.createDataFrame([(0, 0.0, "a", 1), (0, 1.0, "b", 2), (0, 2.0, "b", 3), (1, 1.0, "a", 1), (1, 2.0, "b", 2), (1, 2.0, "b", 3)],
                               "id int, distance double, label string, rank int")
    uniform = {(r.id, r.label): r.proba for r in N.knn_vote(df).collect()}
    assert np.isclose(uniform[(0, "b")], 2 / 3)
    weighted = {(r.id, r.label): r.proba for r in N.knn_vote(df, "distance").collect()}
    assert weighted[(0, "a")] == 1 and weighted[(0, "b")] == 0 and np.isclose(weighted[(1, "a")], 0.5)
    positive = {r.id: r.proba for r in N.knn_probability(df, "a", "distance").collect()}
    assert positive == {0: 1.0, 1: 0.5}


def test_grid_search_equals_separate_searches(spark):
    rng = np.random.default_rng(9)
    n = 72
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": range(n), "a": rng.normal(size=n) + y, "b": rng.normal(size=n), "c": rng.choice(["s", "t"], n),
                        "target": np.where(y == 1, "pos", "neg"), "fold": np.repeat(range(6), 12)})
    got = {(r.k, r.weights, r.p): r.mean_auc for r in N.knn_grid_search(
        spark.createDataFrame(pdf), ["a", "b"], ["c"], "target", "pos", ks=(3, 7, 15)).collect()}
    assert len(got) == 12 and all(got[(15, w, p)] is None for w in ("uniform", "distance") for p in (1, 2))
    for k, w, p in [(3, "uniform", 1), (7, "distance", 2)]:
        aucs = []
        for f in range(1, 6):
            tr, te = pdf[pdf.fold < f], pdf[pdf.fold == f]
            z = lambda d: np.column_stack([(d[c] - tr[c].mean()) / tr[c].std(ddof=0) for c in "ab"])
            diff = np.abs(z(te)[:, None] - z(tr)[None])
            level = 2 * (te.c.to_numpy()[:, None] != tr.c.to_numpy()[None])
            d = diff.sum(2) + level if p == 1 else np.sqrt((diff**2).sum(2) + level)
            near = np.argsort(d, axis=1, kind="stable")[:, :k]
            dist = np.take_along_axis(d, near, 1)
            wt = np.ones_like(dist) if w == "uniform" else 1 / dist
            hit = (tr.target.to_numpy()[near] == "pos") * wt
            score, t = hit.sum(1) / wt.sum(1), (te.target == "pos").to_numpy()
            pos, neg = score[t], score[~t]
            aucs.append(np.mean((pos[:, None] > neg[None]) + 0.5 * np.isclose(pos[:, None], neg[None])))
        assert np.isclose(got[(k, w, p)], np.mean(aucs), atol=1e-6)


def test_preprocessor(spark):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (6.0, "a"), (None, None), (9.0, "b")], "v double, c string")
    assert fit_medians(train, ["v"]) == {"v": 4.0} and fit_modes(train, ["c"]) == {"c": "a"}
    prep = Preprocessor(["v"], ["c"]).fit(train)
    filled = np.array([1, 2, 6, 4, 9.0])
    got = prep.transform(train).select(vector_to_array("features").alias("f")).collect()
    assert np.allclose([r.f[0] for r in got], (filled - filled.mean()) / filled.std())
    assert [list(r.f[1:]) for r in got] == [[0, 1], [1, 0], [1, 0], [1, 0], [0, 1]]
    other = prep.transform(spark.createDataFrame([(1.0, "new")], "v double, c string")).select(vector_to_array("features").alias("f")).first()
    assert list(other.f[1:]) == [0, 0]
    parts = prep.parts(spark.createDataFrame([(1.0, "new"), (1.0, "a")], "v double, c string")).collect()
    assert [r.levels for r in parts] == [[None], ["a"]]
    flat = Preprocessor(["v"]).fit(train.withColumn("v", __import__("pyspark").sql.functions.lit(3.0)))
    assert flat.scales["v"] == (3.0, 0.0)
    assert [list(r.f) for r in flat.transform(train.limit(1)).select(vector_to_array("features").alias("f")).collect()] == [[-2.0]]


def test_roc_with_ties_and_one_class(spark):
    rng = np.random.default_rng(6)
    y, s = rng.integers(0, 2, 60), rng.integers(0, 10, 60).astype(float)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None]))
    assert np.isclose(M.roc_auc(df, "y", "s").first().auc, want)
    full = M.roc_curve(df, "y", "s", drop_collinear=False).toPandas().sort_values("threshold", ascending=False)
    assert np.isclose(np.trapezoid(full.tpr, full.fpr), want) and len(full) == len(set(s)) + 1
    short = M.roc_curve(df, "y", "s").toPandas().sort_values("threshold", ascending=False)
    assert np.isclose(np.trapezoid(short.tpr, short.fpr), want) and len(short) <= len(full)
    assert M.roc_auc(df.where("y = 1"), "y", "s").first().auc is None
    line = spark.createDataFrame([(1, 3.0), (0, 3.0), (1, 2.0), (0, 2.0), (1, 1.0), (0, 1.0)], "y int, s double")
    assert sorted(M.roc_curve(line, "y", "s").toPandas().threshold) == [1.0, 3.0, math.inf]


def test_classification_numbers(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("b", "c")], "t string, p string")
    m = {r.metric: r.value for r in M.classification_metrics(df, "t", "p").collect()}
    assert np.isclose(m["accuracy"], 0.6) and np.isclose(m["balanced_accuracy"], (0.5 + 2 / 3) / 2) and m["f1_c"] == 0
    rep = {r.label: r for r in M.classification_report(df, "t", "p").collect()}
    assert rep["c"].support == 0 and rep["weighted avg"].support == 5 and np.isclose(rep["a"].precision, 1)
    grid = {(r.truth, r.predicted): r["count"] for r in M.confusion_matrix(df, "t", "p", ["a", "b"]).collect()}
    assert grid == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 2}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(12)
    pts = np.vstack([rng.normal(c, 0.4, (15, 2)) for c in ((0, 0), (5, 0), (0, 6))])
    lab = np.repeat([2, 0, 1], 15)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(pts, lab))], "id long, x array<double>, cluster int")
    return pts, lab, df


def _silhouette(pts, lab):
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2))
    out = []
    for i in range(len(pts)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][lab == c].mean() for c in set(lab) - {lab[i]})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_internal_measures(blobs, monkeypatch):
    pts, lab, df = blobs
    assert np.isclose(C.silhouette(df).first()[0], _silhouette(pts, lab))
    per = C.silhouette_points(df, block_rows=8).toPandas()
    assert len(per) == 45 and np.isclose(per.silhouette.mean(), _silhouette(pts, lab))
    g = pts.mean(0)
    centres = {c: pts[lab == c].mean(0) for c in range(3)}
    between = sum(15 * ((centres[c] - g) ** 2).sum() for c in range(3))
    within = sum(((pts[lab == c] - centres[c]) ** 2).sum() for c in range(3))
    assert np.isclose(C.calinski_harabasz(df).first()[0], between * 42 / (within * 2))
    s = {c: np.sqrt(((pts[lab == c] - centres[c]) ** 2).sum(1)).mean() for c in range(3)}
    worst = [max((s[i] + s[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)]
    assert np.isclose(C.davies_bouldin(df).first()[0], np.mean(worst))


def test_single_cluster_gives_nulls(blobs):
    _, _, df = blobs
    one = df.withColumn("cluster", F.lit(0))
    assert C.silhouette(one).first()[0] is None and C.calinski_harabasz(one).first()[0] is None and C.davies_bouldin(one).first()[0] is None


def test_external_measures(spark):
    same = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 0), ("c", 2)], "t string, c int")
    assert C.adjusted_rand(same, "t", "c").first()[0] == 1
    assert np.isclose(C.adjusted_mutual_info(same, "t", "c").first()[0], 1)
    assert np.isclose(C.v_measure(same, "t", "c").first().v_measure, 1)
    trivial = same.withColumn("t", F.lit("x")).withColumn("c", F.lit(1))
    assert C.adjusted_rand(trivial, "t", "c").first()[0] == 1 and C.adjusted_mutual_info(trivial, "t", "c").first()[0] == 1
    rng = np.random.default_rng(7)
    t, c = rng.integers(0, 3, 40), rng.integers(0, 4, 40)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, c)], "t int, c int")
    agree = np.array([[(t[i] == t[j], c[i] == c[j]) for j in range(40) if j > i][k] for i in range(40) for k in range(39 - i)])
    both, in_t, in_c, n = (agree[:, 0] & agree[:, 1]).sum(), agree[:, 0].sum(), agree[:, 1].sum(), len(agree)
    expected = in_t * in_c / n
    assert np.isclose(C.adjusted_rand(df, "t", "c").first()[0], (both - expected) / ((in_t + in_c) / 2 - expected))
    # Expected mutual information against the mean over random relabellings.
    ta, tc = np.bincount(t), np.bincount(c)

    def mutual(u, v):
        cells = np.zeros((3, 4))
        np.add.at(cells, (u, v), 1)
        p = cells / 40
        outer = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
        return np.sum(p[p > 0] * np.log(p[p > 0] / outer[p > 0]))

    exact = sum(C.overlap_information(float(a), float(b), 40.0) for a in ta for b in tc)
    sampled = np.mean([mutual(rng.permutation(t), c) for _ in range(4000)])
    assert np.isclose(exact, sampled, atol=0.003)


def test_kmeans_invariants_and_selection(blobs):
    pts, lab, df = blobs
    data = C.as_vectors(df.drop("cluster"))
    table = C.kmeans_select(data, ks=(2, 3, 4, 5)).collect()
    inertia = [r.inertia for r in sorted(table, key=lambda r: r.k)]
    assert all(a > b for a, b in zip(inertia[:2], inertia[1:3])) and [r.k for r in table if r.best] == [3]
    model = C.kmeans_fit(data, 3)
    got = C.assign(data, model).select("id", "x", "cluster").toPandas()
    centres = np.array(sorted(map(tuple, model.vectors)))
    near = [int(np.argmin([np.linalg.norm(np.array(x) - c) for c in centres])) for x in got.x]
    assert got.cluster.tolist() == near
    assert C.adjusted_rand(C.assign(data, model).join(df.select("id", F.col("cluster").alias("t")), "id"), "t", "cluster").first()[0] == 1
    assert 0.5 < C.silhouette_linear(C.assign(data, model).withColumn("x", vector_to_array("features"))).first()[0] <= 1


def test_kmeans_from_a_given_start_with_ties_and_an_empty_cluster(spark):
    rows = [(i, [float(v)]) for i, v in enumerate([0, 0, 2, 2, 4, 10])] + [(6, None), (7, [float("nan")])]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    start = np.array([[1.0], [3.0], [100.0]])  # 2 is as near to the first as to the second; nothing is near the third
    first = C.kmeans_fit(df, 3, max_iter=1, start=start)
    assert first.vectors.tolist() == [[1.0], [7.0], [100.0]]
    done = C.kmeans_fit(df, 3, start=start)
    assert done.vectors.tolist() == [[1.6], [10.0], [100.0]] and np.isclose(done.cost, 11.2)
    assert {r.id: r.cluster for r in C.assign(df.where("id < 6"), done).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, features array<double>")
    assert len(C.kmeans_fit(same, 3).vectors) == 1
    with pytest.raises(ValueError):
        C.kmeans_fit(df.where("id > 5"), 2)


def test_overlaps_against_the_full_sum():
    lg = np.vectorize(math.lgamma)
    for a, b, n in ((1, 1, 1), (1, 5, 7), (6, 5, 7), (300, 400, 1000), (999, 999, 1000), (20000, 30000, 100000), (2, 99999, 100000)):
        k = np.arange(max(1, a + b - n), min(a, b) + 1, dtype=float)
        log_p = lg(a + 1) + lg(b + 1) + lg(n - a + 1) + lg(n - b + 1) - lg(n + 1) - lg(k + 1) - lg(a - k + 1) - lg(b - k + 1) - lg(n - a - b + k + 1)
        want = float(np.sum(k / n * np.log(n * k / (a * b)) * np.exp(log_p)))
        assert np.isclose(C.overlap_information(float(a), float(b), float(n)), want, rtol=1e-7, atol=1e-15)


def test_many_sizes_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "SIZE_BLOCK", 3)
    rng = np.random.default_rng(5)
    pairs = [(int(rng.integers(0, 12) ** 2 // 10), int(rng.integers(0, 15) ** 2 // 12)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "t int, c int")
    (t, c), n = (np.array(v) for v in zip(*pairs)), 600
    cells = np.zeros((t.max() + 1, c.max() + 1))
    np.add.at(cells, (t, c), 1)
    h = lambda v: -sum(x / n * math.log(x / n) for x in np.ravel(v) if x)
    a, b = cells.sum(1), cells.sum(0)
    expected = sum(C.overlap_information(x, y, float(n)) for x in a[a > 0] for y in b[b > 0])
    want = (h(a) + h(b) - h(cells) - expected) / ((h(a) + h(b)) / 2 - expected)
    assert np.isclose(C.adjusted_mutual_info(df, "t", "c").first()[0], want, rtol=1e-9)


def test_pca_centres_and_fixes_signs(blobs):
    pts, _, df = blobs
    wide = df.withColumn("x", F.concat("x", F.array(F.sin(F.col("x")[0]) + F.col("x")[1])))  # two columns would come back as they are
    got = C.pca_2d(C.as_vectors(wide)).select("id", "pc1", "pc2", "explained").toPandas().sort_values("id")
    pts = np.column_stack([pts, np.sin(pts[:, 0]) + pts[:, 1]])
    z = pts - pts.mean(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    vt = np.array([v * np.sign(v[np.argmax(np.abs(v))]) for v in vt])[:2]
    share = (s[:2] ** 2).sum() / (s ** 2).sum()
    assert np.allclose(got[["pc1", "pc2"]], z @ vt.T, atol=1e-8) and np.isclose(got.explained.iloc[0], share)


def test_summary_table(blobs):
    _, lab, df = blobs
    out = C.cluster_summary({"train": df.withColumn("t", F.col("cluster"))}, "t").collect()
    assert {r.metric: r.part for r in out} == {m: "train" for m in (
        "silhouette", "calinski_harabasz", "davies_bouldin", "adjusted_rand", "adjusted_mutual_info", "v_measure")}
