"""Preprocessing, nearest neighbours, classification metrics, clustering."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.operators import clustering as C
from panelkit.operators import metrics as M
from panelkit.operators import neighbors as N
from panelkit.operators.panel import panel_features, temporal_split, time_series_folds
from panelkit.operators.preprocess import Preprocessor, impute_median, impute_mode, standardize
from panelkit.plans.cluster_sql import assigned_sql, kmeans_sql, pca_sql, points_sql, select_sql, summary_sql
from panelkit.plans.registry import FEATURES_SQL, facts, query, r, rounded
from panelkit.session import materialize
from panelkit.sources.adapters import ERA_A, ERA_B, LINEITEM_CUTOFF, LINEITEM_HOLDOUT, table

NUMERIC = ["monto_asinh", "lag1", "roll3_mean", "roll3_std", "sin12", "cos12"]


def _features(spark, d):
    rows = panel_features(facts(spark, d), cutoff=LINEITEM_CUTOFF, before=ERA_A, after=ERA_B)
    return materialize(rows.withColumn("id", F.concat_ws("|", F.col("fecha").cast("string"), "subtema", "sector")))


def _points(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")


@query("impute_median", """WITH t AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
  SELECT event_id, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM t)), 4) AS v FROM t""")
def impute_median_query(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return rounded(impute_median(rows, ["v"]), 4)


@query("impute_mode", """WITH t AS (SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS v FROM part)
  SELECT p_partkey, coalesce(v, (SELECT v FROM t WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)) AS v FROM t""")
def impute_mode_query(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("v"))
    return impute_mode(rows, ["v"])


@query("standardize", f"""WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
  SELECT c_custkey, {r('(c_acctbal - m) / sd')} AS c_acctbal FROM customer, s""")
def standardize_query(spark, d):
    return rounded(standardize(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]))


@query("one_hot", """WITH l AS (SELECT DISTINCT c_mktsegment AS s FROM customer WHERE c_nationkey < 20 AND c_mktsegment <> 'MACHINERY'),
  o AS (SELECT list(s ORDER BY s) AS all_s FROM l)
  SELECT c_custkey, array_to_string(list_transform(all_s, lambda s: (s = c_mktsegment)::INT), ',') AS code FROM customer, o""")
def one_hot(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.lit(0.0).alias("zero"))
    known = rows.where((F.col("c_nationkey") < 20) & (F.col("c_mktsegment") != "MACHINERY"))
    coded = Preprocessor(["zero"], ["c_mktsegment"]).fit(known).transform(rows)
    slots = F.transform(F.slice(vector_to_array("features"), F.lit(2), F.size(vector_to_array("features")) - 1), lambda v: v.cast("int").cast("string"))
    return coded.select("c_custkey", F.array_join(slots, ",").alias("code"))


@query("knn_neighbors", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings),
  p AS (SELECT a.vec_id AS id, b.vec_id AS neighbor, b.label, list_distance(a.x, b.x) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id),
  k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbor) AS rank FROM p)
  SELECT id, neighbor, label, rank::INT AS rank, round(d, 6) AS distance FROM k WHERE rank <= 5""")
def knn_neighbors(spark, d):
    points = _points(spark, d)
    found = N.knn_neighbors(points, points, 5, (2,), "vec_id", exclude_self=True)
    return rounded(found.drop("p"))


_Z = ", ".join(f"({c} - avg({c}) FILTER (fecha < DATE '2000-07-01') OVER ()) / stddev_pop({c}) FILTER (fecha < DATE '2000-07-01') OVER () AS z{i}"
               for i, c in enumerate(NUMERIC))
_L1 = " + ".join(f"abs(a.z{i} - b.z{i})" for i in range(len(NUMERIC)))


@query("knn_classify", f"""WITH {FEATURES_SQL}, z AS (SELECT fecha, subtema, sector, concat_ws('|', fecha::VARCHAR, subtema, sector) AS id, {_Z} FROM features),
  p AS (SELECT a.id, a.subtema AS truth, b.subtema AS label, {_L1} + CASE WHEN a.sector = b.sector THEN 0 ELSE 2 END AS d, b.id AS nid
    FROM z a JOIN z b ON a.fecha >= DATE '2000-07-01' AND b.fecha < DATE '2000-07-01'),
  k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, nid) AS i FROM p),
  s AS (SELECT id, truth, label, sum(1 / d) AS w FROM k WHERE i <= 7 GROUP BY ALL),
  b AS (SELECT *, w / sum(w) OVER (PARTITION BY id) AS proba, row_number() OVER (PARTITION BY id ORDER BY w DESC, label) AS j FROM s)
  SELECT id, truth AS subtema, label AS pred_subtema, (truth = label)::INT AS is_correct, {r('proba')} AS proba FROM b WHERE j = 1""")
def knn_classify(spark, d):
    rows = _features(spark, d)
    train, test = temporal_split(rows, LINEITEM_HOLDOUT)
    prep = Preprocessor(NUMERIC, ["sector"]).fit(train)
    left = prep.parts(train).withColumnRenamed("subtema", "label")
    right = prep.parts(test)
    votes = N.knn_classify(left, right, 7, "distance", 1)
    out = N.prediction_table(test.withColumn("key", F.col("id")), votes, "subtema", ["key"], probability="proba")
    return rounded(out.withColumnRenamed("key", "id"))


_COLS = range(len(NUMERIC))
GRID_SQL = f"""WITH {FEATURES_SQL}, o AS (SELECT *, concat_ws('|', fecha::VARCHAR, subtema, sector) AS id, (subtema = 'A')::INT AS y,
    row_number() OVER (ORDER BY fecha, subtema, sector) - 1 AS i, count(*) OVER () AS n FROM features),
  fo AS (SELECT *, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS fold FROM o),
  folds AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
  st AS (SELECT f, {', '.join(f'avg({c}) AS m{i}, stddev_pop({c}) AS s{i}' for i, c in enumerate(NUMERIC))} FROM folds JOIN fo ON fold < f GROUP BY 1),
  z AS (SELECT f, fold, id, y, sector, {', '.join(f'({c} - m{i}) / s{i} AS z{i}' for i, c in enumerate(NUMERIC))} FROM st JOIN fo ON fold <= f),
  pairs AS (SELECT a.f, a.id, a.y AS truth, b.y AS label, b.id AS nid, CASE WHEN a.sector = b.sector THEN 0 ELSE 2 END AS lv,
      {' + '.join(f'abs(a.z{i} - b.z{i})' for i in _COLS)} AS l1, {' + '.join(f'(a.z{i} - b.z{i}) ** 2' for i in _COLS)} AS l2
    FROM z a JOIN z b ON a.f = b.f AND a.fold = a.f AND b.fold < b.f),
  d AS (SELECT f, id, truth, label, nid, 1 AS p, l1 + lv AS d FROM pairs UNION ALL SELECT f, id, truth, label, nid, 2, sqrt(l2 + lv) FROM pairs),
  rk AS (SELECT *, row_number() OVER (PARTITION BY f, p, id ORDER BY d, nid) AS r FROM d QUALIFY r <= 41),
  s AS (SELECT f, p, id, truth, k, weights, sum(CASE weights WHEN 'uniform' THEN 1.0::DOUBLE ELSE 1 / d END * label)
      / sum(CASE weights WHEN 'uniform' THEN 1.0::DOUBLE ELSE 1 / d END) AS score
    FROM rk JOIN (SELECT unnest([3, 5, 7, 9, 11, 15, 21, 31, 41]) AS k) ON r <= k, (SELECT unnest(['uniform', 'distance']) AS weights) GROUP BY ALL),
  q AS (SELECT *, rank() OVER (PARTITION BY f, p, k, weights ORDER BY score) + (count(*) OVER (PARTITION BY f, p, k, weights, score) - 1) / 2.0::DOUBLE AS rank FROM s),
  a AS (SELECT f, p, k, weights, (sum(rank * truth) - sum(truth) * (sum(truth) + 1) / 2) / (sum(truth) * sum(1 - truth))::DOUBLE AS auc FROM q GROUP BY ALL)
  SELECT k, weights, p, round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS std_auc FROM a GROUP BY ALL"""


@query("knn_grid", GRID_SQL)
def knn_grid(spark, d):
    rows = time_series_folds(_features(spark, d), ["fecha", "subtema", "sector"])
    return rounded(N.knn_grid_search(materialize(rows), NUMERIC, ["sector"], "subtema", "A"))


GUESS_SQL = "g AS (SELECT l_linestatus AS truth, CASE WHEN l_quantity > 25 THEN 'F' WHEN l_quantity > 2 THEN 'O' ELSE 'X' END AS pred FROM lineitem)"
CLASS_SQL = f"""{GUESS_SQL}, c AS (SELECT truth, pred, count(*) AS n FROM g GROUP BY ALL),
  k AS (SELECT DISTINCT truth AS label FROM c UNION SELECT DISTINCT pred FROM c),
  p AS (SELECT label, coalesce((SELECT sum(n) FROM c WHERE truth = label), 0)::BIGINT AS support, coalesce((SELECT sum(n) FROM c WHERE pred = label), 0)::BIGINT AS predicted,
    coalesce((SELECT sum(n) FROM c WHERE pred = label AND truth = label), 0)::BIGINT AS hits FROM k)"""


def _guess(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select(F.col("l_linestatus").alias("truth"), F.when(q > 25, "F").when(q > 2, "O").otherwise("X").alias("pred"))


@query("confusion_matrix", f"""WITH {GUESS_SQL}, l AS (SELECT * FROM (VALUES (0, 'F'), (1, 'O'), (2, 'X')) t(i, x))
  SELECT a.i::INT AS row, b.i::INT AS col, a.x AS truth, b.x AS predicted, (SELECT count(*) FROM g WHERE truth = a.x AND pred = b.x) AS count FROM l a, l b""")
def confusion_matrix(spark, d):
    return M.confusion_matrix(_guess(spark, d), "truth", "pred", ["F", "O", "X"])


@query("classification_metrics", f"""WITH {CLASS_SQL} SELECT 'accuracy' AS metric, round(sum(hits) / sum(support), 6) AS value FROM p
  UNION ALL SELECT 'balanced_accuracy', round(avg(hits / support) FILTER (support > 0), 6) FROM p
  UNION ALL SELECT 'f1_' || label, round(2 * hits / (support + predicted), 6) FROM p""")
def classification_metrics(spark, d):
    return rounded(M.classification_metrics(_guess(spark, d), "truth", "pred"))


@query("classification_report", f"""WITH {CLASS_SQL}, m AS (SELECT label, coalesce(hits / nullif(predicted, 0), 0) AS precision,
    coalesce(hits / nullif(support, 0), 0) AS recall, coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f1, support FROM p)
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM m
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM m""")
def classification_report(spark, d):
    return rounded(M.classification_report(_guess(spark, d), "truth", "pred"))


def _scored(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", (F.col("l_linestatus") == "F").cast("int").alias("truth"),
                                              F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("price"))


@query("roc_curve", """WITH s AS (SELECT l_quantity AS q, count(*) FILTER (l_linestatus = 'F') AS pos, count(*) FILTER (l_linestatus <> 'F') AS neg FROM lineitem GROUP BY 1),
  c AS (SELECT q, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS i FROM s
    WINDOW w AS (ORDER BY q DESC)), t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s)
  SELECT round(q, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c, t WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg
  UNION ALL SELECT 'inf'::DOUBLE, 0::DOUBLE, 0::DOUBLE""")
def roc_curve(spark, d):
    curve = M.roc_curve(_scored(spark, d), "truth", "q")
    return curve.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query("roc_auc", """WITH t AS (SELECT l_returnflag, (l_linestatus = 'F')::INT AS y, l_extendedprice AS s FROM lineitem),
  k AS (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY s) + (count(*) OVER (PARTITION BY l_returnflag, s) - 1) / 2.0::DOUBLE AS rk FROM t),
  u AS (SELECT l_returnflag, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n, sum(rk * y) AS r FROM k GROUP BY 1)
  SELECT l_returnflag, round((r - p * (p + 1) / 2) / (p * n), 6) AS auc FROM u""")
def roc_auc(spark, d):
    return rounded(M.roc_auc(_scored(spark, d), "truth", "price", ["l_returnflag"]))


E_SQL = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)"
CENTRE_SQL = f"""{E_SQL}, u AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM e),
  dims AS (SELECT label, j, count(*) AS n, avg(v) AS m, var_pop(v) * count(*) AS w FROM u GROUP BY ALL),
  centre AS (SELECT label, any_value(n) AS n, sum(w) AS within, list(m ORDER BY j) AS c FROM dims GROUP BY 1)"""


@query("silhouette", f"""WITH {E_SQL}, p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM e a, e b GROUP BY ALL),
  m AS (SELECT id, max(s / nullif(n - 1, 0)) FILTER (own = other) AS a, min(s / n) FILTER (own <> other) AS b FROM p GROUP BY 1)
  SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM m""")
def silhouette(spark, d):
    return rounded(C.silhouette(_points(spark, d), "vec_id", "x", "label"))


@query("silhouette_linear", f"""WITH {E_SQL}, p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x) ** 2) AS s, count(*) AS n
    FROM e a, e b GROUP BY ALL),
  m AS (SELECT id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM p GROUP BY id)
  SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM m""")
def silhouette_linear(spark, d):
    return rounded(C.silhouette_linear(_points(spark, d), "x", "label"))


@query("calinski_harabasz", f"""WITH {CENTRE_SQL}, g AS (SELECT j, avg(v) AS g FROM u GROUP BY 1),
  b AS (SELECT sum(n * (m - g) ** 2) AS b FROM dims JOIN g USING (j)), t AS (SELECT sum(n) AS n, count(*) AS k, sum(within) AS w FROM centre)
  SELECT round(b * (n - k) / (w * (k - 1)), 6) AS calinski_harabasz FROM b, t""")
def calinski_harabasz(spark, d):
    return rounded(C.calinski_harabasz(_points(spark, d), "x", "label"))


@query("davies_bouldin", f"""WITH {CENTRE_SQL}, s AS (SELECT e.label, any_value(c) AS c, avg(list_distance(x, c)) AS s FROM e JOIN centre USING (label) GROUP BY 1),
  p AS (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM s a JOIN s b ON a.label <> b.label GROUP BY 1)
  SELECT round(avg(worst), 6) AS davies_bouldin FROM p""")
def davies_bouldin(spark, d):
    return rounded(C.davies_bouldin(_points(spark, d), "x", "label"))


@query("assign_to_centres", f"""WITH {CENTRE_SQL}, p AS (SELECT vec_id, e.label, centre.label AS cluster,
    row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(x, c), centre.label) AS i FROM e, centre)
  SELECT vec_id, label, cluster FROM p WHERE i = 1""")
def assign_to_centres(spark, d):
    points = _points(spark, d)
    centres = C.cluster_spreads(points, "x", "label").select("cluster", F.col("centre").alias("x"))
    return C.assign_to_centres(points, centres).select("vec_id", "label", "cluster")


CROSS_SQL = """x AS (SELECT l_returnflag AS a, l_linestatus || CASE WHEN l_quantity > 25 THEN 'h' ELSE 'l' END AS b FROM lineitem),
  c AS (SELECT a, b, count(*)::DOUBLE AS n FROM x GROUP BY ALL), ra AS (SELECT a, sum(n) AS n FROM c GROUP BY 1), rb AS (SELECT b, sum(n) AS n FROM c GROUP BY 1),
  t AS (SELECT sum(n) AS n FROM c)"""
INFO_SQL = f"""{CROSS_SQL}, h AS (SELECT t.n, ln(t.n) - (SELECT sum(n * ln(n)) FROM ra) / t.n AS ha, ln(t.n) - (SELECT sum(n * ln(n)) FROM rb) / t.n AS hb,
    ln(t.n) - (SELECT sum(n * ln(n)) FROM c) / t.n AS hj FROM t), mi AS (SELECT *, greatest(ha + hb - hj, 0) AS mi FROM h)"""


def _partitions(spark, d):
    half = F.when(F.col("l_quantity") > 25, "h").otherwise("l")
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("truth"), F.concat("l_linestatus", half).alias("cluster"))


@query("adjusted_rand", f"""WITH {CROSS_SQL}, s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS ij, (SELECT sum(n * (n - 1) / 2) FROM ra) AS i,
    (SELECT sum(n * (n - 1) / 2) FROM rb) AS j, n * (n - 1) / 2 AS all_ FROM t)
  SELECT {r('(ij - i * j / all_) / ((i + j) / 2 - i * j / all_)', 8)} AS adjusted_rand FROM s""")
def adjusted_rand(spark, d):
    return rounded(C.adjusted_rand(_partitions(spark, d), "truth", "cluster"), 8)


@query("adjusted_mutual_info", f"""WITH {INFO_SQL}, pairs AS (SELECT ra.n AS a, rb.n AS b, t.n AS n FROM ra, rb, t),
  terms AS (SELECT a, b, n, unnest(range(greatest(1, a + b - n)::BIGINT, least(a, b)::BIGINT + 1))::DOUBLE AS k FROM pairs),
  emi AS (SELECT sum(k / n * ln(n * k / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(n - a + 1) + lgamma(n - b + 1) - lgamma(n + 1)
    - lgamma(k + 1) - lgamma(a - k + 1) - lgamma(b - k + 1) - lgamma(n - a - b + k + 1))) AS e FROM terms)
  SELECT {r('(mi - e) / ((ha + hb) / 2 - e)', 7)} AS adjusted_mutual_info FROM mi, emi""")
def adjusted_mutual_info(spark, d):
    return rounded(C.adjusted_mutual_info(_partitions(spark, d), "truth", "cluster"), 7)


@query("v_measure", f"""WITH {INFO_SQL}, p AS (SELECT mi / ha AS homogeneity, mi / hb AS completeness FROM mi)
  SELECT {r('homogeneity', 8)} AS homogeneity, {r('completeness', 8)} AS completeness,
    {r('2 * homogeneity * completeness / (homogeneity + completeness)', 8)} AS v_measure FROM p""")
def v_measure(spark, d):
    return rounded(C.v_measure(_partitions(spark, d), "truth", "cluster"), 8)


def _prepared(spark, d):
    rows = _features(spark, d)
    train, test = temporal_split(rows, LINEITEM_HOLDOUT)
    prep = Preprocessor(NUMERIC, ["subtema", "sector"]).fit(train)
    return prep.transform(train), prep.transform(test)


POINTS_SQL = points_sql(NUMERIC, _Z)
WIDTH = len(NUMERIC) + 5


@query("kmeans_select", select_sql(POINTS_SQL, WIDTH, DEFAULTS.cluster_k))
def kmeans_select(spark, d):
    train, _ = _prepared(spark, d)
    return rounded(C.kmeans_select(train))


@query("kmeans_assign", f"""WITH {POINTS_SQL}, {kmeans_sql(WIDTH, [4])}, {assigned_sql()}
  SELECT id, fecha, subtema, sector, sexenio, {', '.join(f'{r(c)} AS {c}' for c in NUMERIC)}, cluster FROM g""")
def kmeans_assign(spark, d):
    train, test = _prepared(spark, d)
    model = C.kmeans_fit(train, 4)
    both = C.assign(train, model).unionByName(C.assign(test, model))
    return rounded(both.select("id", "fecha", "subtema", "sector", "sexenio", *NUMERIC, "cluster"))


@query("cluster_summary", summary_sql(POINTS_SQL, WIDTH, 4))
def cluster_summary(spark, d):
    train, test = _prepared(spark, d)
    model = C.kmeans_fit(train, 4)
    parts = {n: C.assign(p, model).withColumn("x", vector_to_array("features")) for n, p in (("train", train), ("test", test))}
    return rounded(C.cluster_summary(parts, "sexenio"))


@query("pca_2d", pca_sql(POINTS_SQL))
def pca_2d(spark, d):
    train, test = _prepared(spark, d)
    return rounded(C.pca_2d(train, test).select("id", "pc1", "pc2", "explained"))
