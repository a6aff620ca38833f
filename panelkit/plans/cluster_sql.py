"""SQL of the clustering queries: k-means from the same start, its quality measures, and principal components."""

from __future__ import annotations

from collections.abc import Sequence

from panelkit.config import DEFAULTS
from panelkit.plans.registry import FEATURES_SQL, r

ROUNDS, SQUARINGS = 40, 12


def points_sql(numeric: Sequence[str], scaled: str) -> str:
    """Scaled and 0/1-coded rows v (id, x, train, ...) as the preprocessor makes them."""
    levels = [f"({c} = '{x}')::INT::DOUBLE" for c, values in (("subtema", "ANR"), ("sector", "FO")) for x in values]
    return f"""{FEATURES_SQL}, z AS (SELECT fecha, subtema, sector, sexenio, {', '.join(numeric)}, concat_ws('|', fecha::VARCHAR, subtema, sector) AS id, {scaled} FROM features),
  v AS MATERIALIZED (SELECT *, fecha < DATE '2000-07-01' AS train, [{', '.join([f'z{i}' for i in range(len(numeric))] + levels)}] AS x FROM z),
  t AS MATERIALIZED (SELECT id, x FROM v WHERE train)"""


def kmeans_sql(width: int, ks: Sequence[int], seed: int = DEFAULTS.seed, rounds: int = ROUNDS) -> str:
    """Centres f (k, l, c) of the rows t for every k, by the same draws and steps."""
    u = lambda step: f"((('0x' || substr(md5('{seed}:{step}:' || id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"
    out = [f"s0 AS MATERIALIZED (SELECT 0 AS l, x AS c FROM t ORDER BY -ln({u(0)}), id LIMIT 1)"]
    for j in range(1, max(ks)):
        taken = " UNION ALL ".join(f"SELECT c FROM s{i}" for i in range(j))
        out.append(f"s{j} AS MATERIALIZED (SELECT {j} AS l, x AS c FROM (SELECT id, any_value(x) AS x, min(list_distance(x, c) ** 2) AS d FROM t, ({taken}) GROUP BY id) "
                   f"WHERE d > 0 ORDER BY -ln({u(j)}) / d, id LIMIT 1)")
    start = " UNION ALL ".join(f"SELECT l, c FROM s{i}" for i in range(max(ks)))
    out.append(f"c0 AS MATERIALIZED (SELECT k, l, c FROM ({start}) JOIN (SELECT unnest([{', '.join(map(str, ks))}]) AS k) ON l < k)")
    for i in range(1, rounds + 1):
        near = f"SELECT k, id, x, l, row_number() OVER (PARTITION BY k, id ORDER BY list_distance(x, c), l) AS i FROM t, c{i - 1}"
        mean = ", ".join(f"avg(a.x[{j}])" for j in range(1, width + 1))
        out.append(f"c{i} AS MATERIALIZED (SELECT c.k, c.l, CASE WHEN count(a.id) = 0 THEN any_value(c.c) ELSE [{mean}] END AS c "
                   f"FROM c{i - 1} c LEFT JOIN ({near} QUALIFY i = 1) a ON a.k = c.k AND a.l = c.l GROUP BY c.k, c.l)")
    out.append(f"f AS MATERIALIZED (SELECT k, row_number() OVER (PARTITION BY k ORDER BY c) - 1 AS l, c FROM c{rounds})")
    return ", ".join(out)


def assigned_sql(rows: str = "v") -> str:
    """g (k, cluster, d, and the columns of ``rows``)."""
    return (f"g AS MATERIALIZED (SELECT {rows}.*, f.k, f.l::INT AS cluster, list_distance({rows}.x, f.c) ** 2 AS d FROM {rows}, f "
            f"QUALIFY row_number() OVER (PARTITION BY f.k, {rows}.id ORDER BY list_distance({rows}.x, f.c), f.l) = 1)")


def _silhouette_sql(by: str) -> str:
    return f"""pairs AS (SELECT a.{by}, a.id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.x, b.x) ** 2) AS s, count(*) AS n FROM g a JOIN g b ON a.{by} = b.{by} GROUP BY ALL),
  near AS (SELECT {by}, id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM pairs GROUP BY ALL),
  sil AS (SELECT {by}, avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM near GROUP BY ALL)"""


def select_sql(points: str, width: int, ks: Sequence[int]) -> str:
    return f"""WITH {points}, {kmeans_sql(width, ks)}, {assigned_sql('t')}, {_silhouette_sql('k')},
  cost AS (SELECT k, sum(d) AS inertia FROM g GROUP BY 1)
  SELECT k, round(inertia, 6) AS inertia, round(silhouette, 6) AS silhouette, k = (SELECT k FROM sil ORDER BY silhouette DESC, k LIMIT 1) AS best FROM cost JOIN sil USING (k)"""


def summary_sql(points: str, width: int, k: int) -> str:
    """All quality measures of both parts, long form."""
    names = ("silhouette", "calinski_harabasz", "davies_bouldin", "adjusted_rand", "adjusted_mutual_info", "v_measure")
    long = " UNION ALL ".join(f"SELECT part, '{n}' AS metric, round({n}, 6) AS value FROM whole" for n in names)
    return f"""WITH {points}, {kmeans_sql(width, [k])}, w AS (SELECT *, CASE WHEN train THEN 'train' ELSE 'test' END AS part, sexenio AS truth FROM v), {assigned_sql('w')},
  {_silhouette_sql('part')},
  u AS (SELECT part, cluster, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM g),
  dims AS (SELECT part, cluster, j, count(*) AS n, avg(e) AS m, var_pop(e) * count(*) AS w FROM u GROUP BY ALL), mid AS (SELECT part, j, avg(e) AS g FROM u GROUP BY ALL),
  centre AS (SELECT part, cluster, any_value(n) AS n, sum(w) AS w, list(m ORDER BY j) AS c FROM dims GROUP BY ALL),
  ch AS (SELECT part, sum(b) * (any_value(n) - any_value(k)) / (any_value(w) * (any_value(k) - 1)) AS calinski_harabasz FROM (SELECT part, dims.n * (m - g) ** 2 AS b FROM dims JOIN mid USING (part, j))
    JOIN (SELECT part, sum(n) AS n, count(*) AS k, sum(w) AS w FROM centre GROUP BY 1) USING (part) GROUP BY 1),
  sp AS (SELECT g.part, g.cluster, any_value(c.c) AS c, avg(list_distance(g.x, c.c)) AS s FROM g JOIN centre c ON c.part = g.part AND c.cluster = g.cluster GROUP BY ALL),
  db AS (SELECT part, avg(worst) AS davies_bouldin FROM (SELECT a.part, a.cluster, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM sp a JOIN sp b ON a.part = b.part AND a.cluster <> b.cluster GROUP BY ALL) GROUP BY 1),
  cells AS (SELECT part, truth, cluster, count(*)::DOUBLE AS n FROM g GROUP BY ALL), ra AS (SELECT part, truth, sum(n) AS n FROM cells GROUP BY ALL),
  rb AS (SELECT part, cluster, sum(n) AS n FROM cells GROUP BY ALL), tot AS (SELECT part, sum(n) AS n FROM cells GROUP BY ALL),
  prs AS (SELECT part, n, n * (n - 1) / 2 AS every, (SELECT sum(n * (n - 1) / 2) FROM cells WHERE part = tot.part) AS ij, (SELECT sum(n * (n - 1) / 2) FROM ra WHERE part = tot.part) AS i,
    (SELECT sum(n * (n - 1) / 2) FROM rb WHERE part = tot.part) AS j, ln(n) - (SELECT sum(n * ln(n)) FROM ra WHERE part = tot.part) / n AS ha,
    ln(n) - (SELECT sum(n * ln(n)) FROM rb WHERE part = tot.part) / n AS hb, ln(n) - (SELECT sum(n * ln(n)) FROM cells WHERE part = tot.part) / n AS hj,
    (SELECT count(*) FROM ra WHERE part = tot.part) AS classes, (SELECT count(*) FROM rb WHERE part = tot.part) AS clusters FROM tot),
  terms AS (SELECT part, ra.n AS a, rb.n AS b, tot.n AS n, unnest(range(greatest(1, ra.n + rb.n - tot.n)::BIGINT, least(ra.n, rb.n)::BIGINT + 1))::DOUBLE AS k FROM ra JOIN rb USING (part) JOIN tot USING (part)),
  emi AS (SELECT part, sum(k / n * ln(n * k / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(n - a + 1) + lgamma(n - b + 1) - lgamma(n + 1)
    - lgamma(k + 1) - lgamma(a - k + 1) - lgamma(b - k + 1) - lgamma(n - a - b + k + 1))) AS e FROM terms GROUP BY 1),
  ext AS (SELECT *, greatest(ha + hb - hj, 0) AS mi, CASE WHEN abs((i + j) / 2 - i * j / every) < 1e-12 THEN 1 ELSE (ij - i * j / every) / ((i + j) / 2 - i * j / every) END AS adjusted_rand FROM prs JOIN emi USING (part)),
  whole AS (SELECT part, silhouette, calinski_harabasz, davies_bouldin, adjusted_rand,
    CASE WHEN classes = 1 AND clusters = 1 THEN 1 ELSE (mi - e) / CASE WHEN (ha + hb) / 2 - e < 0 THEN least((ha + hb) / 2 - e, -2.220446049250313e-16) ELSE greatest((ha + hb) / 2 - e, 2.220446049250313e-16) END END AS adjusted_mutual_info,
    CASE WHEN ha > 0 THEN mi / ha ELSE 1 END AS hom, CASE WHEN hb > 0 THEN mi / hb ELSE 1 END AS com, CASE WHEN hom + com > 0 THEN 2 * hom * com / (hom + com) ELSE 0 END AS v_measure
    FROM ext JOIN sil USING (part) JOIN ch USING (part) JOIN db USING (part))
  {long}"""


def pca_sql(points: str) -> str:
    """First two principal components of the rows t, applied to the other rows of v."""
    out = ["mu AS (SELECT j, avg(e) AS m FROM (SELECT unnest(x) AS e, generate_subscripts(x, 1) AS j FROM t) GROUP BY 1)",
           "dev AS MATERIALIZED (SELECT id, j, e - m AS e FROM (SELECT id, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM t) JOIN mu USING (j))",
           "cov1 AS MATERIALIZED (SELECT a.j AS i, b.j AS j, sum(a.e * b.e) / (SELECT count(*) - 1 FROM t) AS v FROM dev a JOIN dev b USING (id) GROUP BY ALL)"]
    for k in (1, 2):
        out.append(f"p{k}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM cov{k} WHERE i = j) AS v FROM cov{k})")
        for s in range(1, SQUARINGS + 1):
            out.append(f"q{k}_{s} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM p{k}_{s - 1} a JOIN p{k}_{s - 1} b ON a.j = b.i GROUP BY ALL)")
            out.append(f"p{k}_{s} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM q{k}_{s} WHERE i = j) AS v FROM q{k}_{s})")
        out.append(f"e{k} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) * sign(max_by(v, abs(v)) OVER ()) AS v FROM p{k}_{SQUARINGS} "
                   f"WHERE j = (SELECT j FROM p{k}_{SQUARINGS} WHERE i = j ORDER BY v DESC, j LIMIT 1))")
        out.append(f"l{k} AS MATERIALIZED (SELECT sum(a.v * c.v * b.v) AS l FROM e{k} a JOIN cov{k} c ON c.i = a.i JOIN e{k} b ON b.i = c.j)")
        if k == 1:
            out.append("cov2 AS MATERIALIZED (SELECT c.i, c.j, c.v - l * a.v * b.v AS v FROM cov1 c JOIN e1 a ON a.i = c.i JOIN e1 b ON b.i = c.j, l1)")
    cells = "(SELECT id, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM v WHERE NOT train)"
    return f"""WITH {points}, {', '.join(out)}
  SELECT id, {r('sum((e - m) * e1.v)')} AS pc1, {r('sum((e - m) * e2.v)')} AS pc2, 
    round(((SELECT l FROM l1) + (SELECT l FROM l2)) / (SELECT sum(v) FROM cov1 WHERE i = j), 6) AS explained
  FROM {cells} w JOIN mu ON mu.j = w.i JOIN e1 USING (i) JOIN e2 USING (i) GROUP BY id"""
