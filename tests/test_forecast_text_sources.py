from collections import Counter
from datetime import date

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import norm
from panelkit.operators import forecast as FC
from panelkit.operators import terms as T
from panelkit.operators.panel import monthly_panel
from panelkit.session import checkpoint_dir
from panelkit.sources import tables as S


def _months(n, start=2018):
    return [date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def _series(n=48, seed=0, gap=None):
    rng = np.random.default_rng(seed)
    months = _months(n)
    y = [1000 * (5 + 0.05 * i + np.sin(2 * np.pi * m.month / 12)) + rng.normal(0, 50) for i, m in enumerate(months)]
    return [(m, float(v)) for i, (m, v) in enumerate(zip(months, y)) if i != gap]


def _row(m, i, hist):
    prev, year = m.year * 12 + m.month - 1, m.year * 12 + m.month - 12
    return [1.0, i, np.sin(2 * np.pi * m.month / 12), np.cos(2 * np.pi * m.month / 12), hist.get(prev), hist.get(year)]


def _reference(series, holdout, horizon, history):
    """Plain loop over one series."""
    idx = lambda m: m.year * 12 + m.month
    y = {idx(m): float(np.arcsinh(v)) for m, v in series}
    first, out = min(y), {}
    usable = [m for m, _ in series if None not in _row(m, 0, y)]
    train, test = [m for m in usable if m < holdout], [m for m in usable if m >= holdout]
    x = np.array([_row(m, idx(m) - first, y) for m in train])
    coef = np.linalg.lstsq(x, np.array([y[idx(m)] for m in train]), rcond=None)[0]
    out.update({m: float(r @ coef) for m, r in zip(train, x)})

    def walk(dates, hist):
        for m in dates:
            r = _row(m, idx(m) - first, hist)
            out[m] = None if None in r else float(np.array(r) @ coef)
            if out[m] is not None:
                hist[idx(m)] = out[m]

    known = {k: v for k, v in y.items() if k <= idx(train[-1])}
    walk(test, dict(known))
    last = max(m for m, _ in series)
    ahead = [date(last.year + (last.month - 1 + i) // 12, (last.month - 1 + i) % 12 + 1, 1) for i in range(1, horizon + 1)]
    walk(ahead, dict(y if history == "all" else known))
    return out


@pytest.mark.parametrize("keys,gap,history", [((), None, "all"), (("k",), None, "all"), (("k",), 30, "all"), ((), None, "train"), (("k",), 41, "train")])
def test_forecast_table_matches_a_plain_loop(spark, keys, gap, history):
    data = {"a": _series(seed=1, gap=gap)} if not keys else {"a": _series(seed=1, gap=gap), "b": _series(60, seed=2)}
    df = spark.createDataFrame([(k, m, v) for k, s in data.items() for m, v in s], "k string, fecha date, monto double")
    got = FC.forecast_table(monthly_panel(df, keys), keys, holdout_start=date(2021, 1, 1), horizon=14, history=history).toPandas()
    for k, series in data.items():
        part = got[got.k == k] if keys else got
        want = _reference(series, date(2021, 1, 1), 14, history)
        assert len(part) == len(series) + 14
        for r in part.itertuples():
            expected = want.get(r.fecha)
            if expected is None:
                assert pd.isna(r.yhat_asinh) and pd.isna(r.yhat)
            else:
                assert np.isclose(r.yhat_asinh, expected, rtol=1e-6) and np.isclose(r.yhat, np.sinh(expected), rtol=1e-4)
        assert set(part.split) == {"train", "test", "forecast"}
        assert part[part.fecha < date(2021, 1, 1)].split.eq("train").all()
    if history == "train":
        assert got[got.split == "forecast"].yhat.isna().all()


def test_future_months_cross_the_year(spark):
    got = spark.createDataFrame([(date(2021, 11, 1),)], "d date").select(FC.future_months(F.col("d"), 3).alias("m")).first().m
    assert got == [date(2021, 12, 1), date(2022, 1, 1), date(2022, 2, 1)]


TEXTS = ["La deuda pública de PEMEX creció", "La deuda pública de PEMEX creció", "deuda deuda externa", "x y deuda 2019", "", None, "aportaciones y_b aportaciones"]


def _count(texts, stop, n, min_df, min_len=2, floor="documents"):
    tf, df = Counter(), Counter()
    for t in texts:
        words = [w for w in norm(t or "").split() if len(w) >= min_len and w not in stop]
        grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        tf.update(grams)
        df.update(set(grams))
    return {g: (c, df[g]) for g, c in tf.items() if (df[g] if floor == "documents" else c) >= min_df}


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("n,min_df,floor,min_len", [(1, 1, "documents", 2), (2, 1, "documents", 2), (3, 1, "documents", 2), (1, 2, "documents", 2), (1, 2, "total", 3)])
def test_term_frequencies(spark, collapse, n, min_df, floor, min_len):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    stop = {"la", "de"}
    got = T.term_freq(T.corpus(df, ["t"], collapse=collapse), n=n, min_df=min_df, stopwords=stop, floor=floor, min_len=min_len)
    assert {r.term: (r.freq, r.doc_freq) for r in got.collect()} == _count(TEXTS, stop, n, min_df, min_len, floor)


def test_slices_and_caps(spark):
    df = spark.createDataFrame([("s1", "uno dos"), ("s1", "uno tres"), ("s2", "dos"), (None, "nada")], "g string, t string")
    freq = T.term_freq(T.corpus(df, ["t"], ["g"], collapse=False), by=["g"], min_df=1, stopwords=())
    assert {(r.g, r.term) for r in T.top_terms(freq, 1, ["g"]).collect()} == {("s1", "uno"), ("s2", "dos")}
    assert [r.term for r in T.top_terms(freq.where("g = 's1'"), 2).collect()] == ["uno", "dos"]
    w = {(r.g, r.term): r.weight for r in T.cloud_weights(freq, 10, ["g"]).collect()}
    assert np.isclose(w[("s1", "uno")], 60) and np.isclose(w[("s1", "dos")], 10) and np.isclose(w[("s2", "dos")], 10)


def test_tasks_send_one_row_per_slice_and_term():
    rng = np.random.default_rng(3)
    vocabulary = ["a", "la", "uno", "dos", "tres", "ñu", "y_b", "𝒳𝒳"]
    rows = [(g, w, " ".join(rng.choice(vocabulary, int(k)))) for g, w, k in zip(rng.choice(["p", "q", None], 300), rng.integers(1, 3, 300).tolist(), rng.integers(0, 12, 300))]
    rows += [("p", 1, None), ("p", 1, " uno  dos "), ("q", 2, "la")]
    table = pa.table({"g": pa.array([r[0] for r in rows]), "w": [r[1] for r in rows], "t": pa.array([r[2] for r in rows])})
    tf, df = Counter(), Counter()
    for g, w, t in rows:
        words = [x for x in (t or "").split() if len(x) >= 2 and x != "la"]
        grams = [(g, w, n, " ".join(words[i:i + n])) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1)]
        tf.update(grams)
        df.update(set(grams))
    pieces = list(T._pieces(table.to_batches(max_chunksize=7)))
    assert len(pieces) == 1
    got = [tuple(r.values()) for batch in T._count_terms(pieces[0], (1, 2, 3, 4), pa.array(["la"]), 2) for r in batch.to_pylist()]
    assert len(got) == len(tf) and {r[:4]: r[4:] for r in got} == {k: (c, df[k]) for k, c in tf.items()}


def test_pieces_keep_every_text_once(monkeypatch):
    monkeypatch.setattr(T, "PIECE_BYTES", 10)
    texts = ["a" * k for k in (3, 0, 4, 5, 25, 1, 1, 9, 10, 2)] + [None]
    batch = pa.table({"i": list(range(11)), "t": pa.array(texts)})
    pieces = list(T._pieces(batch.to_batches(max_chunksize=4)))
    assert [i for p in pieces for i in p.column("i").to_pylist()] == [0, 2, 3, 4, 5, 6, 7, 8, 9]
    assert len(pieces) > 3 and all(sum(map(len, p.column("t").to_pylist()[:-1])) <= 10 for p in pieces)


def test_slices_of_any_type_and_weights_of_their_own(spark):
    rows = [(1.5, [1], 2, "uno dos uno"), (1.5, [1], None, "uno"), (float("nan"), [1], 1, "uno"), (0.0, [1], 3, "uno dos"), (-0.0, [1], 4, "uno"), (0.0, [2], 1, ""), (None, [1], 1, "uno")]
    df = spark.createDataFrame(rows, "x double, a array<int>, weight int, texto string")
    got = {(str(r.x), r.a[0], r.n, r.term): (r.freq, r.doc_freq) for r in T.term_freq(df, n=(2, 1), by=["x", "a"], min_df=0, stopwords=()).collect()}
    assert got == {("1.5", 1, 1, "uno"): (4, 2), ("1.5", 1, 1, "dos"): (2, 2), ("1.5", 1, 2, "uno dos"): (2, 2), ("1.5", 1, 2, "dos uno"): (2, 2),
                   ("0.0", 1, 1, "uno"): (7, 7), ("0.0", 1, 1, "dos"): (3, 3), ("0.0", 1, 2, "uno dos"): (3, 3)}


def test_text_column_fallback(spark):
    df = spark.createDataFrame([("a", "b", 1, "c")], "p string, q string, n int, r string")
    assert T.text_columns(df) == ["p", "q", "r"]
    assert T.text_columns(df.withColumnRenamed("q", "sector")) == ["sector"]


def test_csv_round_trip_and_coercion(spark, tmp_path):
    df = spark.createDataFrame([(2019, "Enero", 'a "q", b', 1.5), (2020, "Marzo", None, -2.0)], "ciclo int, mes string, nombre string, monto double")
    path = str(tmp_path / "out")
    S.write_table(df, path, single_file=True)
    back = S.read_facts(spark, path)
    assert dict(back.dtypes) == {"ciclo": "int", "mes": "string", "nombre": "string", "monto": "double"}
    assert {r.monto for r in back.collect()} == {1.5, -2.0}
    assert S.probe_columns(spark, path) == 4
    (tmp_path / "bad.csv").write_text("ciclo,mes,monto\nx,Enero,n/d\n2020,Enero,nan\n2021,Enero,3\n")
    got = S.read_facts(spark, str(tmp_path / "bad.csv")).collect()
    assert [(r.ciclo, r.monto) for r in got] == [(None, None), (2020, None), (2021, 3.0)]
    with pytest.raises(ValueError, match="sector"):
        S.require_columns(back, ["ciclo", "sector"])


def test_encoding_fallback(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("mes,nombre\nEnero,año\n".encode("latin-1"))
    (tmp_path / "u.csv").write_bytes("mes,nombre\nEnero,año\n".encode("utf-8"))
    assert S.read_facts(spark, str(tmp_path / "l.csv")).first().nombre == "año"
    assert S.read_facts(spark, str(tmp_path / "u.csv")).first().nombre == "año"


def test_parquet_and_slices(spark, tmp_path):
    df = spark.createDataFrame([("Peña Nieto", 1), ("AMLO", 2), ("AMLO", 3)], "era string, v int")
    S.write_slices(df, "era", str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["slice=amlo", "slice=pena_nieto"]
    S.write_table(df, str(tmp_path / "t.parquet"), fmt="parquet", partition_by=["era"])
    assert S.read_facts(spark, str(tmp_path / "t.parquet")).count() == 3


def test_checkpoint_folder_is_kept(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
