import math
import random
import unicodedata
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS, MONTHS_ES
from panelkit.functions import dates as D
from panelkit.functions import scalars as S
from panelkit.functions import textnorm as X
from panelkit.operators import panel as P


def test_month_numbers_and_unmapped(spark):
    df = spark.createDataFrame([(n,) for n in [*MONTHS_ES, "Setiembre", None]], "mes string")
    got = [r.n for r in df.select(D.month_number("mes").alias("n")).collect()]
    assert got == [*range(1, 13), None, None]
    with pytest.raises(Exception, match="unmapped month"):
        df.select(D.month_number("mes", on_unmapped="raise")).collect()


def test_month_date_strict_and_lenient(spark):
    df = spark.createDataFrame([(2019, 2), (2019, 13), (None, 1)], "y int, m int")
    assert [r.d for r in df.select(D.month_date("y", "m", strict=False).alias("d")).collect()] == [date(2019, 2, 1), None, None]
    with pytest.raises(Exception):
        df.select(D.month_date("y", "m").alias("d")).collect()


def test_clean_facts_checks_rows_outside_the_range(spark):
    good = spark.createDataFrame([(2012, "Noviembre"), (2012, "Diciembre"), (2024, "Septiembre"), (2024, "Octubre")], "ciclo int, mes string")
    assert {r.fecha for r in P.clean_facts(good).collect()} == {date(2012, 12, 1), date(2024, 9, 1)}
    bad = good.union(spark.createDataFrame([(1999, "Setiembre")], good.schema))
    with pytest.raises(Exception, match="unmapped month"):
        P.clean_facts(bad).collect()
    kept = P.prepare_facts(bad.withColumn("monto", F.lit("1")))
    assert kept.count() == 4
    with pytest.raises(ValueError, match="monto"):
        P.prepare_facts(bad)


def test_prepare_drops_what_is_no_number(spark):
    df = spark.createDataFrame([(2019, "Enero", v) for v in ("1.5", "n/d", "", None, "NaN", "-4.653e8")], "ciclo int, mes string, monto string")
    assert sorted(r.monto for r in P.prepare_facts(df).collect()) == [-4.653e8, 1.5]
    assert P.prepare_facts(df, years=(2020, 2021)).count() == 0


def test_resolve_date_branches(spark):
    day_first = spark.createDataFrame([("13/02/2019",), ("14/02/2019",), ("01/03/2019",)], "fecha string")
    assert {r.fecha for r in D.resolve_date(day_first).collect()} == {date(2019, 2, 1), date(2019, 3, 1)}
    mostly_fine = spark.createDataFrame([("2019-02-13",)] * 9 + [("x",)], "fecha string")
    assert D.resolve_date(mostly_fine).count() == 9
    period = spark.createDataFrame([("2019-03",), ("2019-13",), (None,)], "periodo_inicio string")
    assert [r.fecha for r in D.resolve_date(period).collect()] == [date(2019, 3, 1)]
    built = spark.createDataFrame([(2019, "Marzo"), (2019, "Setiembre")], "ciclo int, mes string")
    assert [r.fecha for r in D.resolve_date(built).collect()] == [date(2019, 3, 1)]
    with pytest.raises(ValueError):
        D.resolve_date(spark.createDataFrame([(1,)], "x int"))


def test_eras_and_relative_month(spark):
    days = [date(2012, 11, 1), date(2012, 12, 1), date(2013, 11, 1), date(2018, 11, 1), date(2018, 12, 1), date(2019, 11, 1), date(2019, 12, 1)]
    df = spark.createDataFrame([(d,) for d in days], "fecha date")
    era = [r.e for r in df.select(D.label_era("fecha").alias("e")).collect()]
    assert era == [DEFAULTS.era_before] * 4 + [DEFAULTS.era_after] * 3
    label = D.label_ranges("fecha")
    got = df.withColumn("l", label).withColumn("m", D.relative_month("fecha", D.range_start("l"))).collect()
    assert [r.l is None for r in got] == [True, False, False, True, False, False, True]
    assert [r.m for r in got if r.l] == [1, 12, 1, 12]


def test_asinh_is_exact_for_large_negatives(spark):
    xs = [-4.653e8, -1e6, -1.0, 0.0, 1e-9, 1.06e9]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(S.asinh("x").alias("a"), S.sinh(S.asinh("x")).alias("b")).collect()
    assert np.allclose([r.a for r in got], np.arcsinh(xs), rtol=1e-13)
    assert np.allclose([r.b for r in got], xs, rtol=1e-9)


def test_labels_codec(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "c string").withColumn("n", S.encode_label("c", "B"))
    out = df.select("n", S.decode_label("n", "A", "B").alias("back"), S.is_correct("c", F.lit("A")).alias("ok")).collect()
    assert [(r.n, r.back, r.ok) for r in out] == [(0, "A", 1), (1, "B", 0), (None, None, None)]


PLAIN = {"Año": "Ano", "ÇÜñ": "CUn", "Łø": "Łø", "ﬁscal": "fiscal", "½": "1⁄2", "²": "2", "Ⅻ": "XII", "①": "1", "ﬃ": "ffi", "Œßœ": "Œßœ", "İ": "I", "ſ": "s",
         "é": "e", "℃": "°C", "№": "No", "ªº": "ao", "…": "...", "９": "9", "𝐀": "A", "Й": "И", "Ώ": "Ω", "日本": "日本", "가": "\u1100\u1161", "한": "\u1112\u1161\u11ab",
         "": "", "plain": "plain", "\u0301": ""}
NORMAL = {"Año ﬁscal, 2019: ¡pesos!": "ano fiscal pesos", "  ": "", "": "", "A_b--C": "a_b c", "x1y22z": "x y z", "¿Qué?\n\tÑu": "que nu", "ÉÉ é": "ee e",
          "a…b": "a b", "№5": "No", "٣x": "x", "naïve Ⅻ": "naive xii", "🙂ok🙂": "ok", "“quoted”—text": "quoted text"}


def test_accents_and_normal_form_of_known_texts(spark):
    for table, fn in ((PLAIN, X.strip_accents), (NORMAL, X.normalize_text)):
        df = spark.createDataFrame([(k, v) for k, v in table.items()], "t string, want string")
        assert [(r.t, r.got) for r in df.select("t", fn("t").alias("got"), "want").where("got <> want").collect()] == []
    null = spark.createDataFrame([(None,)], "t string").select(X.strip_accents("t").alias("s"), X.normalize_text("t").alias("n")).first()
    assert null.s is None and null.n == ""


def test_normal_form_holds_only_letters_and_single_spaces(spark):
    rng = random.Random(1)
    alphabet = "aáñüÇŁøßœﬁﬃ½²Ⅻ①한글가힣日本語ЖйΆώ ١٢٣__--..,;!?\t\n  “”…—ªº№℃İıſ éñ𝐀𝒷🙂９"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for r in df.select("t", X.strip_accents("t").alias("s"), X.normalize_text("t").alias("n")).collect():
        assert not any(unicodedata.combining(c) for c in r.s) and len(r.s) >= sum(c.isascii() for c in r.t)
        assert r.n == r.n.strip() and "  " not in r.n
        assert all(c in " _" or unicodedata.category(c)[0] == "L" or unicodedata.category(c) in ("Nl", "No") for c in r.n)
    capital = [c for c in alphabet if (d := unicodedata.normalize("NFKD", c.lower())) != d.lower()]  # such a character becomes a capital after lower case
    assert "№" in capital
    once = df.where(~F.col("t").rlike(f"[{''.join(capital)}]")).select(X.normalize_text("t").alias("n"))
    assert once.count() > 50 and once.select("n", X.normalize_text("n").alias("twice")).where("n <> twice").isEmpty()


def test_tokens_stopwords_slug_join(spark):
    df = spark.createDataFrame([("la deuda de pemex y_z a no x deuda", "Peña Nieto (Dic)", None)], "t string, s string, u string")
    r = df.select(X.kept_tokens("t", {"la", "de", "no"}).alias("k"), X.remove_stopwords("t", {"la", "de", "no"}).alias("r"),
                  X.slug("s").alias("g"), X.join_text(["s", "u"], "nan").alias("j"), X.join_text(["u", "s"]).alias("e"),
                  X.tokens("t").alias("w")).first()
    assert r.k == ["deuda", "pemex", "y_z", "deuda"]
    assert r.r == "deuda pemex y_z a x deuda"
    assert r.g == "pena_nieto_dic"
    assert r.j == "Peña Nieto (Dic) nan" and r.e == " Peña Nieto (Dic)"
    assert r.w == ["la", "deuda", "de", "pemex", "y_z", "no", "deuda"]


def test_seasonality_period(spark):
    df = spark.createDataFrame([(date(2020, m, 1),) for m in range(1, 13)], "fecha date")
    got = P.add_seasonality(df).orderBy("fecha").collect()
    for r in got:
        assert math.isclose(r.sin12, math.sin(2 * math.pi * r.mes / 12), abs_tol=1e-12)
        assert math.isclose(r.cos12, math.cos(2 * math.pi * r.mes / 12), abs_tol=1e-12)


def test_between_dates_reaches_the_scan(spark, tmp_path):
    spark.range(100).select(F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(int(id))").alias("ts")).write.parquet(str(tmp_path / "t"))
    kept = D.between_dates(spark.read.parquet(str(tmp_path / "t")), "ts", date(2020, 1, 11), date(2020, 1, 20))
    assert kept.count() == 10
    assert "GreaterThanOrEqual(ts" in kept._jdf.queryExecution().executedPlan().toString()
