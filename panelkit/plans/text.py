"""Text normalisation and term frequencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions import textnorm as X
from panelkit.functions.scalars import display_weight
from panelkit.operators import terms as T
from panelkit.plans.registry import query, r, rounded
from panelkit.session import spread
from panelkit.sources.adapters import table

STOP = sorted(DEFAULTS.stopwords)
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def _norm_sql(text: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({text})), '[^\\p{{L}}\\p{{Nl}}\\p{{No}}_]+', ' ', 'g'))"


def _kept_sql(norm: str, min_len: int = 2) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda w: length(w) >= {min_len} AND NOT list_contains({STOP_SQL}, w))"


def _freq_sql(n: int = 1, by: str = "", floor: str = "df", min_df: int = DEFAULTS.min_df, min_len: int = 2) -> str:
    """CTEs ending in ``freq`` (by, term, freq, doc_freq) over all documents."""
    key = f"{by}, " if by else ""
    grams = "k" if n == 1 else "list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])"
    return f"""kept AS MATERIALIZED (SELECT doc_id, {key}{_kept_sql(_norm_sql('text'), min_len)} AS k FROM documents),
      words AS (SELECT doc_id, {key}unnest({grams}) AS term FROM kept),
      freq AS (SELECT {key}term, count(*) AS freq, count(DISTINCT doc_id) AS doc_freq FROM words GROUP BY ALL
        HAVING {'count(DISTINCT doc_id)' if floor == 'df' else 'count(*)'} >= {min_df})"""


def _documents(spark, d, *columns):
    return spread(table(spark, d, "documents").select(*columns, "text"))


def _corpus(spark, d, keep=()):
    return T.corpus(table(spark, d, "documents"), ["text"], keep, collapse=False)


@query("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def strip_accents(spark, d):
    return _documents(spark, d, "doc_id").select("doc_id", F.md5(X.strip_accents("text").cast("binary")).alias("plain"))


@query("normalize_text", f"SELECT doc_id, length({_norm_sql('text')}) AS n, md5({_norm_sql('text')}) AS texto FROM documents")
def normalize_text(spark, d):
    norm = _documents(spark, d, "doc_id").select("doc_id", X.normalize_text("text").alias("texto"))
    return norm.select("doc_id", F.length("texto").cast("long").alias("n"), F.md5(F.col("texto").cast("binary")).alias("texto"))


@query("remove_stopwords", f"""SELECT doc_id, md5(array_to_string(list_filter(string_split({_norm_sql('text')}, ' '),
  lambda w: NOT list_contains({STOP_SQL}, w)), ' ')) AS texto FROM documents""")
def remove_stopwords(spark, d):
    kept = X.remove_stopwords(X.normalize_text("text"), STOP)
    return _documents(spark, d, "doc_id").select("doc_id", F.md5(kept.cast("binary")).alias("texto"))


@query("join_text", """SELECT d.doc_id, concat_ws(' ', d.lang, d.source, coalesce(l.quality::VARCHAR, 'nan')) AS texto
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_text(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", X.join_text(["lang", "source", "quality"], null_text="nan").alias("texto"))


@query("slug", """SELECT conv_id, turn, trim(lower(strip_accents(regexp_replace(text, '[^\\p{L}\\p{N}_]+', '_', 'g'))), '_') AS slug FROM conversations""")
def slug(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", X.slug("text").alias("slug"))


@query("tokens", f"""WITH t AS (SELECT lang, regexp_extract_all({_norm_sql('text')}, '[\\p{{L}}\\p{{N}}_]{{2,}}') AS k FROM documents)
  SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest(k) AS token FROM t) GROUP BY ALL""")
def tokens(spark, d):
    words = _documents(spark, d, "lang").select("lang", F.explode(X.tokens(X.normalize_text("text"))).alias("token"))
    return words.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))


@query("unigrams", f"WITH {_freq_sql()} SELECT term, freq, doc_freq FROM freq")
def unigrams(spark, d):
    return T.term_freq(_corpus(spark, d))


@query("bigrams", f"WITH {_freq_sql(2)} SELECT term, freq, doc_freq FROM freq")
def bigrams(spark, d):
    return T.term_freq(_corpus(spark, d), n=2)


@query("unigrams_total_floor", f"WITH {_freq_sql(floor='total', min_len=3)} SELECT term, freq, doc_freq FROM freq")
def unigrams_total_floor(spark, d):
    return T.term_freq(_corpus(spark, d), floor="total", min_len=3)


@query("vocab_cap", f"WITH {_freq_sql()} SELECT term, freq, doc_freq FROM freq ORDER BY freq DESC, term LIMIT {DEFAULTS.max_features}")
def vocab_cap(spark, d):
    return T.top_terms(T.term_freq(_corpus(spark, d)), DEFAULTS.max_features)


def _renamed(freq: str, n: int) -> str:
    """CTEs of one n-gram length under their own names."""
    for name in ("kept", "words", "freq"):
        freq = freq.replace(f"{name} AS", f"{name}{n} AS").replace(f"FROM {name}", f"FROM {name}{n}")
    return freq


def _top_sql(n: int) -> str:
    return f"SELECT {n} AS n, term, freq, doc_freq FROM (SELECT * FROM freq{n} ORDER BY freq DESC, term LIMIT {DEFAULTS.top_terms})"


@query("top_terms_global", f"WITH {_renamed(_freq_sql(1), 1)}, {_renamed(_freq_sql(2), 2)} {_top_sql(1)} UNION ALL {_top_sql(2)}")
def top_terms_global(spark, d):
    freq = T.term_freq(_corpus(spark, d), n=(1, 2))
    return T.top_terms(freq, DEFAULTS.top_terms, ["n"])


@query("top_terms_by_era", f"""WITH {_freq_sql(by='lang', min_df=DEFAULTS.slice_min_df)} SELECT lang, term, freq, doc_freq FROM freq
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY freq DESC, term) <= {DEFAULTS.top_terms}""")
def top_terms_by_era(spark, d):
    freq = T.term_freq(_corpus(spark, d, ["lang"]), by=["lang"], min_df=DEFAULTS.slice_min_df)
    return T.top_terms(freq, DEFAULTS.top_terms, ["lang"])


@query("top_bigrams_by_era", f"""WITH {_freq_sql(2, by='lang', min_df=DEFAULTS.slice_min_df)} SELECT lang, term, freq, doc_freq FROM freq
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY freq DESC, term) <= {DEFAULTS.top_terms}""")
def top_bigrams_by_era(spark, d):
    freq = T.term_freq(_corpus(spark, d, ["lang"]), n=2, by=["lang"], min_df=DEFAULTS.slice_min_df)
    return T.top_terms(freq, DEFAULTS.top_terms, ["lang"])


@query("top_terms_by_group", f"""WITH {_freq_sql(by='source', min_df=DEFAULTS.slice_min_df)} SELECT source, term, freq, doc_freq FROM freq
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY freq DESC, term) <= {DEFAULTS.top_terms_category}""")
def top_terms_by_group(spark, d):
    freq = T.term_freq(_corpus(spark, d, ["source"]), by=["source"], min_df=DEFAULTS.slice_min_df)
    return T.top_terms(freq, DEFAULTS.top_terms_category, ["source"])


@query("cloud_weights", f"""WITH {_freq_sql(by='lang', min_df=DEFAULTS.slice_min_df)}, best AS (SELECT * FROM freq
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY freq DESC, term) <= {DEFAULTS.cloud_words})
  SELECT lang, term, freq, doc_freq, {r('10 + 50 * (freq - min(freq) OVER (PARTITION BY lang)) / (max(freq) OVER (PARTITION BY lang) - min(freq) OVER (PARTITION BY lang) + 1e-9)')} AS weight FROM best""")
def cloud_weights(spark, d):
    freq = T.term_freq(_corpus(spark, d, ["lang"]), by=["lang"], min_df=DEFAULTS.slice_min_df)
    return rounded(T.cloud_weights(freq, by=["lang"]))


@query("term_weight", f"""WITH t AS (SELECT p_brand, count(*) AS freq FROM part GROUP BY 1), m AS (SELECT min(freq) AS lo, max(freq) AS hi FROM t)
  SELECT p_brand, {r('10 + 50 * (freq - lo) / (hi - lo + 1e-9)')} AS weight FROM t, m""")
def term_weight(spark, d):
    freq = table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("freq"))
    low, high = freq.agg(F.min("freq")).scalar(), freq.agg(F.max("freq")).scalar()
    return rounded(freq.select("p_brand", display_weight("freq", low, high).alias("weight")))


@query("fact_descriptors", """SELECT l_returnflag AS subtema, lower(l_linestatus || ' ' || l_returnflag) AS texto, count(*) AS weight
  FROM lineitem GROUP BY 1, 2""")
def fact_descriptors(spark, d):
    # Collapsed corpus: descriptor columns of a fact table, counted before any text work.
    from panelkit.sources.adapters import lineitem_facts

    return T.corpus(lineitem_facts(spark, d), ["sector", "subtema"], keep=["subtema"])
