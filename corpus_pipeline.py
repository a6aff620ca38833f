"""A corpus pipeline of five stages: quality rules, near-duplicates, secrets, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``. ``run`` writes each stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import bpe, mixing, pii, quality, secrets, superminhash
from panelkit.llm.batches import small_batches
from panelkit.llm.queries import VOCABULARY
from panelkit.session import checkpoint_dir, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def with_length(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor the learned rules reject.

    A null or empty text has no words and goes; equal rows are judged alike; without labels only the base rules reject.
    """
    rules = quality.learn_list(quality.labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.judge(docs, rules).where("quality_stats.kept").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates at five words and 0.8: the one whose id names the group.

    Documents without words stay. Of rows equal in id and text one stays.
    """
    found = superminhash.near_duplicates(docs, width=5, percent=80)
    group = F.coalesce(F.hex("group"), F.concat(F.lit("-"), "text_md5", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    first = found.where("kept").groupBy(group.alias("g")).agg(F.min(F.struct("doc_id", "text_md5")).alias("d"))
    first = first.select(F.col("d.doc_id").alias("kept_id"), F.col("d.text_md5").alias("kept_text"))
    own = docs.select(*COLUMNS, F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("own_text"))
    kept = own.join(first, (F.col("own_text") == F.col("kept_text")) & F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "own_text"]).select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret in their texts is replaced by its kind in angle brackets.

    A null text stays null; equal rows and rows without id are all kept.
    """
    findings = secrets.scan_with_ledger(docs, f"{checkpoint_dir(spark)}/secret-ledger-{uuid.uuid4().hex}")
    found = secrets.join_back(docs, findings, keep=COLUMNS)
    return with_length(found.withColumn("text", pii.redact(F.col("text"), F.col("secret_spans"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents: one row per text and round.

    A null or empty text has no words, so no row; equal rows are mixed each; a null source is a source of its own.
    """
    return with_length(mixing.mixed_texts(docs.select(*COLUMNS)))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, whether they decode to its bytes, and a digest of the text, which tells rows of one id apart.

    A null text counts as the empty one: no ids, restored. Every row gives one row.
    """
    ranks = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))
    coded = docs.select(*COLUMNS, bpe.round_trip("text", ranks).alias("c"))
    bytes_ = F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.md5(bytes_).alias("text_md5"), F.size("c.ids").cast("long").alias("n_tokens"), F.col("c.ids").alias("ids"),
                        (F.col("c.decoded") == bytes_).alias("restored"))


def shipped(stage):
    """The stage, with this package on its Python workers and small batches to them."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", shipped(keep_good)),
    ("near_duplicates", shipped(keep_one_of_each_group)),
    ("secrets", shipped(hide_secrets)),
    ("mixing", shipped(mix_sources)),
    ("encoding", shipped(encode_texts)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    base = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{base}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
