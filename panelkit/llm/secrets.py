"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of every path is addressed by the digest of its content. A blob is scanned once per rule and rule version:
pairs already in the ledger are left out, equal blobs are scanned once, and findings are joined back to all paths.

Offsets come from the pieces between matches: a match starts where the lengths of all earlier pieces and matches end.
The running sum is a window over the few findings of one blob.

Defined results: a null text counts as empty and has no findings; repeated rows and copies share their blob's findings;
null paths are kept; an empty table gives an empty table; other columns never enter the scan. ``scan_with_ledger`` keeps
ledger and findings as tables, so that later scans show old secrets on every path and a raised rule replaces its old findings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.session import materialize


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if their ``group`` has ``least`` characters; raise ``version`` with every change."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1
    hint: str | None = None  # a cheaper pattern that every text with a match has


# The shortest hex or access key that counts is part of the pattern: a run either counts whole or not at all.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2,
         hint="(?i:passw|secret|token|api_?key)"),
    Rule("access", "AKIA[A-Z0-9]{14,}", hint="AKIA"),
    Rule("hex", "[0-9a-f]{16,}"),
)
# A key reaches to its end line. Without one before the next five dashes, it is the header and what follows it of base64: whole lines, headers of
# encryption, and long runs. Line ends may be escaped. All repeats of groups are possessive: linear, and no deeper stack in long texts.
_NL = r"(?:\r\n?|\n|\\r\\n|\\n)"
_KEY_LINE = (rf"""[ \t]*+{_NL}[ \t]*+(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*+(?:{_NL}(?={_NL}))?+"""
             rf"""|[A-Za-z0-9+/]{{40,}}+=*+|[A-Za-z0-9+/]++=*+(?=[ \t"']*+(?:{_NL}|\z)))|[ \t]++[A-Za-z0-9+/]{{40,}}+=*+""")
PRIVATE_KEY = ("-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
               f"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{{0,20}}PRIVATE KEY-----|(?:{_KEY_LINE})*+)")
MORE_RULES = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}", hint="gh[opsur]_"),
    Rule("private_key", PRIVATE_KEY, version=2, hint="-----BEGIN "),
)
RULES = BASE_RULES + MORE_RULES


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _pieces(text: Column, rule: Rule) -> Column:
    """Lengths of the text before each match and of the match, and whether it counts."""
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    zipped = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))), value,
                        lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), (F.length(v) >= rule.least).alias("good")))
    return F.filter(zipped, lambda p: p["size"].isNotNull())


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Blobs (blob, text) with the kinds still to be scanned; blobs with none left go."""
    every = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    if ledger is None:
        return blobs.select("blob", "text", every.alias("todo"))
    done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "kind", "version")).alias("done"))
    todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """Findings (blob, kind, version, start, end) of distinct blobs (blob, text, todo)."""
    text = F.coalesce("text", F.lit(""))
    found = []
    for place, r in enumerate(rules):
        wanted = F.array_contains("todo", f"{r.kind}@{r.version}") & text.rlike(r.hint or r.pattern)
        pieces = F.when(wanted, _pieces(text, r))
        found.append(F.struct(F.lit(place).alias("place"), F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), pieces.alias("pieces")))
    hits = blobs.select("blob", F.filter(F.array(*found), lambda f: F.size(f["pieces"]) > 0).alias("hits")).where(F.size("hits") > 0)
    one = hits.select("blob", F.explode("hits").alias("h")).select("blob", "h.place", "h.kind", "h.version", F.posexplode("h.pieces").alias("at", "p"))
    upto = F.sum(F.col("p.gap") + F.col("p.size")).over(Window.partitionBy("blob", "place").orderBy("at"))
    return one.withColumn("end", upto.cast("int")).where("p.good").select(
        "blob", "place", "kind", "version", (F.col("end") - F.col("p.size")).alias("start"), "end")


def scan_versions(versions: DataFrame, text: str = "text", ledger: DataFrame | None = None, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of all unseen blobs of ``versions``, and the ledger rows (blob, kind, version) that this scan adds."""
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), F.col(text).alias("text")).dropDuplicates(["blob"])
    todo = unseen(blobs, ledger, rules)
    kind, version = F.split_part("pair", F.lit("@"), F.lit(1)), F.split_part("pair", F.lit("@"), F.lit(2)).cast("int")
    added = todo.select("blob", F.explode("todo").alias("pair")).select("blob", kind.alias("kind"), version.alias("version"))
    return scan(todo, rules), added


LEDGER = "blob {}, kind string, version int"
FINDINGS = "blob {}, place int, kind string, version int, start int, end int"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the ledger, empty before the first scan."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _of_rules(rows: DataFrame, rules) -> DataFrame:
    """Rows of the current version of each rule."""
    current = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    return rows.where(F.array_contains(current, F.concat_ws("@", "kind", "version")))


def scan_with_ledger(versions: DataFrame, folder: str, text: str = "text", rules=RULES) -> DataFrame:
    """All findings of the current rules in all versions scanned so far, whichever scan found them.

    ``folder`` (shared) holds two tables that only grow: which blob was scanned by which version of a rule, and what was found.
    Only unseen pairs are scanned. Findings are stored before the pairs, so that a scan that breaks off is done again; what it
    had stored twice counts once. Findings of a rule's earlier versions stay in the table, but are not given.
    """
    spark = versions.sparkSession
    kind = dict(versions.select(blob_id(F.col(text)).alias("blob")).dtypes)["blob"]
    ledger = _stored(spark, f"{folder}/scanned", LEDGER.format(kind))
    new, added = scan_versions(versions, text, ledger, rules)
    new.write.mode("append").parquet(f"{folder}/found")
    added.write.mode("append").parquet(f"{folder}/scanned")
    return _of_rules(_stored(spark, f"{folder}/found", FINDINGS.format(kind)), rules).dropDuplicates()


def spans_by_blob(findings: DataFrame) -> DataFrame:
    """One row per blob: its findings by start, then by rule. One text's findings make one row."""
    one = F.struct("start", "place", "kind", "end")
    return findings.groupBy("blob").agg(F.array_sort(F.collect_list(one)).alias("spans"))


def join_back(versions: DataFrame, findings: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``versions`` (columns ``keep``) with the array ``secret_spans`` of their blob, which replaces a column so named.

    The findings are written first. Both sides are then shuffled by blob, so that Spark can split a blob of many copies.
    """
    spans = materialize(spans_by_blob(findings)).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    columns = [F.col(f"`{c}`") for c in (keep or versions.columns) if c.lower() != "secret_spans"]
    paths = versions.select(*columns, blob_id(F.col(text)).alias("__path_blob"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    joined = paths.join(spans.hint("merge"), F.col("__path_blob") == F.col("__blob"), "left")
    return joined.select(*columns, F.coalesce("__spans", none).alias("secret_spans"))
