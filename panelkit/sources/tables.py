"""Reading fact tables and writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.scalars import number
from panelkit.functions.textnorm import slug
from panelkit.operators.scan import attach_by_group
from panelkit.sources.csvfiles import infer_types, read_csv

FACT_TYPES = {"ciclo": T.IntegerType(), "mes": T.StringType(), "monto": T.DoubleType()}
SLICE_ROWS = 1_000_000
NO_SLICE = "\x00"  # stands for a null value of the slice column


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def probe_columns(spark: SparkSession, path: str) -> int:
    """Number of columns of a CSV file, from its header."""
    return len(spark.read.option("header", True).csv(path).columns)


def read_facts(spark: SparkSession, path, schema: T.StructType | None = None,
               encodings: Sequence[str] = ("UTF-8", "ISO-8859-1"), infer: bool = False) -> DataFrame:
    """Scan a fact table from parquet, or from CSV with a header.

    CSV columns are text except the ones in ``FACT_TYPES`` or ``schema``; ``infer`` finds the types of all others from their
    values in one more pass. Each file is read in the first encoding that its bytes are valid in, and in several tasks where it is
    large; quoted line breaks belong to their field. A row with too few or too many fields fails. See ``csvfiles``.
    """
    first = path if isinstance(path, str) else path[0]
    if first.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    df = read_csv(spark, path, encodings)
    types = {f.name: f.dataType for f in schema} if schema else dict(FACT_TYPES)
    if infer:
        others = [c for c in df.columns if c not in types]
        types |= infer_types(df.select(*[F.col(f"`{c}`") for c in others])) if others else {}
    out = []
    for name in df.columns:
        dtype = types.get(name, T.StringType())
        if isinstance(dtype, T.DoubleType):
            out.append(number(f"`{name}`").alias(name))
        elif isinstance(dtype, T.StringType):
            out.append(F.col(f"`{name}`"))
        else:
            out.append(F.trim(F.col(f"`{name}`")).try_cast(dtype).alias(name))
    return df.select(*out)


def write_table(df: DataFrame, path: str, single_file: bool = False, fmt: str = "csv", mode: str = "overwrite",
                partition_by: Sequence[str] = (), encoding: str = "UTF-8") -> None:
    """Write with a header. ``single_file`` is for small result tables only."""
    out = df.repartition(1) if single_file else df  # only the last step runs in one task
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _save(writer, path, fmt, encoding)


def _save(writer, path: str, fmt: str, encoding: str = "UTF-8") -> None:
    if fmt == "csv":
        (writer.option("header", True).option("encoding", encoding).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        writer.format(fmt).save(path)


def write_slices(df: DataFrame, by: str, path: str, mode: str = "overwrite", fmt: str = "csv", rows_per_file: int = SLICE_ROWS) -> None:
    """One folder per value of ``by``, named by its slug; values that share one get a part of their digest as well.

    A first pass counts the rows of each slice. Rows are dealt by slice and by a digest of the whole row over as many files as
    the slice has times ``rows_per_file`` rows, so that a task that runs again deals them alike. Equal rows share a file.
    """
    values = df.groupBy(F.col(by).alias("__value")).agg(F.count(F.lit(1)).alias("__rows")).withColumn("slice", slug("__value"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("slice")) > 1
    digest = F.substring(F.md5(F.col("__value").cast("string").cast("binary")), 1, 8)
    named = values.select("__value", F.when(shared, F.concat_ws("_", "slice", digest)).otherwise(F.col("slice")).alias("slice"),
                          F.ceil(F.col("__rows") / rows_per_file).cast("long").alias("__files"))
    joined = attach_by_group(df.withColumn("__value", F.coalesce(F.col(by).cast("string"), F.lit(NO_SLICE))), named.withColumn(
        "__value", F.coalesce(F.col("__value").cast("string"), F.lit(NO_SLICE))), ["__value"], "__files")
    dealt = joined.repartition("slice", F.pmod(F.xxhash64(*df.columns), F.col("__files"))).drop("__files", "__value")
    _save(dealt.write.mode(mode).partitionBy("slice"), path, fmt)
