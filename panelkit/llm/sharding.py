"""Shards by extendible hashing, with DataFrame functions only.

A row's hash gives a string of bits. The directory is indexed by its first bits: a bucket over the byte limit is split on
one more bit, all others stay as they are, until every bucket fits. Sizes of all levels come from one histogram over 16
bits (at most 65,536 rows, hence broadcast); only where a 16-bit bucket is still too large the next 16 bits follow.

Defined results: null and empty texts have no bytes but a shard; null ids hash as the empty text; a single row over the
limit makes a shard of its own; rows equal in id and text share all bits and are parted by a row number if they exceed
the limit; an empty table gives an empty table; all columns are kept but one named ``shard``, which the added struct replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import materialize

BITS, STEP = 60, 16
SHARD_BYTES = 64 << 20


def hash_bits(doc_id: Column, text: Column) -> Column:
    """60 bits of the digest of id and text, as a number."""
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    digest = F.md5(F.concat(empty(doc_id), F.lit(":"), F.md5(empty(text).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column, depth: Column) -> Column:
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def directory(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(slot, depth, shard_bytes, shard_rows) for each prefix of ``high`` bits; depth is null where even that is too large."""
    slots = rows.groupBy(_prefix(F.col("bits"), F.lit(high)).alias("slot")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    depths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    levels = materialize(slots).select("slot", "bytes", "n", depths)
    levels = levels.withColumn("prefix", F.expr(f"shiftright(slot, {high} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = fits.where(F.col("shard_bytes") <= limit)
    found = levels.join(fits, ["depth", "prefix"], "left").groupBy("slot").agg(
        F.min(F.when(F.col("shard_bytes").isNotNull(), F.struct("depth", "shard_bytes", "shard_rows"))).alias("d"))
    return found.select("slot", "d.depth", "d.shard_bytes", "d.shard_rows")


def assign_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """All rows of ``docs`` with the struct ``shard``: name (the bits), depth, bytes of the row and of the shard, rows."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "shard"]).alias("row"), hash_bits(F.col(doc_id), F.col(text)).alias("bits"), size.alias("bytes"))
    done, low = [], 0
    while True:
        high = min(low + STEP, BITS)
        found = materialize(directory(hashed.select("bits", "bytes"), low, high, limit))
        placed = hashed.withColumn("slot", _prefix(F.col("bits"), F.lit(high))).join(F.broadcast(found) if low == 0 else found, "slot")
        done.append(placed.where("depth IS NOT NULL").select("row", "bits", "bytes", "depth", "shard_bytes", "shard_rows", F.lit("").alias("part")))
        if found.where("depth IS NULL").isEmpty():
            break
        hashed = placed.where("depth IS NULL").select("row", "bits", "bytes")
        low = high + 1
        if low > BITS:
            done.append(_equal_rows(hashed, limit))
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    name = F.concat(F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin(_prefix(F.col("bits"), F.col("depth"))), F.greatest("depth", F.lit(1)), F.lit("0"))), "part")
    shard = F.struct(name.alias("name"), "depth", F.col("bytes").alias("row_bytes"), "shard_bytes", "shard_rows")
    return out.select("row.*", shard.alias("shard"))


def _equal_rows(rows: DataFrame, limit: int) -> DataFrame:
    """Rows that share all bits are equal: each part takes as many as fit, one at least."""
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))
    numbered = rows.withColumn("place", F.row_number().over(Window.partitionBy("bits").orderBy("bytes")) - 1)
    numbered = numbered.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bits")))
    part = F.floor(F.col("place") / each)
    held = F.least(each, F.col("n") - part * each)
    return numbered.select("row", "bits", "bytes", F.lit(BITS).alias("depth"), (held * F.col("bytes")).alias("shard_bytes"), held.alias("shard_rows"),
                           F.concat(F.lit("-"), part.cast("string")).alias("part"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a shard fits one task."""
    sharded.withColumn("shard", F.concat(F.lit("s"), F.col("shard.name"))).repartition("shard").write.partitionBy("shard").parquet(path)
