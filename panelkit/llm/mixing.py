"""Mixing sources to target weights.

The words of a source, text after text, are packed into blocks of fixed length. Each source draws a fixed number of blocks,
dealt over the output shards by a multinomial draw. The k-th draw of a source is slot k; a pseudorandom permutation per
source and round (a Feistel network on the block numbers) maps it to a block, so that no block is taken a second time before
all have been taken once. Blocks and slots are joined by source and block number.

Positions of texts in their source come from two running sums: over the few thousand texts of one bucket of a source, and
over the buckets' totals. Sources are a configuration-sized list: more than ``MOST_SOURCES`` raise an error.

Defined results: null and empty texts have no words and nothing is taken from them; the null source is a source of its own,
last in order; repeated rows are texts of their own; rows equal in id and text may swap what is taken; an empty table gives an
empty table; other columns are kept out of the mix, and names can't clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import materialize

WORD = "[^ \\x09-\\x0D]+"
BLOCK_WORDS, SHARD_BLOCKS, BUCKET_ROWS = 128, 4096, 4096
WEIGHTS, SHARE, MOST_TIMES, SEED = (3, 1, 2), 1.5, 2, 20260101
MOST_SOURCES, SHARD_GROUP = 1_000_000, 65_536
PLACED = ["row_key", "doc_id", "sid", "size", "start"]


def targets(sizes: list[int], share: float = SHARE, weights=WEIGHTS, most_times: float = MOST_TIMES) -> list[float]:
    """Target of each source in order: shares by weight, cut at ``most_times`` its size, the excess shared again."""
    out, left = [0.0] * len(sizes), share * sum(sizes)
    open_ = list(range(len(sizes)))
    while open_ and left > 0:
        weight = sum(weights[i % len(weights)] for i in open_)
        part = {i: left * weights[i % len(weights)] / weight for i in open_}
        full = [i for i in open_ if part[i] > most_times * sizes[i]]
        if not full:
            for i in open_:
                out[i] = part[i]
            break
        for i in full:
            out[i] = float(most_times * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of 0..size-1: four Feistel rounds, repeated while out of range."""
    half = max(1, math.ceil(math.log2(max(2, size)) / 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([SEED, key]).integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            z = (right + np.uint64(1)) * k
            z ^= z >> np.uint64(29)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((z >> np.uint64(32)) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def placed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", also: tuple[str, ...] = ()) -> tuple[DataFrame, list]:
    """Texts (row_key, doc_id, sid, size, start) with their first word's place in the source; the sources with their sizes.

    ``also``: further columns that tell rows apart.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.regexp_count(value, F.lit(WORD)).cast("long").alias("size"),
                        row_key(*[F.col(f"`{c}`") for c in (doc_id, text, source, *also)]).alias("row_key"))
    sized = materialize(sized)
    found = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found = sorted(found, key=lambda r: (r.source is None, r.source or ""))
    ids = spark.createDataFrame([(i, r.source) for i, r in enumerate(found)], "sid int, name string")
    rows = sum(r.n for r in found)
    buckets = max(1, -(-rows // BUCKET_ROWS))
    sized = sized.join(F.broadcast(ids), F.col("source").eqNullSafe(F.col("name"))).select(
        "row_key", "doc_id", "sid", "size", F.pmod(F.xxhash64("row_key"), F.lit(buckets)).alias("bucket"))
    totals = sized.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("words")
    ahead = totals.select("sid", "bucket", ahead.alias("ahead"))
    inside = F.sum("size").over(Window.partitionBy("sid", "bucket").orderBy("row_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = sized.withColumn("inside", inside).join(ahead, ["sid", "bucket"]).withColumn("start", F.col("ahead") + F.col("inside"))
    return placed.select(*PLACED), found


def row_key(*columns: Column) -> Column:
    """Digest of a row's columns, null and empty apart; rows equal in them share it."""
    return F.md5(F.concat(*[F.coalesce(F.md5(c.cast("string").cast("binary")), F.lit("-")) for c in columns]).cast("binary"))


def draws(sizes: list[int], wanted: list[float], block_words: int = BLOCK_WORDS) -> list[int]:
    """Blocks that each source draws: its target by the mean length of its blocks, at most ``MOST_TIMES`` each."""
    blocks = [-(-s // block_words) for s in sizes]
    return [min(MOST_TIMES * b, round(t * b / s)) if s else 0 for s, t, b in zip(sizes, wanted, blocks)]


def drawn_slots(spark, sizes: list[int], counts: list[int], block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(sid, block, turn, shard, slot): the block of each draw, the round it belongs to, its shard and number there."""
    shards = max(1, -(-sum(counts) // shard_blocks))
    groups = [min(SHARD_GROUP, shards - g) for g in range(0, shards, SHARD_GROUP)]
    work = []
    for sid, n in enumerate(counts):
        parts = np.random.default_rng([SEED, sid]).multinomial(n, np.array(groups) / shards) if n else [0] * len(groups)
        begin = 0
        for g, part in enumerate(map(int, parts)):
            if part:
                work.append((sid, g, groups[g], begin, part, -(-sizes[sid] // block_words)))
            begin += part
    shares = spark.createDataFrame(work, "sid int, g int, shards int, begin long, n long, blocks long")

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                own = np.random.default_rng([SEED, r.sid, r.g, 1]).multinomial(r.n, np.full(r.shards, 1 / r.shards))
                starts = r.begin + np.append(0, np.cumsum(own[:-1]))
                yield pd.DataFrame({"sid": np.int32(r.sid), "shard": r.g * SHARD_GROUP + np.arange(r.shards), "begin": starts, "n": own, "blocks": r.blocks})

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, shard, begin, n, blocks in zip(*(batch.column(c).to_pylist() for c in ("sid", "shard", "begin", "n", "blocks"))):
                for low in range(begin, begin + n, 1 << 16):
                    k = np.arange(low, min(begin + n, low + (1 << 16)))
                    turn = k // blocks
                    block = np.empty(len(k), np.int64)
                    for t in np.unique(turn):
                        block[turn == t] = permuted(k[turn == t] % blocks, blocks, sid * MOST_TIMES + int(t))
                    yield pa.RecordBatch.from_pydict({"sid": pa.array(np.full(len(k), sid, np.int32)), "block": block, "turn": turn.astype(np.int32),
                                                      "shard": np.full(len(k), shard, np.int64), "slot": k - begin})

    shards_of = shares.repartition(max(1, min(len(work), 2 * spark.sparkContext.defaultParallelism))).mapInPandas(dealt, "sid int, shard long, begin long, n long, blocks long")
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards_of.where("n > 0").repartition(many, "sid", "shard").mapInArrow(mapped, "sid int, block long, turn int, shard long, slot long")


def pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each text's part of each block: (columns of ``placed``, block, first, words); first is a word's number in the text."""
    b = F.lit(block_words)
    last = F.col("start") + F.col("size") - 1
    blocks = F.explode(F.sequence(F.floor(F.col("start") / b), F.floor(last / b))).alias("block")
    cut = placed.where("size > 0").select(*PLACED, blocks)
    begin = F.greatest(F.col("start"), F.col("block") * b)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
    return cut.select(*PLACED, "block", (begin - F.col("start")).alias("first"), (end - begin).alias("words"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS, also: tuple[str, ...] = ()):
    """(placed texts, sources, targets, drawn slots) of the mix of ``docs``."""
    placed, found = placed_texts(docs, doc_id, text, source, also)
    sizes = [int(r.words) for r in found]
    wanted = targets(sizes)
    slots = drawn_slots(docs.sparkSession, sizes, draws(sizes, wanted, block_words), block_words, shard_blocks)
    return placed, found, wanted, slots


def mixed_blocks(placed: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: (shard, slot, sid, block, turn, row_key, doc_id, text_start, first, words), blocks joined with slots by number."""
    # Spark takes the slots for as few as the sources they are made from, and would broadcast them.
    return pieces(placed, block_words).join(slots.hint("merge"), ["sid", "block"]).select(
        "shard", "slot", "sid", "block", "turn", "row_key", "doc_id", F.col("start").alias("text_start"), "first", "words")


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS, **names) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    placed, found, wanted, slots = mix(docs, block_words=block_words, **names)
    placed = materialize(placed)
    times = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = pieces(placed, block_words).join(times.hint("merge"), ["sid", "block"]).groupBy("sid", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    facts = docs.sparkSession.createDataFrame([(i, int(r.words), float(t)) for i, (r, t) in enumerate(zip(found, wanted))],
                                              "sid int, source_size long, target double")
    full = placed.where("size > 0").join(taken, ["sid", "start"], "left")
    out = full.select("doc_id", "sid", "size", "taken").union(placed.where("size = 0").select("doc_id", "sid", "size", F.lit(0).cast("long")))
    return out.join(F.broadcast(facts), "sid").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def words_between(text, parts):
    """Text from the first to the last word of each run of words (first, words), runs joined by line breaks."""

    def run(texts: pa.Array, all_parts: pa.Array) -> pa.Array:
        out = []
        for t, own in zip(texts, all_parts):
            out.append(cut(t.as_py() or "", [(p["first"], p["words"]) for p in own.as_py() or ()]))
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text, parts)


def cut(text: str, parts: list[tuple[int, int]]) -> str:
    runs: list[list[int]] = []
    for first, words in sorted(parts):
        if runs and runs[-1][1] == first:
            runs[-1][1] = first + words
        else:
            runs.append([first, first + words])
    bounds = [m.span() for m in re.finditer("[^ \t-\r]+", text)] if runs else []
    return "\n".join(text[bounds[a][0]:bounds[b - 1][1]] for a, b in runs)


def mixed_texts(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: for each text and round, the words taken, with the other columns of the text.

    ``docs`` has doc_id, text, source and n_chars. A text taken twice gives two rows; one that no draw takes gives none.
    """
    also = tuple(c for c in docs.columns if c not in ("doc_id", "text", "source"))
    placed, _, _, slots = mix(docs, block_words=block_words, also=also)
    placed = materialize(placed)
    whole = mixed_blocks(placed, slots, block_words).groupBy("row_key", "sid", "text_start", "turn").agg(F.collect_list(F.struct("first", "words")).alias("parts"))
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], row_key(*[F.col(f"`{c}`") for c in ("doc_id", "text", "source", *also)]).alias("__key"))
    keyed = keyed.dropDuplicates(["__key"])  # equal rows are told apart by their start
    joined = keyed.join(whole.hint("merge"), F.col("__key") == F.col("row_key"))  # texts and their parts grow with the input: no broadcast
    return joined.select(*[words_between("text", "parts").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
