"""Conversation prefix trie in balanced parentheses.

Every distinct sequence of first turns is a node; its key is made of digests of (place, role, text), combined by xor, so that
it comes from running values over short blocks and needs no list of turns. Members, ends and least members of nodes are plain
aggregates. Nodes of one member set form a chain; a chain is named by its least member and its number of members, and the
trie of chains has less than two nodes per conversation, however long these are.

Childless nodes are dealt to shards together with the chains above them (a hot first turn is salted over several). Each shard
writes its part of the trie as balanced parentheses: an open and a close per chain, with excess blocks under a tree of their
minima. ``find_close`` delimits subtrees, the rank of leaf pairs "()" counts leaves, and a cumulative array over opens gives the
savings. Chains that several shards hold, the spines, merge by summing: a leaf lies in one shard, and a chain's own savings
are counted in one.

Defined results: turns are ordered by ``turn``, null first, then role and text; null role or text is empty; rows without
conversation id are no conversation; repeated rows are turns of their own; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.graph import shuffled_again
from panelkit.operators.scan import Running, running
from panelkit.session import materialize

BLOCK = 1024  # depths in one window
BITS = 64  # parentheses in one excess block
SHARD_ROWS = 100_000  # chains of leaves in one shard
FAR = np.int32(2**31 - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, code, words) of all turns with an id: place from 1, digest of the turn, words of its text.

    Equal rows are counted and numbered together. Only different turns of one number in one conversation are sorted by their
    texts.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    same = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text")).groupBy(
        "conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    tied = not same.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) if tied else F.lit(1)
    placed = same.select("conv_id", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn_key"), place.alias("place"),
                         digest.alias("code"), F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("words"), "n")
    upto = running(placed, ["has_turn", "turn_key", "place"], {"upto": Running("n")}, by=["conv_id"])
    each = F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto")))
    return upto.select("conv_id", "code", "words", each.alias("pos"))


def rebuilt(turns: DataFrame, heads: Column, base: Column, most_heads: int) -> DataFrame:
    """Turns by ``number_turns`` with the first ``heads`` (at most ``most_heads``) of each conversation taken from conversation ``base``.

    Adds a row of pos 0 for every conversation, also for one that keeps no turn.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).withColumn("h", heads.cast("long")).withColumn("base", base.cast("long"))
    convs = materialize(convs)
    size = convs.select(F.col("conv_id").alias("base_id"), F.col("turns").alias("base_turns"))
    convs = materialize(convs.join(size, F.col("base") == F.col("base_id"), "left").select(
        "conv_id", "h", "base", F.least(F.coalesce("base_turns", F.lit(0)), F.col("h")).alias("taken")))
    first = turns.where(F.col("pos") <= most_heads).select(F.col("conv_id").alias("base"), "pos", "code", "words")
    taken = convs.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", "pos", "code", "words")
    shift = convs.select(shuffled_again("conv_id").alias("own"), "h", "taken").hint("merge")
    own = turns.join(shift, F.col("conv_id") == F.col("own")).where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "code", "words")
    start = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("code"), F.lit(0).cast("long").alias("words"))
    return start.unionByName(taken).unionByName(own)


def _blocked_running(rows: DataFrame, by: list[str], depth: str, values: dict[str, tuple]) -> DataFrame:
    """Running values over ``depth`` in every group, by blocks of ``BLOCK`` depths: no window holds more rows.

    ``values``: name, (aggregate, column, neutral value, how a block's earlier total joins).
    """
    block = F.floor(F.col(depth) / BLOCK)
    rows = rows.withColumn("block", block)
    inner = Window.partitionBy(*by, "block").orderBy(depth).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*by, "block").agg(*[agg(c).alias(n) for n, (agg, c, _, _) in values.items()])
    before = totals.select(*[F.col(c).alias(f"{c}_2") for c in by], F.col("block").alias("block_2"), *[agg(n).over(across).alias(f"{n}_0") for n, (agg, _, _, _) in values.items()])
    on = F.col("block") == F.col("block_2")
    for c in by:
        on = on & (F.col(c) == F.col(f"{c}_2"))
    both = rows.withColumns({n: agg(c).over(inner) for n, (agg, c, _, _) in values.items()}).join(before, on)
    return both.withColumns({n: how(F.col(n), F.coalesce(f"{n}_0", F.lit(zero))) for n, (_, _, zero, how) in values.items()}).select(
        *[c for c in rows.columns if c != "block"], *values)


def prefix_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, words, ends): the node of every conversation at every depth, and its parent's key."""
    part = lambda at: F.when(F.col("pos") == 0, F.lit(0)).otherwise(
        F.conv(F.substring(F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), "code").cast("binary")), at, 15), 16, 10).cast("long")).cast("long")
    rows = materialize(turns.select("conv_id", F.col("pos").alias("depth"), part(1).alias("own_a"), part(17).alias("own_b"), "words"))
    xor = lambda x, y: x.bitwiseXOR(y)
    keyed = _blocked_running(rows, ["conv_id"], "depth", {"a": (F.bit_xor, "own_a", 0, xor), "b": (F.bit_xor, "own_b", 0, xor)})
    last = rows.groupBy(F.col("conv_id").alias("lc")).agg(F.max("depth").alias("last"))
    marked = keyed.join(last, (F.col("conv_id") == F.col("lc")) & (F.col("depth") == F.col("last")), "left")
    return marked.select("conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b"),
                         "words", F.col("lc").isNotNull().alias("ends"))


def find_close(opens: np.ndarray, excess: np.ndarray) -> np.ndarray:
    """The matching close of every open: the first later place whose excess is below the open's.

    Inside the open's own block by comparison; else a tree over the blocks' minima is climbed to the first block that falls
    below, and descended.
    """
    blocks = -(-len(excess) // BITS)
    padded = np.full(blocks * BITS, FAR, np.int32)
    padded[:len(excess)] = excess
    table = padded.reshape(blocks, BITS)
    leaves = 1 << max(0, blocks - 1).bit_length()
    tree = np.full(2 * leaves, FAR, np.int32)
    tree[leaves:leaves + blocks] = table.min(axis=1)
    for k in range(leaves - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    out = np.empty(len(opens), np.int64)
    for k in range(0, len(opens), 1 << 16):
        at = opens[k:k + (1 << 16)]
        level, block, column = excess[at], at // BITS, at % BITS
        below = (table[block] < level[:, None]) & (np.arange(BITS) > column[:, None])
        here = below.any(axis=1)
        close = block * BITS + below.argmax(axis=1)
        node, value = block[~here] + leaves, level[~here]
        climbing = np.ones(len(node), bool)
        while climbing.any():
            right = climbing & (node % 2 == 0) & (tree[np.minimum(node + 1, 2 * leaves - 1)] < value)
            node = np.where(right, node + 1, np.where(climbing, node // 2, node))
            climbing &= ~right
        while (inner := node < leaves).any():
            node = np.where(inner, 2 * node + (tree[np.minimum(2 * node, 2 * leaves - 1)] >= value), node)
        block = node - leaves
        close[~here] = block * BITS + (table[block] < value[:, None]).argmax(axis=1)
        out[k:k + (1 << 16)] = close
    return out


def encode_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one shard's (leaf, top, conv_id, n_convs, own): per chain its leaves and savings here, and the chain above."""
    rows = rows.sort_values(["leaf", "top"], kind="stable")
    chains, codes = np.unique(rows[["conv_id", "n_convs"]].to_numpy(np.int64), axis=0, return_inverse=True)
    codes = codes.reshape(-1)
    own = np.zeros(len(chains), np.int64)
    np.add.at(own, codes, rows["own"].to_numpy(np.int64))
    cuts = np.flatnonzero(np.diff(rows["leaf"].to_numpy())) + 1
    paths = sorted(p.tolist() for p in np.split(codes, cuts))
    bits, opened, above, stack = [], [], [], []
    for path in paths:
        same = next((i for i, (x, y) in enumerate(zip(stack, path)) if x != y), min(len(stack), len(path)))
        bits += [-1] * (len(stack) - same) + [1] * (len(path) - same)
        opened += path[same:]
        above += [path[i - 1] if i else -1 for i in range(same, len(path))]
        stack = path
    bits = np.array(bits + [-1] * len(stack), np.int8)
    opened, above = np.array(opened), np.array(above)
    opens = np.flatnonzero(bits == 1)
    closes = find_close(opens, np.cumsum(bits, dtype=np.int32))
    pairs = np.concatenate([[0], np.cumsum((bits[:-1] == 1) & (bits[1:] == -1))])  # leaf pairs that end at a place or before
    saved = np.zeros(len(bits) + 1, np.int64)
    saved[opens + 1] = own[opened]
    saved = np.cumsum(saved)
    return pd.DataFrame({"conv_id": chains[opened, 0], "n_convs": chains[opened, 1], "n_leaves": pairs[closes] - pairs[opens],
                         "saved": saved[closes + 1] - saved[opens], "up": np.where(above >= 0, chains[above, 0], 0), "has_up": above >= 0})


def _end_digests(rows: DataFrame) -> DataFrame:
    """(end_a, end_b, ends_sha256): members that end at a node, hashed as a stream of sorted ids: none is held as a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if (a, b) != now:
                    if now:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (a, b), hashlib.sha256(str(c).encode())
                else:
                    digest.update(b"," + str(c).encode())
            yield _digest_batch(done)
        if now:
            yield _digest_batch([(*now, digest.hexdigest())])

    ends = rows.where("ends").select("a", "b", "conv_id").repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
    return ends.mapInArrow(run, "end_a bigint, end_b bigint, ends_sha256 string")


def _digest_batch(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[k]) for k in range(3)], names=["end_a", "end_b", "ends_sha256"])


def _leaf_chains(rows: DataFrame, nodes: DataFrame, chains: DataFrame) -> DataFrame:
    """(leaf, top, conv_id, n_convs, own): of every childless node the chains from the root down; ``own`` once per chain."""
    leaf = nodes.where("ends = n_convs").select(shuffled_again("conv_id").alias("leaf"))  # its least member stands for it
    walked = rows.join(leaf.hint("merge"), F.col("conv_id") == F.col("leaf")).select("leaf", "a", "b")
    tops = chains.select(F.col("top_a"), F.col("top_b"), "top", "conv_id", "n_convs", "weight")
    on = (shuffled_again("a") == F.col("top_a")) & (F.col("b") == F.col("top_b"))
    found = materialize(walked.join(tops.hint("merge"), on).select("leaf", "top", "conv_id", "n_convs", "weight"))
    owner = found.groupBy("conv_id", "n_convs").agg(F.min("leaf").alias("leaf")).select(
        F.col("conv_id").alias("oc"), F.col("n_convs").alias("on"), F.col("leaf").alias("ol"))
    same = (F.col("conv_id") == F.col("oc")) & (F.col("n_convs") == F.col("on")) & (F.col("leaf") == F.col("ol"))
    return found.join(owner, same, "left").select("leaf", "top", "conv_id", "n_convs", F.when(F.col("ol").isNotNull(), F.col("weight")).otherwise(F.lit(0)).alias("own"))


def _sharded(found: DataFrame, shard_rows: int) -> DataFrame:
    """Leaf chains with their shard: leaves under one chain below the root together, salted if these are many."""
    size = found.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("top") > 0, F.struct("top", "conv_id", "n_convs"))).alias("s"))
    size = materialize(size.select("leaf", "n", F.coalesce("s.conv_id", F.lit(-1)).alias("sc"), F.coalesce("s.n_convs", F.lit(-1)).alias("sn")))
    shards = max(1, -(-int(size.agg(F.sum("n")).first()[0] or 0) // shard_rows))
    heavy = size.groupBy("sc", "sn").agg(F.sum("n").alias("total")).where(F.col("total") > shard_rows).select(
        F.col("sc").alias("hc"), F.col("sn").alias("hn"), F.ceil(F.col("total") / shard_rows).cast("long").alias("salts"))
    dealt = size.join(F.broadcast(heavy), (F.col("sc") == F.col("hc")) & (F.col("sn") == F.col("hn")), "left")  # at most one row per shard
    salt = F.pmod(F.xxhash64("leaf"), F.coalesce("salts", F.lit(1)))
    dealt = dealt.select(F.col("leaf").alias("dealt"), F.pmod(F.xxhash64("sc", "sn", salt), F.lit(shards)).alias("shard"))
    return found.join(dealt.hint("merge"), shuffled_again("leaf") == F.col("dealt")).drop("dealt")


def prefix_trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node from (conv_id, pos, code, words) rows that start with pos 0 for each conversation.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the key (a, b).
    """
    rows = materialize(prefix_rows(turns))
    nodes = materialize(rows.groupBy("a", "b", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("ends"),
        F.first("words").alias("words"), F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b")))
    own = (F.col("n_convs") - 1) * F.col("words")
    by_depth = F.struct("depth", "a", "b", "up_a", "up_b")
    chains = nodes.groupBy("conv_id", "n_convs").agg(F.min(by_depth).alias("first"), F.max(by_depth).alias("last"), F.sum(own).alias("weight"))
    chains = materialize(chains.select("conv_id", "n_convs", "weight", F.col("first.depth").alias("top"), F.col("first.a").alias("top_a"), F.col("first.b").alias("top_b"),
                                       F.col("first.up_a").alias("up_a"), F.col("first.up_b").alias("up_b"),
                                       F.col("last.depth").alias("bottom"), F.col("last.a").alias("bottom_a"), F.col("last.b").alias("bottom_b")))
    dealt = _sharded(_leaf_chains(rows, nodes, chains), shard_rows)
    parts = dealt.groupBy("shard").applyInPandas(
        encode_shard, "conv_id bigint, n_convs bigint, n_leaves bigint, saved bigint, up bigint, has_up boolean")
    merged = parts.groupBy("conv_id", "n_convs").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.first(F.when(F.col("has_up"), F.col("up"))).alias("up"))
    merged = merged.select(F.col("conv_id").alias("mc"), F.col("n_convs").alias("mn"), "n_leaves", "saved", "up")
    below = chains.where("top > 0").groupBy("up_a", "up_b").agg(F.count(F.lit(1)).alias("children")).select(F.col("up_a").alias("ca"), F.col("up_b").alias("cb"), "children")
    whole = chains.join(merged, (F.col("conv_id") == F.col("mc")) & (F.col("n_convs") == F.col("mn"))).join(
        below, (F.col("bottom_a") == F.col("ca")) & (F.col("bottom_b") == F.col("cb")), "left")
    blocks = F.explode(F.sequence(F.floor(F.col("top") / BLOCK), F.floor(F.col("bottom") / BLOCK)))
    whole = whole.select(F.col("mc"), F.col("mn"), "top", "bottom", "n_leaves", "saved", "up", F.coalesce("children", F.lit(0)).alias("children"), blocks.alias("mblock"))

    plus = lambda x, y: x + y
    along = _blocked_running(nodes.withColumn("own", own), ["conv_id", "n_convs"], "depth", {"upto": (F.sum, "own", 0, plus)})
    on = (F.col("conv_id") == F.col("mc")) & (F.col("n_convs") == F.col("mn")) & (F.floor(F.col("depth") / BLOCK) == F.col("mblock"))
    full = along.join(whole.hint("merge"), on)
    full = full.join(_end_digests(rows), (F.col("a") == F.col("end_a")) & (F.col("b") == F.col("end_b")), "left")
    inside, top = F.col("depth") < F.col("bottom"), F.col("depth") == F.col("top")
    return full.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(top, F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(inside, F.lit(1)).otherwise(F.col("children")).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - F.col("upto") + F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "a", "b")
