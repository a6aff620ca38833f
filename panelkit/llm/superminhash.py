"""Near-duplicates by SuperMinHash signatures, banding, exact verification and union-find grouping.

Each shingle draws a random permutation of the signature's places step by step; at step j it offers j plus a fraction to
the place drawn. A document stops as soon as no place can improve. Texts of one shingle set form a node; nodes that agree
on a band of their signatures are candidates. With 36 bands of 6 values, a pair at similarity 0.85 is missed with a
probability of about 4e-8.

Candidates of a bucket are never all paired at once. First every node is compared with one other, the least node of all its
buckets, and what links gets one label; a cheap estimate from the signatures (six standard deviations below the threshold)
goes before the comparison of full sets, which decides. Buckets that then hold one label are done. The members of the others
are grouped by the most common label of their bucket, and each member is written as its difference to the node that names this
label: for x and y with the centre h, |x and y| = |h| - |Rx or Ry| + |Ax and Ay| with removed R and added A, which are small where a
group is large. Groups are cut into blocks of bounded size; two blocks meet in one task, which compares all their pairs of
different labels exactly by these differences and gives a spanning forest, never pairs. So every pair of a bucket is compared
or already in one group.

Defined results: null and empty texts have no shingles and are linked with nothing; a text of fewer words than a shingle
has one, its whole sequence; copies and repeated rows share a node; rows without id join groups, and are kept only
in a group without any id; an empty
table gives an empty table; only the two columns named are read. Shingles are held as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import text_pieces
from panelkit.llm.graph import components, shuffled_again, union_find
from panelkit.session import materialize

BANDS, ROWS = 36, 6
PLACES = BANDS * ROWS
CHUNK_BYTES = 1 << 19
BLOCK_NODES, BLOCK_BYTES = 4096, 32 << 20  # of differences that meet another block in one task
CHUNK_HITS = 2_000_000
GOLD = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
PROFILE = "struct<n_shingles:bigint,node:binary,signature:binary>"
PROFILE_TYPE = pa.struct([("n_shingles", pa.int64()), ("node", pa.binary()), ("signature", pa.binary())])


def mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; A-Z count as a-z."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * GOLD + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """One row of ``places`` values per set; values are step and fraction in one number."""
    sizes = np.array([len(s) for s in sets], np.intp)
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    out = np.full(len(sets) * places, EMPTY)
    order = np.tile(np.arange(places, dtype=np.uint8), (len(element), 1))
    for j in range(places):
        if not len(element):
            break
        z = mix(element + np.uint64((j + 1) * int(GOLD) & (2**64 - 1)))
        k = j + (((z & LOW) * np.uint64(places - j)) >> HALF).astype(np.intp)
        row = np.arange(len(element))
        place = order[row, k]
        order[row, k] = order[:, j]
        np.minimum.at(out, owner * places + place, (np.uint64(j) << HALF) | (z >> HALF))
        worst = out.reshape(-1, places).max(axis=1) >> HALF
        open_ = worst[owner] > np.uint64(j)
        if not open_.all():
            element, owner, order = element[open_], owner[open_], order[open_]
    return out.reshape(-1, places)


def band_keys(signature: Column | str) -> Column:
    """One key per band, from the signature's bytes. Six bytes agree by chance once in 2**48 pairs; such pairs fail the comparison."""
    part = lambda i: F.substring(signature, i * ROWS + 1, F.lit(ROWS))
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, part(i)))


def profile(text: Column | str, width: int) -> Column:
    """Number of shingles, digest of the set and one byte of each signature value."""

    def profiles(sets: list[np.ndarray]) -> pa.Array:
        low = iter(signatures([s for s in sets if len(s)]).astype(np.uint8))
        return pa.array([{"n_shingles": len(s), "node": hashlib.md5(s.tobytes()).digest() if len(s) else None,
                          "signature": next(low).tobytes() if len(s) else None} for s in sets], PROFILE_TYPE)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in text_pieces(batch, CHUNK_BYTES):
                yield profiles([shingles(t, width) for t in part])

    return F.arrow_udf(run, PROFILE)(text)


def shingle_set(text: Column | str, width: int) -> Column:
    return F.arrow_udf(lambda b: pa.array([shingles(x.as_py(), width).tobytes() for x in b], pa.binary()), "binary")(text)


def own_set(text: Column | str, node: Column | str, width: int) -> Column:
    """The shingles of a text if they are those of ``node``, else null. As it reads both, it runs after the join that finds them."""

    def run(texts: pa.Array, nodes: pa.Array) -> pa.Array:
        sets = (shingles(x.as_py(), width).tobytes() for x in texts)
        return pa.array([s if hashlib.md5(s).digest() == n.as_py() else None for s, n in zip(sets, nodes)], pa.binary())

    return F.arrow_udf(run, "binary")(text, node)


def same_bytes(a: Column | str, b: Column | str) -> Column:
    """Share of equal bytes of two strings of bytes of one length."""

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(len(v), -1) for v in (x, y))
        return pa.array((left == right).mean(axis=1))

    return F.arrow_udf(run, "double")(a, b)


def similar_sets(a: Column | str, b: Column | str, percent: int) -> Column:
    """100 * intersection >= percent * union, for sets as sorted hashes."""

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y):
            s, t = (np.frombuffer(v.as_py(), np.uint64) for v in (p, q))
            both = len(np.intersect1d(s, t, assume_unique=True))
            out.append(100 * both >= percent * (len(s) + len(t) - both))
        return pa.array(out, pa.bool_())

    return F.arrow_udf(run, "boolean")(a, b)


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and signatures leave the similarity possible."""
    share = percent / 100
    margin = 6 * (share * (1 - share) / PLACES) ** 0.5
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}"))
        pairs = pairs.join(own, side)
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return pairs.where(fits).where(same_bytes("s_a", "s_b") >= share - margin).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return pairs.where(similar_sets("set_a", "set_b", percent)).select("a", "b")


def difference(own: Column | str, centre: Column | str) -> Column:
    """What a set adds to the centre's, and the places of the centre's elements that it lacks."""
    kind = pa.struct([("added", pa.binary()), ("removed", pa.binary())])

    def run(sets: pa.Array, centres: pa.Array) -> pa.Array:
        out = []
        for x, h in zip(sets, centres):
            x, h = (np.frombuffer(v.as_py(), np.uint64) for v in (x, h))
            out.append({"added": np.setdiff1d(x, h, assume_unique=True).tobytes(), "removed": np.flatnonzero(~np.isin(h, x, assume_unique=True)).astype(np.uint32).tobytes()})
        return pa.array(out, kind)

    return F.arrow_udf(run, "struct<added:binary,removed:binary>")(own, centre)


class Lists:
    """Sets of several nodes as one array, with what is needed to count common elements."""

    def __init__(self, packed: list[bytes], kind):
        parts = [np.frombuffer(p, kind) for p in packed]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.start = np.append(0, np.cumsum(self.sizes))
        self.values = np.concatenate(parts) if parts else np.empty(0, kind)

    def complement(self, size: int) -> Lists:
        """The other numbers below ``size`` of each set."""
        every = np.arange(size, dtype=np.uint32)
        return Lists([np.delete(every, self.values[a:z]).tobytes() for a, z in zip(self.start, self.start[1:])], np.uint32)

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.values, kind="stable")
        return self.values[order], np.repeat(np.arange(len(self.sizes)), self.sizes)[order]


def _chunks(lists: list[tuple[Lists, np.ndarray]], rows: int):
    """Ranges of rows that meet at most ``CHUNK_HITS`` elements of the other side, one row at least."""
    hits = np.zeros(rows + 1, np.int64)
    for own, index in lists:
        met = np.searchsorted(index, own.values, "right") - np.searchsorted(index, own.values, "left")
        hits += np.append(0, np.cumsum(met))[own.start]
    begin = 0
    while begin < rows:
        end = max(begin + 1, min(begin + 512, int(np.searchsorted(hits, hits[begin] + CHUNK_HITS, "right")) - 1))
        yield begin, end
        begin = end


def _common(own: Lists, index: np.ndarray, owner: np.ndarray, begin: int, end: int, width: int) -> np.ndarray:
    """Numbers of common elements of rows begin..end with every row of the indexed side."""
    values = own.values[own.start[begin]:own.start[end]]
    rows = np.repeat(np.arange(end - begin), own.sizes[begin:end])
    low = np.searchsorted(index, values, "left")
    n = np.searchsorted(index, values, "right") - low
    at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.bincount(np.repeat(rows, n) * width + owner[at], minlength=(end - begin) * width).reshape(end - begin, width)


def compare_blocks(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between nodes of different labels of two blocks of one group, as a forest over labels."""
    left, right = rows[rows.side == 0], rows[rows.side == 1]
    right = left if int(rows.a.iloc[0]) == int(rows.b.iloc[0]) else right
    edges = []
    if len(left) and len(right):
        labels = {x: k for k, x in enumerate(sorted({*left.label, *right.label}))}
        root = np.arange(len(labels))
        lx, rx = (np.array([labels[x] for x in side.label]) for side in (left, right))
        ln, rn = left.node.to_numpy(), right.node.to_numpy()
        h, sl, sr = int(rows.centre_size.iloc[0]), left.n_shingles.to_numpy(np.int64), right.n_shingles.to_numpy(np.int64)
        al, ar = Lists(left.added.to_list(), np.uint64), Lists(right.added.to_list(), np.uint64)
        ml, mr = Lists(left.removed.to_list(), np.uint32), Lists(right.removed.to_list(), np.uint32)
        kept = ml.sizes.sum() + mr.sizes.sum() > h * (len(left) + len(right)) // 2  # then what is shared with the centre is shorter
        if kept:
            ml, mr = ml.complement(h), mr.complement(h)
        (ai, ao), (mi, mo) = ar.index(), mr.index()
        for begin, end in _chunks([(al, ai), (ml, mi)], len(left)):
            both = _common(ml, mi, mo, begin, end, len(right))
            if not kept:
                both = h - (ml.sizes[begin:end, None] + mr.sizes - both)
            both = both + _common(al, ai, ao, begin, end, len(right))
            hit = (100 * both >= percent * (sl[begin:end, None] + sr - both)) & (root[lx[begin:end]][:, None] != root[rx])
            while hit.any():
                x, y = np.nonzero(hit)
                u, v = root[lx[begin + x]], root[rx[y]]
                pairs, first = np.unique(np.column_stack([np.minimum(u, v), np.maximum(u, v)]), axis=0, return_index=True)
                joined = union_find(map(tuple, pairs.tolist()))
                edges += [(ln[begin + x[k]], rn[y[k]]) for k in first]
                root = np.array([joined.get(r, r) for r in root.tolist()])
                hit &= root[lx[begin:end]][:, None] != root[rx]
    return pd.DataFrame({"a": [e[0] for e in edges], "b": [e[1] for e in edges]})


def _mixed(multi: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, label, centre) of buckets that hold several labels, once for each common label of a node's buckets."""
    label = groups.select(F.col("node").alias("known"), F.col("component").alias("label"))
    labelled = materialize(multi.join(label, F.col("node") == F.col("known"), "left").select("key", "node", F.coalesce("label", "node").alias("label")))
    counts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    common = counts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    common = common.select(shuffled_again("key").alias("mixed_key"), F.col("most.label").alias("centre")).hint("merge")
    return materialize(labelled.join(common, F.col("key") == F.col("mixed_key")).select("node", "label", "centre").distinct())


def _links_within(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join different labels inside the groups of ``mixed``."""
    own = sets.select(F.col("node").alias("own_node"), F.col("shingles").alias("own_set"))
    centre = sets.select(F.col("node").alias("centre_node"), F.col("shingles").alias("centre_set")).join(
        mixed.select("centre").distinct(), F.col("centre_node") == F.col("centre"), "left_semi")
    both = mixed.join(own.hint("merge"), F.col("node") == F.col("own_node")).join(centre.hint("merge"), shuffled_again("centre") == F.col("centre_node"))
    size = lambda c: (F.length(c) / 8).cast("long")
    apart = materialize(both.select("centre", "node", "label", size("own_set").alias("n_shingles"), size("centre_set").alias("centre_size"),
                                    difference("own_set", "centre_set").alias("d")).select("centre", "node", "label", "n_shingles", "centre_size", "d.*"))
    heavy = apart.groupBy("centre").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum(F.length("added") + F.length("removed")) / BLOCK_BYTES)).alias("blocks"))
    heavy = heavy.where("blocks > 1").select(F.col("centre").alias("heavy_centre"), F.col("blocks").cast("int").alias("blocks"))
    rows = apart.join(heavy.hint("merge"), shuffled_again("centre") == F.col("heavy_centre"), "left").drop("heavy_centre").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    place = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(F.col("block"), k).alias("a"), F.greatest(F.col("block"), k).alias("b"), (F.col("block") > k).cast("int").alias("side")))
    units = rows.withColumn("block", block).withColumn("u", F.explode(place)).select(
        "centre", "u.*", "node", "label", "n_shingles", "centre_size", "added", "removed")
    return materialize(units.groupBy("centre", "a", "b").applyInPandas(lambda rows: compare_blocks(rows, percent), "a binary, b binary"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_md5, group (null without shingles).

    Two texts are linked if 100 * common shingles >= ``percent`` * all shingles of both. ``component_id`` is the smallest id
    reachable over links.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")
    rows = materialize(docs.select("doc_id", digest, profile("text", width).alias("p")).select("doc_id", "text_md5", "p.*"))
    nodes = materialize(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))

    member = nodes.select(F.explode(band_keys("signature")).alias("key"), "node")
    shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(shuffled_again("key").alias("shared_key")).hint("merge")
    multi = materialize(member.join(shared, F.col("key") == F.col("shared_key")).select("key", "node"))
    least = multi.groupBy("key").agg(F.min("node").alias("hub")).select(shuffled_again("key").alias("hub_key"), "hub").hint("merge")
    star = multi.join(least, F.col("key") == F.col("hub_key")).groupBy("node").agg(F.min("hub").alias("hub")).where("node != hub")

    involved = materialize(multi.select("node").distinct().join(nodes, "node"))
    named = docs.join(involved.where("doc_id IS NOT NULL").select("node", "doc_id"), "doc_id").select("node", own_set("text", "node", width).alias("shingles"))
    nameless = docs.where("doc_id IS NULL").select(shingle_set("text", width).alias("shingles"))  # rows without id are found by their set
    nameless = nameless.select(F.unhex(F.md5("shingles")).alias("node"), "shingles").join(involved.where("doc_id IS NULL"), "node", "left_semi")
    sets = materialize(named.where("shingles IS NOT NULL").union(nameless).dropDuplicates(["node"]))

    links = materialize(_confirmed(_estimated(star.select(F.col("hub").alias("a"), F.col("node").alias("b")), involved, percent), sets, percent))
    groups = materialize(components(links, "a", "b"))
    mixed = _mixed(multi, groups)
    if not mixed.isEmpty():
        groups = materialize(components(links.union(_links_within(mixed, sets, percent)), "a", "b"))

    named = nodes.select("node", "doc_id").join(groups, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id")).select(shuffled_again("component").alias("c2"), "component_id")
    named = materialize(named.join(least.hint("merge"), F.col("component") == F.col("c2")).select(F.col("node").alias("named"), "component_id", F.col("component").alias("group")))
    out = rows.select("doc_id", "n_shingles", "text_md5", "node").join(named.hint("merge"), F.col("node") == F.col("named"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      "text_md5", "group")
