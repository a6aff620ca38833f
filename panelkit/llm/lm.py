"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs of the training texts are counted. A count c is stored as its level, 1 + floor(log2 c): the filter
holds the pair (n-gram, j) for each j up to the level, so the level of an n-gram is read by probing j = 1, 2, ... until one
is missing. The probability of a word after another mixes the pair's share with the word's own smoothed share, all from
such probes.

Counting: each task reduces its part of the corpus to sorted 48-bit hashes with counts, one packed block per segment of the
hash space (of 10^12 n-grams, 0.4 % would share a hash, far less than the filter's own error); each segment is merged and set into its own bits by one task. The filter has
10 bits per stored item at every size, so that the rate of false probes does not depend on the size of the corpus.

Scoring: a filter that takes at most ``most_bytes`` whatever the n-grams is broadcast. Words with at least 1/2^20 of all tokens, hence at
most 2^20 words, are sent to the workers with their exact counts, which serve the base score; the counts of all others are joined, and
none of them is frequent enough to be a hot key.

Where the filter may be larger, it stays in its segments. The texts are kept once, as blocks of words and numbers. Each block sends every
segment its distinct words and pairs there with their counts in training texts, packed; the segment adds up the counts of all blocks, sets its
bits, and sends back the exact counts of the words and the levels of all n-grams. So the n-grams are shuffled once for counting and
asking together. Both ways read the same bits.

Defined results: a null or empty text is one end token; a null id counts as the empty text when choosing training rows;
repeated rows are counted and scored each; without training tokens all counts are 0; an empty table gives an empty table;
only the two columns named are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.superminhash import GOLD, mix
from panelkit.session import materialize

END = b""  # no word is empty
HASH_BITS = np.uint64((1 << 48) - 1)
HASH_END = np.uint64(xxhash.xxh3_64_intdigest(END)) & HASH_BITS
PAIR = np.uint64(0xD6E8FEB86659FD93)
CHUNK_WORDS = 200_000
HOT_SHARE = 1 << 20
PROBES, BITS_PER_ITEM, MOST_BYTES = 3, 10, 48 << 20
SEGMENT_TOKENS = 2_000_000
BLOCK_WORDS = 1_000_000  # of texts whose n-grams are sent to the segments together
WEIGHT = 0.7  # of the pair's share, where the first word is known
LEVELS = 63


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z as a-z, then one end."""
    words = text.encode().lower().split() if text else []
    words.append(END)
    return words


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for text in texts:
        own = tokens(text.as_py())
        if part and size + len(own) > CHUNK_WORDS:
            yield part
            part, size = [], 0
        part.append(own)
        size += len(own)
    if part:
        yield part


def _hashes(part: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of several texts, and of each word with the word before it (an end before the first)."""
    flat = [w for own in part for w in own]
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat)) & HASH_BITS
    return one, _pairs(one)


def _pairs(one: np.ndarray) -> np.ndarray:
    before = np.append(HASH_END, one[:-1])  # each text ends with an end
    return mix(before * GOLD + one ^ PAIR) & HASH_BITS


def pack(grams: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return grams.astype(np.uint32).tobytes() + (grams >> np.uint64(32)).astype(np.uint16).tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return np.frombuffer(data, np.uint32, n) | np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)


def planes(values: np.ndarray, width: int = 4) -> bytes:
    """``width`` bytes of each number, the lowest bytes of all numbers first: the high ones are mostly zero and compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int = 4) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def pack_sorted(grams: np.ndarray, segments: int, segment: int) -> bytes:
    """Ascending n-grams of one segment as differences, of as many bytes each as the first byte says."""
    gaps = np.diff((grams - np.uint64(segment)) // np.uint64(segments), prepend=np.uint64(0))
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + planes(gaps, width)


def unpack_sorted(data: bytes, segments: int, segment: int) -> np.ndarray:
    return np.cumsum(from_planes(data[1:], data[0]), dtype=np.uint64) * np.uint64(segments) + np.uint64(segment)


def encode_words(one: np.ndarray) -> bytes:
    """Hashes of successive words: each distinct one, frequent ones first, then their numbers by planes of bytes, compressed."""
    distinct, number, times = np.unique(one, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), "<u4")
    rank[order] = np.arange(len(order), dtype="<u4")
    return len(distinct).to_bytes(4, "little") + pack(distinct[order]) + zlib.compress(planes(rank[number]), 1)


def decode_words(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    return unpack(data[4:4 + 6 * n])[from_planes(zlib.decompress(data[4 + 6 * n:]))]


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n): partial counts of the words of ``text``."""

    def run(batches):
        counts: Counter = Counter()

        def packed():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in _chunks(batch.column(0)):
                for own in part:
                    counts.update(own)
                if len(counts) > 300_000:
                    yield packed()
        if counts:
            yield packed()

    return texts.mapInArrow(run, "word binary, n bigint")


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, n = k[order], n[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.intp)
    return k[first], np.add.reduceat(n, first) if len(k) else n


def count_grams(texts: DataFrame, segments: int) -> DataFrame:
    """(segment, grams, counts): sorted hashes of words and pairs of a task's texts with their counts, packed."""

    def run(batches):
        keys, counts, held = [], [], 0

        def packed():
            k, n = _merged(keys, counts)
            segment = k % np.uint64(segments)
            order = np.argsort(segment, kind="stable")
            cuts = np.searchsorted(segment[order], np.arange(segments + 1))
            for s in range(segments):
                at = order[cuts[s]:cuts[s + 1]]
                if len(at):
                    yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "grams": [pack_sorted(k[at], segments, s)], "counts": [n[at].astype(np.uint32).tobytes()]})
            keys.clear()
            counts.clear()

        for batch in batches:
            for part in _chunks(batch.column(0)):
                for h in _hashes(part):
                    k, n = np.unique(h, return_counts=True)
                    keys.append(k)
                    counts.append(n)
                    held += len(k)
                if held > 3_000_000:
                    k, n = _merged(keys, counts)
                    keys[:], counts[:], held = [k], [n], len(k)
                    if held > 2_000_000:
                        yield from packed()
                        held = 0
        if keys:
            yield from packed()

    return texts.mapInArrow(run, "segment int, grams binary, counts binary")


def _places(grams: np.ndarray, level: int, bits) -> list[np.ndarray]:
    z = mix(grams + np.uint64((level + 1) * int(GOLD) & (2**64 - 1)))
    a, b = z >> np.uint64(32), (z & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [((a + np.uint64(i) * b) % bits) for i in range(PROBES)]


def build_segment(grams: np.ndarray, counts: np.ndarray, most_bits: int | None = None) -> np.ndarray:
    """Bytes of one segment of the filter; a bound on its bits makes false probes likelier."""
    level = np.frexp(counts.astype(float))[1]  # 1 + floor(log2 count)
    bits = int(level.sum()) * BITS_PER_ITEM
    bits = max(64, bits if most_bits is None else min(most_bits, bits)) // 8 * 8
    field = np.zeros(bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        for place in _places(grams[level >= j], j, np.uint64(bits)):
            field[place] = True
    return np.packbits(field, bitorder="little")


def build_filter(packed: DataFrame, segments: int) -> DataFrame:
    """(segment, field): the bits of each segment, as many as its items need."""

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for s, grams, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                keys, own = held.setdefault(s, ([], []))
                keys.append(unpack_sorted(grams, segments, s))
                own.append(np.frombuffer(counts, np.uint32).astype(np.int64))
                if len(keys) > 16:
                    k, n = _merged(keys, own)
                    keys[:], own[:] = [k], [n]
        for s, (keys, own) in held.items():
            field = build_segment(*_merged(keys, own))
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "field": [field.tobytes()]})

    return packed.repartition(segments, "segment").mapInArrow(run, "segment int, field binary")


@dataclass
class BloomCounts:
    """Levels of n-grams by membership probes."""

    field: bytes
    bounds: np.ndarray  # first byte of each segment

    def levels(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams), np.int64)
        if not len(self.field):
            return out
        field, segments = np.frombuffer(self.field, np.uint8), np.uint64(len(self.bounds) - 1)
        segment = (grams % segments).astype(np.intp)
        first = self.bounds[segment].astype(np.uint64)
        bits = (self.bounds[segment + 1] - self.bounds[segment]).astype(np.uint64) * np.uint64(8)
        at = np.flatnonzero(bits)
        for j in range(1, LEVELS):
            g, size, begin = grams[at], bits[at], first[at]
            alive = np.ones(len(at), bool)
            for place in _places(g, j, size):
                byte = field[(begin + (place >> np.uint64(3))).astype(np.intp)]
                alive &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at = at[alive]
            if not len(at):
                break
            out[at] = j
        return out


@dataclass
class KnownLevels:
    """Levels of the n-grams of a block, all of them looked up before."""

    grams: np.ndarray  # sorted
    level: np.ndarray

    def levels(self, grams: np.ndarray) -> np.ndarray:
        return self.level[np.searchsorted(self.grams, grams)]


def expected(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; level 0 is 0, level 1 is 1."""
    return np.where(level > 0, (1.5 * np.exp2(level - 1.0) - 0.5), 0.0)


def log_probability(one: np.ndarray, pair: np.ndarray, model: BloomCounts | KnownLevels, total: int, distinct: int) -> np.ndarray:
    """log10 of each token's smoothed probability after the token before it."""
    grams, back = np.unique(one, return_inverse=True)
    own = expected(model.levels(grams))[back]
    before = np.append(expected(model.levels(np.array([HASH_END]))), own[:-1])
    share = np.minimum(expected(model.levels(pair)), before) / np.maximum(before, 1.0)
    weight = np.where(before > 0, WEIGHT, 0.0)
    return np.log10(weight * share + (1 - weight) * np.minimum(1.0, (own + 1) / (total + distinct + 1)))


SCORED = "doc_id {}, uid bigint, held_out boolean, n_tokens bigint, known bigint, logs double, rare array<struct<word:binary,n:int>>, score double"
RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))


def score_tokens(docs: DataFrame, hot: Broadcast, model: Broadcast, bounds: np.ndarray, total: int, distinct: int) -> DataFrame:
    """One row per text: what the hot words and the model give, and the other words for the join."""

    def run(batches):
        filter_, known = BloomCounts(model.value, bounds), hot.value
        for batch in batches:
            at = 0
            for part in _chunks(batch.column("text")):
                one, pair = _hashes(part)
                sizes = np.array([len(own) for own in part], np.int64)
                n_known, logs, rare = [], [], []
                for own in part:
                    found = [known.get(w) for w in own]
                    sure = [x for x in found if x is not None]
                    n_known.append(len(sure))
                    logs.append(float(np.sum(sure)))
                    rare.append([{"word": w, "n": n} for w, n in Counter(w for w, x in zip(own, found) if x is None).items()])
                rows = batch.slice(at, len(part)).select(["doc_id", "uid", "held_out"])
                at += len(part)
                first = np.append(0, np.cumsum(sizes[:-1])).astype(np.intp)
                score = np.add.reduceat(log_probability(one, pair, filter_, total, distinct), first)
                columns = [*rows.columns, pa.array(sizes), pa.array(n_known, pa.int64()), pa.array(logs), pa.array(rare, RARE), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "n_tokens", "known", "logs", "rare", "score"])

    return docs.mapInArrow(run, SCORED.format(docs.schema["doc_id"].dataType.simpleString()))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of several texts one after another, with A-Z as a-z, and how many each text has, its end left out."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = pc.list_flatten(lists)
    kept = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends of a text leave empty pieces
    sizes = np.bincount(pc.list_parent_indices(lists).filter(kept).to_numpy(), minlength=len(texts))
    return flat.filter(kept).cast(pa.large_binary()), sizes


def _pieces(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with texts of about ``size`` bytes together; a longer text stands alone."""
    sums = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(sums, (sums[begin - 1] if begin else 0) + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def count_tokens(texts: DataFrame) -> int:
    """Words of all texts and one end for each."""

    def run(batches):
        n = sum(len(piece) + int(split_words(piece.column("text"))[1].sum()) for batch in batches for piece in _pieces(batch))
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return texts.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def pack_words(words: pa.Array) -> bytes:
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    first = np.frombuffer(words.buffers()[1], np.int64, 1, 8 * words.offset)[0] if len(words) else 0
    data = words.buffers()[2][first:first + int(sizes.sum())].to_pybytes() if len(words) and words.buffers()[2] else b""
    return len(words).to_bytes(4, "little") + zlib.compress(planes(sizes) + data, 1)


def unpack_words(data: bytes) -> pa.Array:
    n, raw = int.from_bytes(data[:4], "little"), zlib.decompress(data[4:])
    ends = np.append(0, np.cumsum(from_planes(raw[:4 * n]))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[4 * n:])])


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words)) & HASH_BITS


def text_blocks(docs: DataFrame) -> DataFrame:
    """One row for every about ``BLOCK_WORDS`` tokens of ``docs`` (doc_id, text, held_out, uid); its first uid names it.

    (block, trained, doc_ids, held, sizes, words, numbers): tokens of training texts, the texts' ids, whether they are held out and their
    tokens, the distinct words, frequent ones first, and the number of the word at each token.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words, counts, rows, n = [], [], [], 0

        def block():
            coded = pa.concat_arrays(words).dictionary_encode()
            sizes, held = np.concatenate(counts), np.concatenate([r.column("held_out").to_numpy(zero_copy_only=False) for r in rows]).astype(bool)
            number = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(sizes), len(coded.dictionary))  # the end is the last word
            times = np.bincount(number, minlength=len(coded.dictionary) + 1)
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            ids = pa.concat_arrays([r.column("doc_id") for r in rows])
            out = {"block": pa.array([rows[0].column("uid")[0].as_py()], pa.int64()), "trained": pa.array([int((sizes + 1)[~held].sum())], pa.int64()),
                   "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "held": [held.tobytes()],
                   "sizes": [zlib.compress(planes(sizes + 1), 1)],
                   "words": [pack_words(pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_binary())]).take(pa.array(order)))],
                   "numbers": [zlib.compress(planes(rank[number]), 1)]}
            for part in (words, counts, rows):
                part.clear()
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for piece in _pieces(batch):
                flat, sizes = split_words(piece.column("text"))
                words.append(flat)
                counts.append(sizes)
                rows.append(piece.select(["doc_id", "uid", "held_out"]))
                n += len(flat) + len(sizes)
                if n >= BLOCK_WORDS:
                    yield block()
                    n = 0
        if rows:
            yield block()

    return docs.mapInArrow(run, f"block bigint, trained bigint, doc_ids array<{id_type}>, held binary, sizes binary, words binary, numbers binary")


@dataclass
class BlockGrams:
    """Words and distinct pairs of a block, and where those of each segment are."""

    words: pa.Array
    number: np.ndarray  # of the word at each token
    hashes: np.ndarray  # of the words
    pair: np.ndarray  # at each token
    pairs: np.ndarray  # distinct, ascending
    times: np.ndarray  # of the pairs in training texts
    word_order: np.ndarray
    word_cuts: np.ndarray
    pair_order: np.ndarray
    pair_cuts: np.ndarray

    @classmethod
    def of(cls, words: bytes, numbers: bytes, trained: np.ndarray, segments: int) -> BlockGrams:
        own, number = unpack_words(words), from_planes(zlib.decompress(numbers)).astype(np.int64)
        hashes = _word_hashes(own)
        pair = _pairs(hashes[number])
        keys = np.sort(pair << np.uint64(1) | trained)  # 49 bits
        first = np.flatnonzero(np.append(True, keys[1:] >> np.uint64(1) != keys[:-1] >> np.uint64(1)))
        pairs = keys[first] >> np.uint64(1)
        times = np.add.reduceat((keys & np.uint64(1)).astype(np.int64), first)
        return cls(own, number, hashes, pair, pairs, times, *_by_segment(hashes, segments), *_by_segment(pairs, segments))

    def word_at(self, s: int) -> np.ndarray:
        return self.word_order[self.word_cuts[s]:self.word_cuts[s + 1]]

    def pair_at(self, s: int) -> np.ndarray:
        return self.pair_order[self.pair_cuts[s]:self.pair_cuts[s + 1]]


def _by_segment(grams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of n-grams by segment, their own order kept, and where each segment begins in it."""
    segment = grams % np.uint64(segments)
    order = np.argsort(segment, kind="stable")
    return order, np.searchsorted(segment[order], np.arange(segments + 1))


def count_and_answer(blocks: DataFrame, segments: int) -> DataFrame:
    """(block, segment, data, distinct): exact counts of a block's words and levels of its n-grams, those of one segment; and a row
    without block for each segment with the number of distinct words of training texts in it.

    No task holds more than one block or what one segment is asked.
    """

    def ask(batches):
        for batch in batches:
            for block, held, sizes, words, numbers in zip(*(batch.column(k).to_pylist() for k in range(5))):
                trained = np.repeat(~np.frombuffer(held, bool), from_planes(zlib.decompress(sizes)).astype(np.int64))
                grams = BlockGrams.of(words, numbers, trained, segments)
                times = np.bincount(grams.number[trained], minlength=len(grams.words))
                for s in range(segments):
                    own, pair = grams.word_at(s), grams.pair_at(s)
                    if len(own) or len(pair):
                        yield pa.RecordBatch.from_pydict({
                            "segment": pa.array([s], pa.int32()), "block": pa.array([block], pa.int64()),
                            "words": [pack_words(grams.words.take(pa.array(own)))], "pairs": [pack_sorted(grams.pairs[pair], segments, s)],
                            "times": [zlib.compress(planes(np.append(times[own], grams.times[pair])), 1)]})

    def answer(batches):
        at, asked = None, []

        def answered():
            words, pairs = [unpack_words(w) for _, w, _, _ in asked], [unpack_sorted(p, segments, at) for _, _, p, _ in asked]
            times = [from_planes(zlib.decompress(t)).astype(np.int64) for *_, t in asked]
            coded = pa.concat_arrays(words).dictionary_encode()
            index, n = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
            np.add.at(n, index, np.concatenate([t[:len(w)] for w, t in zip(words, times)]))
            hashes = _word_hashes(coded.dictionary)
            grams, count = _merged([hashes, *pairs], [n, *(t[len(w):] for w, t in zip(words, times))])
            field = build_segment(grams, count)
            level = BloomCounts(field.tobytes(), np.array([0, len(field)])).levels(grams).astype(np.uint8)
            word_level, begin = level[np.searchsorted(grams, hashes)], 0
            for (block, *_), w, p in zip(asked, words, pairs):
                own = index[begin:begin + len(w)]
                begin += len(w)
                data = planes(n[own], 8) + word_level[own].tobytes() + level[np.searchsorted(grams, p)].tobytes()
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "segment": pa.array([at], pa.int32()),
                                                  "data": [zlib.compress(data, 1)], "distinct": pa.array([None], pa.int64())})
            yield pa.RecordBatch.from_pydict({"block": pa.array([None], pa.int64()), "segment": pa.array([at], pa.int32()),
                                              "data": pa.array([None], pa.binary()), "distinct": pa.array([int((n > 0).sum())], pa.int64())})

        for batch in batches:
            for s, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if asked and s != at:
                    yield from answered()
                    asked.clear()
                at = s
                asked.append(row)
        if asked:
            yield from answered()

    sent = blocks.select("block", "held", "sizes", "words", "numbers").mapInArrow(ask, "segment int, block bigint, words binary, pairs binary, times binary")
    placed = sent.repartition(segments, "segment").sortWithinPartitions("segment")
    return placed.mapInArrow(answer, "block bigint, segment int, data binary, distinct bigint")


SCORES = "doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def score_blocks(blocks: DataFrame, answers: DataFrame, segments: int, total: int, distinct: int) -> DataFrame:
    """Scores of the texts of ``blocks``; neither frame must change between uses. A task holds one block at a time."""
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    every = float(np.log10(total + distinct + 1))

    def run(batches):
        own = None

        def scored():
            ids, held, sizes, grams, n, word_level, level = own
            keys, levels = np.append(grams.hashes, grams.pairs), np.append(word_level, level)
            order = np.argsort(keys)
            logp = log_probability(grams.hashes[grams.number], grams.pair, KnownLevels(keys[order], levels[order]), total, distinct)
            last = np.cumsum(sizes)
            first = last - sizes
            known, logs = (n > 0)[grams.number], np.log10(n + 1)[grams.number]
            base = np.array([np.sum(logs[a:b][known[a:b]]) for a, b in zip(first, last)]) - sizes * every
            return pa.RecordBatch.from_arrays([ids, pa.array(held), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), first)), pa.array(base),
                                               pa.array(np.add.reduceat(logp, first))], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for i, (s, data) in enumerate(zip(batch.column("segment").to_pylist(), batch.column("data").to_pylist())):
                if s < 0:  # the block itself comes first
                    if own:
                        yield scored()
                    held, sizes, words, numbers = (batch.column(k)[i].as_py() for k in ("held", "sizes", "words", "numbers"))
                    held, sizes = np.frombuffer(held, bool), from_planes(zlib.decompress(sizes)).astype(np.int64)
                    grams = BlockGrams.of(words, numbers, np.repeat(~held, sizes), segments)
                    own = (batch.column("doc_ids")[i].values, held, sizes, grams, *(np.zeros(k, np.int64) for k in (len(grams.words), len(grams.words), len(grams.pairs))))
                else:
                    word, pair = grams.word_at(s), grams.pair_at(s)
                    data = zlib.decompress(data)
                    level = np.frombuffer(data, np.uint8, offset=8 * len(word))
                    own[4][word] = from_planes(data[:8 * len(word)], 8).astype(np.int64)
                    own[5][word], own[6][pair] = level[:len(word)], level[len(word):]
        if own:
            yield scored()

    whole = blocks.withColumns({"segment": F.lit(-1), "data": F.lit(None).cast("binary")}).drop("trained")
    both = whole.unionByName(answers.where("block IS NOT NULL").drop("distinct"), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "segment").mapInArrow(run, SCORES.format(id_type))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: tuple[int, int] = (7, 2), most_bytes: int = MOST_BYTES) -> DataFrame:
    """Rows of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows whose crc32 of the id as text is not ``held_out[1]`` modulo ``held_out[0]``. A filter that may take
    more than ``most_bytes`` is probed where its segments are instead of being broadcast.
    """
    sc = docs.sparkSession.sparkContext
    mod, left_out = held_out
    out = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod == left_out
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), out.alias("held_out"))
    train = docs.where(~F.col("held_out")).select("text")

    named = docs.select("doc_id", "text", "held_out", F.monotonically_increasing_id().alias("uid"))  # kept when first used
    # An n-gram with count c is stored with at most c levels, and a token is part of one word and one pair.
    if 2 * count_tokens(train) * BITS_PER_ITEM > 8 * most_bytes:
        blocks = materialize(text_blocks(named))
        total = blocks.agg(F.sum("trained")).first()[0]
        segments = max(1, -(-total // SEGMENT_TOKENS))
        answers = materialize(count_and_answer(blocks, segments))
        distinct = answers.agg(F.sum("distinct")).first()[0]
        return score_blocks(blocks, answers, segments, total, distinct).select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

    words = materialize(count_words(train).groupBy("word").agg(F.sum("n").alias("c")))
    stats = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = stats.total, stats.distinct
    is_hot = F.col("c") * HOT_SHARE >= total
    hot = {bytes(r.word): float(np.log10(r.c + 1)) for r in words.where(is_hot).collect()}

    segments = max(1, -(-total // SEGMENT_TOKENS))
    by_segment = {r.segment: bytes(r.field) for r in build_filter(count_grams(train, segments), segments).collect()}
    bounds = np.append(0, np.cumsum([len(by_segment.get(s, b"")) for s in range(segments)]))
    model = sc.broadcast(b"".join(by_segment.get(s, b"") for s in range(segments)))
    del by_segment

    scored = materialize(score_tokens(named, sc.broadcast(hot), model, bounds, total, distinct))
    rare = scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.n")
    counts = words.where(~is_hot).select("word", "c")
    more = rare.join(counts, "word").groupBy("uid").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    more = more.withColumnRenamed("uid", "more_uid")
    joined = scored.drop("rare").join(more, F.col("uid") == F.col("more_uid"), "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                         F.lit(total).cast("long").alias("train_tokens"), logs.alias("base_score"), "score")
