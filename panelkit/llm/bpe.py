"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Pre-tokenisation needs no regular expression. Every code point gets a class (letter, number, space, ...); classes that
depend on the next one or two characters (contractions, the last white space of a run) are found by shifting the array.
Each class is a function on the seven states of a small automaton. Composition is associative, and all compositions of
these functions form a small set, so a composition is one table lookup: blocks of text are composed side by side, the
block totals are scanned, and a last pass marks where slices start. Slices are merged by rank; short ones are cached.

Defined results: a null or empty text has no ids and decodes to no bytes; each row is handled by itself, so repeated
rows, other columns and empty tables need nothing; a slice of any length merges in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.llm.batches import text_pieces

CHUNK_BYTES = 1 << 19
CACHE_SLICES = 1 << 18
CACHED_CHARS = 48
BLOCK = 256

# The White_Space property.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

SEP, LETTER, NUMBER, OTHER, SHORT, LONG, MID, SPACE, WHITE, PAD = range(10)  # SHORT, LONG: apostrophe before 1 or 2 letters
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINING, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a slice starts here", by state and class."""
    step = np.zeros((8, 10), np.uint8)
    starts = np.ones((8, 10), np.uint8)
    step[:, PAD], starts[:, PAD] = np.arange(8), 0
    for kind, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[:, kind] = state
        starts[[state, JOINING], kind] = 0
    for kind, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        step[:, kind] = state
        step[[IN_OTHERS, JOINING], kind] = IN_OTHERS
        starts[[IN_OTHERS, JOINING], kind] = 0
    step[:, MID], starts[IN_WHITE, MID] = IN_WHITE, 0
    step[:, SPACE], step[:, WHITE], step[:, SEP] = JOINING, START, START
    step[ONE_LEFT, LETTER], step[TWO_LEFT, LETTER] = START, ONE_LEFT
    starts[[ONE_LEFT, TWO_LEFT], LETTER] = 0
    return step, starts


def _monoid(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the class functions: table of compositions, function of each class, first state's image."""
    found = {tuple(step[:, k]): k for k in range(step.shape[1])}
    index: dict[tuple, int] = {}
    for f in found:
        index[f] = len(index)
    todo, gens = list(index), list(index)
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[s] for s in f)
            if h not in index:
                index[h] = len(index)
                todo.append(h)
    all_f = np.array(list(index), np.uint8)
    key = {f: i for f, i in index.items()}
    table = np.empty((len(all_f), len(all_f)), np.uint16)
    for i, f in enumerate(all_f):
        for j, g in enumerate(all_f):
            table[i, j] = key[tuple(g[f])]
    of_class = np.array([key[tuple(step[:, k])] for k in range(step.shape[1])], np.uint16)
    return table.ravel(), of_class, all_f[:, START].copy()


class PreTokenizer:
    """Slice bounds of many texts at once."""

    def __init__(self):
        self.step, self.starts = _automaton()
        self.table, self.of_class, self.image = _monoid(self.step)
        self.size = len(self.image)
        kinds = np.full(0x110001, OTHER, np.uint8)
        for cp in range(0x110000):
            major = unicodedata.category(chr(cp))[0]
            if major == "L":
                kinds[cp] = LETTER
            elif major == "N":
                kinds[cp] = NUMBER
        kinds[WHITE_SPACE] = WHITE
        self.kinds = kinds

    def classes(self, codes: np.ndarray, seps: np.ndarray) -> np.ndarray:
        kinds = self.kinds[codes]
        kinds[seps] = SEP
        following = np.append(kinds[1:], SEP)
        white = kinds == WHITE
        last = white & (following != WHITE) & (following != SEP)
        out = kinds.copy()
        out[white & ~last] = MID
        out[last & (codes == 0x20)] = SPACE
        at = np.flatnonzero((codes == 0x27) & (kinds == OTHER))
        if len(at):
            ahead = np.append(codes, [0, 0])
            ahead[seps] = 0
            one, two = ahead[at + 1], ahead[at + 2]
            out[at[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
            pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            out[at[pairs]] = LONG
        return out

    def bounds(self, codes: np.ndarray, seps: np.ndarray) -> np.ndarray:
        """Positions where a slice or a separator starts."""
        kinds = self.classes(codes, seps)
        n, blocks = len(kinds), -(-len(kinds) // BLOCK)
        padded = np.full(blocks * BLOCK, PAD, np.uint8)
        padded[:n] = kinds
        columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
        total = self.of_class[columns[0]].astype(np.intp)
        for j in range(1, BLOCK):
            total = self.table[total * self.size + self.of_class[columns[j]]].astype(np.intp)
        ahead = np.append(self.of_class[PAD], total[:-1]).astype(np.intp)  # exclusive scan of the block totals
        width = 1
        while width < blocks:
            ahead[width:] = self.table[ahead[:-width] * self.size + ahead[width:]]
            width *= 2
        state = self.image[ahead].astype(np.intp)
        marks, step = self.starts.ravel(), self.step.ravel()
        out = np.empty((BLOCK, blocks), np.uint8)
        for j in range(BLOCK):
            at = state * 10 + columns[j]
            out[j] = marks[at]
            state = step[at].astype(np.intp)
        return np.flatnonzero(out.T.ravel()[:n])


class Codec(dict):
    """Ranks of byte strings; as a dict, the cache of slices and their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.bytes_of = dict(map(reversed, ranks.items()))
        self.cut = PreTokenizer()

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.merge(piece.encode())
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_SLICES:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the pair of lowest rank, leftmost first, is joined until no pair has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) > 96:
            return self._merge_long(piece)
        none = len(ranks)
        get = ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return tuple(map(ranks.__getitem__, parts))

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := piece[i:i + 2]) in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := joined + parts[after[i]]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := before[i]) >= 0 and (p := parts[h] + joined) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        return tuple(ranks[p] for p in parts if p is not None)

    def encode_chunk(self, texts: list[str]):
        """Ids of all texts in one array, its bounds by text, slice starts in code points and first ids, bounds by text."""
        joined = "\n".join(texts) + "\n"
        seps = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        at = self.cut.bounds(codes, seps)
        ends = np.append(at[1:], len(codes))
        is_slice = np.ones(len(at), bool)
        is_slice[np.searchsorted(at, seps)] = False
        starts, ends = at[is_slice], ends[is_slice]
        ids = [self[joined[a:b]] for a, b in zip(starts.tolist(), ends.tolist())]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first_ids = np.append(0, np.cumsum(sizes))
        slices = np.append(0, np.searchsorted(starts, seps))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(first_ids[-1]))
        id_bounds = first_ids[slices]
        texts_of = np.repeat(np.arange(len(texts)), np.diff(slices))
        begins = np.append(0, seps[:-1] + 1)
        return flat, id_bounds, starts - begins[texts_of], first_ids[:-1] - id_bounds[texts_of], slices

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[int, Codec] = {}


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def codec(data: bytes) -> Codec:
    """One codec per vocabulary and Python worker."""
    key = hash(data)
    if key not in _CODECS:
        _CODECS[key] = Codec(parse_ranks(data))
    return _CODECS[key]


def read_vocabulary(path: str) -> bytes:
    """A rank file (base64 and rank per line), read on the driver; under 1 MB, it travels with the function."""
    with open(path, "rb") as file:
        return file.read()


def _list(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(text: Column | str, vocabulary: bytes) -> Column:
    """Struct of a text's ids, and for each slice its start (code points) and the index of its first id."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(vocabulary)
        for part in _pieces(batches):
            flat, bounds, starts, firsts, slices = own.encode_chunk(part)
            yield pa.StructArray.from_arrays([_list(flat, bounds), _list(starts, slices), _list(firsts, slices)], ["ids", "slice_starts", "slice_ids"])

    return F.arrow_udf(run, "struct<ids:array<int>, slice_starts:array<int>, slice_ids:array<int>>")(text)


def _pieces(batches: Iterator[pa.Array]) -> Iterator[list[str]]:
    for batch in batches:
        for part in text_pieces(batch, CHUNK_BYTES):
            yield [t or "" for t in part]


def decode(ids: Column | str, vocabulary: bytes) -> Column:
    """Bytes of an array of ids; null ids give no bytes."""

    def run(batch: pa.Array) -> pa.Array:
        own = codec(vocabulary)
        return pa.array([own.decode(x or ()) for x in batch.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def round_trip(text: Column | str, vocabulary: bytes) -> Column:
    """Struct of a text's ids and of the bytes these ids decode to, in one visit to the Python worker."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(vocabulary)
        for part in _pieces(batches):
            flat, bounds, *_ = own.encode_chunk(part)
            ids, b = flat.tolist(), bounds.tolist()
            decoded = pa.array([own.decode(ids[i:j]) for i, j in zip(b, b[1:])], pa.binary())
            yield pa.StructArray.from_arrays([_list(flat, bounds), decoded], ["ids", "decoded"])

    return F.arrow_udf(run, "struct<ids:array<int>, decoded:binary>")(text)
