"""Ranked lexical search in reverse: the items are indexed, and every document streams through their index.

The items' terms form an inverted index, which is small beside the documents. It is cut into chunks of a bounded number of
bytes, each broadcast in a pass of its own, so that any number of items can be served. A first pass counts documents, terms
and the documents that hold each item term; a second one takes each document's term counts through the postings and keeps a
heap of the best documents per item and task. The heaps of all tasks merge in two levels, so that no task gets more rows
than a heap's size times a bounded number of tasks.

Score: for each term of the item, repeats included, w * ((10^9 * tf) div (1000 * tf + 12 * m)), with
w = floor(1000 * ln((2N+2) / (2df+1))) and m = 75 + (25 * n * N) div L.

Defined results: null and empty texts have no terms, and are neither counted nor found; an item without terms finds nothing;
repeated items are ranked each by itself, as are repeated documents; documents without id rank behind others of their score;
an empty table of documents or items gives an empty table; only the columns named are read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from panelkit.llm.batches import text_pieces

TOP = 20
INDEX_BYTES = 16 << 20  # terms and postings of one broadcast; a single item may exceed it, as may a row
PIECE_BYTES = 1 << 20
MERGE_TASKS = 64
NO_ID = 1 << 64
#: Separators become blanks, A-Z become a-z; everything from 0x80 on belongs to terms.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


@dataclass
class Index:
    """Postings of one chunk of items: of each term, the items that hold it and how often."""

    ids: list = field(default_factory=list)
    place: dict[bytes, int] = field(default_factory=dict)
    items: list[list[int]] = field(default_factory=list)
    times: list[list[int]] = field(default_factory=list)
    size: int = 0

    def add(self, item_id, words: list[bytes]) -> None:
        number = len(self.ids)
        self.ids.append(item_id)
        for word, times in Counter(words).items():
            if word not in self.place:
                self.place[word] = len(self.items)
                self.items.append([])
                self.times.append([])
                self.size += len(word) + 100
            at = self.place[word]
            self.items[at].append(number)
            self.times[at].append(times)
            self.size += 16


def index_chunks(items: Iterator[Row]) -> Iterator[Index]:
    """Indexes of at most ``INDEX_BYTES`` each, from rows (item_id, text)."""
    now = Index()
    for row in items:
        words = terms(row.text)
        if now.ids and now.size + sum(map(len, words)) + 116 * len(words) > INDEX_BYTES:
            yield now
            now = Index()
        now.add(row.item_id, words)
    if now.ids:
        yield now


def _counted(batches: Iterator[pa.RecordBatch], place: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Of one task: documents per item term; at -1 the documents with a term, at -2 all terms."""
    found = np.zeros(len(place), np.int64)
    docs = total = 0
    for batch in batches:
        for part in text_pieces(batch.column(0), PIECE_BYTES):
            for text in part:
                words = terms(text)
                docs += bool(words)
                total += len(words)
                found[[place[w] for w in set(words) if w in place]] += 1
    hit = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, [-1, -2])), pa.array(np.append(found[hit], [docs, total]))], names=["term", "n"])


class Heaps:
    """The best ``top`` documents of every item met so far, as (score, -id)."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # the lowest score that may enter

    def push(self, item: int, score: int, doc_id: int | None) -> None:
        heap, entry = self.heaps[item], (score, -(NO_ID if doc_id is None else doc_id))
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.top:
            self.least[item] = heap[0][0]


def _score_piece(texts: list, doc_ids: list, index: dict, df: np.ndarray, docs: int, total: int, heaps: Heaps) -> None:
    """Scores of a piece of documents against all items, pushed to the heaps."""
    place, start, item, times = index["place"], index["start"], index["item"], index["times"]
    rows, cols, tf, m = [], [], [], []
    for row, text in enumerate(texts):
        words = terms(text)
        held = [(place[w], c) for w, c in Counter(words).items() if w in place]
        rows += [row] * len(held)
        cols += [h[0] for h in held]
        tf += [h[1] for h in held]
        m += [75 + 25 * len(words) * docs // total] * len(held)
    if not rows:
        return
    rows, cols, tf, m = (np.array(x, np.int64) for x in (rows, cols, tf, m))
    weight = df[cols] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    n = start[cols + 1] - start[cols]
    at = np.repeat(start[cols] - np.cumsum(n) + n, n) + np.arange(n.sum())  # postings of every (document, term)
    scores = np.zeros((len(texts), len(heaps.heaps)), np.int64)
    np.add.at(scores, (np.repeat(rows, n), item[at]), np.repeat(weight, n) * times[at])
    for row, one in zip(*np.nonzero(scores >= heaps.least)):
        if scores[row, one] >= heaps.least[one]:
            heaps.push(one, int(scores[row, one]), doc_ids[row])


def _best(batches: Iterator[pa.RecordBatch], index: dict, df: np.ndarray, docs: int, total: int, top: int) -> Iterator[pa.RecordBatch]:
    heaps = Heaps(index["items"], top)
    step = max(1, (1 << 22) // (8 * max(1, index["items"])))  # rows whose scores fit in 4 MB
    for batch in batches:
        ids = batch.column(0).to_pylist()
        done = 0
        for part in text_pieces(batch.column(1), PIECE_BYTES):
            for k in range(0, len(part), step):
                _score_piece(part[k:k + step], ids[done + k:done + k + step], index, df, docs, total, heaps)
            done += len(part)
    rows = [(i, None if -x == NO_ID else -x, s) for i, heap in enumerate(heaps.heaps) for s, x in heap]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["item", "doc_id", "score"])


def _search_chunk(docs: DataFrame, index: Index, top: int) -> DataFrame:
    """(item, doc_id, score, rank) of one chunk of items."""
    spark = docs.sparkSession
    start = np.cumsum([0, *map(len, index.items)])
    packed = spark.sparkContext.broadcast({
        "place": index.place, "start": start, "items": len(index.ids), "item": np.array([i for x in index.items for i in x], np.int64),
        "times": np.array([t for x in index.times for t in x], np.int64)})
    counted = docs.select("text").mapInArrow(lambda b: _counted(b, packed.value["place"]), "term bigint, n bigint")
    held = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # one row per term of the chunk
    n, total = held.get(-1, 0), held.get(-2, 0)
    df = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * held.get(k, 0) + 1))) for k in range(len(index.items))], np.int64)
    best = docs.select("doc_id", "text").mapInArrow(lambda b: _best(b, packed.value, df, n, max(total, 1), top), "item bigint, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = best.withColumn("task", F.spark_partition_id() % MERGE_TASKS).withColumn("rank", place("item", "task")).where(F.col("rank") <= top)
    return some.withColumn("rank", place("item")).where(F.col("rank") <= top).select("item", "doc_id", "score", "rank")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for index in index_chunks(items.toLocalIterator()):
        names = spark.createDataFrame(list(enumerate(index.ids)), f"number bigint, item_id {kind}")
        found = _search_chunk(docs, index, top).join(F.broadcast(names), F.col("item") == F.col("number"))  # ids of one bounded chunk
        out = out.union(found.select("item_id", "rank", "doc_id", "score"))
    return out
