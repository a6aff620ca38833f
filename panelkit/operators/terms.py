"""Term frequencies of a text corpus, for the whole corpus or per slice in one job."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import DEFAULTS
from panelkit.functions.scalars import display_weight
from panelkit.functions.textnorm import join_text, normalize_lower
from panelkit.session import spread

PIECE_BYTES = 16 << 20  # of text whose n-grams a task counts together
OUT_ROWS = 50_000  # sent on at a time


def text_columns(df: DataFrame, preferred: Sequence[str] = DEFAULTS.text_columns, k: int = 4) -> list[str]:
    """The preferred columns that exist, otherwise the first ``k`` text columns."""
    found = [c for c in preferred if c in df.columns]
    return found or [n for n, t in df.dtypes if t == "string"][:k]


def corpus(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = (), null_text: str = "",
           collapse: bool = True) -> DataFrame:
    """Normalised text ``texto`` with a row ``weight``.

    Fact tables repeat a few descriptor combinations millions of times: ``collapse`` counts equal combinations
    first, so that each is normalised and split once. Switch it off for long texts that rarely repeat.
    """
    columns = list(columns or text_columns(df))
    if collapse:
        names = list(dict.fromkeys([*keep, *columns]))
        df = df.groupBy(*names).agg(F.count(F.lit(1)).alias("weight"))
    else:
        names = list(dict.fromkeys([*keep, *columns]))
        df = spread(df.select(*names)).withColumn("weight", F.lit(1).cast("long"))
    low = df.select(*keep, F.lower(join_text(columns, null_text)).alias("texto"), "weight")
    return low.select(*keep, normalize_lower("texto").alias("texto"), "weight")


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows with texts (last column) of about ``PIECE_BYTES`` together; a longer text stands alone."""
    held, size = [], 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.binary_length(batch.column(batch.num_columns - 1)), 0))
        ends, begin = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + PIECE_BYTES - size, side="right")))
            held.append(batch.slice(begin, end - begin))
            size += int(ends[end - 1] - before)
            begin = end
            if begin < batch.num_rows or size >= PIECE_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _row_groups(table: pa.Table, columns: int) -> np.ndarray:
    """Number of each row's group of equal values in the first columns."""
    group = np.zeros(table.num_rows, np.int64)
    for column in table.columns[:columns]:
        if pa.types.is_nested(column.type):  # has no dictionary: each row for itself, equal ones meet later
            return np.arange(table.num_rows)
        coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
        group = np.unique(group * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_inverse=True)[1]
    return group


def _count_terms(table: pa.Table, lengths: Sequence[int], stopwords: pa.Array, min_len: int) -> Iterator[pa.RecordBatch]:
    """Each group's n-grams of kept words with their number and the number of texts that hold them."""
    keys = table.num_columns - 1
    group = _row_groups(table, keys)
    by_group = np.argsort(group, kind="stable")
    place = np.empty(len(group), np.int64)  # rows of one group follow each other
    place[by_group] = np.arange(len(group))
    group = group[by_group]
    lists = pc.split_pattern(table.column(keys).combine_chunks(), " ")
    coded = pc.list_flatten(lists).dictionary_encode()
    kept = pc.and_(pc.greater_equal(pc.utf8_length(coded.dictionary), min_len), pc.invert(pc.is_in(coded.dictionary, stopwords)))
    kept = kept.to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
    word, row = coded.indices.to_numpy()[kept].astype(np.int64), place[pc.list_parent_indices(lists).to_numpy()[kept]]
    words, code, shorter = len(coded.dictionary), word, []
    for n in range(1, max(lengths) + 1):
        if n > 1:
            if n > 2:  # as dense numbers, so that the next word has room
                distinct, code = np.unique(code, return_inverse=True)
                shorter.append(distinct)
            code = code[:-1] * words + word[n - 1:]
        same = row[:len(code)] == row[n - 1:]  # the run stays in one text
        if n not in lengths or not same.any():
            continue
        grams = code[same]
        numbers = None
        if int(grams.max()) + 1 > 2**62 // len(group):
            numbers, grams = np.unique(grams, return_inverse=True)
        cells = np.sort(grams * len(group) + row[:len(code)][same])
        grams, at = np.divmod(cells, len(group))
        text_first = np.append(True, cells[1:] != cells[:-1])
        first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (group[at[1:]] != group[at[:-1]])))
        times, docs = np.diff(np.append(first, len(cells))), np.add.reduceat(text_first.astype(np.int64), first)
        left, parts = grams[first] if numbers is None else numbers[grams[first]], []
        for k in range(n, 1, -1):
            left, last = np.divmod(left, words)
            parts.insert(0, last)
            if k > 2:
                left = shorter[k - 3][left]
        parts = [coded.dictionary.take(pa.array(part)) for part in (left, *parts)]
        terms = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
        owner = table.select(range(keys)).take(pa.array(by_group[at[first]]))
        cells = pa.table([*owner.columns, pa.array(np.full(len(first), n, np.int32)), terms, pa.array(times), pa.array(docs)],
                         names=[*owner.column_names, "__n", "term", "__times", "__docs"])
        yield from cells.combine_chunks().to_batches(max_chunksize=OUT_ROWS)


def term_freq(df: DataFrame, text: str = "texto", n: int | Sequence[int] = 1, min_df: int = DEFAULTS.min_df,
              by: Sequence[str] = (), stopwords: Iterable[str] = DEFAULTS.stopwords, min_len: int = 2,
              floor: str = "documents", weight: str | None = "weight") -> DataFrame:
    """Frequency of every n-gram of kept words per slice, from normalised text.

    ``floor`` says what ``min_df`` bounds: the number of documents with the term, or its total frequency. Several
    ``n`` are counted together and told apart by a column ``n``: both counts of all lengths come out of one scan and
    one shuffle. Tasks count the n-grams of some megabytes of text at a time and send on one row per slice, weight and
    n-gram of them.
    """
    by, lengths = list(by), [n] if isinstance(n, int) else list(n)
    if min(lengths) < 1:
        raise ValueError("n must be at least 1")
    rows = df.dropna(subset=by) if by else df
    w = F.col(weight) if weight and weight in df.columns else F.lit(1).cast("long")
    rows = rows.select(*by, w.alias("__w"), F.col(text).alias("__text"))
    left_out = sorted(stopwords)

    def run(batches):
        for piece in _pieces(batches):
            yield from _count_terms(piece, lengths, pa.array(left_out, piece.column(piece.num_columns - 1).type), min_len)

    counted = T.StructType([*rows.schema.fields[:-1], T.StructField("__n", T.IntegerType()), T.StructField("term", T.StringType()),
                            T.StructField("__times", T.LongType()), T.StructField("__docs", T.LongType())])
    cells = rows.mapInArrow(run, counted)
    if isinstance(n, int):
        slices = by
    else:
        cells, slices = cells.withColumnRenamed("__n", "n"), [*by, "n"]
    # Tasks have added up what repeats; bigrams of further texts are mostly new, and a table of them all before the shuffle would only spill.
    freq = cells.repartition(*slices, "term").groupBy(*slices, "term").agg(
        F.coalesce(F.sum(F.col("__w") * F.col("__times")), F.lit(0)).alias("freq"), F.coalesce(F.sum(F.col("__w") * F.col("__docs")), F.lit(0)).alias("doc_freq"))
    return freq.where(F.col("doc_freq" if floor == "documents" else "freq") >= min_df)


def top_terms(freq: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent terms per slice, ties by term. Also caps a vocabulary."""
    if not by:
        return freq.orderBy(F.desc("freq"), "term").limit(k)
    order = W.partitionBy(*by).orderBy(F.desc("freq"), "term")
    return freq.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k).drop("__place")


def cloud_weights(freq: DataFrame, k: int = DEFAULTS.cloud_words, by: Sequence[str] = ()) -> DataFrame:
    """The top terms with a display weight. Windows only see the at most ``k`` terms of a slice."""
    best = top_terms(freq, k, by)
    frame = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    low, high = F.min("freq").over(frame), F.max("freq").over(frame)
    return best.withColumn("weight", display_weight("freq", low, high))
