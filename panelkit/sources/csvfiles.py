"""CSV files of any size in several tasks, with line breaks inside quotes and an encoding for each file.

A file is read as raw lines, in as many splits as Spark makes of it. A first pass keeps one row per split: whether its quote
marks are odd in number, and which encodings its bytes are valid in. The parities compose: a split begins inside a quoted
field if the splits before it hold an odd number of marks together. With that, every task cuts its lines into whole records by
itself; only the two ends of a record that crosses a split are put together by a shuffle. Records are then decoded in the
encoding of their file and parsed by Spark's own CSV parser.

Quote marks stand around fields and are doubled inside; a mark inside an unquoted field is not supported. Encodings must have
the line feed as a byte of its own, as UTF-8 and the single-byte ones do. Empty lines are no records. An empty file has none.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, MARK = b'"', b"\xef\xbb\xbf"
WHOLE, HEADER, END, START = range(4)  # kinds of pieces: a record, a file's first record, the end of a record from before, a start or middle without end
PIECES = "file string, block bigint, kind int, text string"
NO_VALUE = ("nan", "na", "n/a", "null", "none")


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, block, line): raw lines in the order of their split, which begins at byte ``block`` of its file."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").alias("line"))


def _valid(line: Column, encoding: str) -> Column:
    """Whether the bytes of a line are text in an encoding."""
    if encoding.upper().replace("-", "") == "UTF8":
        return F.is_valid_utf8(line)

    def run(lines: pa.Array) -> pa.Array:
        def good(b: bytes | None) -> bool:
            try:
                (b or b"").decode(encoding)
                return True
            except UnicodeDecodeError:
                return False

        return pa.array([good(b) for b in lines.to_pylist()], pa.bool_())

    return F.arrow_udf(run, "boolean")(line.cast("binary"))


def splits(spark: SparkSession, path, encodings: Sequence[str]) -> DataFrame:
    """(file, block, inside, encoding): one row per split; ``inside`` if it begins in a quoted field.

    The encoding is the file's: the first one that all its bytes are valid in, else the last.
    """
    line = F.col("line")
    marks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    valid = [F.bool_and(_valid(line, e)).alias(f"valid_{k}") for k, e in enumerate(encodings[:-1])]
    own = _lines(spark, path).groupBy("file", "block").agg(F.sum(marks).alias("marks"), *valid)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    name = F.coalesce(*[F.when(F.bool_and(f"valid_{k}").over(whole), F.lit(e)) for k, e in enumerate(encodings[:-1])], F.lit(encodings[-1]))
    return own.select("file", "block", (F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2 == 1).alias("inside"), name.alias("encoding"))


class _Records:
    """Cuts the lines of one split after another into pieces."""

    def __init__(self, inside: set, encoding: dict, usual: str):
        self.inside_at, self.encoding, self.usual = inside, encoding, usual
        self.at, self.held, self.out = None, [], []

    def enter(self, file: str, block: int) -> None:
        self.leave()
        self.at, self.inside = (file, block), (file, block) in self.inside_at
        self.first = block == 0
        self.decode = self.encoding.get(file, self.usual)
        self.crossing = self.inside  # the record that is open here began before

    def leave(self) -> None:
        if self.at and self.held:
            self.put(START)
        self.at = None

    def put(self, kind: int) -> None:
        data = b"\n".join(self.held)
        if kind == START:
            data += b"\n"  # the break before what follows in the next split
        elif data.endswith(b"\r"):
            data = data[:-1]
        self.held = []
        if kind == WHOLE and self.first and data:
            kind, self.first, data = HEADER, False, data.removeprefix(MARK)
        if data or kind != WHOLE:
            self.out.append((*self.at, kind, data.decode(self.decode)))

    def add(self, lines: pa.Array) -> None:
        """Lines of the split entered last."""
        data = lines.to_pylist()
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) % 2
        open_ = (np.cumsum(odd) + self.inside) % 2 == 1
        for line, still in zip(data, open_.tolist()):
            self.held.append(line)
            if not still:
                self.put(END if self.crossing else WHOLE)
                self.crossing = False
        if len(data):
            self.inside = bool(open_[-1])

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            columns = list(zip(*self.out))
            self.out = []
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()))], names=["file", "block", "kind", "text"])


def pieces(lines: DataFrame, inside: set, encoding: dict, usual: str) -> DataFrame:
    """(file, block, kind, text): whole records, each file's header, and the pieces of records that cross splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _Records(inside, encoding, usual)
        for batch in batches:
            files, blocks, data = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
            edges = [0, *[i for i in range(1, len(files)) if files[i] != files[i - 1] or blocks[i] != blocks[i - 1]], len(files)]
            for a, z in zip(edges, edges[1:]):
                if a < z:
                    if records.at != (files[a], int(blocks[a])):
                        records.enter(files[a], int(blocks[a]))
                    records.add(data.slice(a, z - a))
            yield from records.taken()
        records.leave()
        yield from records.taken()

    return lines.select("file", "block", F.col("line").cast("binary").alias("line")).mapInArrow(run, PIECES)


def _crossing(parts: DataFrame) -> DataFrame:
    """(text): the records that cross splits, put together from their pieces, which are few: two per split at most."""
    some = parts.where(F.col("kind").isin(END, START))
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, -1)  # an end comes before a start
    done = F.coalesce(F.sum((F.col("kind") == END).cast("long")).over(order), F.lit(0))  # a record takes all pieces since the last end
    joined = some.withColumn("record", done).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))
    return joined.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))


def _names(header: str) -> list[str]:
    names, seen = next(csv.reader([header]), []), set()
    out = []
    for k, name in enumerate(names):
        name = name or f"_c{k}"
        out.append(f"{name}{k}" if name.lower() in seen or sum(n.lower() == name.lower() for n in names) > 1 else name)
        seen.add(out[-1].lower())
    return out


def read_csv(spark: SparkSession, path, encodings: Sequence[str] = ("UTF-8", "ISO-8859-1")) -> DataFrame:
    """All records of one or several CSV files with the same header, as text columns. A record with too few or too many fields fails.

    One pass over the bytes finds where records begin and each file's encoding, a second one reads. The driver gets an entry for
    each split that begins inside quotes, and for each file that is not in the first encoding.
    """
    found = splits(spark, path, encodings).where(F.col("inside") | (F.col("encoding") != encodings[0])).collect()
    inside = {(r.file, r.block) for r in found if r.inside}
    encoding = {r.file: r.encoding for r in found if r.encoding != encodings[0]}
    parts = pieces(_lines(spark, path), inside, encoding, encodings[0])
    first = parts.where(F.col("kind") == HEADER).select("text").first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    header = first.text
    names = _names(header)
    other = F.raise_error(F.concat(F.lit("header differs in "), "file"))
    checked = parts.where((F.col("kind") == WHOLE) | F.when((F.col("kind") == HEADER) & (F.col("text") != header), other.cast("boolean"))).select("text")
    if inside:
        checked = checked.unionByName(_crossing(parts))
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true"}
    return checked.select(F.from_csv("text", ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names), options).alias("r")).select("r.*")


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """Types of text columns in one pass: the least of long, double, boolean and text that holds all values of a column.

    Each value has a kind, kinds of a column combine by or; empty values and the usual words for none fit every type.
    """

    def kind(name: str) -> Column:
        v = F.trim(F.col(f"`{name}`"))
        number = v.try_cast("double").isNotNull() & v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
        return (F.when(v.isNull() | (v == "") | F.lower(v).isin(*NO_VALUE), 0)
                .when(v.rlike(r"^[+-]?\d+$") & v.try_cast("bigint").isNotNull(), 1).when(number, 2)
                .when(F.lower(v).isin("true", "false"), 4).otherwise(8))

    row = df.agg(*[F.bit_or(kind(c)).alias(str(k)) for k, c in enumerate(df.columns)]).first()
    types = {1: T.LongType(), 2: T.DoubleType(), 3: T.DoubleType(), 4: T.BooleanType()}
    return {c: types.get(row[k], T.StringType()) for k, c in enumerate(df.columns)}
