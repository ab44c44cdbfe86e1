"""Helpers that several operators of this package share."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagetrove.session import settled

# A document's words are the runs of characters other than space and \t \n \v \f \r, which is what
# bytes.split() finds in UTF-8. The regular expression says the same to Spark.
WORD = r"[^\x20\x09-\x0D]+"


def utf8(column: str | Column) -> Column:
    """A text as UTF-8 bytes, null as no bytes; Python then needs no decoding."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[list[list]]:
    """The columns of each batch as Python lists, a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield [column.to_pylist() for column in part.columns]


def map_slices(df: DataFrame, work: Callable[[list[list]], list], schema: str, rows: int = 1024) -> DataFrame:
    """Apply ``work`` to lists of column values, ``rows`` at a time; it returns the columns of the result."""
    fields = T.StructType.fromDDL(schema)
    names, types = fields.names, [field.type for field in to_arrow_schema(fields)]

    def run(batches):
        for columns in in_slices(batches, rows):
            made = work(columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=kind) for values, kind in zip(made, types)], names=names)

    return df.mapInArrow(run, schema)


def word_bounds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in the words joined by one space."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    return ends - sizes, ends


def same_row(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Join ``docs`` with ``marks`` (doc_id, text_key, others) on doc_id, null included, and text."""
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    marks = marks.withColumnsRenamed({"doc_id": "__doc_id", "text_key": "__text_key"})
    match = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__key") == F.col("__text_key"))
    return keyed.join(marks, match, how).drop("__key", "__doc_id", "__text_key")


# Rows of a file whose marks meet them in one row of a join, and rows whose marks make one number.
BLOCK, WORD_BITS = 4096, 64


def rows_with_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``df``, a table read from Parquet files, whose ``doc_id`` is in ``ids`` (doc_id, each once): what a
    left semi join gives, but the other columns are not shuffled for it.

    Ids meet the places (file, row) they stand at; the places found are written as one bit for each row of the table,
    and those bits meet the rows by file and block of rows. Spark chooses how: it broadcasts the bits for as long as
    they are few (2.1 MB for 15.4 million rows in 60 files, where its limit is 10 MB), and shuffles the rows beyond that.
    """
    row, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    spot = {"__file": file, "__block": F.floor(row / BLOCK), "__word": F.floor(row % BLOCK / WORD_BITS).cast("int"),
            "__bit": (row % WORD_BITS).cast("int")}
    places = df.select("doc_id", *[column.alias(name) for name, column in spot.items()])
    # A join by shuffle at every size: places are small, and their share of the input stays the same.
    found = places.join(ids.hint("merge"), "doc_id", "left_semi")
    words = found.groupBy("__file", "__block", "__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    blocks = settled(words.groupBy("__file", "__block").agg(
        F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__words")), "places")
    marked = df.withColumns(spot).join(blocks, ["__file", "__block"])
    return marked.where(F.getbit(F.col("__words")[F.col("__word")], F.col("__bit")) == 1).select(df.columns)


def even_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` values that cut an integer column into parts of about equal row counts."""
    shares = [i / parts for i in range(1, parts)]
    return sorted({int(cut) for cut in df.approxQuantile(column, shares, 0.2 / parts)})


def part_of(column: Column, cuts: list[int], least: int = 0) -> Column:
    """Number of cuts that are not above the value: a binary search in the list, as an expression.
    A null value is in part 0."""
    if not cuts:
        return F.lit(least)
    middle = len(cuts) // 2
    return F.when(column >= cuts[middle], part_of(column, cuts[middle + 1:], least + middle + 1)).otherwise(
        part_of(column, cuts[:middle], least))


# A term is a run of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. In UTF-8 all
# bytes of the latter are above 127, so that one table does for bytes.
_TERM_BYTES = bytes(
    at + 32 if 65 <= at <= 90 else at if at >= 128 or chr(at).isalnum() else 32 for at in range(256))
STRETCH = 1 << 20  # bytes of a text that are split at a time


def term_stretches(text: bytes, most: int = STRETCH) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded stretch at a time."""
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + most) if at + most < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end
