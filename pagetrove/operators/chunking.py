"""Splitting pages into chunks. A chunk never crosses a page and keeps the page's columns."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrove.functions import text as X
from pagetrove.operators.recursive_split import split_recursively

RECURSIVE = "RecursiveCharacterTextSplitter"
TOKENS = "TokenTextSplitter"
MODEL_TOKENS = "SentenceTransformersTokenTextSplitter"
SPLITTERS = (RECURSIVE, MODEL_TOKENS, TOKENS)

# Default chunk size and overlap.
CHUNK_SIZE = 2500
CHUNK_OVERLAP = 100

STRINGS = T.ArrayType(T.StringType(), containsNull=False)


def check_chunk_parameters(size, overlap, splitter=RECURSIVE):
    if not isinstance(size, int) or not isinstance(overlap, int) or size <= 0 or overlap < 0:
        raise ValueError("chunk size must be a positive integer and overlap an integer from 0")
    if overlap >= size:
        raise ValueError("chunk overlap must be smaller than the chunk size")
    if splitter not in SPLITTERS:
        raise ValueError(f"unknown splitter {splitter!r}; known: {', '.join(SPLITTERS)}")


def token_windows(words: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` words; each starts ``size - overlap`` words after the one before."""
    starts = F.when(
        F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(size - overlap))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(words, i + 1, F.lit(size)))


def char_windows(size: int, overlap: int) -> Callable[[Column], Column]:
    """Function of a text column: windows of ``size`` characters, of which each starts ``size - overlap``
    characters after the one before. A blank text has none.

    The windows are cut in Python, because in the JVM a place in a text is found by walking from its start.
    """

    @F.arrow_udf(STRINGS)
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array(
            [[text[at:at + size] for at in range(0, len(text), size - overlap)] if text and text.strip() else []
             for text in texts.to_pylist()], pa.list_(pa.string()))

    return cut


def _pack_lines(text, size):
    """Consecutive lines packed greedily, in one walk over the text."""
    packs, held, filled = [], [], 0
    for line in text.split("\n"):
        if held and filled + 1 + len(line) > size:
            packs.append("\n".join(held))
            held, filled = [], 0
        filled += len(line) + (1 if held else 0)
        held.append(line)
    packs.append("\n".join(held))
    return [pack for pack in packs if pack.strip()]


def line_packs(size: int):
    """Function of a text column: its lines packed greedily into texts of at most ``size`` characters.

    There is no overlap, a line longer than ``size`` makes a text of its own, and blank texts are
    left out.
    """

    @F.arrow_udf(STRINGS)
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([_pack_lines(text, size) if text else [] for text in texts.to_pylist()],
                        pa.list_(pa.string()))

    return pack


def _recursive(size, overlap):
    @F.arrow_udf(STRINGS)
    def split(texts: pa.Array) -> pa.Array:
        return pa.array(
            [split_recursively(text, size, overlap) if text else [] for text in texts.to_pylist()],
            pa.list_(pa.string()),
        )

    return split


def _tokenizer_windows(load_tokenizer, size, overlap):
    @F.arrow_udf(STRINGS)
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load_tokenizer()
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                ids = tokenizer.encode(text) if text else []
                rows.append([tokenizer.decode(ids[at:at + size])
                             for at in range(0, len(ids), size - overlap)])
            yield pa.array(rows, pa.list_(pa.string()))

    return split


def with_splits(
    pages: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    splitter: str = RECURSIVE,
    text_col: str = "page_content",
    tokenizer: Callable | None = None,
) -> DataFrame:
    """The page table with a column ``splits``, the array of each page's chunks."""
    check_chunk_parameters(size, overlap, splitter)
    if splitter == RECURSIVE:
        return pages.withColumn("splits", _recursive(size, overlap)(text_col))
    if tokenizer is not None:
        return pages.withColumn("splits", _tokenizer_windows(tokenizer, size, overlap)(text_col))
    if splitter == MODEL_TOKENS:
        raise ValueError(f"{MODEL_TOKENS} needs a tokenizer")
    worded = pages.withColumn("splits", X.tokens(F.col(text_col)))
    windows = token_windows(F.col("splits"), size, overlap)
    return worded.withColumn("splits", F.transform(windows, lambda words: F.array_join(words, " ")))


def explode_chunks(pages: DataFrame, text_col: str = "page_content") -> DataFrame:
    """One row per chunk of ``with_splits``; the chunk's text takes the place of the page's.

    The outer form is chosen because for the inner one the optimizer puts a filter on the size of
    ``splits`` in front, which would split every text one more time.
    """
    kept = [c for c in pages.columns if c not in (text_col, "splits")]
    exploded = pages.select(*kept, F.posexplode_outer("splits").alias("chunk_idx", text_col))
    return exploded.where(F.col("chunk_idx").isNotNull())


def chunk(pages: DataFrame, *args, text_col: str = "page_content", **kwargs) -> DataFrame:
    """Chunk rows of a page table: its other columns, ``chunk_idx`` from 0, and the chunk text.

    Takes the arguments of ``with_splits``. ``tokenizer`` is a function without arguments that gives
    an object with ``encode`` and ``decode``; it is called once per task. Without one, tokens are
    the words of the cleaned text. Null and blank pages give no chunks.
    """
    return explode_chunks(with_splits(pages, *args, text_col=text_col, **kwargs), text_col)


def chunk_lines(pages: DataFrame, size: int = CHUNK_SIZE, text_col: str = "page_content") -> DataFrame:
    """Chunk rows made of whole lines, without overlap. Blank pages give none."""
    check_chunk_parameters(size, 0)
    return explode_chunks(pages.withColumn("splits", line_packs(size)(text_col)), text_col)


def chunk_characters(
    pages: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, text_col: str = "page_content",
) -> DataFrame:
    """Chunk rows of a fixed number of characters."""
    check_chunk_parameters(size, overlap)
    return explode_chunks(pages.withColumn("splits", char_windows(size, overlap)(text_col)), text_col)
