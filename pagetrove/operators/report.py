"""Per-document summary and text reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.operators.numbering import number_within, range_sorted


def page_counts(pages: DataFrame) -> DataFrame:
    """Pages per source."""
    return pages.groupBy("source").agg(F.count("*").alias("page_count"))


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per source."""
    return chunks.groupBy("source").agg(F.count("*").alias("chunk_counts"))


def document_summary(split_pages: DataFrame, method: str) -> DataFrame:
    """File path, page count, chunk count and method per source, from pages that carry ``splits``.

    Both counts come from one pass and one partial aggregation; no join of pages with chunks is
    needed. The path of a document without chunks is null. A row with a null page stands for a
    document without pages.
    """
    counts = split_pages.groupBy("source").agg(
        F.count("page").alias("page_count"),
        F.sum(F.greatest(F.coalesce(F.size("splits"), F.lit(0)), F.lit(0)).cast("long")).alias("chunk_counts"),
    )
    return counts.select(
        F.when(F.col("chunk_counts") > 0, F.col("source")).alias("file_path"),
        "page_count", "chunk_counts", F.lit(method).alias("chunk_method"),
    )


def summary_of(pages: DataFrame, chunks: DataFrame, method: str) -> DataFrame:
    """The same summary where pages and chunks are tables of their own; one row per source on both
    sides of the join."""
    chunked = chunk_counts(chunks).withColumnRenamed("source", "__source")
    counts = page_counts(pages).join(chunked, F.col("source").eqNullSafe(F.col("__source")), "left")
    chunked = F.coalesce("chunk_counts", F.lit(0))
    return counts.select(
        F.when(chunked > 0, F.col("source")).alias("file_path"),
        "page_count", chunked.alias("chunk_counts"), F.lit(method).alias("chunk_method"),
    )


def page_report(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """One report block per page; pages count from 0, blocks from 1."""
    return pages.select(
        "source", page_col, X.page_block(F.col(page_col) + 1, F.col("page_content")).alias("block")
    )


def chunk_report(chunks: DataFrame) -> DataFrame:
    """One report block per chunk, numbered through the whole document."""
    numbered = number_within(chunks, "source", "page", ["chunk_idx"], out="chunk_number", start=1)
    return numbered.select(
        "source", "chunk_number", "page",
        X.chunk_block(F.col("chunk_number"), F.col("page"), F.col("page_content")).alias("block"),
    )


def write_report(blocks: DataFrame, path: str, order_col: str, name: Column | None = None) -> None:
    """Write blocks as text, one folder per source.

    With ``name`` there is a folder per name around them, such as ``text.report_name``; sources of one name
    keep their own folders in it, so that equal file names do not mix. A source's blocks are sorted over as many
    files as its size asks for; the files, in the order of their names, make up the report.
    """
    folders = ["source"] if name is None else ["report", "source"]
    named = blocks if name is None else blocks.withColumn("report", name)
    # Sorted by the folders first, so that the writer keeps the order.
    (range_sorted(named, *folders, order_col).select(*folders, "block")
     .write.mode("overwrite").partitionBy(*folders).option("lineSep", "\n").text(path))
