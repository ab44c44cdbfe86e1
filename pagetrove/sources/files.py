"""Folders of files to parsed documents and pages."""

import json
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.sources.parsers import parser

PARSED = (
    "source string, parse_time double, "
    "loaded_docs array<struct<page_content: string, metadata: string>>, error string"
)


def _any_case(suffix):
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def scan_files(
    spark: SparkSession, path: str, suffix: str = ".pdf", recursive: bool = False
) -> DataFrame:
    """Files of a folder, or a single file, whose name ends in the suffix, whatever the case.

    Raises ValueError if there is none. ``content`` is read only where it is used.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{_any_case(suffix)}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    if files.select("path").isEmpty():
        raise ValueError(f"{path} holds no file that ends in {suffix}")
    return files


def _parsed(files, parse, set_aside):
    parse = parser(parse)

    def run(batches):
        for batch in batches:
            for source, content in zip(batch["path"], batch["content"], strict=True):
                begun, error = time.perf_counter(), None
                try:
                    pages = list(parse(content, source))
                except Exception as failure:
                    if not set_aside:
                        raise
                    pages, error = [], f"{type(failure).__name__}: {failure}"
                seconds = time.perf_counter() - begun
                docs = []
                for number, page in enumerate(pages):
                    text, extra = page if isinstance(page, tuple) else (page, {})
                    metadata = {**extra, "source": source, "page": number}
                    docs.append({"page_content": text,
                                 "metadata": json.dumps(metadata, ensure_ascii=False)})
                # One file per frame: a batch of parsed files has no bound of its own.
                yield pd.DataFrame(
                    {"source": [source], "parse_time": [seconds], "loaded_docs": [docs], "error": [error]}
                )

    parsed = files.select("path", "content").mapInPandas(run, PARSED)
    return parsed.select(
        "source", "loaded_docs", F.size("loaded_docs").alias("page_count"), "parse_time",
        X.clean_pages(F.col("loaded_docs.page_content")).alias("cleaned_text"), "error",
    )


def parse_files(files: DataFrame, parse="PyPDFLoader") -> DataFrame:
    """One row per file: source, pages, page count, parse time, cleaned page texts.

    Metadata is JSON text with at least ``source`` and ``page`` (from 0). An error of the parser
    fails the job.
    """
    return _parsed(files, parse, False).drop("error")


def parse_and_set_aside(
    files: DataFrame, path: str, parse="PyPDFLoader", most_failures: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(parsed documents, failures): the rows of ``parse_files`` for the files that could be parsed, and (source,
    error, parse_time) for those whose parser raised an error.

    Every file is parsed once; both kinds of rows go to ``path`` in the same pass, in folders of their own, and
    what was there is replaced. More than ``most_failures`` failures are an error; the rows stay for a look at
    them. A parser that takes its whole process down still fails the job.
    """
    rows = _parsed(files, parse, True)
    rows = rows.withColumn("failed", F.col("error").isNotNull())
    rows.write.mode("overwrite").partitionBy("failed").parquet(path)
    # With the schema given, a folder without any row is read, too.
    back = files.sparkSession.read.schema(rows.schema).parquet(path)
    failures = back.where("failed").select("source", "error", "parse_time")
    if most_failures is not None:
        count = failures.count()
        if count > most_failures:
            raise ValueError(f"{count} files could not be parsed, more than {most_failures}; see {path}")
    return back.where("NOT failed").drop("error", "failed"), failures


def page_rows(parsed: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Page table of parsed documents: source, page, page_content, metadata.

    With ``keep_empty`` a document without pages has one row, all null but for the source.
    """
    if "loaded_docs" not in parsed.columns:
        raise ValueError("the column 'loaded_docs' is missing")
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return parsed.select("source", explode("loaded_docs").alias("page", "doc")).select(
        "source", "page", "doc.page_content", "doc.metadata"
    )


def page_arrays(pages: DataFrame, key: str = "source", per_row: int = 1024) -> DataFrame:
    """Pages back in arrays, in page order: one row per document and run of ``per_row`` pages.

    Documents of up to ``per_row`` pages come out as one row; a larger one takes several, so no row
    and no group grows with the document.
    """
    part = F.floor(F.col("page") / per_row).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct("page", "page_content")))
    return pages.groupBy(key, part.alias("part")).agg(
        F.transform(ordered, lambda p: p["page_content"]).alias("pages")
    )


def html_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Visible text of web pages that stand in a table; needs no Python."""
    return pages.select(key, X.html_text(F.col(html)).alias("page_content"))
