"""Registered queries: each runs one operator, or a chain of them, over whole test tables."""

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.functions import vectors as V
from pagetrove.operators import chunking, embedding, index, numbering, report, tree_index
from pagetrove.operators import search as nn
from pagetrove.plans import steps
from pagetrove.session import scratch_path, settled, spread, table
from pagetrove.sources import collection as store
from pagetrove.sources import files, tables
from pagetrove.sources.parsers import form_feed_text

# Chunks of the queries, in words, and dimension of the hash vectors.
SIZE, OVERLAP, DIM = 200, 20, 256


def _md5(column, name):
    return F.md5(column).alias(name)


def _documents(spark, sf):
    return spread(table(spark, sf, "documents", "doc_id", "source", "text"))


def _pages(spark, sf):
    """Documents as a page table: the document number stands for the page."""
    return _documents(spark, sf).withColumnsRenamed({"doc_id": "page", "text": "page_content"})


def _corpus(spark, sf):
    return table(spark, sf, "embeddings").withColumnRenamed("embedding", "embeddings")


def _means(spark, sf):
    return index.mean_centroids(_corpus(spark, sf), "label")


def _label_queries(spark, sf):
    """One query per label: the mean vector of its rows."""
    return _means(spark, sf).toDF("query_id", "embeddings")


def _texts(spark, sf):
    return table(spark, sf, "benchmark").toDF("query_id", "text")


# Pages and text


def page_table(spark, sf):
    numbered = numbering.number_within(_documents(spark, sf), "source", "doc_id", out="page")
    return numbered.select("source", "page", "doc_id", _md5(F.col("text"), "content_md5"))


def page_count_by_source(spark, sf):
    return report.page_counts(table(spark, sf, "documents"))


def suffix_filter(spark, sf):
    return table(spark, sf, "pages", "page_id", "url").where(X.has_suffix(F.col("url"), ".HTML"))


def html_pages(spark, sf):
    pages = files.html_pages(spread(table(spark, sf, "pages", "page_id", "html")))
    return pages.select("page_id", _md5(F.col("page_content"), "content_md5"))


def clean_text(spark, sf):
    cleaned = X.clean_text(F.col("text"))
    return _documents(spark, sf).select("doc_id", _md5(cleaned, "clean_md5"))


def clean_text_urls(spark, sf):
    noisy = F.concat(F.lit("  page "), "page_id", F.lit("\n at "), "url", F.lit(" \t ("), "url",
                     F.lit(") end\n"))
    return table(spark, sf, "pages", "page_id", "url").select(
        "page_id", X.clean_text(noisy).alias("cleaned")
    )


def clean_text_array(spark, sf):
    turns = table(spark, sf, "conversations").select(
        "conv_id", F.col("turn").alias("page"), F.col("text").alias("page_content")
    )
    arrays = files.page_arrays(turns, "conv_id", per_row=4)
    cleaned = X.clean_pages(F.col("pages"))
    return arrays.select(
        "conv_id", "part", F.size("pages").alias("page_count"),
        F.try_element_at(cleaned, F.lit(1)).alias("first_page"),
        _md5(F.array_join(cleaned, "\n"), "clean_md5"),
    )


def file_names(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages", "page_id", "url").select(
        "page_id", X.base_name(url).alias("base_name"), X.stem(url).alias("stem"),
        X.extension(url).alias("extension"),
        X.swap_extension(url, ".html", ".docx").alias("chunk_report_name"),
        X.report_name(url).alias("page_report_name"),
    )


def metadata_filter(spark, sf):
    k = X.metadata_field(F.col("props"), "k", "int")
    return table(spark, sf, "events", "event_id", "props").select("event_id", k.alias("k")).where(
        F.col("k") >= 90
    )


# Reports


def page_report(spark, sf):
    pages = numbering.number_within(_documents(spark, sf), "source", "doc_id", out="page")
    blocks = report.page_report(pages.withColumnRenamed("text", "page_content"))
    return blocks.select("source", "page", _md5(F.col("block"), "block_md5"))


def chunk_report(spark, sf):
    # Written first, because numbering reads the chunks twice.
    chunks = settled(chunking.chunk(_pages(spark, sf), SIZE, OVERLAP, chunking.TOKENS), "chunks")
    return report.chunk_report(chunks).select(
        "source", "chunk_number", "page", _md5(F.col("block"), "block_md5")
    )


def report_files(spark, sf):
    """Page report written as text and read back, line by line."""
    path = scratch_path(spark, "report")
    report.write_report(report.page_report(_pages(spark, sf)), path, "page")
    lines = spark.read.text(path)
    return lines.groupBy("source", _md5(F.col("value"), "line_md5")).agg(F.count("*").alias("n"))


def report_names(spark, sf):
    """Chunk reports of sources named like files, under the names of their reports."""
    source = F.concat(F.lit("in/"), "source", F.lit(".PDF"))
    pages = _pages(spark, sf).withColumn("source", source)
    # Written first, because numbering reads the chunks twice.
    chunks = settled(chunking.chunk(pages, SIZE, OVERLAP, chunking.TOKENS), "chunks")
    path = scratch_path(spark, "report")
    name = X.swap_extension(F.col("source"), ".pdf", ".docx")
    report.write_report(report.chunk_report(chunks), path, "chunk_number", name)
    lines = spark.read.text(path)
    return lines.groupBy("report", "source").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


def chunk_summary(spark, sf):
    split = chunking.with_splits(_pages(spark, sf), SIZE, OVERLAP, chunking.TOKENS)
    return report.document_summary(split, chunking.TOKENS)


def chunk_summary_join(spark, sf):
    pages = _pages(spark, sf)
    return report.summary_of(pages, chunking.chunk_lines(pages, 1000), "lines")


# Chunks


def _chunk_rows(chunks):
    return chunks.select(F.col("page").alias("doc_id"), "chunk_idx",
                         F.length("page_content").alias("n_chars"),
                         _md5(F.col("page_content"), "chunk_md5"))


def chunk_token_window(spark, sf):
    return _chunk_rows(chunking.chunk(_pages(spark, sf), SIZE, OVERLAP, chunking.TOKENS))


def chunk_line_pack(spark, sf):
    return _chunk_rows(chunking.chunk_lines(_pages(spark, sf), 1000))


def chunk_recursive(spark, sf):
    return _chunk_rows(chunking.chunk(_pages(spark, sf)))


class _WordPieces:
    """Tokenizer whose tokens are words with the blank before them."""

    def encode(self, text):
        return re.findall(r" ?[^ ]+", text)

    def decode(self, pieces):
        return "".join(pieces)


def tokenizer_chunks(spark, sf):
    return _chunk_rows(chunking.chunk(
        _pages(spark, sf), SIZE, OVERLAP, chunking.MODEL_TOKENS, tokenizer=_WordPieces
    ))


def dense_ids(spark, sf):
    pages = numbering.range_sorted(_pages(spark, sf), "source", "page")
    chunks = chunking.chunk(pages, SIZE, OVERLAP, chunking.TOKENS)
    return numbering.ids_as_written(chunks).select(
        "id", "source", "page", "chunk_idx", _md5(F.col("page_content"), "chunk_md5")
    )


# Embeddings and collections


def hash_embed(spark, sf):
    return embedding.HashEmbedder(DIM).weights(_documents(spark, sf), "text", "doc_id")


def hash_embed_arrow(spark, sf):
    embedded = embedding.embed(_documents(spark, sf), "hash", str(DIM), text_col="text")
    return embedded.select("doc_id", F.posexplode_outer("embeddings").alias("bucket", "x")).where(
        F.col("x") > 0
    ).select("doc_id", "bucket", F.round(F.col("x").cast("double"), 6).alias("weight"))


def tfidf_embed(spark, sf):
    """Weights learned from all documents, then their vectors."""
    found = embedding.TfIdfEmbedder(DIM).fit(_documents(spark, sf), "text")
    embedded = embedding.embed(_documents(spark, sf), found, text_col="text")
    return embedded.select("doc_id", F.posexplode_outer("embeddings").alias("bucket", "x")).where(
        F.col("x") > 0
    ).select("doc_id", "bucket", F.round(F.col("x").cast("double"), 6).alias("weight"))


def _letter_model():
    def run(texts):
        return np.array([[len(t), t.count(" "), t.count("e")] for t in texts], dtype=np.float64)

    return run


def model_embed(spark, sf):
    embedded = embedding.embed(
        _documents(spark, sf), embedding.ModelEmbedder(_letter_model), text_col="text"
    )
    return embedded.select("doc_id", *[
        F.get("embeddings", F.lit(i)).cast("int").alias(name)
        for i, name in enumerate(("n_chars", "n_blanks", "n_e"))
    ])


def embed_distinct(spark, sf):
    """The lines of all documents, of which many are equal, by a model that gets each text once."""
    lines = settled(_documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")),
                    "lines")
    embedded = embedding.embed_distinct(lines, embedding.ModelEmbedder(_letter_model), text_col="t")
    return embedded.select("doc_id", "line", *[
        F.get("embeddings", F.lit(i)).cast("int").alias(name)
        for i, name in enumerate(("n_chars", "n_blanks", "n_e"))
    ])


def _collection_rows(spark, sf):
    return _corpus(spark, sf).select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("page_content"),
        X.page_metadata(F.lit("embeddings"), F.col("vec_id")).alias("metadata"), "embeddings",
    )


def _collection_facts(df):
    # Each element counts with its place, so that a permuted vector shows.
    weighted = F.transform("embeddings", lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x)
    return df.select("id", "page_content", "metadata", F.size("embeddings").alias("dim"),
                     F.round(total, 5).alias("total"))


def collection_roundtrip(spark, sf):
    path = scratch_path(spark, "collection")
    store.create_collection(_collection_rows(spark, sf), path)
    return _collection_facts(store.read_collection(spark, path))


def collection_append(spark, sf):
    """The embeddings, then one more batch: the mean vector of every label, with ids below 0."""
    path = scratch_path(spark, "collection")
    store.create_collection(_collection_rows(spark, sf), path)
    store.insert(_means(spark, sf).select(
        (F.lit(-1) - F.col("cell")).alias("id"), F.lit("mean").alias("page_content"),
        X.page_metadata(F.lit("means"), F.col("cell")).alias("metadata"),
        F.col("centroid").alias("embeddings"),
    ), path)
    return _collection_facts(store.read_collection(spark, path))


def collection_upsert(spark, sf):
    """The embeddings, into which the mean vectors of the labels are put: those of even labels in the place of the
    rows of these ids, the others with ids below 0."""
    path = scratch_path(spark, "collection")
    store.create_collection(_collection_rows(spark, sf), path)
    id_ = F.when(F.col("cell") % 2 == 0, F.col("cell")).otherwise(F.lit(-1) - F.col("cell"))
    store.upsert(_means(spark, sf).select(
        id_.alias("id"), F.lit("mean").alias("page_content"),
        X.page_metadata(F.lit("means"), F.col("cell")).alias("metadata"), F.col("centroid").alias("embeddings"),
    ), path)
    return _collection_facts(store.read_collection(spark, path))


def collection_violations(spark, sf):
    """Documents without vectors and vectors without texts in one table of rows."""
    texts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("page_content"),
        F.lit(None).cast("array<float>").alias("embeddings"),
    )
    vectors = _corpus(spark, sf).select(
        F.col("vec_id").alias("id"), F.lit(None).cast("string").alias("page_content"), "embeddings"
    )
    return store.collection_violations(texts.unionByName(vectors), 64)


def vector_dim(spark, sf):
    return store.vector_dimension(_corpus(spark, sf))


def csv_roundtrip(spark, sf):
    """Documents as parsed files, a line a page, written as CSV and read back."""
    source = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    docs = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        line.alias("page_content"), X.page_metadata(F.col("file"), i).alias("metadata")))
    parsed = _documents(spark, sf).withColumn("file", source).select(
        F.col("file").alias("source"), docs.alias("loaded_docs")
    ).select("source", "loaded_docs", F.size("loaded_docs").alias("page_count"),
             X.clean_pages(F.col("loaded_docs.page_content")).alias("cleaned_text"))
    path = scratch_path(spark, "csv")
    tables.write_csv(parsed, path)
    schema = "source string, loaded_docs string, page_count int, cleaned_text string"
    back = tables.read_csv(spark, path, schema)
    last = F.element_at("loaded_docs", -1)["metadata"]
    return back.select(
        "source", "page_count", X.metadata_field(last, "page", "int").alias("last_page"),
        _md5(F.array_join("loaded_docs.page_content", "\n"), "text_md5"),
        _md5(F.array_join("cleaned_text", "\n"), "clean_md5"),
    )


def summary_csv(spark, sf):
    path = scratch_path(spark, "summary")
    tables.write_csv(chunk_summary(spark, sf), path)
    schema = "file_path string, page_count long, chunk_counts long, chunk_method string"
    return tables.read_csv(spark, path, schema)


def file_scan(spark, sf):
    """Documents written as text files with a form feed after each page, then scanned and parsed."""
    path = scratch_path(spark, "files")
    (_documents(spark, sf).select("text").write.option("lineSep", "\f")
     .option("maxRecordsPerFile", 500).text(path))
    parsed = files.parse_files(files.scan_files(spark, path, ".TXT"), "form_feed")
    pages = files.page_rows(parsed.where("parse_time >= 0"))
    return pages.groupBy(_md5(F.col("page_content"), "content_md5")).agg(
        F.count("*").alias("n_pages")
    )


def _even_sources(content, path):
    """A parser that cannot read the files of every other source."""
    number = int(re.search(r"/source=[^/]*?(\d+)/", path)[1])
    if number % 2:
        raise ValueError(f"source {number} cannot be read")
    return form_feed_text(content, path)


def file_scan_errors(spark, sf):
    """Documents written as text files by source, then parsed; files that fail are set aside in the same pass."""
    path = scratch_path(spark, "files")
    (_documents(spark, sf).select("source", "text").write.partitionBy("source").option("lineSep", "\f")
     .option("maxRecordsPerFile", 500).text(path))
    found = files.scan_files(spark, path, ".txt", recursive=True)
    parsed, failures = files.parse_and_set_aside(found, scratch_path(spark, "parsed"), _even_sources)
    source = F.regexp_extract("source", "/source=([^/]+)/", 1)
    pages = files.page_rows(parsed).select(
        source.alias("source"), F.lit(None).cast("string").alias("error"), _md5(F.col("page_content"), "content_md5"))
    failed = failures.select(source.alias("source"), "error", F.lit(None).cast("string").alias("content_md5")).distinct()
    return pages.unionByName(failed).groupBy("source", "error", "content_md5").agg(F.count("*").alias("n"))


def chunk_summary_files(spark, sf):
    """Summary over parsed documents, of which those with fewer than 400 characters have no pages."""
    source = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    pages = F.when(F.length("text") < 400, F.array()).otherwise(F.split("text", "\n"))
    docs = F.transform(pages, lambda line: F.struct(line.alias("page_content"), F.lit("{}").alias("metadata")))
    parsed = _documents(spark, sf).select(source.alias("source"), docs.alias("loaded_docs"))
    split = chunking.with_splits(files.page_rows(parsed, keep_empty=True), SIZE, OVERLAP, chunking.TOKENS)
    return report.document_summary(split, "lines").groupBy("page_count", "chunk_counts").agg(
        F.count("*").alias("documents"), F.count("file_path").alias("with_path"))


def chunk_char_window(spark, sf):
    return _chunk_rows(chunking.chunk_characters(_pages(spark, sf), 1000, 100))


# Search


def collection_append_search(spark, sf):
    """A collection with an index, to which the mean vectors are added, and hits by the index."""
    path = scratch_path(spark, "index")
    rows = _collection_rows(spark, sf)
    index.build_index(rows, path, _means(spark, sf))
    index.append_to_index(_means(spark, sf).select(
        (F.lit(-1) - F.col("cell")).cast("long").alias("id"), F.lit("mean").alias("page_content"),
        F.lit("{}").alias("metadata"), F.col("centroid").cast("array<float>").alias("embeddings")), path)
    return index.search_index(spark, path, _label_queries(spark, sf), 3, 100, output_fields=["page_content"])


def _knn(spark, sf, k=3, **options):
    return nn.search(_corpus(spark, sf), _label_queries(spark, sf), k, ids=("vec_id",), **options)


def knn_cosine(spark, sf):
    return _knn(spark, sf)


def knn_l2(spark, sf):
    return _knn(spark, sf, metric="L2")


def knn_l2_shifted(spark, sf):
    """The vectors, ten million away from the origin in each direction."""
    def shifted(df):
        return df.withColumn("moved", F.transform("embeddings", lambda x: x.cast("double") + 1e7))

    return nn.search(shifted(_corpus(spark, sf)), shifted(_label_queries(spark, sf)), 3, metric="L2",
                     ids=("vec_id",), anns_field="moved", query_field="moved")


def knn_ip(spark, sf):
    return _knn(spark, sf, metric="IP")


def knn_filtered(spark, sf):
    return _knn(spark, sf, expr="label >= 5")


def knn_threshold(spark, sf):
    return _knn(spark, sf, k=50, threshold=0.3)


def knn_l2_threshold(spark, sf):
    return _knn(spark, sf, k=50, metric="L2", threshold=0.95)


def knn_output_fields(spark, sf):
    return _knn(spark, sf, output_fields=["label"])


def knn_deep(spark, sf):
    """So many hits that they are merged in rounds."""
    return _knn(spark, sf, k=1000)


def variant_filter(spark, sf):
    """A collection with metadata as a VARIANT; search among the rows that a typed path names."""
    path = scratch_path(spark, "collection")
    rows = _corpus(spark, sf).select(
        F.col("vec_id").alias("id"), F.lit("").alias("page_content"), "embeddings",
        F.to_json(F.struct("label", F.struct(F.col("vec_id").alias("number")).alias("place"))).alias("metadata"))
    store.create_collection(rows, path, variant=True)
    hits = nn.search(store.read_collection(spark, path), _label_queries(spark, sf), 3,
                     expr="variant_get(metadata, '$.label', 'int') >= 5", output_fields=["metadata"])
    return hits.select("query_id", "rank", F.col("id").alias("vec_id"), "score",
                       F.variant_get("metadata", "$.place.number", "long").alias("number"))


def knn_single(spark, sf):
    """One vector, the mean of all rows, against the collection."""
    everything = _corpus(spark, sf).withColumn("all", F.lit(0))
    vector = index.mean_centroids(everything, "all").first()["centroid"]
    return nn.nearest(_corpus(spark, sf), vector, 10, ids=("vec_id",), output_fields=["label"])


def ivf_assign(spark, sf):
    placed = index.assign_cells(_corpus(spark, sf), _means(spark, sf))
    return placed.select("vec_id", "cell")


def _peak_queries(spark, sf):
    """One query per label: the greatest value of every position among its rows."""
    parts = _corpus(spark, sf).select("label", F.posexplode("embeddings").alias("at", "x"))
    peaks = parts.groupBy("label", "at").agg(F.max("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))
    return peaks.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda p: p["x"]).alias("embeddings")
    )


def ivf_search(spark, sf):
    path = scratch_path(spark, "index")
    index.build_index(_corpus(spark, sf), path, _means(spark, sf))
    return index.search_index(
        spark, path, _peak_queries(spark, sf), 5, 2, ids=("vec_id",), output_fields=["label"]
    )


def ivf_tree(spark, sf):
    """Cells in two levels, all of them probed: the hits are those of the exact search."""
    path = scratch_path(spark, "tree")
    tree_index.build_tree(_corpus(spark, sf), path, 64, 8, ids=("vec_id",))
    return tree_index.search_tree(spark, path, _label_queries(spark, sf), 3, 10_000, 8, ids=("vec_id",))


def ivf_join(spark, sf):
    """Every row is a query, in the two cells nearest to it; queries and rows meet by a shuffle."""
    path = scratch_path(spark, "index")
    index.build_index(_corpus(spark, sf), path, _means(spark, sf))
    asked = _corpus(spark, sf).select(F.col("vec_id").alias("query_id"), "embeddings")
    return index.search_index(spark, path, asked, 4, 2, ids=("vec_id",), block_bytes=1 << 16)


def range_search(spark, sf):
    """All rows above a threshold, from the cells that can hold any."""
    path = scratch_path(spark, "index")
    index.build_index(_corpus(spark, sf), path, _means(spark, sf))
    return index.range_search(spark, path, _peak_queries(spark, sf), 0.3, ids=("vec_id",), output_fields=["label"])


def ivf_kmeans(spark, sf):
    """Trained cells, all of them probed: the hits are those of the exact search."""
    path = scratch_path(spark, "index")
    index.build_index(_corpus(spark, sf), path, nlist=16)
    return index.search_index(spark, path, _label_queries(spark, sf), 3, 16, ids=("vec_id",))


def text_search(spark, sf):
    """Query texts against the chunks of all documents."""
    pages = _pages(spark, sf)
    hits = steps.text_hits(pages, _texts(spark, sf), 3, SIZE, OVERLAP, threshold=0.5)
    return hits.select("query_id", "rank", F.col("page").alias("doc_id"), "chunk_idx", "score",
                       _md5(F.col("page_content"), "chunk_md5"))


def tfidf_search(spark, sf):
    """Query texts against the chunks of all documents, by vectors with weights learned from the chunks."""
    hits = steps.text_hits(_pages(spark, sf), _texts(spark, sf), 3, SIZE, OVERLAP, "tfidf", threshold=0.3)
    return hits.select("query_id", "rank", F.col("page").alias("doc_id"), "chunk_idx", "score",
                       _md5(F.col("page_content"), "chunk_md5"))


def stored_search(spark, sf):
    """The same search through a stored collection with dense ids and all cells of its index."""
    flow = steps.DocumentSearch(spark, scratch_path(spark, "stored"))
    pages = numbering.range_sorted(_pages(spark, sf), "source", "page")
    pages = pages.withColumn("metadata", X.page_metadata(F.col("source"), F.col("page")))
    chunks = chunking.chunk(pages, SIZE, OVERLAP, chunking.TOKENS)
    flow.embed_and_store(chunks, nlist=8)
    hits = flow.retrieve(_texts(spark, sf), threshold=0.5, nprobe=8,
                         output_fields=["page_content", "metadata"])
    return hits.select("query_id", "rank", "id", "score", _md5(F.col("page_content"), "chunk_md5"),
                       X.metadata_field(F.col("metadata"), "page", "long").alias("doc_id"))


QUERIES = [
    page_table, page_count_by_source, suffix_filter, html_pages, clean_text, clean_text_urls,
    clean_text_array, file_names, metadata_filter, page_report, chunk_report, report_files,
    chunk_summary, chunk_summary_join, chunk_summary_files, chunk_char_window, chunk_token_window, chunk_line_pack, chunk_recursive,
    tokenizer_chunks, dense_ids, hash_embed, hash_embed_arrow, model_embed, collection_roundtrip,
    collection_append, collection_violations, vector_dim, csv_roundtrip, summary_csv, file_scan,
    collection_append_search, knn_cosine, knn_l2, knn_l2_shifted, knn_ip, knn_filtered, knn_threshold, knn_l2_threshold, knn_output_fields,
    knn_single, ivf_assign, ivf_search, ivf_kmeans, text_search, stored_search,
    tfidf_embed, tfidf_search, collection_upsert, ivf_join, ivf_tree, range_search,
    file_scan_errors, variant_filter, embed_distinct, knn_deep, report_names,
]
