"""The four steps of document retrieval, with their defaults, on top of the operators."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.operators import chunking, embedding, index, numbering, report
from pagetrove.operators import search as nn
from pagetrove.session import drop_folder, scratch_path, settled
from pagetrove.sources import collection as store
from pagetrove.sources import files, tables

# Fixed value: columns returned with a hit unless others are asked for.
OUTPUT_FIELDS = ("page_content",)
# What the index holds of a collection: texts are fetched from the collection.
INDEXED = ("id", "metadata", "embeddings")


class DocumentSearch:
    """Extract, chunk, embed and store, retrieve.

    ``collection`` is the path under which the store step keeps the indexed collection. One embedder
    serves chunks and queries. One that is fitted to the corpus, as ``tfidf`` is, learns from the chunks that are
    stored, and is kept with them, so that another object over the same path uses the same weights.
    """

    def __init__(self, spark: SparkSession, collection: str, kind="hash", model: str | None = None):
        self.spark, self.collection = spark, collection
        self.embedder = embedding.embedder(kind, model)

    def extract_text(
        self, path: str, parser="PyPDFLoader", suffix: str = ".pdf", output: str | None = None,
        most_failures: int = 0,
    ) -> DataFrame:
        """Parsed documents of a folder or file. With ``output`` they are also written there as CSV,
        with a page report, and read back, so that no file is parsed twice. Up to ``most_failures`` files that
        cannot be parsed are then set aside, with their errors, in ``extracted_text/documents/failed=true``;
        beyond that, and without ``output``, such a file is an error."""
        found = files.scan_files(self.spark, path, suffix)
        if output is None:
            return files.parse_files(found, parser)
        parsed, _ = files.parse_and_set_aside(found, f"{output}/extracted_text/documents", parser, most_failures)
        tables.write_csv(parsed, f"{output}/extracted_text/csv")
        blocks = report.page_report(files.page_rows(parsed))
        report.write_report(blocks, f"{output}/extracted_text/report", "page", X.report_name(F.col("source")))
        return parsed

    def generate_chunks(
        self, parsed: DataFrame, size: int = chunking.CHUNK_SIZE,
        overlap: int = chunking.CHUNK_OVERLAP, splitter: str = chunking.RECURSIVE,
        tokenizer=None, output: str | None = None,
    ) -> DataFrame:
        """Chunks of parsed documents. With ``output`` the summary and the chunk report are written
        there, and the chunks with them, so that no page is split twice."""
        # Documents without pages stay in for the summary.
        pages = files.page_rows(parsed, keep_empty=True)
        split = chunking.with_splits(pages, size, overlap, splitter, tokenizer=tokenizer)
        if output is None:
            return chunking.explode_chunks(split)
        kept = f"{output}/chunks/splits"
        split.write.mode("overwrite").parquet(kept)
        split = self.spark.read.parquet(kept)
        chunks = chunking.explode_chunks(split)
        tables.write_csv(report.document_summary(split, splitter), f"{output}/doc_summary")
        name = X.swap_extension(F.col("source"), ".pdf", ".docx")
        report.write_report(report.chunk_report(chunks), f"{output}/chunks/report", "chunk_number", name)
        return chunks

    def embed_and_store(
        self, chunks: DataFrame, nlist: int = index.NLIST, centroids: DataFrame | None = None,
        distinct: bool = False, variant: bool = False,
    ) -> DataFrame:
        """Number the chunks densely in the order they come in, embed them, store the collection and
        its index, for which rows are gathered by cell. The stored collection is returned. With ``distinct``
        equal texts are embedded once, with ``variant`` metadata is stored as a VARIANT.

        Texts are stored in the collection only. The table that the numbers come from is deleted when
        the collection stands."""
        kept = scratch_path(self.spark, "rows")
        numbered = numbering.ids_as_written(chunks, path=kept)
        if hasattr(self.embedder, "fit"):
            self.embedder = self.embedder.fit(numbered)
            self.embedder.save(self.spark, self._model)
        embed = embedding.embed_distinct if distinct else embedding.embed
        embedded = embed(numbered, self.embedder)
        dim = getattr(self.embedder, "dim", None)
        store.create_collection(embedded, f"{self.collection}/rows", dim, variant)
        drop_folder(self.spark, kept)
        stored = store.read_collection(self.spark, f"{self.collection}/rows")
        index.build_index(stored, f"{self.collection}/index", centroids, nlist, columns=INDEXED)
        return stored

    @property
    def _model(self):
        return f"{self.collection}/model"

    def _fitted(self):
        """The embedder, with the weights that are stored with the collection."""
        if hasattr(self.embedder, "fit") and self.embedder.bucket_weights is None:
            self.embedder = type(self.embedder).load(self.spark, self._model)
        return self.embedder

    def add(self, chunks: DataFrame) -> DataFrame:
        """Add chunks to the stored collection and its index, so that both kinds of search find them.
        Ids go on after the greatest one. Returns the rows added. Should it fail between the two, ``repair``
        brings the index up to date."""
        rows = store.read_collection(self.spark, f"{self.collection}/rows")
        greatest = rows.agg(F.max("id")).first()[0]
        numbered = numbering.ids_as_written(chunks, start=1 if greatest is None else greatest + 1)
        embedded = settled(embedding.embed(numbered, self._fitted()), "added")
        store.insert(embedded, f"{self.collection}/rows")
        columns = rows.columns
        batch = store.typed(embedded, store.has_variant(rows)).select(columns)
        index.append_to_index(batch, f"{self.collection}/index")
        return embedded

    def repair(self) -> int:
        """Put rows of the collection that its index lacks into the index. Returns how many there were."""
        rows = store.read_collection(self.spark, f"{self.collection}/rows")
        path = f"{self.collection}/index"
        missing = settled(rows.join(index.read_cells(self.spark, path).select("id"), "id", "left_anti")
                          .select(rows.columns), "missing")
        count = missing.count()
        if count:
            index.append_to_index(missing, path)
        return count

    def retrieve(
        self, query: str | DataFrame, threshold: float | None = None, limit: int | None = None,
        expr: str | None = None, output_fields: Sequence[str] | None = None,
        metric: str = "COSINE", nprobe: int | None = None, anns_field: str = "embeddings",
        exact: bool = False,
    ) -> DataFrame:
        """Hits for a query text, or for a table of (query_id, text). None means the default."""
        if isinstance(query, str):
            query = self.spark.createDataFrame([(0, query)], "query_id long, text string")
        queries = embedding.embed(query, self._fitted(), text_col="text")
        options = {
            "threshold": nn.THRESHOLD if threshold is None else threshold,
            "expr": expr,
            "output_fields": OUTPUT_FIELDS if output_fields is None else tuple(output_fields),
            "metric": metric,
            "anns_field": anns_field,
        }
        k = nn.LIMIT if limit is None else limit
        rows = store.read_collection(self.spark, f"{self.collection}/rows")
        if exact:
            return nn.search(rows, queries, k, **options)
        probed = index.NPROBE if nprobe is None else nprobe
        return index.search_index(self.spark, f"{self.collection}/index", queries, k, probed, rows=rows, **options)


def text_hits(
    pages: DataFrame, queries: DataFrame, k: int, size: int, overlap: int, kind="hash",
    threshold: float | None = None, key: str = "page",
) -> DataFrame:
    """Hits among the token-window chunks of pages that are stored nowhere yet.

    Scoring carries key, chunk number and vector only. The pages of the hits, and no others, are
    split a second time for their text.
    """
    found = embedding.embedder(kind)
    chunks = chunking.chunk(pages, size, overlap, chunking.TOKENS)
    if hasattr(found, "fit") and found.bucket_weights is None:
        found = found.fit(chunks)
    corpus = embedding.embed(chunks, found)
    asked = embedding.embed(queries, found, text_col="text")
    hits = settled(
        nn.search(corpus, asked, k, ids=(key, "chunk_idx"), threshold=threshold), "hits"
    )
    bound = hits.count()
    small = F.broadcast(hits) if bound <= nn.BROADCAST_HITS else hits
    hit_pages = nn.in_files_of_hits(pages, [key], hits, bound).join(small.select(key).distinct(), key, "left_semi")
    texts = chunking.chunk(hit_pages, size, overlap, chunking.TOKENS)
    return texts.join(small, [key, "chunk_idx"]).select(
        "query_id", "rank", key, "chunk_idx", "score", "page_content"
    )
