"""Texts to vectors, with pluggable embedders."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.functions import vectors as V
from pagetrove.session import settled

HASH_DIM = 256
# A text with more than this share of all rows is hot; there are fewer hot texts than its inverse.
HOT_SHARE = 1e-3


def _counts_to_unit_vectors(dim, weights=None):
    @F.arrow_udf(V.VECTOR)
    def dense(buckets: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(1, len(buckets)), max(1, V.ELEMENTS // dim)):
            part = buckets.slice(at, max(1, V.ELEMENTS // dim))
            rows = len(part)
            lengths = np.diff(part.offsets.to_numpy())
            cells = np.repeat(np.arange(rows), lengths) * dim + part.flatten().to_numpy()
            counts = np.bincount(cells, minlength=rows * dim).reshape(rows, dim)
            counts = counts.astype(np.float64) if weights is None else counts * weights
            parts.append(V.list_array(V.unit_rows(counts)))
        return pa.concat_arrays(parts)

    return dense


class HashEmbedder:
    """Feature hashing (Weinberger et al., 2009): word counts per hash bucket, scaled to length 1.

    Words are hashed inside the JVM; only bucket numbers cross to Python, one Arrow batch at a time.
    """

    def __init__(self, dim: int = HASH_DIM):
        self.dim = dim

    def column(self, text: Column) -> Column:
        buckets = V.hash_buckets(X.tokens(text), self.dim)
        return _counts_to_unit_vectors(self.dim)(F.coalesce(buckets, F.array().cast("array<int>")))

    def weights(self, df: DataFrame, text_col: str, *keys: str) -> DataFrame:
        """Sparse form without Python: rows of keys, bucket and word count."""
        kept = df.select(*keys, F.sort_array(V.hash_buckets(X.tokens(F.col(text_col)), self.dim))
                         .alias("sorted"))
        # Equal buckets stand next to each other: a run begins where the bucket before is another, and its
        # count is the distance to the next run.
        begins = F.transform("sorted", lambda bucket, i: F.when(
            (i == 0) | (F.get("sorted", i - 1) != bucket), i))
        kept = kept.withColumn("firsts", F.array_compact(begins))
        pairs = F.transform("firsts", lambda at, i: F.struct(
            F.get("sorted", at).alias("bucket"),
            (F.coalesce(F.get("firsts", i + 1), F.size("sorted")) - at).alias("n")))
        # The outer form, for the reason given at explode_chunks.
        rows = kept.select(*keys, F.inline_outer(pairs)).toDF(*keys, "bucket", "n")
        return rows.where(F.col("bucket").isNotNull())


class TfIdfEmbedder:
    """Word counts per hash bucket, times the bucket's weight in a corpus, scaled to length 1.

    A bucket that ``df`` of ``n`` texts have weighs ln((1 + n) / (1 + df)) + 1 (Salton and Buckley, 1988, in the smoothed
    form). The weights are learned by ``fit`` and stay as they are for texts and queries that come later.
    """

    def __init__(self, dim: int = HASH_DIM, weights: np.ndarray | None = None):
        self.dim, self.bucket_weights = dim, weights

    def fit(self, df: DataFrame, text_col: str = "page_content") -> "TfIdfEmbedder":
        """An embedder with the weights of a corpus. One aggregation, of as many rows as there are buckets;
        null and blank texts count as texts without words."""
        buckets = F.array_distinct(V.hash_buckets(X.tokens(F.coalesce(F.col(text_col), F.lit(""))), self.dim))
        # Bucket -1 counts the texts.
        marks = df.select(F.explode(F.concat(buckets, F.array(F.lit(-1)))).alias("bucket"))
        counts = {row["bucket"]: row["n"] for row in marks.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        texts = counts.pop(-1, 0)
        held = np.zeros(self.dim)
        held[list(counts)] = list(counts.values())
        return TfIdfEmbedder(self.dim, np.log((1.0 + texts) / (1.0 + held)) + 1.0)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = list(enumerate(self.bucket_weights.tolist()))
        spark.createDataFrame(rows, "bucket int, weight double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TfIdfEmbedder":
        found = spark.read.parquet(path).orderBy("bucket").toArrow()
        return TfIdfEmbedder(found.num_rows, found.column("weight").to_numpy())

    def column(self, text: Column) -> Column:
        if self.bucket_weights is None:
            raise ValueError("the weights have to be fitted or loaded first")
        buckets = V.hash_buckets(X.tokens(text), self.dim)
        return _counts_to_unit_vectors(self.dim, self.bucket_weights)(F.coalesce(buckets, F.array().cast("array<int>")))


class ModelEmbedder:
    """Any Python model. ``load`` is called once per task and gives a function that turns a list of
    texts into a matrix with one row per text; texts come in Arrow batches."""

    def __init__(self, load: Callable[[], Callable[[list], np.ndarray]]):
        self.load = load

    def column(self, text: Column) -> Column:
        load = self.load

        @F.arrow_udf(V.VECTOR)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for texts in batches:
                rows = model(texts.to_pylist()) if len(texts) else np.zeros((0, 1))
                yield V.list_array(np.asarray(rows, dtype=np.float64))

        return run(text)


def sentence_transformer(model: str) -> ModelEmbedder:
    """Embedder on the optional package ``sentence_transformers``, imported inside the tasks."""

    def load():
        from sentence_transformers import SentenceTransformer

        return SentenceTransformer(model).encode

    return ModelEmbedder(load)


_EMBEDDERS = {
    "hash": lambda model: HashEmbedder(int(model) if model else HASH_DIM),
    "tfidf": lambda model: TfIdfEmbedder(int(model) if model else HASH_DIM),
    "SentenceTransformer": sentence_transformer,
    "HuggingFaceEmbeddings": sentence_transformer,
}


def register_embedder(name: str, make: Callable) -> None:
    """Add an embedder by name; ``make`` gets the model name and gives an embedder."""
    _EMBEDDERS[name] = make


def embedder(kind="hash", model: str | None = None):
    """An embedder by name; objects with a ``column`` method pass through."""
    if hasattr(kind, "column"):
        return kind
    if kind not in _EMBEDDERS:
        raise ValueError(f"unsupported embedding model {kind!r}; known: {', '.join(_EMBEDDERS)}")
    return _EMBEDDERS[kind](model)


def embed(
    df: DataFrame, kind="hash", model: str | None = None,
    text_col: str = "page_content", out: str = "embeddings",
) -> DataFrame:
    """Add the vector of a text column. Queries and chunks go through the same function."""
    return df.withColumn(out, embedder(kind, model).column(F.col(text_col)))


def embed_distinct(
    df: DataFrame, kind="hash", model: str | None = None,
    text_col: str = "page_content", out: str = "embeddings",
) -> DataFrame:
    """``embed``, but equal texts go through the model once, null as a text of its own. Worth it if the model is
    costly and texts repeat, since texts are shuffled for it.

    ``df`` is read twice, so it is best a written table. Vectors meet their rows by the texts' SHA-256. Those of
    hot texts are broadcast, at most ``1 / HOT_SHARE`` of them, so that no task gets more than that share of rows
    for one text; all others by a shuffle.
    """
    texts = df.groupBy(F.col(text_col).alias("__text")).agg(F.count("*").alias("__rows"))
    vectors = texts.select(_text_key(F.col("__text")).alias("__key"), "__rows",
                           embedder(kind, model).column(F.col("__text")).alias(out))
    # Written, so that no text is embedded again for a second use.
    vectors = settled(vectors, "vectors")
    rows = vectors.agg(F.sum("__rows")).first()[0] or 0
    hot = F.col("__rows") > HOT_SHARE * rows
    names = [name for name in df.columns if name != out]
    keyed = df.select(*names, _text_key(F.col(text_col)).alias("__key"))
    found = F.broadcast(vectors.where(hot).select("__key", F.struct(F.col(out).alias("vector")).alias("__hot")))
    keyed = keyed.join(found, "__key", "left")
    # Rows that are done need no partner; a null key has none, and is dealt over all tasks by the salt.
    rest = vectors.where(~hot).select(F.col("__key").alias("__cold_key"), F.lit(-1).alias("__salt"),
                                      F.col(out).alias("__cold"))
    done = F.col("__hot").isNotNull()
    keyed = keyed.withColumns({
        "__cold_key": F.when(~done, F.col("__key")),
        "__salt": F.when(done, F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int")).otherwise(-1)})
    keyed = keyed.join(rest, ["__cold_key", "__salt"], "left")
    return keyed.select(*names, F.coalesce(F.col("__hot.vector"), F.col("__cold")).alias(out))


def _text_key(text):
    return F.coalesce(F.sha2(text, 256), F.lit(""))
