"""Stored collections: id, page_content, metadata, embeddings. Addressed by path or table name.

Metadata is JSON text, or a VARIANT if the collection was created so: then it is parsed once, when it is stored, and
filters name typed paths, as in ``variant_get(metadata, '$.page', 'int') < 3``.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from pagetrove.functions import text as X
from pagetrove.functions import vectors as V
from pagetrove.session import drop_folder, replace_folder, scratch_path, settled

# Columns of a collection and the greatest length of a text, in bytes.
SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("page_content", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("embeddings", V.VECTOR),
])
MAX_TEXT = 5000

# The ids of a batch are broadcast up to this many.
BROADCAST_IDS = 1_000_000


def _is_path(target):
    return "/" in target


def collection_exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
    except AnalysisException:
        return False
    return True


def read_collection(spark: SparkSession, target: str, persist: bool = False) -> DataFrame:
    df = spark.read.parquet(target) if _is_path(target) else spark.table(target)
    return df.persist() if persist else df


def vector_dimension(df: DataFrame, anns_field: str = "embeddings") -> DataFrame:
    """Least and greatest vector length; they are equal in a sound collection."""
    return df.agg(
        F.min(F.size(anns_field)).alias("min_dim"), F.max(F.size(anns_field)).alias("max_dim")
    )


def _first_dimension(df):
    vectors = df.select("embeddings")
    # Mostly the first row has a vector; the filter is for the rest, since it may run an embedder.
    row = vectors.first()
    if row is not None and row["embeddings"] is None:
        row = vectors.where("embeddings is not null").first()
    return None if row is None else len(row["embeddings"])


def _broken(dim: int | None) -> dict[str, Column]:
    """Row rules by name; a rule is true where it is broken. Without a dimension there is none to break."""
    vector = F.col("embeddings")
    return {
        "null_id": F.col("id").isNull(),
        "text_too_long": F.coalesce(F.octet_length("page_content") > MAX_TEXT, F.lit(False)),
        "null_vector": vector.isNull(),
        "wrong_dimension": F.coalesce(F.size(vector) != dim, F.lit(False)) if dim is not None else F.lit(False),
        "null_element": F.coalesce(F.exists(vector, lambda x: x.isNull()), F.lit(False)),
    }


def collection_violations(df: DataFrame, dim: int) -> DataFrame:
    """Rows (rule, violations) for every rule of a collection, from one pass.

    Ids that occur twice are found by a partial count per id, so that neither texts nor vectors are
    shuffled and many copies of one id collapse in the map tasks.
    """
    rules = _broken(dim)
    flags = [F.sum(broken.cast("long")).alias(name) for name, broken in rules.items()]
    per_id = df.groupBy("id").agg(F.count("id").alias("copies"), *flags)
    totals = per_id.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
        F.coalesce(F.sum(F.greatest(F.col("copies") - 1, F.lit(0))), F.lit(0)).alias("duplicate_id"),
    )
    names = [*rules, "duplicate_id"]
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names]
    return totals.select(F.inline(F.array(*pairs)))


def has_variant(df: DataFrame) -> bool:
    """Whether the metadata of a collection is a VARIANT."""
    return isinstance(df.schema["metadata"].dataType, T.VariantType)


def typed(df: DataFrame, variant: bool = False) -> DataFrame:
    """The columns of a collection, in its types."""
    metadata = F.col("metadata")
    if variant and not has_variant(df):
        metadata = X.metadata_variant(metadata)
    elif not variant and has_variant(df):
        metadata = F.to_json(metadata)
    return df.select(
        F.col("id").cast("long"), "page_content", metadata.alias("metadata"),
        V.to_vector(F.col("embeddings")).alias("embeddings"),
    )


def _checked(df, dim, variant=False):
    """The collection's columns; a row that breaks a rule fails the write that reads it."""
    if dim is None:
        dim = _first_dimension(df)
    failure = F.lit(None).cast("string")
    rules = _broken(dim)
    if variant and not has_variant(df):
        # A text that is no JSON would be lost.
        rules["metadata_not_json"] = F.col("metadata").isNotNull() & X.metadata_variant(F.col("metadata")).isNull()
    for name, broken in rules.items():
        text = F.concat(F.lit(f"collection rule {name} is broken by id "),
                        F.coalesce(F.col("id").cast("string"), F.lit("null")))
        failure = F.coalesce(failure, F.when(broken, text))
    sound = F.when(failure.isNotNull(), F.raise_error(failure)).otherwise(F.col("id"))
    return typed(df.withColumn("id", sound.cast("long")), variant)


def _switch(spark, beside, target, schema):
    """Put the written rows in the place of a collection, which is there until they are."""
    if _is_path(target):
        replace_folder(spark, beside, target)
        return
    mark = uuid.uuid4().hex
    made, aside = f"{target}_new_{mark}", f"{target}_old_{mark}"
    spark.read.schema(schema).parquet(beside).write.saveAsTable(made)
    had = spark.catalog.tableExists(target)
    try:
        if had:
            spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {made} RENAME TO {target}")
    except BaseException:
        if had and spark.catalog.tableExists(aside):
            spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        spark.sql(f"DROP TABLE IF EXISTS {made}")
        raise
    if had:
        spark.sql(f"DROP TABLE {aside}")


def _replace(rows, target):
    spark = rows.sparkSession
    beside = f"{target.rstrip('/')}-new-{uuid.uuid4().hex}" if _is_path(target) else scratch_path(spark, "collection")
    try:
        rows.write.parquet(beside)
        _switch(spark, beside, target, rows.schema)
    finally:
        drop_folder(spark, beside)


def create_collection(df: DataFrame, target: str, dim: int | None = None, variant: bool = False) -> None:
    """Create or replace a collection. The dimension is that of the first row if none is given. With ``variant``
    metadata is stored as a VARIANT, and metadata that is no JSON breaks a rule.

    Rules on single rows are checked while the rows are written, without a pass of their own. They are
    written beside the old collection, which is replaced only when all of them are sound, and which is kept until
    then whatever fails.
    """
    _replace(_checked(df, dim, variant), target)


def _new_batch(df, target):
    """(rows, stored): a batch, checked and written, and the collection it is for. Its ids must differ."""
    stored = read_collection(df.sparkSession, target)
    rows = settled(_checked(df, _first_dimension(stored), has_variant(stored)), "batch")
    twice = [row["id"] for row in rows.groupBy("id").count().where("count > 1").select("id").limit(3).collect()]
    if twice:
        raise ValueError(f"ids occur more than once in the batch: {twice} and perhaps others")
    return rows, stored


def _ids(rows):
    """The ids of a batch, for a join that shuffles the stored ids only if the batch is large."""
    ids = rows.select("id")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def insert(df: DataFrame, target: str) -> None:
    """Append a batch to a collection, under the collection's dimension.

    Ids are a key: one that occurs twice in the batch, or that is stored already, is an error, and nothing
    is written. Of the stored rows only the ids are read for it. Writers that append at the same time are not
    kept apart; ``collection_violations`` finds what they do to each other.
    """
    rows, stored = _new_batch(df, target)
    known = stored.select("id").join(_ids(rows), "id", "left_semi")
    known = [row["id"] for row in known.limit(3).collect()]
    if known:
        raise ValueError(f"ids are stored already: {known} and perhaps others")
    writer = rows.write.mode("append")
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)


def upsert(df: DataFrame, target: str) -> None:
    """Put a batch into a collection: rows with stored ids take their place, others are added. An id that occurs
    twice in the batch is an error.

    A Parquet folder has no rows that could be changed in place, so the collection is written anew, beside the
    old one, and switched. Batches are therefore best collected before.
    """
    rows, stored = _new_batch(df, target)
    _replace(typed(stored, has_variant(stored)).join(_ids(rows), "id", "left_anti").select(rows.columns).unionByName(rows), target)
