"""An index with two levels of cells, for more cells than one matrix of centroids can hold.

Coarse cells are trained on all vectors. Inside each, fine cells are trained in one grouped job on a bounded
sample. A vector goes down from its coarse cell to the nearest of that cell's fine ones; a query does the
same from several coarse cells. Only the coarse centroids are broadcast. The fine ones meet vectors and
queries by a shuffle, in groups of bounded size, however much a coarse cell holds.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagetrove.functions import vectors as V
from pagetrove.operators.index import NPROBE, assign_cells, train_centroids
from pagetrove.operators.search import GROUP_ROWS, LIMIT, search
from pagetrove.session import settled

# Default number of coarse cells, and of those that a query goes down from.
COARSE = 256
COARSE_PROBE = 8
# Most fine cells of a coarse one, and vectors of a fine cell's sample.
FINE_MOST = 4096
SAMPLE = 64
ROUNDS = 10

FINE = T.StructType([
    T.StructField("coarse", T.IntegerType()),
    T.StructField("cell", T.IntegerType()),
    T.StructField("centroid", T.ArrayType(T.DoubleType())),
])


def _nearest(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid of unit length with the greatest cosine, for each row."""
    out, step = np.zeros(len(unit), np.int64), max(1, V.ELEMENTS // len(centroids))
    for at in range(0, len(unit), step):
        out[at:at + step] = (unit[at:at + step] @ centroids.T).argmax(axis=1)
    return out


def spherical_means(rows: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of unit length by Lloyd's iteration under the cosine, from evenly spaced different rows. A centroid
    without rows stays where it was."""
    unit = V.unit_rows(rows)
    different = np.unique(unit, axis=0)
    centroids = different[np.linspace(0, len(different) - 1, min(cells, len(different))).astype(np.int64)]
    for _ in range(rounds):
        chosen = _nearest(unit, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, chosen, unit)
        moved = np.where((sums != 0).any(axis=1)[:, None], V.unit_rows(sums), centroids)
        if np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids


def train_fine(placed: DataFrame, nlist: int, anns_field: str = "embeddings") -> DataFrame:
    """Rows (coarse, cell, centroid): about ``nlist`` fine cells, dealt to the coarse cells of ``placed`` by their size.

    A coarse cell has at most ``FINE_MOST`` of them, and is trained on the ``SAMPLE`` vectors for each that come first
    by a hash of the vector; all are taken if there are fewer. Vectors that are zero or not finite do not take part.
    """
    usable = F.exists(anns_field, lambda x: x != 0) & F.forall(anns_field, lambda x: F.abs(x) < float("inf"))
    rows = placed.where(F.col("coarse").isNotNull() & usable).select("coarse", F.col(anns_field).alias("v"))
    total = max(1, rows.count())
    fine = F.least(F.ceil(F.col("n") * nlist / total), F.lit(FINE_MOST)).cast("int")
    # One row a coarse cell.
    counts = F.broadcast(rows.groupBy("coarse").agg(F.count("*").alias("n")).select("coarse", fine.alias("fine")))
    first = Window.partitionBy("coarse").orderBy(F.xxhash64("v"))
    ranked = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE * FINE_MOST)
    sample = ranked.join(counts, "coarse").where(F.col("place") <= F.col("fine") * SAMPLE)

    def train(found: pa.Table) -> pa.Table:
        coarse = found.column("coarse")[0].as_py()
        centroids = spherical_means(V.matrix(found.column("v")), found.column("fine")[0].as_py())
        numbers = np.arange(len(centroids), dtype=np.int32)
        return pa.table({
            "coarse": pa.array(np.full(len(centroids), coarse, np.int32)),
            "cell": pa.array(np.int32(coarse * FINE_MOST) + numbers),
            "centroid": pa.array(centroids.tolist(), pa.list_(pa.float64()))}, schema=to_arrow_schema(FINE))

    return sample.select("coarse", "fine", "v").groupBy("coarse").applyInArrow(train, FINE)


def _meet(rows: DataFrame, fine: DataFrame, key: Sequence[str], work, schema) -> DataFrame:
    """Bring rows (coarse, others) and the fine centroids of their coarse cells together, in groups of about
    ``GROUP_ROWS`` rows. The centroids are sent once to each group."""
    sizes = F.broadcast(settled(rows.groupBy("coarse").agg(
        F.ceil(F.count("*") / GROUP_ROWS).alias("__groups")), "coarse-cells"))
    left = rows.join(sizes, "coarse").withColumn("__group", F.pmod(F.xxhash64(*key), F.col("__groups"))).drop("__groups")
    right = fine.join(sizes, "coarse").withColumn(
        "__group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__groups") - 1))).drop("__groups")
    return left.groupBy("coarse", "__group").cogroup(right.groupBy("coarse", "__group")).applyInArrow(work, schema)


def _place(rows: DataFrame, fine: DataFrame, ids: Sequence[str], anns_field: str) -> DataFrame:
    """Rows (coarse, others) with their fine cell."""
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])
    arrow, names = to_arrow_schema(schema), rows.columns

    def work(found, cells):
        if not found.num_rows:
            return arrow.empty_table()
        if not cells.num_rows:  # only vectors without a direction are here
            chosen = np.full(found.num_rows, found.column("coarse")[0].as_py() * FINE_MOST, np.int32)
        else:
            matrix = V.matrix(cells.column("centroid"))
            unit = V.unit_rows(np.nan_to_num(V.matrix(found.column(anns_field), matrix.shape[1]), posinf=0.0, neginf=0.0))
            chosen = cells.column("cell").to_numpy()[_nearest(unit, matrix)].astype(np.int32)
        return pa.table([*(found.column(name) for name in names), pa.array(chosen)], schema=arrow)

    known = rows.where(F.col("coarse").isNotNull())
    unknown = rows.where(F.col("coarse").isNull()).withColumn("cell", F.lit(None).cast("int"))
    return _meet(known, fine, ids, work, schema).unionByName(unknown)


def build_tree(
    collection: DataFrame, path: str, nlist: int, ncoarse: int = COARSE, ids: Sequence[str] = ("id",),
    anns_field: str = "embeddings",
) -> str:
    """Train both levels and write the collection by coarse cell, sorted by fine cell inside the files, so that a
    scan for some fine cells skips the row groups of others."""
    spark = collection.sparkSession
    train_centroids(collection, ncoarse, anns_field).write.mode("overwrite").parquet(f"{path}/coarse")
    coarse = spark.read.parquet(f"{path}/coarse")
    if coarse.isEmpty():
        raise ValueError("a tree needs at least one vector")
    placed = settled(assign_cells(collection, coarse, anns_field, "coarse"), "coarse")
    train_fine(placed, nlist, anns_field).write.mode("overwrite").parquet(f"{path}/fine")
    _write(_place(placed, spark.read.schema(FINE).parquet(f"{path}/fine"), ids, anns_field), path, "overwrite")
    return path


def append_to_tree(rows: DataFrame, path: str, ids: Sequence[str] = ("id",), anns_field: str = "embeddings") -> None:
    """Put more rows into the cells of a tree."""
    spark = rows.sparkSession
    placed = settled(assign_cells(rows, spark.read.parquet(f"{path}/coarse"), anns_field, "coarse"), "coarse")
    _write(_place(placed, spark.read.schema(FINE).parquet(f"{path}/fine"), ids, anns_field), path, "append")


def _write(placed, path, mode):
    placed.hint("rebalance", "coarse").sortWithinPartitions("coarse", "cell").write.mode(mode).partitionBy(
        "coarse").parquet(f"{path}/cells")


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells")


def probe_tree(
    spark: SparkSession, path: str, queries: DataFrame, nprobe: int = NPROBE, coarse_probe: int = COARSE_PROBE,
    query_id: str = "query_id", query_field: str = "embeddings",
) -> DataFrame:
    """Rows (query id, __cells): the ``nprobe`` nearest fine cells of each query, among those of its ``coarse_probe``
    nearest coarse cells. Queries without a vector have none."""
    fine = spark.read.schema(FINE).parquet(f"{path}/fine")
    asked = assign_cells(queries.select(query_id, query_field), spark.read.parquet(f"{path}/coarse"), query_field,
                         "__coarse", coarse_probe)
    asked = settled(asked.select(query_id, F.col(query_field).alias("v"), F.explode_outer("__coarse").alias("coarse")), "probes")
    schema = T.StructType([queries.schema[query_id], T.StructField("cell", T.IntegerType()),
                           T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def work(found, cells):
        if not found.num_rows or not cells.num_rows:
            return arrow.empty_table()
        matrix = V.matrix(cells.column("centroid"))
        rows, numbers, parts = V.matrix(found.column("v"), matrix.shape[1]), cells.column("cell").to_numpy(), []
        width, step = min(nprobe, len(numbers)), max(1, V.ELEMENTS // len(matrix))
        for at in range(0, len(rows), step):
            scores = V.score_matrix(rows[at:at + step], matrix, "COSINE")
            best = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            query = found.column(query_id).slice(at, step).take(pa.array(np.repeat(np.arange(len(scores)), width)))
            parts.append(pa.table([query, pa.array(numbers[best].ravel().astype(np.int32)),
                                   pa.array(np.take_along_axis(scores, best, 1).ravel())], schema=arrow))
        return pa.concat_tables(parts)

    found = _meet(asked.where(F.col("coarse").isNotNull()), fine, [query_id], work, schema)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), "cell")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= nprobe)
    return best.groupBy(query_id).agg(F.sort_array(F.collect_list("cell")).alias("__cells"))


def search_tree(
    spark: SparkSession, path: str, queries: DataFrame, k: int = LIMIT, nprobe: int = NPROBE,
    coarse_probe: int = COARSE_PROBE, query_id: str = "query_id", query_field: str = "embeddings", **options,
) -> DataFrame:
    """``search`` in the fine cells that ``probe_tree`` gives each query; takes the options of ``search``."""
    probes = settled(probe_tree(spark, path, queries, nprobe, coarse_probe, query_id, query_field), "probing")
    # Only the partitions of these coarse cells are read, at most as many as there are.
    reached = probes.select(F.explode("__cells").alias("cell")).select(
        F.floor(F.col("cell") / FINE_MOST).cast("int").alias("coarse")).distinct()
    rows = read_tree(spark, path).where(F.col("coarse").isin([row["coarse"] for row in reached.collect()]))
    return search(rows, queries.join(probes, query_id), k, query_id=query_id, query_field=query_field,
                  cell="cell", query_cells="__cells", **options)
