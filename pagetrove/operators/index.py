"""Inverted-file index (Jegou et al., 2011): a corpus partitioned by its nearest centroid."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrove.functions import vectors as V
from pagetrove.operators.search import BLOCK_BYTES, LIMIT, fields_by_id, search, search_range
from pagetrove.session import settled

# Default number of cells, and of cells probed per query.
NLIST = 1024
NPROBE = 10

# Vectors that a cell's centroid is trained on, on average, at most.
SAMPLE = 256

# Bound on the centroid matrix that is broadcast.
CENTROID_BYTES = 256 << 20
# Centroids fetched to learn their number and dimension.
FIRST_CENTROIDS = 4096

# Column of an index: the cosine of a row with the centroid of its cell.
COSINE = "__cosine"
# Scores are rounded to six places; angles have errors of their own, far smaller.
MARGIN = 1e-6

CENTROIDS = T.StructType([
    T.StructField("cell", T.IntegerType()),
    T.StructField("centroid", T.ArrayType(T.DoubleType())),
])


def train_centroids(
    vectors: DataFrame, nlist: int = NLIST, anns_field: str = "embeddings",
    max_iter: int = 20, seed: int = 1, sample: int | None = SAMPLE,
) -> DataFrame:
    """Centroids of spherical k-means: rows of (cell, centroid).

    They are trained on all vectors up to ``sample`` times ``nlist`` of them, and on a hashed share of about that
    many beyond; None means all. Whatever they are trained on, the index holds every row. Zero vectors have
    no direction, and others have elements that are not finite; both are left out of the training. There are
    at most as many cells as vectors to train on, one for a collection without any to train on, and none
    without vectors at all. Vectors are counted before they are taken, so they had better be stored ones.
    """
    usable = F.exists(anns_field, lambda x: x != 0) & F.forall(anns_field, lambda x: F.abs(x) < float("inf"))
    points = vectors.where(usable).select(F.col(anns_field).cast("array<double>").alias("v"))
    most, total = None if sample is None else sample * nlist, points.count()
    if most is not None and total > most:
        # Of equal vectors each has a place of its own in the share.
        place = F.pmod(F.xxhash64("v", F.monotonically_increasing_id(), F.lit(seed)), F.lit(1 << 32))
        points = points.where(place < int((1 << 32) * most / total))
    # k-means goes over its input once per iteration.
    points = settled(points, "points")
    cells = min(nlist, total)
    if cells < 2:
        known = points.first() or vectors.where(F.col(anns_field).isNotNull()).select(
            F.transform(anns_field, lambda x: F.lit(0.0)).alias("v")).first()
        if known is None:
            return vectors.sparkSession.createDataFrame([], CENTROIDS)
        return vectors.sparkSession.createDataFrame([(0, list(known["v"]))], CENTROIDS)
    points = points.select(array_to_vector("v").alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=max_iter, seed=seed).fit(points)
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, CENTROIDS)


def mean_centroids(vectors: DataFrame, label: str, anns_field: str = "embeddings") -> DataFrame:
    """Mean vector of every label, as centroids; the label is the cell.

    Means are built per (label, position), so a label that most rows carry is summed up in the map
    tasks. They are rounded, because a sum of floats depends on its order.
    """
    parts = vectors.select(label, F.posexplode(anns_field).alias("at", "x"))
    means = parts.groupBy(label, "at").agg(
        F.round(F.avg(F.col("x").cast("double")), V.SCORE_DIGITS).alias("mean")
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "mean")))
    return means.groupBy(F.col(label).cast("int").alias("cell")).agg(
        F.transform(ordered, lambda part: part["mean"]).alias("centroid")
    )


def _centroid_matrix(centroids: DataFrame):
    """(cells, matrix) in the order of the cells. Mostly one look at the centroids is enough."""
    ordered = centroids.select("cell", "centroid").orderBy("cell")
    found = ordered.limit(FIRST_CENTROIDS + 1).toArrow()
    if not found.num_rows:
        raise ValueError("there are no centroids")
    most = CENTROID_BYTES // (8 * max(1, len(found.column("centroid")[0])))
    if found.num_rows > FIRST_CENTROIDS and most > FIRST_CENTROIDS:
        # One more than fits tells whether there are too many.
        found = ordered.limit(most + 1).toArrow()
    if found.num_rows > most:
        raise ValueError("the centroids are too large to be broadcast; use fewer cells")
    return found.column("cell").to_numpy(), V.matrix(found.column("centroid"))


def assign_cells(
    df: DataFrame, centroids: DataFrame, anns_field: str = "embeddings",
    out: str = "cell", nprobe: int | None = None,
) -> DataFrame:
    """Add the cell of the centroid with the greatest cosine; ties go to the lower cell.

    With ``nprobe`` the column is the array of the ``nprobe`` best cells instead. Null vectors get
    null.
    """
    shared = df.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))
    kind = T.IntegerType() if nprobe is None else T.ArrayType(T.IntegerType())

    @F.arrow_udf(kind)
    def nearest_cells(vectors: pa.Array) -> pa.Array:
        cells, matrix = shared.value
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        rows = V.matrix(vectors.drop_null(), matrix.shape[1])
        width = 1 if nprobe is None else min(nprobe, len(cells))
        best = np.zeros((len(vectors), width), dtype=np.int32)
        number, step = np.flatnonzero(valid), max(1, V.ELEMENTS // len(cells))
        for at in range(0, len(rows), step):
            scores = V.score_matrix(rows[at:at + step], matrix, "COSINE")
            order = scores.argmax(axis=1)[:, None] if nprobe is None else np.argsort(
                -scores, axis=1, kind="stable")[:, :width]
            best[number[at:at + step]] = cells[order]
        if nprobe is None:
            return pa.array(best[:, 0], mask=~valid)
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * width)
        return pa.ListArray.from_arrays(offsets, pa.array(best.ravel()), mask=pa.array(~valid))

    return df.withColumn(out, nearest_cells(F.col(anns_field)))


def _placed(df, centroids, anns_field):
    """Rows with their cell and the cosine with its centroid, not rounded."""
    shared = df.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))

    @F.arrow_udf(T.DoubleType())
    def cosine(vectors: pa.Array, chosen: pa.Array) -> pa.Array:
        cells, matrix = shared.value
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        out, unit, number = np.zeros(len(vectors)), V.unit_rows(matrix), np.flatnonzero(valid)
        rows = V.matrix(vectors.drop_null(), matrix.shape[1])
        at = np.searchsorted(cells, chosen.drop_null().to_numpy())
        step = max(1, V.ELEMENTS // max(1, matrix.shape[1]))
        for begin in range(0, len(rows), step):
            part = slice(begin, begin + step)
            out[number[part]] = (V.unit_rows(rows[part]) * unit[at[part]]).sum(axis=1)
        return pa.array(out, mask=~valid)

    placed = assign_cells(df, centroids, anns_field)
    return placed.withColumn(COSINE, cosine(F.col(anns_field), F.col("cell")))


def build_index(
    collection: DataFrame, path: str, centroids: DataFrame | None = None,
    nlist: int = NLIST, anns_field: str = "embeddings", columns: Sequence[str] | None = None,
) -> str:
    """Write a collection partitioned by cell, next to its centroids. Every row has its cosine with the centroid.

    Rows are gathered by cell so that a cell becomes a few files; a cell that holds much of the
    collection is split over many tasks by the rebalance step. A collection without vectors makes an index
    without centroids and hits, which the first rows added to it train.

    ``columns`` are the ones that the index holds, among them ids and vector; None means all. An index without
    texts is searched together with the table that has them: see ``search_index``.
    """
    if centroids is None:
        centroids = train_centroids(collection, nlist, anns_field)
    spark = collection.sparkSession
    rows = collection.select(*columns) if columns else collection
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    centroids = spark.read.parquet(f"{path}/centroids")
    if centroids.isEmpty():
        rows.withColumns({"cell": F.lit(None).cast("int"), COSINE: F.lit(None).cast("double")}).write.mode(
            "overwrite").parquet(f"{path}/cells")
        return path
    placed = _placed(rows, centroids, anns_field)
    (placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell")
     .parquet(f"{path}/cells"))
    return path


def append_to_index(rows: DataFrame, path: str, anns_field: str = "embeddings", nlist: int = NLIST) -> None:
    """Put more rows into an index, into the cells of its stored centroids. If it has none yet, it is built anew
    from what it holds and these rows. Columns that the index does not hold are left out."""
    spark = rows.sparkSession
    centroids = spark.read.parquet(f"{path}/centroids")
    held = read_cells(spark, path).drop("cell")
    rows = rows.select(held.columns)
    if centroids.isEmpty():
        every = settled(held.unionByName(rows), "first-rows")
        build_index(every, path, nlist=nlist, anns_field=anns_field)
        return
    placed = _placed(rows, centroids, anns_field)
    placed.hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{path}/cells")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells").drop(COSINE)


def _filtered(cells, rows, expr, ids):
    """The rows of an index that a filter leaves. One on columns that only ``rows`` has is answered there."""
    try:
        return cells.where(expr)
    except AnalysisException:
        return cells.join(rows.where(expr).select(*ids), list(ids), "left_semi")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int = LIMIT, nprobe: int = NPROBE,
    query_field: str = "embeddings", rows: DataFrame | None = None, **options,
) -> DataFrame:
    """``search`` in the ``nprobe`` cells nearest to each query; takes the options of ``search``.

    ``rows`` is the indexed table, if the index does not hold all of its columns. Output fields are then fetched
    from it for the hits alone, and a filter on columns that the index lacks is answered by it: its ids are
    joined with those of the probed cells.
    """
    centroids = spark.read.parquet(f"{path}/centroids")
    cells, fields = read_cells(spark, path), ()
    ids = tuple(options.get("ids", ("id",)))
    if rows is not None:
        expr, fields = options.pop("expr", None), options.pop("output_fields", ())
        cells = _filtered(cells, rows, expr, ids) if expr else cells
    if centroids.isEmpty():
        hits = search(cells, queries, k, query_field=query_field, **options)
    else:
        probing = assign_cells(queries, centroids, query_field, "__cells", nprobe)
        hits = search(cells, probing, k, query_field=query_field, cell="cell", query_cells="__cells", **options)
    if not fields:
        return hits
    return fields_by_id(hits, rows, ids, fields, options.get("query_id", "query_id"))


def _reachable_cells(queries, centroids, widest, threshold, query_field, out):
    """The cells that may hold a vector whose cosine with the query is above the threshold.

    Angles obey the triangle inequality: no vector of a cell is nearer to the query than the query's angle
    to the centroid less the widest angle of the cell.
    """
    shared = queries.sparkSession.sparkContext.broadcast((_centroid_matrix(centroids), widest))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def reach(vectors: pa.Array) -> pa.Array:
        (cells, matrix), widest = shared.value
        angles = np.array([widest.get(int(cell), np.nan) for cell in cells])
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        rows, unit, found = V.matrix(vectors.drop_null(), matrix.shape[1]), V.unit_rows(matrix), []
        step = max(1, V.ELEMENTS // len(cells))
        for at in range(0, len(rows), step):
            apart = np.arccos(np.clip(V.unit_rows(rows[at:at + step]) @ unit.T, -1.0, 1.0))
            # A cell without usable vectors has no angle, and is not reached.
            best = np.cos(np.maximum(0.0, apart - angles))
            found += [cells[mask].tolist() for mask in best > threshold - MARGIN]
        lists = iter(found)
        return pa.array([next(lists) if one else None for one in valid], pa.list_(pa.int32()))

    return queries.withColumn(out, reach(F.col(query_field)))


def range_search(
    spark: SparkSession, path: str, queries: DataFrame, threshold: float, *, ids: Sequence[str] = ("id",),
    anns_field: str = "embeddings", expr: str | None = None, output_fields: Sequence[str] = (),
    query_id: str = "query_id", query_field: str = "embeddings", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows of an index whose cosine with a query is above ``threshold``: query id, ids, score, output fields.

    Nothing is lost: cells that no query can reach are not read, and a query meets the rows of no other cells than
    it can reach. The widest angles come from the cosines stored with the rows, of which this reads one column.
    A query without a vector has no hits, and so has a vector that is not finite.
    """
    stored = spark.read.parquet(f"{path}/cells")
    rows = read_cells(spark, path)
    rows = rows.where(expr) if expr else rows
    centroids = spark.read.parquet(f"{path}/centroids")
    widest = stored.where(F.col("cell").isNotNull() & F.col(COSINE).isNotNull()).groupBy("cell").agg(
        F.min(COSINE).alias("least"))
    # One row a cell, as many as there are centroids.
    widest = {row["cell"]: float(np.arccos(np.clip(row["least"], -1.0, 1.0))) for row in widest.collect()}
    if not widest:
        queries, cells = queries.withColumn("__cells", F.array().cast("array<int>")), "__cells"
    else:
        queries, cells = _reachable_cells(queries, centroids, widest, threshold, query_field, "__cells"), "__cells"
    return search_range(rows, queries, threshold, ids=ids, anns_field=anns_field, output_fields=output_fields,
                        query_id=query_id, query_field=query_field, cell="cell", query_cells=cells,
                        block_bytes=block_bytes)
