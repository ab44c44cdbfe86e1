"""Nearest-neighbour search: exact, or restricted to the index cells that each query probes.

No pair of query and corpus row ever becomes a row. A bounded block of queries is broadcast as a
matrix; each task multiplies its corpus rows with it, batch by batch, and keeps the best ``k`` rows
per query. Only these leave the task, so the shuffle carries at most tasks x queries x k rows.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagetrove.functions import vectors as V
from pagetrove.operators.numbering import ids_as_written
from pagetrove.session import scratch_path, settled

# Search defaults.
LIMIT = 3
THRESHOLD = 0.70

# Bound on one broadcast block of queries; more queries are searched block after block.
BLOCK_BYTES = 64 << 20
# Bound on the hits that a task keeps for one block, so that a large k makes blocks smaller.
TASK_HITS = 2_000_000
# Rows of one query that meet in one task when hits are merged, and tasks that searches are laid out for.
MERGE_ROWS = 5_000_000
MOST_TASKS = 100_000
# Queries fetched to learn their number and dimension; most searches have no more.
FIRST_QUERIES = 1024
# Bound on one score matrix inside a task, in elements. Several of its size are held at a time, in every Python worker.
SCORES = 1 << 19
# Hits that wait in a task before they are sorted in with the best ones.
WAITING = 1 << 17
# The files of up to this many hits are listed in the plan.
LISTED_HITS = 10_000
# Hits are broadcast for the look-up of output fields up to this many rows.
BROADCAST_HITS = 500_000
# Ranges of ids that a look-up of output fields is cut into.
ID_RANGES = 64


class _Best:
    """The best k rows per query that a task has seen so far."""

    def __init__(self, queries, k, metric, threshold, ids):
        self.matrix, self.k, self.metric, self.ids = queries, k, metric, ids
        self.sign = 1.0 if V.METRICS[metric] else -1.0
        self.floor = np.full(len(queries), -np.inf)
        self.threshold = None if threshold is None else self.sign * threshold
        self.hits = pd.DataFrame({"q": [], "merit": [], **{name: [] for name in ids}})
        self.waiting, self.many = [], 0

    def offer(self, vectors, keys, members=None):
        """Score rows, given by a matrix or an Arrow array of vectors, with all queries, or with the numbered ones only."""
        asked = self.matrix if members is None else self.matrix[members]
        members = np.arange(len(self.matrix)) if members is None else members
        if not len(members):
            return
        step = max(1, SCORES // len(members))
        for at in range(0, len(vectors), step):
            rows = vectors[at:at + step]
            # Of an Arrow array only these rows become doubles.
            rows = rows if isinstance(rows, np.ndarray) else V.matrix(rows, asked.shape[1])
            merit = V.score_matrix(rows, asked, self.metric)
            merit *= self.sign
            # A vector with NaN or infinite elements has no score and is no hit.
            merit[~np.isfinite(merit)] = -np.inf
            self._take(merit, members, keys.slice(at, step))
        self._sort_in()

    def _take(self, merit, members, keys):
        bar = self.floor[members]
        if len(merit) > self.k:
            kth = np.partition(merit, len(merit) - self.k, axis=0)[len(merit) - self.k]
            # That many rows are as good, so that no lesser one is a hit.
            self.floor[members] = bar = np.maximum(bar, kth)
        # Rows equal to the k-th score stay in: their ids decide.
        wanted = (merit >= bar) & (merit > -np.inf)
        if self.threshold is not None:
            wanted &= merit > self.threshold
        row, member = np.nonzero(wanted)
        if not len(row):
            return
        found = keys.take(pa.array(row)).to_pandas()
        found.insert(0, "q", members[member])
        found.insert(1, "merit", merit[row, member])
        self.waiting.append(found)
        self.many += len(found)
        if self.many > max(WAITING, len(self.hits)):
            self._sort_in()

    def _sort_in(self):
        """Of the best rows and those that wait, the best ``k`` of each query."""
        if not self.many:
            return
        hits = pd.concat([self.hits, *self.waiting] if len(self.hits) else self.waiting)
        self.waiting, self.many = [], 0
        hits = hits.sort_values(
            ["q", "merit", *self.ids], ascending=[True, False] + [True] * len(self.ids)
        )
        self.hits = hits[hits.groupby("q").cumcount() < self.k]
        full = self.hits.groupby("q")["merit"].agg(["size", "min"])
        full = full[full["size"] == self.k]
        number = full.index.to_numpy(dtype=np.int64)
        self.floor[number] = np.maximum(self.floor[number], full["min"].to_numpy())

    def batch(self, query_ids, schema):
        number = self.hits["q"].to_numpy(dtype=np.int64)
        columns = [query_ids.take(pa.array(number))]
        columns += [pa.Array.from_pandas(self.hits[name]) for name in self.ids]
        columns.append(pa.array(self.sign * self.hits["merit"].to_numpy(dtype=np.float64) + 0.0))
        arrays = [c.cast(f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _task(block, k, metric, threshold, ids, vector, cell, schema):
    def run(batches):
        query_ids, queries, probes = block.value
        best = _Best(queries, k, metric, threshold, ids)
        for batch in batches:
            # Rows without a vector are dropped here: a filter in the plan would be pushed below the
            # embedder and run it twice.
            batch = batch.filter(batch.column(vector).is_valid())
            if not batch.num_rows:
                continue
            vectors = batch.column(vector)
            keys = pa.Table.from_batches([batch]).select(ids)
            if cell is None:
                best.offer(vectors, keys)
            else:
                cells = batch.column(cell).to_numpy()
                for value in np.unique(cells):
                    at = np.flatnonzero(cells == value)
                    members = probes.get(int(value), np.zeros(0, dtype=np.int64))
                    best.offer(vectors.take(pa.array(at)), keys.take(pa.array(at)), members)
            # With a very large k a task hands on what it has, and Spark ranks it.
            if len(best.hits) > TASK_HITS:
                yield best.batch(query_ids, schema)
                best = _Best(queries, k, metric, threshold, ids)
        if len(best.hits):
            yield best.batch(query_ids, schema)

    return run


def _search_block(corpus, block, k, metric, threshold, ids, vector, cell, query_id):
    """Best k corpus rows per query of one block (query ids, matrix, probing queries by cell)."""
    spark = corpus.sparkSession
    fields = [query_id, *[corpus.schema[name] for name in ids],
              T.StructField("score", T.DoubleType())]
    rows = _in_cells(corpus, cell, block)
    task = _task(spark.sparkContext.broadcast(block), k, metric, threshold, list(ids), vector, cell,
                 to_arrow_schema(T.StructType(fields)))
    needed = rows.select(*ids, vector, *([cell] if cell else []))
    partial = needed.mapInArrow(task, T.StructType(fields))
    return _merged(partial, k, metric, ids, query_id.name)


def merge_rounds(k: int, merge_rows: int = MERGE_ROWS, most_tasks: int = MOST_TASKS) -> list[int]:
    """Into how many parts the tasks' hits of a query are merged, round by round, before the last merge.

    A part gets the hits of at most ``merge_rows // k`` tasks, or of two, and hands on ``k``. With more than
    ``most_tasks`` tasks the parts grow in proportion.
    """
    fan, parts, rounds = max(2, merge_rows // k), most_tasks, []
    while parts > fan:
        parts = -(-parts // fan)
        rounds.append(parts)
    return rounds


def _merged(partial, k, metric, ids, query_id):
    """The best ``k`` of the tasks' hits by query."""
    best = F.col("score").desc() if V.METRICS[metric] else F.col("score").asc()
    rounds = merge_rounds(k)
    if rounds:
        partial = partial.withColumn("__part", F.spark_partition_id())
    for parts in rounds:
        # Rows of a task stay together, and so do those of a part of the round before.
        ranks = Window.partitionBy(query_id, "__part").orderBy(best, *ids)
        partial = partial.withColumn("__part", F.col("__part") % parts).withColumn(
            "rank", F.row_number().over(ranks)).where(F.col("rank") <= k).drop("rank")
    ranks = Window.partitionBy(query_id).orderBy(best, *ids)
    return partial.drop("__part").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)


def _to_block(found, query_id, vector, cells):
    found = found.filter(pc.is_valid(found.column(vector)))
    if len(pc.unique(found.column(query_id))) < found.num_rows:
        raise ValueError(f"queries must differ in {query_id!r}")
    matrix = V.matrix(found.column(vector))
    probes = {}
    if cells:
        lists = found.column(cells).combine_chunks()
        number = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        cell = lists.flatten().to_numpy()
        for value in np.unique(cell):
            probes[int(value)] = number[cell == value]
    return found.column(query_id).combine_chunks(), matrix, probes


def search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = LIMIT,
    *,
    metric: str = "COSINE",
    anns_field: str = "embeddings",
    ids: Sequence[str] = ("id",),
    expr: str | None = None,
    threshold: float | None = None,
    output_fields: Sequence[str] = (),
    query_id: str = "query_id",
    query_field: str = "embeddings",
    cell: str | None = None,
    query_cells: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` best corpus rows for each query: query id, rank from 1, ids, score, output fields.

    ``expr`` restricts the corpus before the search. ``threshold`` keeps scores strictly on the
    better side of it. With ``cell`` and ``query_cells`` a query meets only corpus rows whose cell is
    in its list. Ties go to the lower id. A query without a vector has no hits. An output field may not
    have the name of another column of the result.
    """
    V.check_metric(metric)
    if k <= 0:
        raise ValueError("k must be positive")
    _check_fields(output_fields, (query_id, "rank", "score"))
    wanted = queries.select(query_id, query_field, *([query_cells] if query_cells else []))
    rows = corpus.where(expr) if expr else corpus
    args = (k, metric, threshold, tuple(ids), anns_field, cell, queries.schema[query_id])
    columns = (query_id, query_field, query_cells)

    found = wanted.limit(FIRST_QUERIES + 1).toArrow()
    cap = query_cap(found, query_field, query_cells, block_bytes, k)
    if found.num_rows > FIRST_QUERIES and cap > FIRST_QUERIES:
        found = wanted.limit(cap + 1).toArrow()
    if found.num_rows <= cap:
        block = _to_block(found, *columns)
        if not len(block[0]):
            return _with_fields(_no_hits(rows, args), rows, ids, output_fields, query_id, 0)
        hits, rows = _search_block(rows, block, *args), _in_cells(rows, cell, block)
        return _with_fields(hits, rows, ids, output_fields, query_id, found.num_rows * k)
    if cell:
        hits = _search_joined(rows, wanted, columns, args)
    else:
        hits = _search_in_blocks(rows, wanted, cap, columns, args)
    return _with_fields(hits, rows, ids, output_fields, query_id, None)


def query_cap(found: pa.Table, query_field: str, query_cells: str | None, block_bytes: int, k: int) -> int:
    """How many queries such as those found go into one block."""
    widths = [max((len(value) for value in found.column(name) if value.is_valid), default=1)
              for name in (query_field, query_cells) if name]
    return max(1, min(block_bytes // (8 * max(1, sum(widths))), TASK_HITS // k))


def _check_fields(output_fields, names):
    clash = sorted({name for name in names if name in output_fields})
    if clash:
        raise ValueError(f"output fields may not be named {', '.join(clash)}")


def _in_cells(rows, cell, block):
    """Literal cell list: of a corpus partitioned by cell, only these partitions are read."""
    return rows.where(F.col(cell).isin(sorted(block[2]))) if cell else rows


def _no_hits(rows, args):
    _, _, _, ids, _, _, query_id = args
    fields = [query_id, *[rows.schema[name] for name in ids],
              T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]
    return rows.sparkSession.createDataFrame([], T.StructType(fields))


def _search_in_blocks(rows, wanted, cap, columns, args):
    """One pass over the corpus per block of queries. Queries and hits go through written tables,
    so neither the driver nor a task ever holds more than one block."""
    spark = rows.sparkSession
    _, _, _, ids, vector, cell, query_id = args
    staged, results = scratch_path(spark, "queries"), scratch_path(spark, "hits")
    block = F.floor(F.col("__number") / cap).cast("int")
    (ids_as_written(wanted, "__number", start=0).withColumn("__block", block)
     .repartition("__block").write.partitionBy("__block").parquet(staged))
    queries = spark.read.parquet(staged)
    if not queries.groupBy(query_id.name).count().where("count > 1").isEmpty():
        raise ValueError(f"queries must differ in {query_id.name!r}")
    # Every block reads the corpus, which may have to be cut up and embedded first.
    rows = settled(rows.select(*ids, vector, *([cell] if cell else [])), "corpus")
    for number in range(-(-queries.count() // cap)):
        found = queries.where(F.col("__block") == number).select(*wanted.columns).toArrow()
        block = _to_block(found, *columns)
        if not len(block[0]):
            continue
        hits = _search_block(rows, block, *args)
        hits.write.mode("append").parquet(results)
    return spark.read.schema(_no_hits(rows, args).schema).parquet(results)


# Rows and queries that meet in one group of the join below.
GROUP_ROWS = 50_000
GROUP_QUERIES = 5_000


def _search_joined(rows, wanted, columns, args):
    """One pass for any number of queries, which go to the cells they probe by a shuffle.

    A cell's rows are dealt to groups of about ``GROUP_ROWS``, its queries to groups of about
    ``GROUP_QUERIES``; every group of rows meets every group of queries, matrix by matrix. A row is sent
    once for each group of queries of its own cell, a query once for each group of rows of its cells.
    """
    k, metric, threshold, ids, vector, cell, query_id = args
    _, query_field, query_cells = columns
    # Written, since both sides are counted first and may have been embedded.
    queries = settled(wanted, "queries")
    if not queries.groupBy(query_id.name).count().where("count > 1").isEmpty():
        raise ValueError(f"queries must differ in {query_id.name!r}")
    asked = queries.where(F.col(query_field).isNotNull()).select(
        F.col(query_id.name).alias("__query"), F.col(query_field).alias("__asked"),
        F.explode(F.array_distinct(query_cells)).alias("__cell"))
    rows = rows.select(*ids, vector, F.col(cell).alias("__cell"))
    sizes = rows.groupBy("__cell").agg(F.count("*").alias("__rows")).join(
        asked.groupBy("__cell").agg(F.count("*").alias("__queries")), "__cell")
    sizes = settled(sizes.select(
        "__cell", F.ceil(F.col("__rows") / GROUP_ROWS).alias("__row_groups"),
        F.ceil(F.col("__queries") / GROUP_QUERIES).alias("__query_groups")), "cells")
    if sizes.count() <= BROADCAST_HITS:
        sizes = F.broadcast(sizes)

    def dealt(df, key, own, other):
        """A group of the row's own kind by a hash, and a copy of the row for each of the other kind."""
        return df.join(sizes, "__cell").withColumns({
            f"{own}_group": F.pmod(F.xxhash64(*key), F.col(f"{own}_groups")),
            f"{other}_group": F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_groups") - 1)),
        }).drop("__row_groups", "__query_groups")

    group = ["__cell", "__row_group", "__query_group"]
    fields = [query_id, *[rows.schema[name] for name in ids], T.StructField("score", T.DoubleType())]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def meet(found, asking):
        # Rows without a vector are no hits.
        found = found.filter(pc.is_valid(found.column(vector)))
        if not found.num_rows or not asking.num_rows:
            return arrow.empty_table()
        queries = V.matrix(asking.column("__asked"))
        best = _Best(queries, k, metric, threshold, list(ids))
        best.offer(found.column(vector), found.select(list(ids)))
        return pa.Table.from_batches([best.batch(asking.column("__query").combine_chunks(), arrow)])

    partial = dealt(rows, ids, "__row", "__query").groupBy(*group).cogroup(
        dealt(asked, ["__query"], "__query", "__row").groupBy(*group)).applyInArrow(meet, schema)
    best = F.col("score").desc() if V.METRICS[metric] else F.col("score").asc()
    ranks = Window.partitionBy(query_id.name).orderBy(best, *ids)
    return partial.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)


def in_files_of_hits(rows, keys, hits, bound):
    """The rows, read from the files that hold a hit only.

    A first scan of the key columns finds these files; the wide columns of all others stay unread.
    Rows that do not come from files, and hits too many for a list of files, change nothing.
    """
    if bound is None or bound > LISTED_HITS:
        return rows
    try:
        placed = rows.select(*keys, F.col("_metadata.file_path").alias("__file"))
    except AnalysisException:
        return rows
    wanted = F.broadcast(hits.select(*keys).distinct())
    found = placed.join(wanted, list(keys), "left_semi").select("__file").distinct().collect()
    return rows.where(F.col("_metadata.file_path").isin([row["__file"] for row in found]))


def _with_fields(hits, rows, ids, output_fields, query_id, bound):
    """Fetch output fields for the hits alone; the scoring scan never reads them."""
    columns = [query_id, "rank", *ids, "score"]
    extra = [name for name in output_fields if name not in columns]
    if extra:
        hits = settled(hits, "hits")
        small = F.broadcast(hits) if bound is not None and bound <= BROADCAST_HITS else hits
        rows = in_files_of_hits(rows, ids, hits, bound)
        hits = rows.select(*ids, *extra).join(small, list(ids))
    return hits.select(*columns, *extra)


def id_ranges(ids: np.ndarray, most: int = ID_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges (first, last) that hold all of the ids, cut at the widest gaps."""
    ids = np.unique(ids)
    if not len(ids):
        return []
    gaps = np.argsort(-np.diff(ids.astype(np.float64)), kind="stable")[:most - 1]
    return [(int(part[0]), int(part[-1])) for part in np.split(ids, np.sort(gaps) + 1)]


def fields_by_id(
    hits: DataFrame, rows: DataFrame, ids: Sequence[str], output_fields: Sequence[str], query_id: str = "query_id",
) -> DataFrame:
    """``hits`` with output fields of the table that was searched, whose rows lie in the order of their ids, more
    or less.

    Up to ``BROADCAST_HITS`` hits are looked up by ranges of one integer id: Parquet keeps the least and
    the greatest id of every row group, so that row groups without a hit are not read. More are joined.
    """
    columns = [query_id, "rank", *ids, "score"]
    _check_fields(output_fields, (query_id, "rank", "score"))
    extra = [name for name in output_fields if name not in columns]
    if not extra:
        return hits.select(*columns)
    hits = settled(hits, "hits")
    if hits.count() <= BROADCAST_HITS:
        if len(ids) == 1 and isinstance(rows.schema[ids[0]].dataType, T.IntegralType):
            found = hits.select(ids[0]).distinct().toArrow().column(0).to_numpy()
            wanted = F.lit(False)
            for first, last in id_ranges(found):
                wanted |= F.col(ids[0]).between(first, last)
            rows = rows.where(wanted)
        hits = F.broadcast(hits)
    return rows.select(*ids, *extra).join(hits, list(ids)).select(*columns, *extra)


def _range_task(block, threshold, ids, vector, cell, schema):
    def run(batches):
        query_ids, queries, probes = block.value
        everyone = np.arange(len(queries))
        for batch in batches:
            batch = batch.filter(batch.column(vector).is_valid())
            if not batch.num_rows:
                continue
            rows, cells = V.matrix(batch.column(vector), queries.shape[1]), batch.column(cell).to_numpy()
            for value in np.unique(cells):
                at = np.flatnonzero(cells == value)
                members = probes.get(int(value), everyone[:0])
                step = max(1, SCORES // max(1, len(members)))
                for begin in range(0, len(at) if len(members) else 0, step):
                    part = at[begin:begin + step]
                    scores = V.score_matrix(rows[part], queries[members], "COSINE")
                    row, member = np.nonzero(scores > threshold)
                    fields = batch.drop_columns([vector, cell]).take(pa.array(part[row])).columns
                    columns = [query_ids.take(pa.array(members[member])), *fields[:ids],
                               pa.array(scores[row, member]), *fields[ids:]]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def search_range(
    corpus: DataFrame, queries: DataFrame, threshold: float, *, cell: str, query_cells: str,
    ids: Sequence[str] = ("id",), anns_field: str = "embeddings", output_fields: Sequence[str] = (),
    query_id: str = "query_id", query_field: str = "embeddings", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All corpus rows whose cosine with a query is above ``threshold``, among the cells that the query names.

    Hits leave the tasks as they are found, with their output fields; nothing is ranked or shuffled. More queries
    than a block holds are searched block after block.
    """
    _check_fields(output_fields, (query_id, "score"))
    spark = corpus.sparkSession
    extra = [name for name in output_fields if name not in ids]
    needed = corpus.select(*ids, *extra, anns_field, cell)
    schema = T.StructType([
        queries.schema[query_id], *[corpus.schema[name] for name in ids], T.StructField("score", T.DoubleType()),
        *[corpus.schema[name] for name in extra]])
    arrow = to_arrow_schema(schema)
    columns = (query_id, query_field, query_cells)
    wanted = queries.select(*columns)

    def hits(found):
        block = _to_block(found, *columns)
        if not block[2]:
            return spark.createDataFrame([], schema)
        task = _range_task(spark.sparkContext.broadcast(block), threshold, len(ids), anns_field, cell, arrow)
        return _in_cells(needed, cell, block).mapInArrow(task, schema)

    found = wanted.limit(FIRST_QUERIES + 1).toArrow()
    cap = query_cap(found, query_field, query_cells, block_bytes, 1)
    if found.num_rows > FIRST_QUERIES and cap > FIRST_QUERIES:
        found = wanted.limit(cap + 1).toArrow()
    if found.num_rows <= cap:
        return hits(found)
    numbered = ids_as_written(wanted, "__number", start=0)
    if not numbered.groupBy(query_id).count().where("count > 1").isEmpty():
        raise ValueError(f"queries must differ in {query_id!r}")
    results = scratch_path(spark, "hits")
    spark.createDataFrame([], schema).write.parquet(results)
    for begin in range(0, numbered.count(), cap):
        part = numbered.where(F.col("__number").between(begin, begin + cap - 1)).select(*columns).toArrow()
        hits(part).write.mode("append").parquet(results)
    return spark.read.schema(schema).parquet(results)


def nearest(
    corpus: DataFrame,
    vector: Sequence[float],
    k: int = LIMIT,
    *,
    metric: str = "COSINE",
    anns_field: str = "embeddings",
    ids: Sequence[str] = ("id",),
    expr: str | None = None,
    threshold: float | None = None,
    output_fields: Sequence[str] = (),
) -> DataFrame:
    """``search`` for one given vector, in the order of the rank.

    Tasks score ids and vectors only and hand on the rows of each batch that can be among the best ``k``;
    output fields are fetched for the hits alone.
    """
    V.check_metric(metric)
    if k <= 0:
        raise ValueError("k must be positive")
    _check_fields(output_fields, ("rank", "score"))
    spark, rows = corpus.sparkSession, corpus.where(expr) if expr else corpus
    query = np.array([[float(x) for x in vector]])
    schema = T.StructType([*[rows.schema[name] for name in ids], T.StructField("score", T.DoubleType())])
    arrow, keys, sign = to_arrow_schema(schema), list(ids), 1.0 if V.METRICS[metric] else -1.0

    def score(batches):
        for batch in batches:
            batch = batch.filter(batch.column(anns_field).is_valid())
            scores = V.score_matrix(V.matrix(batch.column(anns_field), query.shape[1]), query, metric)[:, 0]
            wanted = np.isfinite(scores)
            if threshold is not None:
                wanted &= sign * scores > sign * threshold
            at = np.flatnonzero(wanted)
            if len(at) > k:
                merit = sign * scores[at]
                at = at[merit >= np.partition(merit, len(at) - k)[len(at) - k]]
            found = batch.select(keys).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(scores[at])], schema=arrow)

    best = F.col("score").desc() if V.METRICS[metric] else F.col("score").asc()
    order = [best, *(F.col(name) for name in ids)]
    hits = rows.select(*ids, anns_field).mapInArrow(score, schema).orderBy(*order).limit(k)
    extra = [name for name in output_fields if name not in ids]
    if not extra:
        return hits.select(*ids, *output_fields, "score")
    if k <= BROADCAST_HITS:
        # Few rows, whose ids the scan for the fields can then be told.
        found = hits.toArrow()
        hits = F.broadcast(spark.createDataFrame(found, schema))
        if k <= LISTED_HITS and len(ids) == 1:
            rows = rows.where(F.col(ids[0]).isin(found.column(0).to_pylist()))
    return rows.select(*ids, *extra).join(hits, list(ids)).orderBy(*order).select(*ids, *output_fields, "score")
