import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagetrove.functions import vectors as V
from pagetrove.operators import embedding
from pagetrove.operators import search as nn

RNG = np.random.default_rng(5)
ROWS, DIM = 300, 8
VECTORS = RNG.normal(size=(ROWS, DIM)).astype(np.float32)
VECTORS[100:200] = VECTORS[100]  # a third of all rows are copies
VECTORS[7] = 0
QUERIES = np.concatenate([RNG.normal(size=(5, DIM)), VECTORS[100:101], -VECTORS[100:101]]).astype(np.float32)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, VECTORS[i].tolist(), i % 4) for i in range(ROWS)]
    return spark.createDataFrame(rows, "id long, embeddings array<float>, tag int").repartition(5)


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(q, QUERIES[q].tolist()) for q in range(len(QUERIES))]
    return spark.createDataFrame(rows, "query_id long, embeddings array<float>")


def scores(metric):
    a, b = VECTORS.astype(np.float64), QUERIES.astype(np.float64)
    if metric == "IP":
        return b @ a.T
    if metric == "L2":
        return ((b[:, None, :] - a[None, :, :]) ** 2).sum(axis=2)
    norms = np.linalg.norm(b, axis=1)[:, None] * np.linalg.norm(a, axis=1)[None, :]
    return np.divide(b @ a.T, norms, out=np.zeros((len(b), len(a))), where=norms > 0)


def brute(k, metric="COSINE", keep=lambda i: True, threshold=None):
    table = np.round(scores(metric), 6)
    sign = 1 if metric == "L2" else -1
    hits = []
    for q in range(len(QUERIES)):
        order = sorted((i for i in range(ROWS) if keep(i)), key=lambda i: (sign * table[q, i], i))[:k]
        for rank, i in enumerate(order, 1):
            if threshold is None or (table[q, i] < threshold if sign == 1 else table[q, i] > threshold):
                hits.append((q, rank, i, float(table[q, i])))
    return hits


def found(df):
    return [(r.query_id, r["rank"], r.id, r.score) for r in df.sort("query_id", "rank").collect()]


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
@pytest.mark.parametrize("k", [1, 4, 150, 1000])
def test_exact_search(corpus, queries, metric, k):
    assert found(nn.search(corpus, queries, k, metric=metric)) == brute(k, metric)


def test_small_score_matrices(corpus, queries, monkeypatch):
    monkeypatch.setattr(nn, "SCORES", 40)
    best = nn._Best(QUERIES.astype(np.float64), 4, "COSINE", None, ["id"])
    import pyarrow as pa

    best.offer(VECTORS.astype(np.float64), pa.table({"id": np.arange(ROWS)}))
    got = [(int(q), int(i), m) for q, m, i in best.hits[["q", "merit", "id"]].itertuples(index=False)]
    assert got == [(q, i, s) for q, _, i, s in brute(4)]


@pytest.mark.parametrize("block", [1, 2, 3])
def test_more_queries_than_one_block_holds(corpus, queries, block):
    hits = nn.search(corpus, queries, 3, block_bytes=8 * DIM * block, output_fields=["tag"])
    assert found(hits) == brute(3)
    assert all(r.tag == r.id % 4 for r in hits.collect())


def test_large_k_makes_blocks_smaller(corpus, queries, monkeypatch):
    monkeypatch.setattr(nn, "TASK_HITS", 40)
    assert found(nn.search(corpus, queries, 10)) == brute(10)


def test_filter_comes_before_the_limit(corpus, queries):
    assert found(nn.search(corpus, queries, 3, expr="tag = 2")) == brute(3, keep=lambda i: i % 4 == 2)


@pytest.mark.parametrize("metric, threshold", [("COSINE", 0.4), ("L2", 6.0), ("IP", 1.0), ("COSINE", 0.0)])
def test_threshold_is_strict(corpus, queries, metric, threshold):
    assert found(nn.search(corpus, queries, 120, metric=metric, threshold=threshold)) == brute(
        120, metric, threshold=threshold)
    exact = brute(1)[0][3]
    assert not [h for h in found(nn.search(corpus, queries, 1, threshold=exact)) if h[0] == 0]


def test_output_fields(corpus, queries):
    hits = nn.search(corpus, queries, 2, output_fields=["tag", "id"])
    assert hits.columns == ["query_id", "rank", "id", "score", "tag"]
    assert found(hits) == brute(2)


def test_rows_without_vector_are_no_hits(spark, queries):
    corpus = spark.createDataFrame([(1, None), (2, [1.0] * DIM)], "id long, embeddings array<float>")
    assert {h[2] for h in found(nn.search(corpus, queries, 3))} == {2}


def test_vectors_without_a_score_are_no_hits(spark, queries):
    odd = [(1, [float("nan")] * DIM), (2, [float("inf")] * DIM), (3, [1.0] * DIM), (4, [2.0] * DIM)]
    corpus = spark.createDataFrame(odd, "id long, embeddings array<float>").coalesce(1)
    for metric in ("COSINE", "IP", "L2"):
        assert {h[2] for h in found(nn.search(corpus, queries, 2, metric=metric))} == {3, 4}
        assert {r.id for r in nn.nearest(corpus, [1.0] * DIM, 4, metric=metric).collect()} == {3, 4}


def test_output_fields_come_from_the_files_of_hits(spark, tmp_path):
    vectors = F.array(F.cos(F.col("id") / 100), F.sin(F.col("id") / 100)).cast("array<float>")
    spark.range(0, 300, 1, 10).select(
        "id", vectors.alias("embeddings"), F.concat(F.lit("t"), "id").alias("page_content")
    ).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, embeddings array<float>")
    hits = nn.search(stored, asked, 3, output_fields=["page_content"])
    assert [r.page_content for r in hits.sort("rank").collect()] == ["t0", "t1", "t2"]
    restricted = nn.in_files_of_hits(stored, ["id"], hits.select("id"), 3)
    assert restricted.select("_metadata.file_path").distinct().count() == 1
    assert restricted.count() == 30


def test_wrong_dimension_fails(spark, queries):
    corpus = spark.createDataFrame([(2, [1.0, 2.0])], "id long, embeddings array<float>")
    with pytest.raises(Exception, match="elements"):
        nn.search(corpus, queries, 3).collect()


def test_no_queries(corpus, queries):
    assert nn.search(corpus, queries.where("query_id < 0"), 3, output_fields=["tag"]).collect() == []


def test_text_ids(spark, corpus, queries):
    named = corpus.select(F.format_string("r%04d", "id").alias("name"), "embeddings")
    hits = nn.search(named, queries, 3, ids=("name",)).sort("query_id", "rank").collect()
    assert [r.name for r in hits] == [f"r{i:04d}" for _, _, i, _ in brute(3)]


def test_bad_arguments(corpus, queries):
    with pytest.raises(ValueError):
        nn.search(corpus, queries, 0)
    with pytest.raises(ValueError):
        nn.search(corpus, queries, 1, metric="HAMMING")


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
def test_nearest_is_search_for_one_vector(corpus, metric):
    hits = nn.nearest(corpus, QUERIES[5].tolist(), 120, metric=metric, output_fields=["tag"]).collect()
    assert [(r.id, pytest.approx(r.score, abs=2e-6)) for r in hits] == [
        (i, s) for q, _, i, s in brute(120, metric) if q == 5]


def test_plans(corpus, queries, spark, tmp_path):
    corpus.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    text = plan(nn.search(stored, queries, 3, expr="tag = 1"))
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "EqualTo(tag,1)" in text
    text = plan(nn.nearest(stored, QUERIES[0].tolist(), 3, expr="tag = 1"))
    assert "TakeOrderedAndProject" in text and "EqualTo(tag,1)" in text


def test_queries_without_a_vector_have_no_hits(spark, corpus):
    asked = spark.createDataFrame([(0, None), (1, QUERIES[1].tolist()), (2, None)], "query_id long, embeddings array<float>")
    assert {h[0] for h in found(nn.search(corpus, asked, 3))} == {1}
    assert {h[0] for h in found(nn.search(corpus, asked, 3, block_bytes=1))} == {1}
    nothing = nn.search(corpus, asked.where("query_id <> 1"), 3, output_fields=["tag"])
    assert nothing.columns == ["query_id", "rank", "id", "score", "tag"] and nothing.collect() == []


@pytest.mark.parametrize("name", ["score", "rank", "query_id"])
def test_output_fields_may_not_clash(corpus, queries, name):
    named = corpus.withColumn(name, F.lit(9.5))
    with pytest.raises(ValueError, match=name):
        nn.search(named, queries, 2, output_fields=[name])


def test_nearest_with_threshold_and_filter(corpus):
    hits = nn.nearest(corpus, QUERIES[2].tolist(), 50, expr="tag = 1", threshold=0.1, output_fields=["tag"]).collect()
    assert all(r.tag == 1 and r.score > 0.1 for r in hits)
    assert [(-r.score, r.id) for r in hits] == sorted((-r.score, r.id) for r in hits)
    every = nn.nearest(corpus, QUERIES[2].tolist(), 10_000, expr="tag = 1")
    assert sorted(r.id for r in every.where("score > 0.1").collect()) == sorted(r.id for r in hits)


@pytest.mark.parametrize("metric", ["COSINE", "L2"])
@pytest.mark.parametrize("rows, asked", [(50_000, 5_000), (7, 3)])
def test_joined_search_is_block_search(spark, corpus, monkeypatch, metric, rows, asked):
    """Cells of very different sizes; groups of a few rows and queries."""
    monkeypatch.setattr(nn, "GROUP_ROWS", rows)
    monkeypatch.setattr(nn, "GROUP_QUERIES", asked)
    placed = corpus.withColumn("cell", F.when(F.col("id") % 3 > 0, 0).otherwise((F.col("id") % 7).cast("int")))
    probing = spark.createDataFrame(
        [(i, q.tolist(), cells) for i, (q, cells) in enumerate(zip(QUERIES, [[0], [1, 2], [0, 3, 3], [9], []] * 20))]
        + [(999, None, [0])], "query_id long, embeddings array<float>, cells array<int>")
    options = {"metric": metric, "cell": "cell", "query_cells": "cells", "output_fields": ["tag"]}
    assert found(nn.search(placed, probing, 4, block_bytes=1, **options)) == found(
        nn.search(placed, probing, 4, **options)) != []


def test_merge_rounds_bound_what_meets():
    assert nn.merge_rounds(3) == []
    for k, rows, tasks in ((1000, 10_000, 1000), (50, 100, 10_000), (7, 3, 90)):
        fan, parts = max(2, rows // k), tasks
        for after in nn.merge_rounds(k, rows, tasks):
            # Parts are dealt by their number, so none gets more than its share.
            assert -(-parts // after) <= fan
            parts = after
        assert parts <= fan


def test_merging_in_rounds_changes_nothing(corpus, queries, monkeypatch):
    expected = sorted(nn.search(corpus, queries, 3).collect())
    monkeypatch.setattr(nn, "MERGE_ROWS", 6)
    monkeypatch.setattr(nn, "merge_rounds", lambda k: [5, 3, 2])
    found = nn.search(corpus.repartition(16), queries, 3)
    assert sorted(found.collect()) == expected
    assert plan(found).count("Window ") >= 4


def test_id_ranges():
    assert nn.id_ranges(np.array([], dtype=np.int64)) == []
    assert nn.id_ranges(np.array([5, 1, 5, 2, 90, 91, 40]), 3) == [(1, 5), (40, 40), (90, 91)]
    assert nn.id_ranges(np.array([3, 7, 1000]), 1) == [(3, 1000)]
    assert nn.id_ranges(np.array([-2**63, 2**63 - 1])) == [(-2**63, -2**63), (2**63 - 1, 2**63 - 1)]


def test_fields_by_id_reads_ranges(spark, corpus, queries, tmp_path):
    corpus.withColumn("name", F.format_string("n%d", "id")).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    hits = nn.search(stored, queries, 3)
    found = nn.fields_by_id(hits, stored, ["id"], ["name", "tag"])
    assert "GreaterThanOrEqual(id," in plan(found) and "embeddings" not in plan(found).split("ReadSchema")[1].split(">")[0]
    wanted = nn.search(stored, queries, 3, output_fields=["name", "tag"])
    assert found.columns == wanted.columns and sorted(found.collect()) == sorted(wanted.collect())
    none = nn.fields_by_id(hits.where("rank < 0"), stored, ["id"], ["name"])
    assert none.collect() == [] and none.columns == [*hits.select("query_id", "rank", "id", "score").columns, "name"]


def test_many_hits_are_joined(spark, corpus, queries, monkeypatch):
    monkeypatch.setattr(nn, "BROADCAST_HITS", 1)
    hits = nn.search(corpus, queries, 3)
    assert sorted(nn.fields_by_id(hits, corpus, ["id"], ["tag"]).collect()) == sorted(
        nn.search(corpus, queries, 3, output_fields=["tag"]).collect())


def _peak(run):
    """Bytes that a function's Python objects and matrices take at most."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_full_batches_take_little_memory():
    """A task scores a batch piece by piece, and finds what a plain sort finds."""
    random = np.random.default_rng(5)
    rows, asked = random.normal(size=(20_000, 256)).astype(np.float32), random.normal(size=(200, 256))
    asked[7] = asked[3]
    rows[15_000:15_010] = rows[4]
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    block = SimpleNamespace(value=(pa.array(np.arange(200)), asked, {}))
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + 10_000)), V.list_array(rows[at:at + 10_000])],
                                          names=["id", "v"]) for at in (0, 10_000)]
    found, peak = _peak(lambda: list(nn._task(block, 3, "COSINE", 0.01, ["id"], "v", None, schema)(iter(batches))))
    assert peak < 40e6
    scores = V.score_matrix(rows.astype(np.float64), asked, "COSINE")
    best = {q: np.lexsort((np.arange(len(rows)), -scores[:, q]))[:3].tolist() for q in range(200)}
    got = pa.Table.from_batches(found).to_pandas().groupby("query_id")["id"].apply(list).to_dict()
    assert got == best
    text = embedding._counts_to_unit_vectors(256).func
    words = pa.array(random.integers(0, 256, (10_000, 100)).astype(np.int32).tolist(), pa.list_(pa.int32()))
    vectors, peak = _peak(lambda: text(words))
    assert peak < 40e6 and len(vectors) == 10_000
    counts = np.array([np.bincount(row, minlength=256) for row in words.to_pylist()], dtype=np.float64)
    assert np.array_equal(V.matrix(vectors, 256).astype(np.float32), V.unit_rows(counts).astype(np.float32))


def test_equal_rows_wait_in_bounded_numbers(monkeypatch):
    monkeypatch.setattr(nn, "WAITING", 50)
    monkeypatch.setattr(nn, "SCORES", 40)
    vectors = np.ones((300, 4))
    vectors[250:] = [1.0, 0.0, 0.0, 0.0]
    best = nn._Best(np.array([[1.0, 1.0, 1.0, 1.0], [1.0, 0.0, 0.0, 0.0]]), 2, "IP", None, ["id"])
    ids = np.arange(300)[::-1].copy()
    best.offer(V.list_array(vectors), pa.table({"id": ids}))
    assert best.hits[["q", "merit", "id"]].to_numpy().tolist() == [[0, 4, 50], [0, 4, 51], [1, 1, 0], [1, 1, 1]]


def test_full_groups_take_little_memory():
    """Rows and queries of one group of the join, given as Arrow arrays of several chunks."""
    random = np.random.default_rng(6)
    rows, asked = random.normal(size=(8_000, 64)).astype(np.float32), random.normal(size=(3_000, 64))
    vectors = pa.chunked_array([V.list_array(rows[:3_000]), V.list_array(rows[3_000:])])
    best = nn._Best(asked, 4, "COSINE", None, ["id"])
    _, peak = _peak(lambda: best.offer(vectors, pa.table({"id": np.arange(8_000)})))
    assert peak < 40e6
    scores = V.score_matrix(rows.astype(np.float64), asked, "COSINE")
    for q in range(0, 3_000, 100):
        mine = best.hits[best.hits["q"] == q]["id"].tolist()
        assert mine == np.lexsort((np.arange(len(rows)), -scores[:, q]))[:4].tolist()
