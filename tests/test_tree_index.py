import numpy as np
import pytest

from pagetrove.operators import index, tree_index
from pagetrove.operators import search as nn

RNG = np.random.default_rng(11)
CENTERS = RNG.normal(size=(40, 12))
VECTORS = (CENTERS[RNG.integers(0, 40, 3000)] + 0.25 * RNG.normal(size=(3000, 12))).astype(np.float32)
VECTORS[5] = 0
VECTORS[6, 2] = np.nan
QUERIES = (CENTERS + 0.2 * RNG.normal(size=CENTERS.shape)).astype(np.float32)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = [(i, v.tolist()) for i, v in enumerate(VECTORS)] + [(9000, None)]
    path = str(tmp_path_factory.mktemp("corpus") / "rows")
    spark.createDataFrame(rows, "id long, embeddings array<float>").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(QUERIES)] + [(77, None)]
    return spark.createDataFrame(rows, "query_id long, embeddings array<float>")


@pytest.fixture(scope="module")
def tree(corpus, tmp_path_factory):
    return tree_index.build_tree(corpus, str(tmp_path_factory.mktemp("tree")), nlist=64, ncoarse=8)


def found(df):
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in df.collect())


def test_a_tree_holds_the_collection(spark, tree):
    rows = tree_index.read_tree(spark, tree).collect()
    assert sorted(r.id for r in rows) == [*range(3000), 9000]
    fine = spark.read.parquet(f"{tree}/fine").collect()
    assert len({r.coarse for r in fine}) == 8 and 64 <= len(fine) <= 72
    centroids = {r.cell: np.array(r.centroid) for r in fine}
    siblings = {}
    for r in fine:
        siblings.setdefault(r.coarse, []).append(r.cell)
    for r in rows:
        if r.id in (5, 6, 9000):
            continue
        scores = {c: float(np.dot(centroids[c], r.embeddings)) for c in siblings[r.coarse]}
        assert scores[r.cell] == pytest.approx(max(scores.values()))


def test_all_cells_are_exact_search(spark, corpus, queries, tree):
    assert found(tree_index.search_tree(spark, tree, queries, 5, 10_000, 8)) == found(nn.search(corpus, queries, 5))


def recall(hits, exact):
    pairs = lambda rows: {(q, i) for q, _, i, _ in rows}
    return len(pairs(hits) & pairs(exact)) / len(pairs(exact))


def test_recall_with_few_probes(spark, corpus, queries, tree, tmp_path):
    exact = found(nn.search(corpus, queries, 5))
    flat = index.build_index(corpus, str(tmp_path / "flat"), nlist=64)
    for probes in (2, 4):
        by_tree = recall(found(tree_index.search_tree(spark, tree, queries, 5, probes, 4)), exact)
        by_flat = recall(found(index.search_index(spark, flat, queries, 5, probes)), exact)
        assert by_tree >= by_flat - 0.05 and by_tree >= 0.8


def test_small_groups_and_appended_rows(spark, corpus, queries, tmp_path, monkeypatch):
    monkeypatch.setattr(tree_index, "GROUP_ROWS", 50)
    path = tree_index.build_tree(corpus.where("id % 2 = 0"), str(tmp_path / "t"), nlist=20, ncoarse=3)
    tree_index.append_to_tree(corpus.where("id % 2 = 1"), path)
    assert found(tree_index.search_tree(spark, path, queries, 3, 1000, 3)) == found(nn.search(corpus, queries, 3))


def test_a_coarse_cell_with_equal_vectors(spark, tmp_path):
    rows = [(i, [1.0, 0.0]) for i in range(500)] + [(500, [0.0, 1.0]), (501, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "id long, embeddings array<float>")
    path = tree_index.build_tree(table, str(tmp_path / "t"), nlist=50, ncoarse=2)
    asked = spark.createDataFrame([(1, [1.0, 0.1])], "query_id long, embeddings array<float>")
    assert [h[2] for h in found(tree_index.search_tree(spark, path, asked, 3, 1, 1))] == [0, 1, 2]
    with pytest.raises(ValueError):
        tree_index.build_tree(table.limit(0), str(tmp_path / "e"), nlist=5)


def test_spherical_means():
    means = tree_index.spherical_means(np.array([[2.0, 0], [4, 0.1], [0, 3], [0.1, 5], [0, 0]]), 3)
    assert np.allclose(np.linalg.norm(means, axis=1)[np.any(means != 0, axis=1)], 1)
    assert len(tree_index.spherical_means(np.ones((4, 2)), 3)) == 1
