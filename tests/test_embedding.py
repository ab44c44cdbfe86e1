import hashlib
import json
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrove.functions import vectors as V
from pagetrove.operators import embedding as E

TEXTS = ["a b a", "", None, "  x\n\ny ", "word " * 500]


def expected(text, dim):
    counts = np.zeros(dim)
    for word in (text or "").split():
        counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = np.linalg.norm(counts)
    return counts / norm if norm else counts


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, page_content string")


def test_hash_vectors(texts):
    rows = E.embed(texts, "hash", "16").sort("id").collect()
    for row, text in zip(rows, TEXTS):
        assert np.allclose(row.embeddings, expected(text, 16), atol=1e-6)


def test_sparse_weights_agree_with_vectors(texts):
    rows = E.HashEmbedder(16).weights(texts, "page_content", "id").collect()
    got = {i: np.zeros(16) for i in range(len(TEXTS))}
    for row in rows:
        got[row.id][row.bucket] = row.n
    for i, text in enumerate(TEXTS):
        norm = np.linalg.norm(got[i]) or 1
        assert np.allclose(got[i] / norm, expected(text, 16))


class Lengths:
    loads = 0

    def __call__(self):
        return lambda texts: np.array([[len(t), 1.0] for t in texts])


def test_model_embedder(spark):
    df = spark.range(0, 50, 1, 3).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    rows = E.embed(df, E.ModelEmbedder(Lengths()), text_col="t", out="v").collect()
    assert all(list(r.v) == [r.id, 1.0] for r in rows)


def test_registry(texts):
    E.register_embedder("twice", lambda model: E.HashEmbedder(2 * int(model)))
    assert E.embed(texts, "twice", "4").select(F.size("embeddings")).first()[0] == 8
    with pytest.raises(ValueError):
        E.embed(texts, "unknown")


def test_similarity_columns(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    for metric, values in {"COSINE": [0.8, 0.0], "IP": [4.0, 0.0], "L2": [2.0, 2.0]}.items():
        assert [r[0] for r in df.select(V.similarity(F.col("a"), F.col("b"), metric)).collect()] == values


def test_tfidf(spark, texts, tmp_path):
    fitted = E.TfIdfEmbedder(16).fit(texts)
    held = sum(expected(t, 16) > 0 for t in TEXTS)
    weights = np.log((1 + len(TEXTS)) / (1 + held)) + 1
    assert np.allclose(fitted.bucket_weights, weights)
    fitted.save(spark, str(tmp_path / "m"))
    again = E.TfIdfEmbedder.load(spark, str(tmp_path / "m"))
    assert again.dim == 16 and (again.bucket_weights == fitted.bucket_weights).all()
    for row, text in zip(E.embed(texts, again).sort("id").collect(), TEXTS):
        x = expected(text, 16) * weights
        assert np.allclose(row.embeddings, x / (np.linalg.norm(x) or 1), atol=1e-6)


def test_tfidf_has_to_be_fitted(spark, texts):
    with pytest.raises(ValueError, match="fitted"):
        E.embed(texts, "tfidf", "16")
    assert (E.TfIdfEmbedder(4).fit(texts.limit(0)).bucket_weights == 1).all()


class Logged:
    """A model that notes the texts it gets, a file a call."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        def run(texts):
            (self.folder / uuid.uuid4().hex).write_text(json.dumps(texts))
            return np.array([[-1.0 if t is None else len(t), 1.0] for t in texts])

        return run


@pytest.mark.parametrize("share", [1e-3, 0.3, 2.0])
def test_distinct_texts_are_embedded_once(spark, tmp_path, monkeypatch, share):
    monkeypatch.setattr(E, "HOT_SHARE", share)
    texts = ["hot"] * 300 + ["warm"] * 40 + [None] * 30 + [""] * 20 + [f"t{i}" for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, page_content string").repartition(5)
    found = E.embed_distinct(df, E.ModelEmbedder(Logged(tmp_path)))
    rows = {r.id: r for r in found.collect()}
    assert found.columns == ["id", "page_content", "embeddings"] and len(rows) == len(texts) == found.count()
    assert all(rows[i].embeddings == [-1.0 if t is None else len(t), 1.0] for i, t in enumerate(texts))
    seen = [t for file in tmp_path.iterdir() for t in json.loads(file.read_text())]
    assert sorted(seen, key=str) == sorted(set(texts), key=str)


def test_distinct_embedding_agrees_with_plain(spark, texts):
    plain = {r.id: r.embeddings for r in E.embed(texts.unionAll(texts), "hash", "16").collect()}
    found = E.embed_distinct(texts.unionAll(texts), "hash", "16").collect()
    assert len(found) == 2 * len(TEXTS) and all(plain[r.id] == r.embeddings for r in found)
    assert E.embed_distinct(texts.limit(0), "hash", "16").collect() == []
    # A column of the name of the result gives way, as in the plain form.
    again = E.embed_distinct(texts.withColumn("embeddings", F.lit(1)), "hash", "16")
    assert again.columns == ["id", "page_content", "embeddings"] and again.count() == len(TEXTS)
