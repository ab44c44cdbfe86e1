"""Vector functions: Column expressions for single scores, Arrow arrays for bulk work."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR = T.ArrayType(T.FloatType(), containsNull=False)

# Scores are rounded before they are ranked, so that the order of hits does not hang on the order
# in which a machine adds up a dot product. Equal rounded scores are ranked by id.
SCORE_DIGITS = 6

# A squared distance below this share of the squares it is made of is taken from the differences.
CANCELLED = 1e-3
# Bound on a matrix inside a task, in elements. Several of its size are held at a time, in every Python worker.
ELEMENTS = 1 << 19

# Metric names, and whether a greater value means a closer vector.
METRICS = {"COSINE": True, "IP": True, "L2": False}


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {', '.join(METRICS)}")
    return metric


def to_vector(values: Column) -> Column:
    """Any numeric array as a vector of floats."""
    return values.cast("array<float>")


def _fold(a: Column, b: Column, term) -> Column:
    products = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: x * y)


def similarity(a: Column, b: Column, metric: str = "COSINE") -> Column:
    """Score of two vector columns: cosine, inner product, or squared Euclidean distance.

    The cosine with a zero vector is 0.
    """
    check_metric(metric)
    if metric == "L2":
        score = _fold(a, b, lambda x, y: (x - y) * (x - y))
    elif metric == "IP":
        score = dot(a, b)
    else:
        norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
        score = F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(norms, F.lit(0.0)))
    return F.round(score, SCORE_DIGITS)


def hash_buckets(words: Column, dim: int) -> Column:
    """Bucket of every word: the first 32 bits of its MD5, modulo ``dim``."""
    return F.transform(
        words,
        lambda word: (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % dim).cast("int"),
    )


def matrix(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    """An Arrow array of equally long lists as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = len(vectors)
    if rows == 0:
        return np.zeros((0, dim or 0))
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths[0]) if dim is None else dim
    if vectors.null_count or (lengths != width).any():
        raise ValueError(f"every vector must be present and have {width} elements")
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("a vector holds a null element")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, width)


def list_array(values: np.ndarray) -> pa.Array:
    """A matrix as an Arrow array of float lists."""
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32).ravel()))


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    norms = np.sqrt((values * values).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1.0
    return values / norms


def score_matrix(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Rounded score of every row with every query, as ``similarity`` defines it."""
    if metric == "L2":
        # A common offset is taken off first, and what is small against its parts is worked out from
        # the differences, because the subtraction below would lose its digits.
        offset = queries.mean(axis=0) if len(queries) else 0.0
        near, far = rows - offset, queries - offset
        squares = (near * near).sum(axis=1)[:, None] + (far * far).sum(axis=1)[None, :]
        scores = np.maximum(squares - 2.0 * (near @ far.T), 0.0)
        row, query = np.nonzero(scores < CANCELLED * squares)
        step = max(1, ELEMENTS // max(1, rows.shape[1]))
        for at in range(0, len(row), step):
            i, j = row[at:at + step], query[at:at + step]
            difference = rows[i] - queries[j]
            scores[i, j] = (difference * difference).sum(axis=1)
    elif metric == "IP":
        scores = rows @ queries.T
    else:
        scores = unit_rows(rows) @ unit_rows(queries).T
    np.round(scores, SCORE_DIGITS, out=scores)
    scores += 0.0
    return scores
