"""Hard negatives by exact inner products of integers.

Anchors are taken in blocks of bounded size, which every task gets as an int64 matrix. A task multiplies
tiles of anchors with tiles of its rows by Strassen's recursion and keeps heaps of bounded size, which
are merged by a shuffle. The first pass over the rows meets anchors with the rows of their label and
finds the positives; their scores fix the windows for the second pass, over the rows of other labels.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.heaps import GREATEST, LEAST, Heaps, merged
from pagetrove.operators.numbering import ids_as_written, range_sorted
from pagetrove.session import scratch_path, spread

LEAF = 32  # a product with a side up to this is made directly
ANCHORS = 512  # anchors of a tile
ROWS = 1024  # rows of a tile, after a few smaller ones
BLOCK_BYTES = 32 << 20  # anchors that are broadcast at a time
# Scores times 100 have to fit into 64 bits.
GREATEST_SCORE = (1 << 63) // 128



def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two int64 matrices, exact as long as it fits: sums of halves may wrap round, and do so
    back. Odd sides get a line of zeros."""
    rows, depth, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, depth, columns) <= LEAF:
        return a @ b
    if rows % 2 or depth % 2:
        a = np.pad(a, ((0, rows % 2), (0, depth % 2)))
    if depth % 2 or columns % 2:
        b = np.pad(b, ((0, depth % 2), (0, columns % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    both = strassen(a11 + a22, b11 + b22)
    low_left = strassen(a21 + a22, b11)
    high_right = strassen(a11, b12 - b22)
    high_left = strassen(a22, b21 - b11)
    low_right = strassen(a11 + a12, b22)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = both + high_left - low_right + strassen(a12 - a22, b21 + b22)
    out[:i, k:] = high_right + low_right
    out[i:, :k] = low_left + high_left
    out[i:, k:] = both - low_left + high_right + strassen(a21 - a11, b11 + b12)
    return out[:rows, :columns]


def whole_matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(256 x) of every element, as rows of one width: that of the longest vector, or the given one. A
    shorter vector ends in zeros, a longer one is cut, as its other products would be with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    values = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(values).max(initial=0) >= 2.0 ** 62:
        raise ValueError("an element is too large for scores of 64 bits")
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), width), np.int64)
    inside = place < width
    out[row[inside], place[inside]] = values[inside].astype(np.int64)
    return out


def _check_scores(a, b):
    """Scores come out right only if they fit; the bound is that of the lengths."""
    longest = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for m in (a, b)]
    if longest[0] * longest[1] >= GREATEST_SCORE:
        raise ValueError("the vectors are too long for scores of 64 bits")


def _tiles(batches, width) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of some rows at a time. The first tiles are small: they fill the heaps, whose
    floors then keep most scores out."""
    size = 16
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy() for i in range(2))
        matrix, at = whole_matrix(batch.column(2), width), 0
        while at < len(ids):
            span = slice(at, at + size)
            yield ids[span], labels[span], matrix[span]
            at, size = at + size, min(2 * size, ROWS)


class _Block:
    """Anchors of one block, in the order of their labels."""

    def __init__(self, found: pa.Table):
        self.ids = found.column("vec_id").to_numpy()
        self.labels = found.column("label").to_numpy()
        self.matrix = whole_matrix(found.column("vector"))

    def tiles(self, begin=0, end=None):
        end = len(self.ids) if end is None else end
        return [slice(at, min(at + ANCHORS, end)) for at in range(begin, end, ANCHORS)]


_POSITIVES = "anchor int, positive_id long, positive_score long"


def _find_positives(shared, size):
    def run(batches):
        block = shared.value
        held: dict[int, list] = {}  # by label: tiles of anchors with their heaps
        for ids, labels, matrix in _tiles(batches, block.matrix.shape[1]):
            for label in np.unique(labels).tolist():
                if label not in held:
                    ends = np.searchsorted(block.labels, [label, label + 1])
                    held[label] = [(span, Heaps(span.stop - span.start, size)) for span in block.tiles(*ends.tolist())]
                if not held[label]:
                    continue
                mine = labels == label
                rows, numbers = matrix[mine], ids[mine]
                for span, heaps in held[label]:
                    _check_scores(block.matrix[span], rows)
                    scores = strassen(block.matrix[span], rows.T)
                    wanted = scores >= heaps.floor[:, None]
                    wanted &= block.ids[span][:, None] != numbers
                    anchor, row = np.nonzero(wanted)
                    heaps.take(anchor, scores[anchor, row], numbers[row])
        for tiles in held.values():
            for span, heaps in tiles:
                yield pa.RecordBatch.from_arrays(
                    [pa.array((heaps.key + span.start).astype(np.int32)), pa.array(heaps.ids[0]), pa.array(heaps.score)],
                    names=["anchor", "positive_id", "positive_score"])

    return run


class _Windows:
    """Positives of a block by anchor and place, and the scores that their negatives may have."""

    def __init__(self, found: pa.Table, anchors: int, size: int, least: int, most: int):
        anchor, place = found.column("anchor").to_numpy(), found.column("place").to_numpy() - 1
        self.ids = np.zeros((anchors, size), np.int64)
        self.scores = np.zeros((anchors, size), np.int64)
        self.low, self.high = np.full((anchors, size), GREATEST), np.full((anchors, size), LEAST)
        scores = found.column("positive_score").to_numpy()
        self.ids[anchor, place], self.scores[anchor, place] = found.column("positive_id").to_numpy(), scores
        # least * positive <= 100 * negative <= most * positive, in whole numbers.
        self.low[anchor, place], self.high[anchor, place] = -(-least * scores // 100), most * scores // 100


_NEGATIVES = ("anchor int, place int, anchor_id long, positive_id long, positive_score long, negative_id long, "
              "negative_score long")


def _find_negatives(shared, size):
    def run(batches):
        block, windows = shared.value
        places = windows.ids.shape[1]
        tiles = [(span, Heaps((span.stop - span.start) * places, size)) for span in block.tiles()]
        for ids, labels, matrix in _tiles(batches, block.matrix.shape[1]):
            for span, heaps in tiles:
                high = windows.high[span]
                low = np.maximum(windows.low[span], heaps.floor.reshape(high.shape))
                _check_scores(block.matrix[span], matrix)
                scores = strassen(block.matrix[span], matrix.T)
                # All windows of an anchor at once, then each for itself.
                wanted = scores >= low.min(axis=1)[:, None]
                wanted &= scores <= high.max(axis=1)[:, None]
                wanted &= block.labels[span][:, None] != labels
                wanted &= block.ids[span][:, None] != ids
                anchor, row = np.nonzero(wanted)
                score = scores[anchor, row]
                for place in range(places):
                    inside = (low[anchor, place] <= score) & (score <= high[anchor, place])
                    heaps.take(anchor[inside] * places + place, score[inside], ids[row[inside]])
        for span, heaps in tiles:
            anchor, place = heaps.key // places + span.start, heaps.key % places
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(block.ids[anchor]),
                 pa.array(windows.ids[anchor, place]), pa.array(windows.scores[anchor, place]), pa.array(heaps.ids[0]),
                 pa.array(heaps.score)],
                names=[part.split()[0] for part in _NEGATIVES.split(", ")])

    return run


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50,
         most: int = 95, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among
    ``vectors`` (vec_id, label, embedding, any others): the rows whose vec_id is divisible by ``every``.

    Scores are inner products of floor(256 x). An anchor's positives are its first ``positives`` rows of the
    same label; each of them gets its first ``negatives`` rows of other labels whose score is from ``least``
    to ``most`` hundredths of the positive's. Greater scores come first, ties go to the smaller vec_id.

    Rows without vec_id, label or vector, or with a component that is null or not finite, take no part. Vectors of
    different lengths are taken as followed by zeros. Rows that repeat count each for itself, but as an
    anchor once, and no row of an anchor's vec_id is its positive or negative. An empty table, or one
    without anchors, gives no rows. Scores beyond 2 ** 56 are an error.
    """
    spark = vectors.sparkSession
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = spread(vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    chosen = rows.where(F.col("vec_id") % every == 0).distinct()
    # Anchors of one label stand together, so that a block has few labels.
    anchors = ids_as_written(range_sorted(chosen, "label", "vec_id"), "number", start=0)
    size = anchors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    cap = max(1, block_bytes // (8 * (size["width"] or 0) + 48 * positives + 16))
    results = []
    for begin in range(0, size["n"], cap):
        found = anchors.where(F.col("number").between(begin, begin + cap - 1))
        block = _Block(found.orderBy("label", "vec_id").drop("number").toArrow())
        labels = np.unique(block.labels)
        near = rows.where(F.col("label").between(int(labels[0]), int(labels[-1])))
        first = near.mapInArrow(_find_positives(spark.sparkContext.broadcast(block), positives), _POSITIVES)
        first = merged(first, ["anchor"], "positive_score", "positive_id", positives, "place")
        windows = _Windows(first.toArrow(), len(block.ids), positives, least, most)
        second = rows.mapInArrow(
            _find_negatives(spark.sparkContext.broadcast((block, windows)), negatives), _NEGATIVES)
        results.append(merged(second, ["anchor", "place"], "negative_score", "negative_id", negatives, "rank").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        if size["n"] > cap:
            # Written block by block, so that no plan and no failure spans them all.
            path = scratch_path(spark, "negatives")
            results[-1].write.parquet(path)
            results[-1] = path
    if size["n"] > cap:
        return spark.read.parquet(*results)
    return results[0] if results else spark.createDataFrame([], (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
