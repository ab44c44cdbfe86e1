"""Ranked search for the words of items, with every bag of words scored once.

A document counts only by its bag: how often it has each term of the items' vocabulary, and by a number
that stands for its length. Documents that share both are one class, found by a hash and told apart by
the bag itself. Classes are scored, each once for all items; the best classes of an item hold all of its
best documents, and only their members are looked up, in ascending doc_id.

Items are taken in blocks of bounded size, whose vocabulary every task gets.
"""

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import in_slices, map_slices, term_stretches, utf8
from pagetrove.llm.heaps import GREATEST, Heaps, merged
from pagetrove.session import scratch_path, settled, spread

TOP = 50
BLOCK_BYTES = 4 << 20  # terms of items, and room for their best classes, that are in hand at a time
CELLS = 1 << 17  # scores in hand at a time, of classes by items
PARTS = 1 << 22  # most parts of these scores in hand at a time

_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])  # a bag is these, in the order of the terms


class Vocabulary:
    """The terms of a block of items (item_id, terms), numbered, and the places of the items that have each."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.items = len(items)
        self.numbers: dict[bytes, int] = {}
        pairs = sorted({(self.numbers.setdefault(term, len(self.numbers)), at)
                        for at, (_, terms) in enumerate(items) for term in terms})
        terms = np.array([term for term, _ in pairs], np.int64)
        self.places = np.array([at for _, at in pairs], np.int64)  # of the items, term after term
        self.ends = np.searchsorted(terms, np.arange(len(self.numbers)), side="right")
        self.begins = np.searchsorted(terms, np.arange(len(self.numbers)))

    def bag(self, text: bytes) -> tuple[int, bytes]:
        """(number of terms, bag) of a text."""
        total, counts = 0, Counter()
        for terms in term_stretches(text):
            total += len(terms)
            counts.update(map(self.numbers.get, terms))
        counts.pop(None, None)
        return total, np.array(sorted(counts.items()), np.int64).reshape(-1, 2).astype("<u4").tobytes()

    def scores(self, bags: list[bytes], m: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of bags (rows) for all items (columns)."""
        pairs = np.frombuffer(b"".join(bags), _PAIR)
        sizes = np.fromiter(map(len, bags), np.int64, len(bags)) // _PAIR.itemsize
        terms, tf, row = pairs["term"].astype(np.int64), pairs["tf"].astype(np.int64), np.repeat(np.arange(len(bags)), sizes)
        part = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
        # Every term adds its part to all items that have it.
        holders = self.ends[terms] - self.begins[terms]
        before = np.cumsum(holders) - holders
        item = self.places[np.arange(holders.sum()) + np.repeat(self.begins[terms] - before, holders)]
        scores = np.zeros((len(bags), self.items), np.int64)
        np.add.at(scores.reshape(-1), np.repeat(row * self.items, holders) + item, np.repeat(part, holders))
        return scores


_READY: dict[str, Vocabulary] = {}


def _ready(key: str, items: list) -> Vocabulary:
    """The vocabulary of this Python worker, made once for all its tasks."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Vocabulary(items)
    return _READY[key]


def _distinct_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the terms of each item, once each."""
    def cut(batches):
        for ids, texts in in_slices(batches, 64):
            for item_id, text in zip(ids, texts):
                for terms in term_stretches(text):
                    found = sorted(set(terms))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item_id] * len(found), pa.string()), pa.array(found, pa.binary())],
                        names=["item_id", "term"])

    named = items.select(F.col("item_id").cast("string"), utf8("text"))
    return named.mapInArrow(cut, "item_id string, term binary").distinct()


def _blocks(terms: DataFrame, most: int, room: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with their terms in blocks of at most ``most`` bytes, or twice those of the largest item. An item
    takes ``room`` bytes besides its terms."""
    size = F.octet_length("term") + 8
    sizes = settled(terms.groupBy("item_id").agg((F.sum(size) + room).alias("size")), "item-sizes")
    total, longest = (value or 0 for value in sizes.agg(F.sum("size"), F.max("size")).first())
    most = max(most, 2 * longest)
    count = 1 if total <= most else -(-2 * total // most)
    while True:
        part = F.pmod(F.xxhash64("item_id"), F.lit(count))
        largest = sizes.groupBy(part).agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0] or 0
        if largest <= most:
            break
        count *= 2
    for number in range(count):
        found: dict = {}
        rows = terms.where(part == number).toArrow()
        for item_id, term in zip(*(column.to_pylist() for column in rows.columns)):
            found.setdefault(item_id, []).append(term)
        if found:
            yield sorted(found.items(), key=str)


def _score_classes(shared, key, top):
    """The best classes of every item among a task's classes (class_id, m, bag, least)."""
    def run(batches):
        items, weights = shared.value
        vocabulary = _ready(key, items)
        heaps = Heaps(len(items), top, ids=2, floor=1)  # a score of zero is no hit
        most = max(1, min(CELLS // len(items), PARTS // max(1, len(vocabulary.places))))
        # The first steps are short: they fill the heaps, whose floors then keep most scores out.
        step = min(16, most)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                class_ids, m, bags, least = batch.slice(at, step).columns
                scores = vocabulary.scores(bags.to_pylist(), m.to_numpy(), weights)
                found, item = np.nonzero(scores >= heaps.floor)
                # Without a doc_id a class comes last among equal scores.
                least = least.fill_null(GREATEST).to_numpy()
                heaps.take(item, scores[found, item], least[found], class_ids.to_numpy()[found])
                at, step = at + step, min(2 * step, most)
        least, class_id = heaps.ids
        yield pa.RecordBatch.from_arrays(
            [pa.array([items[at][0] for at in heaps.key], pa.string()), pa.array(class_id), pa.array(least),
             pa.array(heaps.score)], names=["item_id", "class_id", "least", "score"])

    return run


def _count_documents(batches):
    """(term, df) of a task's bags."""
    counts: np.ndarray = np.zeros(0, np.int64)
    for batch in batches:
        for (bags,) in in_slices([batch]):
            here = np.bincount(np.frombuffer(b"".join(bags), _PAIR)["term"], minlength=len(counts))
            here[:len(counts)] += counts
            counts = here
    terms = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(counts[terms])], names=["term", "df"])


def _search(docs: DataFrame, items: list, top: int) -> DataFrame:
    """(item_id as a string, rank, doc_id, score) for the items of one block."""
    context, key = docs.sparkSession.sparkContext, uuid.uuid4().hex
    shared = context.broadcast(items)

    def count(columns):
        vocabulary = _ready(key, shared.value)
        found = [vocabulary.bag(text) for text in columns[1]]
        return [columns[0], [n for n, _ in found], [bag for _, bag in found]]

    bags = settled(map_slices(docs.select("doc_id", utf8("text")), count, "doc_id long, n long, bag binary"), "bags")
    total = bags.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    bags = bags.where(F.octet_length("bag") > 0)
    counted = bags.select("bag").mapInArrow(_count_documents, "term long, df long").groupBy("term").agg(F.sum("df"))
    found = counted.toArrow()  # no more rows than the vocabulary has terms
    df = np.zeros(len(Vocabulary(items).numbers), np.int64)
    df[found.column(0).to_numpy()] = found.column(1).to_numpy()
    documents = total["documents"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

    # Members of a class have the same bag and the same m; the hash keeps equal ones together.
    m = F.expr(f"50 + (50 * n * {documents}L) div {max(1, total['terms'] or 0)}L")
    bags = bags.select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    same = ["hash", "m", "bag"]
    classes = settled(bags.groupBy(*same).agg(F.min("doc_id").alias("least")).withColumn(
        "class_id", F.monotonically_increasing_id()), "bag-classes")
    scored = classes.select("class_id", "m", "bag", "least").mapInArrow(
        _score_classes(context.broadcast((items, weights)), key, top),
        "item_id string, class_id long, least long, score long")
    # Of an item's best documents none is outside its ``top`` best classes: the first documents of these are as good.
    best = settled(merged(scored, ["item_id"], "score", "least", top, "place"), "best-classes")
    chosen = settled(best.select("item_id", "class_id", "score").join(
        classes.select("class_id", *same), "class_id").drop("class_id"), "chosen-classes")

    # At most ``top`` hashes an item. Of a class that holds a third of all documents, a task keeps ``top``.
    members = bags.join(F.broadcast(chosen.select("hash").distinct()), "hash", "left_semi")
    members = merged(members.withColumn("one", F.lit(1)), same, "one", "doc_id", top, "place").drop("one", "place")
    return merged(chosen.join(members, same), ["item_id"], "score", "doc_id", top, "rank").select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best rows of ``docs`` (doc_id, text, any others) with a score
    above zero for each of ``items`` (item_id, text, any others), ranked from 1, equal scores by ascending doc_id.

    Terms are those of ``term_stretches``. N documents have terms, L in all; df documents have a given one. A
    term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))). A document of n terms has m = 50 + 50 n N div L, and
    its score sums w (10 ** 9 tf div (1000 tf + 20 m)) over the different terms of the item, tf times in it.

    Null texts have no terms. Items with one item_id, null included, are one item; items without terms, or with
    terms that no document has, give no rows. Documents that repeat are ranked each for itself; one without doc_id comes
    last among equal scores. An empty table gives no rows.
    """
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    terms = settled(_distinct_terms(spread(items)), "item-terms")
    paths = []
    for block in _blocks(terms, block_bytes, 24 * top):
        paths.append(scratch_path(spark, "ranked"))
        _search(docs, block, top).withColumn("item_id", F.col("item_id").cast(kind)).write.parquet(paths[-1])
    if paths:
        return spark.read.parquet(*paths)
    return spark.createDataFrame([], "item_id string, rank int, doc_id long, score long").withColumn(
        "item_id", F.col("item_id").cast(kind))
