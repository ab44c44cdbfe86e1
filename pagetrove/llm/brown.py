"""Scoring of texts by a Brown class-based bigram model.

p(word | word before) = p(class | class before) * p(word | class), with a class for the end of a text,
which also stands before its first word. Classes are found by exchange clustering: units are moved, one
after the other, to the class that raises the likelihood of the class bigrams most. Units are the most
frequent words, and for all other words their endings, so that every word, seen or not, has a class.

All counts cover all training documents. Counts of words are a table; what goes to the driver and to the
tasks are the unit bigrams by class, whose number depends on the parameters alone, and the counts of a
bounded number of frequent words. The other words meet their counts by a join.
"""

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pagetrove.llm.common import in_slices, utf8
from pagetrove.session import settled

WORD_UNITS = 4096  # at most so many frequent words are units of their own
END_UNITS = 2048  # units for endings of other words
KNOWN = 1 << 18  # at most so many words have their counts in every task
LONGEST = 64  # bytes of such a word
CLASSES = 64
ROUNDS = 5
DELTA = 0.2  # added to the count of every word of a class, and of one unknown word
MU = 5.0  # weight of the classes' own shares in the transitions
FLUSH = 500_000  # entries after which a task hands on its counts
ENDING = 3  # bytes
END = WORD_UNITS + END_UNITS  # unit of the end of a text


def held_out(column: str = "doc_id", of: int = 7, part: int = 2) -> Column:
    """Documents not to learn from; a null id counts as the empty string."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % of == part


def ending_unit(word: bytes) -> int:
    return WORD_UNITS + xxh64_intdigest(word[-ENDING:], seed=42) % END_UNITS


def _ending_unit(word):
    return (WORD_UNITS + F.pmod(F.xxhash64(F.substring(word, -ENDING, ENDING)), F.lit(END_UNITS))).cast("int")


def _count_words(batches):
    counts = {}
    get = counts.get
    for (texts,) in in_slices(batches, 256):
        for text in texts:
            for word in text.lower().split():
                counts[word] = get(word, 0) + 1
        if len(counts) > FLUSH:
            yield _word_counts(counts)
            counts.clear()
    if counts:
        yield _word_counts(counts)


def _word_counts(counts):
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
        names=["word", "n"])


def _least_count(words, most):
    """The smallest count such that at most ``most`` words have it or more, up to steps of 4 %."""
    step = F.floor(F.log2("n") * 16).cast("int")
    bins = words.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).collect()
    least, total = None, 0
    for row in sorted(bins, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return least if least is not None else 1 << 62


def _x_log_x(x):
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(bigrams: np.ndarray) -> float:
    """Of the class bigrams, but for what does not depend on the classes."""
    return float(_x_log_x(bigrams).sum() - _x_log_x(bigrams.sum(axis=0)).sum()
                 - _x_log_x(bigrams.sum(axis=1)).sum())


def exchange(classes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One round: new classes of the units. ``left[u, c]`` says how often unit u follows class c, and
    ``right[u, c]`` how often it is followed by it, for the classes before the round. The last class
    is that of the end and takes no other unit."""
    classes, many = classes.copy(), left.shape[1]
    joint = np.zeros((many, many))
    np.add.at(joint.T, classes, left)  # column of a unit's class
    order = np.argsort(-left.sum(axis=1), kind="stable")
    for unit in order:
        own = classes[unit]
        before, after = left[unit], right[unit]
        if own == many - 1 or not before.any():
            continue
        joint[:, own] -= before
        joint[own] -= after
        np.maximum(joint, 0, out=joint)
        seen, said = before > 0, after > 0
        gain = (_x_log_x(joint[seen] + before[seen, None]) - _x_log_x(joint[seen])).sum(axis=0)
        gain += (_x_log_x(joint[:, said] + after[said]) - _x_log_x(joint[:, said])).sum(axis=1)
        inward, outward = joint.sum(axis=0), joint.sum(axis=1)
        gain -= _x_log_x(inward + before.sum()) - _x_log_x(inward)
        gain -= _x_log_x(outward + after.sum()) - _x_log_x(outward)
        best = int(np.argmax(gain[:-1]))
        joint[:, best] += before
        joint[best] += after
        classes[unit] = best
    return classes


@dataclass
class Model:
    """What every task gets. Its size is bounded by the parameters."""

    known: dict[bytes, int]  # frequent words, numbered
    counts: np.ndarray  # by number
    units: np.ndarray  # by number
    classes: np.ndarray  # by unit
    transitions: np.ndarray  # log10 p(class | class before)
    scale: np.ndarray  # by class: log10 of what the counts of its words are divided by
    tokens: int  # training tokens
    distinct: int  # distinct ones
    base: float = field(init=False)

    def __post_init__(self):
        self.base = float(np.log10(self.tokens + self.distinct + 1))
        self.emission = np.log10(self.counts + DELTA) - self.scale[self.classes[self.units]]
        self.base_of = np.log10(self.counts + 1.0) - self.base

    def score(self, words: list[bytes], ends: int):
        """Score and base score but for the counts of words not in ``known``, the number of known
        tokens, and those words. ``ends`` is the count of the end token."""
        get = self.known.get
        at = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
        rare = np.flatnonzero(at < 0)
        units = self.units[at] if len(self.units) else np.zeros(len(at), np.int64)
        names = [words[i] for i in rare.tolist()]
        units[rare] = [ending_unit(word) for word in names]
        path = np.concatenate([[END], units, [END]])
        path = self.classes[path]
        common = at[at >= 0]
        score = self.transitions[path[:-1], path[1:]].sum() + self.emission[common].sum()
        score -= self.scale[self.classes[units[rare]]].sum()
        base = self.base_of[common].sum() + np.log10(ends + 1) - self.base * (1 + len(rare))
        return float(score), float(base), len(common) + (ends > 0), names


def _bigrams(known, units):
    """Counts of neighbouring units in each task."""

    def run(batches):
        get = known.get
        codes, size = [], 0

        def made():
            found, n = np.unique(np.concatenate(codes), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])

        for (texts,) in in_slices(batches, 256):
            for text in texts:
                words = text.lower().split()
                path = np.empty(len(words) + 2, dtype=np.int64)
                path[0] = path[-1] = END
                at = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
                path[1:-1] = units[at] if len(units) else 0
                for i in np.flatnonzero(at < 0).tolist():
                    path[i + 1] = ending_unit(words[i])
                codes.append(path[:-1] * (END + 1) + path[1:])
                size += len(path)
            if size > 4_000_000:
                yield made()
                codes, size = [], 0
        if codes:
            yield made()

    return run


def _by_class(pairs, classes, many):
    """left, right as ``exchange`` wants them."""
    lookup = F.lit(classes.tolist())

    def of(unit):
        return F.element_at(lookup, (F.col(unit) + 1).cast("int"))

    def matrix(unit, other):
        out = np.zeros((END + 1, many))
        for row in pairs.groupBy(unit, of(other).alias("class")).agg(F.sum("n").alias("n")).toLocalIterator():
            out[row[unit], row["class"]] = row["n"]
        return out

    return matrix("next", "unit"), matrix("unit", "next")


def train(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS):
    """(model, table of words and counts, count of ends, smallest count in the model) from ``docs`` (text)."""
    docs = docs.select(utf8("text").alias("text"))
    ends = docs.count()
    words = settled(docs.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "brown-words")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    short = words.where(F.octet_length("word") <= LONGEST)
    own, least = _least_count(short, WORD_UNITS), _least_count(short, KNOWN)
    top = sorted(((-row["n"], bytes(row["word"])) for row in short.where(F.col("n") >= least).collect()))
    known = {word: i for i, (_, word) in enumerate(top)}
    counts = np.array([-n for n, _ in top], dtype=np.float64)
    units = np.array([i if -n >= own else ending_unit(word) for i, (n, word) in enumerate(top)], dtype=np.int64)
    coded = docs.mapInArrow(_bigrams(known, units), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = settled(coded.select(
        F.floor(F.col("pair") / (END + 1)).cast("int").alias("unit"),
        (F.col("pair") % (END + 1)).cast("int").alias("next"), "n"), "brown-pairs")
    # Words of each unit: one, or all that have the ending.
    is_unit = (F.col("n") >= own) & (F.octet_length("word") <= LONGEST)
    per_unit = np.zeros(END + 1)
    per_unit[units[counts >= own]] = 1
    per_unit[END] = ends > 0
    for row in words.where(~is_unit).groupBy(_ending_unit(F.col("word")).alias("unit")).count().collect():
        per_unit[row["unit"]] = row["count"]
    many = classes + 1
    of = np.arange(END + 1) % classes
    of[END] = classes
    best = None
    for _ in range(rounds + 1):
        left, right = _by_class(pairs, of, many)
        joint = np.zeros((many, many))
        np.add.at(joint.T, of, left)
        value = likelihood(joint)
        if best is not None and value <= best[0]:
            break
        best = (value, of, joint)
        of = exchange(of, left, right)
    _, of, joint = best
    total = joint.sum()
    shares = (joint.sum(axis=0) + 1) / (total + many)
    transitions = (joint + MU * shares) / (joint.sum(axis=1, keepdims=True) + MU)
    in_class = joint.sum(axis=0)
    kinds = np.zeros(many)
    np.add.at(kinds, of, per_unit)
    scale = np.log10(in_class + DELTA * (kinds + 1))
    model = Model(known, counts, units, of, np.log10(transitions), scale,
                  int(totals["n"] or 0) + ends, int(totals["words"]) + (ends > 0))
    return model, words, ends, least


def score(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``
    (doc_id, text, any others); the model learns from those that are not held out.

    Scores are log10 of the text's probability, the end included, so a null or empty text has the
    probability of ending at once. Unknown words share one place in each class. Rows that repeat are
    learned from and scored each for itself. With no training document every score is that of a
    model without counts. An empty table gives no rows.
    """
    model, words, ends, least = train(docs.where(~held_out()), classes, rounds)

    def work(batches):
        for ids, out, texts in in_slices(batches, 256):
            rows = []
            for doc_id, held, text in zip(ids, out, texts):
                split = text.lower().split()
                value, base, known, rare = model.score(split, ends)
                rows.append((doc_id, held, len(split) + 1, known, base, value,
                             [{"word": w, "times": n} for w, n in Counter(rare).items()]))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    partly = settled(docs.select("doc_id", held_out().alias("held_out"), utf8("text")).mapInArrow(
        work, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              "rare array<struct<word: binary, times: bigint>>").withColumn("row", F.monotonically_increasing_id()), "brown-scored")
    # Words in the model are never looked up here.
    fewer = words.where((F.col("n") < least) | (F.octet_length("word") > LONGEST))
    asked = partly.select("row", F.inline("rare"))
    found = asked.join(fewer, "word", "left").select(
        "row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    extra = found.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("base"),
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(DELTA))).alias("value"))

    def plus(column, more):
        return (F.col(column) + F.coalesce(F.col(more), F.lit(0))).alias(column)

    return partly.drop("rare").join(extra, "row", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        plus("base_score", "base"), plus("score", "value"))
