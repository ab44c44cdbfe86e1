"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are sorted by their rank in Gray order. Runs of neighbours share most bits; the bits on
which all codes below a node agree are kept in the node as a masked pattern, once, and a child keeps
only what its parent does not. A search goes down from the top, adds up the differences seen in the
patterns, and leaves a whole group as soon as the sum exceeds the limit.

The index is spread by a pigeonhole: of ``pieces`` equal parts of a code at most ``limit`` can differ,
so two linked codes agree on ``pieces - limit`` of them. For every choice of parts there is one table,
whose codes have those parts in front; codes that agree there are neighbours in Gray order. Tables are
dealt by range of the rank, so a crowded range is split over tasks. Ranges that go over the edge of a
task, or over more codes than a run may hold, are joined run by run: first the patterns at the tops of
their indexes, and only runs whose patterns are near enough meet with all their codes.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pagetrove.llm.common import map_slices, same_row, utf8, word_bounds
from pagetrove.llm.components import connected, spanning
from pagetrove.session import settled

SEED = 42
BITS = 64
LEAF = 32  # codes under one node of the lowest level
FANOUT = 8  # nodes under one node of a higher level
RUN = 4096  # codes of one run
QUERIES = 256  # codes searched at a time


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of one UTF-8 text: a bit is 1 if it is set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts, ends = word_bounds(words)
    count = max(1, len(words) - width + 1)
    firsts, lasts = starts[:count].tolist(), ends[-count:].tolist()
    shingles = [joined[a:b] for a, b in zip(firsts, lasts)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, 1 << 15):
        part = hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, *more: Column) -> DataFrame:
    """(doc_id, code) and the long columns ``more``: the SimHash of every text as a signed long. Null counts as the
    empty text, whose code is 0."""
    names = docs.select(*more).columns

    def work(columns):
        ids, texts, *rest = columns
        codes = np.array([fingerprint(text, width) for text in texts], dtype=np.uint64)
        return [ids, codes.view(np.int64), *rest]

    schema = ", ".join(["doc_id long, code long", *(f"{name} long" for name in names)])
    return map_slices(docs.select("doc_id", utf8("text"), *more), work, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the order in which neighbours differ in one bit."""
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


class Layout:
    """The tables: for each choice of parts, the order of bits that puts these parts in front."""

    def __init__(self, limit: int, pieces: int):
        if not 0 <= limit < pieces <= BITS:
            raise ValueError("need 0 <= limit < pieces <= 64")
        edges = [BITS * i // pieces for i in range(pieces + 1)]
        parts = list(zip(edges[:-1], edges[1:]))
        self.orders, self.heads = [], []
        for chosen in combinations(range(pieces), pieces - limit):
            front = [parts[i] for i in chosen]
            rest = [parts[i] for i in range(pieces) if i not in chosen]
            self.orders.append(front + rest)
            self.heads.append(sum(b - a for a, b in front))

    def permuted(self, codes: np.ndarray, table: int) -> np.ndarray:
        made, room = np.zeros_like(codes), BITS
        for a, b in self.orders[table]:
            room -= b - a
            made |= ((codes >> np.uint64(BITS - b)) & np.uint64((1 << (b - a)) - 1)) << np.uint64(room)
        return made

    def restored(self, codes: np.ndarray, table: int) -> np.ndarray:
        made, room = np.zeros_like(codes), BITS
        for a, b in self.orders[table]:
            room -= b - a
            made |= ((codes >> np.uint64(room)) & np.uint64((1 << (b - a)) - 1)) << np.uint64(BITS - b)
        return made

    def head(self, ranks: np.ndarray, table: int) -> np.ndarray:
        """The front parts, as ranks of equal fronts have equal leading bits."""
        return ranks >> np.uint64(BITS - self.heads[table])


class GrayIndex:
    """Hierarchy over codes in Gray order."""

    def __init__(self, codes: np.ndarray):
        every = np.uint64(2**64 - 1)
        pattern, fixed = codes, np.full(len(codes), every)
        self.levels = []  # from the codes up: pattern, bits fixed here but not above, first child
        width = LEAF
        while True:
            starts = np.arange(0, len(pattern), width)
            if len(pattern) == 1:
                self.levels.append((pattern, fixed, None))
                break
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            varies = np.bitwise_or.reduceat(pattern ^ first, starts)
            above = np.bitwise_and.reduceat(fixed, starts) & ~varies
            owner = np.repeat(above, np.diff(np.append(starts, len(pattern))))
            self.levels.append((pattern, fixed & ~owner, starts))
            pattern, fixed, width = pattern[starts] & above, above, FANOUT

    def within(self, queries: np.ndarray, limit: int):
        """Pairs (query, code) of positions with at most ``limit`` differing bits."""
        top = self.levels[-1]
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        seen = np.bitwise_count((queries ^ top[0][0]) & top[1][0]).astype(np.int64)
        query, node, seen = query[seen <= limit], node[seen <= limit], seen[seen <= limit]
        for pattern, fixed, starts in self.levels[-2::-1]:
            begin = starts[node]
            size = np.append(starts[1:], len(pattern))[node] - begin
            below = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            query, seen = np.repeat(query, size), np.repeat(seen, size)
            seen = seen + np.bitwise_count((queries[query] ^ pattern[below]) & fixed[below])
            near = seen <= limit
            query, node, seen = query[near], below[near], seen[near]
        return query, node


def _linked(codes, limit, other=None):
    """Labels that join all linked codes, of one run or of two runs laid end to end."""
    labels = np.arange(len(codes) + (0 if other is None else len(other)))
    index = GrayIndex(codes if other is None else other)
    shift = 0 if other is None else len(codes)
    for at in range(0, len(codes), QUERIES):
        query, found = index.within(codes[at:at + QUERIES], limit)
        labels = spanning(labels, query + at, found + shift)
    return labels


def _small_blocks(codes, block, limit):
    """Labels within blocks of at most LEAF codes, where a leaf is all there is to search."""
    labels = np.arange(len(codes))
    for shift in range(1, LEAF):
        same = np.flatnonzero(block[shift:] == block[:-shift])
        if not len(same):
            break
        near = same[np.bitwise_count(codes[same] ^ codes[same + shift]) <= limit]
        labels = spanning(labels, near, near + shift)
    return labels


def _edges(codes, labels):
    """Links of every code to the first one of its label."""
    at = np.flatnonzero(labels != np.arange(len(codes)))
    return codes[at], codes[labels[at]]


_FOUND = "a long, b long, part int, head long, run long, pattern long, fixed long, ranks binary"


def top_pattern(codes: np.ndarray) -> tuple[int, int]:
    """The first code, and the bits on which all others agree with it, as signed longs."""
    fixed = ~np.bitwise_or.reduce(codes ^ codes[0])
    return tuple(np.array([codes[0], fixed]).view(np.int64).tolist())


def _found(a=(), b=(), part=None, runs=()):
    links = len(a)
    tops = [top_pattern(gray_code(r[1])) for r in runs]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([np.asarray(a, np.uint64).view(np.int64), np.zeros(len(runs), np.int64)])),
        pa.array(np.concatenate([np.asarray(b, np.uint64).view(np.int64), np.zeros(len(runs), np.int64)])),
        pa.array([None] * links + [part] * len(runs), pa.int32()),
        pa.array([None] * links + [int(np.int64(r[0])) for r in runs], pa.int64()),
        pa.array([None] * links + [int(r[1][:1].view(np.int64)[0]) for r in runs], pa.int64()),
        pa.array([None] * links + [pattern for pattern, _ in tops], pa.int64()),
        pa.array([None] * links + [fixed for _, fixed in tops], pa.int64()),
        pa.array([None] * links + [r[1].tobytes() for r in runs], pa.binary()),
    ], names=["a", "b", "part", "head", "run", "pattern", "fixed", "ranks"])


def _search_tables(layout, limit):
    """Links inside the runs of a task, and the runs that may go on elsewhere."""

    def chunk(table, ranks):
        """One stretch of a table. Its first and its last block may have more codes elsewhere."""
        heads = layout.head(ranks, table)
        starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
        sizes = np.diff(np.append(starts, len(ranks)))
        codes = gray_code(ranks)
        large = np.flatnonzero(sizes > LEAF)
        # The codes of large blocks get numbers of their own, so that the first search passes over them.
        block = np.repeat(np.arange(len(starts)), sizes)
        for at in large:
            block[starts[at]:starts[at] + sizes[at]] = -1 - np.arange(sizes[at])
        labels = _small_blocks(codes, block, limit)
        runs = []
        for at in large:
            end = starts[at] + sizes[at]
            for low in range(starts[at], end, RUN):
                high = min(low + RUN, end)
                labels[low:high] = _linked(codes[low:high], limit) + low
                if sizes[at] > RUN:
                    runs.append((heads[low], ranks[low:high]))
        for at in {0, len(starts) - 1}:
            if sizes[at] <= RUN:
                runs.append((heads[starts[at]], ranks[starts[at]:starts[at] + sizes[at]]))
        a, b = _edges(codes, labels)
        return _found(layout.restored(a, table), layout.restored(b, table), table, runs)

    def run(batches):
        table, kept = None, np.zeros(0, np.uint64)
        for batch in batches:
            tables = batch.column(0).to_numpy()
            ranks = batch.column(1).to_numpy().view(np.uint64)
            edges = np.flatnonzero(np.append(True, tables[1:] != tables[:-1]))
            for begin, end in zip(edges, np.append(edges[1:], len(tables))):
                if len(kept) and (tables[begin] != table or len(kept) >= 8 * RUN):
                    yield chunk(table, kept)
                    kept = kept[:0]
                table = int(tables[begin])
                kept = np.concatenate([kept, ranks[begin:end]])
        if len(kept):
            yield chunk(table, kept)

    return run


def _search_runs(layout, limit):
    def run(batches):
        for batch in batches:
            for table, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                mine = gray_code(np.frombuffer(left, np.uint64))
                other = gray_code(np.frombuffer(right, np.uint64))
                labels = _linked(mine, limit, other)
                a, b = _edges(np.concatenate([mine, other]), labels)
                made = [layout.restored(x, table).view(np.int64) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["a", "b"])

    return run


def code_links(codes: DataFrame, limit: int = 3, pieces: int = 5) -> DataFrame:
    """(a, b): links between distinct ``code`` values, enough to join all whose codes are, directly or
    by way of others, at most ``limit`` bits apart. ``codes`` must be a written table of distinct codes.

    More ``pieces`` make shorter blocks in more tables: 5 give 10 tables with blocks of 25 bits, good
    for some billions of codes. Result and completeness do not depend on it.
    """
    layout = Layout(limit, pieces)

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for table in range(len(layout.orders)):
                ranks = gray_rank(layout.permuted(values, table)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ranks), table, np.int32)), pa.array(ranks)],
                    names=["part", "rank"])

    dealt = codes.select("code").mapInArrow(deal, "part int, rank long")
    tasks = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = dealt.repartitionByRange(tasks, "part", "rank").sortWithinPartitions("part", "rank")
    found = settled(ranked.mapInArrow(_search_tables(layout, limit), _FOUND), "simhash-links")
    inside = found.where(F.col("ranks").isNull()).select("a", "b")
    runs = found.where(F.col("ranks").isNotNull())
    pairs = near_runs(runs, limit)
    for side in ("a", "b"):
        pairs = pairs.join(runs.select("part", F.col("run").alias(f"run_{side}"),
                                       F.col("ranks").alias(f"ranks_{side}")), ["part", f"run_{side}"])
    across = pairs.select("part", "ranks_a", "ranks_b").mapInArrow(
        _search_runs(layout, limit), "a long, b long")
    return inside.unionByName(across)


def near_runs(runs: DataFrame, limit: int) -> DataFrame:
    """(part, run_a, run_b): the runs of a head whose patterns do not differ in more than ``limit`` of the bits that
    are fixed in both. No codes move for it; runs left out have no link, whatever their codes."""
    def tops(side):
        return runs.select("part", "head", *(F.col(c).alias(f"{c}_{side}") for c in ("run", "pattern", "fixed")))

    differing = F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(
        F.col("fixed_a")).bitwiseAND(F.col("fixed_b"))
    near = (F.col("run_a") < F.col("run_b")) & (F.bit_count(differing) <= limit)
    return tops("a").join(tops("b"), ["part", "head"]).where(near).select("part", "run_a", "run_b")


def near_duplicates(docs: DataFrame, width: int = 3, limit: int = 3, pieces: int = 5) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text, any others).

    The fingerprint has 16 hex digits. ``component_id`` is the smallest doc_id that can be reached by
    links of at most ``limit`` differing bits, the own one included; rows with a null doc_id take part
    and never name a component (null if nothing else is in it). Null and blank texts have fingerprint
    zero and are linked by it. Rows that repeat give rows that repeat. An empty table gives none.
    """
    return _grouped(fingerprints(docs, width), limit, pieces).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(prints: DataFrame, limit: int, pieces: int) -> DataFrame:
    """Rows with fingerprints (doc_id, code, any others), with the component_id of their code."""
    prints = settled(prints, "simhash-codes")
    codes = settled(prints.groupBy("code").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected(code_links(codes, limit, pieces))
    # Codes without a link are their own root.
    rooted = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "least", F.coalesce("root", "code").alias("root"))
    # Written, so that the join has two plain shuffles, of which Spark can split a large component.
    named = settled(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-named")
    return prints.join(rooted.join(named, "root").select("code", "component_id"), "code")


def keep_first(docs: DataFrame, width: int = 3, limit: int = 3, pieces: int = 5) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the rows with its smallest doc_id stay.

    A row is told by its doc_id and text, so that a text whose doc_id another text has, too, is not lost
    with that; rows that are equal in both stay or go together. Rows with a null doc_id stay, as no other row can be
    named in their place."""
    key = F.xxhash64("text").alias("text_key")
    groups = _grouped(fingerprints(docs, width, key), limit, pieces)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id", "text_key").distinct()
    return same_row(docs, gone, "left_anti")
