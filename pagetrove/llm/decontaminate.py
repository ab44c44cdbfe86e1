"""Occurrences of benchmark passages in documents, by Wu-Manber multi-pattern search over words.

Patterns are word sequences: all windows of an item, or the whole of an item shorter than one. Patterns
of one length form a matcher. Its shift table tells, for the two words under the end of the search window,
how far the window can go on without missing a pattern; most pairs are in no pattern, and the window skips
nearly its own length. Where the shift is zero, the bucket of these two last words, then the first two,
select patterns, which are compared word by word.

The items reach the tasks by broadcast, a block of bounded size at a time. An item of any length is cut
into pieces that overlap by a window, so that no block depends on the length of one item.
"""

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import map_slices, term_stretches, utf8
from pagetrove.session import settled, spread

WINDOW = 10  # words of a pattern
PIECE = 4096  # words of a piece of an item
# Text of items that is broadcast at a time; a worker's tables take some hundred times as much.
BLOCK_BYTES = 2 << 20


class Matcher:
    """Patterns of one length. They are given as places in a list of words, where they begin."""

    def __init__(self, length: int, flat: list):
        self.length, self.flat = length, flat
        self.block = min(2, length)  # words by which shifts are looked up
        # A pair that no pattern has lets the window go on until the pair's second word is its first.
        self.most = length - self.block + 1
        self.shifts: dict[tuple, int] = {}
        # By last and first words: patterns with the numbers of the items that have them.
        self.buckets: dict[tuple, list[list]] = {}

    def add(self, place: int, items: frozenset) -> None:
        """Add a pattern, or more items to one that is there already."""
        pattern = self.flat[place:place + self.length]
        bucket = self.buckets.setdefault((*pattern[-self.block:], *pattern[:self.block]), [])
        for known in bucket:
            if self.flat[known[0]:known[0] + self.length] == pattern:
                known[1] |= items
                return
        bucket.append([place, items])
        for at in range(self.most):
            pair = tuple(pattern[at:at + self.block])
            self.shifts[pair] = min(self.most - 1 - at, self.shifts.get(pair, self.most))

    def find(self, words: list, begin: int) -> Iterator[tuple[int, list]]:
        """(start, pattern) of every occurrence among ``words`` that starts at ``begin`` or later."""
        length, block, most, shift = self.length, self.block, self.most, self.shifts.get
        end, last = begin + length, len(words)
        while end <= last:
            pair = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            move = shift(pair, most)
            if move:
                end += move
                continue
            start = end - length
            for pattern in self.buckets.get((*pair, *words[start:start + block]), ()):
                if self.flat[pattern[0]:pattern[0] + length] == words[start:end]:
                    yield start, pattern
            end += 1


class Searcher:
    """Matchers for all pattern lengths of some items, given as (name, words). An item of fewer words than a
    window is one pattern."""

    def __init__(self, items: list[tuple[str, list]], width: int = WINDOW):
        known: dict[bytes, bytes] = {}
        flat: list[bytes] = []
        matchers: dict[int, Matcher] = {}
        for number, (_, words) in enumerate(items):
            place, only = len(flat), frozenset([number])
            flat += [known.setdefault(word, word) for word in words]
            length = min(width, len(words))
            if length:
                matcher = matchers.setdefault(length, Matcher(length, flat))
                for at in range(place, len(flat) - length + 1):
                    matcher.add(at, only)
        self.names = [name for name, _ in items]
        self.matchers = list(matchers.values())

    def __call__(self, text: bytes) -> tuple[int, list[list[int]], set[str]]:
        """(number of words, spans of words inside occurrences, names of the items found) of a text, whose
        words are in hand a stretch at a time. The spans are sorted and apart."""
        total, held, offset, found = 0, [], 0, {}
        longest = max((m.length for m in self.matchers), default=1)
        spans: list[list[list[int]]] = [[] for _ in self.matchers]
        for words in term_stretches(text):
            total += len(words)
            words = held + words  # the end of the stretch before, where an occurrence may start
            for matcher, mine in zip(self.matchers, spans):
                # What the held words allow by themselves was found before.
                for start, pattern in matcher.find(words, max(0, len(held) - matcher.length + 1)):
                    found[id(pattern)] = pattern[1]
                    add_span(mine, offset + start, offset + start + matcher.length)
            held = words[max(0, len(words) - longest + 1):]
            offset += len(words) - len(held)
        return total, union(spans), {self.names[number] for number in set().union(*found.values())}


def add_span(spans: list[list[int]], begin: int, end: int) -> None:
    """Add a span that begins no earlier than those before, and is one with the last where they touch."""
    if spans and begin <= spans[-1][1]:
        spans[-1][1] = max(end, spans[-1][1])
    else:
        spans.append([begin, end])


def union(spans: list[list[list[int]]]) -> list[list[int]]:
    """The spans of several lists as one."""
    out: list[list[int]] = []
    for begin, end in sorted(span for mine in spans for span in mine):
        add_span(out, begin, end)
    return out


def _pieces(items: DataFrame, width: int) -> DataFrame:
    """(name, words): the items' words, cut where they are long. Every window of an item is in some piece, and a
    piece has fewer words than a window only if the item has."""
    def cut(text):
        held, whole = [], True
        for words in term_stretches(text):
            words = held + words
            for at in range(0, len(words) - width + 1, PIECE):
                whole = False
                yield words[at:at + PIECE + width - 1]
            held = words[max(0, len(words) - width + 1):]
        if whole and held:
            yield held

    def work(columns):
        rows = [(name, b" ".join(words)) for name, text in zip(*columns) for words in cut(text)]
        return [[name for name, _ in rows], [words for _, words in rows]]

    named = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name")
    return map_slices(items.select(named, utf8("text")), work, "name string, words binary", 64)


def _blocks(pieces: DataFrame, most: int) -> Iterator[list[tuple[str, list]]]:
    """The pieces, which differ, in blocks of at most ``most`` bytes, or twice those of the longest piece."""
    size = F.octet_length("words") + F.octet_length(F.col("name").cast("binary"))
    total, longest = (value or 0 for value in pieces.agg(F.sum(size), F.max(size)).first())
    most = max(most, 2 * longest)
    count = 1 if total <= most else -(-2 * total // most)
    while True:
        part = F.pmod(F.xxhash64("name", "words"), F.lit(count))
        largest = pieces.groupBy(part).agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0] or 0
        if largest <= most:
            break
        count *= 2
    for number in range(count):
        rows = pieces.where(part == number).toArrow()
        found = [(name, words.split()) for name, words in zip(*(c.to_pylist() for c in rows.columns))]
        if found or count == 1:
            yield found


_SPANS = "array<struct<begin: bigint, end: bigint>>"


_READY: dict[str, Searcher] = {}


def _ready(key: str, items: list, width: int) -> Searcher:
    """The searcher of this Python worker, made once for all its tasks."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Searcher(items, width)
    return _READY[key]


def _search(docs: DataFrame, items: list, width: int) -> DataFrame:
    """(doc_id, text_key, n_words, spans, items) of every row."""
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def work(columns):
        ids, keys, texts = columns
        search = _ready(key, shared.value, width)
        found = [search(text) for text in texts]
        return [ids, keys, [n for n, _, _ in found],
                [[{"begin": b, "end": e} for b, e in spans] for _, spans, _ in found],
                [sorted(names) for _, _, names in found]]

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), utf8("text"))
    return map_slices(keyed, work, f"doc_id long, text_key long, n_words long, spans {_SPANS}, items array<string>")


def _merged(found: DataFrame) -> DataFrame:
    """Spans and items of equal rows in several blocks as one."""
    def work(columns):
        ids, keys, spans, items = columns
        joined = [union([[[s["begin"], s["end"]] for s in part] for part in parts]) for parts in spans]
        return [ids, keys, [[{"begin": b, "end": e} for b, e in out] for out in joined],
                [sorted({name for part in parts for name in part}) for parts in items]]

    # A row and its copies have the same finding in a block, which is kept once.
    lists = found.select("doc_id", "text_key", "spans", "items").distinct().groupBy("doc_id", "text_key").agg(
        F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return map_slices(lists, work, f"doc_id long, text_key long, spans {_SPANS}, items array<string>")


def find_items(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of ``docs`` (doc_id, text, any others): the spans of words
    that lie inside an occurrence of a window of ``items`` (item_id, text, any others), sorted and apart, and
    the sorted names of the items with such windows.

    A window is ``width`` consecutive words of an item; an item of fewer words is one window, an item of none
    has no window. Words are those of ``term_stretches``. An item's name is its item_id as a string, "" if it
    is null; rows with one item_id are one item. Null texts have no words. Rows that repeat are searched
    each for itself. No documents give no rows, and no items no spans.
    """
    pieces = settled(_pieces(spread(items), width).distinct(), "item-pieces")
    results = [_search(docs, block, width) for block in _blocks(pieces, block_bytes)]
    if len(results) < 2:
        return (results or [_search(docs, [], width)])[0].drop("text_key")
    first = settled(results[0], "found-0")
    some = [first, *(settled(df.where(F.size("items") > 0), f"found-{i}") for i, df in enumerate(results[1:], 1))]
    every = some[0]
    for df in some[1:]:
        every = every.unionByName(df)
    merged = _merged(every.where(F.size("items") > 0)).withColumnsRenamed({"doc_id": "its_id", "text_key": "its_key"})
    match = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))
    return first.select("doc_id", "text_key", "n_words").join(merged, match, "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of the rows of ``find_items``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))
