"""Token counts that follow edits.

A document is held as its pre-tokens, in blocks under a segment tree whose nodes sum up characters and
tokens. An edit goes down the tree to the block where it starts, and back to a block with two pre-tokens
before it, because the vocabulary's pattern looks no further. From there pre-tokens are cut anew, until
a cut falls on the start of an old block behind the edit; only these are encoded. They replace the
blocks in between, and the sums above these are brought up to date.
"""

import json
import os
import zlib
from bisect import bisect_left
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import in_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Fixed value: the pattern by which this vocabulary cuts texts into pre-tokens.
PATTERN = regex.compile(public_tokenizers.PATTERN)
BLOCK = 32  # pre-tokens of a block
LOOK = 2  # pre-tokens before an edit, and characters behind a cut, that the pattern may look at
KEPT = 300_000  # pre-tokens whose counts are kept
TOGETHER = 64  # texts in hand

_LOADED: dict[str, "PieceCounts"] = {}


# Fixed value: the printable bytes, which the byte alphabet leaves as they are; the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([byte for byte in range(256) if byte not in _PRINTABLE], range(256, 512)))


class PieceCounts:
    """Number of tokens of each pre-token; a token never goes beyond one. Pre-tokens are cut here, so that new ones
    go to the library's model itself, in its byte alphabet."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        if made.get("normalizer") or made["model"]["type"] != "BPE" or made["model"].get("dropout"):
            raise ValueError(f"{path} is not made like {os.path.basename(VOCABULARY)}: its counts would come out wrong")
        self.tokenize = Tokenizer.from_file(path).model.tokenize
        self.known: dict[str, int] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        tokenize, known, blank = self.tokenize, self.known, chr(_BYTES[ord(" ")])
        for piece in pieces:
            if piece in known:
                continue
            if piece.isascii() and piece.isprintable():
                as_bytes = piece.replace(" ", blank)
            else:
                as_bytes = piece.encode(errors="replace").decode("latin-1").translate(_BYTES)
            known[piece] = len(tokenize(as_bytes))

    def forget(self) -> None:
        if len(self.known) > KEPT:
            self.known.clear()

    def __call__(self, pieces: list[str]) -> list[int]:
        counts = list(map(self.known.get, pieces))
        if None in counts:
            self.learn(pieces)
            counts = list(map(self.known.__getitem__, pieces))
        return counts


def loaded(path: str = VOCABULARY) -> PieceCounts:
    """The counter of this Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceCounts(path)
    return _LOADED[path]


class TokenTree:
    """A text that can be edited, with the number of its tokens.

    Leaves are blocks of pre-tokens. The tree is an implicit binary one over the blocks: node 1 is the
    root, nodes 2 i and 2 i + 1 are below node i.
    """

    def __init__(self, text: str, counts: PieceCounts, pieces: list[str] | None = None):
        self.counts = counts
        self.encoded = 0  # pre-tokens encoded so far
        pieces = PATTERN.findall(text) if pieces is None else pieces
        numbers = self._count(pieces)
        self.blocks = [(pieces[i:i + BLOCK], numbers[i:i + BLOCK]) for i in range(0, len(pieces), BLOCK)]
        self._build()

    def _count(self, pieces):
        self.encoded += len(pieces)
        return self.counts(pieces)

    def _build(self):
        self.width = 1
        while self.width < max(1, len(self.blocks)):
            self.width *= 2
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for at, (pieces, numbers) in enumerate(self.blocks, self.width):
            self.chars[at], self.tokens[at] = sum(map(len, pieces)), sum(numbers)
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node):
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(piece for pieces, _ in self.blocks for piece in pieces)

    def _find(self, place):
        """(block, character at which it starts) of the block that holds a place."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place >= before + self.chars[node]:
                before += self.chars[node]
                node += 1
        return min(node - self.width, len(self.blocks) - 1), before

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters [start, end) by ``new``."""
        if not 0 <= start <= end <= self.length:
            raise ValueError("the edit lies outside the text")
        if not self.blocks:
            self.blocks = [([], [])]
            self._build()
        first, begin = self._find(max(0, start - 1))
        whole = 0
        while first and whole < LOOK:
            first -= 1
            begin -= self.chars[self.width + first]
            whole += len(self.blocks[first][0])
        # Old text in hand: from ``begin`` to ``edge``, where block ``last`` starts.
        last, edge, old = first, begin, []
        while last < len(self.blocks) and edge <= end:
            old += self.blocks[last][0]
            edge += self.chars[self.width + last]
            last += 1
        old = "".join(old)
        text = old[:start - begin] + new + old[end - begin:]
        moved = len(new) - (end - start) - begin
        meets = {edge + moved: last}  # starts of old blocks behind the edit, as places in ``text``
        made, at, met = [], 0, None
        while met is None:
            complete = last == len(self.blocks)
            found = PATTERN.findall(text, at)
            starts = list(accumulate(map(len, found), initial=at))
            # With more text a cut near the end may turn out otherwise.
            sure = len(found) if complete else bisect_left(starts, len(text) - LOOK, 1) - 1
            meeting = [(i, block) for place, block in meets.items()
                       if (i := bisect_left(starts, place)) < len(found) and i <= sure and starts[i] == place]
            if meeting:
                sure, met = min(meeting)
            made += found[:sure]
            at = starts[sure]
            if complete and met is None:
                met = last
            if met is None:
                text += "".join(self.blocks[last][0])
                edge += self.chars[self.width + last]
                last += 1
                meets[edge + moved] = last
        self._replace(first, met, made, self._count(made))

    def _replace(self, first, last, pieces, numbers):
        room = last - first
        if room and len(pieces) <= 4 * BLOCK * room:
            # As many blocks as before, so that only the sums above them change.
            size = max(1, -(-len(pieces) // room))
            nodes = set()
            for number in range(room):
                span = slice(number * size, (number + 1) * size)
                self.blocks[first + number] = (pieces[span], numbers[span])
                leaf = self.width + first + number
                self.chars[leaf], self.tokens[leaf] = sum(map(len, pieces[span])), sum(numbers[span])
                nodes.add(leaf // 2)
            while nodes - {0}:
                for node in nodes:
                    self._sum(node)
                nodes = {node // 2 for node in nodes}
        else:
            self.blocks[first:last] = [
                (pieces[i:i + BLOCK], numbers[i:i + BLOCK]) for i in range(0, len(pieces), BLOCK)]
            self._build()


EDITS = "array<struct<begin: bigint, end: bigint, new: string>>"
_OUT = "doc_id long, n_tokens long, edited_tokens long, n_edits long, edited_crc32 long, encoded long, encoded_again long"


def count_edits(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts before and after the edits of every row of ``docs`` (doc_id, text, edits, any others).

    ``edits`` is an array of (begin, end, new) in code points, applied one after the other to the text as it
    is then. Places outside the text are moved to its ends, an end before its begin is the begin, a
    null ``new`` is empty, and edits without a begin are left out; null edits or no edits change nothing. A
    null text is empty. ``edited_crc32`` is that of the edited text in UTF-8; ``encoded`` is the number of
    pre-tokens of the first version, ``encoded_again`` how many were encoded for all edits together. Rows that
    repeat are counted alike; an empty table gives no rows. No row leaves its task.
    """
    fields = [piece.split()[0] for piece in _OUT.split(", ")]

    def work(batches):
        counts = loaded(vocabulary)
        for ids, texts, edits in in_slices(batches, TOGETHER):
            rows = []
            cut = [PATTERN.findall(text or "") for text in texts]
            counts.forget()
            counts.learn(set().union(*cut))
            for doc_id, text, changes, pieces in zip(ids, texts, edits, cut):
                tree = TokenTree(text or "", counts, pieces)
                before, first = tree.total, tree.encoded
                done = 0
                for change in changes or ():
                    if change is None or change["begin"] is None:
                        continue
                    begin = min(max(0, change["begin"]), tree.length)
                    end = change["begin"] if change["end"] is None else change["end"]
                    tree.edit(begin, min(max(begin, end), tree.length), change["new"] or "")
                    done += 1
                rows.append((doc_id, before, tree.total, done, zlib.crc32(tree.text().encode()), first,
                             tree.encoded - first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in zip(*rows)], names=fields)

    return docs.select("doc_id", "text", F.col("edits").cast(EDITS).alias("edits")).mapInArrow(work, _OUT)
