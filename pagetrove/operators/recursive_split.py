"""Recursive character splitting of one text. A chunk is always a slice of the text."""

from bisect import bisect_left, bisect_right
from itertools import pairwise

# Separators from coarse to fine; the empty one cuts between any two characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def _cuts(text, separator):
    """Offsets that cut the text so that each separator opens a piece."""
    if not separator:
        return list(range(len(text) + 1))
    cuts = [0]
    at = text.find(separator)
    while at != -1:
        if at:
            cuts.append(at)
        at = text.find(separator, at + len(separator))
    cuts.append(len(text))
    return cuts


def _pack(text, cuts, size, overlap):
    """Chunks of at most ``size`` characters between cuts that lie less than ``size`` apart.

    The next chunk starts at the first cut that leaves at most ``overlap`` characters of the last
    chunk in front and still has room for one new piece.
    """
    last = len(cuts) - 1
    start = 0
    while start < last:
        end = bisect_right(cuts, cuts[start] + size) - 1
        chunk = text[cuts[start]:cuts[end]].strip()
        if chunk:
            yield chunk
        if end == last:
            return
        start = min(
            end,
            max(bisect_left(cuts, cuts[end] - overlap), bisect_left(cuts, cuts[end + 1] - size)),
        )


def split_recursively(text, size, overlap, separators=SEPARATORS):
    """Chunks of a text, cut at the coarsest separator it holds; long pieces are cut finer."""
    if len(text) <= size and size > 1:
        whole = text.strip()
        return [whole] if whole else []
    level = next(i for i, separator in enumerate(separators) if separator in text)
    finer = separators[level + 1:]
    chunks = []
    run = [0]
    for start, end in pairwise(_cuts(text, separators[level])):
        if end - start < size:
            run.append(end)
            continue
        chunks.extend(_pack(text, run, size, overlap))
        piece = text[start:end]
        chunks.extend(split_recursively(piece, size, overlap, finer) if finer else [piece])
        run = [end]
    chunks.extend(_pack(text, run, size, overlap))
    return chunks
