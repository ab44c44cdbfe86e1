"""Token ids of whole texts by a vocabulary file of the tokenizers library, word by word.

The vocabulary this is for drops white space and never joins characters across it, so the ids of a text
are those of its words in a row. The words of many texts are split and numbered by Arrow, and only the
different ones are looked at: those of plain Latin letters and signs are put in lower case and cut, all together,
where the vocabulary's own pattern cuts them; the ids of pieces seen before are kept, and new ones go to the
library's model itself, in its byte alphabet. Other words go through the whole library. The ids of all texts
are then gathered by numpy. A vocabulary that is made in another way is refused.
"""

import json
import os
import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
KEPT = 300_000  # entries of the newer half of a store, which then becomes the older half
TOGETHER = 512  # new pieces of one call
_MARK = b"\x1c"  # stands between new pieces; one id in a byte-level vocabulary

# Fixed value: the vocabulary's pattern, for lower-case words of printable ASCII and Latin-1 letters. The line
# breaks stand between words.
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|\n|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\na-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
_ALL_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ\n]*")
_END = 0xFFFFFFFF  # stands for a line break among ids

# Fixed value: the same pattern in full, as the vocabulary file has it.
_WHOLE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LOADED: dict[str, "WordIds"] = {}


# Fixed value: the printable bytes, which the byte alphabet leaves as they are; the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([byte for byte in range(256) if byte not in _PRINTABLE], range(256, 512)))


def check_vocabulary(path: str) -> None:
    """An error unless ids of a text are those of its words, and a word's those of its pieces, as made here."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    cut, alphabet = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    steps = [step["type"] for step in (made.get("normalizer") or {}).get("normalizers") or ()]
    if (steps != ["NFC", "Replace", "Lowercase"] or cut.get("pattern") != {"Regex": _WHOLE_PATTERN}
            or not cut.get("invert") or alphabet.get("type") != "ByteLevel" or alphabet.get("add_prefix_space")
            or alphabet.get("use_regex") or made["model"]["type"] != "BPE" or made["model"].get("dropout")):
        raise ValueError(f"{path} is not made like {os.path.basename(VOCABULARY)}: its ids would come out wrong")


class _Store:
    """Ids by text, of bounded size: what was not asked for lately is dropped."""

    def __init__(self, kept: int):
        self.kept = kept
        self.new: dict = {}
        self.old: dict = {}

    def missing(self, texts: set) -> list:
        """Texts not known at all; known ones are brought into the newer half."""
        unknown, old = texts.difference(self.new), self.old
        again = [text for text in unknown if text in old]
        self.new.update(zip(again, map(old.__getitem__, again)))
        return list(unknown.difference(again))

    def turn(self):
        if len(self.new) > self.kept:
            self.new, self.old = {}, self.new


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        check_vocabulary(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._of([_MARK.decode()])[0]
        self.pieces = _Store(KEPT)

    def _of(self, texts):
        return [np.array(e.ids, dtype="<u4")
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_library(self, texts):
        """Ids of each text without white space, by the whole library."""
        mark, made = _MARK.decode(), {}
        plain = [t for t in texts if mark not in t] if len(self.mark) == 1 else []
        for at in range(0, len(plain), TOGETHER):
            part = plain[at:at + TOGETHER]
            ids = self._of([f" {mark} ".join(part)])[0]
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            made.update(zip(part, np.split(ids, ends[:-1])))
        for at, text in enumerate(plain):
            if at % TOGETHER:
                made[text] = made[text][1:]  # without the mark before it
        odd = [t for t in texts if t not in made]
        made.update(zip(odd, self._of(odd)))
        return [made[t] for t in texts]

    def _learn(self, pieces):
        tokenize, kept = self.tokenizer.model.tokenize, self.pieces.new
        for piece in self.pieces.missing(pieces):
            as_bytes = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTES)
            ids = [token.id for token in tokenize(as_bytes)]
            kept[piece] = struct.pack(f"<{len(ids)}I", *ids)
        kept["\n"] = _END.to_bytes(4, "little")

    def _of_words(self, words: list[bytes]) -> pa.LargeBinaryArray:
        """The ids of each of different words."""
        text, odd = b"\n".join(words).decode(errors="replace"), {}
        if "<|" in text or not _ALL_PLAIN.fullmatch(text):
            several = text.split("\n")
            for at, word in enumerate(several):
                if "<|" in word or not _PLAIN.fullmatch(word):
                    odd[at], several[at] = word, ""
            text = "\n".join(several)
        pieces = _PIECE.findall(text.lower())
        self._learn(set(pieces))
        flat = np.frombuffer(b"".join(map(self.pieces.new.__getitem__, pieces)), "<u4")
        at_end = flat == _END
        ends = np.append(np.flatnonzero(at_end), len(flat)) - np.arange(len(words))
        offsets = np.append(0, 4 * ends)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [
            None, pa.py_buffer(offsets), pa.py_buffer(flat[~at_end])])
        if odd:
            mask = np.zeros(len(words), bool)
            mask[list(odd)] = True
            made = [ids.tobytes() for ids in self._by_library(list(odd.values()))]
            found = pc.replace_with_mask(found, pa.array(mask), pa.array(made, pa.large_binary()))
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text, as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        self.pieces.turn()
        held = pa.array(texts, pa.large_binary())
        split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(held), *held.buffers()[1:]))
        words = split.flatten().cast(pa.large_binary()).dictionary_encode()
        if not len(words):
            return [b""] * len(texts)
        every = self._of_words(words.dictionary.to_pylist()).take(words.indices)
        _, offsets, data = every.buffers()
        ends = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * every.offset)[split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data else b""
        return [bytes(data[begin:end]) for begin, end in zip(ends, ends[1:])]


def loaded(path: str = VOCABULARY) -> WordIds:
    """The encoder of this Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
