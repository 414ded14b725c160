"""Token ids of whole texts by a byte-level vocabulary of the ``tokenizers`` library.

Such a tokenizer cuts a text into pre-tokens by a fixed pattern and merges within each.
Where no two white-space characters meet, a cut surely falls before each space, around
each line feed, and between a Latin letter and a punctuation mark. Texts are cut there in
bulk, each different piece of a slice is encoded once, by the library's own merges, and
the ids are gathered. Other texts are cut one by one; those that hold a special token's
string, and vocabularies of another kind, go through the library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from skyledger.llm.texts import filled

# White space as Unicode defines it, the pre-token pattern of byte-level
# vocabularies, the same for ASCII, and letters that are in every version of Unicode.
WHITE = "\t-\r \x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"

#: Marks a cut. A text that holds it is cut alone.
CUT = "\x1f"
#: Pieces whose ids a process keeps between slices.
REMEMBERED = 400_000


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteLevel:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        before = spec["pre_tokenizer"] or {}
        kind = before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)
        self.fast = spec["normalizer"] is None and kind == ("ByteLevel", False, True)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._model = self.library.model
        self._letters = _byte_letters()
        self._pre_token, self._ascii_pre_token = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        self._latin_word = re.compile(f" ?[{LATIN}]+")
        self._forget()

    def _forget(self) -> None:
        self._known, self._ids = pa.array([], pa.string()), np.empty(0, self.dtype)
        self._length = np.empty(0, np.int64)

    def _merge(self, pre_token: str) -> bytes:
        if pre_token.isascii() and pre_token.isprintable():
            written = pre_token.replace(" ", self._letters[32])
        else:
            written = pre_token.encode().decode("latin-1").translate(self._letters)
        return array(self._code, [t.id for t in self._model.tokenize(written)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The ids of one or more whole pre-tokens."""
        if self._latin_word.fullmatch(piece):
            return self._merge(piece)
        return b"".join(map(self._merge, (self._ascii_pre_token if piece.isascii() else self._pre_token).findall(piece)))

    def whole(self, text: str) -> np.ndarray:
        """By the library alone."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def alone(self, text: str) -> np.ndarray:
        if not self.fast or any(s in text for s in self.special):
            return self.whole(text)
        return np.frombuffer(b"".join(map(self._merge, self._pre_token.findall(text))), dtype=self.dtype)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of each piece are kept; those not yet known are encoded."""
        if len(self._known) > REMEMBERED:
            self._forget()
        places = pc.index_in(pieces, value_set=self._known)
        new = pc.is_null(places)
        if pc.any(new).as_py():
            pieces_new = pieces.filter(new)
            encoded = list(map(self._piece, pieces_new.to_pylist()))
            lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) // self.dtype.itemsize
            known = len(self._known)
            self._known = pa.concat_arrays([self._known, pieces_new])
            self._length = np.concatenate([self._length, lengths])
            self._ids = np.concatenate([self._ids, np.frombuffer(b"".join(encoded), dtype=self.dtype)])
            new = new.to_numpy(zero_copy_only=False)
            places = places.fill_null(0).to_numpy(zero_copy_only=False).copy()
            places[new] = known + np.arange(len(encoded))
            return places
        return places.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        texts = filled(texts)
        if not self.fast:
            return [self.whole(t) for t in texts.to_pylist()]
        slow = pc.match_substring_regex(texts, f"[{WHITE}][{WHITE}]|{CUT}").to_numpy(zero_copy_only=False)
        for string in self.special:
            slow = slow | pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        bulk = texts.filter(pa.array(~slow))
        cut = pc.replace_substring(bulk, " ", CUT + " ")
        cut = pc.replace_substring(cut, "\n", f"{CUT}\n{CUT}")
        cut = pc.replace_substring_regex(cut, f"([{LATIN}])([.,;:!?])", rf"\1{CUT}\2")
        lists = pc.split_pattern(cut, CUT)
        offsets = lists.offsets.to_numpy()
        encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        del bulk, cut, lists
        places = self._places(encoded.dictionary)[encoded.indices.to_numpy(zero_copy_only=False)]
        lengths = self._length[places]
        ends = np.cumsum(lengths)
        start = np.cumsum(self._length) - self._length
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(start[places] - (ends - lengths), lengths)
        at += np.arange(total)
        ids = self._ids[at]
        bounds = np.concatenate([[0], ends])[offsets - offsets[0]].tolist()
        rows = iter(zip(bounds[:-1], bounds[1:], strict=True))
        return [self.alone(texts[i].as_py()) if s else ids[slice(*next(rows))] for i, s in enumerate(slow.tolist())]


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevel:
    """One for each process; it keeps what it has merged."""
    return ByteLevel(path)
