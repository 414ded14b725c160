"""Token counts by a vocabulary of whole words, lower case and without white space.

Such a tokenizer drops white space and never merges across it. Which vocabulary strings
encode alone as one token is proved once for each process, by encoding every one of them;
pre-tokens among these count one without being merged. Only the rest are merged, by the
library, each different one once per slice.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import texts

# Fixed value: the pre-tokens of such vocabularies, of lower-case ASCII text.
ASCII_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"

#: Words whose counts a process keeps between slices.
REMEMBERED = 600_000

COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class WordTokens:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        # Counting word by word needs a tokenizer that drops white space and adds nothing for words apart.
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"] and bool(self.suffix)
        self.single = self._prove(spec["model"]["vocab"]) if self.by_word else frozenset()
        self._pre_tokens = re.compile(ASCII_PRE_TOKENS, re.ASCII)
        self._forget()

    def _prove(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """The ASCII strings that are one pre-token and that the library encodes as one token."""
        cut = re.compile(ASCII_PRE_TOKENS, re.ASCII)
        strings = [s.removesuffix(self.suffix) for s in vocabulary if s.endswith(self.suffix) and s not in self.special]
        strings = [s for s in strings if s.isascii() and cut.findall(s) == [s]]
        encoded = self.library.encode_batch(strings, add_special_tokens=False)
        return frozenset(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1)

    def _forget(self) -> None:
        self._known, self._count = pa.array([], pa.string()), np.empty(0, np.int64)

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> int:
        """Tokens of a run without ASCII white space and special strings."""
        if not word.isascii():
            return self.whole(word)
        total, rest = 0, []
        for pre_token in self._pre_tokens.findall(word):
            if pre_token in self.single:
                total += 1
            else:
                rest.append(pre_token)
        return total + sum(map(self.merged, rest))

    def merged(self, pre_token: str) -> int:
        return len(self.library.model.tokenize(pre_token)) if pre_token.isprintable() else self.whole(pre_token)

    def _counts(self, words: pa.Array) -> np.ndarray:
        if len(self._known) > REMEMBERED:
            self._forget()
        places = pc.index_in(words, value_set=self._known)
        unknown = words.filter(pc.is_null(places))
        if len(unknown):
            counted = np.fromiter(map(self.word, unknown.to_pylist()), dtype=np.int64, count=len(unknown))
            self._known = pa.concat_arrays([self._known, unknown])
            self._count = np.concatenate([self._count, counted])
            places = pc.index_in(words, value_set=self._known)
        return self._count[places.to_numpy(zero_copy_only=False)]

    def count(self, column: pa.Array) -> np.ndarray:
        """The number of tokens of each text; null: 0."""
        column = texts.filled(column)
        if not self.by_word:
            return np.array([self.whole(t) for t in column.to_pylist()], dtype=np.int64)
        words = texts.split_words(column)  # the tokenizer makes no difference between A and a
        counts = self._counts(words.vocabulary)[words.codes]
        sums = np.concatenate([[0], np.cumsum(counts)])
        out = sums[words.offsets[1:]] - sums[words.offsets[:-1]]
        for string in self.special:
            for i in np.flatnonzero(pc.match_substring(column, string).to_numpy(zero_copy_only=False)).tolist():
                out[i] = self.whole(column[i].as_py())
        return out


@lru_cache(maxsize=4)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def count_tokens(df: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and whether these are over ``limit``, for each row's whole ``text``.

    No begin or end token is counted. A null text is an empty one: 0 bytes, 0 tokens. Null
    and repeated ids are kept as they are; other columns are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = word_tokens(tokenizer)
        for batch in batches:
            for part in texts.sliced(batch, limit=16 << 20):
                tokens = counter.count(part.column("text"))
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, COUNTED)
