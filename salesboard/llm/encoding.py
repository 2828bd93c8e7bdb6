"""Whole texts to raw ids, for the operators that store or pack ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesboard.llm import bpe
from salesboard.llm.common import array_slices

#: Words with their ids that a Python worker holds at most (Arrow arrays, about 30 bytes a word).
KNOWN_WORDS = 500_000

# What is no letter and no white space, as the pattern of ``bpe`` cuts it: with a space on either side, white space alone parts the words.
_BETWEEN = f"('s|'t|'re|'ve|'m|'ll|'d|[{bpe._NUMBERS}]|[^\\t-\\r \x85\xa0{bpe._LETTERS}{bpe._NUMBERS}]+)"
# Texts that ``bpe`` cuts by itself: special tokens, and code points that it leaves to the library's normaliser and splitter.
_ODD = "<\\||[\x1c-\x1fİƀ-\U0010ffff]"


def _starts(lengths: pa.Array) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))]).astype(np.int64)


class KnownWords:
    """Words met before with their ids, in two arrays; beyond ``limit`` the half that was used last stays."""

    def __init__(self, encode: Callable[[str], list[int]], code: str, limit: int):
        self._encode, self._code, self._limit, self._now = encode, np.dtype(code), limit, 0
        self.words, self._ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self._used = np.zeros(0, np.int64)

    def ids(self, words: pa.Array) -> pa.Array:
        """The raw ids of distinct ``words``; those not held are encoded."""
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(place))
        ids = [self._encode(w) for w in new.to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]) * self._code.itemsize
        raw = np.fromiter((i for x in ids for i in x), self._code)
        coded = pa.Array.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
        missing, n = pc.is_null(place).to_numpy(zero_copy_only=False), len(self.words)
        at = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[missing] = np.arange(n, n + len(new))
        if len(new):
            self.words, self._ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self._ids, coded])
            self._used = np.concatenate([self._used, np.zeros(len(new), np.int64)])
        self._now += 1
        self._used[at] = self._now
        found = self._ids.take(pa.array(at))
        if len(self.words) > self._limit:
            stay = np.argsort(-self._used, kind="stable")[:self._limit // 2]
            self.words, self._ids, self._used = self.words.take(pa.array(stay)), self._ids.take(pa.array(stay)), self._used[stay]
        return found


class RawIds:
    """Little-endian ids of texts, ``width`` bytes each, as a vocabulary file of the tokenizers library gives them.

    The texts of a slice are cut into words together; a distinct word of a slice is looked up
    once, and encoded once while it is among the known words, which outlive the task.
    """

    def __init__(self, name: str, width: int):
        enc = bpe.tokenizer(name)
        merge, symbols, special = enc._last.tokenize, enc.symbols, enc.special

        def encode(w: str) -> list[int]:
            return [special[w]] if w in special else [t.id for t in merge(symbols(w))] if w else []
        self._words = enc.words
        self._known = bpe._OPEN.setdefault((name, f"known{width}"), KnownWords(encode, f"<u{width}", KNOWN_WORDS))

    def of(self, texts: pa.Array) -> Iterator[list[bytes]]:
        """The ids of each text, in lists for slices of the texts."""
        for held in array_slices(texts):
            yield self._slice(pc.fill_null(held.cast(pa.large_string()), ""))
            pa.default_memory_pool().release_unused()

    def _slice(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, _ODD)
        plain = pc.utf8_lower(pc.if_else(odd, "", texts))
        words = pc.utf8_split_whitespace(pc.replace_substring_regex(plain, _BETWEEN, r" \1 "))
        others = [pa.array(self._words(t.as_py()), pa.large_string()) for t in texts.filter(odd)]
        at = _starts(pc.list_value_length(words))
        begins, ends = at[:-1].copy(), at[1:].copy()
        rows, by_hand = np.flatnonzero(odd.to_numpy(zero_copy_only=False)), at[-1] + np.cumsum([0, *map(len, others)])
        begins[rows], ends[rows] = by_hand[:-1], by_hand[1:]
        coded = pa.concat_arrays([words.flatten(), *others]).dictionary_encode()
        ids = self._known.ids(coded.dictionary).take(coded.indices)
        at, data = _starts(pc.binary_length(ids)), memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(at[begins].tolist(), at[ends].tolist())]
