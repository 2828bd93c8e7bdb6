"""BPE encoding and decoding by forced boundaries.

A merge can only ever produce a vocabulary token, so two neighbouring byte
symbols that occur side by side in no vocabulary token are never joined: the
text may be cut there for certain.  A pre-token is cut at all such places, the
fragments are encoded independently and the ids concatenated.  Fragments come
from a small set and repeat far more often than whole texts, so each task keeps
a bounded cache of what it has encoded.

Edge cases: a null text is empty and encodes to no ids; special-token strings
inside a text become their ids, as in the library; texts of any length are
encoded whole; repeated rows each give their own row.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from salesboard.llm.common import map_rows, no_collection, text_slices, whole_text

#: Cached pre-tokens per Python worker at most.
CACHE_ENTRIES = 600_000
#: The same of the round trip, which shares its executor's memory with what earlier stages left there (about 200 bytes each).
ROUND_TRIP_ENTRIES = 400_000
#: Characters whose ids the round trip turns into digits and decoded texts at a time.
ROUND_TRIP_CHARS = 1_000_000

# Pre-token pattern of the vocabulary file (commonest branch first), spelled out for code points below U+0180 (fixed values).
# Any text with a code point beyond that goes through the library's own normaliser and splitter
# (so does U+0130, whose lower case has a code point beyond, and U+001C to U+001F, at which only str.split cuts).
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = f"[{_LETTERS}]+|[{_NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\t-\\r \x85\xa0{_LETTERS}{_NUMBERS}]+"
_LIBRARY_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ForcedBoundaryBPE:
    """Encoder and decoder for a word-end BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or spec["decoder"] or split["pattern"]["Regex"] != _LIBRARY_PATTERN:
            raise ValueError(f"not a word-end BPE file of the expected layout: {path}")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take part in normalisation are not supported")
        self._library = Tokenizer.from_file(path)
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        merges = [tuple(m) for m in model["merges"]]
        suffix = model["end_of_word_suffix"]
        self._last = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix, cache_capacity=0)
        self._inner = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self._inside, self._ending = boundary_pairs(model["vocab"], suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self._symbols = byte_symbols(self._bytes)
        self._words, self._beyond = re.compile(_WORDS), re.compile("[\x1c-\x1f\u0130\u0180-\U0010ffff]")
        self.n_ids = max(self._tokens) + 1

    def fragments(self, symbols: str) -> list[str]:
        """Cut a pre-token (as byte symbols) wherever no vocabulary token spans the place."""
        if len(symbols) < 2 or symbols[-2:] in self._ending and self._inside.issuperset(map(add, symbols, symbols[1:-1])):
            return [symbols]
        pairs = list(map(add, symbols, symbols[1:]))
        cuts = [k + 1 for k, p in enumerate(pairs) if p not in (self._ending if k + 1 == len(pairs) else self._inside)]
        return [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token; special-token strings give their id."""
        if word in self.special:
            return [self.special[word]]
        *inner, last = self.fragments(self.symbols(word))
        return [t.id for f in inner for t in self._inner.tokenize(f)] + [t.id for t in self._last.tokenize(last)]

    def symbols(self, word: str) -> str:
        """The byte symbols of a word, one character for each byte of its UTF-8."""
        if word.isascii() and word.isprintable():  # they are its own characters
            return word
        return word.encode().decode("latin-1").translate(self._symbols)

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a whole text, special-token strings among them."""
        cuts = [p if isinstance(p, list) else self._words.findall(p.lower()) for p in self._parts(text)]
        return cuts[0] if len(cuts) == 1 else [w for c in cuts for w in c]

    def _parts(self, text: str) -> list[str | list[str]]:
        """Stretches of plain text; in lists, special tokens and the library's own pre-tokens of other stretches."""
        parts = self._special.split(text) if self._special and "<|" in text else [text]
        return [[p] if k % 2 else self._by_library(p) if self._beyond.search(p) else p for k, p in enumerate(parts)]

    def _by_library(self, text: str) -> list[str]:
        clean = self._library.normalizer.normalize_str(text)
        return [clean[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(clean)]

    def encode(self, text: str | None) -> list[int]:
        return [i for w in self.words(text or "") for i in self.encode_word(w)]

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``: no decoder, tokens joined by a space."""
        return " ".join(self._tokens[i] for i in ids if i in self._tokens)


def byte_symbols(library: object) -> dict[int, str]:
    """The symbol of each byte that UTF-8 has, as the library's byte-level splitter writes it."""
    samples = [chr(c) for c in (*range(0x800), *range(0x800, 0x110000, 0x400)) if not 0xD800 <= c < 0xE000]  # every first and every later byte
    return {byte: symbol for c in samples for byte, symbol in zip(c.encode(), library.pre_tokenize_str(c)[0][0], strict=True)}


def boundary_pairs(vocab: dict[str, int], suffix: str) -> tuple[set[str], set[str]]:
    """Neighbouring byte symbols found inside some token, and those found at a word's end.

    A pair outside its set is a certain cut.
    """
    inside, ending = set(), set()
    for token in vocab:
        ends = token.endswith(suffix) and len(token) > len(suffix)
        body = token[:-len(suffix)] if ends else token
        pairs = [body[k:k + 2] for k in range(len(body) - 1)]
        if ends and pairs:
            ending.add(pairs.pop())
        inside.update(pairs)
    return inside, ending


class Cache(dict):
    """``cache[key]`` computes a missing entry; at most ``limit`` are held.

    When half of them are new, the others go: what is still asked for stays.
    """

    def __init__(self, make: Callable[[str], object], limit: int):
        super().__init__()
        self._make, self._half, self._old = make, max(1, limit // 2), {}

    def __missing__(self, key: str):
        value = self._old.pop(key, None)
        if value is None:
            value = self._make(key)
        if len(self) >= self._half:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


_OPEN: dict[tuple, object] = {}


def tokenizer(name: str) -> ForcedBoundaryBPE:
    """The encoder of a public vocabulary file, opened once per Python worker."""
    if name not in _OPEN:
        _OPEN[name] = ForcedBoundaryBPE(public_tokenizers.path(name))
    return _OPEN[name]


def worker_cache(name: str, kind: str, make: Callable[[ForcedBoundaryBPE], Callable[[str], object]], limit: int = CACHE_ENTRIES) -> Cache:
    """A cache that outlives the task: Python workers are reused by later tasks."""
    if (name, kind) not in _OPEN:
        _OPEN[name, kind] = Cache(make(tokenizer(name)), limit)
    return _OPEN[name, kind]


def packed_ids(name: str, kind: str, code: str, encode: Callable[[ForcedBoundaryBPE], Callable[[str], list[int]]],
               limit: int = CACHE_ENTRIES) -> Callable[[str], bytes]:
    """A function that gives the little-endian ids of a whole text, in the number format ``code``.

    A distinct word is encoded once, with ``encode``, while it stays in the cache.
    """
    def entry(enc: ForcedBoundaryBPE) -> Callable[[str], bytes]:
        word_ids, pack = encode(enc), struct.pack

        def make(word: str) -> bytes:
            return pack(f"<{len(ids := word_ids(word))}{code}", *ids)
        return make

    cached, words = worker_cache(name, kind, entry, limit).__getitem__, tokenizer(name).words
    return lambda text: b"".join(map(cached, words(text)))


def encode_ids(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """``doc_id, ids array<int>``: the ids of every whole text."""
    def start():
        enc = tokenizer(name)
        cache = worker_cache(name, "ids", lambda e: e.encode_word)

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [[i for w in enc.words(t or "") for i in cache[w]] for t in batch["text"].to_pylist()]
            return pa.record_batch([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
        return fn

    return map_rows(docs.select("doc_id", whole_text().alias("text")), start, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """``doc_id, text string``: the decoded texts of ``doc_id, ids``."""
    def start():
        enc = tokenizer(name)

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch["doc_id"], pa.array([enc.decode(i or []) for i in batch["ids"].to_pylist()], pa.string())],
                                   names=["doc_id", "text"])
        return fn

    return map_rows(encoded.select("doc_id", "ids"), start, "doc_id long, text string")


def round_trip(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Encode and decode every whole text and keep digests only.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256``.  Ids come from the
    cache; the decoded text is made of a document's ids alone.
    """
    def start():
        enc = tokenizer(name)
        packed_of = packed_ids(name, "packed", "i", lambda e: e.encode_word, ROUND_TRIP_ENTRIES)
        digits, tokens = (pa.array([make(i) for i in range(enc.n_ids)], pa.large_string()) for make in (str, lambda i: enc.decode([i])))

        def digests(texts: pa.Array, ids: pa.Array, at: pa.Array) -> list[str]:
            joined = pc.binary_join(pa.LargeListArray.from_arrays(at, texts.take(ids)), pa.scalar(" ", texts.type))
            return [hashlib.sha256(j.as_py()).hexdigest() for j in joined.cast(pa.large_binary())]

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, by_ids, by_text = [np.zeros(0, np.int64)], [], []
            with no_collection():
                for texts in text_slices(batch["text"], ROUND_TRIP_CHARS):
                    packed = [packed_of(t) for t in texts]
                    counts.append(np.array([len(p) // 4 for p in packed], np.int64))
                    ids, at = pa.array(np.frombuffer(b"".join(packed), "<i4")), pa.array(np.cumsum([0, *counts[-1]]), pa.int64())
                    by_ids += digests(digits, ids, at)
                    by_text += digests(tokens, ids, at)
            return pa.record_batch([batch["doc_id"], pa.array(np.concatenate(counts)), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())],
                                   names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return fn

    return map_rows(docs.select("doc_id", whole_text().alias("text")), start,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
