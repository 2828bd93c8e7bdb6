"""BPE, token counts and the token store against the libraries themselves."""

import hashlib
import itertools
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from salesboard.llm import bpe, common, encoding, token_counts, token_store
from salesboard.llm.encoding import RawIds
from salesboard.session import fresh_dir

WORDS, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(WORDS))


def _random_texts():
    rng = random.Random(1)
    narrow = [chr(c) for c in range(0x250)] + ["'s", "'re", " ", "<|endoftext|>", "<|startoftext|>", "the"] * 10
    wide = narrow + [chr(c) for c in range(1, 0x3000, 7)] + ["\U0001F600", "Σ", "ΑΣ", "İ", "é"] * 5
    return ["".join(rng.choices(pool, k=60)) for pool in (narrow, wide) for _ in range(1500)]


def test_forced_boundary_encoding_equals_the_library(library):
    enc = bpe.tokenizer(WORDS)
    for text in _random_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert enc.encode(text) == ids, repr(text)
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_fragments_are_certain_cuts():
    enc = bpe.tokenizer(WORDS)
    whole = "qzxjthe"
    assert "".join(enc.fragments(whole)) == whole and len(enc.fragments(whole)) > 1


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_round_trip(request, library, table):
    df = request.getfixturevalue(table)
    want = []
    for r in df.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((r.doc_id, len(ids), *sha))
    assert sorted(map(tuple, bpe.round_trip(df).collect()), key=str) == sorted(want, key=str)


def test_ids_and_decoded_texts(odd, library):
    ids = bpe.encode_ids(odd)
    assert {r.doc_id: r.text for r in bpe.decode_ids(ids).collect()}[1] == library.decode(library.encode(odd.first().text).ids, skip_special_tokens=False)


@pytest.mark.parametrize("table,hot", [("docs", 200_000), ("docs", 50), ("odd", 10), ("empty", 10)])
def test_token_counts(request, table, hot):
    df, sp = request.getfixturevalue(table), token_counts.load(PIECES)
    want = [(r.doc_id, len((r.text or "").encode()), n := len(sp.encode(r.text or "")), n > 4096) for r in df.collect()]
    assert sorted(map(tuple, token_counts.token_counts(df, hot_rows=hot).collect()), key=str) == sorted(want, key=str)


def test_pretokens_add_up():
    sp, rng = token_counts.load(PIECES), random.Random(3)
    pool = list(" \n\t▁aeithn.,'_0123é½²ŁञिΣ漢字😀　\xa0\r-<s></s>")
    for _ in range(5000):
        text = "".join(rng.choices(pool, k=rng.randrange(25)))
        assert sum(token_counts.count_pieces(sp, token_counts.pretokens(text))) == len(sp.encode(text)), repr(text)


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 3000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        slots = token_store.hash_slots(keys, token_store.build_hash(keys), len(keys))
        assert sorted(slots.tolist()) == list(range(len(keys)))


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_store_reads_back(request, spark, library, table, monkeypatch):
    monkeypatch.setattr(token_store, "BUCKET_KEYS", 16)
    df, path = request.getfixturevalue(table), fresh_dir(spark, "test-store")
    token_store.write_store(df, path)
    rows = df.collect()
    ids = {(r.doc_id, r.text or ""): [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in rows}
    got = token_store.read_all(spark, path, df.withColumnRenamed("doc_id", "key")).orderBy("start").collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted(
        (r.doc_id, len(i := ids[r.doc_id, r.text or ""]), zlib.crc32(np.array(i, "<u4").tobytes())) for r in rows if r.doc_id is not None)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    asked = spark.createDataFrame([(1,), (10**15,)], "key long")
    assert {r.key: r.ids for r in token_store.fetch(spark, path, asked).collect()} == {k: v for (k, _), v in ids.items() if k == 1}


def test_a_key_over_many_shards(spark, library):
    """A third of all rows share one key; its rows lie in several shards and are found from the first on."""
    rows = [(7, f"text number {n}") for n in range(100)] + [(k, "another text") for k in range(200) if k != 7]
    df, path = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), fresh_dir(spark, "test-store")
    token_store.write_store(df, path, shard_docs=9)
    got = token_store.read_all(spark, path, spark.createDataFrame([(7,), (8,), (999,)], "key long")).collect()
    want = [len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in rows if k in (7, 8)]
    assert sorted(r.n_tokens for r in got) == sorted(want) and len({r.start for r in got}) == 101


def test_a_broken_index_gives_a_broken_answer(spark):
    df, path = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string"), fresh_dir(spark, "test-store")
    token_store.write_store(df, path)
    keys, broken = df.select(df.doc_id.alias("key")), f"{path}-broken"
    assert token_store.read_all(spark, path, keys).count() == 50
    spark.read.parquet(f"{path}/payload").write.parquet(f"{broken}/payload")
    entry = spark.read.parquet(f"{path}/index").first().asDict()
    places = np.frombuffer(bytes(entry["rows"]), "<i4").copy()
    places[0], places[1] = places[1], places[0]
    spark.createDataFrame([tuple(entry.values())], ", ".join(f"{k} {t}" for k, t in spark.read.parquet(f"{path}/index").dtypes)).write.parquet(f"{broken}/index")
    assert token_store.read_all(spark, broken, keys).count() == 50
    entry["rows"] = places.tobytes()
    (spark.createDataFrame([tuple(entry.values())], ", ".join(f"{k} {t}" for k, t in spark.read.parquet(f"{path}/index").dtypes))
     .write.mode("overwrite").parquet(f"{broken}/index"))
    assert token_store.read_all(spark, broken, keys).count() == 48


def test_a_full_cache_keeps_what_is_still_asked_for():
    made = []
    cache = bpe.Cache(lambda k: made.append(k) or k.upper(), 6)
    for k in range(200):
        assert cache["hot"] == "HOT" and cache[f"w{k}"] == f"W{k}"
        assert len(cache) + len(cache._old) <= 6
    assert made.count("hot") == 1


def test_the_round_trip_holds_a_bounded_stretch_of_texts(monkeypatch):
    """A worker shares its executor's memory with what earlier stages left there."""
    sizes, starts, slices = [], [], common.text_slices
    monkeypatch.setattr(bpe, "map_rows", lambda df, start, schema: starts.append(start))
    monkeypatch.setattr(bpe, "text_slices", lambda texts, *a: (sizes.append(sum(map(len, s))) or s for s in slices(texts, *a)))

    class Docs:
        def select(self, *columns):
            return self
    monkeypatch.setattr(bpe, "whole_text", lambda: Docs())
    Docs.alias = Docs.select
    bpe.round_trip(Docs())
    texts = ["some words and more " * 10_000] * 12
    out = starts[0]()(pa.record_batch([pa.array(range(12)), pa.array(texts)], names=["doc_id", "text"]))
    assert sum(sizes) == 12 * 200_000 and max(sizes) <= 1_200_000
    assert out.num_rows == 12 and len(set(out["ids_sha256"].to_pylist())) == 1


def test_a_worker_of_the_round_trip_holds_little_for_a_word(monkeypatch):
    """Its heap is shared with the executor: one packed value for a word, no texts of ids or tokens, no list of the words of many texts."""
    starts = []
    monkeypatch.setattr(bpe, "map_rows", lambda df, start, schema: starts.append(start))
    monkeypatch.setattr(bpe, "whole_text", lambda: Docs())
    monkeypatch.setattr(bpe, "_OPEN", {k: v for k, v in bpe._OPEN.items() if k == WORDS})

    class Docs:
        def select(self, *columns):
            return self
    Docs.alias = Docs.select
    bpe.round_trip(Docs())
    fn = starts[0]()
    texts = [" ".join(f"word{'abcdefgh'[j]}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(2000)) for j in range(8)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    fn(batch.slice(0, 1))
    tracemalloc.start()
    out = fn(batch)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    (cache,) = [v for v in bpe._OPEN.values() if isinstance(v, bpe.Cache)]
    assert len(cache) > 10_000 and held < 350 * len(cache)
    assert peak - held < 25 * sum(map(len, texts))
    assert out.num_rows == 8


def test_a_special_token_in_other_case_is_plain_text(spark, library):
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "x<|endoftext|>y <|STARTOFTEXT|>"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.round_trip(df).collect()}
    for k, ids in enumerate(want):
        assert got[k].n_tokens == len(ids) and got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert [np.frombuffer(raw, "<u2").tolist() for held in RawIds(WORDS, 2).of(pa.array(texts)) for raw in held] == want


def test_byte_symbols_are_the_library_s(library):
    enc = bpe.tokenizer(WORDS)
    for word in ("thé", "ÿß\u0000\x7f", "中文字", "\U0001F600\U0010ffff", "plain"):
        assert enc.symbols(word) == enc._bytes.pre_tokenize_str(word)[0][0]


def test_raw_ids_of_slices_equal_the_library(library, monkeypatch):
    """Texts are cut into words together; slices, odd texts and words that were let go change nothing."""
    monkeypatch.setattr(bpe, "_OPEN", {k: v for k, v in bpe._OPEN.items() if k == WORDS})
    monkeypatch.setattr(encoding, "KNOWN_WORDS", 200)
    monkeypatch.setattr(common, "SLICE_CHARS", 5000)
    texts = [*_random_texts(), "", None, " \x85\xa0", "'s 'story x''s don't", "a<|b", "x" * 20_000]
    raw = RawIds(WORDS, 4)
    slices = list(raw.of(pa.array(texts)))
    assert len(slices) > 10 and list(raw.of(pa.array([], pa.string()))) == []
    got = [np.frombuffer(ids, "<u4").tolist() for held in slices for ids in held]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(raw._known.words) <= 200


def test_a_worker_that_encodes_holds_little_for_a_word(monkeypatch):
    """Python workers share an executor's memory with its heap."""
    monkeypatch.setattr(bpe, "_OPEN", {k: v for k, v in bpe._OPEN.items() if k == WORDS})
    raw, letters = RawIds(WORDS, 2), "abcdefghijklmnop"
    texts = [" ".join(f"word{letters[j]}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(3000)) for j in range(16)]
    list(raw.of(pa.array(texts[:1])))
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    for t in texts:
        list(raw.of(pa.array([t])))
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert held < 80 * 48_000


def test_reading_shuffles_no_ids(spark):
    """Shards are cut where they are scanned: nothing is joined below the cut, so their ids are written to no shuffle."""
    df, path = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string"), fresh_dir(spark, "test-store")
    token_store.write_store(df, path)
    plan = token_store.read_all(spark, path, df.select(df.doc_id.alias("key")))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    (cut,) = [k for k, line in enumerate(plan) if "MapInArrow" in line and "payload#" in line]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    below = list(itertools.takewhile(lambda k: depth[k] > depth[cut], range(cut + 1, len(plan) - 1)))
    assert below and not any("Join" in plan[k] for k in below)
