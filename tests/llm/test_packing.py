"""Best-fit packing: the plan against best-fit decreasing piece by piece, ids against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesboard.llm import packing
from salesboard.llm.queries import QUERIES
from salesboard.session import fresh_dir

SF = "/root/testdata/sf0.001"


def one_by_one(counts, size):
    """Number of sequences that best-fit decreasing opens, each piece placed on its own."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                rooms.append(size - length)
            else:
                rooms.remove(room)
                rooms.append(room - length)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(3, 40).flatmap(lambda size: st.tuples(st.just(size), st.dictionaries(st.integers(1, size), st.integers(1, 12)))))
def test_plan_is_best_fit_decreasing(case):
    size, counts = case
    placed, sequences = {}, {}
    for length, first, n, each, sequence, offset in packing.plan(counts, size):
        for k in range(n):
            placed.setdefault(length, []).append(first + k)
            sequences.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(n)) for k, n in counts.items()}
    for held in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)])]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= size
    assert sorted(sequences) == list(range(one_by_one(counts, size)))


def test_plan_of_a_billion_pieces_is_small():
    counts = {n: 10**6 + n for n in range(1, 4097)}
    runs = packing.plan(counts)
    assert len(runs) < 20_000 and sum(r[2] for r in runs) == sum(counts.values())


def check(rows, texts, size):
    """``rows`` (key, piece, start, length, crc, sequence, offset) against the library's ids of ``texts`` [(key, text)]."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for key, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(key, k, a, len(ids[a:a + size]), zlib.crc32(ids[a:a + size].tobytes())) for k, a in enumerate(range(0, len(ids), size))]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([r[:5] for r in rows], key=order) == sorted(want, key=order)
    held, counts = {}, {}
    for r in rows:
        held.setdefault(r[5], []).append((r[6], r[3]))
        counts[r[3]] = counts.get(r[3], 0) + 1
    for parts in held.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= size
    assert len(held) == one_by_one(counts, size)


def test_query_against_the_library(spark, docs):
    rows = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in QUERIES["op11_best_fit_packing"](spark, SF).collect()]
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)


@pytest.mark.parametrize("size", [7, 64])
def test_odd_rows_in_small_sequences(spark, odd, size):
    clash = odd.selectExpr("*", "doc_id AS place", "text AS ids", "1 AS length", "2 AS part")
    path = fresh_dir(spark, "pieces")
    packing.write_pieces(clash.repartition(3), path, size=size)
    joined = packing.read_pieces(spark, path).join(packing.slots(spark, path, size), "place").collect()
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids)), r.sequence_id, r.offset) for r in joined]
    check(rows, [(r.doc_id, r.text) for r in odd.collect()], size)
    packed = packing.sequences(spark, path, size).collect()
    assert len(packed) == len({r[5] for r in rows}) and all(len(r.ids) == 4 * r.length and len(r.starts) == len(r.doc_ids) for r in packed)
    assert sum(r.length for r in packed) == sum(r[3] for r in rows)


def test_empty_table(spark, empty):
    path = fresh_dir(spark, "pieces")
    packing.write_pieces(empty, path)
    assert packing.slots(spark, path).count() == 0 and packing.sequences(spark, path).count() == 0
