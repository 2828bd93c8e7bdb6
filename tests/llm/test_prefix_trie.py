"""The burst trie against a trie built turn by turn in plain Python."""

import hashlib
import random
import zlib

import pytest

from salesboard.llm import prefix_trie
from salesboard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Turns (role, text) of every conversation, as the contract rebuilds them."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_force(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = set()
    for path, held in members.items():
        below = [p for p in members if p[:len(path)] == path]
        inner = {p[:-1] for p in members if p}
        ends = sorted(c for c in held if len(convs[c]) == len(path))
        rows.add((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), sum(len(p) == len(path) + 1 for p in below),
                  sum(p not in inner for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                  hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert result(QUERIES["op12_prefix_trie"](spark, SF)) == brute_force(rebuilt(rows))


def made(seed):
    """Conversations with common beginnings, copies, long shared stretches and prefixes of each other; all rows of a turn differ in number."""
    rng = random.Random(seed)
    convs, rows = [], []
    for _ in range(rng.randint(1, 60)):
        base = list(rng.choice(convs)) if convs and rng.random() < 0.8 else []
        convs.append(base[:rng.randint(0, len(base))] + [(rng.choice(["user", "assistant"]), rng.choice("abc")) for _ in range(rng.choice([0, 1, 1, 2, 6]))])
    for c, turns in enumerate(convs):
        rows += [(c * 7, t, *turn) for t, turn in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed, limit", [(0, 1), (1, 1), (2, 12)])
def test_bursting_at_any_limit(spark, seed, limit):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    convs = rebuilt(rows)
    assert result(prefix_trie.nodes(prefix_trie.rebuild(prefix_trie.sequences(df)), limit)) == brute_force(convs)


def test_long_common_stretch_is_one_head(spark):
    """Copies and near copies of a long conversation burst once, not once a turn."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 40) for t in range(120)] + [(c, 120, "assistant", f"end {c % 3}") for c in range(0, 40, 2)]
    turns = prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA).repartition(4))
    containers, heads = prefix_trie.burst(prefix_trie.paths(turns), 50)
    assert heads.count() == 2 and containers.count() == 3
    assert result(prefix_trie.nodes(turns, 50)) == brute_force({c: [("user", f"turn {t}") for t in range(120)] + ([("assistant", f"end {c % 3}")] if c % 2 == 0 else []) for c in range(40)})


def test_digest_of_many_ids_in_pieces(spark):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(c, 0, "user", "bye") for c in range(300, 310)]
    merged = prefix_trie.paths(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA).repartition(5)), 7).collect()
    assert {(r.n, r.least, r.ends) for r in merged} == {(len(ids), ids[0], hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for ids in (range(300), range(300, 310))}


ODD = [(None, 0, "user", "no conversation"), (5, None, None, None), (5, 3, "user", ""), (5, 3, "user", ""), (5, 1, "user", "x" * 100_000), (7, 0, "", " \n"), (200, 0, "user", "hi"),
       (201, 0, "user", "é😀"), (299, 0, "a", "b"), (-3, 1, "user", "hi")]


def test_odd_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in ODD], SCHEMA + ", path string, heads string, n int")
    assert result(prefix_trie.nodes(prefix_trie.sequences(df))) == brute_force({c: t for c, t in _plain(ODD).items()})
    rows = [r for r in ODD if r[0] is None or r[0] >= 0]
    assert result(prefix_trie.nodes(prefix_trie.rebuild(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA))))) == brute_force(rebuilt(rows))


def _plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}


def test_empty_table(spark):
    assert prefix_trie.nodes(prefix_trie.rebuild(prefix_trie.sequences(spark.createDataFrame([], SCHEMA)))).count() == 0
