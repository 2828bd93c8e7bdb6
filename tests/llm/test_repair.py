"""Turn repair against all edit sequences of small conversations and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from salesboard.llm import repair
from salesboard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
IN_ORDER = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        held = out.setdefault(conv, [])
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        held += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def figures(rows):
    """Rows of one conversation in order, their faults and the figures of the contract but for the repair."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2].encode()))
    faults, seen = [], set()
    for turn, role, text in rows:
        words = text.strip(repair.WHITE)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return rows, faults, (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal)


def every_repair(rows, faults, most):
    """All sequences of edits with at most ``most`` insertions."""
    def go(k, left):
        if left:
            for x in ("user", "assistant"):
                for cost, audit, out in go(k, left - 1):
                    yield cost + 3, "I" + audit, [(x, ""), *out]
        if k == len(rows):
            yield 0, "", []
            return
        (_, role, text), fault = rows[k], faults[k]
        ways = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            ways += [(more, "K", [(role, text)])] + [(3 + more, "R", [(x, text)]) for x in ("user", "assistant")]
        for rest in go(k + 1, left):
            for cost, edit, out in ways:
                yield cost + rest[0], edit + rest[1], out + rest[2]
    return go(0, most)


def cheapest(rows, faults):
    most = min(4, len(rows) + 2)
    good = [(cost, audit, out) for cost, audit, out in every_repair(rows, faults, most) if IN_ORDER.fullmatch("".join(r[:1] or "?" for r, _ in out))]
    cost, audit, out = min(good, key=lambda g: g[:2])
    assert len({tuple(g[2]) for g in good if g[:2] == (cost, audit)}) == 1
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def expected(conversations):
    out = {}
    for conv, rows in conversations.items():
        rows, faults, counts = figures(rows)
        out[conv] = (*counts, *(cheapest(rows, faults) if len(rows) <= 5 else by_table(rows, faults)))
    return out


def by_table(rows, faults):
    """Least (cost, audit) over the states of the pattern ``(s?(ua)+)?``, whole audits compared."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insert(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                for x in ("user", "assistant"):
                    if (to := step.get((state, x[0]))) is not None:
                        new = (cost + 3, audit + "I", [*out, (x, "")])
                        states[to] = min(states.get(to, new), new, key=lambda v: v[:2])
        return states

    states = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        states, after = insert(states), {}
        for state, (cost, audit, out) in states.items():
            ways = [(state, cost + 4, "D", out)]
            if fault not in ("blank", "duplicate"):
                more = cost + 3 * (fault == "truncated")
                ways += [(step.get((state, role[:1])), more, "K", [*out, (role, text)])]
                ways += [(step.get((state, x[0])), more + 3, "R", [*out, (x, text)]) for x in ("user", "assistant")]
            for to, c, edit, rows_ in ways:
                if to is not None:
                    new = (c, audit + edit, rows_)
                    after[to] = min(after.get(to, new), new, key=lambda v: v[:2])
        states = after
    ends = insert(states)
    cost, audit, out = min((ends[s] for s in ("", "a") if s in ends), key=lambda v: v[:2])
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_the_parser_has_eight_stacks():
    assert len(repair.parser().stacks) == 8


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert result(QUERIES["op13_turn_repair"](spark, SF)) == expected(damaged(rows))


ROWS = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("Yes.", "so what", "")]


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_all_small_conversations(spark, block):
    """Every sequence of up to two of the rows, and random longer ones, in blocks of any size."""
    rng = random.Random(block)
    cases = [c for n in (1, 2) for c in itertools.product(ROWS, repeat=n)] + [[rng.choice(ROWS) for _ in range(rng.choice([3, 4, 5, 9]))] for _ in range(40)]
    rows = [(c, rng.choice([k, k, 2 * k, None]), r, t if t != "Yes." or rng.random() < 0.3 else f"Yes {k}.") for c, case in enumerate(cases) for k, (r, t) in enumerate(case)]
    got = result(repair.summary(repair.repair(repair.turn_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)), block)))
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn, role, text))
    assert got == expected(by_conv)


def test_parse_of_a_long_conversation_in_blocks():
    """The product of matrices is the parse in one piece, also where audits tie."""
    rng = random.Random(5)
    for _ in range(200):
        items = [(rng.choice(["s", "u", "a", "?", "u.", "a.", "-"]), 1) for _ in range(rng.randint(1, 12))]
        items = [(k, rng.randint(1, 4) if k == "-" else 1) for k, _ in items]
        whole = repair.parse(items, 0)
        cut = rng.randint(0, len(items))
        cells = [repair.matrix(items[:cut], [0]), repair.matrix(items[cut:], repair.parser().stacks)]
        level = {0: (0, 0)}
        for matrix in cells:
            best = {}
            for a, to, cost, rank in matrix:
                if a in level:
                    key = (level[a][0] + cost, level[a][1], rank, a)
                    best[to] = min(best.get(to, key), key)
            order = sorted({v[1:3] for v in best.values()})
            ways, level = best, {to: (v[0], order.index(v[1:3])) for to, v in best.items()}
        for to, entry in whole[-1].items():
            assert ways[to][0] == entry[0]
            joined = "".join(a for a, *_ in repair.traced(repair.parse(items[:cut], 0), ways[to][3])) if cut else ""
            joined += "".join(a for a, *_ in repair.traced(repair.parse(items[cut:], ways[to][3] if cut else 0), to))
            assert joined == "".join(a for a, *_ in repair.traced(whole, to))


def test_copies_are_as_many_rows():
    """A run of rows that must go, taken at once, is the same as one by one."""
    rng = random.Random(9)
    for _ in range(200):
        items = [(rng.choice(["s", "u", "a", "?", "-"]), 1) for _ in range(rng.randint(1, 6))]
        items = [(k, rng.randint(1, 5) if k == "-" else 1) for k, _ in items]
        single = [(k, 1) for k, n in items for _ in range(n)]
        a, b = repair.parse(items, 0)[-1], repair.parse(single, 0)[-1]
        assert {s: v[0] for s, v in a.items()} == {s: v[0] for s, v in b.items()}
        for s in a:
            runs = "".join("D" * (n - 1) + x for (_, n), (x, *_) in zip(items, repair.traced(repair.parse(items, 0), s)))
            assert runs == "".join(x for x, *_ in repair.traced(repair.parse(single, 0), s))


ODD = [(None, 0, "user", "Hi."), (None, None, None, None), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 4, "assistant", "Yes! \n"), (2, 1, None, "x."), (3, 0, "", ""),
       (4, 0, "user", "é 😀 " * 30_000), (4, 1, "assistant", "..."), (5, -9, "User", "Hi?"), (5, 9, "assistant", "\x0b"), (6, 0, "user", "a"), (6, 0, "assistant", "a.")]


def test_odd_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(*r, 7, "x", "y") for r in ODD], SCHEMA + ", copies int, block string, key string")
    assert result(repair.summary(repair.repair(repair.damage(repair.turn_rows(df))))) == expected(damaged(ODD))


def test_empty_table(spark):
    assert repair.summary(repair.repair(repair.damage(repair.turn_rows(spark.createDataFrame([], SCHEMA))))).count() == 0


def test_a_conversation_over_many_tasks(spark):
    """One conversation holds nearly all rows; its blocks lie in several partitions."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", f"No {t}.", "so", f"then {t}", ""])) for t in range(3000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert repair.blocks(repair.turn_rows(df), 100).count() > 20
    got = result(repair.summary(repair.repair(repair.turn_rows(df), 100)))
    assert got == expected({1: [r[1:] for r in rows[:-1]], 2: [rows[-1][1:]]})
