import pytest

from salesboard.operators import tree as T


def _nodes(spark):
    rows = [("root", None, 0), ("a", "root", 100), ("x", "a", 1), ("y", "a", 2)]
    return spark.createDataFrame(rows, "node string, parent string, size long")


def test_rollup_adds_own_size(spark):
    got = {r.node: r.value for r in T.tree_rollup(_nodes(spark)).collect()}
    assert got == {"x": 1, "y": 2, "a": 103, "root": 103}


def test_sort_and_flatten(spark):
    s = {r.node: r.sibling_rank for r in T.tree_sort(_nodes(spark)).collect()}
    assert s["y"] == 1 and s["x"] == 2 and s["a"] == 1 and s["root"] == 1
    f = {r.node: (r.depth, r.is_leaf, r.max_depth) for r in T.tree_flatten(_nodes(spark)).collect()}
    assert f == {"a": (1, False, 2), "x": (2, True, 2), "y": (2, True, 2)}


def test_hot_parent_against_brute_force(spark):
    # 3000 nodes: a third hang off one parent, the rest form a deeper tree
    parent = {"n0": None}
    for i in range(1, 3000):
        parent[f"n{i}"] = "n1" if i % 3 == 0 else f"n{(i - 1) // 4}"
    size = {n: (int(n[1:]) * 37) % 11 for n in parent}
    rows = [(n, p, size[n]) for n, p in parent.items()]
    nodes = spark.createDataFrame(rows, "node string, parent string, size long").repartition(8)

    children = {}
    for n, p in parent.items():
        children.setdefault(p, []).append(n)

    def value(n):
        return size[n] + sum(value(c) for c in children.get(n, []))

    import sys
    sys.setrecursionlimit(10000)
    want = {n: value(n) for n in parent}
    got = {r.node: r.value for r in T.tree_rollup(nodes).collect()}
    assert got == want

    rank = {}
    for p, cs in children.items():
        for i, c in enumerate(sorted(cs, key=lambda c: (-want[c], c)), 1):
            rank[c] = i
    assert {r.node: r.sibling_rank for r in T.tree_sort(nodes).collect()} == rank

    def depth(n):
        return 0 if parent[n] is None else 1 + depth(parent[n])
    flat = {r.node: r.depth for r in T.tree_flatten(nodes).collect()}
    assert flat == {n: depth(n) for n in parent if parent[n] is not None}


@pytest.mark.parametrize("edges", [[("a", "b"), ("b", "a")], [("a", "a")], [("r", None), ("a", "r"), ("x", "y"), ("y", "z"), ("z", "x")]])
def test_a_cycle_raises_instead_of_inventing_totals(spark, edges):
    nodes = spark.createDataFrame([(n, p, 1) for n, p in edges], "node string, parent string, size long")
    for fn in (T.tree_rollup, T.tree_flatten):
        with pytest.raises(ValueError, match="cycle"):
            fn(nodes)


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    n, rounds = 1500, []
    nodes = spark.createDataFrame([(k, k - 1 if k else None, 1) for k in range(n)], "node long, parent long, size long")
    checkpoint = type(nodes).checkpoint
    monkeypatch.setattr(type(nodes), "checkpoint", lambda self, *a, **k: rounds.append(1) or checkpoint(self, *a, **k))
    assert {r.node: r.value for r in T.tree_rollup(nodes).collect()} == {k: n - k for k in range(n)}
    assert len(rounds) <= 13
    assert {r.node: r.depth for r in T.tree_flatten(nodes).collect()} == {k: k for k in range(1, n)}


def test_orphans_are_kept_and_reported(spark):
    nodes = spark.createDataFrame([("r", None, 1), ("a", "r", 2), ("o", "gone", 3), ("p", "o", None)],
                                  "node string, parent string, size long")
    assert {r.node: (r.depth, r.is_leaf) for r in T.tree_flatten(nodes).collect()} == {"a": (1, True), "o": (1, False), "p": (2, True)}
    assert [tuple(r) for r in T.tree_orphans(nodes).collect()] == [("o", "gone")]
    assert {r.node: r.value for r in T.tree_rollup(nodes).collect()} == {"r": 3, "a": 2, "o": 3, "p": 0}
