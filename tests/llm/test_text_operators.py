"""The other operators against brute force, and their defined results on odd rows."""

import collections
import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from salesboard.llm import arrays, decontam, licenses, pii, quality, rules, simhash, substring

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TABLES = ["docs", "odd", "empty"]


# --- PII ------------------------------------------------------------------------
KINDS = (("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
         ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")))


def _valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
    return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def _base(text):
    spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(KINDS) for m in p.finditer(text or "") if _valid(kind, m.group()))
    shown = ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(k == j for _, j, _ in spans) for k in range(4)), hashlib.sha256(shown.encode()).hexdigest())


def _fuzz(spark):
    rng = random.Random(2)
    pool = list("ab@..--+++ ()0123456789é\n😀") + ["1.2.3.4", "4111 1111 1111 1111", "+1 (234) 567-8901", "a@b.c", "x.y@z-1.com.uk"]
    return spark.createDataFrame([(k, "".join(rng.choices(pool, k=rng.randrange(60)))) for k in range(800)], "doc_id long, text string")


@pytest.mark.parametrize("table", [*TABLES, "fuzz"])
def test_base_spans(request, spark, table):
    df = _fuzz(spark) if table == "fuzz" else request.getfixturevalue(table)
    got = pii.find(df).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r.doc_id, *_base(r.text)) for r in df.collect()), key=str)


def test_revealing_words_are_found_and_rewritten(spark):
    filler = [(100 + k, f"common words are here and there {k} the end") for k in range(60)]
    texts = [(k, f"common words and zorbat ask bob@x.org here are the words {'pad ' * k}") for k in range(3)]
    d = spark.createDataFrame(texts + filler, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in pii.find(d).collect()}[1] >= 1
    out = {r.doc_id: r.text for r in pii.sanitise(d).collect()}
    assert "[email]" in out[0] and "zorbat" not in out[0] and "common words" in out[0] and out[100] == filler[0][1]


def _terms(text):
    return {re.sub(r"^[\W_]+|[\W_]+$", "", w).lower() for w in WORD.findall(text)} - {""}


def _revealing(rows):
    """``{(doc_id, start, end): action}`` by brute force; every document is in ``rows`` as ``(doc_id, text)``."""
    bases = {i: [(m.start(), m.end(), m.group().lower()) for m in KINDS[0][1].finditer(t)] for i, t in rows}
    words = {i: [(m.start(), m.end(), *(_terms(m.group()) or {""})) for m in WORD.finditer(t) if not any(m.start() < e and s < m.end() for s, e, _ in bases[i])] for i, t in rows}
    held = {i: {v for *_, v in bases[i]} for i, _ in rows}
    df_word = collections.Counter(w for _, t in rows for w in _terms(t))
    df_value = collections.Counter(v for vs in held.values() for v in vs)
    df_pair = collections.Counter((v, w) for i, _ in rows for v in held[i] for w in {w for *_, w in words[i]} - {""})
    text = dict(rows)
    n_texts = {p: len({text[i] for i, _ in rows if p[0] in held[i] and p[1] in {w for *_, w in words[i]}}) for p in df_pair}
    score = {(v, w): np.log2(len(rows) * n / (df_value[v] * df_word[w])) / np.log2(len(rows) / df_value[v]) for (v, w), n in df_pair.items() if n_texts[v, w] >= 2 and df_value[v] < len(rows)}
    found = {}
    for i, _ in rows:
        for a, b, w in words[i]:
            if (d := max((score.get((v, w), 0) for v in held[i]), default=0)) >= 0.6:
                found[i, a, b] = "removed" if d >= 0.8 else "generalised"
    return found


def _disclosing():
    far = "w x y z q r " * 3
    rows = [(k, f"Acme, acme ACME {far} {k} mail hot@third.org") for k in range(20)]  # spellings, far away, hot value
    rows += [(100 + k, f"EMP-0042 4521 ab12cd {far} {'u' * 230} bob@x.org {'v' * 230} {far} near{k} Zorbat, also (zorbat)") for k in range(3)]
    rows += [(200, rows[-1][1]), (201, "zorbat EMP-0042 without the address"), (202, "emp 4521 x@y.zz,bob@x.org"), (203, "two a@b.cd b@c.de")]
    return rows + [(300 + k, f"{far} filler number {k} é\uffff漢") for k in range(36)]


def test_disclosure_against_brute_force(spark):
    rows = _disclosing()
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {(r.doc_id, int(a), int(b)): k for r in got for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k in ("removed", "generalised")}
    assert spans == _revealing(rows) and {dict(rows)[i][a:b] for i, a, b in spans} >= {"Acme,", "acme", "ACME", "EMP-0042", "4521", "ab12cd", "Zorbat,", "(zorbat)", "u" * 230}


def test_word_beside_a_very_long_word(spark):
    rows = [(k, f"zorbat {'u' * 220}{k} {' ' * 300} a@b.cd {'v' * 220}{k} zumbit") for k in range(3)] + [(50 + k, f"filler {k}") for k in range(30)]
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any("zorbat" in out[k] or "zumbit" in out[k] for k in range(3)) and all("[email]" in out[k] for k in range(3))


def test_document_frequency_counts_a_document_once(spark):
    rows = [(k, f"Acme acme, beside a@hot.org number {k}") for k in range(10)] + [(50 + k, f"other beside number {k}") for k in range(20)]
    assert {r.n_removed for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id < 50} == {2}


def test_classes_of_values_and_words_against_brute_force(spark):
    rng = random.Random(5)
    groups = [([f"u{g}x{j}@h{g}.org" for j in range(rng.randrange(1, 4))], [f"Name{g}{'abc'[j]}" for j in range(3)]) for g in range(12)]
    rows = []
    for i in range(120):
        mails, names = (sum(x, []) for x in zip(*rng.sample(groups, rng.randrange(1, 3))))
        parts = rng.sample(mails, rng.randrange(len(mails) + 1)) + rng.sample(names, rng.randrange(len(names))) + [f"w{rng.randrange(30)}" for _ in range(6)]
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 120, 7)]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {(r.doc_id, int(a), int(b)): k for r in got for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k in ("removed", "generalised")}
    assert spans == _revealing(rows) and set(spans.values()) == {"removed", "generalised"}


def test_generalised_words_keep_their_shape(spark):
    rows = [(k, f"4521 ab12cd Zorbat plainword mail bob{k % 4}@x.org") for k in range(8)]
    rows = [(k, f"{t} {k}") for k, t in rows] + [(50 + k, f"filler {k} text") for k in range(24)]
    out = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string"), pii.Limits(generalise=0.2, remove=9.0)).collect()
    assert {r.text.rsplit(" ", 1)[0] for r in out if r.doc_id < 50} == {"[number] [code] [name] [word] [word] [email]"}


def test_running_and_stretch_against_plain_loops(spark):
    rng = random.Random(3)
    rows = [(k, [rng.randrange(100) for _ in range(n)], "".join(rng.choices("aé漢😀 ", k=n * 9))) for k, n in enumerate([0, 1, 127, 128, 129, 1000, 16384])]
    cut = [(0, 5), (250, 20), (255, 1), (256, 0), (65530, 20), (300, 70000), (10**6, 3)]
    d = spark.createDataFrame(rows, "k long, v array<int>, t string")
    got = d.select("k", arrays.running(F.col("v"), F.lit(0), lambda a, x: a + x).alias("sums"), arrays.running(F.col("v"), F.lit(0), F.greatest).alias("most"),
                   rules.let(arrays.text_blocks(F.col("t")), lambda b: F.array(*[arrays.stretch(b, F.lit(at), F.lit(n)) for at, n in cut])).alias("cuts")).collect()
    for r, (_, v, t) in zip(sorted(got), rows):
        assert r.sums == [sum(v[:i]) for i in range(len(v))] and r.most == [max(v[:i], default=0) for i in range(len(v))] and r.cuts == [t[a:a + n] for a, n in cut]


def test_thousands_of_addresses_in_one_text(spark):
    def run(n):
        lines = [f"user{i}@host{i}.org belongs to person{i} 漢" for i in range(n)]
        rows = [(1, "\n".join(lines)), (2, "\n".join([*lines, "one more line"]))] + [(10 + k, f"filler {k}") for k in range(60)]
        d, began = spark.createDataFrame(rows, "doc_id long, text string"), time.time()
        texts = {r.doc_id: r.text for r in pii.sanitise(d).collect()}
        assert "@" not in texts[1] and "person" not in texts[1] and texts[1].count("[email]") == n and texts[10] == "filler 0"
        return time.time() - began
    run(20)
    small, large = run(2_000), run(20_000)
    assert large < 10 * small + 5


def test_sanitise_keeps_columns(odd):
    out = pii.sanitise(odd)
    assert out.columns == odd.columns and out.count() == odd.count()


def _clashing(df):
    """``df`` with columns whose names the operators use themselves."""
    names = ["base", "revealing", "marks", "text_key", "row", "row_key", "__row_key", "__n_rows", "root", "fp", "first", "a.b"]
    return df.select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])


def test_sanitise_keeps_clashing_columns(spark, odd):
    df = _clashing(odd)
    out = pii.sanitise(df)
    assert out.schema.names == df.schema.names
    plain = {(r.doc_id, r.text) for r in pii.sanitise(odd).collect()}
    rows = out.collect()
    assert {(r.doc_id, r.text) for r in rows} == plain
    assert all(r[n] == f"{n}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in df.schema.names[len(odd.columns):])


def test_keep_one_keeps_clashing_columns(odd):
    df = _clashing(odd)
    out = simhash.keep_one(df)
    rows = out.collect()
    assert out.schema.names == df.schema.names and sorted(r.doc_id or 0 for r in rows) == sorted(r.doc_id or 0 for r in simhash.keep_one(odd).collect())
    assert all(r[n] == f"{n}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in df.schema.names[len(odd.columns):])


# --- quality classifier ---------------------------------------------------------
def test_classifier_held_out(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = quality.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in got) >= 0.95 * len(got)


def test_trees_learn_an_interaction():
    x = np.random.default_rng(1).random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit(x[:1500], y[:1500])
    assert ((trees.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_flat_trees_against_a_plain_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1200, 4)).round(1)  # many ties with the thresholds
    trees = quality.fit(x, ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float))

    def walk(row, node):
        while trees.feature[node] >= 0:
            node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
        return trees.value[node]

    margins = [trees.base + sum(walk(row, root) for root in trees.roots) for row in x]
    assert trees.scores(x) == pytest.approx([1 / (1 + np.exp(-m)) for m in margins], abs=1e-12)
    assert trees.scores(np.zeros((0, 4))).shape == (0,)


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_classifier_odd_rows(request, spark, table):
    df = request.getfixturevalue(table)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.score(df, labels).collect()
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    assert quality.keep_good(df, labels.limit(0)).count() == df.count()  # no label: 0.5 for all


# --- SimHash --------------------------------------------------------------------
def _simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints, most=3):
    """``{fp: representative}`` by brute force."""
    fps = sorted(set(prints))
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for k, a in enumerate(fps):
        for b in fps[k + 1:]:
            if (a ^ b).bit_count() <= most:
                parent[root(b)] = root(a)
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("table", TABLES)
def test_near_duplicates(request, table):
    df = request.getfixturevalue(table)
    rows = [(r.doc_id, _simhash(r.text)) for r in df.collect()]
    roots = _components([f for _, f in rows])
    least = {}
    for i, f in rows:
        if i is not None:
            least[roots[f]] = min(least.get(roots[f], i), i)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(((i, f, least.get(roots[f])) for i, f in rows), key=str)


@pytest.mark.parametrize("bucket", [2, 2048])
def test_large_buckets_are_split(spark, bucket):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(20)}
    fps |= {f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for f in list(fps)[:4] for _ in range(60)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = {r.node: r.root for r in simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), bucket=bucket)).collect()}
    groups, want = collections.defaultdict(set), collections.defaultdict(set)
    for (s,) in signed:
        groups[found.get(s, s)].add(s % (1 << 64))
    for f, r in _components(fps).items():
        want[r].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_keep_one(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == {None: 1, 1: 1, 2: 1, 4: 1, 7: 1}  # 3 and 6 are empty like 2, 5 is 4; the row without a key is near to nothing


def test_keep_one_of_each_component(spark):
    texts = ["alpha " * 30, "beta gamma " * 20, "delta epsilon zeta " * 10, "eta theta " * 25, "iota kappa " * 9]
    rows = [(5, texts[0], 1), (3, texts[0], 2), (5, texts[1], 3),  # 3 stands for the first text, 5 for the second only
            (None, texts[2], 4), (None, texts[2], 5), (None, texts[1], 6), (8, texts[3], 7), (8, texts[4], 8), (8, texts[4], 8)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert sorted((r.text, r.doc_id) for r in kept) == sorted([(texts[0], 3), (texts[1], 5), (texts[2], None), (texts[3], 8), (texts[4], 8)])


# --- decontamination ------------------------------------------------------------
def test_reordered_passage_is_a_leak(spark):
    item = [f"w{k}" for k in range(24)]
    texts = [(1, " ".join(item)), (2, "x y " + " ".join(item[12:] + ["gap"] + item[:12])), (3, " ".join(item[:10])), (4, None), (5, " ".join(item[::-1])),
             (6, " ".join(item) + " " + " ".join(item)), (6, " ".join(item).upper() + "!")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    b = spark.createDataFrame([(9, " ".join(item)), (10, "too short"), (11, None), (None, " ".join(item[:6]))], "item_id long, text string")
    found = collections.Counter((r.doc_id, r.item_id) for r in decontam.leaks(d, b).collect())
    assert {k for k in found if k[1] == 9} == {(1, 9), (2, 9), (6, 9)} and found[6, 9] == 2
    assert {i for i, item_id in found if item_id is None} == {1, 2, 3, 6}
    assert sorted(r.doc_id for r in decontam.keep_clean(d, b).collect()) == [4, 5]


def test_verbatim_items_are_found(spark, docs):
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    joined = {r.doc_id: " ".join(decontam.words(r.text)) for r in docs.collect()}
    want = {(i, r.item_id) for r in b.collect() for i, t in joined.items() if " ".join(decontam.words(r.text)) in t}
    assert want <= {(r.doc_id, r.item_id) for r in decontam.leaks(docs, b).collect()}


def test_tiles_do_not_overlap():
    rng = random.Random(6)
    for _ in range(200):
        doc, item = ([rng.randrange(3) for _ in range(n)] for n in (40, 15))
        k = 3
        grams = [tuple(item[j:j + k]) for j in range(len(item) - k + 1)]
        names = {g: n + 1 for n, g in enumerate(sorted(set(grams)))}
        at = [(p, names[g]) for p in range(len(doc) - k + 1) if (g := tuple(doc[p:p + k])) in names]
        tiles = decontam.tiles(at, [names[g] for g in grams], k)
        places = [[x for t in tiles for x in range(t[s], t[s] + t[2])] for s in (0, 1)]
        assert all(len(p) == len(set(p)) for p in places) and all(doc[p:p + n] == item[q:q + n] for p, q, n in tiles)


def _greedy(doc, item, k):
    """Words of the item covered by a plain greedy tiling: the longest match of unmarked words first, first places first."""
    doc_free, item_free, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        top = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and doc_free[p + n] and item_free[q + n]:
                    n += 1
                if n > top[0]:
                    top = (n, p, q)
        n, p, q = top
        if n < k:
            return covered
        covered += n
        doc_free[p:p + n], item_free[q:q + n] = [False] * n, [False] * n


def test_leaks_against_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [rng.choices(vocabulary, k=rng.randrange(1, 40)) for _ in range(30)]
    docs = []
    for n in range(150):
        text = []
        for item in rng.sample(items, 3):
            cuts = sorted(rng.sample(range(len(item) + 1), min(len(item) + 1, rng.randrange(2, 5))))
            parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, len(item)])]
            rng.shuffle(parts)
            for part in parts:
                text += part + rng.choices(vocabulary, k=rng.randrange(3))
        docs.append((n, text))
    want = set()
    for n, text in docs:
        for j, item in enumerate(items):
            k = min(5, len(item))
            if (covered := _greedy(text, item, k)) / len(item) >= 0.6:
                want.add((n, j, len(item), covered))
    d = spark.createDataFrame([(n, " ".join(t)) for n, t in docs], "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_words, r.n_covered) for r in decontam.leaks(d, b).collect()}
    assert got == want and any(w[2] < 5 for w in want) and any(w[3] < w[2] for w in want)
    assert sorted(r.doc_id for r in decontam.keep_clean(d, b).collect()) == sorted({n for n, _ in docs} - {w[0] for w in want if w[2] >= 5})
    assert sorted(r.doc_id for r in decontam.keep_clean(d, b, least_words=1).collect()) == sorted({n for n, _ in docs} - {w[0] for w in want})


def test_short_items_are_whole_matches(spark):
    d = spark.createDataFrame([(1, "the Answer is: forty two!"), (2, "forty and two"), (3, None), (4, "two")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "forty two"), (2, "two"), (3, ""), (4, None), (5, "is forty two now")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(d, b).collect()} == {(1, 1), (1, 2), (2, 2), (4, 2)}
    assert decontam.keep_clean(d, b).count() == 4


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_decontam_odd_rows(request, spark, table):
    df = request.getfixturevalue(table)
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(df, b).count() == 0 and decontam.keep_clean(df, b).count() == df.count()


# --- quality rules --------------------------------------------------------------
def _rule_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {x for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for x in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


@pytest.mark.parametrize("table", TABLES)
def test_rule_counts(request, table):
    df = request.getfixturevalue(table)
    got = rules.judge(df).collect()
    assert sorted(((r.doc_id, *r[1:7]) for r in got), key=str) == sorted(((r.doc_id, *_rule_counts(r.text)) for r in df.collect()), key=str)
    assert not any(r.kept for r in got if r.base_failed)


def test_divergent_text_is_dropped(spark):
    rng = random.Random(7)
    common = "the of and to in is it that for with".split()
    clean = [(k, " ".join(rng.choice(common) if rng.random() < 0.6 else "".join(rng.choices("abcdefgh", k=5)) for _ in range(120)), "en") for k in range(60)]
    junk = (99, " ".join("#".join(rng.choices("XYZ&%$", k=5)) for _ in range(120)), "en")
    out = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame([*clean, junk], "doc_id long, text string, lang string")).collect()}
    assert out.pop(99) is False and all(out.values())


def _distances(rows):
    """``{doc_id: (class distance, word distance)}`` by brute force, for documents and languages above the guards."""
    def classes(text):
        counts = []
        for _, pattern in (*rules.CLASSES[:3], ("letter", r"[^\W\d_]+"), *rules.CLASSES[4:]):
            rest = re.sub(pattern, "", text)
            counts.append(len(text) - len(rest))
            text = rest
        return np.array([*counts, len(text)], float)

    def js(p, q):
        m = (p + q) / 2
        return np.sqrt(sum(0.5 * (x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)))

    out = {}
    for lang in {r[2] for r in rows}:
        own = [(i, t, WORD.findall(t.lower())) for i, t, x in rows if x == lang]
        counts = collections.Counter(w for _, _, words in own for w in words)
        top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:24]]
        share = lambda c, n: np.array([*(c[w] for w in top), n - sum(c[w] for w in top)], float) / n
        whole = sum(classes(t) for _, t, _ in own)
        for i, t, words in own:
            if len(words) >= 50 and counts.total() >= 2000:
                out[i] = js(classes(t) / len(t), whole / whole.sum()), js(share(collections.Counter(words), len(words)), share(counts, counts.total()))
    return out


def test_distances_and_verdict(spark):
    rng = random.Random(11)
    common = "the of and to in is it that for with as on by at from this be are or an was not but have which".split()
    rows = []
    for k in range(60):
        words = [rng.choice(common[:k % 25 + 1]) if rng.random() < 0.6 else "".join(rng.choices("abcdefghé1,", k=5)) for _ in range(40 + k)]
        text = rng.choice([" ", "\t", "\n"]).join([w.title() if rng.random() < 0.3 else w for w in words])
        rows.append((k, text.upper() if k % 10 == 9 else text, "fr" if k == 7 else "en"))
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    want = _distances(rows)
    assert {i for i, r in got.items() if r.word_distance is not None} == set(want) and want
    for i, (by_class, by_word) in want.items():
        assert got[i].class_distance == pytest.approx(by_class, abs=1e-6) and got[i].word_distance == pytest.approx(by_word, abs=1e-6)
        assert got[i].kept == (not got[i].base_failed and by_class <= 0.30 and by_word <= 0.42)


def test_a_null_language_is_not_the_empty_one(spark):
    rows = [(k, f"{word} " * 60, lang) for k, (word, lang) in enumerate([("alpha", None), ("beta", "")] * 40)]
    refs = rules.references(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted(r.common for r in refs) == [["alpha"], ["beta"]]
    judged = rules.judge(spark.createDataFrame([*rows, (99, "alpha " * 60, "")], "doc_id long, text string, lang string")).collect()
    assert all(r.word_distance < 0.2 for r in judged if r.doc_id < 99) and [r.word_distance > 0.5 for r in judged if r.doc_id == 99] == [True]


# --- licenses -------------------------------------------------------------------
def test_patience_alignment():
    assert licenses.align(list("axbycz"), list("abc")) == [(0, 0), (2, 1), (4, 2)]
    assert licenses.increasing([(0, 2), (1, 0), (2, 1), (3, 3)]) == [(1, 0), (2, 1), (3, 3)]


def test_licenses_are_found_in_place(spark):
    t = licenses.TEMPLATES
    d = spark.createDataFrame([(1, f"some words {t['mit notice']} more {t['mit notice']}"), (2, t["mpl-2.0 header"].replace("subject", "object").upper()),
                               (3, "the license is not here"), (4, None)], "doc_id long, text string")
    found = collections.Counter((r.doc_id, r.license) for r in licenses.scan(d).collect())
    assert found == {(1, "mit notice"): 2, (2, "mpl-2.0 header"): 1}


def test_license_lines_of_the_table(docs):
    notices = [n for n in licenses.TEMPLATES if n.endswith("notice")]
    want = {(r.doc_id, n) for r in docs.collect() for n in notices if licenses.TEMPLATES[n] in (r.text or "")}
    assert want == {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}


def test_versions_and_whole_texts_are_told_apart(spark):
    t = licenses.TEMPLATES
    names = [n for n in t if n.endswith((" text", " spdx", " header"))]
    rows = [(k, f"some words before {t[n]} and some after") for k, n in enumerate(names)]
    rows += [(1000, "This work is licensed under the GNU General Public License, version 2."), (1001, "SPDX-License-Identifier: XYZ-2.0")]
    found = collections.defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].add(r.license)
    for k, n in enumerate(names):
        assert {x for x in found[k] if x.split()[-1] == n.split()[-1]} >= {n} and (t[n] not in t["gpl header"] or found[k] == {"gpl header"})
    assert found[1000] == {"gpl-2.0 notice"} and not found[1001]
    by_kind = collections.Counter((k, x.split()[-1]) for k, n in enumerate(names) for x in found[k] if x.split()[-1] == n.split()[-1])
    assert set(by_kind.values()) == {1}


def test_stray_words_do_not_stretch_a_find():
    template = [f"t{k}" for k in range(50)]
    text = template[:1] + ["x"] * 32 + template[1:5] + template[8:49] + ["y"] * 30 + template[49:]
    places = collections.defaultdict(list)
    for k, w in enumerate(text):
        places[w].append(k)
    assert [m >= 45 for *_, m in licenses.find(text, template, dict(places))] == [True]


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_license_odd_rows(request, table):
    assert licenses.scan(request.getfixturevalue(table)).count() == 0


def _found(spark, texts):
    found = collections.defaultdict(list)
    for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        found[r.doc_id].append((r.first_word, r.last_word, r.license))
    return [sorted(found[k]) for k in range(len(texts))]


def test_the_name_and_version_are_the_license(spark):
    near = ["Released under the Commercial License.", "Released under the Zlib License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-ND 4.0.",
            "This work is licensed under the GNU Lesser General Public License, version 2.", "Licensed under the Apache License, Version 1.1.",
            "This work is licensed under the GNU Affero General Public License, version 2.1.", "Released under the BSD Zero License."]
    assert _found(spark, near) == [[]] * len(near)
    same = {"This work is licensed under the GNU General Public License v3.": "gpl-3.0 notice", "Licensed under the Apache License 2.0": "apache-2.0 notice",
            "This work is licensed under the GNU Lesser General Public License, version 2.1.": "lgpl-2.1 notice",
            "This work is licensed under the GNU General Public License, version 2. 1 copy.": "gpl-2.0 notice"}
    assert [[n for *_, n in f] for f in _found(spark, list(same))] == [[n] for n in same.values()]
    headers = [n for n in licenses.TEMPLATES if n.endswith("header")]
    assert [{n for *_, n in f if n.endswith("header")} for f in _found(spark, [licenses.TEMPLATES[n] for n in headers])] == [{n} for n in headers]


@pytest.mark.parametrize("name", ["mit notice", "gpl-3.0 notice", "isc text"])
def test_adjacent_copies_are_found_whole(spark, name):
    n = len(decontam.words(licenses.TEMPLATES[name]))
    texts = [before + f"{licenses.TEMPLATES[name]} " * copies + after for copies in (1, 2, 3, 5) for before, after in (("", ""), ("some words before ", "and after"))]
    want = [[(at + k * n, at + (k + 1) * n, name) for k in range(copies)] for copies in (1, 2, 3, 5) for at in (0, 3)]
    assert _found(spark, texts) == want


def test_equal_fits_are_one_row(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "doc_id long, text string")
    found = licenses.scan(d, {"x text": "alpha beta gamma delta one", "y text": "alpha beta gamma delta two"}).collect()
    assert [(r.license, r.n_matched) for r in found] == [("x text | y text", 4)]


def _common(a, b):
    """Length of the longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_alignment_against_brute_force():
    rng = random.Random(9)
    for k in range(300):
        n = rng.randrange(2, 30)
        b = list(range(n)) if k % 2 else [rng.randrange(n) for _ in range(n)]
        a = [x for x in b if rng.random() < 0.8]
        for _ in range(rng.randrange(6)):
            a.insert(rng.randrange(len(a) + 1), 100 + rng.randrange(50) if k % 2 else rng.randrange(n))
        if k % 3 == 0:
            rng.shuffle(a)
        pairs = licenses.align(a, b)
        assert all(a[p] == b[q] for p, q in pairs) and all(p < x and q < y for (p, q), (x, y) in zip(pairs, pairs[1:]))
        assert len(pairs) <= _common(a, b)
        if k % 2 and len(set(a)) == len(a) and k % 3:  # words that are unique to both and keep their order: nothing better exists
            assert len(pairs) == _common(a, b)


def test_a_whole_license_is_scanned_in_little_time():
    text = decontam.words(licenses.TEMPLATES["gpl-3.0 text"])
    places = collections.defaultdict(list)
    for p, w in enumerate(text):
        places[w].append(p)
    begun = time.process_time()
    found = {n: licenses.find(text, decontam.words(t), places) for n, t in licenses.TEMPLATES.items() if n.endswith(" text")}
    assert [n for n, f in found.items() if f] == ["gpl-3.0 text"] and time.process_time() - begun < 3


# --- substring dedup ------------------------------------------------------------
def _deduplicated(rows):
    first = {}
    for i, text in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - 12) if i is not None else ():
            first[tuple(w[k:k + 13])] = min(first.get(tuple(w[k:k + 13]), i), i)
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = {x for k in range(len(w) - 12) if i is not None and first[tuple(w[k:k + 13])] < i for x in range(k, k + 13)}
        yield i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)


def _passages():
    rng = random.Random(5)
    base = [rng.choices("abcdefgh", k=400) for _ in range(5)]
    rows = [(1, "a " * 40), (2, "a " * 20), (3, "a b " * 30), (4, "c a b " * 20 + "a " * 13), (5, "b a " * 14)]
    for k in range(6, 300):
        j = rng.randrange(380)
        rows.append((k, " ".join(rng.choices("abc", k=rng.randrange(30)) + rng.choice(base)[j:j + rng.randrange(5, 30)] + rng.choices("xyz", k=rng.randrange(30)))))
    return rows


@pytest.mark.parametrize("table", [*TABLES, "passages"])
def test_substring_dedup(request, spark, table):
    df = spark.createDataFrame(_passages(), "doc_id long, text string") if table == "passages" else request.getfixturevalue(table)
    want = sorted(_deduplicated([(r.doc_id, r.text) for r in df.collect()]), key=str)
    assert sorted(map(tuple, substring.deduplicate(df).collect()), key=str) == want


def test_anchor_depends_on_its_window_alone():
    rng = np.random.default_rng(8)
    window = rng.integers(0, 3, substring.WINDOW).astype(np.uint64)
    places = {int(substring.anchors(np.concatenate([rng.integers(0, 3, n).astype(np.uint64), window, rng.integers(0, 3, 30).astype(np.uint64)]))[n]) - n
              for n in range(40)}
    assert len(places) == 1


def test_word_symbols_tell_words_apart(docs):
    rng = random.Random(3)
    texts = [r.text or "" for r in docs.limit(60).collect()] + ["", " ", "x", "é 漢字 é", "a" * 300 + " " + "a" * 301 + " " + "a" * 300, "q" * (substring.BLOCK + 5) + " tail", "a\x00 a \x00a"]
    texts += ["".join(rng.choices("ab \n\t", k=rng.randrange(40))) for _ in range(200)] + ["word " * 500_000]
    array = pa.array(["cut off", *texts])[1:]
    seen, k = {}, 0
    for first, at, symbols in substring._slices(array):
        assert first == k
        for a, b in zip(at, at[1:]):
            words = texts[k].encode().split()
            assert len(words) == b - a
            for w, s in zip(words, symbols[a:b].tolist()):
                assert seen.setdefault(w, s) == s
            k += 1
    assert k == len(texts) and len(set(seen.values())) == len(seen)


def test_copied_texts(spark):
    long, short = "one passage of words that is long enough to hold a window and some more", "a short one"
    rows = [(5, long), (3, long), (3, long), (9, long), (None, long), (7, f"{long} end"), (2, short), (1, short), (3, short), (3, "other text"), (4, f"start {long}")] * 2
    got = sorted(map(tuple, substring.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted(_deduplicated(rows), key=str)
