"""Quality classifier: histogram gradient-boosted trees over document statistics.

* ``document_statistics`` turns a whole text into one row of numbers.
* ``fit`` bins every statistic into at most ``BINS`` quantile bins and grows
  depth-limited trees on gradient histograms (logistic loss).
* The trees are kept as flat arrays (statistic, threshold, children, value); a
  batch of documents walks all of them level by level in numpy.

Labels are learned from a bounded sample (``SAMPLE`` rows, picked by a hash of
the document key); all statistics and scores cover every row and whole texts.

Edge cases: null and empty texts have a score like any other (their statistics
are zeros); rows without a label or key are scored, never learned from; several
labels of one key count as one (the highest); with no label at all the score is
0.5 everywhere.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import map_rows, whole_text

#: Labelled rows learned from, at most (about: the sample is drawn by hash).
SAMPLE = 20_000
#: Learning parameters.
BINS, TREES, DEPTH, RATE, L2, LEAF = 64, 60, 4, 0.2, 1.0, 5.0
KEPT_SCORE = 0.3

STATISTICS = ("log_words", "log_bytes", "mean_word", "spread_word", "longest_word", "distinct_words", "top_word", "repeats", "log_lines", "repeated_lines",
              "words_per_line", "upper", "digits", "spaces", "stops", "marks", "bars", "exclaims", "symbols", "beyond_ascii", "byte_entropy", "short_words",
              "ends_in_symbol")
_ENDS = re.compile(rb"[#*$%&|<>!](?:\s|$)")


def document_statistics(text: str | None) -> list[float]:
    """Statistics of a whole text, in the order of ``STATISTICS``."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    at = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = at[65:91].sum(), at[97:123].sum()
    p = at[at > 0] / size
    marks = at[33:48].sum() + at[58:65].sum() + at[91:97].sum() + at[123:127].sum()
    return [np.log1p(n), np.log1p(size), lengths.mean(), lengths.std(), np.log1p(lengths.max()), len(counts) / n, max(counts.values()) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), n / len(lines),
            upper / max(1, upper + lower), at[48:58].sum() / size, (at[32] + at[9:14].sum()) / size, (at[44] + at[46]) / size, marks / size, at[124] / n,
            at[33] / n, at[[35, 36, 37, 38, 42, 60, 62]].sum() / n, at[128:].sum() / size, float(-(p * np.log2(p)).sum()), (lengths <= 3).mean(),
            len(_ENDS.findall(raw)) / n]


@dataclass
class Trees:
    """All trees in flat arrays; children of a node are positions in the same arrays, a leaf has ``feature`` -1."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values, every row and tree a step at a time."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            feature = self.feature[node]
            goes_left = x[rows, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(feature < 0, node, np.where(goes_left, self.left[node], self.right[node]))
        return self.base + self.value[node].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Grow the trees on rows ``x`` with labels ``y`` in {0, 1}."""
    flat: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if not len(y):
        return Trees(0.0, np.zeros(0, int), *(np.zeros(0, int), np.zeros(0), np.zeros(0, int), np.zeros(0, int), np.zeros(0)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)

    def add(**node) -> int:
        for k, v in ({"feature": -1, "threshold": 0.0, "left": 0, "right": 0, "value": 0.0} | node).items():
            flat[k].append(v)
        return len(flat["feature"]) - 1

    def grow(rows: np.ndarray, depth: int) -> int:
        g, h = grad[rows], hess[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-6, None, None)
        if depth < DEPTH:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gl, hl = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g, h))
                gr, hr = total_g - gl, total_h - hl
                gain = np.where((hl >= LEAF) & (hr >= LEAF), gl**2 / (hl + L2) + gr**2 / (hr + L2) - total_g**2 / (total_h + L2), 0)
                if gain[k := int(gain.argmax())] > best[0]:
                    best = (gain[k], j, k)
        if best[1] is None:
            step = -RATE * total_g / (total_h + L2)
            margin[rows] += step
            return add(value=float(step))
        here = add(feature=best[1], threshold=float(edges[best[1]][best[2]]))
        goes_left = binned[rows, best[1]] <= best[2]
        flat["left"][here], flat["right"][here] = grow(rows[goes_left], depth + 1), grow(rows[~goes_left], depth + 1)
        return here

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(grow(np.arange(len(y)), 0))
    return Trees(base, np.array(roots), *(np.array(flat[k]) for k in ("feature", "threshold", "left", "right", "value")))


def held_out(key: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on at most about ``sample`` labelled rows outside the held-out fold."""
    usable = (labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    n = usable.count()
    if n > sample:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    # bounded: about `sample` rows of two numbers
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(usable), "doc_id")

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [document_statistics(t.as_py()) for t in batch["text"]]
            return pa.record_batch([pa.array(x, pa.list_(pa.float64())), batch["quality"].cast(pa.int32())], names=["x", "y"])
        return fn

    got = map_rows(rows.select("text", "quality"), start, "x array<double>, y int").collect()
    got.sort(key=lambda r: (r["y"], r["x"]))  # the same trees whatever the order of the tasks
    return fit(np.array([r["x"] for r in got], float).reshape(-1, len(STATISTICS)), np.array([r["y"] for r in got], float))


def text_scores(trees: Trees, texts: pa.Array) -> np.ndarray:
    return trees.scores(np.array([document_statistics(t.as_py()) for t in texts], float).reshape(-1, len(STATISTICS)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    trees = learn(docs, labels)

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(text_scores(trees, batch["text"]), pa.float64())],
                                   names=["doc_id", "held_out", "score"])
        return fn

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text"))
    scored = map_rows(rows, start, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= KEPT_SCORE).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject."""
    trees = learn(docs, labels)

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(text_scores(trees, batch["text"]) >= KEPT_SCORE, pa.bool_()))
        return fn

    return map_rows(docs, start, docs.schema)
