"""Token counts by distinct pre-token.

No piece of the vocabulary contains a letter or digit followed by another kind of
character, anything before a space, or a line break, so a text's pieces are those
of its pre-tokens side by side.  The pieces of a pre-token are counted once per
distinct pre-token of the corpus; a document's count is the sum over its
pre-token frequencies.  Ids are never built per document.

The pre-tokens with the highest corpus counts (at most ``HOT`` of them) meet the
documents as a broadcast table, which takes out every heavy join key; the rest
are joined by an ordinary shuffle, ``(pre-token, document, frequency)``.

Edge cases: a null or empty text has 0 bytes and 0 tokens; special-token strings
are ordinary text, as in the library; repeated rows give a row each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import map_rows, whole_text, written

#: Bound of the broadcast part of the pre-token table (rows; about 12 bytes each).
HOT = 200_000
#: Distinct pre-tokens a task holds before it passes their counts on.
FLUSH = 200_000

SPACE_MARK = "▁"
_OTHER = "_\xb2\xb3\xb9"  # word characters of the pattern language that pieces treat as signs
_PRETOKEN = re.compile(rf" *(?:[^ \w\n]|[{_OTHER}])*[^\W{_OTHER}]*|\n")


def load(name: str):
    """The library's processor, after checking that the pre-tokens are safe for its vocabulary."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    spans = re.compile(rf"[^{SPACE_MARK}]{SPACE_MARK}|[^\W{_OTHER}](?:[^\w{SPACE_MARK}]|[{_OTHER}])|\n")
    if found := [p for p in plain if spans.search(p)]:
        raise ValueError(f"{name} has pieces that span a pre-token boundary: {found[:3]}")
    probe = "ﬁ  \xbd é"
    if "".join(sp.encode(probe, out_type=str)).replace(SPACE_MARK, " ") != " " + probe:
        raise ValueError(f"{name} normalises its input")
    return sp


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a whole text behind the space that the library puts first; the space mark is a space."""
    return [t for t in _PRETOKEN.findall(" " + text.replace(SPACE_MARK, " ")) if t] if text else []


def count_pieces(sp, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token.  A line break in front keeps the library's own space (one piece, as the break) apart."""
    return [len(ids) - 2 for ids in sp.encode(["\n" + t for t in tokens], num_threads=1)]


def corpus_pieces(docs: DataFrame, name: str) -> DataFrame:
    """``token, n (occurrences), pieces``: one row per distinct pre-token of all texts."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])
        for batch in batches:
            for t in batch["text"]:
                held.update(pretokens(t.as_py()))
                if len(held) >= FLUSH:
                    yield out()
                    held.clear()
        yield out()

    def start():
        sp = load(name)

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch["token"], batch["n"], pa.array(count_pieces(sp, batch["token"].to_pylist()), pa.int32())],
                                   names=["token", "n", "pieces"])
        return fn

    distinct = (docs.select(whole_text().alias("text")).mapInArrow(tally, "token string, n long")
                .groupBy("token").agg(F.sum("n").alias("n")))
    return map_rows(distinct, start, "token string, n long, pieces int")


def hot_bound(pieces: DataFrame, most: int) -> int:
    """The smallest occurrence count that at most ``most`` pre-tokens reach, over powers of two."""
    sizes = pieces.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()  # at most 64 rows
    total, bound = 0, 62  # beyond any count
    for p, count in sorted(((r["p"], r["count"]) for r in sizes), reverse=True):
        if (total := total + count) > most:
            break
        bound = p
    return 2 ** bound


def token_counts(docs: DataFrame, name: str = "piece_bpe_32k.model", limit: int = 4096, hot_rows: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    pieces = written(corpus_pieces(docs, name), "pieces")
    least = hot_bound(pieces, hot_rows)
    hot = {r["token"]: r["pieces"] for r in pieces.where(F.col("n") >= least).select("token", "pieces").toLocalIterator()}
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document one row with its own columns and the sum over its frequent pre-tokens, and a row for each other pre-token."""
        get, row = known.value.get, TaskContext.get().partitionId() << 40
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, t in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text, total, at = t.as_py(), 0, len(out[0])
                out[0].append(f"\n{row}")  # a key of its own, no pre-token
                for token, n in Counter(pretokens(text)).items():
                    if (k := get(token)) is not None:
                        total += n * k
                    else:
                        out[0].append(token)
                        out[2].append(n)
                more = len(out[0]) - at - 1
                out[1].extend([row] * (more + 1))
                out[2].insert(at, total)
                out[3].extend([doc_id] + [None] * more)
                out[4].extend([len(text.encode())] + [None] * more)
                row += 1
                if len(out[0]) > 100_000:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(out, _KINDS)], names=_NAMES)
                    out = ([], [], [], [], [])
            if out[0]:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, _KINDS)], names=_NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        frequencies, "token string, row long, n long, doc_id long, n_bytes long")
    rare = pieces.where(F.col("n") < least).select("token", "pieces")
    # an own row meets no pre-token and stands for its sum; every other row meets exactly one
    counted = rows.join(rare, "token", "left").select("row", "doc_id", "n_bytes", (F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n"))
    summed = counted.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


_NAMES = ["token", "row", "n", "doc_id", "n_bytes"]
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
