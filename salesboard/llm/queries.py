"""The registered query of each operator, with production parameters.

Each query reads the whole table, runs its operator and derives the contract's
columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesboard.llm import bpe, decontam, licenses, packing, pii, prefix_trie, quality, repair, rules, simhash, substring, token_counts, token_store
from salesboard.llm.common import documents
from salesboard.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB twins, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


@query
def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_words", "n_tiles", "n_covered", "coverage")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, most=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), fresh_dir(spark, "token-store")
    token_store.write_store(docs, path)
    return token_store.read_all(spark, path, docs.select(F.col("doc_id").alias("key")))


@query
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.deduplicate(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op10_substring"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, p, array_to_string(w[p:p + 12], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - 11)) AS p FROM texts)),
firsts AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
covered AS (
  SELECT DISTINCT r, unnest(range(p, p + 13)) AS k FROM windows JOIN firsts USING (win) WHERE doc_id > first_id),
gone AS (SELECT r, list(k) AS ks, count(*) AS n FROM covered GROUP BY r),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY k) AS kept_text
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts) ANTI JOIN covered USING (r, k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM texts LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)"""


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "pieces")
    packing.write_pieces(documents(spark, sf_dir), path)
    pieces = packing.read_pieces(spark, path).select(
        "place", "doc_id", F.col("piece").cast("int").alias("piece"), "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return pieces.join(packing.slots(spark, path), "place").drop("place")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.rebuild(prefix_trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.summary(repair.repair(repair.damage(rows)))
