"""Every registered query and the pipeline run on the smallest tables."""

import collections
import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from salesboard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


#: Operators whose rows are not one a document: finds, pieces, nodes, conversations.
OTHER_ROWS = (4, 8, 11, 12, 13)


@pytest.mark.parametrize("name", [n for n in QUERIES if int(n[2:].split("_")[0]) not in OTHER_ROWS])
def test_query_has_a_row_for_each_document(spark, docs, name):
    rows = QUERIES[name](spark, SF).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in docs.collect())


def test_pipeline_stages_keep_their_contract(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = stage(spark, kept, SF).cache()
        ids = [r.doc_id for r in kept.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        assert kept.columns == docs.columns or name == "bpe"
        if name in ("pii", "bpe"):
            assert set(ids) == before


def test_run_encodes_what_the_stages_keep(spark, docs):
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF).cache()
    enc = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    enc.no_truncation()
    enc.no_padding()
    want = set()
    for r in kept.collect():
        ids = enc.encode(r.text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), enc.decode(ids, skip_special_tokens=False))]
        want.add((r.doc_id, len(ids), *digests))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == want


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_stages_on_odd_rows(request, spark, table):
    df = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.count() <= df.count() and (out.columns == df.columns or name == "bpe")
