"""The pipeline against brute-force versions of its stages, stage by stage."""

import re

import corpus_pipeline as cp
from strata.llm.queries import vocabulary
from tests.conftest import SF_SMALL
from tests.llm import test_ngram_join, test_pii, test_quality_rules


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns
    tables = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = stage(spark, docs, SF_SMALL).cache()
        tables[name] = before, docs
        if name != "bpe":
            assert docs.columns == names

    before, after = tables["quality_rules"]
    kept = {r.doc_id for r in after.collect()}
    for r in before.collect():
        n, _, symbols, _, repeats = test_quality_rules.brute(r.text)
        if n < 50 or 2 * repeats > n:
            assert r.doc_id not in kept
        elif symbols == 0 and repeats == 0 and n > 100:
            assert r.doc_id in kept

    before, after = tables["ngram_join"]
    groups = test_ngram_join.brute([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {root for _, _, root in groups}

    before, after = tables["decontaminate"]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in after.collect()}
    dirty = {r.doc_id for r in before.collect() if any(i in (r.text or "") for i in items)}
    assert not clean & dirty and len(clean) >= before.count() - len(dirty) - 2

    before, after = tables["pii"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text)
        if not test_pii.brute(texts[r.doc_id]) and not re.search(r"[0-9]{3}", texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
        assert not test_pii.brute(r.text)

    before, after = tables["bpe"]
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == " ".join(map(str, ids)) and r.n_tokens == len(ids)


def test_run_equals_the_chain_of_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert sorted(map(tuple, cp.run(spark, SF_SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0
