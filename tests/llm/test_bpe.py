"""The automaton against the tokenizers library, text by text."""

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe
from strata.llm.queries import op2_bpe, vocabulary
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


EDGES = ["", " \t\n", "Hello  World's 123 é ß <|endoftext|> x.   ΟΔΟΣ", "á é \x1c \x1f b \x85\xa0c", "İ ½²Ⅷ ٣ 中文 🙂🙂",
         "<|startoftext|><|endoftext|>x", "a" * 5000, "!" * 3000 + "z" * 777, "don't I'LL we'Re 'S",
         "\x00\x01\x7f", "ﬁ ŉ ẞ֌", "x " * 4000]


def test_edges(library):
    automaton = bpe.load(vocabulary())
    assert [automaton.encode_both(t) for t in EDGES] == [expected(library, t) for t in EDGES]
    assert all(automaton.decode_text(expected(library, t)[0]) == expected(library, t)[1] for t in EDGES)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="abcdeinrstħé'!0 \n", max_size=60)))
def test_any_text(library, text):
    assert bpe.load(vocabulary()).encode_both(text) == expected(library, text)


def test_bounded_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHE_ARCS", 5)
    text = "the quick brown fox, the lazy dog and antidisestablishmentarianism! " * 3
    assert bpe.Automaton(vocabulary()).encode_both(text) == expected(library, text)


def test_documents(spark, library):
    texts = [None, *EDGES, *EDGES]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS ids")
    got = {r.doc_id: r for r in bpe.encode_documents(df, vocabulary()).collect()}
    assert [(got[i].ids, got[i].decoded) for i in range(len(texts))] == [expected(library, t) for t in texts]
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), vocabulary()).count() == 0


@pytest.mark.parametrize("operator", [bpe.encode_documents, bpe.digest_documents])
def test_a_batch_goes_in_slices(operator):
    class Frame:  # hands back the function that Spark would call with its batches
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    texts = [None, "", *["the quick brown fox 123 " * 100] * 2000, "jumps " * 400_000]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    out = list(operator(Frame(), vocabulary())(iter([whole, whole.slice(0, 0)])))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(len(texts)))
    assert len(out) >= 6 and all(b.nbytes < 12 << 20 for b in out[:-1]) and out[-1].num_rows == 1


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op2_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, decoded = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids.split())
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_a_vocabulary_of_other_rules_is_refused():
    import public_tokenizers
    import pytest

    with pytest.raises(ValueError, match="normaliser and splitter"):
        bpe.Automaton(public_tokenizers.path("byte_bpe_50k.json"))
