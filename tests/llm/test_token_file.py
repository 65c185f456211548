"""Token files against the tokenizers library and plain numpy."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import token_file as tf

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, start string"
TEXTS = [None, "", " ", "Hello, World!  it's 42\tfoo", "naïve Straße ÀÉ µ ª º ² ½", "a\x85b\xa0c\x1cd\x0be",
         "H̱ḥ é Å Ω ſ İI ǅ", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "日本語 テキスト 😀👍🏽 x",
         "don't DON'T we'll'll ''s !'s", "word " * 30000, "x" * 5000, "\x00\x01 ​﻿", "１２ Ⅷ ٣"]


def brute(rows, end_id=2):
    t = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_encoder_equals_the_library():
    t = Tokenizer.from_file(VOCABULARY)
    texts = [x or "" for x in TEXTS]
    ids, counts = tf.TextEncoder(VOCABULARY).encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_on_any_text(texts):
    t = _encoder().tokenizer
    ids, counts = _encoder().encode(pa.array(texts, pa.string()))
    expected = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


_HELD = []


def _encoder():
    if not _HELD:
        _HELD.append(tf.TextEncoder(VOCABULARY))
    return _HELD[0]


def test_word_cache_is_cleared_and_rebuilt(monkeypatch):
    monkeypatch.setattr(tf, "CACHE_WORDS", 3)
    t, encoder = Tokenizer.from_file(VOCABULARY), tf.TextEncoder(VOCABULARY)
    for text in ("one two three", "two four five six seven", "one seven", "eight"):
        assert encoder.encode(pa.array([text]))[0].tolist() == t.encode(text, add_special_tokens=False).ids


def test_another_vocabulary_goes_text_by_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, encoder = Tokenizer.from_file(path), tf.TextEncoder(path)
    assert not encoder.by_word
    ids, counts = encoder.encode(pa.array(["a  b\n", "", " c"]))
    assert ids.tolist() == t.encode("a  b\n", add_special_tokens=False).ids + t.encode(" c", add_special_tokens=False).ids
    assert counts[1] == 0


@pytest.mark.parametrize("values", [
    [], [7], [5] * 1024, list(range(3000)), [0, 2**32 - 1] * 700, [3] * 1000 + [2**31] * 24 + [9] * 10])
def test_blocks_round_trip(values):
    values = np.array(values, np.uint32)
    for percentile in (0, 50, 90, 100):
        blocks = tf.pack(values, percentile)
        data, starts = b"".join(blocks), np.cumsum([0] + [len(b) for b in blocks])[:-1]
        assert np.array_equal(tf.unpack(data, starts.astype(np.int64)), values)


def test_outliers_go_to_the_exception_list():
    values = np.arange(1024, dtype=np.uint32) % 16
    values[10] = 40000
    (block,) = tf.pack(values)
    count, exceptions, width, low = tf._HEAD.unpack_from(block)
    assert (count, exceptions, width, low) == (1024, 1, 4, 0)
    assert len(block) == tf._HEAD.size + 4 * 128 + 6


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_round_trip_equals_brute_force(spark):
    rows = [(i * 7 % 100, t) for i, t in enumerate(TEXTS * 3, 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    assert rows_of(tf.round_trip(df, VOCABULARY)) == brute(sorted(rows, key=lambda r: r[0]))


def test_null_and_repeated_ids(spark):
    rows = [(None, "null id"), (5, "same"), (5, "same"), (5, "same"), (2, "two"), (None, None)]
    got = rows_of(tf.round_trip(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), VOCABULARY))
    assert [r[0] for r in got] == [None, None, 2, 5, 5, 5]
    assert sorted((r[2], r[3]) for r in got) == sorted((r[2], r[3]) for r in brute(rows))
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()


def test_empty_table(spark):
    assert tf.round_trip(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []


def test_ids_and_random_access(spark, scratch):
    rows = [(i, f"document {i} " * (i % 37 + 1)) for i in range(400)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    manifest = tf.write_tokens(df, scratch, VOCABULARY, end_id=9, files=3)
    assert len(manifest) == 3 and sorted(os.listdir(scratch))[1:] == [f"part-{i:05d}.pfor" for i in range(3)]
    got = tf.read_tokens(spark, scratch).orderBy("start").collect()
    t = Tokenizer.from_file(VOCABULARY)
    assert [r["ids"] for r in got] == [t.encode(x, add_special_tokens=False).ids + [9] for _, x in rows]
    whole = np.array([i for r in got for i in r["ids"]], np.uint32)
    for start, count in ((0, 5), (1000, 3000), (len(whole) - 3, 10), (manifest[1]["start"] - 2, 4)):
        assert np.array_equal(tf.read_ids(scratch, start, count), whole[start:start + count])


def test_a_cut_file_is_refused(spark, scratch):
    df = spark.createDataFrame([(1, "a b c", "x", "y")], SCHEMA)
    tf.write_tokens(df, scratch, VOCABULARY, files=1)
    path = f"{scratch}/part-00000.pfor"
    with open(path, "rb+") as f:
        f.truncate(os.path.getsize(path) - 5)
    with pytest.raises(ValueError):
        tf.TokenFile(path)
