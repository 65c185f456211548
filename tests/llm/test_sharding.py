"""Exact shard sizes, gapless slots and a uniform draw."""

import zlib
from collections import Counter

import numpy as np

from strata.llm import sharding
from strata.llm.queries import op9_sharding
from tests.conftest import SF_SMALL


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(5)
    draws = [sharding.hypergeometric(rng, 12, 20, 9) for _ in range(20000)]
    other = np.random.default_rng(6).hypergeometric(12, 20, 9, 20000)
    a, b = np.bincount(draws, minlength=10), np.bincount(other, minlength=10)
    assert np.abs(a - b).max() < 500
    big = [sharding.hypergeometric(rng, 3 * 10**10, 10**10, 10**6) for _ in range(200)]
    assert abs(np.mean(big) - 750000) < 200


def test_matrix_margins():
    blocks, shards = [0, 5, 17, 1, 100], [41, 41, 41]
    m = sharding.communication_matrix(blocks, shards, 3)
    assert m.sum(axis=1).tolist() == blocks and m.sum(axis=0).tolist() == shards


def check(rows, n, shards=24):
    assert len(rows) == n
    sizes = Counter(r.shard for r in rows)
    assert all(n // shards <= sizes.get(s, 0) <= n // shards + 1 for s in range(shards))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_query(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op9_sharding(spark, SF_SMALL).collect()
    check(rows, len(docs))
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(docs[r.doc_id]) + 8, zlib.crc32(docs[r.doc_id]), "rows", None)
    assert rows == op9_sharding(spark, SF_SMALL).collect() or Counter(rows) == Counter(
        op9_sharding(spark, SF_SMALL).collect())


def test_nulls_repeats_clashes_and_empty(spark):
    data = [(None, None, "a"), (None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "é" * 100000, "c"), (3, None, "d")] * 9
    df = spark.createDataFrame(data, "doc_id long, text string, shard string")
    check(sharding.shard(df, blocks=8, buckets=4).collect(), len(data))
    assert sharding.shard(df.limit(0), blocks=8, buckets=4).count() == 0


def test_every_shard_gets_a_fair_mix(spark):
    df = spark.range(24000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    rows = sharding.shard(df).collect()
    halves = Counter(r.shard for r in rows if r.doc_id < 12000)
    assert all(400 < halves[s] < 600 for s in range(24))
    assert abs(np.corrcoef([r.doc_id for r in rows], [r.slot for r in rows])[0, 1]) < 0.05


def test_equal_rows_spread_over_blocks(spark, monkeypatch, scratch):
    seen = {}

    def kept(df, label, keep=sharding.written):
        out = keep(df, label)
        seen[label] = out
        return out

    monkeypatch.setattr(sharding, "written", kept)
    df = spark.range(3000).selectExpr("CAST(IF(id < 2000, 7, id) AS LONG) AS doc_id", "'same' AS text")
    check(sharding.shard(df).collect(), 3000)
    hot = seen["shard-keys"].filter("doc_id = 7")
    assert hot.select("key").distinct().count() == 2000


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS", 2)
    df = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")
    check(sharding.shard(df, blocks=4, buckets=2).collect(), 3000)
