"""Held-out accuracy, folds and edge cases of the quality classifier."""

import zlib

import pytest

from strata.llm import quality_classifier as q
from strata.llm.queries import op8_quality_classifier

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op8_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert sum(a > b for a in good for b in bad) > 0.97 * len(good) * len(bad)
    assert sum((s >= 0.7) == (y == 1) for s, y in held) > 0.95 * len(held)


def test_training_leaves_the_held_out_fold_alone(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "1 AS score")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    texts, _ = q.labelled_sample(docs, labels, 1000)
    used = {int(t.split()[1]) for t in texts}
    assert used == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(q.labelled_sample(docs, labels, 50)[0]) == 50


def test_edges(spark):
    model = q.train([b"good words here", b"bad### noise###"] * 20, [1, 0] * 20, buckets=1 << 12)
    data = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "good words here", "x"), (5, "bad### noise###", "x"),
            (4, "good words here", "x"), (None, "good " * 200000, "x"), (6, "é", "x")]
    out = q.score(spark.createDataFrame(data, "doc_id long, text string, score string"), model).collect()
    by = {r.doc_id: r.score for r in out}
    assert len(out) == len(data) and by[1] == by[2] == by[3]
    assert by[4] > 0.7 > 0.3 > by[5]
    assert q.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0
    with pytest.raises(ValueError):
        q.train([b"a"], [1])


def test_repeated_rows_take_one_place_in_the_sample(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    hot = spark.range(2500).selectExpr("CAST(0 AS LONG) AS doc_id", "'text number 0' AS text")
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 3 AS INT) AS quality")  # 2 is no label
    texts, marks = q.labelled_sample(docs.unionByName(hot), labels, 2000)
    assert len(texts) == len(set(texts)) and set(marks) == {0, 1}
    assert q.classify(docs.unionByName(hot), labels).count() == 2560
    few, _ = q.labelled_sample(docs, labels, 2000, size_bytes=60)
    assert 1 <= len(few) <= 5


@pytest.mark.parametrize("quality, low, high", [("NULL", 0.5, 0.5), ("1", 0.9, 1.0), ("0", 0.0, 0.1)])
def test_labels_of_one_class_or_none(spark, quality, low, high):
    docs = spark.range(40).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
    rows = q.classify(docs, spark.range(40).selectExpr("id AS doc_id", f"CAST({quality} AS INT) AS quality")).collect()
    assert len(rows) == 40 and all(low <= r.score <= high for r in rows)
