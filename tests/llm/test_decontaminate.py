"""Benchmark decontamination: planted items, paraphrases, and recall against brute force."""

import random

import numpy as np

from strata.llm import decontaminate as dc
from strata.llm.queries import op5_decontaminate
from tests.conftest import SF_ORACLE

DOCS, BENCH = "doc_id long, text string, item_id string", "item_id long, text string, doc_id string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (rng.choices(range(5), k=rng.randrange(1, 30)) for _ in range(2))
        assert dc.common_subsequence(a, np.array(b)) == lcs(a, b)


def fixture():
    rng = random.Random(2)
    common = [f"c{i}" for i in range(30)]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(n)]

    items = [(i, prose(rng.randrange(12, 60))) for i in range(40)]
    rows, truth = [], set()
    for d in range(300):
        words = prose(rng.randrange(1, 400))
        if d % 5 == 0:
            i, item = rng.choice(items)
            item = list(item)
            if d % 10 == 0:  # a paraphrase: every sixth word replaced, one inserted
                item = [f"q{rng.randrange(10**6)}" if k % 6 == 5 else w for k, w in enumerate(item)]
                item.insert(3, "inserted")
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
            truth.add((d, i))
        rows.append((d, " ".join(words).capitalize() + "."))
    return rows, [(i, " ".join(w).capitalize() + ".") for i, w in items], truth


def run(spark, rows, items, **kw):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], DOCS)
    bench = spark.createDataFrame([(*r, "clash") for r in items], BENCH)
    return dc.find_leaks(docs, bench, **kw)


def test_planted_items_and_paraphrases(spark):
    rows, items, truth = fixture()
    got = {(r.doc_id, r.item_id) for r in run(spark, rows, items).collect()}
    brute = {(r.doc_id, r.item_id) for r in run(spark, rows, items, cosine=-1.0).collect()}
    assert len(got & truth) >= 0.9 * len(truth) and len(got & brute) >= 0.9 * len(brute)
    assert got <= brute and len(got - truth) == 0


def test_blocks_of_items(spark, monkeypatch):
    rows, items, truth = fixture()
    monkeypatch.setattr(dc, "BLOCK_WORDS", 200)
    got = {(r.doc_id, r.item_id) for r in run(spark, rows, items).collect()}
    assert len(got & truth) >= 0.9 * len(truth) and not got - truth


def test_repeated_items_are_taken_once(spark, monkeypatch):
    rows, items, _ = fixture()
    seen, keep = [], dc.Items.__init__

    def counted(self, found):
        seen.append(len(found))
        keep(self, found)

    monkeypatch.setattr(dc.Items, "__init__", counted)
    one = sorted(map(tuple, run(spark, rows, items).collect()))
    many = sorted(map(tuple, run(spark, rows, items[:3] * 200 + items).collect()))
    assert one == many and seen == [len(items), len(items)]


def test_edges(spark):
    item = "the answer to this long question is of course forty two rare zebras"
    rows = [(1, None), (2, ""), (3, "?!"), (4, item.upper()), (4, item.upper()), (None, item), (5, "few words"),
            (6, "x " * 30000 + item), (7, "one two")]
    got = sorted((r.doc_id, r.item_id) for r in run(spark, rows, [(1, item), (2, item), (3, "one two"), (4, None),
                                                                  (None, item), (5, "")]).collect())
    assert got == [(4, 1), (4, 2), (6, 1), (6, 2)]
    assert run(spark, [], [(1, item)]).count() == 0 and run(spark, rows, []).count() == 0
    docs = spark.createDataFrame([(*r, "clash") for r in rows], DOCS)
    kept = dc.remove_leaks(docs, spark.createDataFrame([(1, item, "")], BENCH))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "5", "7", "None"]


def test_query_finds_every_whole_item(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in op5_decontaminate(spark, SF_ORACLE).collect()}
    assert whole <= got and len(got - whole) <= 0.1 * len(whole)
