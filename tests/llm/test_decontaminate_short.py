"""Benchmark items of a few words: found where they stand word for word."""

from strata.llm import decontaminate as dc

QUESTION = "What is the capital of Australia?"
LONG = "the answer to this long question is of course forty two rare zebras"
DOCS = [(1, f"Quiz. {QUESTION} Canberra."), (2, "what is the capital of old Australia"), (3, QUESTION.upper()),
        (4, "What is the capital"), (5, "of Australia?"), (6, "x " * 300000 + QUESTION), (7, None), (8, ""),
        (9, f"{LONG} {QUESTION} {QUESTION}"), (None, QUESTION)]


def frames(spark, items):
    return (spark.createDataFrame(DOCS, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_short_items(spark):
    docs, bench = frames(spark, [(1, QUESTION), (2, LONG), (3, QUESTION), (4, "old Australia"), (5, "the capital of")])
    got = sorted((r.doc_id, r.item_id, r.item_words, r.lcs_words, r.start_word) for r in
                 dc.find_leaks(docs, bench).collect())
    first = {1: 1, 3: 0, 6: 300000, 9: 13}
    want = [(d, i, 6, 6, at) for d, at in first.items() for i in (1, 3)] + [(9, 2, 13, 13, 0)]
    want += [(d, 5, 3, 3, at + 2) for d, at in {**first, 2: 0}.items()]
    assert [g for g in got if g[1] != 2] == sorted(w for w in want if w[1] != 2)
    assert [g[:2] for g in got if g[1] == 2] == [(9, 2)]
    kept = {r.doc_id for r in dc.remove_leaks(docs, bench).collect()}
    assert kept == {4, 5, 7, 8, None}


def test_short_items_alone(spark):
    docs, bench = frames(spark, [(1, QUESTION)])
    assert sorted(r.doc_id for r in dc.find_leaks(docs, bench).collect()) == [1, 3, 6, 9]
