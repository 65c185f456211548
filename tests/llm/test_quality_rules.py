"""Quality rules against a plain Python reading of the contract."""

import random
import re

from strata.llm import quality_rules as q

SCHEMA = "doc_id long, text string, n_words string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def rows(spark, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    out = q.measure(df).orderBy("doc_id").collect()
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out], out


def test_measures_on_edge_cases(spark):
    texts = [None, "", " \t\n", "a", "a b", "a a a a", "x y z x y z", "a b c d a b c", "é\x85ü ß #|<>",
             "one two\none two\n \n\nthree", "w " * 500, "k%d " * 3, " ".join(f"w{i % 97}" for i in range(3000)),
             " ".join(f"w{i}" for i in range(5000)) + "\n" + "a b c " * 3, "a b\x0bc\x0cd\re"]
    got, _ = rows(spark, texts + texts)
    assert got == [brute(t) for t in texts + texts]


def test_measures_on_random_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab #\n\tÉ", k=rng.randrange(80))) for _ in range(1200)]
    got, _ = rows(spark, texts)
    assert got == [brute(t) for t in texts]


def test_verdict(spark):
    clean = " ".join(["the quick fox of a small town was seen by someone near hill number"] + [
        f"and then word{i} walked to place{i}" for i in range(20)])
    noisy = " ".join(w + "###" for w in clean.split())
    _, out = rows(spark, [clean, noisy, "too short", "the end " * 60])
    assert [(r.base_failed, r.kept) for r in out] == [(False, True), (False, False), (True, False), (True, False)]


def test_empty_table_and_reject_keeps_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert q.measure(empty).count() == 0
    clean = " ".join(f"the word{i} of" for i in range(60))
    df = spark.createDataFrame([(1, clean, "x"), (2, None, None), (None, clean, "y")], SCHEMA)
    out = q.reject(df)
    assert out.columns == df.columns
    assert sorted(r.n_words for r in out.collect()) == ["x", "y"]


def test_plan_is_one_narrow_stage(spark):
    plan = q.measure(spark.createDataFrame([(1, "a", "b")], SCHEMA))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
