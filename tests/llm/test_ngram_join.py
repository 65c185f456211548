"""N-gram Jaccard join against all pairs."""

import random

from strata.llm import ngram_join as nj
from strata.llm.components import components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return sorted((i, len(a), root(i)) for i, a in sets)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long")
    return sorted(map(tuple, nj.join(df).collect()))


def corpus(seed, families, copies, edits, length):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(4, length))]
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.randrange(0, edits)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_families_of_copies(spark):
    rows = corpus(1, 40, 14, 6, 160)
    assert run(spark, rows) == brute(rows)


def test_chains_and_shared_passages(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # each differs from the next by two words, the ends not at all alike
        rows.append((i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(200)] = f"y{rng.randrange(10**6)}"
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(60):
        rows.append((100 + i, passage + " " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60)))))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_one_hub_with_many_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(500, " ".join(base))]
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Few Words"), (5, "few\twords"), (6, "a b c d e"), (7, "A B C D E"),
            (8, "é ü ß ö ä"), (9, "É ü ß ö ä"), (10, "a a a a a a a a"), (11, "a a a a a"), (12, "x " * 30000),
            (13, "x x x x x y"), (14, "few words more")]
    assert run(spark, rows) == brute(rows)


def test_repeated_and_null_ids_and_empty_table(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"),
            (None, None), (2, "seven eight nine ten eleven"), (1, "seven eight nine ten eleven")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, nj.join(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (None, 0, None), (2, 1, 1), (1, 1, 1)], key=str)
    assert nj.join(df.limit(0)).count() == 0
    kept = nj.keep_one(df.withColumn("text2", df.text))
    assert kept.columns == ["doc_id", "text", "text2"] and kept.filter("doc_id = 2").count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_around_a_missing_centre(spark):
    """Copies of a text that is not there itself: many pivots, few of which link with each other's followers."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(220):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words[:rng.choice([120, 120, 120, 100, 90])])))
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    near = []
    for i in range(6):
        words = list(base)
        for _ in range(i):
            words[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        near.append((i, " ".join(words)))
    seen = {}

    def counted(df, label, keep=nj.written):
        out = keep(df, label)
        seen[label] = max(seen.get(label, 0), out.count())
        return out

    monkeypatch.setattr(nj, "written", counted)
    sizes = []
    for times in (1, 40):
        seen.clear()
        assert run(spark, near * times) == sorted(brute(near) * times)
        sizes.append({k: v for k, v in seen.items() if k != "join-sets"})
    # Repeats shift the order of the shingles a little, and nothing else.
    assert sizes[0].keys() == sizes[1].keys() and all(sizes[1][k] <= 1.5 * n + 5 for k, n in sizes[0].items())


def test_one_row_of_repeats_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "a")] * 5 + [(2, text, "b")] * 3 + [(None, text, "c")] * 4 + [(None, None, "d"), (3, "", "e"), (3, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = sorted(map(tuple, nj.keep_one(df).collect()), key=str)
    assert got == sorted([(1, text, "a"), (None, text, "c"), (None, None, "d"), (3, "", "e")], key=str)


def test_two_texts_under_one_id_link_by_either(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    other = list(words)
    other[5] = "x"
    rows = [(1, " ".join(words)), (1, "a b c d e"), (2, " ".join(other)), (3, "a b c d e"), (4, "z " * 9)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in nj.join(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
