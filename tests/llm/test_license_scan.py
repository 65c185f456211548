"""License scan against exact containment over all windows."""

import random
import re

from strata.llm import license_scan as ls
from strata.llm.queries import op10_license_scan
from tests.conftest import SF_SMALL


def brute(rows):
    out = []
    for doc_id, text in rows:
        words = [re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
        words = [w for w in words if w]
        shingles = [" ".join(words[i:i + 5]) for i in range(max(len(words) - 5, 0) + 1)]
        for name, template in ls.TEMPLATES:
            n, wanted = len(ls.template_words(template)), set(ls.template_shingles(template))
            stride = -(-n // 2)
            held = max(n + stride - 6, 0) + 1
            hits = [(-len(wanted & set(shingles[i:i + held])), i) for i in range(0, len(shingles), stride)]
            hits = [h for h in hits if 100 * -h[0] >= 80 * len(wanted)]
            if hits:
                out.append((doc_id, name, -min(hits)[0] / len(wanted), min(hits)[1], len(hits)))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, license string")
    return sorted(map(tuple, ls.scan(df).collect()))


def test_edges(spark):
    rng = random.Random(1)

    def noise(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    rows = [(1, None), (2, ""), (3, "no notice here"), (4, "the license"), (5, "x " * 20000)]
    for k, (_, text) in enumerate(ls.TEMPLATES):
        for at in range(9):
            rows.append((100 * k + 10 + at, noise(at + 30) + " " + text.upper() + "\n" + noise(20)))
        rows.append((100 * k + 30, text))
        words = text.split()
        rows.append((100 * k + 31, noise(9) + " " + " ".join(words[1:]) + " " + noise(9)))
        rows.append((100 * k + 32, noise(9) + " " + " ".join(words[:2] + ["oddly"] + words[2:]) + " " + noise(9)))
    rows += [(900, noise(3000) + " (Licensed under CC BY-NC 4.0.) " + noise(3000))] * 2
    got, want = run(spark, rows), brute(rows)
    assert got == want and len(want) >= 9 * len(ls.TEMPLATES)


def test_query_and_empty(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op10_license_scan(spark, SF_SMALL).collect())) == brute(rows)
    assert ls.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_anchor_words_lose_nothing():
    anchors = set(ls.anchor_words())
    for _, text in ls.TEMPLATES:
        shingles = ls.template_shingles(text)
        assert 100 * sum(not anchors & set(s.split()) for s in shingles) < 80 * len(shingles)


def test_native_plan(spark):
    plan = ls.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_hashes_are_those_of_spark(spark):
    shingles = ["a b c d e", "é ü the mit license", ""]
    df = spark.createDataFrame([(x,) for x in shingles], "s string")
    got = [tuple(r) for r in df.selectExpr("xxhash64(s)", "xxhash64(s, 0)", "xxhash64(s, 31)").collect()]
    assert got == [(ls.shingle_hash(x), ls.min_hash([x], 0), ls.min_hash([x], 31)) for x in shingles]
    assert ls.min_hash(shingles, 7) == min(ls.min_hash([x], 7) for x in shingles)


def test_bands_retrieve_among_many_notices(spark):
    """Whole pages of notices one behind the other: every one that is contained is retrieved."""
    rng = random.Random(4)
    pages = []
    for i in range(40):
        notices = rng.sample([t for _, t in ls.TEMPLATES], rng.randrange(2, 8))
        pages.append((i, " ".join(n + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 6)))
                                  for n in notices * rng.randrange(1, 4))))
    assert run(spark, pages) == brute(pages)
