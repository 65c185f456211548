"""Substring dedup against a direct reading of the contract."""

import hashlib
import random

import numpy as np

from strata.llm import substring_dedup as sd


def brute(rows, length):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        windows = [tuple(words[p:p + length]) for p in range(len(words) - length + 1)]
        gone = set()
        for p, w in enumerate(windows):
            if w in seen:
                gone.update(range(p, p + length))
            seen.add(w)
        kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, tie string")
    return sorted(map(tuple, sd.remove_repeats(df, **kw).collect()))


def test_small_windows_over_random_words(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randrange(40)))) for i in range(120)]
    assert run(spark, rows, length=6, gram=3) == brute(rows, 6)


def test_edges(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rng = random.Random(5)

    def noise(n):
        return " ".join(f"n{rng.randrange(10**9)}" for _ in range(n))

    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "few words"), (5, noise(19)), (6, passage),
            (7, noise(30) + " " + passage + "\n" + noise(5)), (8, passage), (9, "say it again " * 60),
            (10, noise(10) + " " + " ".join(passage.split()[5:30])), (11, " ".join(passage.split()[:19])),
            (12, "x " * 25), (13, "é\x85ü " * 40), (14, passage.upper()), (15, noise(30000) + " " + passage)]
    rows += [(100 + i, passage + " " + noise(3)) for i in range(80)]
    assert run(spark, rows) == brute(rows, 20)


def test_repeated_rows_share_a_result_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = run(spark, [(1, text), (1, text), (2, text)])
    assert [(r[0], r[2]) for r in got] == [(1, 0), (1, 0), (2, 40)]
    assert run(spark, [(3, text), (3, "other " + text)])[0][0] == 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sd.remove_repeats(empty).count() == 0


def test_every_window_has_an_anchor_of_its_own_words():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 4, 300).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    starts = np.array([0, 100, 110, 300])
    _, _, first, last, owner = sd.blocks_of(words, starts, 20, 6)
    covered = {(o, w) for o, a, b in zip(owner, first, last) for w in range(a, b + 1)}
    assert covered == {(0, w) for w in range(81)} | {(2, w) for w in range(171)}
    assert (last - first).max() <= 20 - 6
