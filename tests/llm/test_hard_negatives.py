"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from strata.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, score string, id string, part string"


def brute(rows, every=50):
    kept = set()
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        kept.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))

    def product(a, b):
        return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))

    out = []
    for anchor in kept:
        if anchor[0] % every:
            continue
        scored = [(-product(anchor[2], r[2]), r[0], r) for r in kept]
        positives = sorted(x[:2] for x in scored if x[2][1] == anchor[1] and x[2] != anchor)[:5]
        for ps, pid in positives:
            inside = sorted(x[:2] for x in scored if x[2][1] != anchor[1] and -50 * ps <= -100 * x[0] <= -95 * ps)
            out += [(anchor[0], pid, k, nid, -ps, -ns) for k, (ns, nid) in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    out = hn.mine(df, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def some_rows(n, dim, seed=0, labels=10):
    r = np.random.default_rng(seed)
    return [(i, int(r.integers(labels)), [float(x) for x in r.normal(0, 0.15, dim).astype(np.float32)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = some_rows(900, 16)
    got = mined(spark, rows)
    assert got and got == brute(rows)


def test_small_boxes_and_many_blocks(spark, monkeypatch):
    rows = some_rows(700, 3, seed=5, labels=3)
    index = dict(LEAF=4, BLOCK=64, BLOCKS=2, ANCHORS=3)
    # Tasks read the constants in their own process; whole blocks are compared here.
    expected = brute(rows)
    assert mined(spark, rows) == expected
    for name, value in index.items():
        monkeypatch.setattr(hn, name, value)
    shape_rows = hn.usable_rows(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA))
    data = shape_rows.collect()
    ids = np.array([r["vec_id"] for r in data])
    labels = np.array([r["label"] for r in data])
    vectors = np.floor(256 * np.array([r["v"] for r in data]))
    opened = 0
    for anchor in np.flatnonzero(ids % 50 == 0).tolist():
        best = hn.Best(5)
        for part in np.array_split(np.arange(len(ids)), 11):
            order, slabs = hn.str_pack(vectors[part], ids[part], [0, 1])
            part = part[order]
            tree, ends = block_tree(vectors[part], ids[part], labels[part], slabs, vectors[anchor])
            keep = hn._rule(tree, True, labels[anchor], ids[anchor], vectors[anchor])
            opened += tree.search(vectors[anchor], ends, keep, [best])
        scores = vectors @ vectors[anchor]
        same = [(-scores[i], ids[i]) for i in range(len(ids)) if labels[i] == labels[anchor] and i != anchor]
        assert best.held == sorted(same)[:5]
    assert opened < 0.6 * (len(ids) / 4) * (ids % 50 == 0).sum()  # boxes are really skipped


def block_tree(vectors, ids, labels, slabs, q):
    starts = np.arange(0, len(ids), hn.LEAF)
    low, high = hn._boxes(vectors, vectors, starts)
    above = np.cumsum(slabs) - slabs
    slab_low, slab_high = hn._boxes(low, high, above)
    tree = hn.Tree({"ids": ids, "labels": labels, "vectors": vectors, "leaf_low": low, "leaf_high": high,
                    "leaf_id": np.minimum.reduceat(ids, starts), "slab_low": slab_low, "slab_high": slab_high,
                    "slab_start": np.append(above, len(starts))}, True)
    return tree, tuple(e[0] for e in tree.intervals(q[None, :]))


def test_boxes_hold_their_scores(monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 32)
    r = np.random.default_rng(3)
    vectors, ids = np.floor(r.normal(0, 40, (300, 8))), np.arange(300)
    order, slabs = hn.str_pack(vectors, ids, [2, 5])
    assert sorted(order.tolist()) == list(range(300)) and slabs.sum() == -(-300 // hn.LEAF)
    vectors = vectors[order]
    q = np.floor(r.normal(0, 40, 8))
    _, (low, high, slab_low, slab_high) = block_tree(vectors, ids[order], ids, slabs, q)
    scores = vectors @ q
    for leaf in range(len(low)):
        part = scores[leaf * hn.LEAF:(leaf + 1) * hn.LEAF]
        assert low[leaf] <= part.min() and part.max() <= high[leaf]
    assert min(slab_low) <= scores.min() and scores.max() <= max(slab_high)


def test_one_very_common_vector(spark):
    v = [0.5, -0.25, 0.125]
    rows = [(i, i % 3, v if i % 2 == 0 else [0.3 + i / 1000, 0.1, 0.0]) for i in range(600)]
    assert mined(spark, rows) == brute(rows)


def test_nulls_repeats_short_vectors_and_bad_components(spark):
    rows = some_rows(120, 4, seed=2, labels=2)
    rows += [rows[0], rows[0], rows[7], (None, 1, [0.1]), (200, None, [0.1]), (250, 1, None), (300, 1, [0.1, None]),
             (350, 1, [float("nan"), 1.0]), (400, 0, [float("inf")]), (450, 0, []), (451, 1, [0.5]), (452, 1, [0.4, 0.2]),
             (50, 1, [0.5, 0.5, 0.5, 0.5]), (-50, 1, [0.2, 0.2]), (500, 1, [0.0, -0.0])]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_doubles_are_whole(spark):
    r = random.Random(1)
    rows = [(i, i % 2, [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(0, 8) for _ in range(3)]) for i in range(150)]
    rows += [(1000, 0, [3e38, 1.0, 1.0]), (1001, 1, [2e38, 0.0, 1.0]), (1002, 0, [1e30, 0.0, 0.0])]
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(50, 1, [0.1])], [(50, 1, [0.1]), (51, 1, [0.1])], [(1, 1, [0.1]), (2, 2, [0.1])]])
def test_nothing_to_return(spark, rows):
    assert mined(spark, rows) == []


def test_window_ends():
    for score in (-101, -100, -1, 0, 1, 3, 100, 101, 10**18):
        low, high = hn.window_of(score)
        assert 100 * low >= 50 * score > 100 * (low - 1) and 100 * high <= 95 * score < 100 * (high + 1)


def test_groups_of_index_files():
    index = {0: [1, 2], 1: [1], 3: [1] * 5, 4: [1], 7: [1]}
    assert hn._groups(index, 4) == [[0, 1], [3], [4, 7]]
    assert hn._groups(index, 1) == [[0], [1], [3], [4], [7]] and hn._groups({}, 3) == []
