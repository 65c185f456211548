"""The trie against a brute-force one in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from strata.llm import conversation_trie as ct
from strata.llm.oracle import TRIE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth string, kind string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, role, tie), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def brute(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        parts = [below(x) for x in children[node]]
        return own + sum(p[0] for p in parts), sum(p[1] for p in parts) or 1

    out = []
    for node, held in members.items():
        saved, leaves = below(node)
        ends = ",".join(str(c) for c in sorted(c for c in held if convs[c] == node))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(children[node]),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def some_rows(seed, n=60, texts=3):
    r = random.Random(seed)
    out = []
    for c in range(n):
        for turn in range(r.choice([0, 1, 2, 3, 8, 12])):
            out.append((c, turn, r.choice(["user", None, "assistant"]), r.choice(["a", "é", None, "long text"][:texts])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = some_rows(seed)
    assert rows_of(ct.forked_trie(frame(spark, rows))) == brute(rebuilt(rows))


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_any_number_of_shards(spark, shards):
    rows = some_rows(9, n=120)
    paths = ct.forked_paths(frame(spark, rows))
    assert rows_of(ct.build(paths, shards)) == brute(rebuilt(rows))


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(None, 1, "user", "x"), (5, None, "user", "a"), (5, None, "user", "a"), (5, 0, None, None),
            (5, 0, "", ""), (6, 3, "user", "b"), (6, 1, "user", "a"), (6, 1, "b", "a"), (8, 1, "user", "only"),
            (-3, 1, "user", "minus"), (100, 1, "user", "é" * 5000)]
    assert rows_of(ct.forked_trie(frame(spark, rows))) == brute(rebuilt(rows))


def test_one_hot_path_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE", 64)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 2000, 5) for t in range(3)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(1, 400, 5) for t in range(4)]
    paths = ct.forked_paths(frame(spark, rows))
    assert len(ct.choose_splitters(paths, 12).splitters) == 11
    assert rows_of(ct.build(paths, 12)) == brute(rebuilt(rows))


def test_one_very_long_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in (10, 11, 20) for t in range(900 if c == 10 else 5)]
    convs = rebuilt(rows)
    got = rows_of(ct.build(ct.forked_paths(frame(spark, rows)), 3))
    assert len(got) == len({p[:d] for p in convs.values() for d in range(len(p) + 1)})
    assert max(r[1] for r in got) == 900


def test_empty_table(spark):
    assert ct.forked_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plain_paths_and_members(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (3, 0, "user", "c")]
    paths = ct.plain_paths(frame(spark, rows))
    assert rows_of(ct.build(paths)) == brute({1: (("user", "a"), ("user", "b")), 2: (("user", "a"),), 3: (("user", "c"),)})
    first = bytes(paths.filter("conv_id = 2").first()["path"])
    assert sorted(r[0] for r in ct.members_of(paths, first).collect()) == [1, 2]


def test_sql_equals_brute_force():
    rows = some_rows(4) + [(5, None, None, "tie"), (77, 1, "user", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({TRIE_SQL})").fetchall()
    assert sorted(got, key=str) == brute(rebuilt(rows))
