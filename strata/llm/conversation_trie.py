"""Prefix trie of conversations by a splitter skeleton.

A conversation's path is the sequence of the 128-bit digests of its turns; the
trie has a node for each distinct prefix of a path.

1. *Splitters.*  Paths, ties broken by conversation id, are cut into ranges at
   the quantiles of a hashed sample.  The trie of the splitters' own paths is the
   skeleton, and is broadcast.  A node whose members lie in two ranges is a
   prefix of the splitter between them, so only skeleton nodes cross ranges.
2. *Shards.*  Each range is sorted in one task, which walks it once with a stack
   of open nodes: neighbours share the prefix that stays open.  A node that is no
   skeleton node is finished there, with its whole subtree.
3. *Reduction.*  For skeleton nodes a shard emits partial aggregates, summed by
   Spark to one row for each skeleton node and rolled up from the leaves of the
   skeleton to its root.

Rows that repeat one path spread over shards as the ids break ties.  What is
broadcast and what reaches the driver is one row for each skeleton node: at most
``MAX_SHARDS`` paths; the sample holds ``SAMPLE`` rows for each shard.  A
conversation's path is one row of 20 bytes a turn, however long its texts are.  A
shard task holds the open nodes and the finished children of open nodes.  The
ids that end at a skeleton node are hashed in order by one task, as SHA-256
needs, from pieces of ``PIECE`` bytes as they stream by.

Defined results: rows without a conv_id are ignored; turns that share a number
follow each other by role and digest, repeated rows are turns of their own; a
null role or text is empty; other columns are ignored; an empty table gives no
nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written

WIDTH = 16
SHARD_BYTES = 4 << 20
MAX_SHARDS = 4096
SAMPLE = 64
PIECE = 1 << 16
BATCH = 5000
NOTHING = hashlib.sha256(b"").hexdigest()


def _ordered(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: number, role, digest and bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"), role.alias("role"),
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.octet_length(text).alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _path(turns: Column) -> list[Column]:
    digests = F.array_join(F.transform(turns, lambda t: t["digest"]), "")
    return [F.unhex(digests).alias("path"), F.transform(turns, lambda t: t["bytes"]).alias("bytes")]


def plain_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path, bytes (of each turn's text) of the conversations as they are."""
    return _ordered(conversations).select("conv_id", *_path(F.col("turns")))


def forked_paths(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Paths of conversations that begin with turns of their family's first one.

    Conversation c takes the first h turns of conversation c - c % family (all if
    fewer, none if absent) and its own turns after its first h, where h is the
    crc32 of its decimal id modulo ``most``.
    """
    own = written(_ordered(conversations), "trie-turns")
    heads = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    rows = own.withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % family,
        "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")}).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.size("turns")))
    return rows.select("conv_id", *_path(turns))


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, children come after their parents."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), WIDTH):
                key = (node, path[at:at + WIDTH])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def choose_splitters(paths: DataFrame, shards: int | None = None) -> Skeleton:
    n, size = paths.agg(F.count("*"), F.sum(F.octet_length("path").cast("long"))).first()
    if shards is None:
        shards = max(paths.sparkSession.sparkContext.defaultParallelism, -(-(size or 0) // SHARD_BYTES))
    shards = min(shards, MAX_SHARDS)
    if not n or shards < 2:
        return Skeleton([])
    share = min(1.0, SAMPLE * shards / n)
    sample = paths.filter(F.pmod(F.xxhash64("conv_id", F.lit("splitter")), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = sorted((bytes(r["path"]), r["conv_id"]) for r in sample.select("path", "conv_id").collect())
    return Skeleton(sorted({rows[i * len(rows) // shards] for i in range(1, shards)} if rows else []))


class _Node:
    __slots__ = ("skeleton", "depth", "bytes", "least", "members", "children", "leaves", "saved", "ends", "held")

    def __init__(self, skeleton: int, depth: int, size: int):
        self.skeleton, self.depth, self.bytes = skeleton, depth, size
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.held = None, []


#: kind 0: a finished node, 1: a shard's part of a skeleton node (its depth is known, so ``depth`` carries
#: the bytes of its last text), 2: a piece of the ids that end at one.
PARTS = ("kind int, skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, shard int, place long, piece string")
_NAMES = [x.split()[0] for x in PARTS.split(", ")]
_TYPES = pa.schema(list(zip(_NAMES, [
    pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.string(), pa.int32(), pa.int64(), pa.string()])))


def walk(rows: Iterator[tuple[int, bytes, int, list[int]]], skeleton: Skeleton) -> Iterator[tuple]:
    """The parts of one sorted run of (shard, path, conv_id, bytes)."""
    out: list[tuple] = []
    stack: list[_Node] = []
    pieces = 0

    def flush(node: _Node, shard: int) -> None:
        nonlocal pieces
        out.append((2, node.skeleton, *[None] * 8, shard, pieces, "".join(node.ends)))
        node.ends, pieces = [], pieces + 1

    def close(shard: int) -> None:
        node = stack.pop()
        above = stack[-1] if stack else None
        if above:
            above.members += node.members
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton >= 0:
            if node.ends:
                flush(node, shard)
            out.append((1, node.skeleton, node.least, node.bytes, None, node.members, node.children, node.leaves,
                        node.saved, None, shard, None, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.members - 1) * node.bytes
        for child in node.held:
            out.append((0, None, child[0], child[1], node.least, *child[2:], None, None, None))
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        row = (node.least, node.depth, node.members, node.children, leaves, saved,
               node.ends.hexdigest() if node.ends else NOTHING)
        if above.skeleton >= 0:
            out.append((0, above.skeleton, row[0], row[1], None, *row[2:], None, None, None))
        else:
            above.held.append(row)

    before, shard = b"", 0
    for shard, path, conv_id, sizes in rows:
        if not stack:
            stack.append(_Node(0, 0, 0))
        length = len(path)
        if path == before:
            same = length // WIDTH
        else:
            at, end = 0, min(length, len(before))
            while at < end and path[at:at + WIDTH] == before[at:at + WIDTH]:
                at += WIDTH
            same = at // WIDTH
        while len(stack) - 1 > same:
            close(shard)
        for depth in range(same + 1, length // WIDTH + 1):
            up = stack[-1].skeleton
            step = path[(depth - 1) * WIDTH:depth * WIDTH]
            stack.append(_Node(skeleton.child.get((up, step), -1) if up >= 0 else -1, depth, sizes[depth - 1]))
        node = stack[-1]
        node.members += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.skeleton >= 0:
            node.ends = node.ends or []
            node.ends.append(f"{conv_id},")
            if len(node.ends) * 8 >= PIECE:
                flush(node, shard)
        elif node.ends:
            node.ends.update(b",%d" % conv_id)
        else:
            node.ends = hashlib.sha256(b"%d" % conv_id)
        before = path
        if len(out) >= BATCH:
            yield from out
            out.clear()
    while stack:
        close(shard)
    yield from out


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES.types)], schema=_TYPES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES.types)], schema=_TYPES)


def _parts(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Every shard's finished nodes, partial aggregates and pieces of ids."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)

    def place(batches):
        for batch in batches:
            ids, ways = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shards = pa.array(list(map(shared.value.shard, ways, ids)), pa.int32())
            yield pa.RecordBatch.from_arrays([shards, *batch.columns], ["shard", "conv_id", "path", "bytes"])

    def rows(batches):
        for batch in batches:
            conv_id, path, sizes, shard = (batch.column(c).to_pylist() for c in ("conv_id", "path", "bytes", "shard"))
            yield from zip(shard, path, conv_id, sizes)

    def run(batches):
        yield from _batches(walk(rows(batches), shared.value))

    dealt = paths.select("conv_id", "path", "bytes").mapInArrow(
        place, "shard int, conv_id long, path binary, bytes array<int>")
    dealt = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard"))
    return dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, PARTS)


def _ends(pieces: DataFrame) -> DataFrame:
    """skeleton, sha: digest of all ids that end at a node, from its pieces in order."""
    def run(batches):
        node, state = None, None
        found = []
        for batch in batches:
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != node:
                    if node is not None:
                        found.append((node, state[0], state[1]))
                    node, state = at, (hashlib.sha256(), "")
                # The comma after the last id of all does not count.
                state[0].update((state[1] + piece[:-1]).encode())
                state = (state[0], ",")
        if node is not None:
            found.append((node, state[0], state[1]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()),
                                          pa.array([x[1].hexdigest() for x in found], pa.string())],
                                         ["skeleton", "sha"])

    return (pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "place")
            .select("skeleton", "piece").mapInArrow(run, "skeleton int, sha string"))


NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


def _roll_up(skeleton: Skeleton, totals: list, ends: dict[int, str]) -> list[tuple]:
    """The finished skeleton nodes: one row each, from the leaves of the skeleton up."""
    found = {r["skeleton"]: r for r in totals}
    size = len(skeleton.parent)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):
        r = found[node]
        children[node] += r["n_children"]
        leaves[node] = leaves[node] + r["n_leaves"] if children[node] else 1
        saved[node] += r["saved_tokens"] + (r["n_convs"] - 1) * r["bytes"]
        if node:
            up = skeleton.parent[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    return [(found[k]["conv_id"], skeleton.depth[k], found[skeleton.parent[k]]["conv_id"] if k else None,
             found[k]["n_convs"], children[k], leaves[k], saved[k], ends.get(k, NOTHING)) for k in range(size)]


def build(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """Every node of the trie over ``paths`` (conv_id, path, bytes), one row of ``NODES`` each."""
    spark: SparkSession = paths.sparkSession
    paths = written(paths, "trie-paths")
    skeleton = choose_splitters(paths, shards)
    parts = written(_parts(paths, skeleton), "trie-parts")
    # One row for each node of the skeleton, which the driver itself broadcast.
    totals = parts.filter("kind = 1").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("bytes"), *[
            F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).collect()
    ends = {r["skeleton"]: r["sha"] for r in _ends(parts.filter("kind = 2")).collect()}
    rows = _roll_up(skeleton, totals, ends) if totals else []
    top = spark.createDataFrame(rows, NODES)
    first = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "skeleton int, first long")
    nodes = parts.filter("kind = 0").join(F.broadcast(first), "skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "first"))
    names = top.columns
    return nodes.select(*names).unionByName(top)


def forked_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations; the rows of the contract."""
    return build(forked_paths(conversations))


def members_of(paths: DataFrame, prefix: bytes) -> DataFrame:
    """conv_id of every conversation whose path begins with the given one."""
    return paths.filter(F.substring("path", 1, len(prefix)) == F.lit(prefix)).select("conv_id")
