"""Hard negatives by STR-packed R-trees.

The vectors are dealt into ranges of the coordinate that varies most; every range
is cut into blocks, and every block is sort-tile packed on the next two
coordinates into leaves of ``LEAF`` vectors, slabs of leaves above them, each with
its minimum bounding box.  A box gives an interval for its vectors' inner products
with an anchor, coordinate by coordinate.  A best-first queue opens boxes by the
upper end of that interval, skips those outside every score window that still
counts, and stops once the best box left is strictly below the kth score found
(a box that could only tie is opened, as a smaller id may win).

1. Positives: the first ``POSITIVES`` other rows of the anchor's label.
2. Negatives: for each positive's score window the first ``NEGATIVES`` rows of
   another label.

Anchors go in batches of ``ANCHORS``, and each batch is searched against each
range of the index by one task, which reads both from the shared folder, one block
at a time, and returns at most k rows for each anchor and window.  These are
merged by a ranked window that Spark limits before its shuffle.  All rows with a
wanted id are anchors and all rows are indexed; nothing but the column statistics
and one row for each index file reaches the driver.

Scores are exact: inner products of whole numbers in doubles below 2**53, and in
Python's integers, held to the range of a long, where a product might pass that.

Defined results: rows with a null id, label, vector or component or a non-finite
component take no part; rows repeated whole count once; a missing component of a
shorter vector is zero; rows that share an id are rows of their own; other columns
are ignored; no anchors, positives or negatives give no rows.
"""

from __future__ import annotations

import heapq
import io
import uuid
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import new_folder, written
from strata.llm.warc import _filesystem

#: Small leaves skip more rows of clustered vectors, large ones cost fewer steps where little can be skipped.
LEAF = 512
BLOCK = 8192
#: Blocks of one index file: what one task searches a batch of anchors against.
BLOCKS = 16
ANCHORS = 128
POSITIVES = 5
NEGATIVES = 3
SCALE = 256
#: A negative's score lies within these percentages of its positive's.
LOW, HIGH = 50, 95
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v (components as doubles) of the rows that take part, each once.

    Every seventh id carries its neighbour's label, as the noise to be mined against.
    """
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             v.alias("v")).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.withColumn("label", noisy).distinct()


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Whole-number components of an Arrow list column, short vectors filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = np.floor(SCALE * column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]])
    size = np.diff(offsets)
    width = max(size.max(initial=0), width or 0)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


class Shape:
    """What the index needs to know of all rows: size, width, coordinates by variance, exactness of doubles."""

    def __init__(self, rows: DataFrame):
        def run(batches):
            n, total, square, top = 0, np.zeros(0), np.zeros(0), 0.0
            for batch in batches:
                m = _matrix(batch.column(0), len(total))
                grow = m.shape[1] - len(total)
                n, total, square = n + len(m), np.pad(total, (0, grow)), np.pad(square, (0, grow))
                total += m.sum(axis=0)
                square += (m * m).sum(axis=0)
                top = max(top, np.abs(m).max(initial=0.0))
            yield pa.RecordBatch.from_arrays([
                pa.array([n]), pa.array([top]), pa.array([total], pa.list_(pa.float64())),
                pa.array([square], pa.list_(pa.float64()))], ["n", "top", "total", "square"])

        found = rows.select("v").mapInArrow(
            run, "n long, top double, total array<double>, square array<double>").collect()  # one row for each task
        self.n = sum(r["n"] for r in found)
        self.width = max((len(r["total"]) for r in found), default=0)
        sums = np.zeros((2, self.width))
        for r in found:
            sums[0, :len(r["total"])] += r["total"]
            sums[1, :len(r["square"])] += r["square"]
        with np.errstate(all="ignore"):
            spread = np.nan_to_num(sums[1] - sums[0] ** 2 / max(self.n, 1), posinf=np.finfo(float).max)
        self.axes = [int(x) for x in np.argsort(-spread, kind="stable")]
        top = max((r["top"] for r in found), default=0.0)
        self.exact = top * top * max(self.width, 1) < 2 ** 53
        self.small = top < 2 ** 31


class _Pile:
    """A file of blobs, whole under its own name or absent."""

    def __init__(self, path: str):
        self.path = path
        self.files, self.place = _filesystem(path)
        self.attempt = f"{self.place}.{uuid.uuid4().hex}.part"
        self.out, self.at = self.files.open_output_stream(self.attempt), 0

    def add(self, arrays: dict[str, np.ndarray]) -> tuple[int, int]:
        held = io.BytesIO()
        np.savez(held, **arrays)
        blob = held.getvalue()
        self.out.write(blob)
        self.at += len(blob)
        return self.at - len(blob), len(blob)

    def close(self) -> None:
        self.out.close()
        if self.files.get_file_info(self.place).type != pafs.FileType.NotFound:
            self.files.delete_file(self.attempt)  # another attempt made the same file
        else:
            self.files.move(self.attempt, self.place)


def _load(path: str, places: list[tuple[int, int]]) -> Iterator[dict[str, np.ndarray]]:
    files, place = _filesystem(path)
    with files.open_input_file(place) as f:
        for offset, length in places:
            with np.load(io.BytesIO(f.read_at(length, offset))) as held:
                yield {k: held[k] for k in held.files}


def str_pack(vectors: np.ndarray, ids: np.ndarray, axes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile order of the rows, and the number of leaves in each slab.

    Slabs of whole leaves along the first axis, runs of ``LEAF`` rows along the second in each slab.
    """
    n = len(ids)
    leaves = -(-n // LEAF)
    slabs = int(np.ceil(np.sqrt(leaves)))
    rows = -(-leaves // slabs) * LEAF
    first, second = (vectors[:, a] if a is not None else ids for a in (axes + [None, None])[:2])
    order = np.lexsort((ids, first))
    for start in range(0, n, rows):
        part = order[start:start + rows]
        order[start:start + rows] = part[np.lexsort((ids[part], second[part]))]
    return order, np.array([-(-min(rows, n - s) // LEAF) for s in range(0, n, rows)], np.int64)


def _boxes(low: np.ndarray, high: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)


def build_index(rows: DataFrame, shape: Shape, folder: str) -> dict[int, list[tuple[int, int]]]:
    """Index files of all rows in ``folder``: the places of each file's blocks."""
    files = max(rows.sparkSession.sparkContext.defaultParallelism, -(-shape.n // (BLOCK * BLOCKS)))
    key = F.coalesce(F.get("v", F.lit(shape.axes[0])), F.lit(0.0)) if shape.axes else F.lit(0.0)
    dealt = (rows.withColumn("_key", key).repartitionByRange(files, "_key", "vec_id", "label")
             .sortWithinPartitions("_key", "vec_id", "label").select("vec_id", "label", "v"))
    axes, width, small = shape.axes[1:3], shape.width, shape.small

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK - size)
                at += part.num_rows
                size += part.num_rows
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2), width)))
                if size == BLOCK:
                    yield [np.concatenate(x) for x in zip(*held)]
                    held, size = [], 0
        if held:
            yield [np.concatenate(x) for x in zip(*held)]

    def run(batches):
        part, pile, places = TaskContext.get().partitionId(), None, []
        for ids, labels, vectors in blocks(batches):
            order, slabs = str_pack(vectors, ids, axes)
            ids, labels, vectors = ids[order], labels[order], vectors[order]
            starts = np.arange(0, len(ids), LEAF)
            low, high = _boxes(vectors, vectors, starts)
            above = np.cumsum(slabs) - slabs
            slab_low, slab_high = _boxes(low, high, above)
            pile = pile or _Pile(f"{folder}/index-{part:05d}")
            places.append(pile.add({
                "ids": ids, "labels": labels, "vectors": vectors.astype(np.int32) if small else vectors,
                "leaf_low": low, "leaf_high": high, "leaf_id": np.minimum.reduceat(ids, starts),
                "slab_low": slab_low, "slab_high": slab_high, "slab_start": np.append(above, len(starts))}))
        if pile:
            pile.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([[x for p in places for x in p]], pa.list_(pa.int64()))],
                ["part", "places"])

    found = dealt.mapInArrow(run, "part int, places array<long>").collect()  # one row for each index file
    return {r["part"]: list(zip(r["places"][::2], r["places"][1::2])) for r in found}


def _anchor_batches(rows: DataFrame, shape: Shape, folder: str, every: int) -> DataFrame:
    """batch, path, offset, length of each batch of anchors."""
    width, small = shape.width, shape.small

    def run(batches):
        part, pile, out = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHORS):
                few = batch.slice(at, ANCHORS)
                pile = pile or _Pile(f"{folder}/anchors-{part:05d}")
                vectors = _matrix(few.column(2), width)
                place = pile.add({"ids": few.column(0).to_numpy(), "labels": few.column(1).to_numpy(),
                                  "vectors": vectors.astype(np.int32) if small else vectors})
                out.append(((part << 32) + len(out), pile.path, *place))
        if pile:
            pile.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["batch", "path", "offset", "length"])

    anchors = rows.filter(F.col("vec_id") % every == 0)
    # The order makes a task that runs twice write the same file.
    files = max(1, -(-shape.n // (every * ANCHORS * 32)))
    anchors = anchors.coalesce(files).sortWithinPartitions("vec_id", "label", "v")
    return written(anchors.mapInArrow(run, "batch long, path string, offset long, length long"), "hard-anchors")


class Best:
    """The first k (score, id) of one window of scores: higher scores first, then smaller ids."""

    __slots__ = ("k", "low", "high", "held")

    def __init__(self, k: int, low=-np.inf, high=np.inf):
        self.k, self.low, self.high, self.held = k, low, high, []

    def floor(self):
        """Scores below this do not count any more."""
        return max(self.low, -self.held[-1][0]) if len(self.held) == self.k else self.low

    def open_to(self, low, high, least_id: int) -> bool:
        """Whether a box of these scores, with this smallest id, can still add a row."""
        if high < self.low or low > self.high:
            return False
        if len(self.held) < self.k:
            return True
        worst, high = self.held[-1], min(high, self.high)
        return high > -worst[0] or (high == -worst[0] and least_id < worst[1])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        hit = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        rows = zip((-scores[hit]).tolist(), ids[hit].tolist())
        for row in sorted(rows)[:self.k] if len(hit) > self.k else rows:
            insort(self.held, row)
        del self.held[self.k:]


class Tree:
    """One block of the index, ready to be searched."""

    def __init__(self, block: dict[str, np.ndarray], exact: bool):
        self.exact = exact
        for name, value in block.items():
            whole = name in ("vectors", "leaf_low", "leaf_high", "slab_low", "slab_high")
            setattr(self, name, numbers(value, exact) if whole else value)
        self.slab_start = self.slab_start.tolist()
        self.leaf_id = self.leaf_id.tolist()

    def intervals(self, q: np.ndarray) -> tuple[list, list, list, list]:
        """For each anchor: low and high ends of the scores in every leaf and every slab."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        ends = []
        for low, high in ((self.leaf_low, self.leaf_high), (self.slab_low, self.slab_high)):
            ends.append(held(up @ low.T + down @ high.T, self.exact).tolist())
            ends.append(held(up @ high.T + down @ low.T, self.exact).tolist())
        return tuple(ends)

    def search(self, q: np.ndarray, ends: tuple[list, list, list, list], keep, bests: list[Best]) -> int:
        """Bring ``bests`` up to date with this block; returns the number of leaves opened.

        ``keep`` says which rows of a leaf count.  Slabs have numbers below zero in the queue.
        """
        leaf_low, leaf_high, slab_low, slab_high = ends
        queue = [(-high, -1 - i) for i, high in enumerate(slab_high)]
        heapq.heapify(queue)
        opened = 0
        while queue:
            high, box = heapq.heappop(queue)
            high = -high
            if all(high < b.floor() for b in bests):
                break
            if box < 0:
                slab = -1 - box
                for leaf in range(self.slab_start[slab], self.slab_start[slab + 1]):
                    for b in bests:
                        if b.open_to(leaf_low[leaf], leaf_high[leaf], self.leaf_id[leaf]):
                            heapq.heappush(queue, (-leaf_high[leaf], leaf))
                            break
                continue
            live = [b for b in bests if b.open_to(leaf_low[box], high, self.leaf_id[box])]
            if not live:
                continue
            opened += 1
            part = slice(box * LEAF, (box + 1) * LEAF)
            rows = keep(part)
            if len(rows):
                rows = rows + part.start
                scores, ids = held(self.vectors[rows] @ q, self.exact), self.ids[rows]
                for b in live:
                    b.add(scores, ids)
        return opened


def numbers(values: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return values.astype(np.float64)
    flat = np.array([int(x) for x in values.reshape(-1).tolist()], object)
    return flat.reshape(values.shape)


def held(scores: np.ndarray, exact: bool) -> np.ndarray:
    """Scores within the range of a long."""
    return scores if exact else np.clip(scores, _LEAST, _MOST)


def window_of(score: int) -> tuple[int, int]:
    """Least and greatest score of a hard negative beside a positive of this score."""
    return -(-LOW * score // 100), HIGH * score // 100


FOUND = "batch long, row int, anchor_id long, aim long, score long, id long"
_FOUND = pa.schema([("batch", pa.int64()), ("row", pa.int32()), ("anchor_id", pa.int64()), ("aim", pa.int64()),
                    ("score", pa.int64()), ("id", pa.int64())])


def _search(pairs: DataFrame, shape: Shape, folder: str, index: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """The first rows of each batch of anchors in each index file.

    ``pairs`` has batch, path, offset, length, parts, aims; ``aims`` null asks for
    positives, else it lists (row, score of a positive) and asks for negatives.
    What one file gives prunes the boxes of the next.
    """
    exact = shape.exact

    def blocks(parts: list[int]) -> Iterator[dict[str, np.ndarray]]:
        for part in parts:
            yield from _load(f"{folder}/index-{part:05d}", index[part])

    def run(batches):
        for batch in batches:
            for number, path, offset, length, parts, aims in zip(*(c.to_pylist() for c in batch.columns)):
                anchors = next(_load(path, [(offset, length)]))
                q, labels = numbers(anchors["vectors"], exact), anchors["labels"].tolist()
                if aims is None:
                    bests = {row: {0: Best(POSITIVES)} for row in range(len(q))}
                else:
                    bests = {}
                    for aim in aims:
                        low, high = window_of(aim["score"])
                        if low <= high:
                            bests.setdefault(aim["row"], {})[aim["score"]] = Best(NEGATIVES, low, high)
                for block in blocks(parts):
                    tree = Tree(block, exact)
                    ends = tree.intervals(q)
                    for row, wanted in bests.items():
                        tree.search(q[row], tuple(e[row] for e in ends), _rule(
                            tree, aims is None, labels[row], anchors["ids"][row], q[row]), list(wanted.values()))
                rows = [(number, row, int(anchors["ids"][row]), aim, int(-s), i)
                        for row, wanted in bests.items() for aim, b in wanted.items() for s, i in b.held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, _FOUND.types)], schema=_FOUND)

    return pairs.select("batch", "path", "offset", "length", "parts", "aims").mapInArrow(run, FOUND)


def _groups(index: dict[int, list], limit: int) -> list[list[int]]:
    """Index files that one task searches, one behind the other: of at most ``limit`` blocks, one file at least."""
    out: list[list[int]] = []
    size = 0
    for part in sorted(index):
        if not out or size + len(index[part]) > limit:
            out.append([])
            size = 0
        out[-1].append(part)
        size += len(index[part])
    return out


def _rule(tree: Tree, same: bool, label: int, anchor_id: int, q: np.ndarray):
    """Which rows of a leaf count: the anchor's label without itself, or any other label."""
    def keep(part: slice) -> np.ndarray:
        if not same:
            return np.flatnonzero(tree.labels[part] != label)
        rows = np.flatnonzero(tree.labels[part] == label)
        own = tree.ids[part][rows] == anchor_id
        if own.any():
            vectors = tree.vectors[part][rows]
            rows = rows[[not (o and (v == q).all()) for o, v in zip(own.tolist(), vectors)]]
        return rows

    return keep


def _first(found: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def mine(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every hard negative."""
    spark = embeddings.sparkSession
    rows = written(usable_rows(embeddings), "hard-rows")
    shape = Shape(rows)
    folder = new_folder(spark, "hard-index")
    files, place = _filesystem(folder)
    files.create_dir(place, recursive=True)
    index = build_index(rows, shape, folder)
    batches = _anchor_batches(rows, shape, folder, every)
    # Enough tasks for the cluster, and no more partial results than that takes.
    searches = batches.count() * sum(map(len, index.values()))
    groups = _groups(index, min(BLOCKS, -(-searches // (4 * spark.sparkContext.defaultParallelism))))
    parts = F.array(*[F.array(*map(F.lit, g)) for g in groups]).cast("array<array<int>>")
    tasks = max(1, min(4096, batches.count() * len(groups)))

    def pairs(asked: DataFrame) -> DataFrame:
        return asked.withColumn("parts", F.explode(parts)).repartition(tasks)

    aims = "array<struct<row:int,score:bigint>>"
    found = _search(pairs(batches.withColumn("aims", F.lit(None).cast(aims))), shape, folder, index)
    positives = written(_first(found, ["batch", "row"], POSITIVES, "place"), "hard-positives")
    asked = positives.groupBy("batch").agg(F.collect_set(F.struct("row", "score")).alias("aims"))
    asked = batches.join(asked, "batch").withColumn("aims", F.col("aims").cast(aims))
    found = _search(pairs(asked), shape, folder, index)
    negatives = written(_first(found, ["batch", "row", "aim"], NEGATIVES, "rank"), "hard-negatives").select(
        "batch", "row", "rank", F.col("aim").alias("score"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return positives.join(negatives, ["batch", "row", "score"]).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score")
