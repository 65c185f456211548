"""Substring dedup by seed and extend.

A window is ``LENGTH`` consecutive words of one document; a word goes if a window
that covers it also starts earlier (a smaller doc_id, or an earlier start in the
same document).

1. *Seeds.*  Winnowing: of the word k-grams inside each window the one of the
   smallest hash is its anchor (the last of equals).  Which place it has depends
   on the window's words alone, so equal windows have equal anchors at equal
   places, and a window can occur twice only if its anchor does.  Neighbouring
   windows with the same anchor form a block.
2. *Join.*  Anchors that occur more than once are found by a count with partial
   sums, and joined back: only their blocks go on.
3. *Extend.*  A block extends its anchor both ways, from the first word of its
   first window to the last word of its last.  A block equal to an earlier one is
   repeated as a whole.  Of blocks that differ although they share an anchor, the
   first of each kind is compared window by window.
4. *Maximal repeats.*  The repeated windows of a document merge into maximal
   ranges, and their words go.

No pairs are formed: each step keeps the earliest place of a hash, an aggregate
with partial sums, and joins it back on the hash, where Spark can split a hot
one.  So a group of copies costs as much as other text of that size.  Sequences
are compared by 64-bit hashes of their words (see ``common.Spans``).

Defined results: a null or empty text has no words; a document shorter than a
window keeps everything; rows that share a doc_id are told apart by a hash of
their text, and whole repeated rows share one result, as neither starts earlier;
null doc_ids come first; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Spans, bytes_of, long_of, release, window_starts, word_hashes, written

LENGTH = 20
GRAM = 6
CHUNK_BYTES = 1 << 20


def _last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, where the smallest of values[i:i+width] lies, the last of equals."""
    best = np.arange(len(values))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        reach += step
    return best


def blocks_of(words: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Blocks of all texts: (anchor hash, block hash, first window, last window) as word places."""
    windows = window_starts(starts, length)
    if not len(windows):
        return None
    spans = Spans(words)
    at = np.arange(len(words) - gram + 1)
    anchor = _last_smallest(spans.hash(at, at + gram), length - gram + 1)[windows]
    owner = np.searchsorted(starts, windows, "right")
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([new[1:], [len(windows)]]) - 1
    first, last, anchor, owner = windows[new], windows[last], anchor[new], owner[new] - 1
    seed = spans.hash(anchor, anchor + gram)
    with np.errstate(over="ignore"):
        whole = spans.hash(first, last + length) + (anchor - first).astype(np.uint64)
    return seed, whole, first - starts[owner], last - starts[owner], owner


def _chunks(batch: pa.RecordBatch, column: int):
    """Texts of a batch with their row numbers, in chunks of bounded size."""
    chunk, rows, held = [], [], 0
    for i, text in enumerate(bytes_of(batch.column(column))):
        chunk.append(text)
        rows.append(i)
        held += len(text)
        if held > CHUNK_BYTES:
            yield chunk, np.array(rows)
            chunk, rows, held = [], [], 0
    if chunk:
        yield chunk, np.array(rows)


def _identity(docs: DataFrame) -> DataFrame:
    """doc_id, a tie-breaker among rows of one id, and text."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _tie(texts: list[bytes]) -> np.ndarray:
    return long_of(np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64))


_BLOCK = pa.schema([("seed", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()),
                    ("first", pa.int32()), ("last", pa.int32())])
_WINDOW = pa.schema([("window", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("first", pa.int32())])


def _seed_blocks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for texts, rows in _chunks(batch, 1):
                words, starts = word_hashes(texts)
                found = blocks_of(words, starts, length, gram)
                if found is None:
                    continue
                seed, whole, first, last, owner = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(long_of(seed)), pa.array(long_of(whole)), batch.column(0).take(pa.array(rows[owner])),
                     pa.array(_tie(texts)[owner]), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                    schema=_BLOCK)

    return _identity(docs).mapInArrow(run, "seed long, block long, doc_id long, tie long, first int, last int")


def _block_windows(texts: DataFrame, length: int) -> DataFrame:
    """The single windows of each row's blocks (doc_id, tie, text, ranges)."""
    def run(batches):
        for batch in batches:
            for texts, rows in _chunks(batch, 2):
                words, starts = word_hashes(texts)
                spans = Spans(words)
                at, owner = [], []
                for i, r in enumerate(rows):
                    for x in batch.column(3)[int(r)].as_py():
                        got = np.arange(x["first"], x["last"] + 1)
                        at.append(got + starts[i])
                        owner.append(np.full(len(got), i))
                at, owner = np.concatenate(at), np.concatenate(owner)
                take = pa.array(rows[owner])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(long_of(spans.hash(at, at + length))), batch.column(0).take(take),
                     batch.column(1).take(take), pa.array(at - starts[owner], pa.int32())], schema=_WINDOW)

    return texts.mapInArrow(run, "window long, doc_id long, tie long, first int")


def _later(places: DataFrame, key: list[str], at: list[str]) -> DataFrame:
    """Rows of ``places`` that have an earlier row of the same key, by ``at``."""
    first = (places.groupBy(*key).agg(F.min(F.struct(*at)).alias("_first"), F.count("*").alias("_n"))
             .filter("_n > 1").drop("_n"))
    # Written first: a join of two plain shuffles is one whose hot keys Spark can split.
    first = written(first, "substring-first")
    return places.join(first, key).filter(F.struct(*at) > F.col("_first")).drop("_first")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, tie, ranges: the starts of repeated windows, as an array of struct<first, last>."""
    spark = docs.sparkSession
    blocks = _seed_blocks(docs, length, gram)
    often = blocks.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    seeds = written(blocks.join(written(often, "substring-often"), "seed"), "substring-seeds")
    release(spark)

    whole = _later(seeds, ["seed", "block"], ["doc_id", "tie", "first"]).select("doc_id", "tie", "first", "last")
    kinds = seeds.groupBy("seed", "block").agg(F.min(F.struct("doc_id", "tie", "first", "last")).alias("x"))
    several = kinds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    edges = kinds.join(written(several, "substring-several"), "seed").select("x.*")

    # Ranges of one document are bounded by its own words.
    ranges = edges.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    texts = _identity(docs).withColumn("tie", _tie_column())
    with_text = texts.alias("t").join(
        ranges.alias("r"), F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.tie") == F.col("r.tie")))
    single = _block_windows(with_text.select("t.doc_id", "t.tie", "t.text", "r.ranges"), length)
    single = written(single, "substring-windows")
    parts = _later(single, ["window"], ["doc_id", "tie", "first"]).select(
        "doc_id", "tie", "first", F.col("first").alias("last"))
    return (whole.unionByName(parts).groupBy("doc_id", "tie")
            .agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("ranges")))


def _tie_column():
    """The tie-breaker computed beside the text, by the same hash as in the seeds."""
    @F.pandas_udf("long")
    def tie(text):
        import pandas as pd
        return pd.Series(_tie([t.encode() for t in text]))

    return tie("text")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept_text``) of every row."""
    ranges = written(repeated_ranges(docs, length, gram), "substring-ranges")
    release(docs.sparkSession)
    texts = _identity(docs).withColumn("tie", _tie_column())
    both = texts.alias("t").join(
        ranges.alias("r"), F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.tie") == F.col("r.tie")), "left")

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for text, found in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for x in found or ():
                    gone[x["first"]] += 1
                    gone[x["last"] + length] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                kept = b" ".join([w for w, k in zip(words, keep) if k]) if found else b" ".join(words)
                out[0].append(len(words))
                out[1].append(int(len(words) - keep.sum()))
                out[2].append(hashlib.sha256(kept).hexdigest())
                out[3].append(kept.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string()), pa.array(out[3], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    done = both.select("t.doc_id", "t.text", "r.ranges").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return done if with_text else done.drop("kept_text")
