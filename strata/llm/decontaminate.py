"""Benchmark decontamination by latent semantic retrieval.

1. *TF-IDF passages.*  Words of the benchmark items are the terms; words of the
   documents that no item has weigh nothing.  Document frequencies count every
   passage of every document.
2. *Randomised SVD.*  With A the passages x terms matrix and W a Gaussian test
   matrix, one distributed pass gives Z = A'(AW), summed term by term with partial
   sums; the driver gets terms x rank numbers and finishes the eigenproblem of A'A
   from Z alone (single-pass method of Halko, Martinsson and Tropp).
3. *Cosine search.*  Passages with too few answer words for any item fail the check of
   step 4 whatever their cosine, and are passed over.  The second pass folds all others,
   of every document, into the latent space and compares them with the items,
   block by block: the items are the query set.  Passages are cut for each class
   of item lengths, so that an item fills more than half of a passage that holds
   it whole.
4. *Checks.*  A candidate stands if the longest common subsequence of item and
   passage has ``LCS`` of the item's words and if ``ANSWER`` of the item's rarest
   words, its answer, are in the passage: that finds paraphrases that keep most
   words in order, and lets shared vocabulary go.

Items of fewer than ``LEAST`` words have too few words for steps 1 to 4.  The second
pass finds them by the hash of all their words as an exact run of words, with
cosine 1.

Both passes are narrow; what is shuffled are sums by term, and then the matches.
Distinct items are taken by hash in blocks of about ``BLOCK_WORDS`` words, so what
the driver collects and broadcasts (item words, terms x rank floats) is bounded by
a parameter; more words mean more passes.  Whole texts are read, in chunks of
bounded size.

Defined results: words are lower-cased (A-Z) and freed of ASCII punctuation at
both ends; null and empty texts match nothing; items of one
or two words (fewer than ``EXACT``) are too short to tell and match nothing; items with equal texts match
alike; repeated document rows give one row per item; rows without an id are
never matched; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD_RULE, Spans, bytes_of, window_starts, written

RANK = 64
PASSAGE = 64
COSINE = 0.4
LCS = 0.6
ANSWER = 0.6
ANSWER_WORDS = 5
LEAST = 8
EXACT = 3
BLOCK_WORDS = 200_000
SHRINK = 0.75
CHUNK_BYTES = 1 << 19
SEED = 11
_EDGE = string.punctuation.encode()


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words without punctuation at their ends; words of punctuation alone go."""
    return [w for w in [x.strip(_EDGE) for x in text.lower().split()] if w]


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    digest, parts, starts = xxhash.xxh3_64_intdigest, [], [0]
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        starts.append(starts[-1] + len(words))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(starts, np.int64)


def _chunks(texts: list[bytes]):
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held > CHUNK_BYTES:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _passages(starts: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the passages of all texts; the last ones end with their text."""
    n = np.diff(starts)
    counts = np.where(n > 0, np.maximum(-(-(n - width) // stride), 0) + 1, 0)
    owner = np.repeat(np.arange(len(n)), counts)
    offset = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
    first = starts[owner] + offset
    return first, np.minimum(first + width, starts[owner + 1]), owner


class Items:
    """A block of benchmark items: terms, and each item as a sequence of term numbers.

    Short items come after the others, by their length and the hash of their words.
    """

    def __init__(self, rows: list[tuple[int, str]]):
        found = [(i, _hashes([t.encode()])[0]) for i, t in rows]
        short = sorted(((i, h) for i, h in found if EXACT <= len(h) < LEAST), key=lambda x: (len(x[1]), x[0]))
        found = sorted(((i, h) for i, h in found if len(h) >= LEAST), key=lambda x: (len(x[1]), x[0]))
        self.ids = [i for i, _ in found + short]
        self.sizes = [len(h) for _, h in found + short]
        self.runs: dict[int, dict[int, list[int]]] = {}  # length: hash of the words: items
        for k, (_, h) in enumerate(short, len(found)):
            whole = int(Spans(h).hash(np.array([0]), np.array([len(h)]))[0])
            self.runs.setdefault(len(h), {}).setdefault(whole, []).append(k)
        self.terms = np.unique(np.concatenate([h for _, h in found])) if found else np.empty(0, np.uint64)
        self.words = [np.searchsorted(self.terms, h) for _, h in found]
        self.classes = []  # (first item, end, longest)
        at = len(found)
        while at:
            longest = len(self.words[at - 1])
            first = next(k for k in range(at) if len(self.words[k]) > SHRINK * longest)
            self.classes.append((first, at, longest))
            at = first

    def exact(self, hashes: np.ndarray, starts: np.ndarray):
        """(place, item) of every short item that stands in a text as it is."""
        spans = Spans(hashes) if self.runs else None
        for size, wanted in self.runs.items():
            at = window_starts(starts, size)
            runs = spans.hash(at, at + size)
            for k in np.flatnonzero(np.isin(runs, np.array(list(wanted), np.uint64))):
                for item in wanted[int(runs[k])]:
                    yield int(at[k]), item

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each word, the number of terms where it is none."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, len(self.terms))


def _term_sums(docs: DataFrame, items: Items) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Number of passages, document frequencies, and Z without the term weights."""
    count = len(items.terms)
    test = np.random.default_rng(SEED).standard_normal((count + 1, RANK)).astype(np.float32)
    test[count] = 0
    shared = docs.sparkSession.sparkContext.broadcast((items, test))  # at most about BLOCK_WORDS words of items
    names = [f"z{k}" for k in range(RANK)]

    def run(batches):
        items, test = shared.value
        sums, often, total = np.zeros((count + 1, RANK)), np.zeros(count + 1), 0
        for batch in batches:
            for _, texts in _chunks(bytes_of(batch.column(0))):
                hashes, starts = _hashes(texts)
                first, end, _ = _passages(starts, PASSAGE, PASSAGE)
                if not len(first):
                    continue
                total += len(first)
                number = items.numbers(hashes)
                place = np.searchsorted(first, np.arange(len(number)), "right") - 1
                keep = number < count
                key, times = np.unique(place[keep] * np.int64(count) + number[keep], return_counts=True)
                passage, term = key // count, key % count
                often += np.bincount(term, minlength=count + 1)
                weight = times[:, None].astype(np.float32)
                cuts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]])) if len(key) else []
                if not len(key):
                    continue
                folded = np.add.reduceat(test[term] * weight, cuts, axis=0)
                row = np.cumsum(np.concatenate([[0], (passage[1:] != passage[:-1]).astype(np.int64)]))
                order = np.argsort(term, kind="stable")
                part = folded[row[order]] * weight[order]
                term = term[order]
                heads = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
                sums[term[heads]] += np.add.reduceat(part, heads, axis=0)
        if total:
            sums, often = sums.copy(), often.copy()
            often[count] = total  # the row after the terms counts the passages
            at = np.flatnonzero(often)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(often[at])] + [pa.array(sums[at, k]) for k in range(RANK)],
                ["term", "often", *names])

    out = (docs.select("text").mapInArrow(run, "term int, often double, " + ", ".join(f"{n} double" for n in names))
           .groupBy("term").agg(F.sum("often").alias("often"), *[F.sum(n).alias(n) for n in names])
           .toArrow())  # one row for each term of the block
    sums, often = np.zeros((count + 1, RANK)), np.zeros(count + 1)
    at = out.column("term").to_numpy()
    often[at] = out.column("often").to_numpy()
    for k, n in enumerate(names):
        sums[at, k] = out.column(n).to_numpy()
    return often[count], often[:count], sums[:count], test[:count].astype(float)


def latent_space(total: float, often: np.ndarray, sums: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """idf of the terms, and the map from term counts into the latent space (one row for each term)."""
    idf = np.log((total + 1) / (often + 1)) + 1
    z, w = idf[:, None] * sums, test / idf[:, None]  # Z = A'A W for the weighted A
    q, _ = np.linalg.qr(z)
    core = (q.T @ z) @ np.linalg.pinv(q.T @ w)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-9 * max(values.max(initial=0), 1e-300)
    basis = q @ vectors[:, keep]
    return idf, idf[:, None] * basis / values[keep] ** 0.25


def common_subsequence(item: list[int], passage: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors of the item."""
    places: dict[int, int] = {}
    for i, t in enumerate(item):
        places[t] = places.get(t, 0) | 1 << i
    row = whole = (1 << len(item)) - 1
    for t in passage.tolist():
        at = places.get(t)
        if at is not None:
            met = row & at
            row = ((row + met) | (row - met)) & whole
    return len(item) - row.bit_count()


MATCH = "doc_id long, item_id long, cosine double, lcs_words int, item_words int, start_word int"


def _search(docs: DataFrame, items: Items, idf: np.ndarray, fold: np.ndarray, cosine: float) -> DataFrame:
    count = len(items.terms)
    table = np.zeros((count + 1, fold.shape[1]), np.float32)
    table[:count] = fold
    queries, answers = [], []
    for words in items.words:
        v = table[words].sum(axis=0)
        queries.append(v / max(np.linalg.norm(v), 1e-12))
        rare = sorted(set(words.tolist()), key=lambda t: (-idf[t], t))[:ANSWER_WORDS]
        answers.append(frozenset(rare))
    query = np.array(queries, np.float32)
    # For each class of items: which terms are answer words, and how many an item needs at least.
    asked = []
    for low, high, _ in items.classes:
        mask = np.zeros(count + 1, bool)
        mask[sorted(set().union(*answers[low:high]))] = True
        asked.append((mask, min(-(-int(100 * ANSWER) * len(x) // 100) for x in answers[low:high])))
    shared = docs.sparkSession.sparkContext.broadcast((items, table, query, answers, asked))  # at most about BLOCK_WORDS words of items

    def chunk_matches(texts: list[bytes]):
        items, table, query, answers, asked = shared.value
        hashes, starts = _hashes(texts)
        if not len(hashes):
            return
        for place, item in items.exact(hashes, starts):
            owner = int(np.searchsorted(starts, place, "right")) - 1
            yield owner, item, 1.0, items.sizes[item], int(place - starts[owner])
        if not items.words:
            return
        number = items.numbers(hashes)
        for (low, high, longest), (mask, need) in zip(items.classes, asked):
            stride = max(longest // 3, 1)
            first, end, owner = _passages(starts, longest + stride, stride)
            # A passage with too few answer words fails the check below whatever its cosine.
            seen = np.concatenate([[0], np.cumsum(mask[number])])
            able = np.flatnonzero(seen[end] - seen[first] >= need)
            first, end, owner = first[able], end[able], owner[able]
            for at in range(0, len(first), 1024):
                f, e = first[at:at + 1024], end[at:at + 1024]
                size = e - f
                cuts = np.cumsum(size) - size
                words = np.repeat(f - cuts, size) + np.arange(size.sum())
                vectors = np.add.reduceat(table[number[words]], cuts, axis=0)
                norm = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
                likeness = vectors @ query[low:high].T / norm[:, None]
                for p, k in zip(*np.nonzero(likeness >= cosine)):
                    place, item = at + p, low + int(k)
                    passage = number[first[place]:end[place]]
                    have = answers[item] & set(passage.tolist())
                    if 100 * len(have) < 100 * ANSWER * len(answers[item]):
                        continue
                    own = items.words[item].tolist()
                    common = common_subsequence(own, passage)
                    if common >= LCS * len(own):
                        yield (int(owner[place]), item, float(likeness[p, k]), common,
                               int(first[place] - starts[owner[place]]))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for start, texts in _chunks(bytes_of(batch.column(1))):
                best: dict[tuple[int, int], tuple] = {}
                for owner, item, likeness, common, at in chunk_matches(texts):
                    key, value = (owner, item), (-common, -likeness, at)
                    best[key] = min(best.get(key, value), value)
                for (owner, item), (common, likeness, at) in best.items():
                    if ids[start + owner] is not None:
                        rows.append((ids[start + owner], items.ids[item], -likeness, -common,
                                     items.sizes[item], at))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (
                        pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()))],
                    ["doc_id", "item_id", "cosine", "lcs_words", "item_words", "start_word"])

    return docs.select("doc_id", "text").mapInArrow(run, MATCH)


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    spark = docs.sparkSession
    named = written(benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct(), "items")
    words = F.size(F.regexp_extract_all(F.col("text"), F.lit(WORD_RULE), F.lit(0))).cast("long")
    blocks = max(1, -(-(named.agg(F.sum(words)).first()[0] or 0) // BLOCK_WORDS))
    found = None
    for block in range(blocks):
        part = named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        items = Items([(r.item_id, r.text) for r in part.collect()])  # about BLOCK_WORDS words
        if not items.ids:
            continue
        if items.words:
            total, often, sums, test = _term_sums(docs, items)
            if not total:
                continue
            space = latent_space(total, often, sums, test)
        else:
            space = np.empty(0), np.empty((0, 1))
        one = _search(docs, items, *space, cosine)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], MATCH)
    best = F.max(F.struct("lcs_words", "cosine", (-F.col("start_word")).alias("minus"), "item_words")).alias("x")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("x.cosine").alias("cosine"), F.col("x.lcs_words").alias("lcs_words"),
        F.col("x.item_words").alias("item_words"), (-F.col("x.minus")).alias("start_word"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows without an id stay."""
    names = docs.columns
    leaks = written(find_leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, F.col("doc_id") == F.col("_leak"), "left_anti").select(*[F.col(f"`{c}`") for c in names])
