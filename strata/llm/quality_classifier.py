"""Quality classifier: supervised subword embeddings.

Every word, pair of neighbouring words and character n-gram hashes into a table
of learned vectors; a document is the average of its features' vectors, and a
softmax over two classes scores it.  Vectors and output weights are trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents
(``SAMPLE`` documents, in hash order of their ids); every document is scored on
its whole text.

Scoring is one narrow stage: the output is linear in the average, so each table
row folds into one number, and a document costs one gather per feature.  What
is broadcast is that folded table, whose size is a parameter.  Features are
made for whole Arrow batches with numpy, so a long text costs as much as the
same words in many short ones.

Defined results: null and empty texts have no features and get the score of the
bias alone; repeated rows get equal scores; other columns are ignored; an empty
table gives an empty result.  Without labelled rows of both classes training
fails with a clear error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bytes_of, mixed, word_hashes, written

SAMPLE = 2000
#: Text bytes that training reads at most; both bounds are parameters of the sample.
SAMPLE_BYTES = 64 << 20
BUCKETS = 1 << 18
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
GRAMS = (3, 4)
CHUNK_BYTES = 1 << 20
THRESHOLD = 0.7


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams that hold no white space inside, and their text's number."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where(space, np.uint8(32), data).astype(np.uint64)
    hashes, owners = [], []
    for n in GRAMS:
        count = len(data) - n + 1
        if count <= 0:
            continue
        code, ok = data[:count].copy(), np.ones(count, bool)
        for k in range(1, n):
            code = code << np.uint64(8) | data[k:count + k]
            if k < n - 1:
                ok &= ~space[k:count + k]
        ok &= ~(space[:count] & space[n - 1:])
        at = np.flatnonzero(ok)
        hashes.append(mixed(code[at] + np.uint64(n) * np.uint64(0xD1B54A32D192ED03)))
        owners.append(owner[np.minimum(at, len(owner) - 1)])
    return np.concatenate(hashes or [np.empty(0, np.uint64)]), np.concatenate(owners or [np.empty(0, np.int64)])


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all features of ``texts`` and the number of the text each belongs to."""
    words, starts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    with np.errstate(over="ignore"):
        same = owner[1:] == owner[:-1]
        left, right = words[:-1][same], words[1:][same]
        pairs = mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)
        pairs[left == right] = 1  # a word said twice is one feature, whatever the word
        grams, gram_owner = _grams(texts)
    every = np.concatenate([mixed(words), pairs, grams])
    return ((every >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), np.concatenate(
        [owner, owner[1:][same], gram_owner])


def _chunks(texts: list[bytes]):
    chunk, held = [], 0
    for text in texts:
        chunk.append(text)
        held += len(text)
        if held > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _bags(texts: list[bytes], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Table rows and their shares of each text."""
    rows, owner = features(texts, buckets)
    order = np.argsort(owner, kind="stable")
    rows, ends = rows[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))
    out = []
    for d in range(len(texts)):
        found, times = np.unique(rows[ends[d]:ends[d + 1]], return_counts=True)
        out.append((found.astype(np.int32), (times / max(times.sum(), 1)).astype(np.float32)))
    return out


@dataclass
class Model:
    vectors: np.ndarray  # bucket x dimension
    output: np.ndarray  # dimension x class
    bias: np.ndarray  # class

    def folded(self) -> np.ndarray:
        """Each table row's share of the difference between the two classes' outputs."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def train(texts: list[bytes], labels: list[int], buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """SGD over the documents, with both classes weighted alike and a falling rate."""
    y = np.asarray(labels, np.int64)
    if len(set(labels)) < 2:
        raise ValueError("training needs labelled documents of both classes")
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dimensions, 1 / dimensions, (buckets, dimensions)).astype(np.float32)
    output, bias = np.zeros((dimensions, 2), np.float32), np.zeros(2, np.float32)
    weight = len(y) / (2.0 * np.bincount(y, minlength=2))
    bags = [bag for chunk in _chunks(texts) for bag in _bags(chunk, buckets)]
    steps, total = 0, epochs * len(y)
    for _ in range(epochs):
        for d in rng.permutation(len(y)):
            step = rate * (1 - steps / total)
            steps += 1
            found, share = bags[d]
            mean = share @ table[found]
            z = mean @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[d]] -= 1
            p *= step * weight[y[d]]
            back = output @ p
            output -= np.outer(mean, p)
            bias -= 0.1 * p
            if len(found):
                table[found] -= np.outer(share * len(found) ** 0.5, back)
    return Model(table, output, bias)


def constant(labels: list[int]) -> Model:
    """What labels of one class, or none, tell: their share, drawn towards a half, for every document."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    return Model(np.zeros((1, 1), np.float32), np.zeros((1, 2), np.float32),
                 np.array([0, np.log(share / (1 - share))], np.float32))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE,
                    size_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """Labelled documents to learn from, in hash order of their ids: at most ``size``, and ``size_bytes`` of text.

    One text for each id, the smallest, however often its rows repeat; labels
    other than 0 and 1 teach nothing.
    """
    ids = (labels.filter(F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
           .groupBy("doc_id").agg(F.min("quality").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    order = [F.xxhash64("doc_id"), "doc_id"]  # at most `size` ids
    found = written(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality")), "labelled")
    taken, held = [], 0
    for r in found.select("doc_id", F.octet_length("text").alias("n")).orderBy(*order).collect():
        held += r["n"]
        if held > size_bytes and taken:
            break
        taken.append(r["doc_id"])
    rows = found.filter(F.col("doc_id").isin(taken)).orderBy(*order).collect() if taken else []
    return [r["text"].encode() for r in rows], [int(r["quality"]) for r in rows]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of class 1) of every row."""
    folded = docs.sparkSession.sparkContext.broadcast(model.folded())  # one float for each bucket
    bias, buckets = float(model.bias[1] - model.bias[0]), len(model.vectors)

    def chunk_scores(texts: list[bytes]) -> np.ndarray:
        rows, owner = features(texts, buckets)
        sums = np.bincount(owner, weights=folded.value[rows], minlength=len(texts))
        z = sums / np.maximum(np.bincount(owner, minlength=len(texts)), 1) + bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def run(batches):
        for batch in batches:
            out = [chunk_scores(chunk) for chunk in _chunks(bytes_of(batch.column(1)))]
            values = np.concatenate(out) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    texts, marks = labelled_sample(docs, labels, sample)
    model = train(texts, marks) if len(set(marks)) == 2 else constant(marks)
    return score(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
