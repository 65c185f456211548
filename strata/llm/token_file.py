"""Token ids in patched frame-of-reference files.

Every text is encoded with the tokenizers library, ``end_id`` is appended to each
document, and the ids of all documents, in ascending ``doc_id`` order, lie in the
files of one folder, ``part-00000.pfor`` first.  In a file the ids form blocks of
``BLOCK``.  A block is stored as its minimum (the frame of reference) and the
differences to it, packed at the width that ``PERCENTILE`` percent of them fit
into; the others keep their low bits in place and put position and high bits in
an exception list behind the packed bits.  The footer indexes block starts and
documents, so any run of ids is read by opening only the blocks that hold it.

File, little-endian: ``MAGIC``; blocks; footer of block offsets (u64), doc ids
(i64), null marks (u8), token counts (u64); numbers of blocks, documents and ids
and the footer's offset (u64 each); ``MAGIC``.  Block: ids (u16), exceptions
(u16), width (u8), three zero bytes, minimum (u32); ``width`` bit planes of
``BLOCK`` bits, lowest bit first; exception positions (u16); their bits above the
width (u32).  A last, short block is padded with its minimum.

One range shuffle of the texts by (doc_id, hash of the text, row number), so rows
that repeat one id or one text spread over tasks; encoding and writing follow in
the same sorted tasks.  A task holds about ``CHUNK_BYTES`` of text, its word
cache and one document index.  Files are written under an attempt's own name and
renamed, so a task that is lost or run twice leaves one whole file; the driver
sees one row for each file.

Defined results: a null or empty text holds the end id alone; a null doc_id comes
first and stays null; rows that repeat a doc_id follow each other by the hash of
their text; other columns are ignored; an empty table gives no documents.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.bpe import LATIN_SPLIT, NORMALIZER, SPLIT
from strata.llm.common import new_folder
from strata.llm.warc import _filesystem

MAGIC = b"PFOR0001"
BLOCK = 1024
PERCENTILE = 90
END_ID = 2
CHUNK_BYTES = 8 << 20
#: Text bytes that one file takes, as a mean.
FILE_BYTES = 48 << 20
CACHE_WORDS = 900_000
_HEAD = struct.Struct("<HHB3xI")
_TAIL = struct.Struct("<QQQQ8s")

#: Ends a word among joined ones; no word holds it.
_MARK = "\n"
_PIECES = re.compile(LATIN_SPLIT + "|\n")
_BEYOND = re.compile("[^\x00-\xff]")


class TextEncoder:
    """Ids of whole texts by the tokenizers library, with unused truncation and padding.

    Where the file drops white space and no word crosses it, the library encodes
    every distinct word once and texts are put together from their words' ids;
    with any other file it encodes the texts themselves.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = (
            spec["normalizer"] == NORMALIZER and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": SPLIT} and steps[0].get("invert") is True
            and steps[0].get("behavior") == "Removed" and steps[1].get("add_prefix_space") is False
            and not steps[1].get("use_regex", True)
            and not any(re.search(r"\s", t["content"]) or t["normalized"] for t in spec["added_tokens"]))
        self.special = [t["content"] for t in spec["added_tokens"]]
        suffix = spec["model"].get("end_of_word_suffix")
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.ends_words = bool(suffix)
        self._forget()

    def _forget(self) -> None:
        """The known pre-split words: their numbers, and their ids one behind the other.

        Number 0 marks the end of a run without white space; words that the plain
        pattern does not serve are kept whole, behind a mark.
        """
        self.known: dict[str, int] = {_MARK: 0}
        self.store, self.reach = array("I"), array("q", [0, 0])

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, names: list[str], found: list[list[int]]) -> None:
        for name, ids in zip(names, found):
            self.known[name] = len(self.reach) - 1
            self.store.extend(ids)
            self.reach.append(len(self.store))

    def _learn_pieces(self, pieces: list[str]) -> None:
        """One call for many pre-split words: each ends at the one token that carries the word's end."""
        ids = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids
        cuts = np.flatnonzero(self.ends[ids]) + 1 if self.ends_words else []
        if len(cuts) != len(pieces) or cuts[-1] != len(ids):
            self._learn(pieces, self._library(pieces))
            return
        first = len(self.reach) - 1
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        self.reach.extend((cuts + len(self.store)).tolist())
        self.store.extend(ids)

    def _numbers(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        """Numbers of the pieces of all words, 0 behind each word, and the order that the words were taken in."""
        if not len(distinct):
            return np.empty(0, np.int64), None
        words, odd = [], []
        raw = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), _MARK)[0].as_py()
        # In the first 256 code points nothing composes, so lower case may come first.
        if _BEYOND.search(raw) or any(t in raw for t in self.special):
            words = raw.split(_MARK)
            odd = [i for i, w in enumerate(words) if _BEYOND.search(w) or any(t in w for t in self.special)]
            out = set(odd)
            plain = [i for i in range(len(words)) if i not in out]
            raw = _MARK.join([words[i] for i in plain])
        flat = _PIECES.findall(raw.lower() + _MARK) if len(odd) < len(distinct) else []
        numbers = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(numbers < 0).tolist()
        missing = list({flat[i] for i in unknown})
        for i in range(0, len(missing), 2000):
            self._learn_pieces(missing[i:i + 2000])
        numbers[unknown] = [self.known[flat[i]] for i in unknown]
        if not odd:
            return numbers, None
        names = [_MARK + words[i] for i in odd]
        new = [x for x in names if x not in self.known]
        self._learn(new, self._library([x[1:] for x in new]))
        whole = np.zeros(2 * len(odd), np.int64)
        whole[::2] = [self.known[x] for x in names]
        return np.concatenate([numbers, whole]), np.argsort(np.array(plain + odd))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of each text's ids."""
        if not self.by_word:
            found = self._library(texts.to_pylist())
            return (np.fromiter((i for x in found for i in x), np.uint32),
                    np.array([len(x) for x in found], np.int64))
        if len(self.known) > CACHE_WORDS:
            self._forget()
        runs = pc.ascii_split_whitespace(texts)
        coded = runs.flatten().dictionary_encode()
        numbers, order = self._numbers(coded.dictionary)
        store, reach = np.frombuffer(self.store, np.uint32), np.frombuffer(self.reach, np.int64)
        # The ids of every distinct run, then those of every run of the texts.
        sizes = np.diff(reach)[numbers]
        held = _gather(store, reach[numbers], sizes)
        ends = np.cumsum(sizes)[numbers == 0]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        at = coded.indices.to_numpy(zero_copy_only=False)
        at = at if order is None else order[at]
        counts = (ends - starts)[at]
        ids = _gather(held, starts[at], counts)
        words = pc.list_value_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(words)])])


def _gather(store: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``store`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(sizes)
    return store[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def pack(values: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """The blocks of a run of ids."""
    if not len(values):
        return []
    n = -(-len(values) // BLOCK)
    table = np.empty((n, BLOCK), np.uint32)
    flat = table.reshape(-1)
    flat[:len(values)] = values
    last = values[(n - 1) * BLOCK:]
    flat[len(values):] = last.min()
    low = table.min(axis=1)
    table -= low[:, None]
    # The width holds the given percentage of a block's differences.
    kth = min(BLOCK - 1, max(0, -(-BLOCK * percentile // 100) - 1))
    bound = np.partition(table, kth, axis=1)[:, kth]
    width = np.frexp(bound.astype(np.float64))[1]
    out: list[bytes] = [b""] * n
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        part = table[rows]
        planes = [np.packbits(((part >> np.uint32(j)) & np.uint32(1)).astype(np.uint8), axis=1, bitorder="little")
                  for j in range(w)]
        packed = np.stack(planes, axis=1).reshape(len(rows), -1) if planes else np.empty((len(rows), 0), np.uint8)
        above = (part.astype(np.uint64) >> np.uint64(w)).astype(np.uint32)
        where, place = np.nonzero(above)
        cut = np.searchsorted(where, np.arange(len(rows) + 1))
        place, high = place.astype("<u2"), above[where, place].astype("<u4")
        for i, row in enumerate(rows.tolist()):
            a, b = cut[i], cut[i + 1]
            out[row] = b"".join([
                _HEAD.pack(len(last) if row == n - 1 else BLOCK, b - a, w, int(low[row])),
                packed[i].tobytes(), place[a:b].tobytes(), high[a:b].tobytes()])
    return out


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` of ``data``."""
    heads = [_HEAD.unpack_from(data, s) for s in starts.tolist()]
    if not heads:
        return np.empty(0, np.uint32)
    table = np.zeros((len(heads), BLOCK), np.uint32)
    width = np.array([h[2] for h in heads])
    raw = np.frombuffer(data, np.uint8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        size = w * BLOCK // 8
        if w:
            bits = raw[(starts[rows] + _HEAD.size)[:, None] + np.arange(size)].reshape(len(rows), w, BLOCK // 8)
            part = np.zeros((len(rows), BLOCK), np.uint32)
            for j in range(w):
                part |= np.unpackbits(bits[:, j], axis=1, bitorder="little").astype(np.uint32) << np.uint32(j)
            table[rows] = part
        for row in rows.tolist():
            count = heads[row][1]
            if count:
                at = int(starts[row]) + _HEAD.size + size
                place = np.frombuffer(data, "<u2", count, at)
                high = np.frombuffer(data, "<u4", count, at + 2 * count)
                table[row, place] |= (high.astype(np.uint64) << np.uint64(w)).astype(np.uint32)
    table += np.array([h[3] for h in heads], np.uint32)[:, None]
    return table.reshape(-1)[:(len(heads) - 1) * BLOCK + heads[-1][0]]


class _Writer:
    """One file: blocks as ids arrive, the index at its end."""

    def __init__(self, path: str):
        self.files, self.place = _filesystem(path)
        self.attempt = f"{self.place}.{uuid.uuid4().hex}.part"
        self.out = self.files.open_output_stream(self.attempt)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.offsets: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = np.empty(0, np.uint32)

    def _blocks(self, values: np.ndarray) -> None:
        found = pack(values)
        for block in found:
            self.offsets.append(self.at)
            self.at += len(block)
        self.out.write(b"".join(found))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append((doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
                          doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), counts.astype("<u8")))
        self.n_ids += len(ids)
        self.held = np.concatenate([self.held, ids])
        whole = len(self.held) // BLOCK * BLOCK
        self._blocks(self.held[:whole])
        self.held = self.held[whole:]

    def close(self) -> tuple[int, int]:
        self._blocks(self.held)
        n_docs = sum(len(x[0]) for x in self.docs)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        for column in range(3):
            for x in self.docs:
                self.out.write(x[column].tobytes())
        self.out.write(_TAIL.pack(len(self.offsets), n_docs, self.n_ids, self.at, MAGIC))
        self.out.close()
        if self.files.get_file_info(self.place).type != pafs.FileType.NotFound:
            self.files.delete_file(self.attempt)  # another attempt made the same file
        else:
            self.files.move(self.attempt, self.place)
        return n_docs, self.n_ids


class TokenFile:
    """A written file: its index in memory, its blocks on demand."""

    def __init__(self, path: str):
        files, place = _filesystem(path)
        self.file = files.open_input_file(place)
        end = self.file.size() - _TAIL.size
        n_blocks, n_docs, self.n_ids, foot, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, end))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file, or was cut short")
        raw, at = self.file.read_at(end - foot, foot), 8 * n_blocks
        self.offsets = np.append(np.frombuffer(raw, "<u8", n_blocks), foot).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        self.null = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last`` - 1."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        return unpack(self.file.read_at(b - a, a), self.offsets[first:last] - a)

    def ids(self, start: int, count: int) -> np.ndarray:
        stop = min(start + count, self.n_ids)
        if stop <= start:
            return np.empty(0, np.uint32)
        first = start // BLOCK
        return self.blocks(first, -(-stop // BLOCK))[start - first * BLOCK:stop - first * BLOCK]

    def pieces(self, blocks: int = 256) -> Iterator[np.ndarray]:
        n = len(self.offsets) - 1
        for first in range(0, n, blocks):
            yield self.blocks(first, min(n, first + blocks))

    def close(self) -> None:
        self.file.close()


def _name(folder: str, part: int) -> str:
    return f"{folder}/part-{part:05d}.pfor"


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``CHUNK_BYTES`` of text, one row at least."""
    reach = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = reach[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reach, base + CHUNK_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID,
                 files: int | None = None) -> list[dict]:
    """Write all documents' ids to ``folder``; returns its manifest, one entry for each file.

    The number of files follows from the bytes of all texts where it is not given.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if files is None:
        total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // FILE_BYTES))
    order = ["doc_id", "_hash", "_row"]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    target, place = _filesystem(folder)
    target.create_dir(place, recursive=True)

    def run(batches):
        encoder, part, writer = TextEncoder(vocabulary), TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in _chunks(batch):
                writer = writer or _Writer(_name(folder, part))
                ids, counts = encoder.encode(piece.column(1))
                ends = np.cumsum(counts)
                writer.add(piece.column(0), np.insert(ids, ends, np.uint32(end_id)), counts + 1)
        if writer:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_ids": [n_ids]}, schema=schema)

    schema = pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    found = rows.mapInArrow(run, "part long, n_docs long, n_ids long").collect()  # one row for each file
    manifest, start = [], 0
    for part, n_docs, n_ids in sorted(tuple(x) for x in found):
        manifest.append({"part": part, "start": start, "n_docs": n_docs, "n_ids": n_ids})
        start += n_ids
    with target.open_output_stream(f"{place}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> list[dict]:
    files, place = _filesystem(folder)
    with files.open_input_stream(f"{place}/manifest.json") as side:
        return json.loads(side.read())


def read_ids(folder: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` of the whole folder, opening only the blocks that hold them."""
    out, stop = [], start + count
    for entry in read_manifest(folder):
        a, b = max(start, entry["start"]), min(stop, entry["start"] + entry["n_ids"])
        if a < b:
            file = TokenFile(_name(folder, entry["part"]))
            out.append(file.ids(a - entry["start"], b - a))
            file.close()
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of a folder, one task for each file.

    Without ids a task holds a run of blocks and the file's index only.
    """
    manifest = read_manifest(folder)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])

    def documents(file: TokenFile) -> Iterator[tuple[int, list]]:
        """Checksum (and ids) of each document, as blocks come in."""
        pieces, held = file.pieces(), np.empty(0, np.uint32)
        for count in file.counts.tolist():
            crc, parts = 0, []
            while count:
                if not len(held):
                    held = next(pieces)
                part, held = held[:count], held[count:]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                if with_ids:
                    parts.append(part)
                count -= len(part)
            yield crc, parts

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                entry = manifest[k]
                file = TokenFile(_name(folder, entry["part"]))
                starts = entry["start"] + np.cumsum(file.counts) - file.counts
                found, first, held = [], 0, 0
                for i, (crc, parts) in enumerate(documents(file), 1):
                    found.append((crc, np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)))
                    held += 64 + 8 * len(found[-1][1])
                    if held > CHUNK_BYTES or i == len(file.counts):
                        columns = [pa.array(file.doc_ids[first:i], pa.int64(), mask=file.null[first:i]),
                                   pa.array(starts[first:i], pa.int64()), pa.array(file.counts[first:i], pa.int64()),
                                   pa.array([x[0] for x in found], pa.int64())]
                        if with_ids:
                            columns.append(pa.array([x[1] for x in found], pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(columns, names)
                        found, first, held = [], i, 0
                file.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    n = len(manifest)
    return spark.range(0, n, 1, max(n, 1)).mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the files and read every document back; the rows of the contract."""
    folder = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, vocabulary)
    return read_tokens(docs.sparkSession, folder, with_ids=False)
