"""BPE by a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens by one
gadget for each merge, in order.  The automaton starts with one state and a loop
for every symbol.  The gadget of merge k, ``(u, v) -> w``, lets every path
``p -u-> q -v-> r`` also take the arc ``p -w-> r`` and takes the arc ``v`` away
from the state that ``u`` leads to.  As all arcs labelled ``t`` lead to one
state, a state is known by the token last read, and the gadgets leave this rule:
after token ``a``, token ``w`` has an arc unless a gadget ``(y, x)`` ran at a time
when ``y`` still ended ``a`` and ``x`` still began ``w``.  The table of arcs holds
the answers to that rule; exactly one path spells a word, and its labels are the
word's BPE.  Encoding a word steps over its symbols and follows that table;
decoding emits the labels of the arcs.

One narrow Spark stage: whole texts in Arrow batches, no shuffle; a word's ids
are kept in a bounded cache of each Python worker.  A batch goes in slices of
about 1 MB of text, one text at least: ids and labels take six times the text.

Defined results: a null or empty text has no tokens; repeated rows give equal
rows; other columns are ignored by ``encode_documents``.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from strata.llm.common import slices

CACHE_WORDS = 500_000
CACHE_ARCS = 2_000_000
NEVER = 1 << 62
#: Stands for the end of a word in the goto table; no byte has it for a symbol.
MARK = "\uffff"

# Fixed value: the split of the vocabulary file, spelt out for lower-cased texts of the first 256
# code points (letters, single digits, runs of anything else that is no white space).
LATIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa00-9²³¹¼½¾a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ]+"

# The normaliser and the splitter that the file names.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Automaton:
    """The compiled merges of a vocabulary file with word-end symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [x.get("pattern", {}).get("Regex") for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if spec["normalizer"] != NORMALIZER or steps != [SPLIT, None] or spec["decoder"] is not None:
            raise ValueError("the split of words is spelt out for files with this normaliser and splitter and no decoder")
        self.end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.labels = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels.update({i: t for t, i in self.special.items()})
        self.born = {i: -1 for i in vocab.values()}  # -1: a symbol of the first automaton
        self.halves: dict[int, tuple[int, int]] = {}
        self.gadget: dict[tuple[int, int], int] = {}
        self.dead: set[int] = set()  # tokens that no path reaches
        self.arcs: dict[int, bool] = {}
        for k, pair in enumerate(model["merges"]):
            u, v = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self._add_gadget(k, u, v, vocab["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")])
        self.arcs.clear()
        self.goto = ahocorasick.Automaton()
        for t, i in vocab.items():
            if i not in self.dead:
                t = t[:-len(self.end)] + MARK if self.end and t.endswith(self.end) else t
                self.goto.add_word(t, (i, len(t)))
        self.goto.make_automaton()
        self.symbols = byte_symbols()
        cut = "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.special_cut = re.compile(f"({cut})") if cut else None
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.words: dict[str, str] = {}
        self.chunks: dict[str, tuple[str, str]] = {}
        self.names = {str(i): t for i, t in self.labels.items()}

    def _add_gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.born[w] != -1 or w in self.halves:
            raise ValueError("two merges make one token: the automaton's arcs would not be unique")
        alive = u not in self.dead and v not in self.dead and self._allowed(u, v)
        self.born[w], self.halves[w], self.gadget[u, v] = k, (u, v), k
        if not alive:
            self.dead.add(w)

    def _allowed(self, a: int, w: int) -> bool:
        """Whether the state after ``a`` has an arc ``w``, by the gadgets added so far."""
        spine, until = [], NEVER  # what begins w, each with the times at which it did
        x = w
        while True:
            spine.append((x, self.born[x], until))
            if x not in self.halves:
                break
            until, x = self.born[x], self.halves[x][0]
        y, until = a, NEVER
        while True:
            for x, since, to in spine:
                t = self.gadget.get((y, x))
                if t is not None and t < until and since < t <= to:
                    return False
            if y not in self.halves:
                return True
            until, y = self.born[y], self.halves[y][1]

    def arc(self, state: int, token: int) -> bool:
        key = state << 32 | token
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= CACHE_ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self._allowed(state, token)
        return found

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word, by following the arcs over its symbols.

        The goto table finds the tokens that end at each symbol; the first with an
        arc from the state at its start is the only one, and gives the new state.
        """
        s = word if word.isascii() and word.isalpha() else "".join([self.symbols[b] for b in word.encode()])
        n, arcs = len(s), self.arcs
        state, begin = [-1] * (n + 2), [0] * (n + 2)
        for at, (token, size) in self.goto.iter(s + MARK):
            at += 1
            if state[at] >= 0 or at == n:
                continue
            i = at - size
            if i:
                if state[i] < 0:
                    continue
                found = arcs.get(state[i] << 32 | token)
                if not (self.arc(state[i], token) if found is None else found):
                    continue
            state[at], begin[at] = token, i
        out, j = [], n + 1
        while j:
            if state[j] < 0:
                raise ValueError("the vocabulary has no symbol for a byte")
            out.append(state[j])
            j = begin[j]
        return out[::-1]

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens.

        The file's own normaliser and splitter define them; a pattern of the same
        meaning serves texts of the first 256 code points.
        """
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = self.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return _LATIN.findall(text.lower())

    def _known(self, chunk: str, words) -> tuple[str, str]:
        """Ids and labels of a run without white space, kept in the bounded table."""
        ids = []
        for word in words:
            known = self.words.get(word)
            if known is None:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                known = self.words[word] = " ".join(map(str, self.encode_word(word)))
            ids.append(known)
        text = " ".join(ids)
        if len(self.chunks) >= CACHE_WORDS:
            self.chunks.clear()
        found = self.chunks[chunk] = (text, self.decode_text(text))
        return found

    def encode_both(self, text: str) -> tuple[str, str]:
        """Ids of a whole text in decimal, and their decoded labels, each joined by one space.

        No word crosses white space, so the text goes run by run; with no decoder
        named in the file, the decoding of a text is that of its runs, joined.
        """
        out: list[tuple[str, str]] = []
        for part in self.special_cut.split(text) if self.special_cut else [text]:
            if part in self.special:
                out.append((str(self.special[part]), part))
                continue
            try:
                part.encode("latin-1")
                simple = not _ODD_WHITE.search(part)
            except UnicodeEncodeError:
                simple = False
            if not simple:
                out.extend(self._known(w, [w]) for w in self.split(part))
                continue
            runs = part.lower().split()
            found = list(map(self.chunks.get, runs))
            if None in found:
                for at, known in enumerate(found):
                    if known is None:
                        run = runs[at]
                        found[at] = self.chunks.get(run) or self._known(run, _LATIN.findall(run))
            out.extend(found)
        return " ".join([x[0] for x in out]), " ".join([x[1] for x in out])

    def encode_text(self, text: str) -> str:
        return self.encode_both(text)[0]

    def decode_text(self, ids: str) -> str:
        """The labels of the arcs, joined by one space as the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.split(" "))) if ids else ""


#: Characters at which Python splits words and the normaliser does not.
_ODD_WHITE = re.compile("[\x1c-\x1f]")
_LATIN = re.compile(LATIN_SPLIT)
_LOADED: dict[str, Automaton] = {}


def load(path: str) -> Automaton:
    """The automaton of a vocabulary file, built once in each Python process."""
    if path not in _LOADED:
        _LOADED[path] = Automaton(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """doc_id, ids (space-joined decimals) and decoded text of every row."""
    def run(batches):
        automaton = load(vocabulary)
        for batch in (part for whole in batches for part in slices(whole, [1])):
            both = [automaton.encode_both(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in both], pa.string()),
                 pa.array([x[1] for x in both], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, ids string, decoded string")


def digest_documents(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Like ``encode_documents`` with counts and SHA-256 digests in place of ids and text."""
    def run(batches):
        automaton = load(vocabulary)
        for batch in (part for whole in batches for part in slices(whole, [1])):
            rows = ([], [], [])
            for t in batch.column(1).to_pylist():
                ids, decoded = automaton.encode_both(t or "")
                rows[0].append(ids.count(" ") + 1 if ids else 0)
                rows[1].append(hashlib.sha256(ids.encode()).hexdigest())
                rows[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()),
                 pa.array(rows[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
