r"""Personal data by candidate gradient boosting, in DataFrame expressions only.

1. *Base spans.*  Four kinds by pattern and check (email, ip, card, phone), as
   the contract states them.
2. *Candidates.*  High-recall generators propose spans, which may overlap each
   other and the base: digit runs and groups of card length, numbers in phone
   shape with and without a plus, dotted quads, written-out addresses.
3. *Boosted trees.*  Each candidate has a few small integer features of its
   format and context.  It is a positive example if it overlaps a base span of
   its kind, or if it is a written-out address that reads as a base address once
   its ``[at]`` and ``[dot]`` are signs again ("look (at) home. Next" does not);
   else a negative one.  All candidates of all documents are counted
   by feature vector; that table, bounded by the product of the feature ranges,
   is all that the driver sees.  It fits boosted regression trees there, and
   every tree becomes a CASE expression.
4. *Calibrated thresholds.*  Per kind, the lowest score at which the held-out
   documents (one in five, by hash) show the wanted precision; a kind without
   evidence adds nothing.
5. *Selection.*  Candidates over their threshold that overlap no base span and
   no earlier selected one are added.  Base spans always stay.

Patterns are possessive and start only where a run starts, so matching is
linear in the text and needs no deep stack, however long a run is.  No shuffle
but the count by feature vector, which is pre-aggregated in each task.

Offsets count code points, end exclusive.  Defined results: a null or empty text
has no spans; repeated rows give equal rows; other columns pass through; an empty
table gives an empty result (and a model that adds nothing).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with runs made possessive and anchored at their start.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth running.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
        "phone": r"\+[0-9]"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
BLOCK = 256


@dataclass(frozen=True)
class Generator:
    kind: str
    pattern: str
    hint: str


GENERATORS = (
    Generator("card", r"(?<![0-9])[0-9]{12,19}(?![0-9])", r"[0-9]{12}"),
    Generator("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}(?![0-9])", r"[0-9]{4}[\x20-][0-9]{4}"),
    Generator("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}(?![0-9])", r"\+[0-9]"),
    Generator("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    Generator("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", r"[0-9]\.[0-9]"),
    Generator("email", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{{1,63}}"
                       r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,8}", r"[\[(]at[\])]"),
)
CUES = r"(?i)(phone|call|tel|mail|contact|reach|card|visa|paid|account|address|host|server|login)"
#: name, number of values
FEATURES = (("generator", len(GENERATORS)), ("valid", 2), ("digits", 21), ("breaks", 5), ("before", 5), ("after", 5),
            ("cue", 2), ("lead", 2), ("plus", 2))


def places(text: Column, pattern: str, hint: str) -> Column:
    """array<struct<s, e, m>> of all leftmost matches, in code points.

    Matches and the pieces between them alternate, so running lengths give the
    places; they run in blocks, so that a text of many matches stays cheap.
    """
    kind = "array<struct<s:int,e:int,m:string>>"
    none = F.array().cast(kind)

    def run(pairs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + F.length(x["p"])
            e = s + F.length(x["m"])
            return F.struct(e.alias("at"), F.array_append(
                acc["out"], F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))).cast(kind).alias("out"))

        def join(acc: Column, b: Column) -> Column:
            moved = F.transform(b["out"], lambda x: F.struct(
                (x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["m"].alias("m")))
            return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], moved).cast(kind).alias("out"))

        blocks = F.transform(F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK)),
                             lambda i: F.aggregate(F.slice(pairs, i, F.lit(BLOCK)), start, step))
        return F.aggregate(blocks, start, join, lambda acc: acc["out"])

    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    found = let(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m,
        lambda p, x: F.struct(p.alias("p"), x.alias("m"))), run)))
    return F.when(text.rlike(hint), found).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return acc + d

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    n = F.length(_digits(m))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), luhn(_digits(m))).otherwise(F.lit(False))


SPAN = "array<struct<s:int,k:int,e:int>>"


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the base, by start, then kind as listed."""
    def of(k: int, kind: str) -> Column:
        kept = F.filter(places(text, BASE[kind], HINT[kind]), lambda x: passes(kind, x["m"]))
        return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    found = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.sort_array(F.concat(*found)).cast(SPAN)


def _side(c: Column) -> Column:
    """0 edge of the text, 1 white space, 2 letter, 3 digit, 4 other."""
    return (F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3).otherwise(4))


def spelled(m: Column) -> Column:
    """Whether a written-out address is one of the base pattern and ends like a host, its words made signs."""
    plain = F.regexp_replace(m, r"\x20?[\[(]at[\])]\x20?", "@")
    plain = F.regexp_replace(plain, r"\x20?[\[(]dot[\])]\x20?", ".")
    return plain.rlike(rf"^{_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}$")


def candidates(text: Column) -> Column:
    """array<struct<s, k, e, features...>> of all generators' proposals."""
    def of(g: int, gen: Generator) -> Column:
        def describe(x: Column) -> Column:
            m, s, e = x["m"], x["s"], x["e"]
            valid = spelled(m) if gen.kind == "email" else passes(gen.kind, m)
            breaks = (F.when(m.rlike(r"[()\[\]]"), 4).when(m.rlike("-") & m.rlike(r"\x20"), 3).when(m.rlike("-"), 2)
                      .when(m.rlike(r"\x20"), 1).otherwise(0))
            before = F.when(s == 0, F.lit("")).otherwise(F.substring(text, s, F.lit(1)))
            lead = F.substring(text, F.greatest(s - 23, F.lit(1)), F.least(s, F.lit(24)))
            return F.struct(
                s.alias("s"), F.lit(KINDS.index(gen.kind)).alias("k"), e.alias("e"), F.lit(g).alias("generator"),
                valid.cast("int").alias("valid"), F.least(F.length(_digits(m)), F.lit(20)).alias("digits"),
                breaks.alias("breaks"), _side(before).alias("before"),
                _side(F.substring(text, e + 1, F.lit(1))).alias("after"),
                lead.rlike(CUES).cast("int").alias("cue"), m.rlike("^[3-6]").cast("int").alias("lead"),
                m.startswith("+").cast("int").alias("plus"))

        return F.transform(places(text, gen.pattern, gen.hint), describe)

    return F.concat(*[of(g, gen) for g, gen in enumerate(GENERATORS)])


def _overlaps(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


@dataclass
class Model:
    """Trees as nested tuples ``(feature, cut, low, high)`` with numbers as leaves."""

    bias: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)
    by_format: tuple[str, ...] = ()  # kinds without enough evidence for a threshold

    def score(self, x: np.ndarray) -> np.ndarray:
        def walk(tree, rows: np.ndarray) -> np.ndarray:
            if not isinstance(tree, tuple):
                return np.full(len(rows), tree)
            f, cut, low, high = tree
            return np.where(rows[:, f] <= cut, walk(low, rows), walk(high, rows))

        z = self.bias + sum((walk(t, x) for t in self.trees), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))

    def column(self, c: Column) -> Column:
        """The score of a candidate as one expression."""
        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, cut, low, high = tree
            return F.when(c[FEATURES[f][0]] <= cut, walk(low)).otherwise(walk(high))

        z = reduce(lambda a, t: a + walk(t), self.trees, F.lit(self.bias))
        return 1 / (1 + F.exp(-z))

    def accepts(self, c: Column) -> Column:
        verdict = F.lit(False)
        for kind, threshold in self.thresholds.items():
            verdict = verdict | ((c["k"] == KINDS.index(kind)) & (self.column(c) >= threshold))
        for kind in self.by_format:
            verdict = verdict | ((c["k"] == KINDS.index(kind)) & (c["valid"] == 1))
        return verdict


def boost(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, rounds: int = 12, depth: int = 3,
          rate: float = 0.4) -> Model:
    """Gradient boosted trees with logistic loss on weighted feature vectors."""
    total = pos + neg
    model = Model(bias=math.log((pos.sum() + 1) / (neg.sum() + 1)))
    z = np.full(len(x), model.bias)

    def grow(rows: np.ndarray, level: int, grad: np.ndarray, curve: np.ndarray):
        def gain(at: np.ndarray) -> float:
            return grad[at].sum() ** 2 / (curve[at].sum() + 1.0)

        best = (1e-6, None, None, None)
        if level:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= cut
                    won = gain(rows[left]) + gain(rows[~left]) - gain(rows)
                    if won > best[0]:
                        best = (won, f, int(cut), left)
        if best[1] is None:
            return float(rate * grad[rows].sum() / (curve[rows].sum() + 1.0))
        _, f, cut, left = best
        return f, cut, grow(rows[left], level - 1, grad, curve), grow(rows[~left], level - 1, grad, curve)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        tree = grow(np.arange(len(x)), depth, pos - total * p, total * p * (1 - p))
        model.trees.append(tree)
        one = Model(trees=[tree]).score(x)
        z = z + np.log(one / (1 - one))
    return model


def train(docs: DataFrame, text: str = "text", precision: float = 0.95, least: int = 20) -> Model:
    """Fit trees and thresholds on the candidates of all documents.

    A kind with fewer than ``least`` positive held-out candidates has too little
    evidence for a threshold of its own: its candidates are accepted by their
    format check, so that a short table loses no spelt-out address.
    """
    base, c = F.col("base"), F.col("c")
    found = docs.select(
        (F.pmod(F.xxhash64(text), F.lit(5)) == 0).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = found.select("held", base_spans(F.col("t")).alias("base"), candidates(F.col("t")).alias("all"))
    found = found.filter(F.size("all") > 0).select("held", "base", F.explode("all").alias("c"))
    hit = F.exists(base, lambda b: (b["k"] == c["k"]) & _overlaps(b, c)) | (
        (c["k"] == KINDS.index("email")) & (c["valid"] == 1))
    names = [f for f, _ in FEATURES]
    counts = (found.select("held", hit.alias("hit"), *[c[f].alias(f) for f in names])
              .groupBy("held", *names)
              .agg(F.sum(F.col("hit").cast("long")).alias("pos"), F.sum((~F.col("hit")).cast("long")).alias("neg"))
              .orderBy("held", *names).collect())  # at most the product of the feature ranges
    parts = {}
    for held in (False, True):
        rows = [r for r in counts if r["held"] == held]
        parts[held] = (np.array([[r[f] for f in names] for r in rows], np.int64).reshape(-1, len(names)),
                       np.array([r["pos"] for r in rows], float), np.array([r["neg"] for r in rows], float))
    x, pos, neg = parts[False]
    model = boost(x, pos, neg) if len(x) and pos.sum() else Model()
    x, pos, neg = parts[True]
    scores = model.score(x)
    for kind in KINDS:
        own = np.isin(x[:, 0], [g for g, gen in enumerate(GENERATORS) if gen.kind == kind])
        good = [t for t in np.unique(scores[own]) if pos[own & (scores >= t)].sum() >= least and
                pos[own & (scores >= t)].sum() >= precision * (pos + neg)[own & (scores >= t)].sum()]
        if good:
            model.thresholds[kind] = float(min(good)) - 1e-9
        elif pos[own].sum() < least:
            model.by_format += (kind,)
    return model


def added_spans(base: Column, proposed: Column, model: Model) -> Column:
    """Accepted candidates apart from the base, leftmost and longest first, without overlaps."""
    apart = F.filter(proposed, lambda c: model.accepts(c) & ~F.exists(base, lambda b: _overlaps(b, c)))
    ordered = F.array_sort(F.transform(apart, lambda c: F.struct(
        c["s"].alias("s"), (-c["e"]).alias("n"), c["k"].alias("k"), c["e"].alias("e"))))
    start = F.struct(F.lit(-1).alias("end"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, c: Column) -> Column:
        taken = F.struct(c["e"].alias("end"), F.array_append(acc["out"], F.struct(
            c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"))).cast(SPAN).alias("out"))
        return F.when(c["s"] >= acc["end"], taken).otherwise(acc)

    return F.aggregate(ordered, start, step, lambda acc: acc["out"])


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_spans``: arrays of struct<s, k, e>, k the place in ``KINDS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    both = let(base_spans(t), lambda base: F.struct(base.alias("base"), F.when(
        F.lit(bool(model.thresholds or model.by_format)), F.sort_array(F.concat(base, added_spans(base, candidates(t), model))))
        .otherwise(base).alias("spans")))
    return (docs.withColumn("_pii", both)
            .withColumns({"pii_base": F.col("_pii")["base"], "pii_spans": F.col("_pii")["spans"]}).drop("_pii"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, model: Model) -> DataFrame:
    found = find(docs.select("doc_id", "text"), model)

    def count(k: int) -> Column:
        return F.size(F.filter("pii_base", lambda x: x["k"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"),
                        listed(F.col("pii_spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``[KIND]`` of its first."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.struct(x["e"].alias("at"), F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.get(kinds, x["k"])).alias("out"))
        inside = F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))
        return F.when(x["s"] < acc["at"], inside).otherwise(fresh)

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data of ``text`` replaced; columns as they were."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    row = row.withColumn("text", F.col("_row")["text"])
    found = find(row, train(row))
    clean = redacted(F.col("text"), F.col("pii_spans"))
    return found.select(*[(clean if c == "text" else F.col("_row")[c]).alias(c) for c in names])
