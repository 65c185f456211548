"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the whole text, so the operator is
one narrow stage without a shuffle: it scales with the scan, and no key, source
or group of copies can make a task heavier than its own rows.

Defined results: a null or empty text has no words and fails; exact repeats of
a row give equal rows; a text of any length is measured whole; columns of other
names pass through ``measure`` untouched, and existing columns with the name of
a measure are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE_CLASS, WORD_RULE, is_word_line, let

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "as",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ein", "eine", "ist", "auf", "für", "dem",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "en", "dans", "pour",
    "el", "los", "las", "del", "y", "por", "con", "para", "se", "no",
)


@dataclass(frozen=True)
class Rule:
    """A document passes while ``low * denominator <= 100 * numerator <= high * denominator``."""

    name: str
    numerator: str
    denominator: str
    low: int = 0
    high: int | None = None


#: The base rules of the contract: they alone decide ``base_failed``.
BASE_RULES = (
    Rule("enough_words", "n_words", "one", low=5000),
    Rule("few_repeats", "n_repeat_words", "n_words", high=50),
)
#: The method's own rules, in hundredths: ratios are compared as integers, so
#: that every engine decides a tie alike.
METHOD_RULES = (
    Rule("mean_word_length_pct", "word_chars", "n_words", low=200, high=1500),
    Rule("symbol_ratio", "n_symbols", "n_words", high=25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=4),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=60),
    Rule("shouting_ratio", "n_upper", "word_chars", high=40),
)


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at the sorted ``starts``: the sum of min(3, next - start)."""
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("last")),
        lambda acc, x: F.struct((acc["sum"] + F.least(F.lit(3), x - acc["last"])).cast("long").alias("sum"),
                                x.alias("last")),
        lambda acc: acc["sum"])


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    A window is known by the 64-bit hash of its words (two different windows of
    one text collide with probability under 1e-10 even at 20,000 words).
    Sorting the hashes brings equal ones together.  Most texts end there; a few
    repeated windows are found by looking each window up, many by sorting the
    windows with their places, so that no text costs more than n log n.
    """
    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def by_place(h: Column) -> Column:
        def pick(found: Column) -> Column:
            def equal(i: Column) -> Column:
                return F.get(found, i)["h"] == F.get(found, i + 1)["h"]

            keep = F.filter(found, lambda x, i: ((i > 0) & equal(i - 1)) | ((i < n - 3) & equal(i)))
            return let(F.sort_array(F.transform(keep, lambda x: x["p"])), _covered)

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), pick)

    def search(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(
            F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, F.lit(0).cast("long"))
                   .when(F.size(r) <= 64, let(F.filter(
                       F.sequence(F.lit(0), n - 3), lambda i: F.array_contains(r, F.get(h, i))), _covered))
                   .otherwise(by_place(h)))

    return F.when(n >= 3, let(hashes, search)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    letters = F.regexp_replace(text, f"{SPACE_CLASS}+", "")
    words = F.regexp_extract_all(text, F.lit(f"({WORD_RULE})"), F.lit(1))
    lines = F.filter(F.split(text, "\n", -1), is_word_line)

    def long(c: Column) -> Column:
        return c.cast("long")

    per_word = let(words, lambda w: let(F.size(w), lambda n: F.struct(
        long(n).alias("n_words"), long(_repeat_words(w, n)).alias("n_repeat_words"),
        long(F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))))
        .alias("n_stop_words"))))
    per_line = let(lines, lambda x: F.struct(
        long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return {
        "_words": per_word, "_lines": per_line, "word_chars": long(F.length(letters)),
        "n_symbols": long(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))),
        "n_upper": long(F.length(F.regexp_replace(text, r"[^A-Z]+", ""))),
    }


def compiled(rules: tuple[Rule, ...]) -> Column:
    """The threshold table as one boolean expression over the measures."""
    out = F.lit(True)
    for r in rules:
        top, bottom = F.col(r.numerator), F.lit(1) if r.denominator == "one" else F.col(r.denominator)
        out = out & (F.lit(100) * top >= F.lit(r.low) * bottom)
        if r.high is not None:
            out = out & (F.lit(100) * top <= F.lit(r.high) * bottom)
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_stop_words", "n_lines", "n_upper")


def measure(docs: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE_RULES,
            method: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``."""
    wide = docs.withColumns(measures(F.col(text)))
    for packed in ("_words", "_lines"):
        fields = wide.schema[packed].dataType.names
        wide = wide.withColumns({f: F.col(packed)[f] for f in fields}).drop(packed)
    return (wide.withColumn("base_failed", ~compiled(base))
            .withColumn("kept", ~F.col("base_failed") & compiled(method)))


def reject(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    kept = measure(row.select("_row", F.col("_row")["text"].alias("text"))).filter("kept")
    return kept.select(*[F.col("_row")[c].alias(c) for c in names])
