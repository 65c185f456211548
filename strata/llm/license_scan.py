"""License scans: MinHash bands over overlapping windows, then exact containment.

A template is the set of its 5-word shingles.  A text's shingles that any
template has are its hits, found by a hashed table.  The hits are cut into windows
of two neighbouring blocks of shingles, each block so long that a template of the
window's length class lies whole in one window.  Each window has ``BANDS``
MinHash values, one to a band, and a literal table from band value to templates
gives the templates that agree with it in any band: what is retrieved depends on
the window, not on the number of templates.  A retrieved template is then checked
exactly: its own hits are laid into windows of ``n + stride - 1`` of its n words, a
stride of half its length apart, and a window counts if it holds at least
``CONTAINMENT`` of the template's shingles.

Band settings: only hits enter a window's MinHash, so ordinary words do not dilute
it.  A template of which 80 % is there, alone in its window, agrees in a band with
probability 0.8, and is missed by all 32 with 0.2**32; with hits of other notices
five times as many as its own, which takes a page of licence text, with 1e-2 or
less for that window, and its neighbour is another chance.

A text goes to the windows only if it holds one of the anchor words.  They are
chosen from the templates such that fewer than 80 % of any template's shingles
are free of them: a text without any of them cannot match.

*Versions.*  Notices of two versions differ in one word and so share most
shingles.  A window settles a template if, for each of the template's words with
a digit (and for ``gnu general``, which tells the GPL from its kin), a shingle
with that word is in the window.  A template that no window settles has no row.

The query takes ``CATALOGUE``: the templates and the notices of ``licenses.py``.
A license has several notices there; the first listed one that is contained
gives the row.  It also reads the identifiers of ``SPDX-License-Identifier:``
lines, whole expressions, in the spelling of the SPDX list; an unknown one is
reported in lower case.

One narrow stage of built-in expressions, no shuffle; templates and their tables
are literals, a fixed parameter.  Each MinHash value of a hit is computed once per
text and reused by all windows.

Defined results: words are lower-cased and freed of punctuation at both ends;
null, empty and unlicensed texts have no row; one row for each document row and
license, with its best window (the first of equals); repeated rows give repeated
results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import licenses
from strata.llm.common import WORD_RULE, let

# Notices by which licenses are granted.
TEMPLATES = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files"),
    ("GPL-text", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                 "published by the Free Software Foundation"),
)
CATALOGUE = (*TEMPLATES, *licenses.notices())
IDENTIFIERS = (*dict.fromkeys(name for name, _ in CATALOGUE), *licenses.SPDX)
TAG = "spdx-license-identifier"
WIDTH = 5
BANDS = 32
#: Slots of the literal hash tables.
SLOTS = 1 << 13
CONTAINMENT = 80  # per cent of the template's shingles


def template_words(text: str) -> list[str]:
    words = [re.sub(r"^[^0-9a-z]+|[^0-9a-z]+$", "", w) for w in text.lower().split()]
    return [w for w in words if w]


def template_shingles(text: str, width: int = WIDTH) -> list[str]:
    words = template_words(text)
    return sorted({" ".join(words[i:i + width]) for i in range(max(len(words) - width, 0) + 1)})


def anchor_words(templates=TEMPLATES) -> list[str]:
    """Long words without which fewer than the needed share of any template's shingles is left."""
    chosen: set[str] = set()
    for _, text in templates:
        shingles = template_shingles(text)
        needed = -(-CONTAINMENT * len(shingles) // 100)
        for word in sorted(set(template_words(text)), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(not chosen & set(s.split()) for s in shingles) < needed:
                break
            chosen.add(word)
    return sorted(chosen)


def _words(text: Column) -> Column:
    """Lower-cased words without punctuation at their ends."""
    raw = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD_RULE})"), F.lit(1))
    bare = F.transform(raw, lambda w: F.regexp_replace(w, r"^[^0-9\p{L}]+|[^0-9\p{L}]+$", ""))
    return F.filter(bare, lambda w: w != "")


def _min_hash(shingle: Column, band: Column) -> Column:
    return F.xxhash64(shingle, band)


def marks_of(text: str) -> list[list[str]]:
    """The shingles of each distinguishing word; of each list one must be found."""
    words = [w for w in dict.fromkeys(template_words(text)) if re.search("[0-9]", w)] + ["gnu general"]
    lists = [[s for s in template_shingles(text) if f" {w} " in f" {s} "] for w in words]
    return [x for x in lists if x]


ENTRY = "struct<license:string,place:int,shingles:array<string>,marks:array<array<string>>,stride:int,held:int>"


def _constant(value, kind: str) -> Column:
    """One literal, which the optimizer reads once; a tree of thousands of literals takes long to plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hash(shingle: str) -> int:
    """``xxhash64`` of the shingle, as Spark has it."""
    return _signed(xxhash.xxh64_intdigest(shingle.encode(), 42))


def min_hash(shingles: list[str], band: int) -> int:
    """Least ``xxhash64(shingle, band)``, as Spark has it."""
    return min(_signed(xxhash.xxh64_intdigest(struct.pack("<i", band), xxhash.xxh64_intdigest(s.encode(), 42)))
               for s in shingles)


def _shape(text: str) -> tuple[int, int]:
    """Stride and length, in shingles, of a template's windows."""
    n = len(template_words(text))
    stride = -(-n // 2)
    return stride, max(n + stride - 1 - WIDTH, 0) + 1


def entries(templates=TEMPLATES) -> Column:
    """The templates as a constant array: shingles, marks and windows of each."""
    out = []
    for place, (name, text) in enumerate(templates):
        stride, held = _shape(text)
        out.append({"license": name, "place": place, "shingles": template_shingles(text), "marks": marks_of(text),
                    "stride": stride, "held": held})
    return _constant(out, f"array<{ENTRY}>")


def known_shingles(templates) -> Column:
    """All shingles of the templates, by slot of their hash."""
    slots: list[list[str]] = [[] for _ in range(SLOTS)]
    for s in sorted({s for _, t in templates for s in template_shingles(t)}):
        slots[shingle_hash(s) % SLOTS].append(s)
    return _constant(slots, "array<array<string>>")


def band_tables(templates) -> list[tuple[int, Column]]:
    """(block length, band value -> places of templates by slot) of each length class."""
    classes: dict[int, dict[int, list[int]]] = {}
    for place, (_, text) in enumerate(templates):
        block = 8
        while block < _shape(text)[1]:
            block *= 2
        shingles = template_shingles(text)
        for band in range(BANDS):
            classes.setdefault(block, {}).setdefault(min_hash(shingles, band), []).append(place)
    out = []
    for block, values in sorted(classes.items()):
        slots: list[list[dict]] = [[] for _ in range(SLOTS)]
        for value, places in sorted(values.items()):
            slots[value % SLOTS].append({"value": value, "places": places})
        out.append((block, _constant(slots, "array<array<struct<value:bigint,places:array<int>>>>")))
    return out


def _tagged(words: Column, identifiers: tuple[str, ...]) -> Column:
    """The identifiers that follow SPDX tags: the first, and known ones joined to it by and, or, with."""
    names = {x.lower(): x for x in identifiers}
    known = _constant(dict(sorted(names.items())), "map<string,string>")
    kind = "array<struct<license:string,place:int,found:int,wanted:int,start:int,settled:boolean>>"

    def at(i: Column) -> Column:
        def operand(j: int) -> Column:
            word = F.get(words, i + 2 * j + 1)
            name = F.try_element_at(known, word)
            if not j:
                return F.coalesce(name, word)
            joined = [F.coalesce(F.get(words, i + 2 * k).isin("and", "or", "with"), F.lit(False)) for k in range(1, j + 1)]
            return F.when(F.forall(F.array(*joined), lambda x: x), name)

        def row(name: Column) -> Column:
            return F.struct(name.alias("license"), F.lit(1 << 30).alias("place"), F.lit(1).alias("found"),
                            F.lit(1).alias("wanted"), i.cast("int").alias("start"), F.lit(True).alias("settled"))

        return F.transform(F.array_compact(F.array_distinct(F.array(*[operand(j) for j in range(6)]))), row)

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == TAG)
    return F.when(F.array_contains(words, TAG), F.flatten(F.transform(places, at))).otherwise(
        F.array().cast(kind)).cast(kind)


def matches(text: Column, catalogue: Column, templates=TEMPLATES, identifiers: tuple[str, ...] = ()) -> Column:
    """array<struct<license, place, found, wanted, start, settled>> of the windows that hold a template, and of SPDX tags."""
    kind = "array<struct<license:string,place:int,found:int,wanted:int,start:int,settled:boolean>>"
    none = F.array().cast(kind)
    known, tables = known_shingles(templates), band_tables(templates)

    def slot(value: Column) -> Column:
        return F.pmod(value, F.lit(SLOTS)).cast("int")

    def hits_of(words: Column) -> Column:
        """at, s: place and text of every shingle that a template has."""
        count = F.greatest(F.size(words) - WIDTH, F.lit(0)) + 1

        def hit(i: Column) -> Column:
            return let(F.array_join(F.slice(words, i, F.lit(WIDTH)), " "), lambda s: F.when(
                F.array_contains(F.get(known, slot(F.xxhash64(s))), s), F.struct((i - 1).cast("int").alias("at"), s.alias("s"))))

        return F.array_compact(F.transform(F.sequence(F.lit(1), count), hit))

    def retrieved(hits: Column) -> Column:
        """Places of the templates that agree with a window of hits in any band."""
        def hashed(band: int) -> Column:
            return F.transform(hits, lambda x: _min_hash(x["s"], F.lit(band)))

        hashes = F.array(*map(hashed, range(BANDS)))

        def by_class(h: Column, block: int, table: Column) -> Column:
            def windows(q: Column) -> Column:
                back = F.reverse(q)

                def window(v: Column) -> Column:
                    first = F.array_position(q, v).cast("int")
                    after = F.array_position(back, v + 1).cast("int")
                    last = F.size(q) + 1 - F.when(after > 0, after).otherwise(F.array_position(back, v).cast("int"))

                    def agreeing(one: Column) -> Column:
                        value = F.array_min(F.slice(one, first, last - first + 1))
                        return let(value, lambda m: F.flatten(F.transform(
                            F.filter(F.get(table, slot(m)), lambda e: e["value"] == m), lambda e: e["places"])))

                    return F.array_distinct(F.flatten(F.transform(h, agreeing)))

                return F.array_distinct(F.flatten(F.transform(F.array_distinct(q), window)))

            return let(F.transform(hits, lambda x: F.floor(x["at"] / block).cast("int")), windows)

        return let(hashes, lambda h: F.array_distinct(F.concat(*[by_class(h, block, t) for block, t in tables])))

    def checked(hits: Column, place: Column) -> Column:
        """The windows of one template that hold enough of it."""
        def of(e: Column) -> Column:
            def windows(own: Column) -> Column:
                def window(start: Column) -> Column:
                    inside = F.filter(own, lambda x: (x["at"] >= start) & (x["at"] < start + e["held"]))

                    def verdict(found: Column) -> Column:
                        settled = F.forall(e["marks"], lambda m: F.arrays_overlap(m, found))
                        return F.when(F.lit(100) * F.size(found) >= F.lit(CONTAINMENT) * F.size(e["shingles"]), F.struct(
                            e["license"].alias("license"), e["place"].alias("place"), F.size(found).alias("found"),
                            F.size(e["shingles"]).alias("wanted"), start.cast("int").alias("start"),
                            settled.alias("settled")))

                    return let(F.array_distinct(F.transform(inside, lambda x: x["s"])), verdict)

                # The windows that reach one of the template's hits.
                starts = F.array_sort(F.array_distinct(F.flatten(F.transform(own, lambda x: F.transform(F.sequence(
                    F.greatest(F.floor((x["at"] - e["held"]) / e["stride"]) + 1, F.lit(0)).cast("int"),
                    F.floor(x["at"] / e["stride"]).cast("int")), lambda k: k * e["stride"])))))
                every = F.array_compact(F.transform(starts, window))
                return let(every, lambda x: F.filter(x, lambda _: F.exists(x, lambda y: y["settled"])))

            mine = F.filter(hits, lambda x: F.array_contains(e["shingles"], x["s"]))
            return F.when(F.lit(100) * F.size(mine) >= F.lit(CONTAINMENT) * F.size(e["shingles"]),
                          let(mine, windows)).otherwise(none)

        return let(F.get(catalogue, place), of)

    def search(words: Column) -> Column:
        found = let(hits_of(words), lambda hits: F.when(F.size(hits) > 0, F.flatten(F.transform(
            F.array_sort(retrieved(hits)), lambda p: checked(hits, p))).cast(kind)).otherwise(none))
        return F.concat(found, _tagged(words, identifiers)) if identifiers else found

    anchors = [*anchor_words(templates), *([TAG] if identifiers else [])]
    anchors = [w for w in anchors if not any(v != w and v in w for v in anchors)]
    pattern = "|".join(re.escape(w) for w in anchors)
    return F.when(F.lower(text).rlike(pattern), let(_words(text), search)).otherwise(none)


def scan(docs: DataFrame, templates=TEMPLATES, identifiers: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, license, containment, start_word, windows: one row for each license of each document row.

    SPDX tags are read if ``identifiers`` gives the spelling of the known ones.
    """
    found = docs.select("doc_id", matches(
        F.coalesce("text", F.lit("")), entries(templates), templates, identifiers).alias("all"))
    found = found.filter(F.size("all") > 0)
    names = F.array_sort(F.array_distinct(F.transform("all", lambda x: x["license"])))
    found = found.select("doc_id", "all", F.explode(names).alias("license"))
    own = F.filter("all", lambda x: x["license"] == F.col("license"))
    own = let(own, lambda o: let(F.array_min(F.transform(o, lambda x: x["place"])),
                                 lambda p: F.filter(o, lambda x: x["place"] == p)))
    found = found.select("doc_id", "license", own.alias("own"))
    best = F.element_at(F.array_sort(F.transform("own", lambda x: F.struct(
        (~x["settled"]).alias("open"), (-x["found"]).alias("less"), x["start"].alias("start"), x["wanted"].alias("wanted")))), 1)
    return found.select("doc_id", "license", F.size("own").alias("windows"), best.alias("best")).select(
        "doc_id", "license", (-F.col("best")["less"] / F.col("best")["wanted"]).alias("containment"),
        F.col("best")["start"].alias("start_word"), "windows")
