"""Licence scan: normalised text against licence templates, by the Dice coefficient over word bigrams.

Text is lower-cased, and everything but letters a-z and digits separates words. Units are the lines of a document,
where it has several lines the whole text, and runs of words of the whole text, across line breaks. A unit and a template are
sets of word bigrams A and B; their likeness is 2|A n B| / (|A| + |B|). It can reach t only if t/(2-t) |B| <= |A| <= (2-t)/t |B|,
so a template is compared only with units inside its size bounds.

Runs are anchored: one begins at every bigram that the template has, is as long as the template and ends at its last bigram of
the template; of overlapping ones the better stays. How many different bigrams of the template lie in each run is known from one
sort: a place counts for the runs that begin after the same bigram's place before it. Runs with fewer than t/(2-t) |B| are passed over,
and where one is found, the others that overlap it are compared in order of their bigrams, until none can be better.

A template is looked at only if the whole text has t/(2-t) |B| of its bigrams, so ordinary text costs one look per bigram, whatever its length.

The scan is a projection: no shuffle, no Python, and a hot source or a group of copies costs what its rows cost.
"""

from __future__ import annotations

import json
import math
import re
from pathlib import Path

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import ascii_lower, let, packed, unpacked

# Public licence statements and notices, in alphabetical order of their names; whole licence texts and whole
# standard headers are files, without title and copyright line where these vary.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    **{path.stem: path.read_text(encoding="utf-8") for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))},
}
THRESHOLD = 0.8


def normalised_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)).split()


def template_bigrams(text: str) -> list[str]:
    words = normalised_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The least and the greatest set size that can still reach the threshold."""
    return math.ceil(threshold / (2 - threshold) * size - 1e-9), math.floor((2 - threshold) / threshold * size + 1e-9)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `n_units` (lines and whole text, of two words or more), `matches` (array of unit, licence, dice, word) and the best of them.

    One row per input row. `unit` counts lines from 0; -1 is the whole text and -2 a run of words. `word` is the place of the unit's
    first word. `matches` holds, for each line and the whole text, the template with the highest likeness of at least `threshold`
    (ties: the first name), then the runs, by place. A run is left out if a match with more common bigrams (ties: higher likeness, then
    line, whole text, run) covers more than half of its words. `licence`, `dice` and `unit` are those of the best match (ties: lowest
    unit, runs last, then the first place), null without one. Null and empty texts have no units. Input columns with these names are replaced.
    """
    names = sorted(templates := TEMPLATES if templates is None else templates)
    parts = {name: template_bigrams(templates[name]) for name in names}
    sets = {name: set(values) for name, values in parts.items()}
    names = [name for name in names if parts[name]]
    columns = docs.columns
    if not names:
        raise ValueError("no template has two words")
    facts = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(name).alias("licence"), F.lit(len(parts[name])).alias("size"),
                               F.lit(len(normalised_words(templates[name])) - 1).alias("length"), F.lit(low).alias("low"), F.lit(high).alias("high"))
                      for k, name in enumerate(names) for low, high in [size_bounds(len(parts[name]), threshold)]])

    # Template bigrams with their numbers and the templates that have them, in buckets by hash: one step to look a bigram up. A bucket
    # is a text that Spark reads once, since thousands of literal columns are slow to build.
    bigrams = sorted({b for name in names for b in parts[name]})
    buckets: list[list] = [[] for _ in range(1 << max(4, len(bigrams).bit_length()))]
    for number, bigram in enumerate(bigrams):
        buckets[xxhash.xxh64_intdigest(bigram.encode(), 42) % len(buckets)].append(
            {"x": bigram, "b": number, "ids": [k for k, name in enumerate(names) if bigram in sets[name]]})
    looked_up = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<x:string,b:int,ids:array<int>>>>")
    templates_of = F.from_json(F.lit(json.dumps([[k for k, name in enumerate(names) if bigram in sets[name]] for bigram in bigrams])), "array<array<int>>")

    def mark(x: Column, at: Column) -> Column:
        bucket = F.get(looked_up, F.pmod(F.xxhash64(x), F.lit(len(buckets))).cast("int"))
        return let(F.get(F.filter(bucket, lambda e: e["x"] == x), F.lit(0)), lambda e: F.when(e.isNotNull(), F.struct(at.alias("at"), e["b"].alias("b"), e["ids"].alias("ids"))))

    def common(hits: Column) -> Column:
        return F.size(F.array_distinct(F.transform(hits, lambda h: h["b"])))

    def of(hits: Column, t: Column) -> Column:
        return F.filter(hits, lambda h: F.array_contains(h["ids"], t["id"]))

    def match(unit: Column, t: Column, n_common: Column, size: Column, word: Column, n_words: Column) -> Column:
        return F.struct(unit.cast("int").alias("unit"), t["licence"].alias("licence"), F.round(2.0 * n_common / (size + t["size"]), 9).alias("dice"),
                        word.cast("int").alias("word"), n_words.cast("int").alias("n_words"), n_common.alias("common"))

    def first_best(found: Column) -> Column:
        # The order of names breaks ties, since a later one must be strictly better.
        return F.aggregate(found, F.get(found, F.lit(0)), lambda a, x: F.when(x["dice"] > a["dice"], x).otherwise(a))

    def in_unit(unit: Column, word: Column, n_words: Column, grams: Column, marks: Column, likely: Column) -> Column:
        """The best match of a line or the whole text, null without one."""
        def compared(size: Column, hits: Column) -> Column:
            near = F.filter(likely, lambda t: size.between(t["low"], t["high"]))
            return first_best(F.filter(F.transform(near, lambda t: let(of(hits, t), lambda h: match(unit, t, common(h), size, word, n_words))),
                                       lambda m: m["dice"] >= threshold))

        hits = F.filter(F.slice(marks, word + 1, n_words - 1), lambda h: h.isNotNull())
        return F.when(n_words > 1, let(hits, lambda h: F.when(F.size(h) > 0, let(
            F.size(F.array_distinct(F.slice(grams, word + 1, n_words - 1))), lambda size: compared(size, h)))))

    def runs(t: Column, hits: Column, grams: Column) -> Column:
        """The runs of words that are like template `t`; `hits` are its bigrams in the text."""
        # A hit is the first of its bigram in the runs that begin after `s`, the place before it or a template's length back.
        by_bigram = F.array_sort(F.transform(hits, lambda h: F.struct(h["b"].alias("b"), h["at"].alias("at"))))

        def opened(by: Column) -> Column:
            def first_start(h: Column, i: Column) -> Column:
                before = F.get(by, i - 1)
                return F.greatest(F.when(before["b"] == h["b"], before["at"]).otherwise(-1), h["at"] - t["length"]) + 1
            return F.transform(by, lambda h, i: F.struct(first_start(h, i).alias("p"), F.lit(0).alias("kind"), F.lit(0).alias("i")))

        # Sorted together, a run's place in line tells how many hits are open at it, less those that it has behind it.
        line = F.array_sort(F.concat(let(by_bigram, opened), F.transform(hits, lambda h, i: F.struct(h["at"].alias("p"), F.lit(1).alias("kind"), i.alias("i")))))
        starts = F.filter(F.transform(line, lambda x, k: F.struct((2 * x["i"] - k).alias("minus"), x["p"].alias("p"), x["i"].alias("i"), x["kind"].alias("kind"))),
                          lambda x: (x["kind"] == 1) & (-x["minus"] >= t["low"]))
        # In the same way, how many hits lie before a run's furthest end.
        stops = F.array_sort(F.concat(F.transform(hits, lambda h, i: F.struct((h["at"] + t["length"]).alias("p"), F.lit(0).alias("kind"), i.alias("i"))),
                                      F.transform(hits, lambda h, i: F.struct(h["at"].alias("p"), F.lit(1).alias("kind"), i.alias("i")))))
        reach = F.filter(F.transform(stops, lambda x, k: F.when(x["kind"] == 0, k - x["i"])), lambda n: n.isNotNull())
        starts = let(reach, lambda r: F.transform(starts, lambda x: F.struct(x["minus"].alias("minus"), x["p"].alias("p"), x["i"].alias("i"), F.get(hits, F.get(r, x["i"]) - 1)["at"].alias("end"))))

        def bound(x: Column) -> Column:
            """The likeness of a run if all its bigrams are the template's."""
            return F.round(-2.0 * x["minus"] / (t["size"] - x["minus"]), 9)

        def run(x: Column) -> Column:
            return let(x["end"] - x["p"] + 1, lambda n: match(
                F.lit(-2), t, -x["minus"], F.size(F.array_distinct(F.slice(grams, x["p"] + 1, n))), x["p"], n + 1))

        def better(r: Column, all_starts: Column) -> Column:
            """Number of the best run that overlaps `r` and is better, the first of equal ones; -1 if there is none."""
            pool = F.array_sort(F.filter(all_starts, lambda x: (x["p"] > r["word"]) & (x["p"] < r["word"] + r["n_words"] - 1) & (bound(x) > r["dice"])))

            def look(best: Column, x: Column) -> Column:
                def compared(q: Column) -> Column:
                    wins = (q["dice"] > best["dice"]) | ((q["dice"] == best["dice"]) & (x["p"] < best["p"]))
                    return F.when(wins, F.struct(q["dice"].alias("dice"), x["p"].alias("p"), x["i"].alias("i"))).otherwise(best)
                return F.when((bound(x) > best["dice"]) | ((bound(x) == best["dice"]) & (x["p"] < best["p"])), let(run(x), compared)).otherwise(best)

            return F.aggregate(pool, F.struct(r["dice"].alias("dice"), F.lit(-1).alias("p"), F.lit(-1).alias("i")), look)["i"]

        def found_in(all_starts: Column) -> Column:
            def step(state: Column, x: Column) -> Column:
                found = state["found"]
                last = F.get(found, F.size(found) - 1)
                met = F.coalesce(last["word"] + last["n_words"] - 1 > x["p"], F.lit(False))

                def taken(r: Column, kept_before: Column) -> Column:
                    return F.struct(F.concat(kept_before, F.array(r)).alias("found"), better(r, all_starts).alias("next"))

                return F.when(met & (state["next"] != x["i"]), state).otherwise(let(run(x), lambda r: F.when(met, taken(r, F.slice(found, 1, F.size(found) - 1))).when(
                    r["dice"] >= threshold, taken(r, found)).otherwise(state)))

            return F.aggregate(all_starts, F.struct(none.alias("found"), F.lit(-1).alias("next")), step)["found"]

        return F.when(F.size(hits) >= t["low"], let(starts, found_in)).otherwise(none)

    none = F.array().cast("array<struct<unit:int,licence:string,dice:double,word:int,n_words:int,common:int>>")

    def kept(fixed: Column, found: Column) -> Column:
        """All of `fixed`, and what of `found` is not covered by something better."""
        ahead = F.array_sort(F.concat(fixed, found), lambda a, b: ordered(a, b, ("common", -1), ("dice", -1), ("kind", 1), ("word", 1), ("licence", 1)))

        def covers(a: Column, m: Column) -> Column:
            return 2 * (F.least(a["word"] + a["n_words"], m["word"] + m["n_words"]) - F.greatest(a["word"], m["word"])) > m["n_words"]

        chosen = F.aggregate(ahead, none, lambda got, m: F.when((m["unit"] == -2) & F.exists(got, lambda a: covers(a, m)), got).otherwise(F.concat(got, F.array(m))))
        return F.concat(fixed, F.array_sort(F.filter(chosen, lambda m: m["unit"] == -2), lambda a, b: ordered(a, b, ("word", 1), ("licence", 1))))

    def ordered(a: Column, b: Column, *by: tuple[str, int]) -> Column:
        def key(m: Column, field: str) -> Column:
            return {"kind": lambda: F.when(m["unit"] >= 0, 0).otherwise(-m["unit"]), "rank": lambda: F.when(m["unit"] == -2, 2**31 - 1).otherwise(m["unit"])}.get(
                field, lambda: m[field])()

        result = F.lit(0)
        for field, sign in reversed(by):
            result = F.when(key(a, field) < key(b, field), -sign).when(key(a, field) > key(b, field), sign).otherwise(result)
        return result

    def first_words(counts: Column) -> Column:
        """Number of the first word of each line: sums before it, block by block, so that no array grows line by line."""
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(counts) - 1) / 256).cast("int")), lambda i: F.slice(counts, i * 256 + 1, 256))
        inner = F.transform(blocks, lambda block: F.aggregate(block, F.array(F.lit(0)), lambda s, c: F.concat(s, F.array(F.element_at(s, -1) + c))))
        return let(inner, lambda parts: let(
            F.aggregate(parts, F.array(F.lit(0)), lambda s, p: F.concat(s, F.array(F.element_at(s, -1) + F.element_at(p, -1)))),
            lambda before: F.flatten(F.transform(parts, lambda p, i: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(before, i))))))

    def likely_templates(marks: Column) -> Column:
        """Templates that have enough bigrams in the whole text."""
        # Numbers only: structs would be told apart pair by pair.
        kinds = F.array_distinct(F.transform(F.filter(marks, lambda h: h.isNotNull()), lambda h: h["b"]))
        return let(F.flatten(F.transform(kinds, lambda b: F.get(templates_of, b))), lambda ids: F.filter(facts, lambda t: F.size(F.filter(ids, lambda k: k == t["id"])) >= t["low"]))

    def scanned(counts: Column, grams: Column, marks: Column, likely: Column) -> Column:
        n_words = F.aggregate(counts, F.lit(0), lambda n, c: n + c)
        lines = let(first_words(counts), lambda s: F.transform(counts, lambda c, i: in_unit(i, F.get(s, i), c, grams, marks, likely)))
        whole = F.when(F.size(counts) > 1, let(n_words, lambda n: in_unit(F.lit(-1), F.lit(0), n, grams, marks, likely)))
        fixed = F.filter(F.concat(lines, F.array(whole)), lambda m: m.isNotNull())
        found = let(F.filter(marks, lambda h: h.isNotNull()), lambda hits: F.flatten(F.transform(likely, lambda t: let(of(hits, t), lambda h: runs(t, h, grams)))))
        return let(fixed, lambda f: let(found, lambda r: F.when(F.size(r) > 0, kept(f, r)).otherwise(f)))

    # Line breaks stay, everything else between words becomes one space.
    text = F.regexp_replace(ascii_lower(F.coalesce(F.col("row.text"), F.lit(""))), "[^a-z0-9\n]+", " ")
    lines = packed(docs).select("row", F.transform(F.split(text, "\n"), lambda x: F.trim(x)).alias("lines"))
    words = F.split(F.array_join(F.filter("lines", lambda x: x != ""), " "), " ")
    grams = let(words, lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws(" ", a, b)))
    counted = lines.select("row", F.transform("lines", lambda x: F.when(x == "", 0).otherwise(F.size(F.split(x, " ")))).alias("counts"), grams.alias("grams"))
    marked = counted.select("row", "counts", "grams", F.transform("grams", mark).alias("marks")).select("*", likely_templates(F.col("marks")).alias("likely"))
    found = F.when(F.size("likely") > 0, let(F.col("counts"), lambda c: let(F.col("grams"), lambda g: let(F.col("marks"), lambda m: let(
        F.col("likely"), lambda k: scanned(c, g, m, k)))))).otherwise(none)
    whole = F.when((F.size("counts") > 1) & (F.size("grams") > 0), 1).otherwise(0)
    result = marked.select("row", (F.size(F.filter("counts", lambda c: c > 1)) + whole).alias("n_units"), found.alias("found"))
    top = F.get(F.array_sort("found", lambda a, b: ordered(a, b, ("dice", -1), ("rank", 1), ("word", 1))), F.lit(0))
    result = result.select("row", "n_units", F.transform("found", lambda m: F.struct(
        m["unit"].alias("unit"), m["licence"].alias("licence"), m["dice"].alias("dice"), m["word"].alias("word"))).alias("matches"), top.alias("top"))
    return unpacked(result, columns, n_units=F.col("n_units"), matches=F.col("matches"), licence=F.col("top.licence"), dice=F.col("top.dice"),
                    unit=F.col("top.unit"))
