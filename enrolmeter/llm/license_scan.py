"""License scans: text units against licence templates by Dice over word bigrams.

Units are every line of a document, where notices stand, and the whole text, where it may be a
licence file. A unit is normalised to its runs of letters and digits in lower case; its set of
word bigrams A is compared with a template's set B by Dice, 2 |A n B| / (|A| + |B|).

A Dice of at least t needs |A| between t / (2 - t) and (2 - t) / t times |B|. Three bounds prune
with it: a unit of n words has at most n - 1 bigrams, so one that is too short for the smallest
template builds none; a unit with d distinct words has at least d - 1, so one too long for the
largest builds none either, which spares nearly all whole texts; and the exact size selects the
templates a unit is compared with.

Passages are runs of consecutive words, over the ends of lines or inside longer ones, with a Dice of
at least the threshold and at most (2 - t) / t times the template's words. A text must hold
t / (2 - t) of a template's bigrams at all, and a run as many within its length, before runs are
measured; then every run that begins and ends with a bigram of the template is, since another end
only lowers Dice. Of runs that overlap, the one with most bigrams in common stays; runs that lie by
half or more in units with a hit are not told again. The templates for passages are those of the
units and more that keep similar licences apart.

All of it is array functions within the document's row: no shuffle and no join. The templates
are a literal of a few thousand numbers in the plan, bounded by the list below.

Defined cases: null or empty text has no licence. Repeated rows are scanned alike. Of templates
with equal Dice the first by name counts. Other columns come back as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lines_of, table, text_of, without

THRESHOLD = 0.8
NOT_WORD = "[^\\p{L}\\p{N}]+"

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)

#: Public licence texts and usual notices. The part of a name before ``/`` is the
#: licence, what follows tells its forms apart.
TEMPLATES: dict[str, str] = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "BSD-3-Clause/notice": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0/notice": "Licensed under CC BY 4.0.",
    "CC-BY-4.0/work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0/work": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-SA-4.0/notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0/work": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related rights.",
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should "
        "have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "LGPL-3.0/notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT/notice": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY
    ),
    "MPL-2.0/notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense/notice": "This is free and unencumbered software released into the public domain.",
}

_GPL = TEMPLATES["GPL-3.0/header"]

#: What passages are compared with.
PASSAGES: dict[str, str] = {
    **TEMPLATES,
    "AGPL-3.0/header": _GPL.replace("GNU General", "GNU Affero General"),
    "BSD-3-Clause/text": TEMPLATES["BSD-2-Clause/text"] + (
        " 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."
    ),
    "CC0-1.0/text": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and "
        "Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") "
        "of an original work of authorship and/or a database (each, a \"Work\")."
    ),
    "GPL-1.0/header": _GPL.replace("either version 3 of the License", "either version 1"),
    "GPL-2.0/header": _GPL.replace("either version 3", "either version 2"),
    "LGPL-2.0/header": _GPL.replace("program", "library").replace("GNU General", "GNU Library General")
    .replace("either version 3", "either version 2"),
    "LGPL-2.1/header": _GPL.replace("program", "library").replace("GNU General", "GNU Lesser General")
    .replace("either version 3", "either version 2.1"),
    "LGPL-3.0/header": _GPL.replace("GNU General", "GNU Lesser General"),
    "LGPL-3.0/text": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of "
        "version 3 of the GNU General Public License, supplemented by the additional permissions listed below."
    ),
}


def _words(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), NOT_WORD), lambda w: w != "")


def _pairs(words: Column) -> Column:
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, pairs).otherwise(F.array().cast("array<bigint>"))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _literal(spark: SparkSession, templates: Mapping[str, str]) -> tuple[Column, list[int]]:
    """The templates as an array constant, hashed as the units are, and their sizes."""
    given = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    words = _words(F.col("text"))
    rows = given.select("name", (F.size(words) - 1).alias("length"), _bigrams(words).alias("bigrams")).collect()
    structs = [
        f"named_struct('name', '{r['name']}', 'n', {len(r['bigrams'])}, 'length', {r['length']}, "
        f"'bigrams', array({', '.join(f'{b}L' if b != -(2**63) else str(b) for b in r['bigrams'])}))"
        for r in sorted(rows, key=lambda r: r["name"])
    ]
    return F.expr(f"array({', '.join(structs)})"), [len(r["bigrams"]) for r in rows]


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``hits``: (unit, name, dice) of each unit's best template at or over the
    threshold; unit is the line's number from 0, or -1 for the whole text."""
    known, sizes = _literal(docs.sparkSession, templates)
    # Wider by a trifle: a Dice of exactly the threshold must not be lost to rounding.
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    least, most = min(sizes) * low, max(sizes) * high
    nothing = F.expr("CAST(array() AS array<struct<dice:double,name:string>>)")

    def compare(bigrams: Column) -> Column:
        n = F.size(bigrams)
        near = F.filter(known, lambda t: (n >= t["n"] * low) & (n <= t["n"] * high))

        def dice(t: Column) -> Column:
            both = F.size(F.array_intersect(bigrams, t["bigrams"]))
            return F.struct((2.0 * both / (n + t["n"])).alias("dice"), t["name"].alias("name"))

        return F.filter(F.transform(near, dice), lambda hit: hit["dice"] >= threshold)

    def best(unit: Column) -> Column:
        """The unit's hit in an array, or an empty one."""
        def judged(words: Column) -> Column:
            long_enough = F.size(words) - 1 >= least
            short_enough = F.size(F.array_distinct(words)) - 1 <= most
            hits = F.when(long_enough & short_enough, let(_bigrams(words), compare)).otherwise(nothing)
            order = lambda a, b: (
                F.when(a["dice"] > b["dice"], -1).when(a["dice"] < b["dice"], 1)
                .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0)
            )
            return F.slice(F.array_sort(hits, order), 1, 1)

        return let(_words(unit), judged)

    def placed(unit: Column, number: Column) -> Column:
        return F.transform(
            best(unit), lambda h: F.struct(number.cast("int").alias("unit"), h["name"].alias("name"), h["dice"].alias("dice"))
        )

    def hits(lines: Column) -> Column:
        by_line = F.flatten(F.transform(lines, placed))
        whole = F.when(F.size(lines) > 1, placed(text_of(), F.lit(-1))).otherwise(F.slice(by_line, 1, 0))
        return F.concat(by_line, whole)

    return docs.select(*without(docs, "hits"), let(lines_of(text_of()), hits).alias("hits"))


def passages(
    scanned: DataFrame, templates: Mapping[str, str] = PASSAGES, threshold: float = THRESHOLD
) -> DataFrame:
    """``scanned``, which has ``hits``, with ``passages``: (name, dice, start, until) of the runs of
    words that hold a template, in words of the whole text from 0, ``until`` exclusive."""
    known, _ = _literal(scanned.sparkSession, templates)
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    nothing = F.expr("CAST(array() AS array<struct<fewer:int,less:double,start:int,name:string,until:int>>)")
    every = F.array_distinct(F.flatten(F.transform(known, lambda t: t["bigrams"])))

    def placed(pairs: Column) -> Column:
        """(i, h, last): every bigram with its place and the place of the same one before, or -1."""
        numbered = F.array_sort(F.transform(pairs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def linked(s: Column) -> Column:
            def link(x: Column, j: Column) -> Column:
                before = F.get(s, j - 1)
                last = F.when((j > 0) & (before["h"] == x["h"]), before["i"]).otherwise(-1)
                return F.struct(x["i"].alias("i"), x["h"].alias("h"), last.alias("last"))

            return F.array_sort(F.transform(s, link))

        return let(numbered, linked)

    def best_from(marked: Column, t: Column, length: Column):
        """Of the runs that begin at a place, the one of the greatest Dice."""
        zero = F.struct(*(F.lit(0).alias(x) for x in ("n", "both")), F.lit(0.0).alias("dice"), *(F.lit(0).alias(x) for x in ("shared", "end")))

        def run(a: Column) -> Column:
            def step(s: Column, x: Column) -> Column:
                new = x["last"] < a
                n = s["n"] + new.cast("int")
                both = s["both"] + (new & x["own"]).cast("int")
                dice = 2.0 * both / (n + t["n"])
                better = x["own"] & (dice > s["dice"])
                return F.struct(
                    n.alias("n"), both.alias("both"), F.when(better, dice).otherwise(s["dice"]).alias("dice"),
                    F.when(better, both).otherwise(s["shared"]).alias("shared"),
                    F.when(better, x["i"]).otherwise(s["end"]).alias("end"),
                )

            def result(s: Column) -> Column:
                return F.struct(
                    (-s["shared"]).alias("fewer"), (-s["dice"]).alias("less"), a.alias("start"),
                    t["name"].alias("name"), (s["end"] + 2).alias("until"),
                )

            return F.aggregate(F.slice(marked, a + 1, length), zero, step, result)

        return run

    def of_template(places: Column, t: Column) -> Column:
        need, length = F.ceil(t["n"] * low).cast("int"), F.floor(t["length"] * high).cast("int")
        marked = F.transform(
            places,
            lambda x: F.struct(x["i"].alias("i"), x["last"].alias("last"), F.array_contains(t["bigrams"], x["h"]).alias("own")),
        )

        def measured(m: Column) -> Column:
            def enough(at: Column) -> Column:
                starts = F.filter(at, lambda a, k: F.get(at, k + need - 1) - a < length)
                return F.transform(starts, best_from(m, t, length))

            return let(F.transform(F.filter(m, lambda x: x["own"]), lambda x: x["i"]), enough)

        return F.filter(let(marked, measured), lambda c: -c["less"] >= threshold)

    def candidates(pairs: Column) -> Column:
        def near(common: Column) -> Column:
            return F.filter(known, lambda t: F.size(F.array_intersect(common, t["bigrams"])) >= t["n"] * low)

        def measured(some: Column) -> Column:
            runs = let(placed(pairs), lambda q: F.flatten(F.transform(some, lambda t: of_template(q, t))))
            return F.when(F.size(some) > 0, runs).otherwise(nothing)

        return let(let(F.array_intersect(pairs, every), near), measured)

    def told(lines: Column) -> Column:
        """The words of the units that have a hit."""
        def span(sizes: Column, h: Column) -> Column:
            def until(n: Column) -> Column:
                return F.aggregate(F.slice(sizes, 1, n), F.lit(0), lambda s, x: s + x)

            whole = h["unit"] < 0
            start = F.when(whole, 0).otherwise(until(F.greatest(h["unit"], F.lit(0))))
            end = F.when(whole, until(F.size(sizes))).otherwise(until(F.greatest(h["unit"], F.lit(0)) + 1))
            return F.struct(start.alias("start"), end.alias("until"))

        sizes = F.transform(lines, lambda line: F.size(_words(line)))
        return let(sizes, lambda z: F.transform("hits", lambda h: span(z, h)))

    def chosen(found: Column) -> Column:
        def fresh(c: Column, spans: Column) -> Column:
            def half(u: Column) -> Column:
                both = F.least(c["until"], u["until"]) - F.greatest(c["start"], u["start"])
                return 2 * both >= c["until"] - c["start"]

            return ~F.exists(spans, half)

        def add(taken: Column, c: Column) -> Column:
            met = F.exists(taken, lambda o: (c["start"] < o["until"]) & (o["start"] < c["until"]))
            return F.when(met, taken).otherwise(F.concat(taken, F.array(c)))

        new = let(told(lines_of(text_of())), lambda spans: F.filter(found, lambda c: fresh(c, spans)))
        return F.when(F.size(found) > 0, F.aggregate(F.array_sort(new), nothing, add)).otherwise(nothing)

    found = let(let(_pairs_of_text(), candidates), chosen)
    shown = F.transform(
        found,
        lambda c: F.struct(c["name"].alias("name"), (-c["less"]).alias("dice"), c["start"].alias("start"), c["until"].alias("until")),
    )
    return scanned.select(*without(scanned, "passages"), shown.alias("passages"))


def _pairs_of_text() -> Column:
    return let(_words(text_of()), _pairs)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its hits and passages, the licences they name and the best Dice.

    The SQL below knows units only; on texts without passages both say the same.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return summary(passages(scan(docs)))


def summary(scanned: DataFrame) -> DataFrame:
    def short(hits: str) -> Column:
        return F.transform(hits, lambda h: F.struct(h["name"].alias("name"), h["dice"].alias("dice")))

    every = scanned.select("doc_id", F.concat(short("hits"), short("passages")).alias("hits"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.split_part(h["name"], F.lit("/"), F.lit(1)))))
    return every.select(
        "doc_id",
        F.size("hits").cast("long").alias("n_hits"),
        F.array_join(names, ",").alias("licences"),
        F.round(F.coalesce(F.array_max(F.transform("hits", lambda h: h["dice"])), F.lit(0.0)), 9).alias("best_dice"),
    )


def _oracle() -> str:
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    pairs = (
        "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    )
    return f"""
WITH template(name, text) AS (VALUES {quoted}),
t AS (SELECT name, {pairs} AS b FROM (SELECT name, {words.format('text')} AS w FROM template)),
unit AS (
  SELECT doc_id, generate_subscripts(lines, 1) - 1 AS unit, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
  UNION ALL
  SELECT doc_id, -1, text FROM documents WHERE contains(text, chr(10))),
u AS (SELECT doc_id, unit, {pairs} AS b FROM (SELECT doc_id, unit, {words.format('line')} AS w FROM unit)),
scored AS (
  SELECT doc_id, unit, name, 2.0::DOUBLE * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)) AS dice
  FROM u JOIN t ON 3 * len(u.b) BETWEEN len(t.b) AND 9 * len(t.b)),
hit AS (
  SELECT doc_id, unit, name, dice FROM scored WHERE dice >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, name) = 1),
found AS (
  SELECT doc_id, count(*)::BIGINT AS n_hits, max(dice) AS best_dice,
         string_agg(DISTINCT split_part(name, '/', 1), ',' ORDER BY split_part(name, '/', 1)) AS licences
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_hits, 0)::BIGINT AS n_hits, coalesce(licences, '') AS licences,
       round(coalesce(best_dice, 0::DOUBLE), 9) AS best_dice
FROM documents d LEFT JOIN found USING (doc_id)
"""


ORACLE = _oracle()
