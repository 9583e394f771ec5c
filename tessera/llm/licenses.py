"""License scans with MinHash bands over overlapping text windows; DataFrame functions only.

A template of n words is looked for in windows of n + s words that begin every s words,
s a quarter of its shingles: so every passage of n words lies whole in a window, and a
window that holds 80 % of the template's shingles has a Jaccard similarity of at least
about one half with it.  ``BANDS`` bands of ``ROWS`` MinHash rows miss such a window with a
probability of (1 - 0.5^ROWS)^BANDS, about 1e-8.  A band match retrieves the template; the
share of the template's shingles that the window really holds, compared as text, decides.

Bands are evaluated lazily: a window that holds no shingle of a template of its length has other
minima than every such template, so bands are computed only where a template shingle stands.
Where that is, bit tables tell: two bits a shingle, one table for each shingle width and one for each template
length, made from the templates by Spark and read as a scalar subquery, so no hash stands in the plan.  A false
hit costs a window's bands and nothing else.  The plan grows with the number of different template
lengths, not with their shingles.  The documents stay where they are; only matches are grouped.
Templates are a list on the driver, bounded by its author; they are all that is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
ROWS, BANDS = 2, 64
#: Words: runs of letters and digits of the lower-cased text.
TERM = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Shape:
    """Templates of one length: words, shingle width, step and shingles of a window."""

    n: int

    @property
    def width(self) -> int:
        return min(SHINGLE, self.n)

    @property
    def shingles(self) -> int:
        return self.n - self.width + 1

    @property
    def step(self) -> int:
        return max(1, self.shingles // 4)

    @property
    def window(self) -> int:
        return self.shingles + self.step


def terms(col):
    return F.regexp_extract_all(F.lower(F.coalesce(col.cast("string"), F.lit(""))), F.lit(TERM), F.lit(0))


def shingle_hashes(words, width: int):
    """Hashes of all word shingles; a shorter text has one, of all its words."""
    each = F.transform(words, lambda _, i: F.xxhash64(*[F.get(words, i + d) for d in range(width)]))
    return F.slice(each, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1)))


def shingle_texts(words, width: int):
    """The distinct shingles as text."""
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1))), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.array_distinct(each)


def band_keys(hashes, rows: int = ROWS, bands: int = BANDS):
    """One key a band: the hash of its number and of its rows' minima."""

    def least(k):
        return F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, k)))

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, *[least(b * rows + r) for r in range(rows)]))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]], rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """documents -> doc_id, template, n_windows, containment: one row for each document row
    and template that some window holds at 80 % or more.

    ``n_windows`` counts such windows, ``containment`` is the largest share.  Templates
    shorter than five words are one shingle of all their words; templates without
    words are refused.  Null and empty texts, and texts that hold no template, give no row.
    Rows with null or repeated doc_ids are scanned each on its own.
    """
    spark = docs.sparkSession
    given = _templates(spark, templates)
    facts = given.select("template", F.size("words").alias("n")).collect()
    if any(r["n"] == 0 for r in facts) or len({r["template"] for r in facts}) < len(facts):
        raise ValueError("templates need words, and names of their own")
    shapes = sorted({Shape(r["n"]) for r in facts}, key=lambda s: s.n)
    widths = sorted({s.width for s in shapes})
    if not facts:
        return docs.select("doc_id", F.lit("").alias("template"), F.lit(0).cast("long").alias("n_windows"), F.lit(0.0).alias("containment")).limit(0)
    tables = {}  # shingles at most in each bit table
    for r in facts:
        s = Shape(r["n"])
        for c in (f"w{s.width}", f"n{s.n}"):
            tables[c] = tables.get(c, 0) + s.shingles
    tables = {c: table_longs(m) for c, m in tables.items()}
    bits = _bit_tables(given, tables).scalar()

    # A generator stands between the steps: else the optimizer merges them, and what one step
    # computes once a text would be computed again for every word of the next.
    def fixed(df: DataFrame, keep: list[str], **made) -> DataFrame:
        out = df.select(*keep, F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("made"))
        return out.select(*keep, *[F.col(f"made.{n}").alias(n) for n in made])

    split = fixed(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), ["row", "doc_id"], words=terms(F.col("text")))
    hashed = fixed(split, ["row", "doc_id", "words"], **{f"h{w}": shingle_hashes(F.col("words"), w) for w in widths})
    hashes = [f"h{w}" for w in widths]

    def stands(c: str, w: int, among):
        return F.filter(among, lambda p: has_bits(F.col(f"b_{c}"), F.get(F.col(f"h{w}"), p), tables[c]))

    kept = ["row", "doc_id", "words", *hashes]
    met = hashed.select("*", *[F.element_at(bits, f"w{w}").alias(f"b_w{w}") for w in widths])
    met = fixed(met, kept, **{f"a{w}": stands(f"w{w}", w, F.sequence(F.lit(0), F.size(f"h{w}") - 1)) for w in widths})
    met = met.filter(reduce(lambda a, b: a | b, [F.size(f"a{w}") > 0 for w in widths]))
    # The map is read once a row: a subquery for every length would be planned as often.
    placed = met.select("*", bits.alias("bits")).select("*", *[F.element_at("bits", f"n{s.n}").alias(f"b_n{s.n}") for s in shapes])
    placed = fixed(placed, kept, **{f"p{s.n}": stands(f"n{s.n}", s.width, F.col(f"a{s.width}")) for s in shapes})

    def windows(s: Shape):
        first = lambda p: F.greatest(F.lit(0), F.ceil((p - (s.window - 1)) / F.lit(s.step)).cast("int"))
        last = lambda p: F.floor(p / F.lit(s.step)).cast("int")
        at = F.array_distinct(F.flatten(F.transform(f"p{s.n}", lambda p: F.sequence(first(p), last(p)))))
        return F.transform(
            at,
            lambda k: F.struct(
                F.lit(s.n).alias("n"),
                k.alias("k"),
                F.slice(F.col(f"h{s.width}"), k * s.step + 1, s.window).alias("hashes"),
                F.slice(F.col("words"), k * s.step + 1, s.window + s.width - 1).alias("words"),
            ),
        )

    found = placed.select("row", "doc_id", F.explode(F.concat(*[windows(s) for s in shapes])).alias("w"))
    keyed = found.select("row", "doc_id", "w.n", "w.k", "w.words", F.explode(F.array_distinct(band_keys(F.col("w.hashes"), rows, bands))).alias("key"))

    def cases(make):
        return reduce(lambda c, w: c.when(F.least(F.lit(SHINGLE), F.col("n")) == w, make(w)), widths[1:], F.when(F.least(F.lit(SHINGLE), F.col("n")) == widths[0], make(widths[0])))

    known = given.withColumn("n", F.size("words"))
    known = known.select("template", "n", cases(lambda w: shingle_texts(F.col("words"), w)).alias("shingles"), cases(lambda w: band_keys(shingle_hashes(F.col("words"), w), rows, bands)).alias("keys"))
    retrieved = keyed.join(F.broadcast(known.select("template", "n", F.explode(F.array_distinct("keys")).alias("key"))), ["n", "key"]).select("row", "doc_id", "n", "k", "words", "template")
    once = retrieved.groupBy("row", "template", "k").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("words").alias("words"))
    held = once.join(F.broadcast(known.select("template", "shingles")), "template")
    share = F.size(F.array_intersect(cases(lambda w: shingle_texts(F.col("words"), w)), F.col("shingles"))) / F.size("shingles")
    held = held.withColumn("share", share).filter(F.col("share") >= CONTAINMENT)
    return held.groupBy("row", "template").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_windows"), F.max("share").alias("containment")).select("doc_id", "template", "n_windows", "containment")


def table_longs(shingles: int) -> int:
    """Longs of a bit table: a power of two, 128 bits or more a shingle (a false hit in about 4,000 tests)."""
    return 1 << max(4, (2 * shingles - 1).bit_length())


def has_bits(table, h, longs: int):
    """Whether both bits of a hash are set in a table of ``longs`` 64-bit numbers."""

    def one(p):
        return F.getbit(F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1

    first, second = _bit_places(h, longs)
    return one(first) & one(second)


def _bit_places(h, longs):
    last = (F.lit(64) * longs - 1).cast("long")
    return h.bitwiseAND(last), F.shiftrightunsigned(h, 32).bitwiseAND(last)


def _bit_tables(given: DataFrame, tables: dict[str, int]) -> DataFrame:
    """One row, one column: a map from the table's name (``w`` and a shingle width, ``n`` and a template
    length) to its bits.  Its size follows the templates: 16 to 32 bytes a shingle and table."""
    sizes = given.sparkSession.createDataFrame(list(tables.items()), "name string, longs long")
    width = F.least(F.lit(SHINGLE), F.size("words"))
    hashes = reduce(lambda c, w: c.when(width == w, shingle_hashes(F.col("words"), w)), range(2, SHINGLE + 1), F.when(width == 1, shingle_hashes(F.col("words"), 1)))
    each = given.select(F.array(F.concat(F.lit("w"), width), F.concat(F.lit("n"), F.size("words"))).alias("names"), F.explode(hashes).alias("h"))
    named = each.select(F.explode("names").alias("name"), "h").join(sizes, "name")
    bit = named.select("name", F.explode(F.array(*_bit_places(F.col("h"), F.col("longs")))).alias("p"))
    ones = bit.select("name", F.shiftright("p", 6).alias("at"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("v"))
    zeros = sizes.select("name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("longs") - 1)).alias("at"), F.lit(0).cast("long").alias("v"))
    longs = ones.unionByName(zeros).groupBy("name", "at").agg(F.bit_or("v").alias("v"))
    tabled = longs.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("bits"))
    return tabled.agg(F.map_from_entries(F.collect_list(F.struct("name", "bits"))).alias("tables"))


def _templates(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = spark.createDataFrame(list(templates), "template string, text string")
    return rows.select("template", terms(F.col("text")).alias("words"))


# Usual notices of well-known licenses, and the full wording of the short ones.
NOTICES = [
    ("all-rights-reserved", "All rights reserved."),
    ("mit", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("gpl-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1-header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gnu-no-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("apache-2.0-full-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit-text", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("isc-text", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("bsd-source-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary-clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-endorsement", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-disclaimer", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.'),
    ("cc0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("cc-by-nc-sa-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nd-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
]


def oracle(templates: list[tuple[str, str]]) -> str:
    """DuckDB SQL for the exact result: every window, every template, shingles compared as text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in templates)
    return f"""
WITH t AS (
  SELECT template, regexp_extract_all(lower(text), '{TERM}') AS words FROM (VALUES {values}) v(template, text)
), s AS (
  SELECT template, words, least({SHINGLE}, len(words)) AS width, len(words) - least({SHINGLE}, len(words)) + 1 AS shingles FROM t
), ts AS (
  SELECT DISTINCT template, width, greatest(1, shingles // 4) AS step, shingles + greatest(1, shingles // 4) AS win,
         array_to_string(list_slice(words, i, i + width - 1), ' ') AS shingle
  FROM (SELECT *, unnest(range(1, shingles + 1)) AS i FROM s)
), n AS (
  SELECT template, count(*) AS n FROM ts GROUP BY template
), d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{TERM}') AS words FROM documents
), ds AS (
  SELECT doc_id, width, i - 1 AS pos, array_to_string(list_slice(words, i, i + width - 1), ' ') AS shingle
  FROM (SELECT d.*, w.width, unnest(range(1, greatest(len(words) - w.width + 1, 1) + 1)) AS i FROM d, (SELECT DISTINCT width FROM s) w WHERE len(words) > 0)
), hit AS (
  SELECT doc_id, template, shingle, unnest(range(greatest(0, ceil((pos - (win - 1)) / step))::BIGINT, (pos // step) + 1)) AS k
  FROM ds JOIN ts USING (width, shingle)
), win AS (
  SELECT doc_id, template, k, count(DISTINCT shingle) / any_value(n.n)::DOUBLE AS share FROM hit JOIN n USING (template) GROUP BY doc_id, template, k
)
SELECT doc_id, template, count(*) AS n_windows, max(share) AS containment FROM win WHERE share >= {CONTAINMENT} GROUP BY doc_id, template
"""
