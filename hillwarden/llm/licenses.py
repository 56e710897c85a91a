"""Licence scan by canonical digests of whole texts, whole lines and runs of whole paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hillwarden.llm.tables import row_key

# Licence notices and short licence texts as their licensors word them, a text's paragraphs apart.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "BSD-2-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Titles that stand above a whole licence text.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
}

# Spellings that licence matching guidelines treat as equal.
SAME = [
    ("licence", "license"), ("licenced", "licensed"), ("copyright holder", "copyright owner"), ("copyright holders", "copyright owners"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("authorisation", "authorization"),
    ("favour", "favor"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("fulfil", "fulfill"),
]

OWNER = r"(?im)^[^a-z\n]*(?:copyright (?:\(c\)|©|[0-9]{4})|\(c\) [0-9]{4}|© ?[0-9]{4}|all rights reserved)[^\n]*"
# Words that begin a notice behind an owner's statement on the same line.
BEHIND = "licensed|released|distributed|permission|redistribution|this"
OWNER_BEFORE = OWNER + r"?\.[\x20\t]+(" + BEHIND + r")\b"
BLANK_LINE = r"\n[\x20\t\r]*\n"
PUNCTUATION = r"[^\p{L}\p{N}]+"


def without_owner(text: Column) -> Column:
    """The text without statements of owners; a notice behind one on its line stays."""
    return F.regexp_replace(F.regexp_replace(text, OWNER_BEFORE, " $1"), OWNER + "$", " ")


def canonical(block: Column) -> Column:
    """Lower case, punctuation and white space as single spaces, one of each pair of equal spellings."""
    c = F.regexp_replace(F.concat(F.lit(" "), F.lower(block), F.lit(" ")), PUNCTUATION, " ")
    for a, b in SAME:
        c = F.replace(c, F.lit(f" {a} "), F.lit(f" {b} "))
    return c


def texts(notices: dict[str, list[str]] = NOTICES, titles: dict[str, list[str]] = TITLES) -> list[tuple[str, str]]:
    """(license_id, text) of all notices, those of several paragraphs with each title of the licence as well."""
    plain = [(k, t) for k, ts in sorted(notices.items()) for t in ts]
    return plain + [(k, f"{title}\n\n{t}") for k, t in plain if "\n\n" in t for title in titles.get(k, [])]


def registry(spark: SparkSession, notices: dict[str, list[str]] = NOTICES, titles: dict[str, list[str]] = TITLES) -> DataFrame:
    """license_id, digest, size (of the canonical text) and parts (paragraphs) of each known text."""
    known = spark.createDataFrame(texts(notices, titles), "license_id string, known string")
    form = canonical(without_owner(F.col("known")))
    return known.select("license_id", F.sha2(form, 256).alias("digest"), F.length(form).alias("size"), F.size(F.split("known", BLANK_LINE)).alias("parts")).distinct()


def scan(docs: DataFrame, known: DataFrame, *, max_broadcast: int = 100_000) -> DataFrame:
    """One row per row of docs: doc_id, whole_license, licenses (sorted, comma-joined), n_license_blocks.

    The canonical digest of the entire text, those of its entire lines and of
    runs of entire paragraphs are looked up among the known digests. Paragraphs
    stand between blank lines; runs have as many as known texts may take, from
    one on, and paragraphs that hold an owner's statement only do not count.
    `whole_license` is set if the entire text is a known one; `licenses` lists
    what any of these blocks is. Only blocks of a known length are digested. A
    registry of up to `max_broadcast` rows is broadcast, a larger one is joined
    by shuffle.

    Null and empty texts hold no licence. A notice that stands in several
    blocks counts for each; owners' statements are no part of a text. Repeated
    rows give one row each, with equal results. Texts of any length are read
    whole. Other columns are ignored; an empty registry or table is allowed.
    """
    facts = known.agg(F.count("*").alias("n"), F.max("parts").alias("parts"), F.collect_set("size").alias("sizes")).first()
    side = F.broadcast(known.select("license_id", "digest")) if facts["n"] <= max_broadcast else known.select("license_id", "digest")
    sizes = F.array(*map(F.lit, sorted(facts["sizes"]))).cast("array<int>") if facts["n"] <= max_broadcast else None
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("rk"))
    free = base.where("text is not null").select("rk", without_owner(F.col("text")).alias("body"))
    # each piece is brought into canonical form once; a run is its paragraphs' forms one after the other
    lines = F.transform(F.split("body", r"\n"), canonical)
    parts = F.filter(F.transform(F.split("body", BLANK_LINE), canonical), lambda c: c != " ")
    free = free.select("rk", canonical(F.col("body")).alias("whole"), lines.alias("lines"), parts.alias("parts"))
    at = lambda n: F.when(F.size("parts") >= n, F.sequence(F.lit(1), F.size("parts") - (n - 1))).otherwise(F.array().cast("array<int>"))
    joined = lambda n: lambda i: F.concat(F.lit(" "), F.array_join(F.transform(F.slice(F.col("parts"), i, F.lit(n)), lambda p: F.trim(p)), " "), F.lit(" "))
    kind = lambda name, n=0: lambda x, i: F.struct(F.lit(name).alias("kind"), (F.lit(n << 32) + i).alias("place"), x.alias("form"))
    none = F.array().cast("array<struct<kind:string,place:bigint,form:string>>")
    blocks = F.concat(
        F.array(F.struct(F.lit("whole").alias("kind"), F.lit(-1).cast("bigint").alias("place"), F.col("whole").alias("form"))),
        F.when(F.size("lines") > 1, F.transform("lines", kind("line"))).otherwise(none),
        # with a single paragraph a run of one is the whole text
        F.when(F.size("parts") > 1, F.concat(*[F.transform(F.transform(at(n), joined(n)), kind("run", n)) for n in range(1, (facts["parts"] or 0) + 1)] or [none])).otherwise(none),
    )
    if sizes is not None:
        blocks = F.filter(blocks, lambda b: F.array_contains(sizes, F.length(b["form"])))
    hits = (
        free.select("rk", F.explode(blocks).alias("b"))
        .select("rk", "b.kind", "b.place", F.sha2("b.form", 256).alias("digest"))
        .join(side, "digest")
        .groupBy("rk")
        .agg(
            F.max(F.when(F.col("kind") == "whole", F.col("license_id"))).alias("whole_license"),
            F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("licenses"),
            F.countDistinct("place").alias("n_license_blocks"),
        )
    )
    return base.select("doc_id", "rk").join(hits, "rk", "left").select(
        "doc_id", "whole_license", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_license_blocks", F.lit(0)).cast("long").alias("n_license_blocks")
    )


def sql() -> str:
    """The same scan over `documents`, in DuckDB's SQL."""
    quoted = lambda s: s.replace("'", "''")

    def owner(x: str) -> str:
        return f"regexp_replace(regexp_replace({x}, '{OWNER_BEFORE}', ' \\1', 'g'), '{OWNER}$', ' ', 'g')"

    def canon(x: str) -> str:
        c = f"regexp_replace(' ' || lower({x}) || ' ', '{PUNCTUATION}', ' ', 'g')"
        for a, b in SAME:
            c = f"replace({c}, ' {a} ', ' {b} ')"
        return c

    known = ", ".join(f"('{k}', '{quoted(t)}')" for k, t in texts())
    longest = max(t.count("\n\n") + 1 for _, t in texts())
    return f"""
    WITH known AS (SELECT DISTINCT license_id, {canon(owner("t"))} AS c FROM (VALUES {known}) v(license_id, t)),
    body AS (SELECT row_number() OVER () AS r, doc_id, {owner("text")} AS body FROM documents),
    cut AS (SELECT r, body, string_split_regex(body, '\n') AS a, list_filter(list_transform(string_split_regex(body, '{BLANK_LINE}'), lambda x: {canon("x")}), lambda x: x <> ' ') AS p FROM body),
    runs AS (SELECT r, n, i, ' ' || array_to_string(list_transform(p[i:i + n - 1], lambda x: trim(x)), ' ') || ' ' AS c FROM (SELECT r, p, n, unnest(range(1, len(p) - n + 2)) AS i FROM cut, range(1, {longest + 1}) AS k(n) WHERE len(p) > 1)),
    blocks AS (
      SELECT r, 'whole' AS kind, -1 AS place, {canon("body")} AS c FROM cut WHERE body IS NOT NULL
      UNION ALL SELECT r, 'line', place, {canon("block")} FROM (SELECT r, unnest(range(0, len(a))) AS place, unnest(a) AS block FROM cut WHERE len(a) > 1)
      UNION ALL SELECT r, 'run', n * 4294967296 + i, c FROM runs),
    hits AS (
      SELECT r, max(CASE WHEN kind = 'whole' THEN license_id END) AS whole_license,
             array_to_string(list_sort(list(DISTINCT license_id)), ',') AS licenses, count(DISTINCT place) AS n
      FROM blocks JOIN known USING (c) GROUP BY r)
    SELECT doc_id, whole_license, coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_license_blocks
    FROM body LEFT JOIN hits USING (r)"""
