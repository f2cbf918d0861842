"""License scans: MinHash bands over overlapping windows retrieve templates, exact
shingle containment verifies them.

Texts are lower-cased, cut at [^a-z0-9]+ runs, and read as shingles of SHINGLE words.
Templates are of two kinds, and each has windows that suit it:

* texts, of LONG shingles or more. A window holds TEXT_WIDTH shingles and starts every
  TEXT_STRIDE, so any run of TEXT_WIDTH + TEXT_STRIDE - 1 shingles has a whole window in it.
  TEXT_BANDS bands of TEXT_ROWS MinHash values each are compared with those of the template's
  windows, cut at every offset. Where a template's CONTAINMENT is reached, some window has that
  share of its shingles in common with the template's window beside it, a similarity of 2/3 at
  0.8: it collides with probability 1 - (1 - (2/3)**2)**4 = 0.905. A text of LONG + TEXT_STRIDE - 1
  shingles has two windows wherever it starts, one of which collides with 0.99, and each
  TEXT_STRIDE shingles more add one: 0.9999 for four. Verified is the share of the template's distinct shingles that
  the document holds; first_word is where the first of them stands.
* notices, which may be one shingle long. A window holds WIDTH shingles and starts at each.
  Bands are single MinHash values, as a window with one shingle of a template in common
  collides in a band with probability 1/WIDTH: with BANDS bands, 1 - (1 - 1/WIDTH)**BANDS
  (0.999 here). Verified is the stretch of the text around the window; first_word is where
  the earliest of the best windows starts.

Everything is DataFrame functions in one pass over the text, and only windows that collide
leave it, so the shuffle is as small as the findings. Templates are a parameter; as many as
fit PER_PASS (shingles of notices, of texts) are looked for in one pass, which bounds the
filter and the broadcast, and more take more passes.

Defined cases: null and empty texts, and texts shorter than a shingle, match nothing; a
template of fewer words than a shingle is refused; no templates find nothing; repeated rows
with one doc_id are one finding, with the best containment; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, WIDTH, BANDS, CONTAINMENT = 5, 2, 10, 0.8
LONG, TEXT_WIDTH, TEXT_STRIDE, TEXT_BANDS, TEXT_ROWS = 48, 32, 16, 4, 2
#: Shingles of notices and of texts that one pass looks for.
PER_PASS = {"notices": 4_000, "texts": 100_000}

#: Notices and texts as licensors publish them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": 'you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}

CUT = "[^a-z0-9]+"


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), CUT, " ")), " ")


def _template_words(text: str) -> list[str]:
    return re.sub(CUT, " ", text.lower()).strip().split(" ")


def _least(window: Column, k: int) -> Column:
    return F.array_min(F.transform(window, lambda s: F.xxhash64(s, F.lit(k))))


def _at(w: str, i: Column, width: int = SHINGLE) -> Column:
    return F.xxhash64(*[F.get(w, i + j) for j in range(width)])


def _shingles(w: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: _at(w, i))


def _kinds(templates: Mapping[str, str]) -> Iterator[tuple[str, dict[str, list[str]]]]:
    """(kind, words of the templates) for each pass."""
    split = {name: _template_words(text) for name, text in templates.items()}
    for name, w in split.items():
        if len(w) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
    for kind in PER_PASS:
        waiting: dict[str, list[str]] = {}
        size = 0
        for name, w in split.items():
            n = len(w) - SHINGLE + 1
            if (n >= LONG) == (kind == "texts"):
                if waiting and size + n > PER_PASS[kind]:
                    yield kind, waiting
                    waiting, size = {}, 0
                waiting[name] = w
                size += n
        if waiting:
            yield kind, waiting


def _templates(spark, found: dict[str, list[str]]) -> DataFrame:
    return spark.createDataFrame(list(found.items()), "license string, w array<string>").select("license", _shingles("w").alias("sh"))


def _held(spark, found: dict[str, list[str]]) -> DataFrame:
    """(license, at): a template's distinct shingle hashes."""
    return _templates(spark, found).select("license", F.array_distinct("sh").alias("at"))


def _template_windows(spark, found: dict[str, list[str]], width: int, single: bool) -> DataFrame:
    """(license, window): a template's windows at every offset and, if single, its shingles
    alone."""
    part = F.transform(F.sequence(F.lit(0), F.size("sh") - 1), lambda i: F.slice("sh", i + 1, width))
    windows = F.concat(part, F.transform("sh", lambda s: F.array(s))) if single else F.filter(part, lambda x: F.size(x) == width)
    return _templates(spark, found).select("license", F.explode(windows).alias("window"))


def scan_notices(docs: DataFrame, found: dict[str, list[str]], width: int = WIDTH, bands: int = BANDS, containment: float = CONTAINMENT) -> DataFrame:
    """The notices that documents hold, as ``scan`` gives them."""
    values = F.array(*[F.struct(F.lit(k).alias("band"), _least(F.col("window"), k).alias("value")) for k in range(bands)])
    table = _template_windows(docs.sparkSession, found, width, True).select("license", F.explode(values).alias("v")).select("license", "v.band", "v.value").distinct()
    by_band: dict[int, list[int]] = {}
    for r in table.select("band", "value").distinct().collect():  # bounded: PER_PASS * 2 * bands rows
        by_band.setdefault(r["band"], []).append(r["value"])
    longest = max(map(len, found.values()))

    cut_up = docs.select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    window = cut_up.select("doc_id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)).alias("p"))
    lanes = []
    for i in range(width):
        one = _at("w", F.col("p") + i)
        # past the end of the text the window repeats its first shingle
        lanes.append((one if not lanes else F.when(F.col("p") + i + SHINGLE <= F.size("w"), one).otherwise(lanes[0])).alias(f"s{i}"))
    # a generator keeps the optimizer from hashing the words again for every band
    window = window.select("doc_id", "w", "p", F.explode(F.array(F.struct(*lanes))).alias("s"))
    least = [F.least(*[F.xxhash64(F.col(f"s.s{i}"), F.lit(k)) for i in range(width)]) if width > 1 else F.xxhash64(F.col("s.s0"), F.lit(k)) for k in range(bands)]
    hit = reduce(lambda a, b: a | b, [value.isin(by_band[k]) for k, value in enumerate(least)])
    # the stretch that any alignment of a template around the window can reach
    region = F.slice("w", F.greatest(F.col("p") - longest, F.lit(0)) + 1, 2 * longest + width + SHINGLE)
    some = window.where(hit).select("doc_id", "p", F.array(*[F.col(f"s.s{i}") for i in range(width)]).alias("s"), region.alias("region"))
    bandsof = F.array(*[F.struct(F.lit(k).alias("band"), _least(F.col("s"), k).alias("value")) for k in range(bands)])
    probe = some.select("doc_id", "p", "region", F.explode(bandsof).alias("v")).select("doc_id", "p", "region", "v.band", "v.value")
    known = table.join(_held(docs.sparkSession, found), "license")  # at most LONG hashes a row
    candidate = probe.join(F.broadcast(known), ["band", "value"]).select("doc_id", "p", "license", "at", _shingles("region").alias("held"))
    share = F.size(F.array_intersect("at", "held")) / F.size("at")
    verified = candidate.withColumn("containment", share).where(F.col("containment") >= containment)
    best = F.max(F.struct(F.col("containment"), (-F.col("p")).alias("p")))
    return verified.groupBy("doc_id", "license").agg(best.alias("b")).select("doc_id", "license", F.round("b.containment", 6).alias("containment"), (-F.col("b.p")).cast("long").alias("first_word"))


def scan_texts(docs: DataFrame, found: dict[str, list[str]], width: int = TEXT_WIDTH, stride: int = TEXT_STRIDE, bands: int = TEXT_BANDS, rows: int = TEXT_ROWS, containment: float = CONTAINMENT) -> DataFrame:
    """The longer texts that documents hold, as ``scan`` gives them."""
    if stride > width:
        raise ValueError("windows must meet: the stride is greater than the width")
    band = lambda at, k: F.xxhash64(*[at(k * rows + r) for r in range(rows)], F.lit(k))
    value = lambda at: F.explode(F.array(*[band(at, k) for k in range(bands)])).alias("value")
    windows = _template_windows(docs.sparkSession, found, width, False)
    table = windows.select("license", value(lambda f: _least(F.col("window"), f))).distinct()

    # no text of fewer words has enough distinct shingles
    least = max(SHINGLE, int(containment * min(len({tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}) for w in found.values())))
    cut_up = docs.select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") >= least)
    # generators keep the optimizer from hashing shingles again for every function and window
    one = cut_up.select("doc_id", F.explode(F.array(_shingles("w"))).alias("sh"))
    hashes = lambda f: F.transform("sh", lambda s: F.xxhash64(s, F.lit(f))).alias(f"f{f}")
    functions = [hashes(f) for f in range(bands * rows)]
    hashed = one.select("doc_id", "sh", F.explode(F.array(F.struct(*functions))).alias("h"))
    # windows at every stride, the last one where the text ends
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(F.size("sh") - width, F.lit(0)), F.lit(stride)), F.array(F.greatest(F.size("sh") - width, F.lit(0)))))
    window = hashed.select("doc_id", "sh", "h", F.explode(starts).alias("p"))
    probe = window.select("doc_id", "sh", value(lambda f: F.array_min(F.slice(F.col(f"h.f{f}"), F.col("p") + 1, width))))
    # a text that many windows lead to is verified once; the tables hold at most bands values
    # and one hash for each shingle of the pass
    met = probe.join(F.broadcast(table), "value").groupBy("doc_id", F.xxhash64("sh").alias("own"), "license").agg(F.first("sh").alias("sh"))
    candidate = met.join(F.broadcast(_held(docs.sparkSession, found)), "license").select("doc_id", "license", "at", "sh", F.explode(F.array(F.array_intersect("sh", "at"))).alias("common"))
    verified = candidate.withColumn("containment", F.size("common") / F.size("at")).where(F.col("containment") >= containment)
    first = F.array_position("sh", F.get("common", 0)) - 1
    best = F.max(F.struct("containment", (-first).alias("p")))
    return verified.groupBy("doc_id", "license").agg(best.alias("b")).select("doc_id", "license", F.round("b.containment", 6).alias("containment"), (-F.col("b.p")).cast("long").alias("first_word"))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment (of the template's shingles) and first_word for each
    template that a document holds."""
    how = {"notices": scan_notices, "texts": scan_texts}
    parts = [how[kind](docs, found, containment=containment) for kind, found in _kinds(templates)]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, license string, containment double, first_word long")
    return reduce(DataFrame.unionByName, parts)


def oracle_sql(templates: Mapping[str, str] = TEMPLATES) -> str:
    """The same findings by exact containment, without bands."""
    split = {k: _template_words(v) for k, v in templates.items()}
    values = ", ".join("('{}', '{}')".format(k, " ".join(w)) for k, w in split.items())
    longest = max(len(w) for w in split.values() if len(w) - SHINGLE + 1 < LONG)
    reach = 2 * longest + WIDTH + SHINGLE
    return f"""
WITH t(license, body) AS (VALUES {values}),
tw AS (SELECT license, string_split(body, ' ') AS w FROM t),
ts AS (SELECT DISTINCT license, len(w) - {SHINGLE - 1} >= {LONG} AS is_text, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS s FROM (SELECT license, w, unnest(generate_series(1, len(w) - {SHINGLE - 1})) AS i FROM tw)),
tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
d AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
ds AS (SELECT doc_id, len(w) AS n_words, i - 1 AS pos, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {SHINGLE - 1})) AS i FROM d)),
hit AS (SELECT doc_id, license, is_text, pos, s FROM ds JOIN ts USING (s)),
win AS (SELECT DISTINCT doc_id, license, p FROM (SELECT doc_id, license, unnest(generate_series(greatest(0, pos - {WIDTH - 1}), pos)) AS p FROM hit WHERE NOT is_text)),
held AS (SELECT win.doc_id, win.license, win.p, count(DISTINCT hit.s) AS n FROM win JOIN hit ON win.doc_id = hit.doc_id AND win.license = hit.license
         AND hit.pos >= greatest(win.p - {longest}, 0) AND hit.pos + {SHINGLE} <= greatest(win.p - {longest}, 0) + {reach} GROUP BY ALL
         UNION ALL SELECT doc_id, license, min(pos), count(DISTINCT s) FROM hit WHERE is_text GROUP BY ALL),
ok AS (SELECT held.doc_id, held.license, p, held.n / tn.n AS containment FROM held JOIN tn USING (license) WHERE held.n / tn.n >= {CONTAINMENT})
SELECT doc_id, license, round(max(containment), 6) AS containment, CAST(arg_min(p, (-containment, p)) AS BIGINT) AS first_word FROM ok GROUP BY doc_id, license
"""
