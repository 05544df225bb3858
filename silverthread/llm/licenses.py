"""License scans: look up canonical digests of texts among those of known licenses.

A text is brought into a canonical form, in which wrapping, case, punctuation,
copyright lines and equivalent spellings make no difference; its digest is joined with
those of known licenses. So are the digests of its runs of consecutive lines, since
licenses also stand inside documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .common import content_id, in_slices, stage

# Spellings that count as equal, the first replaced by the second.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "copyright holder": "copyright owner",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "noncommercial": "non commercial",
    "per cent": "percent",
    "sub license": "sublicense",
    "merchantibility": "merchantability",
}

# Texts of short licenses and notices, as their publishers give them.
_MIT_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_BSD_2_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_3_CLAUSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_0BSD_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

""" + _ISC_TERMS.split("\n\n", 1)[1]
_MIT_0_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.

""" + _MIT_TERMS.rsplit("\n\n", 1)[1]
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_GPL_3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_GPL_2_NOTICE = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""

#: Whole licenses, with and without the title that they go by.
FULL: list[tuple[str, str]] = [
    (name, title + text)
    for name, titles, text in (
        ("MIT", ("MIT License", "The MIT License (MIT)", "The MIT License"), _MIT_TERMS),
        ("MIT-0", ("MIT No Attribution",), _MIT_0_TERMS),
        ("ISC", ("ISC License",), _ISC_TERMS),
        ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), _0BSD_TERMS),
        ("BSD-2-Clause", ("BSD 2-Clause License",), _BSD_2_TERMS + _BSD_DISCLAIMER),
        ("BSD-3-Clause", ("BSD 3-Clause License",), _BSD_2_TERMS + _BSD_3_CLAUSE + _BSD_DISCLAIMER),
        ("Unlicense", ("The Unlicense",), _UNLICENSE),
        ("Zlib", ("zlib License",), _ZLIB),
    )
    for title in ("", *(t + "\n\n" for t in titles))
]
#: Notices and statements that name a license.
NOTICES: list[tuple[str, str]] = [
    ("GPL-3.0-or-later", _GPL_3_NOTICE),
    ("GPL-3.0-or-later", _GPL_3_NOTICE.split("\n\n")[0]),
    ("GPL-2.0-or-later", _GPL_2_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("MPL-2.0", _MPL_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    *[
        (f"{name.replace(' ', '-')}-{version}", f"{lead} {name} {version}{end}")
        for name in ("CC BY", "CC BY-SA", "CC BY-NC", "CC BY-ND", "CC BY-NC-SA", "CC BY-NC-ND")
        for version in ("3.0", "4.0")
        for lead, end in (("Licensed under", "."), ("This work is licensed under", "."), ("Released under", "."))
    ],
    *[
        (name, f"SPDX-License-Identifier: {name}")
        for name in (
            "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "0BSD", "Unlicense",
            "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
            "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "CC0-1.0", "CC-BY-4.0",
        )
    ],
]

KNOWN: list[tuple[str, str]] = [*FULL, *NOTICES]

#: First words with sizes of known forms that a pass over the documents looks for; more
#: of them go in several passes.
GATES_AT_ONCE = 200_000

_LEAD = r"^(?:(?![\n©])[\W_])*"
#: Lines that state a copyright: a year, a (c) or a place for the holder follows.
_STATEMENT = re.compile(
    _LEAD + r"(?:©|\(c\)[^\w\n]*(?:(?:19|20)\d\d|copyrights?\b)"
    r"|copyrights?\b[^\w\n]*(?:\(c\)|©|[\[<{]|(?:c[ \t]+)?\d{4}))[^\n]*$",
    re.M | re.I,
)
#: Lines that may state one of a holder: "(c)" also counts off the parts of a text.
_DOUBTFUL = re.compile(
    _LEAD + r"(?:\(c\)|copyrights?\b(?![ \t:]+(?:holders?|owners?|notices?|laws?|licen[cs]es?|acts?"
    r"|statements?|and|or|in|is|to|on|of|as|for|shall|may|must|will)\b))[ \t:]+(?:by[ \t]+)?(?P<holder>[^\W\d_])[^\n]*$",
    re.M | re.I,
)
_URL = re.compile(r"https?://(?:www\.)?")
_TOKEN = re.compile(r"[^\W_]+|\n")
_SINGLE = {word: equal.split() for word, equal in EQUIVALENT.items() if " " not in word}
_PAIRS = {tuple(words.split()): equal.split() for words, equal in EQUIVALENT.items() if " " in words}
_FIRSTS = {first for first, _ in _PAIRS}


def known_licenses(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The built-in texts as ``license``, ``text`` and ``whole`` (whether the text is a
    license; if not, it is a notice or statement of one), and those of the Parquet table
    at ``path``, by default licenses."""
    rows = [(*k, True) for k in FULL] + [(*k, False) for k in NOTICES]
    built_in = spark.createDataFrame(rows, "license string, text string, whole boolean")
    if path is None:
        return built_in
    table = spark.read.parquet(path)
    whole = F.col("whole") if "whole" in table.columns else F.lit(True)
    return built_in.unionByName(table.select("license", "text", whole.alias("whole")))


def without_copyright(text: str) -> list[str]:
    """The text with an empty line for each that states a copyright; if lines are in
    doubt, first with and then without them."""
    low = text.lower()
    if "copyright" not in low and "(c)" not in low and "©" not in low:
        return [text]
    clean = _STATEMENT.sub("", text)
    bare = _DOUBTFUL.sub(lambda m: m[0] if m["holder"].islower() else "", clean)
    return [clean] if bare == clean else [clean, bare]


def _paired(tokens: list[str], across: bool) -> list[str]:
    """Equal spellings of two words, also ``across`` line ends."""
    out, k = [], 0
    while k < len(tokens):
        end = k + 1
        if tokens[k] in _FIRSTS:
            while across and end < len(tokens) and tokens[end] == "\n":
                end += 1
            equal = _PAIRS.get((tokens[k], tokens[end])) if end < len(tokens) else None
            if equal:
                out += [equal[0], *tokens[k + 1 : end], *equal[1:]]
                k = end + 1
                continue
        out.append(tokens[k])
        k += 1
    return out


def canonical(text: str) -> list[list[str]]:
    """Words in lower case and line ends, with equivalent spellings made equal; first
    with those of two words found across line ends. Apply :func:`without_copyright`
    first."""
    plain = text.lower()
    tokens = _TOKEN.findall(_URL.sub("", plain) if "http" in plain else plain)
    if not _SINGLE.keys().isdisjoint(tokens):
        tokens = [word for token in tokens for word in _SINGLE.get(token, (token,))]
    if _FIRSTS.isdisjoint(tokens):
        return [tokens]
    forms = [_paired(tokens, True), _paired(tokens, False)]
    return forms[:1] if forms[0] == forms[1] else forms


def digest(words: list[str]) -> bytes:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def candidates(text: str | None, sizes: dict[str, list[int]]) -> list[tuple[bytes, bool]]:
    """Digests of the text's runs of lines that begin and end as some known form, each
    with whether the run is the whole text."""
    found = set()
    for tokens in (t for clean in without_copyright(text or "") for t in canonical(clean)):
        if sizes.keys().isdisjoint(tokens):
            continue
        words, ends = [], {0}
        for token in tokens:
            if token == "\n":
                ends.add(len(words))
            else:
                words.append(token)
        ends.add(len(words))
        for start in ends - {len(words)}:
            for size in sizes.get(words[start], ()):
                if start + size in ends:
                    found.add((digest(words[start : start + size]), size == len(words)))
    return sorted(found)


def known_forms(known: DataFrame) -> DataFrame:
    """``digest``, ``first`` word, ``size`` in words, ``license`` and ``whole`` of each
    canonical form; of several licenses with one digest the first by name."""
    whole = F.col("whole") if "whole" in known.columns else F.lit(True)
    rows = known.select(F.col("license").cast("string"), F.col("text").cast("string"), whole.cast("boolean"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for every in batches for part in in_slices(every, 1)):
            made = []
            for license_, text, is_whole in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w for w in canonical(without_copyright(text or "")[0])[0] if w != "\n"]
                if words and license_ is not None:
                    made.append((digest(words), words[0], len(words), license_, bool(is_whole)))
            columns = list(zip(*made)) or [()] * 5
            kinds = (pa.binary(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "first", "size", "license", "whole"]
            )

    forms = rows.mapInArrow(run, "digest binary, first string, size bigint, license string, whole boolean")
    least = F.min(F.struct("license", "whole")).alias("of")
    return forms.groupBy("digest").agg(F.first("first").alias("first"), F.first("size").alias("size"), least).select(
        "digest", "first", "size", "of.license", "of.whole"
    )


def scan_licenses(
    docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``license`` of the whole text, ``licenses``, and
    ``full``.

    ``license`` is the license whose canonical digest the whole text has, null if
    none (of several forms of the text the first by name); ``licenses`` are those of the
    text and its runs of consecutive lines (a line, a paragraph, several of either),
    sorted, each once; ``full`` those of them that stand there as whole licenses, not
    as notices. ``known`` has ``license``, ``text`` and perhaps ``whole``; see
    :func:`known_licenses`. Null and empty texts have none, and so has a known text without
    words. Repeated rows come out as often as given; other columns are not used.

    Only runs that begin with the first word of a known form and are as long are hashed;
    their digests meet those of the known forms in a join. What the workers hold is the
    first words and sizes, :data:`GATES_AT_ONCE` at a time, with a pass for each so many.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).alias("doc_id"), content_id(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text")
    )
    forms = stage(known_forms(known), "license_forms")
    gates = forms.select("first", "size").distinct()
    passes = max(1, -(-gates.count() // GATES_AT_ONCE))
    dealt = gates.withColumn("pass", F.pmod(F.xxhash64("first", "size"), F.lit(passes)))
    doc_type = source.schema["doc_id"]
    schema = StructType([doc_type]).add("row", "long").add("digest", "binary").add("is_text", "boolean")
    found = []
    for number in range(passes):
        sizes: dict[str, list[int]] = {}
        for gate in dealt.where(F.col("pass") == number).orderBy("first", "size").collect():
            sizes.setdefault(gate.first, []).append(gate["size"])
        held = spark.sparkContext.broadcast(sizes)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in (part for every in batches for part in in_slices(every, 2)):
                made = [
                    (at, *hit)
                    for at, t in enumerate(batch.column(2).to_pylist())
                    for hit in candidates(t, held.value)
                ]
                at, digests, whole = zip(*made) if made else ((), (), ())
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array(digests, pa.binary()), pa.array(whole, pa.bool_()),
                    ],
                    ["doc_id", "row", "digest", "is_text"],
                )

        found.append(source.mapInArrow(run, schema))
    hits = reduce(lambda a, b: a.unionAll(b), found).join(forms.select("digest", "license", "whole"), "digest")
    named = hits.groupBy(F.col("doc_id").alias("own_id"), F.col("row").alias("own_row")).agg(
        F.min(F.when(F.col("is_text"), F.col("license"))).alias("license"),
        F.sort_array(F.collect_set("license")).alias("licenses"),
        F.sort_array(F.collect_set(F.when(F.col("whole"), F.col("license")))).alias("full"),
    )
    # A few rows: written, so that their number is known to the join with all documents.
    named = stage(named, "license_hits")
    same = (F.col("row") == F.col("own_row")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    none = F.array().cast("array<string>")
    return source.select("doc_id", "row").join(named, same, "left").select(
        "doc_id", "license", F.coalesce("licenses", none).alias("licenses"), F.coalesce("full", none).alias("full")
    )
