"""Operator 2: licence scans by canonical digest lookup.

Texts are normalised (case, punctuation, comment leaders, copyright lines with the "all rights
reserved" beside them, equivalent spellings), hashed, and joined by digest with the known licences: the entire text of each document, and its
paragraphs and lines, where licence notices stand, and the ids of SPDX expressions. The known side is this module's fixed
table with the full texts in ``licence_texts``, so broadcasting it is bounded, or the caller's. Only units with a ``MARKER`` word are normalised; every
known text has one in each of its spellings ("under" for "licensed under" and the like), so no
match is lost.

Defined cases: NULL and empty texts match nothing; equal rows get equal results; a NULL key is
kept; a text of several licences lists each once; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from .common import text_of

MARKER = (r"(?i)licen[cs]|rights[^\p{L}\p{N}]+reserved|permission|warrant|public[^\p{L}\p{N}]+domain|redistribut"
          r"|(?<![\p{L}\p{N}])under(?![\p{L}\p{N}])")

# Fixed values: (pattern, replacement) steps over whole texts, in the order applied: line ends, comment leaders, and
# copyright lines with the "all rights reserved" beside them.
_RIGHTS = r"all[ \t]+rights[ \t]+reserved[ \t]*[.,;]*[ \t]*"
PREPARE = [
    (r"\r\n?", "\n"),
    (r"(?im)^[ \t]*(?:(?:#+|//+|/?\*+/?|;+|--+|%+|<!-+|(?:dnl|rem)(?=[ \t]|$))[ \t]*)+", ""),
    (r"(?m)[ \t]*(?:\*+/|-+>)[ \t]*$", ""),
    (rf"(?im)^(?:[ \t]*{_RIGHTS}\n)?[ \t]*(?:copyright(?![ \t]+(?:holder|owner|notice|statement|law|licen|and\b|or\b|in\b))|\(c\)|©)"
     rf"(?:[^a-z\n][^\n]*)?(?:\n[ \t]*{_RIGHTS})?$", " "),
]

# Fixed values: (pattern, replacement) steps of the canonical form of a prepared text, in the order applied; the spellings
# are those that the SPDX matching guidelines call equivalent.
STEPS = [
    (r"https?://", "http "),
    (r"[^\p{L}\p{N}]+", " "),
    (r"\blicenc", "licens"),
    (r"\blicensor", "licenser"),
    (r"\bsub license", "sublicense"),
    (r"\bnon (commercial|infringement)\b", "non$1"),
    (r"\bmerchantibility\b", "merchantability"),
    (r"\bpractise", "practice"),
    (r"(\p{L}{3})is(e|ed|es|ing|ation|ations)\b", "$1iz$2"),
    (r"\banalys(e|ed|es|ing)\b", "analyz$1"),
    (r"\b(lab|fav)our", "$1or"),
    (r"\b(cancel|label|model|signal)l(ed|ing)\b", "$1$2"),
    (r"\b(analog|catalog)ue", "$1"),
    (r"\bartefact", "artifact"),
    (r"\b(calib|cent)re(s?)\b", "$1er$2"),
    (r"\boffence", "offense"),
    (r"\bjudgement", "judgment"),
    (r"\bfulfill?", "fulfil"),
    (r"\bwilfull", "wilful"),
    (r"\bper cent\b", "percent"),
    (r"\bprogramme(s?)\b", "program$1"),
    (r"\bwhilst\b", "while"),
    (r"\b(version|ver|v) (\d)", "v$2"),
    (r"\bv(\d)( 0)+\b", "v$1"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\b(acknowledgement|acknowledgment)s?\b", "acknowledgment"),
    (r"\bgnu general public license\b", "gpl"),
    (r"\bgnu lesser general public license\b", "lgpl"),
    (r"\b(this (work|program|software|file|document|text) is |released |distributed |available |published |made available )", " "),
    (r"\b(licensed|license) under (the )?(terms of )?(the )?", "under "),
    (r"\bunder (the )?(terms of )?(the )?", "under "),
    (r"\b(please )?see (the )?(accompanying |included |file )?(license|copying|notice)( (txt|md|file))*( for (the )?(full |more |further )?"
     r"(details|information|text|terms))?\s*$", " "),
    (r"\s+", " "),
]

# ids of an SPDX expression: what follows "WITH" is an exception, "+" is an older "or later"
SPDX_LINE = r"(?i)spdx-licen[cs]e-identifier:[ \t]*([^\n]*)"
SPDX_STEPS = [(r"(?i)\bwith[ \t]+[^\s()]+", " "), (r"\+(?=[\s)]|$)", "-or-later"), (r"(?i)[()]|\b(and|or)\b(?!-)(?<!-or)", " ")]
SPDX_IDS = """0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0-Perl Artistic-2.0 BSD-2-Clause BSD-3-Clause
BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1
ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later
GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later
LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OpenSSL PHP-3.01 PostgreSQL PSF-2.0
Python-2.0 Ruby Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1""".split()

_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software."""
_AS_IS_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
_ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
_GPL_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin
of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present
and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

# Licence texts and the notices that name a licence.
KNOWN: list[tuple[str, str]] = [
    ("MIT", f"MIT License {_GRANT_MIT} {_AS_IS_MIT}"), ("MIT", f"The MIT License (MIT) {_GRANT_MIT} {_AS_IS_MIT}"),
    ("MIT", f"{_GRANT_MIT} {_AS_IS_MIT}"),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_AS_IS}"), ("BSD-2-Clause", f"BSD 2-Clause License {_BSD_HEAD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_AS_IS}"), ("BSD-3-Clause", f"BSD 3-Clause License {_BSD_HEAD} {_BSD_THIRD} {_BSD_AS_IS}"),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_AS_IS}"),
    ("ISC", f"ISC License {_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_AS_IS}"),
    ("0BSD", f"{_ISC}. {_ISC_AS_IS}"), ("0BSD", f"Zero-Clause BSD {_ISC}. {_ISC_AS_IS}"),
    ("Zlib", _ZLIB), ("Zlib", f"zlib License {_ZLIB}"), ("Unlicense", _UNLICENSE),
    ("Unlicense", f"{_UNLICENSE} For more information, please refer to <https://unlicense.org>"),
    ("Unlicense", f"{_UNLICENSE} For more information, please refer to <https://unlicense.org/>"),
    ("Apache-2.0", _APACHE_HEADER), ("GPL-3.0-or-later", _GPL_HEADER),
    ("Proprietary", "All rights reserved."), ("Proprietary", "All rights reserved"),
    *[(spdx, f"{lead} {name}{end}") for spdx, names in {
        "MIT": ["the MIT License", "MIT License", "MIT", "the MIT license terms"],
        "Apache-2.0": ["the Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "the Apache 2.0 license"],
        "GPL-2.0-only": ["the GNU General Public License, version 2", "GPLv2", "GPL v2"],
        "GPL-3.0-only": ["the GNU General Public License, version 3", "GPLv3", "GPL v3"],
        "LGPL-3.0-only": ["the GNU Lesser General Public License, version 3", "LGPLv3"],
        "AGPL-3.0-only": ["the GNU Affero General Public License, version 3", "AGPLv3"],
        "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL 2.0"],
        "BSD-2-Clause": ["the BSD 2-Clause License", "BSD-2-Clause"],
        "BSD-3-Clause": ["the BSD 3-Clause License", "BSD-3-Clause"],
        "CC0-1.0": ["CC0 1.0", "CC0", "the CC0 1.0 Universal license"],
        "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
        "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
        "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
        "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"], "CC-BY-ND-4.0": ["CC BY-ND 4.0"], "Unlicense": ["the Unlicense"],
    }.items() for name in names for lead in ("Licensed under", "SPDX-License-Identifier:") for end in ("",)],
    *[(i, f"SPDX-License-Identifier: {i}") for i in SPDX_IDS],
    *[(i, f"SPDX-License-Identifier: {i.removesuffix('-only')}") for i in SPDX_IDS if i.endswith("-only")],
]

# Full texts beside this module: file name -> licence. The text alone does not say "or later".
FULL_TEXTS = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2-only",
              "GFDL-1.3": "GFDL-1.3-only", "GPL-1": "GPL-1.0-only", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only",
              "LGPL-2": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
for _name, _license in FULL_TEXTS.items():
    _text = (Path(__file__).parent / "licence_texts" / f"{_name}.txt").read_text("utf-8")
    KNOWN.append((_license, _text))
    if END_OF_TERMS in _text:  # often given without the appendix
        _terms = _text[:_text.index(END_OF_TERMS)]
        KNOWN += [(_license, _terms), (_license, _terms + END_OF_TERMS)]


def replaced(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def canonical(prepared: Column) -> Column:
    return F.trim(replaced(F.lower(prepared), STEPS))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license), one row per distinct canonical form that is not empty."""
    forms = known.select(canonical(replaced(F.col("text"), PREPARE)).alias("c"), "license").where("c <> ''")
    return forms.select(F.md5("c").alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def unit_digests(rows: DataFrame, text: str, marker: str | None = MARKER) -> DataFrame:
    """``text`` becomes ``units``, an array<struct<scope, digest>> of its units (with a marker, if any): the text, its
    paragraphs, its lines, and the ids of each SPDX expression, whose scope is its place among the expressions."""
    t = F.col(text)
    rows = rows.withColumn(text, F.when(t.rlike(marker), replaced(t, PREPARE)) if marker else replaced(t, PREPARE))
    unit = lambda scope, parts: F.transform(parts, lambda p: F.struct(scope.alias("scope"), p.alias("u")))
    parts = F.concat(unit(F.lit("text"), F.array(t)), unit(F.lit("paragraph"), F.split(t, r"\n[ \t\r]*\n")), unit(F.lit("line"), F.split(t, "\n")))
    ids = lambda e, i: F.transform(F.filter(F.split(replaced(e, SPDX_STEPS), r"\s+"), lambda x: x != ""), lambda x: F.struct(
        i.cast("string").alias("scope"), F.concat(F.lit("spdx-license-identifier "), x).alias("u")))
    found = F.filter(F.regexp_extract_all(t, F.lit(SPDX_LINE), F.lit(1)), lambda e: e.rlike(r"(?i)[+()]|\s(and|or|with)\s"))
    marked = F.filter(F.concat(parts, F.flatten(F.transform(found, ids))), lambda x: x["u"].rlike(marker or r"[\p{L}\p{N}]"))
    return rows.withColumn("units", F.transform(marked, lambda x: F.struct(x["scope"].alias("scope"), F.md5(canonical(x["u"])).alias("digest")))).drop(text)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(key, license, notices, n_matches) for every document: the licence that its entire text is
    (NULL if none), the sorted licences that it names anywhere, and how many of its lines do.

    ``known`` (license, text) takes the place of ``KNOWN``; its texts may lack markers, so every unit
    is normalised then, and its size is not known, so it is joined without a hint."""
    marker = MARKER if known is None else None
    side = known_digests(docs.sparkSession.createDataFrame(KNOWN, "license string, text string") if known is None else known)
    side = F.broadcast(side) if known is None else side
    rows = docs.select(F.monotonically_increasing_id().alias("row"), key, text_of(text).alias("t"))
    rows = materialize(unit_digests(rows, "t", marker), "license-units")
    units = rows.where(F.size("units") > 0).select("row", F.explode("units").alias("x")).select("row", "x.scope", "x.digest")
    found = units.join(side, "digest")
    per_row = found.groupBy("row").agg(
        F.min(F.when(F.col("scope") == "text", F.col("license"))).alias("license"),
        F.sort_array(F.collect_set("license")).alias("notices"),
        # expressions are lines of their own: no known notice has their operators
        (F.sum((F.col("scope") == "line").cast("long")) + F.size(F.collect_set(F.when(F.col("scope").rlike("^[0-9]"), F.col("scope"))))).alias("n"))
    return rows.select("row", key).join(per_row, "row", "left").select(
        key, "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_matches"))
