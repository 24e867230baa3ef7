"""License scan by canonical digests.

A unit of text (a run of consecutive lines, up to the whole document) is put
into a canonical form: copyright lines out, lower case, equivalent spellings
unified, everything but letters and digits a single space. Its SHA-256 digest is
joined to the digests of known license texts, so a unit matches only as a
whole. Only runs that begin like a known text and are as long as one are hashed.
Equal canonical forms are joined once.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenura.llm.text import Guarded
from tenura.settings import materialize

# License texts and the notices that stand for a license.
_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so{condition}
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_GRANT_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted{condition}
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_MIT = _GRANT_MIT.format(
    condition=""", subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
)
_MIT_0 = _GRANT_MIT.format(condition=".")
_ISC = _GRANT_ISC.format(
    condition=", provided that the above copyright notice and this permission notice appear in all copies."
)
_ZERO_BSD = _GRANT_ISC.format(condition=".")
_BSD_2 = f"{_BSD_START}\n{_BSD_END}"
_BSD_3 = f"{_BSD_START}\n{_BSD_NAMES}\n{_BSD_END}"

_BSD_BULLETS = [(f"{n} Redistributions", "Redistributions") for n in ("1.", "2.")] + [("3. Neither", "Neither")]


def _without_numbers(text: str) -> str:
    for numbered, plain in _BSD_BULLETS:
        text = text.replace(numbered, plain)
    return text


#: the names of each license in notices
_NAMES = {
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache Software License, Version 2.0",
        "Apache Software License 2.0", "Apache 2.0 License",
    ],
    "MIT": ["MIT", "MIT License", "MIT Open Source License"],
    "MIT-0": ["MIT-0", "MIT-0 License", "MIT No Attribution License"],
    "ISC": ["ISC", "ISC License"],
    "0BSD": ["0BSD", "0BSD License", "Zero-Clause BSD License", "BSD Zero Clause License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL Version 2.0", "MPL 2.0 License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 License", "CC0 1.0 Universal", "CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal License"],
}
for _n, _word in ((2, "two"), (3, "three")):
    _NAMES[f"BSD-{_n}-Clause"] = [
        f"BSD {_n}-Clause", f"BSD {_n}-Clause License", f"{_n}-Clause BSD", f"{_n}-Clause BSD License", f"{_word}-Clause BSD License",
    ]
_CREATIVE = {"": "", "-SA": "-ShareAlike", "-NC": "-NonCommercial", "-ND": "-NoDerivatives", "-NC-SA": "-NonCommercial-ShareAlike", "-NC-ND": "-NonCommercial-NoDerivatives"}
for _short, _long in _CREATIVE.items():
    for _v, _place in (("4.0", "International"), ("3.0", "Unported")):
        _full = f"Creative Commons Attribution{_long} {_v}"
        _NAMES[f"CC-BY{_short}-{_v}"] = [
            name + license
            for name in (f"CC BY{_short} {_v}", f"CC BY{_short} {_v} {_place}", _full, f"{_full} {_place}")
            for license in ("", " License")
        ] + [f"{_full} {_place} (CC BY{_short} {_v}) License", f"{_full} {_place} (CC BY{_short} {_v})"]

#: GNU licenses: name, versions
_GNU = {
    "GPL": ("General Public License", ["2", "3"]),
    "LGPL": ("Lesser General Public License", ["2.1", "3"]),
    "AGPL": ("Affero General Public License", ["3"]),
}
_LATER = ["or later", "or any later version", "or (at your option) any later version"]


def _gnu_id(short: str, version: str, later: bool) -> str:
    return f"{short}-{version if '.' in version else version + '.0'}-{'or-later' if later else 'only'}"


for _short, (_long, _versions) in _GNU.items():
    for _v in _versions:
        _numbers = [_v] if "." in _v else [_v, f"{_v}.0"]
        _plain = [
            f"{name}{sep}{n}"
            for name in (f"GNU {_long}", f"GNU {_short}", _short)
            for sep in (" ", ", version ", " v. ", " v")
            for n in _numbers
        ] + [f"GNU {_short}v{n}" for n in _numbers] + [f"{_short}v{n}" for n in _numbers]
        _NAMES[_gnu_id(_short, _v, False)] = [n + end for n in _plain for end in ("", " License", " only")] + [
            f"version {n} of the GNU {_long}" for n in _numbers
        ]
        _NAMES[_gnu_id(_short, _v, True)] = [f"{n} {end}" for n in _plain for end in _LATER] + [f"{n}+" for n in _plain]

_APACHE_START = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""

_APACHE_END = """Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
License for the specific language governing permissions and limitations under the License."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def _notices() -> list[tuple[str, str]]:
    """One line for each way to name a license (its start is equivalent to others, see below), and its SPDX lines."""
    lines = [(license, f"Licensed under {name}") for license, names in _NAMES.items() for name in names]
    lines += [(license, f"SPDX-License-Identifier: {license}") for license in _NAMES]
    # the identifiers of the GNU licenses before they named the choice; a plus sign reads "or later"
    return lines + [
        (license, f"SPDX-License-Identifier: {license.removesuffix('-only')}") for license in _NAMES if license.endswith("-only")
    ]


def _headers() -> list[tuple[str, str]]:
    """The standard headers of source files."""
    headers = [("Apache-2.0", _APACHE_START), ("Apache-2.0", f"{_APACHE_START}\n{_APACHE_END}"), ("MPL-2.0", _MPL_HEADER)]
    for thing in ("program", "library", "file", "software"):
        for short, (long, versions) in _GNU.items():
            start = f"""This {thing} is free software: you can redistribute it and/or modify it under the terms of the
            GNU {long} as published by the Free Software Foundation"""
            end = f"""This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
            the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {long} for more details.
            You should have received a copy of the GNU {long} along with this {thing}. If not, see
            <http://www.gnu.org/licenses/>."""
            for v in versions:
                for later, which in (
                    (True, f"either version {v} of the License, or (at your option) any later version."),
                    (False, f"version {v} of the License."),
                    (False, f"version {v}."),
                ):
                    headers += [(_gnu_id(short, v, later), f"{start}, {which}{rest}") for rest in ("", f"\n{end}")]
    for short, long in _CREATIVE.items():
        for v, place in (("4.0", "International"), ("3.0", "Unported")):
            header = f"""This work is licensed under the Creative Commons Attribution{long} {v} {place} License. To view a copy
            of this license, visit http://creativecommons.org/licenses/by{short.lower()}/{v}/"""
            letter = "or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
            headers += [(f"CC-BY{short}-{v}", text) for text in (header, f"{header} {letter}")]
    return headers


KNOWN_TEXTS = [
    ("MIT", _MIT),
    ("MIT", f"MIT License\n{_MIT}"),
    ("MIT", f"The MIT License (MIT)\n{_MIT}"),
    ("MIT-0", _MIT_0),
    ("ISC", _ISC),
    ("ISC", f"ISC License\n{_ISC}"),
    ("0BSD", _ZERO_BSD),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_2}"),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_3}"),
    *[(f"BSD-{n}-Clause", title + _without_numbers(t)) for n, t in ((2, _BSD_2), (3, _BSD_3)) for title in ("", f"BSD {n}-Clause License\n")],
    *_notices(),
    *_headers(),
]

#: full texts too long to be kept here: (license, first characters, length and digest of the canonical form)
KNOWN_DIGESTS: list[tuple[str, str, int, str]] = [
    ("Apache-2.0", "apache license v", 9870, "160d6cb76caa1add9175eec346dc2e8babfed960a4d1863a998b50aa6e838efd"),
    ("Apache-2.0", "apache license v", 8865, "95757702864d8c3c53cfc7f87547fd44b8887a2c59fb6219c1cd983116a3e9d3"),
    ("CC0-1.0", "creative commons", 6690, "20de95c3fe06eca8e014e5041cd21e85467308f799b96917505c8f98b25abd9d"),
    ("GPL-2.0-only", "gnu general publ", 17069, "45ccfbf7e219f169d94e3f4ac2c637e1e4802e21df62e574d63136e7d0519607"),
    ("GPL-2.0-only", "gnu general publ", 14435, "21f0fccd8b77211e3f8c7717f80a7fb00f35503afba02e401d85a472b94fee4a"),
    ("GPL-3.0-only", "gnu general publ", 33406, "35fbb336f341997f4aa7ad96f014fc8806192a7c58b5a20eb0ac76504cb18835"),
    ("GPL-3.0-only", "gnu general publ", 30968, "1c3ca0ab23d42d6fe52b411c49c2e2c0ee4eb65d98be98c9439bda7ddcf280ec"),
    ("LGPL-2.1-only", "gnu lesser gener", 25159, "2ae8b20be6056589b42633a750c9b93220efed95a97903820b43dae623cba62a"),
    ("LGPL-2.1-only", "gnu lesser gener", 23307, "ae65072888f81ac3a4e16b30643418f1b218a98f7216cfa3c2794032efcc24a2"),
    ("LGPL-3.0-only", "gnu lesser gener", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "mozilla public l", 14339, "1e00ffd5f704611d66e3dc04dcd07ed284917bb45176558a56e7e157837cd08d"),
    ("MPL-2.0", "mozilla public l", 13647, "dca1c0454c716b4e4155eda11db07d36b2c0eb988606733853d2e395174cb37a"),
]

# Spellings that count as equal, as patterns.
EQUIVALENT = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("v 2", "version 2"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("https", "http"),
    (
        "(?:this (?:work|software|program|project|library|package|code|file|document|repository) is )?"
        "(?:licensed|released|distributed|available) under(?: the terms of)?(?: the| a| an)?",
        "licensed under",
    ),
]

#: every known text holds one of these, and every equivalent spelling of it
MARKERS = ["licen", "software", "released", "distributed", "available"]

#: notices of a copyright, also in comments; not the lines of a license text that happen to begin with the word
COPYRIGHT_LINE = (
    r"(?m)^[ \t]*(?:(?:#+|/{2,}|/?\*+|--+|;+|%+)[ \t]*)?(?:"
    r"(?i:copyright\b[ \t:,]*(?:\(c\)|©|[0-9]{4}|[<\[{]|by\b))"
    r"|[Cc]opyright[ \t]+(?!Licen|Holder|Owner|Notice|Law|Act\b|Statement|Right|Disclaim)\p{Lu}\p{Ll}"
    r"|(?i:\(c\)[ \t]*(?:copyright\b|[0-9]{4}))|\([Cc]\)[ \t]+\p{Lu}[\p{L}.]*[ \t]+\p{Lu}"
    r"|©|(?i:all rights reserved))[^\n]*$"
)

#: characters by which the beginning of a known text is found
HEAD = 16

_RUNS = "array<struct<start: int, end: int, digest: string>>"


def _canonical_lines(text: Column) -> Column:
    """The canonical form with its line breaks; lines without a letter or digit are left out."""
    form = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, " "))
    form = F.regexp_replace(form, r"(?<=[0-9])\+", " or later ")
    form = F.regexp_replace(form, r"[^\p{L}\p{N}\n]+", " ")
    form = F.regexp_replace(F.regexp_replace(form, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")
    for spelling, chosen in EQUIVALENT:
        form = F.regexp_replace(form, rf"\b{spelling.replace(' ', '[ \n]')}\b", chosen)
    return form


def canonical(text: Column) -> Column:
    """The canonical form of a text; equal forms are one license text."""
    return F.translate(_canonical_lines(text), "\n", " ")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id, head, length), one row for each distinct canonical form; the list of known texts bounds its size."""
    table = spark.createDataFrame(known or KNOWN_TEXTS, "license_id string, text string")
    form = table.select("license_id", canonical(F.col("text")).alias("form")).where("form <> ''")
    return (
        form.groupBy(F.sha2("form", 256).alias("digest"))
        .agg(
            F.min("license_id").alias("license_id"),
            F.min(F.substring("form", 1, HEAD)).alias("head"),
            F.min(F.length("form")).alias("length"),
        )
    )


def _runs(form: str, lengths: dict[str, list[int]]) -> list[tuple[int, int, str]]:
    """(start, end, digest) of the runs of lines of a form that begin like a known text and are as long as one."""
    flat, starts, at = form.replace("\n", " "), [], 0
    for line in form.split("\n"):
        starts.append(at)
        at += len(line) + 1
    ends = {s - 1 for s in starts[1:]} | {len(form)}
    shortest = min(map(len, lengths), default=0)
    runs = []
    for s in starts:
        for n in range(shortest, HEAD + 1):
            for length in lengths.get(flat[s : s + n], ()) if s + n <= len(flat) else ():
                if s + length in ends:
                    runs.append((s, s + length, hashlib.sha256(flat[s : s + length].encode()).hexdigest()))
    return runs


def _candidates(shapes: list[tuple[str, int]]):
    lengths: dict[str, set[int]] = {}
    for head, length in shapes:
        lengths.setdefault(head, set()).add(length)
    ordered = {head: sorted(own) for head, own in lengths.items()}

    def candidates(forms: pd.Series) -> pd.Series:
        return forms.map(lambda form: _runs(form, ordered) if form else [])

    return candidates


def scan_licenses(
    docs: DataFrame,
    known: list[tuple[str, str]] | None = None,
    markers: list[str] | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: all columns, ``licenses`` (sorted ids), ``whole_text`` and ``n_units``.

    A unit is a run of consecutive lines, so also the whole text, a paragraph,
    several paragraphs or a line. Of the units that are known texts, those
    inside a longer one do not count: a license that quotes a notice is one
    license. ``n_units`` counts the distinct matching units' forms of a
    document and ``whole_text`` tells that the document is nothing but a known
    text. Only documents holding one of ``markers`` are looked at; with another
    list of known texts, pass words that each of them holds (by default none
    are asked for then).

    Null, empty or matchless text gives an empty list, false and 0. Repeated
    rows each come back; ids play no part. An empty table gives an empty table.
    Columns of ``docs`` with the names of the new ones stand before them.
    """
    words = markers if markers is not None else MARKERS if known is None else []
    spark = docs.sparkSession
    own = Guarded(docs)
    body = own.col(text)
    marked = F.lit(not words)
    for word in words:
        marked = marked | F.contains(F.lower(body), F.lit(word))
    # one row for each known text: the list given bounds what is collected here and broadcast below
    listed = [tuple(r) for r in known_digests(spark, known).select("license_id", "head", "length", "digest").collect()]
    listed += [] if known else KNOWN_DIGESTS
    candidates = F.pandas_udf(_candidates([(head, length) for _, head, length, _ in listed]), _RUNS)
    scanned = own.df.withColumn("form", F.when(marked, _canonical_lines(body))).withColumn("runs", candidates("form"))
    holds = F.coalesce(F.size("runs") > 0, F.lit(False))
    keyed = scanned.withColumn("form_key", F.when(holds, F.sha2("form", 256)))
    found = _units(keyed, spark.createDataFrame(listed, "license_id string, head string, length int, digest string"))
    none = {"licenses": F.array().cast("array<string>"), "whole_text": F.lit(False), "n_units": F.lit(0).cast("long")}

    def finished(rows: DataFrame) -> DataFrame:
        return rows.select(*own.restored(), *[F.coalesce(F.col(name), empty).alias(name) for name, empty in none.items()])

    # only documents with a candidate are shuffled for the join; the join has no row for the others
    matched = keyed.where(holds).join(found, "form_key", "left")
    rest = keyed.where(~holds)
    for name in none:
        rest = rest.withColumn(name, F.lit(None).cast(found.schema[name].dataType))
    return finished(matched).unionAll(finished(rest))


def _units(keyed: DataFrame, known: DataFrame) -> DataFrame:
    """(form_key, licenses, whole_text, n_units) of the distinct forms that hold a known text.

    The digests of the candidate runs, the entire text among them, are
    hash-joined to the known digests. Of the matches of a form those inside
    another one go; a form has at most as many as its text has lines and
    the known texts have lengths.
    """
    runs = keyed.select("form_key", F.length("form").alias("size"), F.explode("runs").alias("run"))
    runs = runs.select("form_key", "size", F.col("run.start").alias("start"), F.col("run.end").alias("end"), F.col("run.digest").alias("digest"))
    matches = runs.join(F.broadcast(known.select("digest", "license_id")), "digest").distinct()
    before = Window.partitionBy("form_key").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    outer = matches.withColumn("covered", F.max("end").over(before)).where("covered is null or end > covered")
    found = outer.groupBy("form_key").agg(
        F.sort_array(F.collect_set("license_id")).alias("licenses"),
        F.max((F.col("start") == 0) & (F.col("end") == F.col("size"))).alias("whole_text"),
        F.count_distinct("digest").alias("n_units"),
    )
    return materialize(found, "license-units")
