"""License scan by canonical digest.

Known texts (whole licences, their file headers, the one-line notices that name
them and SPDX lines) and the texts at hand go through one normalisation: case, punctuation and spacing, lines
that state a copyright, and spellings that mean the same. What is left is
digested, and the digests are joined by hash: an entire text is compared with
every known one at the cost of one lookup.

Two kinds of entire texts are looked up: the document as a whole, and each of
its lines by itself, as notices stand among other text.

Defined results: null counts as empty; a text with nothing left after
normalisation matches nothing; a copyright line alone is nothing. If two known
texts come to the same digest the first by name stands. Rows are one for one with
the input, repeated rows, null and repeated ids included; an empty table or an
empty registry gives no matches. Extra columns are not looked at.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import let, text_of

# Spellings that mean the same in licences: fixed values, whole words after
# the other steps, each as (from, to).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorise", "authorize"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("modernise", "modernize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("utilise", "utilize"),
    ("whilst", "while"),
    ("noncommercial", "non commercial"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

_BSD_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""



def _short_texts():
    """(license_id, text) of the usual editions of the MIT, ISC and BSD licences."""
    mit = (_MIT, _MIT.replace("this permission notice shall", "this permission notice (including the next paragraph) shall"))
    for text in mit:
        for title in ("", "MIT License", "The MIT License", "(MIT)", "The MIT License (MIT)"):
            yield "MIT", f"{title}\n\n{text}"
    isc = _ISC.replace("modify, and/or distribute", "modify, and distribute")
    for text in (_ISC, isc):
        for title in ("", "ISC License", "The ISC License", "ISC License (ISC)"):
            yield "ISC", f"{title}\n\n{text}"
    ends = [_BSD_END]
    ends.append(_BSD_END.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"))
    ends += [e.replace("BY THE COPYRIGHT HOLDERS AND", "BY THE COPYRIGHT OWNER AND") for e in ends[:2]]
    for end in ends:
        for name, conditions, titles in (
                ("BSD-2-Clause", _BSD_2, ("", "BSD 2-Clause License", 'BSD 2-Clause "Simplified" License')),
                ("BSD-3-Clause", _BSD_2 + _BSD_3, ("", "BSD 3-Clause License", "The 3-Clause BSD License",
                                                  'BSD 3-Clause "New" or "Revised" License'))):
            for title in titles:
                for marks in (conditions, re.sub(r"(?m)^[123]\. ", "* ", conditions)):
                    yield name, f"{title}\n\n{marks}\n{end}"


# Whole texts and identifiers that come as files (id.txt; id~n.txt is the same
# licence in another edition).
FOLDER = Path(__file__).with_name("license_texts")


def _whole_texts():
    """(license_id, text) of the files, each also without the part on how to
    apply it, without the copyright line to fill in, and without its title."""
    for file in sorted(FOLDER.glob("*.txt")):
        if file.name == "spdx_ids.txt":
            continue
        name = file.stem.split("~")[0]
        text = file.read_text(encoding="utf-8")
        ends = [text]
        found = re.search(r"\n[^\n]*END OF TERMS AND CONDITIONS[^\n]*\n", text)
        if found:
            ends += [text[:found.start()], text[:found.end()]]
        found = re.search(r"\n[^\n]*Exhibit A - Source Code Form License Notice", text)
        if found:
            ends += [text[:found.start()]]
        for t in ends:
            filled = re.sub(r"\n[^\n]*Copyright (?:\[|\{|<)?yyyy[^\n]*", "", t)
            for u in {t: 0, filled: 0}:
                yield name, u
                if name in TITLES:
                    yield name, TITLES[name] + "\n\n" + u


# Titles that stand or do not stand above a text.
TITLES = {"0BSD": "Zero-Clause BSD", "ISC": "The ISC License", "Unlicense": "The Unlicense", "Zlib": "zlib License",
          "CC-BY-4.0": "Creative Commons", "CC-BY-SA-4.0": "Creative Commons", "CC0-1.0": "Creative Commons Legal Code"}

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at {url}

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""

_ASF_HEADER = """Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the
NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses
this file to you under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. """

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at {url}"""

_MPL_SECONDARY = """
This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0."""

_GNU_HEADER = """This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the
{name} as published by the Free Software Foundation{version}

This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""

# Ends of the GNU headers, after "a copy of the <name>".
_GNU_ENDS = (
    " along with this {thing}. If not, see <https://www.gnu.org/licenses/>.",
    " along with this {thing}. If not, see <http://www.gnu.org/licenses/>.",
    " along with this {thing}; if not, see <https://www.gnu.org/licenses/>.",
    " along with this {thing}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor,"
    " Boston, MA 02110-1301 USA.",
    " along with this {thing}; if not, write to the Free Software Foundation, Inc., 51 Franklin St, Fifth Floor,"
    " Boston, MA 02110-1301 USA",
    " along with this {thing}; if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330,"
    " Boston, MA 02111-1307 USA",
    " along with this {thing}; if not, write to the Free Software Foundation, Inc., 59 Temple Place - Suite 330,"
    " Boston, MA 02111-1307, USA.",
    " along with this {thing}; if not, write to the Free Software Foundation, Inc., 675 Mass Ave, Cambridge,"
    " MA 02139, USA.",
)

# GNU licences: id, name, version, the things its headers speak of.
_GNU = (
    ("GPL-2.0", "GNU General Public License", "2", ("program", "library", "file", "software")),
    ("GPL-3.0", "GNU General Public License", "3", ("program", "library", "file", "software")),
    ("LGPL-2.0", "GNU Library General Public License", "2", ("program", "library", "file", "software")),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", ("program", "library", "file", "software")),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", ("program", "library", "file", "software")),
    ("AGPL-3.0", "GNU Affero General Public License", "3", ("program", "library", "file", "software")),
)


def _beginnings(text, least):
    """The beginnings of a header that hold its first ``least`` words: where a line
    may end."""
    words = text.split()
    return [" ".join(words[:n]) for n in range(least, len(words) + 1)]


def _headers():
    """(license_id, text) of the usual file headers, and of the lines of them
    that name the licence and its version."""
    for scheme in ("http", "https"):
        for end in ("", ".html", ".txt"):
            body = _APACHE_HEADER.format(url=f"{scheme}://www.apache.org/licenses/LICENSE-2.0{end}")
            yield "Apache-2.0", body
            yield "Apache-2.0", _ASF_HEADER + body[body.index("You may obtain"):]
        url = f"{scheme}://mozilla.org/MPL/2.0/."
        for end in (url, url.replace("mozilla", "www.mozilla")):
            yield "MPL-2.0", _MPL_HEADER.format(url=end)
            yield "MPL-2.0-no-copyleft-exception", _MPL_HEADER.format(url=end) + "\n" + _MPL_SECONDARY
    for line in _beginnings(_APACHE_HEADER.split(". You may obtain")[0], 9):
        yield "Apache-2.0", line
    for line in _beginnings(_MPL_HEADER.split(", You can")[0], 16):
        yield "MPL-2.0", line
    yield "MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"
    for base, name, number, things in _GNU:
        only = (f"; version {number} of the License.", f", version {number}.", f"; version {number}.")
        later = (f", either version {number} of the License, or (at your option) any later version.",)
        for suffix, versions in (("-only", only), ("-or-later", later)):
            for version in versions:
                for thing in things:
                    for receive in (f"You should have received a copy of the {name}",
                                    f"You should have received a copy of the {name} v{number}"):
                        body = _GNU_HEADER.format(thing=thing, mark=":", name=name, version=version)
                        yield base + suffix, body
                        for end in _GNU_ENDS:
                            yield base + suffix, body + "\n\n" + receive + end.format(thing=thing)


# Creative Commons licences: id, letters, words.
_CC = (
    ("CC-BY", "BY", "Attribution"),
    ("CC-BY-SA", "BY-SA", "Attribution-ShareAlike"),
    ("CC-BY-NC", "BY-NC", "Attribution-NonCommercial"),
    ("CC-BY-ND", "BY-ND", "Attribution-NoDerivatives"),
    ("CC-BY-NC-SA", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-NC-ND", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)


def _notices():
    """(license_id, text) of one-line notices."""
    named = [("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"),
             ("MIT", "MIT License"), ("ISC", "ISC License"), ("MPL-2.0", "Mozilla Public License, Version 2.0"),
             ("MPL-2.0", "Mozilla Public License 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
             ("BSD-3-Clause", "BSD 3-Clause License"), ("CC0-1.0", "CC0 1.0"), ("Unlicense", "Unlicense")]
    for base, name, number, _ in _GNU:
        named += [(base, f"{name}, version {number}"), (base, f"{name} version {number}"), (base, f"{name} v{number}")]
    for i, letters, words in _CC:
        for version, area in (("4.0", "International"), ("3.0", "Unported")):
            named += [(f"{i}-{version}", f"CC {letters} {version}"),
                      (f"{i}-{version}", f"Creative Commons {words} {version} {area} License"),
                      (f"{i}-{version}", f"Creative Commons {words} {version} {area}")]
    for i, name in named:
        for how in ("Licensed under", "Released under", "Distributed under", "This work is licensed under",
                    "This project is licensed under", "This software is licensed under"):
            for article in ("", "the ", "a "):
                yield i, f"{how} {article}{name}."


# Licences of which pairs are looked up in SPDX lines, and pairs with an exception.
_PAIRED = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GPL-2.0", "GPL-2.0-only",
           "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
           "MIT", "MPL-2.0", "Unlicense", "Zlib")
_EXCEPTED = ("Apache-2.0 WITH LLVM-exception", "GPL-2.0 WITH Linux-syscall-note",
             "GPL-2.0-only WITH Linux-syscall-note", "GPL-2.0-or-later WITH Linux-syscall-note",
             "GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-or-later WITH Classpath-exception-2.0",
             "GPL-3.0-or-later WITH GCC-exception-3.1", "LGPL-2.1-or-later WITH Linux-syscall-note")


def _spdx():
    """(license_id, text) of SPDX lines: every identifier of the SPDX list, and
    expressions of two of the commonest."""
    ids = (FOLDER / "spdx_ids.txt").read_text(encoding="utf-8").split()
    pairs = [f"{a} {op} {b}" for a in _PAIRED for b in _PAIRED if a != b for op in ("AND", "OR")]
    for name in (*ids, *pairs, *_EXCEPTED):
        yield name, f"SPDX-License-Identifier: {name}"


# Known texts by licence: fixed values and the files. A registry table
# (license_id, text) of any size can take their place.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD_2 + "\n" + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2 + "\n" + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + "\n" + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_2 + _BSD_3 + "\n" + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    *_short_texts(),
    *_whole_texts(),
    *_headers(),
    *_notices(),
    *_spdx(),
)

# Steps on lower-case text, in order, each as (pattern, replacement); line feeds
# stay, so that one pass serves the whole text and its lines.
STEPS = (
    (r"^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*(?:[0-9]{4}|©|\(c\)|all rights reserved)[^\n]*$", " "),
    (r"^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$", " "),
    (r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " "),
)


def _plain(text: Column) -> Column:
    """Lower-case words and line feeds, copyright lines emptied."""
    text = F.lower(text)
    for pattern, to in STEPS:
        text = F.regexp_replace(text, "(?md)" + pattern, to)
    return text


def _spelt(words: Column) -> Column:
    """One spelling of words between single spaces."""
    odd = " (?:" + "|".join(a for a, _ in SPELLINGS) + ") "

    def replaced(text):
        for a, b in SPELLINGS:
            text = F.replace(text, F.lit(f" {a} "), F.lit(f" {b} "))
        return F.trim(text)
    return let(F.concat(F.lit(" "), F.trim(words), F.lit(" ")),
               lambda t: F.when(t.rlike(odd), replaced(t)).otherwise(F.trim(t)))


def _whole(plain: Column) -> Column:
    return _spelt(F.regexp_replace(plain, "[ \n]+", " "))


def canonical(text: Column) -> Column:
    """The normalised text: lower-case words with single spaces between them."""
    return _whole(_plain(text))


def digest(normal: Column) -> Column:
    """SHA-256 of a normalised text; null if nothing is left."""
    return F.sha2(F.nullif(normal, F.lit("")), 256)


def registry(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license_id) of known (license_id, text) pairs or of a table of
    these columns, one row a digest."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license_id string, text string")
    return (known.select(digest(canonical(F.col("text"))).alias("digest"), "license_id").where("digest IS NOT NULL")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_digest, license_id (of the whole text),
    notices (sorted licences of single lines, comma-joined) and n_notices."""
    # Written out, so that the join is planned by the registry's real size: a
    # small one is looked up where the digests are made.
    known = materialize(registry(docs.sparkSession) if known is None else known, "licenses")
    plain = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                        _plain(text_of(docs)).alias("plain"))
    # Units: the whole text (line 0) and its lines. Only digests travel.
    normal = F.concat(F.array(_whole(F.col("plain"))), F.transform(F.split("plain", "\n"), _spelt))
    units = (plain.select("rid", "doc_id", F.posexplode(normal).alias("line", "normal"))
             .select("rid", "doc_id", "line", digest(F.col("normal")).alias("digest"))
             .where("line = 0 OR digest IS NOT NULL"))
    found = units.join(known, "digest", "left").where("line = 0 OR license_id IS NOT NULL")
    whole = F.col("line") == 0
    return (found.groupBy("rid", "doc_id").agg(
                F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
                F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
                F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("license_id")))), ",").alias("notices"),
                F.count(F.when(~whole, F.col("license_id"))).alias("n_notices"))
            .drop("rid"))


def _sql_plain(text: str) -> str:
    out = f"lower({text})"
    for pattern, to in STEPS:
        out = f"regexp_replace({out}, '(?m){pattern}', '{to}', 'g')"
    return out


def _sql_spelt(words: str) -> str:
    out = f"' ' || trim({words}) || ' '"
    for a, b in SPELLINGS:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


def _sql_canonical(text: str) -> str:
    spaced = f"regexp_replace({_sql_plain(text)}, '[ \n]+', ' ', 'g')"
    return _sql_spelt(spaced)


def oracle() -> str:
    def quote(x):
        return "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in KNOWN)
    return f"""
WITH known AS (
  SELECT c, min(license_id) AS license_id FROM (
    SELECT license_id, {_sql_canonical('t')} AS c FROM (VALUES {values}) v(license_id, t)) GROUP BY c),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
whole AS (SELECT rid, doc_id, {_sql_canonical('t')} AS c FROM d),
lines AS (
  SELECT rid, {_sql_spelt('l')} AS c
  FROM (SELECT rid, unnest(string_split({_sql_plain('t')}, chr(10))) AS l FROM d)),
notices AS (
  SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n
  FROM lines JOIN known USING (c) WHERE c <> '' GROUP BY rid)
SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS text_digest, license_id,
  coalesce(notices, '') AS notices, coalesce(n, 0)::BIGINT AS n_notices
FROM whole LEFT JOIN known USING (c) LEFT JOIN notices USING (rid)
"""
