"""Operator 3: licence scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

* Passages: of every whole text, the leading comment; the lines that hold a mark of licence prose; these with the one and
  two lines after them; the blocks of lines without a blank line between, and neighbouring blocks that hold a mark; the
  sentences of all of these; the first ``OPENING`` words; and the whole text.  What is longer than ``WHOLE`` words is
  compared in windows of as many, which follow each other by half.  Comment marks and line breaks are folded to spaces.
  Passages that say that something is not under a licence are left out.  An SPDX line names its licence by itself, the
  first known one of an expression; so does a Creative Commons deed link, alone in its passage or beside licence prose.
  Passages are compared as sparse TF-IDF vectors with the templates by cosine, each distinct passage once; document
  frequencies are counted over all files for every token of a passage or template.  A licence is named only by passages
  that hold its family and version (``NEEDS``), whatever the cosine.  The best template of at least ``threshold`` is the
  file's own licence.
* Licence files: files so named, and files of which licence passages make up at least ``coverage`` of the words.
  The best licence file of a directory (by score, then by name of the licence) names the directory's licence.
* Inheritance: the distinct directories of files are expanded to their ancestors and joined by path with the
  directories that have a licence; the nearest one counts.  Files without a licence of their own take it by a join on
  their directory.

Defined results: null and empty texts have no licence of their own but inherit; null paths are not in a directory;
ties go to the licence first in alphabetical order; repeated rows get equal results; an empty table gives an empty
result.  A passage without the version, or of a family without a template, names no licence.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

THRESHOLD, COVERAGE = 0.6, 0.5
FLUSH = 200_000  # distinct tokens counted by a task before they are sent on

# Short notices and opening sentences by which public licences are known.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal, public domain dedication."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]
_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General "
        "Public License as published by the Free Software Foundation, either version {1} of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "{0}General Public License for more details. You should have received a copy of the GNU {0}General Public License "
        "along with this program. If not, see <https://www.gnu.org/licenses/>.")
_VERBATIM = ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
             "allowed.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
# Whole headers and texts.
TEMPLATES += [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                   "REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                                 "endorse or promote products derived from this software without specific prior written "
                                 "permission. ")),
    ("GPL-2.0", _GPL.format("", 2)), ("GPL-3.0", _GPL.format("", 3)),
    ("LGPL-2.1", _GPL.format("Lesser ", "2.1")), ("LGPL-3.0", _GPL.format("Lesser ", 3)),
    ("AGPL-3.0", _GPL.format("Affero ", 3)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. " + _VERBATIM),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
                "<https://fsf.org/> " + _VERBATIM),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
]
# Further licences by their notices and headings.
TEMPLATES += [
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Artistic-1.0", "Licensed under the Artistic License, Version 1.0."),
    ("Artistic-2.0", "The Artistic License 2.0"),
    ("Artistic-2.0", "Licensed under the Artistic License, Version 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "Creative Commons Zero 1.0 Universal Public Domain Dedication"),
    ("CDDL-1.0", "Licensed under the Common Development and Distribution License, Version 1.0."),
    ("EPL-1.0", "Licensed under the Eclipse Public License, Version 1.0."),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, Version 1.2."),
    ("GPL-2.0", "Licensed under the GPLv2."), ("GPL-3.0", "Licensed under the GPLv3."),
    ("HPND", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose and without "
             "fee is hereby granted, provided that the above copyright notice appear in all copies and that both that "
             "copyright notice and this permission notice appear in supporting documentation"),
    ("ISC", "Released under the ISC License."),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("WTFPL", "Do What The Fuck You Want To Public License, Version 2"),
    ("Zlib", "Released under the zlib License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
]
# The kinds of Creative Commons licences and the titles of their versions.
CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
for _kind, _title in CC_KINDS.items():
    for _version, _scope in CC_VERSIONS.items():
        TEMPLATES += [(f"CC-{_kind}-{_version}", f"Licensed under CC {_kind} {_version}."),
                      (f"CC-{_kind}-{_version}", f"Licensed under a Creative Commons {_title} {_version} {_scope} License.")]
TEMPLATES = list(dict.fromkeys(TEMPLATES))
# A passage names the licence only if it holds all tokens of one of these sets: family, version, clauses.
NEEDS = {
    "AGPL-3.0": [{"affero", "3"}, {"agplv3"}, {"agpl", "3"}], "Apache-1.1": [{"apache", "1.1"}], "Apache-2.0": [{"apache", "2"}],
    "Artistic-1.0": [{"artistic", "1"}], "Artistic-2.0": [{"artistic", "2"}],
    "BSD-2-Clause": [{"bsd", "2", "clause"}, {"bsd", "two", "clause"}, {"bsd", "two-clause"}, {"redistribution", "binary", "forms"}],
    "BSD-3-Clause": [{"bsd", "3", "clause"}, {"bsd", "three", "clause"}, {"bsd", "three-clause"}, {"redistribution", "binary", "forms"}],
    "BSL-1.0": [{"boost", "1"}], "CC0-1.0": [{"cc0"}, {"commons", "zero"}], "CDDL-1.0": [{"development", "distribution", "1"}],
    "EPL-1.0": [{"eclipse", "1"}], "EPL-2.0": [{"eclipse", "2"}], "EUPL-1.2": [{"european", "1.2"}],
    "GPL-2.0": [{"gnu", "2"}, {"gpl", "2"}, {"gplv2"}], "GPL-3.0": [{"gnu", "3"}, {"gpl", "3"}, {"gplv3"}],
    "HPND": [{"fee", "hereby", "granted"}], "ISC": [{"isc"}, {"fee", "hereby", "granted"}],
    "LGPL-2.1": [{"lesser", "2.1"}, {"lgpl", "2.1"}], "LGPL-3.0": [{"lesser", "3"}, {"lgpl", "3"}, {"lgplv3"}],
    "MIT": [{"mit"}, {"hereby", "granted", "free", "charge"}], "MPL-1.1": [{"mozilla", "1.1"}, {"mpl", "1.1"}],
    "MPL-2.0": [{"mozilla", "2"}, {"mpl", "2"}], "OFL-1.1": [{"font", "1.1"}, {"ofl", "1.1"}],
    "Unlicense": [{"unencumbered"}, {"unlicense"}], "WTFPL": [{"wtfpl"}, {"want", "fuck"}],
    "Zlib": [{"zlib"}, {"granted", "anyone", "alter"}],
}
for _kind, _title in CC_KINDS.items():
    for _version in CC_VERSIONS:
        _v = _version.removesuffix(".0")
        NEEDS[f"CC-{_kind}-{_version}"] = [{"cc", _kind.lower(), _v}, {"commons", _title.lower(), _v}]
# Tokens by which a passage that would name the licence speaks of another one of its family.
OTHERS = {"BY": {"sharealike", "noncommercial", "noderivatives", "noderivs", "share-alike", "non-commercial"}}
OPENING, WHOLE = 60, 400  # words of the opening; words of a window of a longer text, which follow each other by half
_COMMENT = re.compile(r"^[ \t]*(?:(?://+|/\*+|\*+/?|#+|;+|--+|<!--|\(\*|%+|dnl\b|rem\b)[ \t]*)|[ \t]*(?:\*+/|-->|\*\))[ \t]*$", re.I)
_SPDX = re.compile(r"SPDX-License-Identifier:\s*(.*)", re.I)
_MARK = re.compile(r"licen[sc]e|permission|redistribution|public domain|source code form|creativecommons\.org|\bcc0\b", re.I)
_LINK = re.compile(r"(?:https?://)?(?:www\.)?creativecommons\.org/(?:licenses/(by(?:-nc)?(?:-sa|-nd)?)/(\d\.\d)|publicdomain/zero/1\.0)\S*", re.I)
# "not released under", "is no longer available under": the passage speaks of a licence that does not hold
_NOT = re.compile(r"\b(?:not|never|no longer|cannot|isn't|aren't)\s+(?:\S+\s+){0,3}?(?:licen[sc]ed|released|distributed|available|"
                  r"offered|published|provided)\s+(?:\S+\s+)?under\b", re.I)
_TOKEN = re.compile(r"[a-z]+[a-z0-9]*(?:-[a-z0-9]+)*|\d+(?:\.\d+)*")
_LINE = re.compile(r"[^\n]+")
_WORD = re.compile(r"\S+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([.-][^/]*)?$"


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


VOCABULARY = sorted({t for _, text in TEMPLATES for t in tokens(text)})


def spdx(expression: str) -> str | None:
    """The first licence of an SPDX expression that has a template."""
    known = {name.lower(): name for name, _ in TEMPLATES}
    for x in re.findall(r"[A-Za-z0-9.+-]+", expression):
        name = known.get(re.sub(r"(-only|-or-later|\+)$", "", x.lower()))
        if name:
            return name
    return None


def named(passage: str) -> str | None:
    """The licence that an SPDX line, or a deed link that stands alone or beside licence prose, names by itself."""
    line = _SPDX.search(passage)
    if line:
        return spdx(line[1])
    link = _LINK.search(passage)
    if link:
        beside = _LINK.sub(" ", passage)
        if _MARK.search(beside) or not re.search(r"\w", beside):
            return f"CC-{link[1].upper()}-{link[2]}" if link[1] else "CC0-1.0"
    return None


def windows(text: str, lines: list[tuple]) -> Iterator[tuple[str, int, int]]:
    """Folded lines as one passage, or as windows of ``WHOLE`` words that follow each other by half, so that every
    stretch of half as many words lies in one whole."""
    words = []
    for body, a, b, *_ in lines:
        raw = [m.span() for m in _WORD.finditer(text, a, b)]
        own = body.split()
        lead = len(raw) - len(own)  # comment marks before the line's words
        words += [(w, *raw[min(j + max(lead, 0), len(raw) - 1)]) for j, w in enumerate(own)]
    for i in range(0, max(1, len(words) - WHOLE + WHOLE // 2), WHOLE // 2):
        part = words[i:i + WHOLE]
        if part:
            yield " ".join(w for w, _, _ in part), part[0][1], part[-1][2]


def passages(text: str | None) -> list[tuple[str, int, int]]:
    """Passages with a mark of licence prose, folded, with their first and end character."""
    if not text or not _MARK.search(text):
        return []
    # folded lines and where they stand; blank lines part the blocks
    lines, block, blank, lead = [], 0, True, 0
    for m in _LINE.finditer(text):
        named = _SPDX.search(m[0])
        body = m[0] if named else _COMMENT.sub("", m[0])
        body = " ".join(body.split())
        far = text.count("\n", lines[-1][2] if lines else 0, m.start()) > 1
        if not body or (far and not blank):
            block += not blank
            blank = True
        if body:
            lines.append((body, m.start(), m.end(), block, bool(_MARK.search(body)), bool(named)))
            blank = False
            if lead == len(lines) - 1 and (named or _COMMENT.match(m[0])):
                lead += 1  # lines of the leading comment
    out: dict[tuple[str, int, int], None] = {}

    def add(first: int, end: int) -> None:
        part = [x for x in lines[first:end] if not x[5]]
        whole = " ".join(x[0] for x in part)
        if part and _MARK.search(whole):
            if len(whole.split(None, WHOLE)) <= WHOLE:
                if not _NOT.search(whole):
                    out[whole, part[0][1], part[-1][2]] = None
            else:
                for piece, a, b in windows(text, part):
                    if _MARK.search(piece) and not _NOT.search(piece):
                        out[piece, a, b] = None
            for s in _SENTENCE.split(whole):
                if _MARK.search(s) and not _NOT.search(s):
                    # a sentence of one line stands somewhere in it; a wrapped one in the lines that hold its words
                    at = text.find(s, part[0][1], part[-1][2])
                    if at >= 0:
                        out[s, at, at + len(s)] = None
                    else:
                        words, k, a, b = whole.index(s), 0, None, None
                        for x in part:
                            if k + len(x[0]) > words and k < words + len(s):
                                a, b = x[1] if a is None else a, x[2]
                            k += len(x[0]) + 1
                        out[s, a, b] = None

    for i, x in enumerate(lines):
        if x[5]:
            out[x[0], x[1], x[2]] = None
        elif x[4]:
            for n in (1, 2, 3):
                add(i, i + n)
    blocks = sorted({x[3]: i for i, x in reversed(list(enumerate(lines)))}.items())
    ends = [i for _, i in blocks[1:]] + [len(lines)]
    words = [len(x[0].split()) for x in lines]
    first = None
    for (_, a), b in zip(blocks, ends):
        marked = any(x[4] for x in lines[a:b])
        if marked:
            add(a, b)
            if first is not None and sum(words[first:b]) <= WHOLE:
                add(first, b)
        first = (a if first is None or sum(words[first:b]) > WHOLE else first) if marked else None
    n = 0
    for i, k in enumerate(words):  # the opening, by whole lines
        n += k
        if n >= OPENING:
            add(0, i + 1)
            break
    for end in {lead, len(lines)}:
        add(0, end)
    return list(out)


def _hash(passage: str) -> int:
    return xxhash.xxh64_intdigest(passage) - (1 << 63)


def possible(times: dict[str, int]) -> set[str]:
    """The licences that a passage with these tokens may name: by family, version and clauses."""
    held = set(times) | {t[1:] for t in times if re.fullmatch(r"v\d+", t)} | {t[:-2] for t in times if re.fullmatch(r"\d+\.0", t)}
    out = {name for name, sets in NEEDS.items() if any(x <= held for x in sets)}
    if OTHERS["BY"] & held:
        out -= {f"CC-BY-{v}" for v in CC_VERSIONS}
    # every "General Public License" of the passage is a lesser or an Affero one
    other = times.get("lesser", 0) + times.get("affero", 0)
    if other and other >= times.get("general", 0):
        out -= {"GPL-2.0", "GPL-3.0"}
    return out


class Matcher:
    """Cosine of sparse TF-IDF vectors to the templates; ``n`` are document frequencies of their tokens."""

    def __init__(self, n: dict[str, int], total: int):
        self.total = total
        self.vectors = [(name, *self._vector((t, k, n.get(t, 0)) for t, k in Counter(tokens(text)).items()))
                        for name, text in TEMPLATES]

    def _vector(self, counts: Iterable[tuple[str, int, int]]) -> tuple[dict[str, float], float]:
        v = {t: (1 + math.log(k)) * (math.log((1 + self.total) / (1 + n)) + 1) for t, k, n in counts}
        return v, math.sqrt(sum(v[t] * v[t] for t in sorted(v))) or 1.0

    def best(self, counts: Iterable[tuple[str, int, int]]) -> tuple[float, str]:
        """Of a passage's ``(token, times, files with it)``."""
        counts = list(counts)
        names = possible({t: k for t, k, _ in counts})
        if not names:
            return 0.0, ""
        v, size = self._vector(counts)
        found = (0.0, "")
        for name, t, norm in self.vectors:
            if name not in names:
                continue
            s = sum(x * v[w] for w, x in t.items() if w in v) / (size * norm)
            if s > found[0] + 1e-12 or (abs(s - found[0]) <= 1e-12 and name < found[1]):
                found = (s, name)
        return found


def frequencies(texts: DataFrame) -> DataFrame:
    """``(token, n)``: how many rows of ``(text)`` hold each token."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = Counter()
        table = lambda: pd.DataFrame({"token": list(n), "n": list(n.values())}).astype({"token": str, "n": "int64"})
        for pdf in batches:
            for t in pdf["text"]:
                n.update(set(tokens(t or "")))
                if len(n) > FLUSH:
                    yield table()
                    n.clear()
        yield table()

    return texts.select("text").mapInPandas(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def matches(src: DataFrame, total: int, threshold: float) -> DataFrame:
    """``(h, license, score)`` of the distinct passages of ``src`` that reach ``threshold``; h: hash of the passage."""
    spark = src.sparkSession

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = sorted({p for t in pdf["text"] for p, _, _ in passages(t)})
            yield pd.DataFrame({"h": [_hash(p) for p in found], "p": found}).astype({"h": "int64", "p": str})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(h, t, k) for h, p in zip(pdf["h"], pdf["p"]) if not _SPDX.search(p)
                   for t, k in Counter(tokens(p)).items()]
            yield pd.DataFrame(out, columns=["h", "token", "k"]).astype({"h": "int64", "token": str, "k": "int32"})

    # written, so that the joins have shuffles of their own on both sides and Spark can split a frequent token
    distinct = cut(src.select("text").mapInPandas(read, "h long, p string").groupBy("h").agg(F.min("p").alias("p")))
    parts = cut(distinct.mapInPandas(split, "h long, token string, k int"))
    known = spark.createDataFrame([(t,) for t in VOCABULARY], "token string")
    wanted = parts.select("token").union(known).distinct()
    n = cut(frequencies(src).join(wanted, "token", "left_semi"))
    mine = {r["token"]: r["n"] for r in n.join(F.broadcast(known), "token").collect()}  # the templates' vocabulary
    shared = spark.sparkContext.broadcast(Matcher(mine, total))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = [shared.value.best(zip(*c)) for c in zip(pdf["ts"], pdf["ks"], pdf["ns"])]
            yield pd.DataFrame({"h": pdf["h"], "license": [b[1] for b in best], "score": [float(b[0]) for b in best]})

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(h, named(p), 1.0) for h, p in zip(pdf["h"], pdf["p"])]
            yield pd.DataFrame([x for x in out if x[1]], columns=["h", "license", "score"]).astype({"h": "int64", "license": str, "score": float})

    whole = (parts.join(n, "token", "left").groupBy("h").agg(
        F.sort_array(F.collect_list(F.struct("token", "k", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))
        .select("h", F.col("c.token").alias("ts"), F.col("c.k").alias("ks"), F.col("c.n").alias("ns")))
    schema = "h long, license string, score double"
    return cut(whole.mapInPandas(match, schema).where(F.col("score") >= threshold).union(distinct.mapInPandas(name, schema)))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, keys: list[str], path: str = "path", text: str = "text", threshold: float = THRESHOLD,
         coverage: float = COVERAGE) -> DataFrame:
    """``keys`` + ``(file_path, license, score, origin, origin_dir)`` for every file; origin is own, inherited or null."""
    own = [f"__key{i}" for i in range(len(keys))]
    src = files.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keys, own)],
                       F.col(f"`{path}`").cast("string").alias("path"), F.col(f"`{text}`").alias("text"))
    schema = src.drop("text").select("*", F.lit(0).alias("size"), F.expr(
        "array(named_struct('h', 0L, 'a', 0, 'b', 0))").alias("found")).schema
    for f in schema.fields:
        f.nullable = True

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size, found = [], []
            for t in pdf.pop("text"):
                some = passages(t)
                starts = [m.start() for m in _WORD.finditer(t)] if some else []
                size.append(len(starts))
                found.append([{"h": _hash(p), "a": bisect_left(starts, a), "b": bisect_left(starts, b)} for p, a, b in some])
            pdf["size"], pdf["found"] = size, found
            yield pdf

    files = cut(src.mapInPandas(read, schema).withColumn("rid", F.monotonically_increasing_id()))
    hits = files.select("rid", F.explode("found").alias("f")).select("rid", "f.*").join(
        matches(src, files.count(), threshold), "h")
    # words that some matching passage covers, each counted once
    spans = F.sort_array(F.collect_set(F.struct("a", "b")))  # the passages of one file
    words = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda c, x: F.struct(
        F.greatest(c["end"], x["b"]).alias("end"),
        (c["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(c["end"], x["a"]))).alias("n")))["n"]
    best = (hits.groupBy("rid").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("m"), spans.alias("spans"))
            .select("rid", F.col("m.license").alias("license"), (-F.col("m.s")).alias("score"), words.alias("words")))
    rows = cut(files.join(best, "rid", "left").select(
        *own, "path", "license", F.coalesce("score", F.lit(0.0)).alias("score"),
        (F.coalesce("words", F.lit(0)) / F.greatest(F.lit(1), F.col("size"))).alias("share"), _parent(F.col("path")).alias("dir")))
    named = F.col("license").isNotNull() & F.col("dir").isNotNull()
    holders = (rows.where(named & (F.col("path").rlike(_FILE) | (F.col("share") >= coverage)))
               .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l"))).alias("m"))
               .select(F.col("dir").alias("up"), F.col("m.l").alias("l"), (-F.col("m.s")).alias("s")))
    parts = F.split("dir", "/")
    dirs = rows.where(F.col("dir").isNotNull()).select("dir").distinct()
    ups = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select(
        "dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("up")).where(
        (F.col("depth") > 0) | (F.col("dir") != ""))
    near = (ups.join(holders, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "l", "s")).alias("m"))
            .select("dir", F.col("m.up").alias("up"), F.col("m.l").alias("l"), F.col("m.s").alias("s")))
    out = rows.join(near, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keys, own) if c not in {"file_path", "license", "score", "origin", "origin_dir"}],
        F.col("path").alias("file_path"), F.coalesce("license", "l").alias("license"),
        F.when(mine, F.col("score")).otherwise(F.coalesce("s", F.lit(0.0))).alias("score"),
        F.when(mine, "own").when(F.col("l").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("up")).alias("origin_dir"))
