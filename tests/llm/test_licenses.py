"""Names of common notices, long texts, and the whole scan against a plain recomputation."""
import math
import os
from collections import Counter

import pytest

from mixcast.llm import licenses

NOTICES = [
    ("Licensed under the Eclipse Public License, version 2.0.", "EPL-2.0"),
    ("Artistic License, Version 2.0", "Artistic-2.0"),
    ("Apache License, Version 1.1", "Apache-1.1"),
    ("This is not released under the MIT License.", None),
    ("Licensed under the BSD License.", None),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
     "following restrictions:", "Zlib"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("https://creativecommons.org/licenses/by-sa/4.0/", "CC-BY-SA-4.0"),
    ("Licence: http://creativecommons.org/licenses/by-nc-nd/3.0", "CC-BY-NC-ND-3.0"),
    ("A picture by Jo (https://creativecommons.org/licenses/by/2.0/)", None),
    ("CC0 1.0 Universal", "CC0-1.0"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
    ("Licensed under the GNU Lesser General Public License, version 2.", None),
    ("This work is licensed under the GNU General Public License v3.0.", "GPL-3.0"),
    ("Licensed under the Common Public License, version 1.0.", None),
    ("It was never distributed under the GNU General Public License, version 2. Released under the MIT License.", "MIT"),
]


def test_common_notices_have_their_names(spark):
    rows = [(f"d{i}/a", text, i) for i, (text, _) in enumerate(NOTICES)]
    rows += [(f"e/{i}", f"words of file {i} about rivers and version {i}", 1000 + i) for i in range(40)]
    out = {r.k: r.license for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, k int"), ["k"]).collect()}
    assert [(text, out[i]) for i, (text, _) in enumerate(NOTICES)] == NOTICES
    assert all(out[k] is None for k in range(1000, 1040))


def test_notices_deep_in_long_texts_are_found():
    mit = max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len)
    for lead in (0, 137, 399, 1203):  # one line without a sentence end but in the notice
        text = "river " * lead + mit + " lake" * 700
        inside = [p for p, a, b in licenses.passages(text) if "hereby granted" in p and "DEALINGS IN THE SOFTWARE" in p.upper()]
        assert inside and all(len(p.split()) <= licenses.WHOLE for p in inside)
        covered = set()
        for p, a, b in licenses.windows(text, [(text.strip(), 0, len(text))]):
            assert text[a:b].split() == p.split()
            covered |= set(range(a, b))
        assert len(text.strip()) - len(covered) <= text.count(" ")


def _plain(rows):
    """Licence and origin of every file by dense cosines and a walk up the folders."""
    bags = [Counter(licenses.tokens(text or "")) for _, text, _ in rows]
    n = Counter(t for b in bags for t in b)

    def cosine(a, b):
        def vector(c):
            return {t: (1 + math.log(k)) * (math.log((1 + len(rows)) / (1 + n[t])) + 1) for t, k in c.items()}

        x, y = vector(a), vector(b)
        size = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
        return sum(v * y.get(t, 0.0) for t, v in x.items()) / size if size else 0.0

    own, holder = {}, {}
    for path, text, k in rows:
        found = []
        for p, a, b in licenses.passages(text):
            if licenses.named(p):
                found.append((-1.0, licenses.named(p), a, b))
            if "SPDX-License-Identifier" in p:
                continue
            bag = Counter(licenses.tokens(p))
            scores = [(-cosine(bag, Counter(licenses.tokens(t))), name) for name, t in licenses.TEMPLATES
                      if name in licenses.possible(bag)]
            if scores and -min(scores)[0] >= licenses.THRESHOLD:
                found.append((*min(scores), a, b))
        if found:
            own[k] = (min(found)[1], -min(found)[0])
            words, total = set(), [m.span() for m in licenses._WORD.finditer(text)]
            for _, _, a, b in found:
                words |= {i for i, (x, _) in enumerate(total) if a <= x < b}
            base = os.path.basename(path).lower()
            if base.startswith(("license", "copying")) or len(words) / len(total) >= licenses.COVERAGE:
                best = (-own[k][1], own[k][0])
                folder = os.path.dirname(path)
                holder[folder] = min(holder.get(folder, best), best)
    out = {}
    for path, _, k in rows:
        folder, name, origin = os.path.dirname(path), None, None
        if k in own:
            name, origin = own[k][0], "own"
        while name is None:
            if folder in holder:
                name, origin = holder[folder][1], "inherited"
            if not folder:
                break
            folder = os.path.dirname(folder)
        out[k] = (name, origin, round(own[k][1], 9) if k in own else None)
    return out


def test_scan_equals_a_plain_recomputation(spark):
    texts = [t for t, _ in NOTICES] + [t for _, t in licenses.TEMPLATES[::7]] + ["plain words", "", None]
    rows = []
    for i, t in enumerate(texts):
        folder = ["p", "p/q", "p/q/r", "s", "s/t/u"][i % 5]
        name = "LICENSE" if i in (3, 8, 14) else f"f{i}.txt"
        rows.append((f"{folder}/{name}", t and f"{t}\n\nfile {i} tells of rivers, hills and more words of its own\n" * (1 + i % 2), i))
    got = {r.k: (r.license, r.origin, round(r.score, 9) if r.origin == "own" else None)
           for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, k int"), ["k"]).collect()}
    want = _plain(rows)
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    for k, v in want.items():
        assert got[k][2] == pytest.approx(v[2]), k
