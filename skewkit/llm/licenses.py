"""License scans by patience alignment of texts with license templates.

A text and a template are aligned on their words (letters and digits, in lower case):
words that occur exactly once in both are paired, the longest increasing subsequence
of the pairs gives the anchors, and the gaps between anchors are aligned in
the same way, after equal words at their edges are matched. Coverage is the
share of the template's words that are matched; ``COVERAGE`` or more is a find, if the template's deciding
phrases (license name, version, terms) are among them, each word by word with nothing between: sibling
licenses differ in little else. A short notice with a negation before it in its sentence (``not released under the``) is no find. A version that goes on (``2.1`` for ``2``) or a qualified name is another license.
In short templates of the caller's own, all words decide. A short notice is looked for where its first deciding phrase is.

Where a template may stand is read from shared word pairs: a pair at word ``p`` of the text and
``q`` of the template points to the start ``p - q``, and starts that agree within ``SLACK`` of the template's
length make one place, so that each of several copies is found. A place is aligned if at
least ``PAIRS`` of the template's word pairs are there. The whole text is read, map-side, and nothing is shuffled.

SPDX lines, license titles with a copyright line after them and short forms (``GPLv3``) are templates of their own, matched whole.

Results: a row per find, none for null, empty or license-free texts. Repeated rows and null
ids are reported as they are. An empty table gives no rows, extra columns are not read. Finds don't overlap: one inside a find of more matched words gives way to it, else the one with the larger product of coverage and matched share of
its words in the text wins, then the one with more matched words, then the first template by name.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_slices

COVERAGE = 0.8
SLACK = 0.25
PAIRS = 0.2
#: Templates of up to so many words, without deciding phrases of their own, must be matched whole.
SHORT = 16
#: Right before a deciding phrase, these name another license.
QUALIFIERS = frozenset("modified lesser library affero non".split())

#: Standard notices of public licenses, by SPDX id.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

#: What decides: phrases that a text must hold word by word for the template to be found.
DECIDING: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License, Version 2.0",), "Apache-2.0-header": ("Apache License, Version 2.0",), "MIT": ("MIT License",),
    "MIT-text": ("subject to the following conditions", "shall be included in all copies"), "ISC-text": ("appear in all copies",),
    "BSD-2-Clause-text": ("Redistributions in binary form must reproduce",),
    "GPL-3.0": ("GNU General Public License, version 3",),
    "GPL-3.0-header": ("GNU General Public License", "version 3 of the License", "any later version"),
    "CC-BY-4.0": ("CC BY 4.0",), "CC-BY-SA-4.0": ("CC BY-SA 4.0",), "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC-BY-text": ("Creative Commons Attribution 4.0",),
}


def _add(name: str, text: str, *deciding: str) -> None:
    """A further template; ``name#n`` is another wording of ``name``."""
    at, key = 1, name
    while key in TEMPLATES:
        at += 1
        key = f"{name}#{at}"
    TEMPLATES[key], DECIDING[key] = text, deciding


def _add_notices() -> None:
    for name, *wordings in (
            ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0"), ("MIT", "MIT License"), ("Apache-1.1", "Apache Software License, Version 1.1"),
            ("MIT-0", "MIT-0 License", "MIT No Attribution License"), ("BSD", "BSD License"), ("0BSD", "Zero-Clause BSD License", "0BSD License"),
            ("BSD-2-Clause", "BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
            ("BSD-3-Clause", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
            ("BSD-4-Clause", "BSD 4-Clause License", "4-Clause BSD License"), ("ISC", "ISC License"), ("Zlib", "zlib License"),
            ("MPL-1.1", "Mozilla Public License, version 1.1", "Mozilla Public License 1.1"),
            ("MPL-2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
            ("EPL-1.0", "Eclipse Public License, version 1.0", "Eclipse Public License 1.0"),
            ("EPL-2.0", "Eclipse Public License, version 2.0", "Eclipse Public License 2.0"),
            ("BSL-1.0", "Boost Software License, version 1.0", "Boost Software License 1.0"),
            ("Artistic-1.0", "Artistic License 1.0"), ("Artistic-2.0", "Artistic License 2.0"), ("Unlicense", "Unlicense")):
        for wording in wordings:
            _add(name, f"Released under the {wording}.", wording)
            _add(name, f"under the terms of the {wording}.", wording)
    for name, full, brief, versions in (
            ("GPL", "GNU General Public License", "GNU GPL", ("1", "2", "3")), ("LGPL", "GNU Library General Public License", "GNU LGPL", ("2",)),
            ("LGPL", "GNU Lesser General Public License", "GNU LGPL", ("2.1", "3")),
            ("AGPL", "GNU Affero General Public License", "GNU AGPL", ("3",))):
        for v in versions:
            spdx = f"{name}-{v if '.' in v else v + '.0'}"
            if spdx != "GPL-3.0":
                _add(spdx, f"This work is licensed under the {full}, version {v}.", f"{full}, version {v}")
            for wording in (f"{full}, version {v}", f"{full} v{v}", f"{brief} version {v}", f"{brief} v{v}"):
                _add(spdx, f"Released under the {wording}.", wording)
            foundation = "as published by the Free Software Foundation"
            opening = f"This program is free software: you can redistribute it and/or modify it under the terms of the {full} {foundation}"
            if spdx != "GPL-3.0":
                _add(f"{spdx}-header", f"{opening}, either version {v} of the License, or (at your option) any later version.",
                     full, f"version {v} of the License", "any later version")
            _add(f"{spdx}-only-header", f"{opening}, version {v} of the License.", full, f"Foundation, version {v} of the License")
        _dates = {"GPL-1": "February 1989", "GPL-2": "June 1991", "GPL-3": "29 June 2007", "LGPL-2": "June 1991", "LGPL-2.1": "February 1999",
                  "LGPL-3": "29 June 2007", "AGPL-3": "19 November 2007"}
        for v in versions:
            _add(f"{name}-{v if '.' in v else v + '.0'}-title", f"{full} Version {v}, {_dates[f'{name}-{v}']}",
                 f"{full} Version {v}, {_dates[f'{name}-{v}']}")
    _add("Apache-2.0-title", "Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004")
    _add("MPL-2.0-title", "Mozilla Public License Version 2.0 1. Definitions", "Mozilla Public License Version 2.0 1. Definitions")
    long = {"BY": "", "BY-SA": "-ShareAlike", "BY-NC": "-NonCommercial", "BY-ND": "-NoDerivatives", "BY-NC-SA": "-NonCommercial-ShareAlike",
            "BY-NC-ND": "-NonCommercial-NoDerivatives"}
    for kind, terms in long.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            if f"CC-{kind}-{v}" not in TEMPLATES:
                _add(f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.", f"CC {kind} {v}")
            place = " International" if v == "4.0" else " Unported" if v == "3.0" else ""
            spdx = "CC-BY-text" if (kind, v) == ("BY", "4.0") else f"CC-{kind}-{v}-text"
            for t in dict.fromkeys((terms, terms.replace("NoDerivatives", "NoDerivs"))):
                t = "Creative Commons Attribution" + t
                if spdx not in TEMPLATES or t.endswith("Derivs"):
                    _add(spdx, f"This work is licensed under a {t} {v}{place} License.", f"{t} {v}")
                _add(spdx, f"Licensed under the {t} {v}{place} License.", f"{t} {v}")
    _add("CC0-1.0", "Released under CC0 1.0.", "CC0 1.0")
    _add("CC0-1.0-title", "CC0 1.0 Universal", "CC0 1.0 Universal")


def _add_texts() -> None:
    as_is = "THE SOFTWARE IS PROVIDED \"AS IS\""
    grant = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    _add("0BSD-text", f"{grant}. {as_is} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
         "is hereby granted. THE SOFTWARE IS PROVIDED")
    mit = TEMPLATES["MIT-text"]
    head, rest = mit.split(", subject to the following conditions")
    _add("MIT-0-text", head + ". " + rest[rest.index("THE SOFTWARE IS"):], "to do so. THE SOFTWARE IS PROVIDED")
    _add("X11-text", mit + " Except as contained in this notice, the name of the copyright holders shall not be used in advertising or "
         "otherwise to promote the sale, use or other dealings in this Software without prior written authorization.",
         *DECIDING["MIT-text"], "Except as contained in this notice")
    bsd = TEMPLATES["BSD-2-Clause-text"]
    names = "may be used to endorse or promote products derived from this software without specific prior written permission."
    _add("BSD-3-Clause-text", f"{bsd} 3. Neither the name of the copyright holder nor the names of its contributors {names}",
         *DECIDING["BSD-2-Clause-text"], "Neither the name of", "endorse or promote products")
    _add("BSD-4-Clause-text", f"{bsd} 3. All advertising materials mentioning features or use of this software must display the following "
         "acknowledgement: This product includes software developed by the organization. 4. Neither the name of the copyright holder nor "
         f"the names of its contributors {names}", *DECIDING["BSD-2-Clause-text"], "All advertising materials", "Neither the name of")
    _add("MPL-1.1-header", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
         "this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",
         "Mozilla Public License Version 1.1")
    _add("MPL-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
         "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Mozilla Public License, v. 2.0")
    _add("Zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
         "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
         "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
         "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
         "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
         "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
         "removed or altered from any source distribution.", "must not be misrepresented")
    _add("BSL-1.0-text", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
         "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit "
         "the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
         "so, all subject to the following: The copyright notices in the Software and this entire statement must be included in all copies of "
         "the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in "
         "the form of machine-executable object code generated by a source language processor.", "person or organization obtaining")
    _add("Unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
         "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
         "non-commercial, and by any means.", "released into the public domain")


#: SPDX ids of licenses that source files name in one line.
SPDX_IDS = (
    "0BSD AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause "
    "BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC0-1.0 EPL-1.0 EPL-2.0 GPL-1.0 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 Unlicense WTFPL Zlib").split()


def _add_lines() -> None:
    for name in SPDX_IDS:
        _add(name, f"SPDX-License-Identifier: {name}", f"SPDX-License-Identifier: {name}")
    for name, title in (("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
                        ("0BSD", "Zero-Clause BSD")):
        _add(name, f"{title} Copyright (c)", f"{title} Copyright (c)")
    for name, versions in (("GPL", ("2", "3")), ("LGPL", ("2.1", "3")), ("AGPL", ("3",))):
        for v in versions:
            for wording in (f"{name}v{v}", f"{name} v{v}", f"the {name}v{v}", f"the {name} v{v}", f"the {name} version {v}"):
                _add(f"{name}-{v if '.' in v else v + '.0'}", f"Licensed under {wording}.", f"Licensed under {wording}")


#: Words that turn a notice round, right before it or before one of the words that may stand between.
NEGATIONS = frozenset("not never nor isn aren wasn cannot no".split())
BETWEEN = frozenset("t is are was be been being longer yet currently released licensed distributed available published".split())
_add_notices()
_add_texts()
_add_lines()

_word = re.compile(r"\w+")


def _unique_places(words: list[str], a: int, b: int) -> dict[str, int]:
    seen: dict[str, int] = {}
    for i in range(a, b):
        seen[words[i]] = -1 if words[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of ``pairs`` (in order of the first) that also increases in the second."""
    tops: list[int] = []
    pile_top: list[int] = []
    back: list[int] = []
    for at, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(pile_top[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            pile_top.append(at)
        else:
            tops[pile], pile_top[pile] = j, at
    out, at = [], pile_top[-1] if pile_top else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


def align(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: index pairs of equal words, increasing on both sides."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(left), 0, len(right))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = _unique_places(left, a, b), _unique_places(right, c, d)
        anchors = _longest_increasing(sorted((i, theirs[w]) for w, i in mine.items() if w in theirs))
        if not anchors:
            continue
        out.extend(anchors)
        bounds = [(a - 1, c - 1), *anchors, (b, d)]
        gaps.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(bounds[:-1], bounds[1:], strict=True))
    return sorted(out)


def _outermost(finds: list[tuple]) -> list[tuple]:
    """Without the finds that stand inside one of more matched words: a license that goes on is the longer one."""
    finds = sorted(finds, key=lambda f: f[3])
    widest = max((f[4] - f[3] for f in finds), default=0)
    out, first = [], 0
    for f in finds:
        while finds[first][3] < f[3] - widest:
            first += 1
        near = itertools.takewhile(lambda g, f=f: g[3] <= f[3], itertools.islice(finds, first, None))
        if not any(g[4] >= f[4] and g[2] > f[2] for g in near):
            out.append(f)
    return out


class Scanner:
    """Templates with an index of their word pairs."""

    def __init__(self, templates: dict[str, str] | None = None, coverage: float = COVERAGE):
        self.coverage = coverage
        chosen = TEMPLATES if templates is None else templates
        self.templates = {name: _word.findall(text.lower()) for name, text in sorted(chosen.items())}
        self.shown = {name: name.split("#")[0] if templates is None else name for name in chosen}
        self.deciding = {name: self._places_of(words, DECIDING.get(name, ()) if TEMPLATES.get(name) == chosen[name] else ())
                         for name, words in self.templates.items()}
        # short notices by their first deciding phrase, under its first word
        self.phrases: dict[str, list[tuple[str, int, list[str]]]] = defaultdict(list)
        self.pairs: dict[tuple[str, str], list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.templates.items():
            if len(words) <= SHORT and self.deciding[name]:
                q, end = self.deciding[name][0]
                self.phrases[words[q]].append((name, q, words[q:end]))
                continue
            for q, pair in enumerate(zip(words, words[1:], strict=False)):
                self.pairs[pair].append((name, q))
        # every pair holds one of these words: texts without any have no place
        rare = {w for pair in self.pairs for w in pair if len(w) > 3} | {w for pair in self.pairs for w in pair
                                                                       if all(len(x) <= 3 for x in pair)} | set(self.phrases)
        self._any = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, rare))) + r")\b", re.I) if rare else None

    @staticmethod
    def _places_of(words: list[str], phrases: tuple[str, ...]) -> list[tuple[int, int]]:
        """First word and end of each deciding phrase in a template; the whole of a short one that has none."""
        if not phrases:
            return [(0, len(words))] if 0 < len(words) <= SHORT else []
        out = []
        for phrase in phrases:
            wanted = _word.findall(phrase.lower())
            at = next(q for q in range(len(words)) if words[q:q + len(wanted)] == wanted)
            out.append((at, at + len(wanted)))
        return out

    def _decided(self, name: str, pairs: list[tuple[int, int]], begin: int, spans: list[tuple], text: str) -> bool:
        """Whether the deciding phrases of a template are aligned whole, and name no other license in the text."""
        at = {q: p + begin for p, q in pairs}
        for a, b in self.deciding[name]:
            p = at.get(a)
            if p is None or any(at.get(q) != p + q - a for q in range(a, b)):
                return False
            if p and spans[p - 1][0] in QUALIFIERS and at.get(a - 1) != p - 1:
                return False
            last = p + b - a
            if last < len(spans) and at.get(b) != last and spans[last - 1][0][-1].isdigit():
                more = spans[last][0]
                if text[spans[last - 1][2]:spans[last][1]] == "." and more.isdigit() and more.strip("0"):
                    return False
        return True

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """``template, coverage, begin, end`` (code points) of each find, in order."""
        if not text or self._any is None or not self._any.search(text):
            return []
        spans = [(m.group().lower(), m.start(), m.end()) for m in _word.finditer(text)]
        words = [s[0] for s in spans]
        starts: dict[str, list[int]] = defaultdict(list)
        for p, pair in enumerate(zip(words, words[1:], strict=False)):
            for name, q in self.pairs.get(pair, ()):
                starts[name].append(p - q)
        placed = {}
        for p, word in enumerate(words):
            for name, q, phrase in self.phrases.get(word, ()):
                if words[p:p + len(phrase)] == phrase:
                    placed.setdefault(name, []).append(p - q)
        finds = [f for name, found in starts.items() for f in self._finds(spans, words, name, self._gathered(name, sorted(found)), text)]
        finds += [f for name, found in placed.items() for f in self._finds(spans, words, name, [[s] for s in found], text)]
        finds = _outermost(finds)
        finds.sort(key=lambda f: (-f[1] * f[2] / (f[4] - f[3] + 1), -f[2], f[0], f[3]))
        kept: list[tuple] = []
        for f in finds:
            if all(f[4] < k[3] or f[3] > k[4] for k in kept):
                kept.append(f)
        kept = [f for f in kept if not self._turned_round(f, spans, text)]
        return sorted(((self.shown[name], share, spans[a][1], spans[b][2]) for name, share, _, a, b in kept), key=lambda f: f[2])

    def _turned_round(self, find: tuple, spans: list[tuple], text: str) -> bool:
        """Whether a short notice is denied in its sentence, or an SPDX id goes on."""
        name, _, _, a, b = find
        words = self.templates[name]
        if words[:1] == ["spdx"] and re.match(r"[-.+]\w|\+", text[spans[b][2]:spans[b][2] + 2]):
            return True
        if len(words) > SHORT:
            return False
        p = a
        while p and a - p < 4 and not re.search(r"[.!?;:\n]", text[spans[p - 1][2]:spans[p][1]]):
            p -= 1
            if spans[p][0] in NEGATIONS:
                return True
            if spans[p][0] not in BETWEEN:
                return False
        return False

    def _gathered(self, name: str, starts: list[int]) -> list[list[int]]:
        """Starts of a template, by place; places with too few of its word pairs are left out."""
        size = len(self.templates[name])
        slack = max(1, int(SLACK * size))
        places: list[list[int]] = []
        for s in starts:
            if places and s - places[-1][0] <= slack:
                places[-1].append(s)
            else:
                places.append([s])
        return [place for place in places if len(place) >= PAIRS * (size - 1)]

    def _finds(self, spans: list[tuple], words: list[str], name: str, places: list[list[int]],
               text: str) -> list[tuple[str, float, int, int, int]]:
        """``name, coverage, matched words, first word, last word`` of each place with enough coverage."""
        template = self.templates[name]
        size = len(template)
        slack = max(1, int(SLACK * size))
        finds = []
        for place in places:
            begin, end = max(0, place[0] - slack), min(len(words), place[-1] + size + slack)
            pairs = align(words[begin:end], template)
            if len(pairs) >= self.coverage * size - 1e-9 and self._decided(name, pairs, begin, spans, text):
                finds.append((name, len(pairs) / size, len(pairs), begin + pairs[0][0], begin + pairs[-1][0]))
        return finds


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, coverage, begin, end`` of each find in ``docs``."""
    scanner = Scanner(templates, coverage)

    def run(part: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [(i, *f) for i, text in enumerate(part.column("text").to_pylist()) for f in scanner.scan(text)]
        if not rows:
            return None
        at, name, share, begin, end = zip(*rows, strict=True)
        return pa.record_batch({"doc_id": part.column("doc_id").take(pa.array(at)), "license": pa.array(name),
                                "coverage": pa.array(share), "begin": pa.array(begin, pa.int64()),
                                "end": pa.array(end, pa.int64())})

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                      "doc_id long, license string, coverage double, begin long, end long")
