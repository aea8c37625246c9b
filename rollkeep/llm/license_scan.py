"""Operator 10: license scans by conditional compression.

A notice that differs from a template in at most a fifth of its words, f, holds one of f + 1 parts of the template word by
word. Texts are searched for all these parts at once, across lines, punctuation and comment signs; where parts are
found, the words around them, by the templates' lengths, are a candidate block. Each block is compressed alone and with
each template that may stand in it as a zstandard raw dictionary. The ranking of the size reductions decides: down it, the
first template that the exact differences in wording confirm takes its words, and no other may have them.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import slices

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, "
    "either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, "
    "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_GNU_FIRST = _GNU.partition(" This program is distributed")[0]
_LESSER = _GNU.replace("program", "library").replace("software:", "software;").replace("Foundation, either", "Foundation; either").format(name="Lesser General Public License", version="2.1")
#: License notices by SPDX identifier or a like name.
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", _GNU.format(name="Affero General Public License", version=3), _GNU_FIRST.format(name="Affero General Public License", version=3)],
    "All-Rights-Reserved": ["All rights reserved."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD + _AS_IS],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _AS_IS,
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _GNU.format(name="General Public License", version=2), _GNU_FIRST.format(name="General Public License", version=2), "Licensed under the GPL v2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _GNU.format(name="General Public License", version=3), _GNU_FIRST.format(name="General Public License", version=3), "Licensed under the GPL v3."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", _LESSER, _LESSER.partition(" This library is distributed")[0]],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _GNU.format(name="Lesser General Public License", version=3), _GNU_FIRST.format(name="Lesser General Public License", version=3)],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Identifiers that may follow "SPDX-License-Identifier:", by the name above.
SPDX = {
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "Apache-2.0": ["Apache-2.0"],
    "BSD-2-Clause": ["BSD-2-Clause"],
    "BSD-3-Clause": ["BSD-3-Clause"],
    "BSL-1.0": ["BSL-1.0"],
    "CC-BY-4.0": ["CC-BY-4.0"],
    "CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC0-1.0": ["CC0-1.0"],
    "EPL-2.0": ["EPL-2.0"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0+"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0+"],
    "ISC": ["ISC"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-2.1+"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MIT": ["MIT"],
    "MPL-2.0": ["MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
_EXPRESSION = re.compile(r"SPDX-License-Identifier:[ \t]*((?:\(|\)|[\w.+-]+|[ \t]+)+)", re.IGNORECASE)
_IDENTIFIER = re.compile(r"[\w.+-]*[\w+]")
_WORD = re.compile(r"[\w.+-]*[\w+]")


def words(text: str) -> list[str]:
    return " ".join(_WORD.findall(text)).lower().split(" ")


def few(want: list[str]) -> int:
    """The words of a template that a notice may differ in: a fifth."""
    return len(want) // 5


def parts(want: list[str]) -> list[tuple[int, list[str]]]:
    """few + 1 parts of a template, one after another: that many differences leave one of them whole."""
    m = few(want) + 1
    cuts = [len(want) * k // m for k in range(m + 1)]
    return [(a, want[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds notices in texts; one for each Python worker."""

    _open: Scanner | None = None

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, spdx: dict[str, list[str]] = SPDX, level: int = 3) -> None:
        import ahocorasick
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.entries: list[tuple[str, list[str], zstandard.ZstdCompressor]] = []
        texts = [(name, t) for name, all_ in templates.items() for t in all_] + [(name, f"SPDX-License-Identifier: {i}") for name, ids in spdx.items() for i in ids]
        for name, text in texts:
            want = words(text)
            # repeated, as a raw dictionary must hold eight bytes at least
            data = zstandard.ZstdCompressionDict((" ".join(want) + "\n").encode() * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.entries.append((name, want, zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False)))
        self.spdx = {i.lower(): name for name, ids in spdx.items() for i in ids}
        self.telling = self._telling_words()
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, want, _) in enumerate(self.entries):
            for at, part in parts(want):
                places.setdefault(f" {' '.join(part)} ", []).append((k, at))
        self.parts = ahocorasick.Automaton()
        for part, where in places.items():
            self.parts.add_word(part, (len(part), where))
        self.parts.make_automaton()

    @classmethod
    def shared(cls) -> Scanner:
        cls._open = cls._open or cls()
        return cls._open

    def _telling_words(self) -> set[str]:
        """Words that tell licenses apart: in which templates of two licenses differ that could else be taken for each other."""
        out: set[str] = set()
        for k, (name, want, _) in enumerate(self.entries):
            for other, have, _ in self.entries[:k]:
                if other != name and abs(len(want) - len(have)) <= max(few(want), few(have)):
                    steps = [s for s in SequenceMatcher(None, want, have, autojunk=False).get_opcodes() if s[0] != "equal"]
                    differ = [w for _, a, b, c, d in steps for w in want[a:b] + have[c:d]]
                    if len(differ) <= 2 * max(few(want), few(have)) + 4 and len(differ) < len(want):
                        out.update(differ)
        return out

    def differences(self, k: int, part: list[str]) -> tuple[int, int, int] | None:
        """Differing words, and the first and last place in part, of template k, if the wording holds up.

        At most a fifth of its words may be missing, replaced or come in between, and none that has a digit or tells
        licenses apart.
        """
        want = self.entries[k][1]
        if (Counter(want) & Counter(part)).total() < len(want) - few(want):
            return None
        steps = SequenceMatcher(None, want, part, autojunk=False).get_opcodes()
        equal = [n for n, step in enumerate(steps) if step[0] == "equal"]
        if not equal:
            return None
        missing = [w for op, a, b, _, _ in steps if op in ("delete", "replace") for w in want[a:b]]
        wrong = [w for op, _, _, c, d in steps[equal[0] : equal[-1]] if op in ("insert", "replace") for w in part[c:d]]
        n = len(missing) + len(wrong)
        if n > few(want) or any(w in self.telling or any(c.isdigit() for c in w) for w in missing + wrong):
            return None
        return n, steps[equal[0]][3], steps[equal[-1]][4] - 1

    def ranked(self, block: list[str], among: Iterable[int] | None = None) -> list[tuple[float, int]]:
        """Size reduction, from 0 to 1, that each template's dictionary brings, the largest first; with the template's number. among: these templates only."""
        data = " ".join(block).encode("utf-8", "surrogatepass")
        alone = max(1, len(self.plain.compress(data)))
        return sorted(((1 - len(self.entries[k][2].compress(data)) / alone, k) for k in (range(len(self.entries)) if among is None else among)), key=lambda x: (-x[0], x[1]))

    def windows(self, have: list[str], joined: str) -> list[tuple[int, int, int]]:
        """(begin, end, template): words around every place where a part of the template stands; places that may be one notice together."""
        starts: list[int] | None = None
        at: dict[int, set[int]] = {}
        for end, (size, where) in self.parts.iter(joined):
            starts = starts or list(accumulate((len(w) + 1 for w in have), initial=1))
            i = bisect_right(starts, end - size + 2) - 1
            for k, offset in where:
                at.setdefault(k, set()).add(i - offset)
        out = []
        for k, found in at.items():
            want = self.entries[k][1]
            run: list[int] = []
            for i in [*sorted(found), None]:
                if run and (i is None or i - run[-1] > few(want)):
                    out.append((max(0, run[0] - few(want)), min(len(have), run[-1] + len(want) + few(want)), k))
                    run = []
                run.append(i)
        return sorted(out)

    def scan(self, text: str | None) -> list[tuple[str, int, int, float, int]]:
        """(name, begin, end, reduction, differing words) of every notice, in order; whole text, across line breaks.

        Of notices that overlap, the one whose template reduces the block most stays; one that brings no reduction is
        none. All identifiers of an SPDX expression are notices at their places. Begin and end take in the rest of
        their lines if that is one word at most.
        """
        text = text or ""
        have = _WORD.findall(text)
        joined = f" {' '.join(have)} ".lower()
        windows = self.windows(have, joined)
        if not windows:
            return []
        have = joined[1:-1].split(" ")
        blocks: list[list[tuple[int, int, int]]] = []
        reach = -1
        for window in windows:
            if window[0] >= reach:
                blocks.append([])
            blocks[-1].append(window)
            reach = max(reach, window[1])
        chosen: list[tuple[str, int, int, float, int]] = []
        for block in blocks:
            by_template: dict[int, list[tuple[int, int, int]]] = {}
            for w in block:
                by_template.setdefault(w[2], []).append(w)
            taken: list[tuple[int, int]] = []
            for gain, k in self.ranked(have[block[0][0] : max(w[1] for w in block)], by_template):
                if gain <= 0:
                    break
                for a, b, _ in by_template[k]:
                    met = self.differences(k, have[a:b])
                    if met and all(a + met[2] < first or last < a + met[1] for first, last in taken):
                        taken.append((a + met[1], a + met[2]))
                        chosen.append((self.entries[k][0], *taken[-1], gain, met[0]))
        return self._expressions(text, self._placed(text, sorted(chosen, key=lambda c: c[1]))) if chosen else []

    def _expressions(self, text: str, found: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
        """found with the identifiers of SPDX expressions after the first, which stand behind AND, OR, WITH or brackets; each license of an expression once."""
        for expression in _EXPRESSION.finditer(text):
            begin, end = expression.span(1)
            inside = [f for f in found if f[1] < end and begin < f[2]]
            if not inside:
                continue
            names = {f[0] for f in inside}
            joined = True
            for word in _IDENTIFIER.finditer(text, begin, end):
                if word[0].upper() in ("AND", "OR", "WITH"):
                    joined = True
                    continue
                if not joined:
                    break  # what follows is no part of the expression
                joined = False
                name = self.spdx.get(word[0].lower())
                if name and name not in names:
                    names.add(name)
                    found.append((name, *word.span(), inside[0][3], 0))
        return sorted(found, key=lambda f: (f[1], f[2]))

    @staticmethod
    def _placed(text: str, chosen: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
        spans = [m.span() for m in _WORD.finditer(text)]
        out: list[tuple[str, int, int, float, int]] = []
        for i, (name, first, last, gain, n) in enumerate(chosen):
            begin, end = spans[first][0], spans[last][1]
            left = max(text.rfind("\n", 0, begin) + 1, out[-1][2] if out else 0)
            after = spans[chosen[i + 1][1]][0] if i + 1 < len(chosen) else len(text)
            right = min(x for x in (text.find("\n", end), after) if x >= 0)
            begin = left if len(_WORD.findall(text, left, begin)) <= 1 else begin
            end = right if len(_WORD.findall(text, end, right)) <= 1 else end
            out.append((name, begin, end, round(gain, 6), n))
        return out


def find_notices(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and notices: an array of (license, begin, end, reduction, changed) for each row, with character places in the text.

    The whole of every text is searched; reduction is that of the notice's block. Null and empty texts, and such without a
    notice, give an empty array. Repeated rows and null keys stay; an empty table gives no rows; other columns are not
    looked at. No shuffle.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner.shared()
        kind = pa.list_(pa.struct([("license", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("reduction", pa.float64()), ("changed", pa.int32())]))
        for batch in slices(batches):
            found = [[dict(zip(("license", "begin", "end", "reduction", "changed"), x, strict=True)) for x in scanner.scan(t)] for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(found, kind)], [key, "notices"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, f"`{key}` {kind}, notices array<struct<license:string,begin:int,end:int,reduction:double,changed:int>>")
