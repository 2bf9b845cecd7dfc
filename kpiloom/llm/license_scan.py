"""License notices found by patience alignment.

Text and template are aligned on the words that are unique in both: the
longest increasing subsequence of their positions gives anchors, and the gaps
between anchors are aligned in the same way, down to gaps without a unique
common word, where equal words at either end still count.  Coverage is the
share of the template's words that are aligned.

Where to look: a place that covers a share ``c`` of a template lacks at most a
share ``1 - c`` of its words, so it has at least one of any ``lacking + 1`` of
them; the ones rarest in the text give the places, each of which is aligned
within a window of the template's length on both sides and, for copies close to
one another, within the template's own span.

Templates are whole license texts and short notices.  A notice counts only if
the words that identify its license (name, version) are aligned and no word
that makes it another license (SA, Lesser, another version) stands between.
"""

from __future__ import annotations

import bisect
import pkgutil
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


#: Words that make another license of the one named beside them, by a word of
#: its template; version numbers do so in short notices only.
FOREIGN = {"cc": frozenset("nc nd sa".split()), "creative": frozenset("noncommercial noderivatives noderivs sharealike".split()),
           "gnu": frozenset("lesser library affero".split())}
NUMBER = re.compile(r"v?\d+(?:\.\d+)*")
#: Templates of fewer words are notices: they name a license, whole texts are one.
SHORT = 30


@dataclass(frozen=True)
class Template:
    license: str
    words: tuple[str, ...]
    #: Words that identify the license: a notice without one of them is none.
    must: frozenset[str] = frozenset()

    @classmethod
    def of(cls, name: str, text: str, must: str = "") -> Template:
        return cls(name, tuple(WORD.findall(text.lower())), frozenset(WORD.findall(must.lower())))

    @cached_property
    def counts(self) -> list[tuple[str, int]]:
        """How often each word occurs, long (mostly rare) words first."""
        return sorted(Counter(self.words).items(), key=lambda c: (-len(c[0]), c[0]))

    @cached_property
    def foreign(self) -> frozenset[str]:
        return frozenset().union(*(f for w, f in FOREIGN.items() if w in self.words))

    def lacks(self, places: dict[str, list[int]], at_most: int) -> bool:
        """Whether a text with these words lacks more than ``at_most`` of the
        template's, or a word that identifies it."""
        if not all(w in places for w in self.must):
            return True
        missing = 0
        for w, n in self.counts:
            missing += max(0, n - len(places.get(w, ())))
            if missing > at_most:
                return True
        return False

    def named(self, words: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether what is aligned names this license and no other: all words
        that identify it are aligned, and no word between makes it another's."""
        aligned = {j for _, j in pairs}
        if any(w in self.must and j not in aligned for j, w in enumerate(self.words)):
            return False
        own = {i for i, _ in pairs}
        (first, head), (last, tail) = pairs[0], pairs[-1]
        # also where the template's unaligned ends would stand
        if any(i not in own and words[i] in self.foreign
               for i in range(max(0, first - head), min(len(words), last + len(self.words) - tail))):
            return False
        return len(self.words) >= SHORT or not any(i not in own and NUMBER.fullmatch(words[i]) for i in range(first, last))


def whole(name: str) -> str:
    """A whole license text of ``license_texts`` (also from a zipped package)."""
    return pkgutil.get_data("kpiloom.llm", f"license_texts/{name}.txt").decode()


#: Whole texts: template name and file.
TEXTS = {
    "Apache-2.0-text": "Apache-2.0", "Artistic-1.0-text": "Artistic", "BSD-2-Clause-text": "BSD-2-Clause",
    "BSD-3-Clause-text": "BSD-3-Clause", "BSL-1.0-text": "BSL-1.0", "CC-BY-4.0-text": "CC-BY-4.0",
    "CC-BY-SA-4.0-text": "CC-BY-SA-4.0", "CC0-1.0-text": "CC0-1.0", "GFDL-1.2-text": "GFDL-1.2", "GFDL-1.3-text": "GFDL-1.3",
    "GPL-1.0-text": "GPL-1.0", "GPL-2.0-text": "GPL-2.0", "GPL-3.0-text": "GPL-3.0", "ISC-text": "ISC",
    "LGPL-2.0-text": "LGPL-2.0", "LGPL-2.1-text": "LGPL-2.1", "LGPL-3.0-text": "LGPL-3.0", "MIT-text": "MIT",
    "MPL-1.1-text": "MPL-1.1", "MPL-2.0-text": "MPL-2.0", "NCSA-text": "NCSA", "OFL-1.1-text": "OFL-1.1",
    "Unicode-3.0-text": "Unicode-3.0", "Unlicense-text": "Unlicense",
}
GNU = "GNU General Public License"
HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by "
          "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")

#: Wordings of public licenses, notices first.
TEMPLATES = (
    Template.of("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "Apache 2.0"),
    Template.of("Apache-1.1", "Licensed under the Apache License, Version 1.1.", "Apache 1.1"),
    Template.of("MIT", "Released under the MIT License.", "MIT"),
    Template.of("BSD", "Released under the BSD License.", "BSD"),
    Template.of("ISC", "Released under the ISC License.", "ISC"),
    *(Template.of(f"GPL-{v}.0", f"This work is licensed under the {GNU}, version {v}.", f"{GNU} {v}") for v in "123"),
    *(Template.of(f"LGPL-{v}", f"This work is licensed under the GNU Lesser General Public License, version {w}.",
                  f"GNU Lesser General Public License {w}") for v, w in (("2.1", "2.1"), ("3.0", "3"))),
    Template.of("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.",
                "GNU Affero General Public License 3"),
    Template.of("MPL-1.1", "Licensed under the Mozilla Public License, Version 1.1.", "Mozilla Public 1.1"),
    Template.of("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0.", "Mozilla Public 2.0"),
    *(Template.of(f"CC-{k}-{v}", f"Licensed under CC {k} {v}.", f"CC {k} {v}")
      for v in ("4.0", "3.0", "2.5", "2.0", "1.0") for k in ("BY-NC", "BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    Template.of("CC0-1.0", "Licensed under CC0 1.0.", "CC0 1.0"),
    *(Template.of(f"GPL-{v}.0-or-later", HEADER.format(GNU, v), f"{GNU} {v}") for v in "23"),
    *(Template.of(f"LGPL-{v}-or-later", HEADER.format("GNU Lesser General Public License", w), f"GNU Lesser {w}")
      for v, w in (("2.1", "2.1"), ("3.0", "3"))),
    Template.of("AGPL-3.0-or-later", HEADER.format("GNU Affero General Public License", 3), "GNU Affero 3"),
    # without a version: any
    Template.of("GPL", HEADER.format(GNU, "").split(", either")[0], GNU),
    *(Template.of(name, whole(file)) for name, file in TEXTS.items()),
)


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    top_at: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        below[i] = top_at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = v, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(text: list[str] | tuple[str, ...], template: list[str] | tuple[str, ...]) -> list[tuple[int, int]]:
    """Aligned positions (in text, in template), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        where = {template[j]: j for j in range(c, d) if in_template[template[j]] == 1}
        common = [(i, where[text[i]]) for i in range(a, b) if in_text[text[i]] == 1 and text[i] in where]
        if not common:
            continue
        last = (a, c)
        for k in longest_increasing([j for _, j in common]):
            i, j = common[k]
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        todo.append((last[0], b, last[1], d))
    return sorted(out)


def near(ascending: list[int], value: int, distance: int) -> bool:
    at = bisect.bisect_left(ascending, value - distance)
    return at < len(ascending) and ascending[at] <= value + distance


def span_shares(words: list[str], template: Template) -> list[int]:
    """Words that the span of the template's length from each word on has in
    common with the template, in any order: no alignment there has more."""
    n, want = len(template.words), dict(template.counts)
    have: Counter[str] = Counter()
    common, out = 0, []
    for i in range(len(words) + n - 1):
        if i < len(words) and (w := words[i]) in want:
            have[w] += 1
            common += have[w] <= want[w]
        if i >= n and (w := words[i - n]) in want:
            common -= have[w] <= want[w]
            have[w] -= 1
        if i >= n - 1:
            out.append(common)
    return out


def scan(text: str | None, templates: tuple[Template, ...], coverage: float) -> list[tuple[str, int, int, float]]:
    """(license, first word, words spanned, coverage) of the notices found:
    the best-covered, then the longest first, none overlapping a better one."""
    words = WORD.findall(text.lower()) if text else []
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    found = []
    for t in templates:
        n = len(t.words)
        lacking = n - max(1, -int(-(coverage * n) // 1))
        if len(words) < n - lacking or t.lacks(places, lacking):
            continue
        order = sorted(range(n), key=lambda j: (len(places.get(t.words[j], ())), j))[:lacking + 1]
        tried: set[int] = set()

        def look(start: int, end: int) -> float:
            pairs = align(words[max(0, start):end], t.words)
            if len(pairs) < coverage * n:
                return 0.0
            pairs = [(i + max(0, start), j) for i, j in pairs]
            if not t.named(words, pairs):
                return 0.0
            first, last = pairs[0][0], pairs[-1][0]
            found.append((t.license, first, last - first + 1, len(pairs) / n, len(pairs)))
            return len(pairs) / n

        for j in order:
            for p in places.get(t.words[j], ()):
                start = max(0, p - j - n // 2)
                if start // max(1, n // 4) in tried:
                    continue
                tried.add(start // max(1, n // 4))
                look(start, p - j + n + n // 2 + 1)
        # copies close to one another leave no word unique in such a window:
        # the template's own span at each place, then a little more
        shares = span_shares(words, t)
        starts = {max(0, p - j) for j in order for p in places.get(t.words[j], ())}
        tight = sorted(f[1] for f in found if f[0] == t.license and f[2] <= n + n // 8)
        failed: list[int] = []
        for start in sorted(starts, key=lambda s: (-shares[s], s)):
            if near(failed, start, n // 32):
                continue
            for more in (0, n // 8, n // 4):
                # all that is found here would overlap what was found before
                if shares[start] + 2 * more < n - lacking or near(tight, start, n - lacking - more - 1):
                    continue
                if look(start - more, start + n + more):
                    if found[-1][2] <= n + n // 8:
                        bisect.insort(tight, found[-1][1])
                    break
            else:
                bisect.insort(failed, start)
    out: list[tuple[str, int, int, float]] = []
    for name, first, span, share, _ in sorted(found, key=lambda f: (-f[4] * f[3], f[2], f[1], f[0])):
        if all(first + span <= o[1] or o[1] + o[2] <= first for o in out):
            out.append((name, first, span, share))
    return sorted(out, key=lambda o: (-o[3], -o[2], o[1], o[0]))


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, coverage: float = 0.8,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, license, coverage, n_notices, notices``.

    ``notices`` are all notices of the whole text; ``license`` and
    ``coverage`` are those of the first (null and 0 if there is none, as for
    null and empty texts).  One pass without a shuffle; repeated rows stay
    repeated; an empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    notice = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int32()), ("words", pa.int32()), ("coverage", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [scan(t, templates, coverage) for t in b.column("text").to_pylist()]
            rows = [[dict(zip(("license", "first_word", "words", "coverage"), n, strict=True)) for n in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f[0][0] if f else None for f in found], pa.string()),
                 pa.array([f[0][3] if f else 0.0 for f in found], pa.float64()),
                 pa.array([len(f) for f in found], pa.int32()), pa.array(rows, notice)],
                ["doc_id", "license", "coverage", "n_notices", "notices"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, license string, coverage double, n_notices int, "
             "notices array<struct<license string, first_word int, words int, coverage double>>")
