"""Licence scan by conditional compression.

A block of text that speaks of licensing is compressed with zstandard alone and
with each licence template as raw dictionary; the template that saves most
tells it best. Templates are held against the text word by word, wherever lines
break: each that stands in it with few differences is a row, and its words are
taken out before the rest is scanned again. It is confirmed if no word differs
that tells licences apart. What is left and speaks of licensing gets the nearest
template, of equal ones that with the best reduction.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from curbflow.llm.common import keyed_texts, map_arrow, texts_of


def gnu_notice(kind: str, version: str, work: str = "program") -> str:
    return (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published "
        f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {work} is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the GNU {kind} for more details."
    )


# Notices as the licences' own pages give them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 notice": gnu_notice("Affero General Public License", "3"),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-1.0": "This work is licensed under the GNU General Public License, version 1.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": gnu_notice("General Public License", "2"),
    "GPL-3.0 notice": gnu_notice("General Public License", "3"),
    "GPL-2.0-or-later": "This work is licensed under the GNU General Public License, version 2 or any later version.",
    "GPL-3.0-or-later": "This work is licensed under the GNU General Public License, version 3 or any later version.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 notice": gnu_notice("Lesser General Public License", "2.1", "library"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 notice": gnu_notice("Lesser General Public License", "3", "library"),
    "MIT": "Released under the MIT License.",
    "MIT notice": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
# The whole texts of licences, by the names of their files. Read where the module is imported; tasks get them with the job.
WHOLE = {f"{path.stem} text": path.read_text() for path in sorted((Path(__file__).parent / "licences").glob("*.txt"))}
CUE = r"licen[cs]e|copyright|all rights reserved|redistribut|warrant(?:y|ies)|merchantab|permission|public domain|creative commons|\bCC BY|spdx"
# A sentence may go on over line ends, not over blank lines.
SENTENCE = re.compile(r"(?:[^\n]|\n(?![^\S\n]*\n))+?(?:[.!?:;](?=\s)|(?=\n[^\S\n]*\n)|$)")
# A run of word characters and marks up to its last word character. It starts where a run does and gives nothing back, so that
# a long run of marks is read once.
WORD = re.compile(r"(?<![\w.\-/+])[.\-/+]*+\w(?:[.\-/+]*+\w)*+")
LEVEL = 6
# Share of a template's words that may differ.
MOST_DIFFERENT = 0.25
# Words that tell no licences apart, and parts of templates that stand for names and addresses; those may have FIELD_WORDS other words.
HARMLESS = frozenset("a an the this that these those is are work works file files program project software http https".split())
FIELDS = (
    "the copyright holders", "the copyright holder", "the authors or copyright holders", "the author",
    "51 franklin street fifth floor boston ma 02110-1301 usa",
)
FIELD_WORDS = 12


def blocks(text: str) -> list[tuple[int, int]]:
    """Stretches (start, end) of sentences with a cue, one after another."""
    found: list[list[int]] = []
    cue, joined = re.compile(CUE, re.IGNORECASE), False
    for match in SENTENCE.finditer(text):
        if not cue.search(match.group()):
            joined = joined and not match.group().strip()
            continue
        start = match.start() + len(match.group()) - len(match.group().lstrip())
        if joined:
            found[-1][1] = match.end()
        else:
            found.append([start, match.end()])
        joined = True
    return [(start, end) for start, end in found]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def rows_of_costs(template: list[str], block: list[str]) -> Iterator[np.ndarray]:
    """After each word of the template, and before the first: the fewest differences with which the template so far ends
    at each place of the block. A fit may start anywhere; a word missing and a word added count one each."""
    places, at = defaultdict(list), np.arange(len(block) + 1, dtype=np.int32)
    for j, word in enumerate(block):
        places[word].append(j)
    held = {word: np.array(places[word]) for word in set(template) & places.keys()}
    row = np.zeros(len(block) + 1, np.int32)
    yield row
    for word in template:
        best = row + 1
        if word in held:
            best[held[word] + 1] = np.minimum(best[held[word] + 1], row[held[word]])
        row = np.minimum.accumulate(best - at) + at
        yield row


class Fit(NamedTuple):
    """Where a template stands among the words of a block; each difference is (word of the template it is at, word, whether added)."""

    start: int
    end: int
    steps: list[tuple[int, str, bool]]

    def listed(self) -> tuple[list[str], list[str]]:
        return [f"-{w}" for _, w, added in self.steps if not added], [f"+{w}" for _, w, added in self.steps if added]


def fit(template: list[str], block: list[str], end: int, cost: int) -> Fit:
    """The fit of ``cost`` differences that ends before the word ``end`` of the block."""
    low = max(0, end - len(template) - cost)
    small = np.int16 if 2 * (len(template) + cost) < 1 << 15 else np.int32
    table = np.stack([row.astype(small) for row in rows_of_costs(template, block[low:end])])
    i, j, steps = len(template), end - low, []
    while i:
        if j and template[i - 1] == block[low + j - 1] and table[i, j] == table[i - 1, j - 1]:
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + 1:
            i -= 1
            steps.append((i, template[i], False))
        else:
            j -= 1
            steps.append((i, block[low + j], True))
    return Fit(low + j, end, steps[::-1])


def costs(template: list[str], block: list[str]) -> np.ndarray:
    for row in rows_of_costs(template, block):
        pass
    return row


def differences(block: list[str], template: list[str]) -> tuple[int, int, list[str]]:
    """Words of the template that are missing, words that are added, and both as -word and +word in order, where the template fits best.

    Words before and after the template's first and last match don't count as added: a notice may stand in a longer line."""
    gone, more = nearest(block, template).listed()
    return len(gone), len(more), gone + more


def nearest(block: list[str], template: list[str]) -> Fit:
    """Where the template fits best in the block, with what stands in place of its first and last words."""
    row = costs(template, block)
    return widened(fit(template, block, int(row.argmin()), int(row.min())), len(template), block, 0, len(block))


def widened(one: Fit, n: int, block: list[str], low: int, high: int) -> Fit:
    """The fit with the words, at most up to ``low`` and ``high``, that stand where first and last words of the template are missing."""
    gone = {i for i, _, added in one.steps if not added}
    first = next((i for i in range(n) if i not in gone), n)
    last = next((i for i in range(n) if n - 1 - i not in gone), n)
    if first == n:
        return one
    start, end = max(low, one.start - first), min(high, one.end + last)
    before = [(0, word, True) for word in block[start : one.start]]
    return Fit(start, end, before + one.steps + [(n, word, True) for word in block[one.end : end]])


def fields(template: list[str]) -> dict[int, int]:
    """For the places in a template that are in a field, and the one after, the number of the field."""
    found: dict[int, int] = {}
    for number, field in enumerate(map(str.split, FIELDS)):
        for i in range(len(template) - len(field) + 1):
            if template[i : i + len(field)] == field and i not in found:
                found |= dict.fromkeys(range(i, i + len(field) + 1), number * len(template) + i)
    return found


class Scanner:
    def __init__(self, templates: dict[str, str] | None = None):
        templates = {**TEMPLATES, **WHOLE} if templates is None else templates
        self.words = {name: words(text) for name, text in templates.items()}
        self.bags = {name: Counter(own) for name, own in self.words.items()}
        self.fields = {name: fields(own) for name, own in self.words.items()}
        self.versioned = {name for name, own in self.words.items() if any(c.isdigit() for word in own for c in word)}
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.given = {
            name: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for name, text in templates.items()
        }

    def reduction(self, block: str, name: str) -> float:
        """Share of the block's compressed size that the template saves."""
        data = block.encode("utf-8", "surrogatepass")
        return 1 - len(self.given[name].compress(data)) / len(self.plain.compress(data))

    def reductions(self, block: str, names: list[str]) -> list[tuple[float, str]]:
        """The reduction by each of the templates, most first; ties by name."""
        return sorted(((self.reduction(block, name), name) for name in names), key=lambda r: (-r[0], r[1]))

    def absent(self, name: str, bag: Counter) -> int:
        """Words of the template that are missing wherever it is held against the bag of words."""
        return sum(n - min(n, bag.get(word, 0)) for word, n in self.bags[name].items())

    def same(self, name: str, steps: list[tuple[int, str, bool]]) -> bool:
        """Whether differences are few and none tells licences apart. In a template without numbers an added one is a list mark."""
        held: Counter = Counter()
        for i, word, added in steps:
            if word in HARMLESS or (added and word.isdigit() and len(word) == 1 and name not in self.versioned):
                continue
            if i not in self.fields[name]:
                return False
            held[self.fields[name][i]] += added
        return len(steps) <= MOST_DIFFERENT * len(self.words[name]) and all(n <= FIELD_WORDS for n in held.values())

    def winner(self, block: str) -> dict:
        """Of the templates, most reduction of the block's size first, the first one whose wording is confirmed; the first
        one of all if none is. Its reduction and differences."""
        own, best = words(block), None
        bag = Counter(own)
        for reduction, name in self.reductions(block, list(self.words)):
            if best is not None and self.absent(name, bag) > MOST_DIFFERENT * len(self.words[name]):
                continue
            one = nearest(own, self.words[name])
            gone, more = one.listed()
            row = {
                "license": name, "reduction": reduction, "missing": len(gone), "added": len(more), "differences": gone + more,
                "confirmed": self.same(name, one.steps),
            }
            if row["confirmed"]:
                return row
            best = best or row
        return best

    def fits(self, name: str, part: list[str], bag: Counter, low: int) -> list[Fit]:
        """Fits of a template with few differences among the words ``part``, which start at ``low``, apart from each other, best first."""
        template, found = self.words[name], []
        most = int(MOST_DIFFERENT * len(template))
        if len(part) + most < len(template) or self.absent(name, bag) > most:
            return found
        row, taken = costs(template, part), np.zeros(len(part) + 1, bool)
        # An end that costs one more than the end before only adds a word to its fit.
        ends = np.flatnonzero((row <= most) & (row <= np.r_[row[:1], row[:-1]]))
        for end in ends[np.argsort(row[ends], kind="stable")].tolist():
            if end and not taken[end - 1]:
                one = fit(template, part, end, int(row[end]))
                if not taken[one.start : one.end].any():
                    taken[one.start : one.end] = True
                    found.append(Fit(low + one.start, low + one.end, one.steps))
        return found

    def best_fits(self, own: list[str], low: int, high: int, stretch: str) -> tuple[str, list[Fit], bool] | None:
        """The template that wins a stretch of text, its fits there, and whether they are confirmed.

        Templates are tried by how much they reduce the stretch's compressed size, most first. The first one with wording
        that confirms it wins; if there is none, the first one with a fit of few differences; None if none has any."""
        part, near = own[low:high], None
        bag = Counter(part)
        for _, name in self.reductions(stretch, [n for n in self.words if self.absent(n, bag) <= MOST_DIFFERENT * len(self.words[n])]):
            found = self.fits(name, part, bag, low)
            sure = [one for one in found if self.same(name, one.steps)]
            if sure:
                return name, sure, True
            if found and near is None:
                near = name, found, False
        return near

    def replaced(self, one: Fit, n: int, own: list[str], spans: list[tuple[int, int]], text: str, taken: np.ndarray, low: int) -> Fit:
        """A fit with the words of its first and last sentence that stand where the template's first and last words are missing."""
        apart = re.compile(r"[.!?:;]\s|\n[^\S\n]*\n")
        joined = lambda j: 0 < j < len(own) and not apart.search(text[spans[j - 1][1] : spans[j][0]])
        start, end, high = one.start, one.end, low + len(taken)
        while start > low and joined(start) and not taken[start - 1 - low]:
            start -= 1
        while end < high and joined(end) and not taken[end - low]:
            end += 1
        wide = widened(one, n, own, start, end)
        taken[wide.start - low : wide.end - low] = True
        return wide

    def scan(self, text: str) -> list[dict]:
        """Templates that stand in the text. The winner of a stretch (see ``best_fits``) is taken out, and what is left on its
        sides is scanned again until none fits. What then still speaks of licensing is a row for each block, with its winner."""
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        own, covered, rows = [text[start:end].lower() for start, end in spans], [], []
        cue = re.compile(CUE, re.IGNORECASE)
        open_ = [(0, len(own))]
        while open_:
            low, high = open_.pop()
            stretch = text[spans[low][0] : spans[high - 1][1]] if low < high else ""
            won = self.best_fits(own, low, high, stretch) if cue.search(stretch) else None
            if won is None:
                continue
            name, found, sure = won
            taken = np.zeros(high - low, bool)
            for one in found:
                taken[one.start - low : one.end - low] = True
            edges = []
            for one in found:
                if not sure:
                    one = self.replaced(one, len(self.words[name]), own, spans, text, taken, low)
                start, end = spans[one.start][0], spans[one.end - 1][1]
                while end < len(text) and not text[end].isspace() and not text[end].isalnum():
                    end += 1
                edges += [one.start, one.end]
                gone, more = one.listed()
                covered.append((start, end))
                rows.append({
                    "start": start, "end": end, "license": name, "reduction": self.reduction(text[start:end], name), "missing": len(gone),
                    "added": len(more), "differences": gone + more, "confirmed": sure,
                })
            edges = [low, *sorted(edges), high]
            open_ += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
        covered.sort()
        for low, high in zip([0, *(end for _, end in covered)], [*(start for start, _ in covered), len(text)]):
            for start, end in blocks(text[low:high]):
                rows.append({"start": low + start, "end": low + end, **self.winner(text[low + start : low + end])})
        return sorted(rows, key=lambda r: r["start"])


SCHEMA = "doc_id long, start long, end long, license string, reduction double, missing int, added int, differences array<string>, confirmed boolean"


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per template that stands in the text and per other block that speaks of licensing: doc_id, start and end in
    the text, the template, the share of the compressed size it saves, template words missing, words added, both listed,
    and whether they are few and none of them tells licences apart.

    Null and empty texts and texts without a cue give no rows; repeated rows give repeated rows; a null key stays
    null; of templates that tie the first by name wins. Other columns are ignored, whatever their names.
    """

    def build():
        scanner = Scanner(templates)

        def work(batch: pa.RecordBatch) -> dict:
            rows = [{"doc_id": i, **row} for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)) for row in scanner.scan(text)]
            return {name: [row[name] for row in rows] for name in ("doc_id", "start", "end", "license", "reduction", "missing", "added", "differences", "confirmed")}

        return work

    speaking = keyed_texts(docs, key, text).where(F.col("text").rlike(f"(?i){CUE}"))
    return map_arrow(speaking, build, SCHEMA)
