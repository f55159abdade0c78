"""License scan by conditional compression.

Blocks of lines that hint at a license are compressed twice: alone, and with
each template as a raw Zstandard dictionary.  The template that saves the
most wins; the winner is confirmed by the words in which block and template
differ.  So are windows of words around each hint, whatever lines they lie on:
they find notices inside long lines and texts of which only some lines hint.
Where places overlap, the one that fits best counts, and a template that misses a word which
tells it from its near twins, such as a version, is never confirmed.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter, defaultdict
from collections.abc import Mapping
from importlib.resources import files as package_files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import arrow, table

#: A line with one of these may belong to a license notice; block ends follow from them.
HINT = re.compile(r"licen[sc]|copyright|\bspdx\b|warrant|permission is|redistribut|public domain|\bcc0\b|all rights reserved", re.I)
LEAST_SAVING = 0.2
LEAST_AGREEMENT = 0.75
#: Words in order that make up for a word of difference, where templates or places are compared.
WEIGHT = 4
#: Foreign words that a window has room for beside the words of a template.
SLACK = 4
#: Templates whose compressed size is within so many bytes of the last finalist's are compared too.
NEAR = 8

# fixed values: the wording of short notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is in the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Proprietary": "All rights reserved.",
}

FOUND = (
    "doc_id long, block int, first_line int, last_line int, license string, bytes_alone int, bytes_with int, saving double, "
    "n_words int, agreement double, missing_words array<string>, extra_words array<string>, ambiguous array<string>, exact boolean, confirmed boolean"
)


WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def templates_in(spark: SparkSession, path: str) -> dict[str, str]:
    """Templates from the ``.txt`` files of a folder, named by the files."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select("value", F.col("_metadata.file_name").alias("name"))
    return {r.name.removesuffix(".txt"): r.value for r in files.collect()}


def full_texts() -> dict[str, str]:
    """Longer license texts and headers that come with the package, named by their files."""
    folder = package_files(__package__) / "licenses_full"
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in sorted(folder.iterdir(), key=lambda f: f.name)}


def blocks(text: str) -> list[tuple[int, int, str]]:
    """First line, last line and text of each run of hinting lines."""
    if not HINT.search(text):
        return []
    out, run = [], []
    lines = text.split("\n")
    for n, line in enumerate(lines):
        if HINT.search(line):
            run.append(n)
        elif run:
            out.append((run[0], run[-1], "\n".join(lines[run[0] : n])))
            run = []
    if run:
        out.append((run[0], run[-1], "\n".join(lines[run[0] :])))
    return out


class Compressor:
    """Compressed sizes of a block alone and after each template."""

    def __init__(self, templates: Mapping[str, str], level: int = 3):
        import zstandard as z

        plain = dict(level=level, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.templates = dict(templates)
        self.alone = z.ZstdCompressor(**plain)
        self.after = {
            name: z.ZstdCompressor(dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT), **plain)
            for name, t in self.templates.items()
        }
        self.own = {name: len(self.alone.compress(t.encode())) for name, t in self.templates.items()}
        self.words = {name: words(t) for name, t in self.templates.items()}
        # a window fits the longest template of its class; classes double
        classes = defaultdict(list)
        for name, w in self.words.items():
            classes[max(16, len(w)).bit_length()].append(name)
        self.classes = [(max(len(self.words[n]) for n in names) + SLACK, names) for _, names in sorted(classes.items())]
        # words of a template that a near twin lacks
        self.telling = {
            a: {w for b in self.words if a != b and share(self.words[a], self.words[b]) >= LEAST_AGREEMENT for w in set(x) - set(self.words[b])}
            for a, x in self.words.items()
        }

    def ranked(self, block: str, names: list[str] | None = None) -> list[tuple[float, str, int, int]]:
        """(saving, name, size alone, size after the template), the smallest size first, then by name.

        The saving is the share of the block's size, or of the template's own where that is smaller.
        """
        raw = block.encode()
        alone = len(self.alone.compress(raw))
        sizes = {name: len(self.after[name].compress(raw)) for name in names or self.after}
        found = (((alone - n) / min(alone, self.own[name]), name, alone, n) for name, n in sizes.items())
        return sorted(found, key=lambda x: (x[3], x[1]))


def compared(ranked: list[tuple[float, str, int, int]], finalists: int) -> list[tuple[float, str, int, int]]:
    """The finalists and all that save as much as the last of them or nearly so."""
    last = ranked[: max(1, finalists)][-1:]
    return [x for x in ranked if x[3] <= last[0][3] + NEAR]


def share(a: list[str], b: list[str]) -> float:
    """Share of the words of ``a`` that ``b`` has in order."""
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) / max(1, len(a))


def difference(block: str, template: str) -> tuple[float, list[str], list[str], tuple[int, int]]:
    """Share of the template's words found in order, its words missing, foreign words between them, and the first and last place."""
    a, b = words(template), words(block)
    match = [m for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    if not match:
        return 0.0, a, b, (0, max(0, len(b) - 1))
    inside_a = {i for m in match for i in range(m.a, m.a + m.size)}
    inside_b = {i for m in match for i in range(m.b, m.b + m.size)}
    low, high = min(inside_b), max(inside_b)
    missing = [w for i, w in enumerate(a) if i not in inside_a]
    extra = [w for i, w in enumerate(b) if low < i < high and i not in inside_b]
    return len(inside_a) / len(a), missing, extra, (low, high)


def far(matched: float, missing: list[str], extra: list[str]) -> int:
    """How badly a place fits: a difference weighs as much as ``WEIGHT`` words that match."""
    return WEIGHT * (len(missing) + len(extra)) - round(matched)


def densest(found: list[str], template: list[str]) -> tuple[int, int]:
    """The words, as many as the template has, that share most with it; the first such place."""
    size, wanted, held = len(template), Counter(template), Counter()
    shared = best = at = 0
    for i, w in enumerate(found):
        held[w] += 1
        shared += held[w] <= wanted[w]
        if i >= size:
            out = found[i - size]
            shared -= held[out] <= wanted[out]
            held[out] -= 1
        if shared > best:
            best, at = shared, max(0, i - size + 1)
    return at, min(len(found), at + size)


def inside(text: str, compressor: Compressor, finalists: int, least: float, cache: dict, every: bool) -> list[tuple[int, int, str]]:
    """Start, end and text of the best place of each finalist in windows of words around each hint, or over the whole text.

    A window that a template does not shorten by the share ``least`` has no place of it.
    """
    spots = [m.span() for m in WORD.finditer(text)]
    starts, out, seen = [a for a, _ in spots], [], set()
    hints = [bisect.bisect_right(starts, m.start()) for m in HINT.finditer(text)]
    for reach, names in compressor.classes:
        for at in range(reach // 2, len(spots) + reach // 2, reach) if every else hints:
            first, last = max(0, at - reach), min(len(spots), at + reach)
            if first >= last:
                continue
            window = text[spots[first][0] : spots[last - 1][1]]
            if (window, reach) not in cache:
                cache[window, reach] = [name for saving, name, _, _ in compared(compressor.ranked(window, names), finalists) if saving >= least]
            found = [text[a:b].lower() for a, b in spots[first:last]]
            for name in cache[window, reach]:
                low, high = densest(found, compressor.words[name])
                # foreign words inside a notice push its ends out
                for slack in (0, SLACK):
                    a, b = max(0, low - slack), min(len(found), high + slack)
                    span = spots[first + a][0], spots[first + b - 1][1]
                    if (span, name) not in seen:
                        seen.add((span, name))
                        out.append((*span, text[span[0] : span[1]]))
    return out


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    *,
    key: str = "doc_id",
    text: str = "text",
    least_saving: float = LEAST_SAVING,
    least_agreement: float = LEAST_AGREEMENT,
    finalists: int = 3,
    every_window: bool = False,
) -> DataFrame:
    """One row per candidate block of each whole text, with its winning template and their differences.

    Blocks of hinting lines come first, confirmed or not; then confirmed places
    in the windows around hints.  ``every_window`` searches windows over the whole text, also where nothing hints.
    A place reaches from its first to its last word that the template has.  Places that overlap are one find: the one
    that fits best is confirmed, whatever license the others say.

    Of the templates that save most, the ``finalists`` and those within ``NEAR``
    bytes of them are compared word by word, and the one with the fewest differences for the words that match wins (then the larger saving,
    then the name): numbers such as versions decide between near twins.
    ``confirmed`` asks for both limits and that no word is missing which tells the template from a near twin;
    ``exact`` for no difference at all.  ``ambiguous`` names templates that fit the place as well as the winner does.
    Templates beyond the finalists are not compared; ``finalists=len(templates)`` compares all.
    Null and empty texts have no blocks; repeated rows are scanned alike.
    Nothing is shuffled.
    """

    def verdict(compressor: Compressor, block: str, cache: dict) -> tuple:
        """The winning template's columns, ``license`` to ``ambiguous``, and the places of its first and last word."""
        if block not in cache:
            tried = []
            for saving, name, alone, size in compared(compressor.ranked(block), finalists):
                agreement, missing, extra, reach = difference(block, compressor.templates[name])
                tried.append(((far(agreement * len(compressor.words[name]), missing, extra), size, name), (name, alone, size, saving, len(words(block)), agreement, missing, extra), reach))
            tried.sort()
            (least, *_), won, reach = tried[0]
            cache[block] = (*won, sorted(t[1][0] for t in tried[1:] if t[0][0] == least), reach)
        return cache[block]

    def sure(compressor: Compressor, v: tuple) -> bool:
        return v[3] >= least_saving and v[5] >= least_agreement and not compressor.telling[v[0]] & set(v[6])

    def span(block: str, start: int, v: tuple) -> tuple[int, int]:
        spots = [m.span() for m in WORD.finditer(block)]
        low, high = v[-1]
        return (start + spots[low][0], start + spots[high][1]) if spots else (start, start)

    def make(compressor: Compressor, batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        whole: dict[str, tuple] = {}
        ranks: dict[tuple, list] = {}
        for own, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            runs = blocks(text)
            if not runs and not every_window:
                continue
            ends = [m.start() for m in re.finditer("\n", text)]
            found = []
            for first, last, block in runs:
                v = verdict(compressor, block, whole)
                found.append((*span(block, ends[first - 1] + 1 if first else 0, v), first, last, v, True))
            for a, _, part in inside(text, compressor, finalists, least_saving, ranks, every_window):
                v = verdict(compressor, part, whole)
                a, b = span(part, a, v)
                found.append((a, b, bisect.bisect_left(ends, a), bisect.bisect_left(ends, b), v, False))
            taken: list[tuple[int, int]] = []
            kept = []
            for a, b, first, last, v, line in sorted(found, key=lambda x: (far(x[4][5] * len(compressor.words[x[4][0]]), x[4][6], x[4][7]), not x[5], x[1] - x[0], x[0])):
                good = sure(compressor, v) and not any(low < b and a < high for low, high in taken)
                if good:
                    taken.append((a, b))
                if good or line:
                    kept.append((not line, a, first, last, v, good))
            for n, (_, _, first, last, v, good) in enumerate(sorted(kept, key=lambda x: x[:2])):
                row = (own, n, first, last, *v[:-1], not v[6] and not v[7], good)
                for c, value in zip(names, row, strict=True):
                    out[c].append(value)
        return out or None

    names = [c.split()[0] for c in FOUND.split(", ")]
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return arrow(rows, make, FOUND, start=lambda: Compressor(templates))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate block of every document, with the short notices and the longer texts of the package."""
    return scan(table(spark, sf_dir, "documents"), TEMPLATES | full_texts())
