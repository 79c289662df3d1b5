"""License scans: normalised text against licence templates by the Dice coefficient over word bigrams.

A text is read as segments: each line, each block of lines between blank ones,
and the whole; where no such segment is like a template, also as runs of words
within the size bound that begin and end with a bigram of the template, so that
a notice inside a longer line is found. Of the templates that a segment is like,
and of runs that overlap, the likest counts, so versions and variants of a notice
are told apart. A segment's words are its runs of letters and digits in lower
case; its bigrams are the set of its neighbouring words. The Dice coefficient is
twice the shared bigrams over the sum of both counts, so for a coefficient of
``t`` the counts may differ by a factor of ``(2 - t) / t`` at most: only
templates within that bound are compared, and only those that share bigrams, by a
table of bigrams. Hashes of all bigrams of a batch find the texts that share as
many bigrams with all templates as the shortest one needs; only those are read on.

The templates are a parameter, some ninety notices and short texts by default,
held by every task.

Defined cases: a null or empty text matches nothing, nor does a segment of less
than two words; of a segment all templates of the greatest coefficient count; repeated rows give
repeated results; a null id is kept; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm import wordhash
from tariffbook.llm.common import text_or_empty
from tariffbook.llm.license_table import TEMPLATES

THRESHOLD = 0.8
SLICE = 1 << 12
WORD = re.compile(r"[^\W_]+")
BLANK = re.compile(r"\n[^\S\n]*\n\s*")


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    found = WORD.findall(text.lower())
    return frozenset(zip(found, found[1:]))


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold, self.ratio = threshold, (2 - threshold) / threshold
        self.templates = [(name, number, bigrams(body)) for number, (name, body) in enumerate(templates)]
        self.where: dict[tuple[str, str], list[int]] = {}
        for _, number, grams in self.templates:
            for gram in grams:
                self.where.setdefault(gram, []).append(number)
        most = max((len(grams) for *_, grams in self.templates), default=0)
        least = min((len(grams) for *_, grams in self.templates if grams), default=1)
        self.least = max(1, int(np.ceil(least / self.ratio - 1e-9)))  # bigrams that the shortest one needs
        self.most = int(most * self.ratio + 1e-9)
        flat = pa.array(sorted({f"{a} {b}" for *_, grams in self.templates for a, b in grams}), pa.string())
        hashes, text, _ = wordhash.words(flat)
        self.hashes = np.unique(wordhash.pairs(hashes, text)[0])

    def candidates(self, texts: pa.Array) -> np.ndarray:
        """Numbers of the texts that share enough bigrams with the templates, marks between the words aside."""
        hashes, text, start = wordhash.words(texts)
        data, _ = wordhash.buffers(texts)
        word = wordhash._KIND[data[start]] == 1 if len(start) else np.zeros(0, bool)
        two, of = wordhash.pairs(hashes[word], text[word])
        at = np.searchsorted(self.hashes, two)
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == two
        return np.flatnonzero(np.bincount(of[hit], minlength=len(texts)) >= self.least)

    def segments(self, text: str) -> Iterator[tuple[int, str]]:
        start = 0
        for line in text.split("\n"):
            yield start, line
            start += len(line) + 1
        start, blocks = 0, 0
        for block in [*BLANK.finditer(text), None]:
            end = block.start() if block else len(text)
            blocks += 1
            if "\n" in text[start:end]:
                yield start, text[start:end]
            start = block.end() if block else end
        if blocks > 1:
            yield 0, text

    def matches(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """Name and number of the template, start, length and coefficient of each segment that is like it."""
        found = set()
        for start, segment in self.segments(text):
            grams = bigrams(segment)
            if not grams or len(grams) > self.most:
                continue
            shared = Counter(number for gram in grams for number in self.where.get(gram, ()))
            like = []
            for number, both in shared.items():
                name, _, other = self.templates[number]
                if max(len(grams), len(other)) <= self.ratio * min(len(grams), len(other)) + 1e-9:
                    like.append((2 * both / (len(grams) + len(other)), name, number))
            best = max((dice for dice, *_ in like), default=0.0)
            if best >= self.threshold:
                found.update((name, number, start, len(segment), dice) for dice, name, number in like if dice == best)
        if self.most and text:
            found.update(self.inside(text, found))
        return sorted(found)

    def inside(self, text: str, found: set[tuple[str, int, int, int, float]]) -> Iterator[tuple[str, int, int, int, float]]:
        """Runs of words that are like a template and overlap no match in ``found`` that is as like; of those that overlap the likest."""
        words = list(WORD.finditer(text))
        lowered = [m[0].lower() for m in words]
        pairs = list(zip(lowered, lowered[1:]))
        hits: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs):
            for number in self.where.get(pair, ()):
                hits.setdefault(number, []).append(at)
        runs = []
        for number, mine in hits.items():
            name, _, grams = self.templates[number]
            need = max(1, int(np.ceil(len(grams) / self.ratio - 1e-9)))
            longest = int(len(grams) * self.ratio + 1e-9)
            for a in range(len(mine) - need + 1):
                first = mine[a]
                if mine[a + need - 1] - first >= longest:  # too few hits within the size bound
                    continue
                dice, end = self._best_run(pairs, first, first + longest, grams)
                if dice >= self.threshold:
                    runs.append((-dice, words[first].start(), words[end + 1].end(), number, name))
        taken = [(at, at + length, dice, number) for _, number, at, length, dice in found]
        for less, start, end, number, name in sorted(runs):
            meets = [(dice, other) for low, high, dice, other in taken if start < high and end > low]
            same = (start, end, -less) in {(low, high, dice) for low, high, dice, _ in taken[len(found) :]}
            if all(dice < -less and other != number for dice, other in meets) or (same and number not in {o for _, o in meets}):
                taken.append((start, end, -less, number))
                yield name, number, start, end - start, -less

    @staticmethod
    def _best_run(pairs: list[tuple[str, str]], first: int, stop: int, grams: frozenset) -> tuple[float, int]:
        """The best coefficient of a run of pairs from ``first`` on and its last pair."""
        seen, shared, best = set(), 0, (0.0, first)
        for at in range(first, min(stop, len(pairs))):
            if pairs[at] not in seen:
                seen.add(pairs[at])
                shared += pairs[at] in grams
            if pairs[at] in grams:
                best = max(best, (2 * shared / (len(seen) + len(grams)), at), key=lambda b: b[0])
        return best


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, license, template, start, length, dice``: a row per segment and template that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in batches:
            rows = []
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                for i in scanner.candidates(part.column(1)).tolist():
                    key = part.column(0)[i].as_py()
                    rows += [(key, *match) for match in scanner.matches(part.column(1)[i].as_py())]
            if rows:
                names = ["doc_id", "license", "template", "start", "length", "dice"]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "doc_id bigint, license string, template bigint, start bigint, length bigint, dice double"
    return rows.mapInArrow(run, schema)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
