"""License scans: winnowed template fingerprints, then banded alignment.

Templates are cut into runs of two words. From every few neighbouring runs the one with the
least hash is kept, so that each stretch of a template is represented; an inverted
index maps the kept fingerprints to template and place. A document asks the index for each
of its runs. Hits whose offset (place in the document less place in the template) falls into
neighbouring buckets are counted together; a pair of buckets with enough of them is a
candidate, and an alignment of template and document in a band around its offsets
says how many template words are matched in order. Candidates that match at least the share
``COVERAGE`` of the template are reported with their span; of overlapping ones of a
template the best stays. A text that holds the words of two templates reports both.

What is promised: a template of n words may lack n - ceil(COVERAGE * n) of them, ``edits``.
Every copy with at most so many words changed, left out and inserted, together, is found.
These cut the copy into ``edits`` + 1 stretches or fewer, which hold n - ``edits`` words or more,
so the longest has ``run`` words by the pigeonhole principle. A stretch of L words keeps at least
(L - window) / window fingerprints when winnowed by ``window`` = ``run`` - 1 (2 at most); their sum
over the stretches is the number of hits asked for. Offsets within a copy differ by at most
``edits``, so two neighbouring buckets that are wider than that hold all of them. The
best alignment scores 3 * matched - n at most and the copy's own 2 * n - 3 * ``edits`` at least,
so it matches n - ``edits`` words or more. Copies with more insertions are found where
enough fingerprints stay together.

The templates are a parameter of bounded size, at most ``MOST_TEMPLATE_BYTES``, and
travel with the function; documents are not shuffled, so neither a common
line nor a hot source matters.

Cases: null and empty texts match nothing; templates without words never match;
a template that occurs several times in a text is reported each time. Null and
repeated ids pass through, an empty table gives an empty result. Texts are
scanned whole. Only id and text are read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes
from tallyglass.llm.decontamination import words_of
from tallyglass.llm.license_texts import TEMPLATES

# Longest window of runs of which one is kept.
WINNOW = 2
COVERAGE = 0.8
MOST_TEMPLATE_BYTES = 16 * 1024 * 1024
# Hits of a part of a document are looked up at once; parts overlap by the longest copy.
PART_WORDS = 1 << 16
KNOWN_BYTES = 32 * 1024 * 1024
MATCH, MISMATCH, GAP = 2, -1, -1

FOUND = (
    "doc_id bigint, license string, template_words int, matched_words int, "
    "coverage double, first_word int, after_word int"
)
_NAMES = [c.split()[0] for c in FOUND.split(", ")]
_KINDS = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]


def winnowed(hashes: list[int], window: int = WINNOW) -> list[int]:
    """Places of the least hash of every ``window`` neighbours, rightmost on ties."""
    kept: set[int] = set()
    for start in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = range(start, min(start + window, len(hashes)))
        kept.add(min(part, key=lambda i: (hashes[i], -i)))
    return sorted(kept)


@dataclass(frozen=True)
class Alignment:
    matched: int
    first: int
    after: int


@dataclass(frozen=True)
class Plan:
    """What a template of ``words`` words needs to be found (see above)."""

    words: int

    @property
    def edits(self) -> int:
        return self.words - math.ceil(COVERAGE * self.words - 1e-9)

    @property
    def run(self) -> int:
        return (self.words - self.edits) // (self.edits + 1)

    @property
    def window(self) -> int:
        return max(1, min(WINNOW, self.run - 1))

    @property
    def hits(self) -> int:
        left = self.words - self.edits - self.window * (self.edits + 1)
        return max(1, math.ceil(left / self.window))


class Index:
    """Templates as word numbers, and the inverted index of their fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        if sum(len(t.encode()) for t in templates.values()) > MOST_TEMPLATE_BYTES:
            raise ValueError("templates are larger than what is sent to every executor")
        self.number: dict[bytes, int] = {}
        self.names: list[str] = []
        self.words: list[np.ndarray] = []
        for name, text in templates.items():
            words = [self.number.setdefault(w, len(self.number)) for w in words_of(text.encode())]
            if words:
                self.names.append(name)
                self.words.append(np.array(words))
        postings = []
        for template, words in enumerate(self.words):
            prints = self.prints(words, len(words) == 1)
            for place in winnowed(prints.tolist(), Plan(len(words)).window):
                postings.append((prints[place], template, place))
        postings.sort()
        # One entry a fingerprint, then where its postings begin.
        self.prints_kept, self.begin = np.unique(np.array([p[0] for p in postings], dtype=np.uint64), return_index=True)
        self.begin = np.append(self.begin, len(postings))
        self.template = np.array([p[1] for p in postings], dtype=np.int64)
        self.place = np.array([p[2] for p in postings], dtype=np.int64)
        self.plans = [Plan(len(w)) for w in self.words]
        self.lengths = np.array([p.words for p in self.plans], dtype=np.int64)
        self.widths = np.array([p.edits + 1 for p in self.plans], dtype=np.int64)
        self.asked = np.array([p.hits for p in self.plans], dtype=np.int64)
        self.known: dict[tuple, list[tuple[int, int, int]]] = {}
        self.known_bytes = 0

    def prints(self, numbers: np.ndarray, single: bool = False) -> np.ndarray:
        """Fingerprints of the runs that begin at each place; of single words for templates
        of one. Runs are numbers above those of single words, and multiplying by an odd
        number keeps different ones different."""
        size = np.uint64(len(self.number) + 1)
        words = numbers.astype(np.uint64) + np.uint64(1)
        runs = words if single else words[:-1] * size + words[1:]
        return runs * np.uint64(0x9E3779B97F4A7C15)

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Template and first offset of every pair of buckets with enough hits, in order."""
        if not self.names:
            return []
        # Buckets of a template follow one another, with a gap to those of the next.
        buckets = (len(numbers) + 2 * self.lengths) // self.widths + 3
        first_bucket = np.cumsum(buckets) - buckets
        overlap = int((self.lengths + 2 * self.widths).max())
        found: set[int] = set()
        for start in range(0, len(numbers), PART_WORDS):
            part = numbers[start : start + PART_WORDS + overlap]
            codes = [self._hits(part, start, single, first_bucket) for single in (False, True)]
            code, hits = np.unique(np.concatenate(codes), return_counts=True)
            if not len(code):
                continue
            follows = np.append(code[1:] == code[:-1] + 1, False)
            together = hits + np.where(follows, np.append(hits[1:], 0), 0)
            template = np.searchsorted(first_bucket, code, "right") - 1
            found.update(code[together >= self.asked[template]].tolist())
        pairs = []
        for code in sorted(found):
            template = int(np.searchsorted(first_bucket, code, "right")) - 1
            offset = (code - first_bucket[template]) * self.widths[template] - self.lengths[template]
            pairs.append((template, int(offset)))
        return pairs

    def _hits(self, part: np.ndarray, start: int, single: bool, first_bucket: np.ndarray) -> np.ndarray:
        """The bucket of every hit of ``part``."""
        known = part >= 0 if single else (part[:-1] >= 0) & (part[1:] >= 0)
        places = np.nonzero(known)[0]
        if not len(places) or (single and self.lengths.min() > 1):
            return np.zeros(0, dtype=np.int64)
        prints = self.prints(part, single)[places]
        at = np.minimum(np.searchsorted(self.prints_kept, prints), len(self.prints_kept) - 1)
        same = self.prints_kept[at] == prints
        at, places = at[same], places[same] + start
        many = self.begin[at + 1] - self.begin[at]
        posting = np.repeat(self.begin[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        template = self.template[posting]
        offset = np.repeat(places, many) - self.place[posting] + self.lengths[template]
        return first_bucket[template] + offset // self.widths[template]

    def scan(self, text: bytes) -> list[tuple]:
        words = words_of(text)
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        found: dict[tuple, None] = {}
        for template, low in self.candidates(numbers):
            plan = self.plans[template]
            high = low + 2 * plan.edits + 1
            start = max(0, low - plan.edits)
            stop = max(start, min(len(numbers), high + plan.words + plan.edits))
            for matched, first, after in self._copies(template, numbers[start:stop], low - start, high - start):
                row = (self.names[template], plan.words, matched, matched / plan.words, start + first, start + after)
                found[row] = None
        return _best_of_overlapping(list(found))

    def _copies(self, template: int, words: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
        """Words matched and span of every copy in a slice. Slices that repeat, as in
        a text of many copies, are aligned once."""
        key = template, low, words.tobytes()
        if key not in self.known:
            self.known_bytes += len(key[2])
            if self.known_bytes > KNOWN_BYTES:
                self.known, self.known_bytes = {}, len(key[2])
            pattern, left, copies = self.words[template], words.copy(), []
            while True:
                best = align(pattern, left, low, high, self.plans[template].edits)
                if best.matched / len(pattern) < COVERAGE:
                    break
                copies.append((best.matched, best.first, best.after))
                left[best.first : best.after] = -2  # another copy may be close by
            self.known[key] = copies
        return self.known[key]


def _best_of_overlapping(found: list[tuple]) -> list[tuple]:
    spans: dict[str, list[tuple[int, int]]] = {}
    kept: list[tuple] = []
    for row in sorted(found, key=lambda r: (-r[3], r[4], r[0])):
        taken, first, after = spans.setdefault(row[0], []), row[4], row[5]
        at = bisect.bisect(taken, (first, after))
        free_before = at == 0 or taken[at - 1][1] <= first
        if free_before and (at == len(taken) or after <= taken[at][0]):
            taken.insert(at, (first, after))
            kept.append(row)
    return sorted(kept, key=lambda r: (r[4], r[0]))


def align(template: np.ndarray, words: np.ndarray, low: int, high: int, band: int) -> Alignment:
    """Best alignment of the whole template with a part of ``words`` whose offsets
    stay within ``band`` of ``low`` to ``high``. Rows are template words; a row's
    cells are computed together, gaps along it by a running maximum."""
    base, width = low - band, high - low + 2 * band + 1
    inside = np.arange(width)
    worst = -(1 << 20)
    scores = np.zeros(width, dtype=np.int64)  # of row i at document place base + i + cell
    rows = [scores]
    same = []
    for i, word in enumerate(template):
        place = base + i + inside
        within = (place >= 0) & (place < len(words))
        equal = within & (words[np.clip(place, 0, max(0, len(words) - 1))] == word if len(words) else within)
        diagonal = scores + np.where(equal, MATCH, MISMATCH)
        diagonal[~within] = worst
        skipped = np.append(scores[1:], worst) + GAP  # the template word has no partner
        best = np.maximum(diagonal, skipped)
        scores = np.maximum.accumulate(best - GAP * inside) + GAP * inside
        rows.append(scores)
        same.append(equal)
    cell, i = int(scores.argmax()), len(template)
    matched, first, after = 0, -1, -1
    while i:
        score = rows[i][cell]
        above = rows[i - 1]
        step = MATCH if same[i - 1][cell] else MISMATCH
        place = base + i - 1 + cell
        if 0 <= place < len(words) and score == above[cell] + step:
            if same[i - 1][cell]:
                matched, first = matched + 1, place
                after = place + 1 if after < 0 else after
            i -= 1
        elif cell + 1 < width and score == above[cell + 1] + GAP:
            i, cell = i - 1, cell + 1
        else:
            cell -= 1
            if cell < 0:
                break
    return Alignment(matched, max(first, 0), max(after, 0))


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per match: document, license, words of the template, words matched,
    their share, and the span of document words (end exclusive)."""
    index = Index(templates)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    rows += [(doc_id, *found) for found in index.scan(text or b"")]
                columns = zip(*rows) if rows else [()] * len(_KINDS)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)

    rows = docs.select(
        field(id_column).cast("bigint").alias("doc_id"), field(text_column).cast("string").alias("text")
    )
    return rows.mapInArrow(work, FOUND)
