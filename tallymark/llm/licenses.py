"""License scans by conditional compression.

Words are ``[^\\x20\\x09-\\x0D]+``, compared in lower case and without punctuation around them. A passage
is a template's wording with changes of at most ``max_changed`` of its words: removed, added or replaced ones.

Every template has cue words, its longest ones, one more than a passage may have removed; so a passage
holds a cue. Around a cue lies a candidate block, as long to either side as the longest passage: one for
long templates, then one for short ones. A template is a candidate if the block holds as many of its word
pairs as a passage must. The block is compressed alone and with each candidate as a raw zstandard
dictionary; what a template saves says how much of its wording the block shares. Templates are ranked
by that and confirmed by their exact differences from the block, an alignment with the fewest words
removed, added or replaced. Of confirmed templates that save nearly as much as the best of them, the one
with the fewest changes wins, then the one that saves more, then the smaller name. Cues inside a
confirmed passage are not looked at again; what lies beside it in the block is.

One pass of an automaton over each text tells those without any cue, at no more cost. Blocks are bounded
by the longest template and each is worked off on its own, so a long text costs memory only for its
words. Null and empty text has no finding. Each of several passages, and each of repeated rows, is
reported. Templates without words find nothing. An empty table gives no rows. Other columns of the input
are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import batched
from tallymark.llm.license_texts import TEMPLATES
from tallymark.session import ship_package

#: Templates of more words than this are looked for first, in larger blocks.
LONG = 50
#: Share of the best confirmed saving from which another template is compared by its wording.
NEARLY = 0.8
_WORD = re.compile(r"[^ \t-\r]+")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("license", pa.string()), ("saved_bytes", pa.int64()), ("changed_words", pa.int64()), ("removed", pa.string()), ("added", pa.string()), ("passage", pa.string())])


def plain(word: str) -> str:
    """A word as it is compared: lower-case, without punctuation around it."""
    return word.lower().strip(".,;:!?()[]{}<>\"'*#/|-") or word


def alignment(own: list[str], block: list[str]) -> tuple[int, int, int, list[str], list[str]]:
    """The fewest changes from ``own`` to a part of the block, where that part lies (first, end), and the words removed and added.

    A replaced word is one change. Of equal alignments the one that ends first is taken, and words are
    replaced rather than removed or added.
    """
    ids = {w: k for k, w in enumerate(dict.fromkeys(own))}
    there = np.array([ids.get(w, -1) for w in block], np.int64)
    places = np.arange(len(block) + 1)
    rows = [np.zeros(len(block) + 1, np.int64)]
    for word in own:
        above = rows[-1]
        best = above + 1
        best[1:] = np.minimum(best[1:], above[:-1] + (there != ids[word]))
        rows.append(np.minimum.accumulate(best - places) + places)  # or words added on the left
    at = end = int(rows[-1].argmin())
    removed, added = [], []
    k = len(own)
    while k:
        here = rows[k][at]
        if at and here == rows[k - 1][at - 1] + (there[at - 1] != ids[own[k - 1]]):
            k, at = k - 1, at - 1
            if block[at] != own[k]:
                removed.append(own[k])
                added.append(block[at])
        elif here == rows[k - 1][at] + 1:
            k -= 1
            removed.append(own[k])
        else:
            at -= 1
            added.append(block[at])
    return int(rows[-1][end]), at, end, removed[::-1], added[::-1]


class Scanner:
    """Ranks and confirms templates for blocks of words."""

    def __init__(self, templates: dict[str, str], max_changed: float):
        import ahocorasick

        self.words = {k: [plain(w) for w in _WORD.findall(templates[k])] for k in sorted(templates)}
        self.names = [k for k, v in self.words.items() if v]
        self.slack = {k: int(max_changed * len(v)) for k, v in self.words.items()}
        # Savings of a short notice are lost in a block that is cut for a long one, so each kind has blocks of its own.
        kinds = [[k for k in self.names if (len(self.words[k]) > LONG) == long] for long in (True, False)]
        self.kinds = [(max(len(self.words[k]) + self.slack[k] for k in names) + 1, names) for names in kinds if names]
        self.reach = max((reach for reach, _ in self.kinds), default=0)
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.given = {k: zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(" ".join(self.words[k]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k in self.names}
        self.cues = self._cues()
        self.automaton = ahocorasick.Automaton()
        for cue in self.cues:
            self.automaton.add_word(cue, 1)
        self.automaton.make_automaton()
        #: Templates of each pair of words, and how many of a template's distinct pairs a passage holds at least.
        self.pairs: dict[tuple[str, str], list[str]] = defaultdict(list)
        self.needed = {}
        for name in self.names:
            own = self.words[name]
            distinct = set(zip(own, own[1:], strict=False))
            self.needed[name] = len(distinct) - 2 * self.slack[name]
            for pair in distinct:
                self.pairs[pair].append(name)

    def _cues(self) -> set[str]:
        """Words of which each passage holds one: at one more place of its template than may be removed.

        Places of words that are cues already come first, then those of the longest words.
        """
        cues: set[str] = set()
        for name in sorted(self.names, key=lambda k: len(self.words[k])):
            places = sorted(self.words[name], key=lambda w: (w not in cues, -len(w), w))
            cues.update(places[: self.slack[name] + 1])
        return cues

    def ranked(self, block: list[str], names: list[str] | None = None) -> list[tuple[int, str]]:
        """(-saved bytes, name) of the templates, best first; in a small block of other words one may save nothing."""
        data = " ".join(block).encode("utf-8", "replace")
        size = len(self.alone.compress(data))
        return sorted((len(self.given[k].compress(data)) - size, k) for k in (self.names if names is None else names))

    def candidates(self, known: list[tuple[int, list[str]]], low: int, high: int, names: list[str]) -> list[str]:
        """Those of the templates of which the block holds enough word pairs; known: places of pairs of any template."""
        held: dict[str, set] = defaultdict(set)
        for k in range(bisect_left(known, low, key=lambda x: x[0]), len(known)):
            at, pair = known[k]
            if at >= high - 1:
                break
            for name in self.pairs[pair]:
                held[name].add(pair)
        return [k for k in names if len(held[k]) >= self.needed[k]]

    def confirm(self, block: list[str], names: list[str] | None = None) -> tuple | None:
        """(name, saved, changed, first, end, removed, added) of the winner."""
        confirmed = []
        for less, name in self.ranked(block, names):
            if confirmed and -less < NEARLY * confirmed[0][1]:
                break
            changed, *found = alignment(self.words[name], block)
            if changed <= self.slack[name]:
                confirmed.append((name, -less, changed, *found))
        return min(confirmed, key=lambda c: (c[2], -c[1], c[0]), default=None)

    def scan(self, text: str | None) -> Iterator[tuple]:
        """Each confirmed passage, in order: first word, number of words, name, saved, changed, removed, added, wording."""
        if not text or not self.cues or next(self.automaton.iter(text.lower()), None) is None:
            return
        words = _WORD.findall(text)
        plains = [plain(w) for w in words]
        known = [(k, pair) for k, pair in enumerate(zip(plains, plains[1:], strict=False)) if pair in self.pairs]
        ready: list[tuple] = []  # confirmed passages that a block may still reach
        for k, word in enumerate(plains):
            while ready and ready[0][0] + ready[0][1] <= k - self.reach:
                yield ready.pop(0)
            if word not in self.cues:
                continue
            # A block may hold several passages: what is confirmed beside the cue bounds the next look at it.
            while not any(p[0] <= k < p[0] + p[1] for p in ready):
                found = None
                for reach, names in self.kinds:
                    low = max([0, k - reach, *(p[0] + p[1] for p in ready if p[0] + p[1] <= k)])
                    high = min([len(words), k + reach, *(p[0] for p in ready if p[0] > k)])
                    among = self.candidates(known, low, high, names)
                    found = self.confirm(plains[low:high], among) if among else None
                    if found:
                        break
                if not found:
                    break
                name, saved, changed, first, end, removed, added = found
                ready.append((low + first, end - first, name, saved, changed, " ".join(removed), " ".join(added), " ".join(words[low + first : low + end])))
                ready.sort()
        yield from ready


def _scanned(templates: dict[str, str], max_changed: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, max_changed)
        rows = ((doc_id, *found) for batch in batches for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for found in scanner.scan(text))
        yield from batched(SCHEMA, ((row, len(row[-1])) for row in rows))

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, max_changed: float = 0.15) -> DataFrame:
    """One row per passage: doc_id, first_word, n_words, license, saved_bytes, changed_words, removed, added, passage."""
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_scanned(TEMPLATES if templates is None else templates, max_changed), "doc_id long, first_word long, n_words long, license string, saved_bytes long, changed_words long, removed string, added string, passage string")
