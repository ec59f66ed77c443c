"""Where the words of a dictionary occur in texts: all matches with places, distinct words, or whether any occurs.

One Aho-Corasick automaton finds all words in one pass over a text, overlapping ones too. It is built once a
process and kept for the tasks that follow; words travel with the function, which Spark broadcasts when
large, so the plan does not grow with them. Places count characters from 0; ``end`` is exclusive.

Null texts give null. Empty words are left out. Matches are in order of their end, longer ones first.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.session import ship_active

#: Automata that a process keeps at most.
KEPT = 4
#: Matches, and characters searched, after which results are handed on.
RUN_MATCHES, RUN_CHARACTERS = 1 << 17, 1 << 22

_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def automaton_of(key: str, words: Iterable[str]) -> ahocorasick.Automaton:
    """The process's automaton for these words, which gives their numbers; the oldest one makes room."""
    if key not in _AUTOMATA:
        while len(_AUTOMATA) >= KEPT:
            del _AUTOMATA[next(iter(_AUTOMATA))]
        made = ahocorasick.Automaton()
        for k, word in enumerate(words):
            made.add_word(word, k)
        made.make_automaton()
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


class _Found:
    """What texts' searches gave, as arrays of numbers."""

    def __init__(self):
        self.words, self.ends, self.counts, self.valid, self.held = array("i"), array("i"), array("i"), bytearray(), 0

    def lists(self, items: pa.Array) -> pa.Array:
        """The items by text; null for texts that are null."""
        ends, valid = np.cumsum(np.r_[0, np.frombuffer(self.counts, np.int32)]).astype(np.int32), np.frombuffer(self.valid, bool)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items, mask=pa.array(~valid))


def _searched(text: Column, words: Iterable[str], kind: str, search: Callable, made: Callable) -> Column:
    """A column of ``made(found, words)`` over runs of texts, each of which ``search(automaton, text, found)`` searched and counted.

    A run ends at RUN_MATCHES matches or RUN_CHARACTERS characters, so a process holds no more than that and one text's.
    """
    ship_active()
    words = sorted({w for w in words if w})
    key = hashlib.sha256("\0".join(words).encode()).hexdigest()

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton, names = automaton_of(key, words) if words else None, pa.array(words, pa.string())
        for batch in batches:
            found = _Found()
            for x in batch:
                x = x.as_py()
                found.valid.append(x is not None)
                before = len(found.words)
                if x and automaton is not None:
                    search(automaton, x, found)
                    found.held += len(x)
                found.counts.append(len(found.words) - before)
                if len(found.words) >= RUN_MATCHES or found.held >= RUN_CHARACTERS:
                    yield made(found, names)
                    found = _Found()
            if found.valid:
                yield made(found, names)

    return run(text.cast("string"))


def _places(automaton: ahocorasick.Automaton, text: str, found: _Found) -> None:
    for end, k in automaton.iter(text):
        found.words.append(k)
        found.ends.append(end + 1)


def _words(automaton: ahocorasick.Automaton, text: str, found: _Found) -> None:
    found.words.extend(sorted({k for _, k in automaton.iter(text)}))


def _any(automaton: ahocorasick.Automaton, text: str, found: _Found) -> None:
    if (first := next(automaton.iter(text), None)) is not None:
        found.words.append(first[1])


def _place_lists(found: _Found, names: pa.Array) -> pa.Array:
    words, ends = names.take(pa.array(np.frombuffer(found.words, np.int32))), np.frombuffer(found.ends, np.int32)
    begins = ends - pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
    return found.lists(pa.StructArray.from_arrays([words, pa.array(begins, pa.int32()), pa.array(ends, pa.int32())], ["word", "begin", "end"]))


def _word_lists(found: _Found, names: pa.Array) -> pa.Array:
    return found.lists(names.take(pa.array(np.frombuffer(found.words, np.int32))))


def _flags(found: _Found, names: pa.Array) -> pa.Array:
    return pa.array(np.frombuffer(found.counts, np.int32) > 0, mask=~np.frombuffer(found.valid, bool))


def matches(text: Column, words: Iterable[str]) -> Column:
    """Every occurrence as array<struct<word, begin, end>>."""
    return _searched(text, words, "array<struct<word:string,begin:int,end:int>>", _places, _place_lists)


def matched_words(text: Column, words: Iterable[str]) -> Column:
    """The distinct words that occur, in order, as array<string>."""
    return _searched(text, words, "array<string>", _words, _word_lists)


def has_match(text: Column, words: Iterable[str]) -> Column:
    """Whether any word occurs; the search ends at the first."""
    return _searched(text, words, "boolean", _any, _flags)
