"""Packing by minimum bin slack.

Each task takes its documents in groups of bounded size. A document of more than one window gives
whole windows; what is left of it is an item. The items' lengths are a multiset of counts, and a
bitset of reachable sums, with each count in binary steps, tells which fill is closest to a window.
Walking back through the steps gives how many items of each length the window takes, and a window of
the same counts is repeated while they last. If no multiset fills a window, one item is cut to fill it
and its rest goes back. What is left of a group, less than a window, goes into the task's next group, and
what is left of a task, its tail, is gathered with other tasks' tails and packed again, by as many tasks
as there are ``tails`` of them at once, until one tail is left. Only that one gives short sequences: it is
cut at powers of two, which need no padding. No text is shuffled, only tails; each round is written to the
shared folder. A sequence identifier is made of round, partition, group and position.

Null or empty text gives a document of its end id alone. Documents are told apart by position, so null
or repeated identifiers and equal texts are each packed. An empty table gives no rows. Other columns
of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import batched
from tallymark.llm.word_ids import encoder, slices
from tallymark.session import ship_package, staged

ROWS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
SCHEMA = pa.schema([(name, pa.binary() if name == "ids" else pa.int64()) for name in (x.split()[0] for x in ROWS.split(", "))])


def best_fill(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, count) pairs from ``counts`` whose sum is the largest that is at most ``room``.

    Bit s of the set says that some multiset sums to s. Lengths are taken from the longest on and the
    search ends when ``room`` itself is reachable.
    """
    if room <= 0:
        return []
    all_bits = (2 << room) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            n = min(step, left)
            steps.append((reach, length, n))
            reach |= reach << length * n & all_bits
            left, step = left - n, step * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for before, length, n in reversed(steps):
        if not before >> at & 1:
            used[length] += n
            at -= length * n
    return list(used.items())


def windows(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Full windows as lists of (document, start, length), and last what is left, less than a window."""
    counts: dict[int, int] = defaultdict(int)
    items: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by length: (document, start)
    total = 0

    def put(doc: int, start: int, length: int) -> None:
        nonlocal total
        counts[length] += 1
        items[length].append((doc, start))
        total += length

    def take(length: int) -> tuple[int, int, int]:
        nonlocal total
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        total -= length
        return (*items[length].pop(), length)

    for doc, n in enumerate(lengths):
        for start in range(0, n - window + 1, window):
            yield [(doc, start, window)]
        if n % window:
            put(doc, n - n % window, n % window)
    while total >= window:
        longest = max(counts)
        fill = [(longest, 1)]
        counts[longest] -= 1
        fill += best_fill({k: v for k, v in counts.items() if v}, window - longest)
        counts[longest] += 1
        need: dict[int, int] = defaultdict(int)
        for length, n in fill:
            need[length] += n
        slack = window - sum(k * n for k, n in need.items())
        while total >= window and all(counts.get(k, 0) >= n for k, n in need.items()):
            sequence = [take(k) for k, n in need.items() for _ in range(n)]
            if slack:
                doc, start, length = take(max(counts))  # longer than the slack, else it would be in the fill
                sequence.append((doc, start, slack))
                put(doc, start + slack, length - slack)
            yield sequence
            if slack:
                break
    yield [take(k) for k in sorted(counts, reverse=True) for _ in range(counts[k])]


def short(rest: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of less than a window, each of a power of two."""
    rest, at = list(rest), 0
    size = sum(x[2] for x in rest)
    for power in (1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1):
        sequence, left = [], power
        while left:
            doc, start, length = rest[at]
            n = min(length, left)
            sequence.append((doc, start, n))
            left -= n
            if n == length:
                at += 1
            else:
                rest[at] = (doc, start + n, length - n)
        yield sequence


def pack(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); every token of every document is in one piece."""
    *full, rest = windows(lengths, window)
    yield from full
    yield from short(rest)


class _Packer:
    """A task's pieces, in groups; its rows are those of ROWS, a tail's with their ids."""

    def __init__(self, dtype: str, window: int, group_docs: int, group_tokens: int, base: int):
        self.dtype, self.window, self.group_docs, self.group_tokens, self.base = dtype, window, group_docs, group_tokens, base
        self.size = np.dtype(dtype).itemsize
        self.group = self.tokens = 0
        self.held: list[tuple[int | None, int, bytes, int]] = []  # doc_id, start, ids, doc_tokens

    def add(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int) -> Iterator[tuple]:
        self.held.append((doc_id, start, ids, doc_tokens))
        self.tokens += len(ids) // self.size
        if len(self.held) >= self.group_docs or self.tokens >= self.group_tokens:
            yield from self._pack()

    def _pack(self) -> Iterator[tuple]:
        *full, rest = windows([len(x[2]) // self.size for x in self.held], self.window)
        yield from self._rows(full)
        kept = []
        for doc, start, length in rest:
            doc_id, first, ids, doc_tokens = self.held[doc]
            kept.append((doc_id, first + start, ids[start * self.size : (start + length) * self.size], doc_tokens))
        self.held, self.tokens = kept, sum(x[2] for x in rest)

    def _rows(self, sequences: list) -> Iterator[tuple]:
        wide = {}
        if self.group >= 1 << 16 or len(sequences) >= 1 << 24:
            raise OverflowError("a partition has 2**16 groups or a group 2**24 sequences: identifiers would meet")
        for number, sequence in enumerate(sequences):
            offset = 0
            for doc, start, length in sequence:
                doc_id, first, ids, doc_tokens = self.held[doc]
                if doc not in wide:
                    wide[doc] = np.frombuffer(ids, self.dtype).astype("<u4")
                yield doc_id, first + start, length, zlib.crc32(wide[doc][start : start + length]), doc_tokens, self.base + (self.group << 24) + number, offset, None
                offset += length
        self.group += 1

    def ended(self, last: bool) -> Iterator[tuple]:
        """The rest as short sequences, if this is the last tail, or as a tail."""
        yield from self._pack()
        if last:
            yield from self._rows(list(short([(k, 0, len(x[2]) // self.size) for k, x in enumerate(self.held)])))
        else:
            for doc_id, start, ids, doc_tokens in self.held:
                yield doc_id, start, len(ids) // self.size, None, doc_tokens, self.base, None, ids


def first_id(number: int, partition: int) -> int:
    """The first sequence identifier of a partition of a round; an error where those of two would meet."""
    if partition >= 1 << 20 or number >= 8:
        raise OverflowError(f"round {number}, partition {partition}: at most 8 rounds of 2**20 partitions have identifiers")
    return (number << 60) + (partition << 40)


def _packed(path: str, end_id: int, window: int, group_docs: int, group_tokens: int, special_as_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        ids_of = encoder(path, special_as_text=special_as_text)
        end = np.array([end_id], ids_of.dtype).tobytes()
        packer = _Packer(ids_of.dtype, window, group_docs, group_tokens, first_id(0, TaskContext.get().partitionId()))
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                for doc_id, ids in zip(doc_ids[a:b], ids_of.encode(texts[a:b]), strict=True):
                    yield from packer.add(doc_id, 0, ids + end, len(ids) // packer.size + 1)
        yield from packer.ended(False)

    return lambda batches: batched(SCHEMA, ((row, 0) for row in rows(batches)))


def _packed_tails(dtype: np.dtype, window: int, group_tokens: int, number: int, last: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        packer = _Packer(dtype, window, group_tokens, group_tokens, first_id(number, TaskContext.get().partitionId()))
        for batch in batches:
            for doc_id, start, ids, doc_tokens in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                yield from packer.add(doc_id, start, ids, doc_tokens)
        yield from packer.ended(last)

    return lambda batches: batched(SCHEMA, ((row, 0) for row in rows(batches)))


def pack_sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, window: int = 2048, group_docs: int = 8192, group_tokens: int = 8 << 20, tails: int = 4096, special_as_text: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    group_docs and group_tokens bound what one packing problem, and so a task's memory, holds; every
    document is in some group. A partition may hold 2**16 groups, a table 2**20 partitions; more are an
    error. tails is 8 at least, so seven rounds are enough.
    """
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dtype = encoder(tokenizer, special_as_text=special_as_text).dtype
    made = staged(slim.mapInArrow(_packed(tokenizer, end_id, window, group_docs, group_tokens, special_as_text), ROWS), "packed")
    out = made.where("ids is null")
    for number in range(1, 8):
        left = made.where("ids is not null")
        n = left.select(F.count_distinct("sequence_id")).first()[0]
        if not n:
            break
        parts = -(-n // max(tails, 8))
        dealt = left.select("doc_id", "start", "ids", "doc_tokens").repartition(parts)
        made = staged(dealt.mapInArrow(_packed_tails(dtype, window, group_tokens, number, parts == 1), ROWS), "packed-tails")
        out = out.unionByName(made.where("ids is null"))
    return out.drop("ids")
