"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, document by document.

A document's tokens of side A (byte-level ids) and side B (piece ids) are laid over the same bytes. Their
ends, put together, cut the bytes into segments; each segment lies in one token of either side, and each
overlapping pair of tokens has one segment, so links are read off sorted ends. Places where tokens of both
sides end cut groups.

How many documents hold an id pair linked needs the whole corpus. Each scan block inverts its documents:
for each pair, the documents that hold it and how often, packed into one row. These postings are shuffled
by the id of side A and sorted on disk, together with the pairs' counts: a cogroup of two sorted streams.
A task reads an id's counts first, finds their maximum, then its postings, and adds up what each document
gets; these contributions are summed by document. Counts come from the postings' lengths, summed before and
after a shuffle. An id with more postings than ``slice_postings`` is cut into slices of blocks, each with all its
counts (at most the size of side B's vocabulary), so that no id has to fit one task; the list of such
ids is bounded by side A's vocabulary.

Special tokens' strings inside texts are ordinary text. A text that is null or empty, or whose bytes do not
come back from both sides' tokens, has no tokens: zeros, and an empty string for its groups. Each row is a
document of its own, also where identifiers repeat or are null. An empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import BATCH_ROWS
from tallymark.llm.pieces import PieceIds
from tallymark.llm.word_ids import PRINTED, encoder, slices
from tallymark.session import ship_package, staged

#: A pair of ids as one number.
SIDE_BITS = 31
SIDE = (1 << SIDE_BITS) - 1
POSTING = np.dtype([("doc", "<u4"), ("times", "<u4")])
BLOCKS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pair long, n int, postings binary"
_SCHEMA = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), *[(x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()), ("pair", pa.int64()), ("n", pa.int32()), ("postings", pa.binary())]
)
#: Characters of a block of documents, inverted at once, and rows from whose number a partition's documents are counted.
BLOCK_CHARS = 2 << 20
#: Entries of an encoder's tables.
HELD = 180_000
ROWS_OF_PART = 1 << 33

_SIDES: dict[tuple[str, str], Sides] = {}


class Sides:
    """Both tokenizers' encoders, their tokens' bytes, and their ids as text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, "<u4", special_as_text=True), PieceIds(path_b)
        # Two encoders' tables lie in one process.
        self.a.held = self.b.known.held = self.b.fits.held = HELD
        byte_of = {chr(c): b for b in range(256) for c in [PRINTED.get(b, b)]}
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)
        entries = {k: v for v, k in model["model"]["vocab"].items()} | {x["id"]: x["content"] for x in model["added_tokens"]}
        self.bytes_a = [bytes(byte_of.get(c, 63) for c in entries.get(k, "")) for k in range(max(entries) + 1)]
        self.bytes_b = self.b.model.bytes_of
        self.len_a, self.len_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # An id's text before another id of its side, at the end of its side of a group, and at a document's end.
        self.text = [f"{k}{mark}" for n, marks in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for mark in marks for k in range(n)]

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for a text whose bytes do not come back."""
        spaced = [f" {x}" if x else "" for x in texts]
        none = np.zeros(0, "<u4")
        side_a, side_b = [], []
        for text, a, b in zip(spaced, self.a.encode(spaced), self.b.encode(texts), strict=True):
            a, b, body = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"), text.encode()
            whole = all(b"".join(map(of.__getitem__, ids.tolist())) == body for of, ids in ((self.bytes_a, a), (self.bytes_b, b)))
            side_a.append(a if whole else none)
            side_b.append(b if whole else none)
        return side_a, side_b


def sides(path_a: str, path_b: str) -> Sides:
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = Sides(path_a, path_b)
    return _SIDES[path_a, path_b]


class Alignment:
    """A block of documents' tokens on one axis of bytes."""

    def __init__(self, both: Sides, side_a: list[np.ndarray], side_b: list[np.ndarray]):
        self.both, docs = both, len(side_a)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (side_a, side_b))
        self.a, self.b = (np.concatenate([np.zeros(0, "<u4"), *side]).astype(np.int64) for side in (side_a, side_b))
        ends_a, ends_b = np.cumsum(both.len_a[self.a]), np.cumsum(both.len_b[self.b])
        size = int(ends_a[-1]) if len(ends_a) else 0
        marks = np.zeros(size + 1, np.uint8)
        marks[ends_a] |= 1
        marks[ends_b] |= 2
        at = np.flatnonzero(marks)  # each segment's end
        kind = marks[at].astype(np.int64)
        self.from_a = np.cumsum(kind & 1) - (kind & 1)  # the token of either side that a segment lies in
        self.from_b = np.cumsum(kind >> 1) - (kind >> 1)
        doc_of_a = np.repeat(np.arange(docs), self.n_a)
        self.doc = doc_of_a[self.from_a]
        self.n_links = np.bincount(self.doc, minlength=docs)
        self.both_end = kind == 3
        self.n_groups = np.bincount(self.doc[self.both_end], minlength=docs)

    def groups(self) -> list[str]:
        """Each document's groups, ``a1,a2|b1;a3|b2,b3``."""
        both, a, b = self.both, self.a, self.b
        last_a, last_b = self.from_a[self.both_end], self.from_b[self.both_end]  # a group's last tokens
        text_a, text_b = a.copy(), b + 2 * len(both.bytes_a)
        text_a[last_a] += len(both.bytes_a)
        text_b[last_b] += len(both.bytes_b)
        # Side A's tokens of a group, then side B's: a group's tokens come after all tokens of the groups before.
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.r_[0, last_b + 1][np.searchsorted(last_a, np.arange(len(a)))]] = text_a
        out[np.arange(len(b)) + (last_a + 1)[np.searchsorted(last_b, np.arange(len(b)))]] = text_b
        made, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            made.append("".join(map(both.text.__getitem__, out[at : at + n].tolist()))[:-1])
            at += n
        return made

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs in order, the end of each one's postings, and the postings: document and number of links."""
        pair = (self.a[self.from_a] << SIDE_BITS) | self.b[self.from_b]
        order = np.lexsort((self.doc, pair))
        pair, doc = pair[order], self.doc[order]
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]) if len(pair) else np.zeros(0, np.int64)
        posting = np.empty(len(first), POSTING)
        posting["doc"], posting["times"] = doc[first], np.diff(np.r_[first, len(pair)])
        pair = pair[first]
        ends = np.flatnonzero(np.r_[pair[1:] != pair[:-1], True]) + 1 if len(pair) else first
        return pair[ends - 1], ends, posting


def _blocks(path_a: str, path_b: str):
    """Rows of documents, and rows of postings, whose ``row`` is that of the block's first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, at = sides(path_a, path_b), 0
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            part = batch.column(2)[0].as_py() if len(texts) else 0
            for a, b in slices(texts, BLOCK_CHARS):
                found = Alignment(both, *both.encoded(texts[a:b]))
                base = part * ROWS_OF_PART + at
                at += b - a
                docs = [pa.array(base + np.arange(b - a)), batch.column(0).slice(a, b - a), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(found.groups())]
                yield _rows(docs + [None] * 3, b - a)
                pairs, ends, posting = found.postings()
                offsets = pa.array(np.r_[0, ends] * POSTING.itemsize, pa.int32())
                packed = pa.BinaryArray.from_buffers(pa.binary(), len(pairs), [None, offsets.buffers()[1], pa.py_buffer(posting.tobytes())])
                made = _rows([pa.array(np.full(len(pairs), base)), *[None] * 6, pa.array(pairs), pa.array(np.diff(np.r_[0, ends]), pa.int32()), packed], len(pairs))
                for k in range(0, made.num_rows, BATCH_ROWS):
                    yield made.slice(k, BATCH_ROWS)

    return run


def _rows(columns: list, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if x is None else x for x, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (id of A, slice, block or null for a count, pair, n, postings) to sums by document.

    A slice's counts come before its postings; both are in the order of pairs.
    """
    key, pairs, counts, known = None, [], [], None
    for batch in batches:
        side, part, pair, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3, 4))
        base = batch.column(2).fill_null(-1).to_numpy()
        postings = batch.column(5)
        rows, best, sums = [], [], []
        change = np.flatnonzero((side[1:] != side[:-1]) | (part[1:] != part[:-1]) | ((base[1:] < 0) != (base[:-1] < 0))) + 1
        for low, high in zip(np.r_[0, change].tolist(), np.r_[change, len(side)].tolist(), strict=True):
            if (side[low], part[low]) != key:
                key, pairs, counts, known = (side[low], part[low]), [], [], None
            if base[low] < 0:
                pairs.append(pair[low:high])
                counts.append(n[low:high])
                continue
            if known is None:
                known = np.concatenate(pairs), np.concatenate(counts)
                largest = known[1].max()
            count = known[1][np.searchsorted(known[0], pair[low:high])]
            run = postings.slice(low, high - low)
            offsets = np.frombuffer(run.buffers()[1], np.int32)[run.offset : run.offset + high - low + 1]
            posting = np.frombuffer(run.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(POSTING)
            of = np.repeat(np.arange(high - low), np.diff(offsets) // POSTING.itemsize)
            times, count = posting["times"].astype(np.int64), count[of]
            rows.append(base[low:high][of] + posting["doc"])
            best.append(np.where(count == largest, times, 0))
            sums.append(count * times)
        if rows:
            row, best, sums = np.concatenate(rows), np.concatenate(best), np.concatenate(sums)
            order = np.argsort(row, kind="stable")
            row = row[order]
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            made = pa.RecordBatch.from_arrays([pa.array(row[first]), *[pa.array(np.add.reduceat(x[order], first)) for x in (best, sums)]], names=["row", "n_best", "count_sum"])
            for k in range(0, made.num_rows, BATCH_ROWS):
                yield made.slice(k, BATCH_ROWS)


def align_tokens(
    docs: DataFrame, tokenizer_a: str, model_b: str, id_col: str = "doc_id", text_col: str = "text", keep: Callable[[Column], Column] = lambda groups: groups, slice_postings: int = 4 << 20
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (the ids as text).

    keep: what to keep of the groups, which are several times as long as the texts, before anything is written.
    """
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    made = slim.mapInArrow(_blocks(tokenizer_a, model_b), BLOCKS)
    blocks = staged(made.withColumn("groups", keep(F.col("groups"))), "alignment", compression="zstd")
    # A block's number is its first document's, so a retried scan task, which writes its file anew, gives the same ones.
    postings = blocks.where("pair is not null").select(F.shiftright("pair", SIDE_BITS).cast("int").alias("side"), "pair", "row", "n", "postings")
    counts = staged(postings.groupBy("side", "pair").agg(F.sum("n").alias("n")), "pair-counts")
    loads = counts.groupBy("side").agg(F.sum("n").alias("n")).where(F.col("n") > slice_postings)
    large = loads.select("side", F.ceil(F.col("n") / slice_postings).cast("int").alias("slices"))  # at most side A's vocabulary
    large = F.broadcast(large)
    left = postings.join(large, "side", "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("row"), F.col("slices")).cast("int"), F.lit(0)))
    right = counts.join(large, "side", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)))
    both = left.select("side", "slice", "row", "pair", F.col("n").cast("long").alias("n"), "postings").unionByName(
        right.select("side", "slice", F.lit(None).cast("long").alias("row"), "pair", "n", F.lit(None).cast("binary").alias("postings"))
    )
    sorted_ = both.repartition("side", "slice").sortWithinPartitions("side", "slice", F.col("row").isNotNull(), "pair")
    sums = sorted_.mapInArrow(_contributions, "row long, n_best long, count_sum long").groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (
        blocks.where("pair is null").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups").join(sums, "row", "left")
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups")
    )
