"""SimHash near-dedup with a Gray-order hierarchical index.

A text's A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``; its shingles are runs of ``words``
words, repeats included (fewer words: the whole sequence). A bit of the fingerprint is 1 if it is set
in over half of the shingles' XXH64 values (UTF-8, seed 42). Fingerprints link at ``distance`` or
fewer differing bits; links are followed to components.

Search. Equal fingerprints are one node. With at most two differing bits and three bit blocks, one
block is equal, so each fingerprint goes to three buckets, keyed by a mask and the bits under it. A
bucket of more than ``bucket_rows`` fingerprints is dealt again by three blocks of its remaining bits;
after four such levels at least 50 bits are fixed, so no bucket can exceed 16,384 fingerprints, and no
link is lost. Within a task, each bucket's fingerprints are sorted by Gray rank. Runs of eight become a node
that factors out the bits that all its members share; its own parent holds the bits shared one level
higher, and a node keeps only the rest. A query walks from the bucket's root, adds the differing bits
of each node to what its ancestors gave, and prunes the whole group once the sum exceeds the distance.
Tasks give a spanning forest of what they found, not all pairs.

With ``similarity``, texts link by their sets of shingles instead: buckets are bands of shingle minima,
and the index prunes before the exact comparison (see ``wording``).

Null text counts as empty; no words give fingerprint zero, linked like any other. Null identifiers
take part but never name a component, unless it has no other. Repeated rows stay repeated. An empty
table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import utf8
from tallymark.llm.components import components
from tallymark.llm.gray_index import bucket_links, fingerprint
from tallymark.llm.wording import DESCRIBED, DISTANCE, described, wording_links
from tallymark.session import ship_package, staged

LEVELS = 4


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x, words) for x in utf8(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], names=["doc_id", "text_hash", "fp"])

    return run


def _links(distance: int, flush_rows: int):
    """Over rows sorted by bucket: whole buckets at a time, some at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(part: np.ndarray) -> pa.RecordBatch:
            u, v = bucket_links(part[0].view(np.uint64), part[1].view(np.uint64), part[2].view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            held.append(np.array([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)], np.int64))
            if sum(x.shape[1] for x in held) >= flush_rows:
                whole = np.concatenate(held, 1)
                change = np.flatnonzero((whole[0, 1:] != whole[0, :-1]) | (whole[1, 1:] != whole[1, :-1]))
                if len(change):
                    yield found(whole[:, : change[-1] + 1])
                    whole = whole[:, change[-1] + 1 :]
                held = [whole]
        if held and sum(x.shape[1] for x in held):
            yield found(np.concatenate(held, 1))

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def refined(mask: int, blocks: int) -> list[int]:
    """The mask with each of ``blocks`` runs of its free bits added."""
    free = [k for k in range(64) if not mask >> k & 1]
    cuts = [len(free) * k // blocks for k in range(blocks + 1)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _dealt(rows: DataFrame, masks: list[int], blocks: int) -> DataFrame:
    """(mask, key, fp) with each row's mask refined."""
    if masks == [0]:
        next_masks = F.array(*[F.lit(_signed(x)) for x in refined(0, blocks)])
    else:
        next_masks = F.element_at(F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(r)) for r in refined(m, blocks)]))]), F.col("mask"))
    return rows.select(F.explode(next_masks).alias("mask"), "fp").select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")


def fingerprint_links(nodes: DataFrame, distance: int = 2, bucket_rows: int = 1024, flush_rows: int = 1 << 17) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (fp long) within ``distance`` bits."""
    blocks = distance + 1
    masks, rows, parts = [0], nodes.select("fp"), []
    for level in range(LEVELS):
        rows = _dealt(rows, masks, blocks)
        if level:  # two masks may be refined to the same one
            rows = rows.distinct()
        masks = list(dict.fromkeys(r for m in masks for r in refined(m, blocks)))
        if level == LEVELS - 1:
            parts.append(rows)
            break
        hot = staged(rows.groupBy("mask", "key").count().where(F.col("count") > bucket_rows).select("mask", "key"), "hot-buckets")
        if hot.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(hot, ["mask", "key"], "left_anti"))
        rows = staged(rows.join(hot, ["mask", "key"]).select("mask", "fp"), "hot-fingerprints")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_links(distance, flush_rows), "u long, v long")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int | None = None, similarity: float | None = None, bucket_rows: int = 1024, **limits) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest identifier reachable), text_hash, first.

    ``first`` holds for one document of each component: the smallest identifier's, of several texts with
    it the one with the least text_hash (XXH64 of the text). Without ``similarity`` fingerprints link at
    ``distance`` (2) bits; with it texts link at that similarity of their sets of shingles, and
    ``distance`` (28) is what the index prunes by. limits: unit_rows, unit_hashes and small of wording_links.
    """
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("least")
    if similarity is None:
        made = staged(slim.mapInArrow(_fingerprints(words), "doc_id long, text_hash long, fp long").withColumn("node", F.col("fp")), "fingerprints")
        nodes = staged(made.groupBy("node").agg(least), "nodes")
        links = fingerprint_links(nodes.select(F.col("node").alias("fp")), 2 if distance is None else distance, bucket_rows)
    else:
        made = staged(slim.mapInArrow(described(words), DESCRIBED), "shingle-bands")
        nodes = staged(made.groupBy("node").agg(least, *[F.first(c).alias(c) for c in ("fp", "n", "bands")]), "nodes")
        links = wording_links(slim, nodes, words, similarity, DISTANCE if distance is None else distance, **limits)
    rooted = nodes.join(components(links).withColumnRenamed("u", "node"), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("first"))
    of_node = rooted.join(named, "root").select("node", "first")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return made.join(of_node, "node").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id"), "text_hash", first.alias("first"))


def first_of_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = 200_000, **options) -> DataFrame:
    """The rows of docs but those that are not ``first`` in their component.

    What goes is told by identifier and text, so rows that repeat both stay or go together. If at most
    ``small`` go, by a count, they are broadcast and nothing is shuffled; else each text is, once.
    """
    found = simhash_near_dedup(docs, id_col, text_col, **options)
    own = "gone_"
    while any(c.lower().startswith(own) for c in docs.columns):  # Spark's names know no case
        own += "_"
    gone = staged(found.where(~F.col("first")).select(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash")).distinct(), "near-copies")
    side = F.broadcast(gone) if gone.count() <= small else gone
    return docs.join(side, docs[id_col].cast("long").eqNullSafe(F.col(f"{own}id")) & (F.xxhash64(docs[text_col].cast("string")) == F.col(f"{own}hash")), "left_anti")
