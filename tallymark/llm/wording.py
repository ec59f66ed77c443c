"""Links between texts whose sets of word shingles have a Jaccard similarity of ``similarity`` or more.

Pairs at 0.8 are about 10 of 64 bits apart, give or take 3: too far for buckets of equal fingerprint
bits. Here a bucket holds the texts that agree in a whole band of minima of their shingles' hashes,
under ``BANDS`` times ``BAND_ROWS`` multiplications; by calculation 3 in a million pairs at 0.8 agree in
none, and fewer of closer ones. Buckets that share texts are one candidate group. Within a group the
fingerprints, in Gray order, go through the hierarchical index, which prunes what is more than
``distance`` bits apart, and what it leaves is settled exactly by the shingles.

Texts with equal sets are one node. A group of more than ``unit_rows`` nodes or ``unit_hashes`` hashes is
dealt out at random into units, each settled by a task: first within the units; then among one node of
each part that the links found make; last, across the parts that are left, in one of two exact ways that
the group's own counts choose, so that a node is sent at most twice by the first:

* few nodes lie outside the group's largest part: these stragglers are sent to every unit and compared
  with the nodes of other parts;
* many do, as with pages of one template: sets alike must share one of each other's rarest hashes, under
  any one order of the hashes (a set of n may leave out ``ceil(similarity * n) - 1``). The order is by counts
  of ``CELLS`` cells of hashes over all these groups. Nodes meet where nodes of different parts have such a
  hash in common, once for all hashes that the same nodes have; what a template repeats comes last in the
  order, so its pages hardly meet. Such a bucket beyond a unit is dealt into units, and its stragglers are sent to all of these, however many.

Two nodes that are in different parts meet in one of these, so no link is lost, and a group that is one
part after the second step costs no more. A task holds one unit in memory, and the counts of the cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import batched, utf8
from tallymark.llm.components import components
from tallymark.llm.gray_index import LOWER, SEED, GrayIndex, gray_rank, majority
from tallymark.session import staged

BANDS, BAND_ROWS = 32, 5
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
#: Bits that texts at a similarity of 0.8 differ in at most, but for one pair in a million, as the binomial law with 12 expected bits says.
DISTANCE = 28
#: Rounding of similarity times a count.
EPSILON = 1e-9
#: Candidates from which one pass over a unit's hashes beats a comparison each.
MANY = 8
SETS = pa.schema([("node", pa.int64()), ("hashes", pa.binary())])
LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
#: Cells whose counts order the hashes; 8 MB of counts.
CELLS = 1 << 20


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The distinct hashes of a text's shingles in order; fewer words are one shingle."""
    parts = text.translate(LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(x) + 1 for x in parts))
    starts = [0, *ends[: len(parts) - words]]
    return np.unique(np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)], np.uint64))


def name(hashes: np.ndarray) -> int:
    """The node of a set of shingles."""
    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), SEED), np.uint64).view(np.int64))


def bands(hashes: np.ndarray, block: int = 512) -> list[int]:
    """A key for each band; none of an empty set."""
    if not len(hashes):
        return []
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), block):
        np.minimum(least, (FACTORS[:, None] * hashes[None, at : at + block]).min(1), out=least)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def enough(shared: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, similarity: float):
    """Whether sets of a and b elements that share so many are alike."""
    return shared >= similarity * (a + b - shared) - EPSILON


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets' Jaccard similarity is at least ``similarity``."""
    return bool(enough(len(a) + len(b) - len(np.union1d(a, b)), len(a), len(b), similarity))


class Unit:
    """Sets in the Gray order of their fingerprints, each with the part that it is in so far."""

    def __init__(self, fps: np.ndarray, sets: list[np.ndarray], parts: np.ndarray, similarity: float, distance: int):
        self.fps, self.sets, self.parts, self.similarity, self.distance = fps, sets, parts.copy(), similarity, distance
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self._words: np.ndarray | None = None

    def shared(self, own: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How many elements a set has in common with each of the others."""
        if len(others) < MANY:
            return np.array([len(own) + self.sizes[k] - len(np.union1d(own, self.sets[k])) for k in others.tolist()], np.int64)
        if self._words is None:
            self._words, self._flat = np.unique(np.concatenate(self.sets), return_inverse=True)
        marked = np.zeros(len(self._words) + 1, np.int64)
        at = np.minimum(np.searchsorted(self._words, own), len(self._words) - 1)
        marked[at[self._words[at] == own]] = 1
        sums = np.r_[0, np.cumsum(marked[self._flat])]
        return sums[self.starts[others + 1]] - sums[self.starts[others]]

    def settle(self, own: np.ndarray, part: int, others: np.ndarray, merge: bool = True) -> Iterator[int]:
        """Of the others in other parts than ``part`` one of each part that has a set alike; with ``merge`` these parts become it."""
        others = others[(self.parts[others] != part) & enough(np.minimum(self.sizes[others], len(own)), self.sizes[others], len(own), self.similarity)]
        if not len(others):
            return
        found = others[enough(self.shared(own, others), self.sizes[others], len(own), self.similarity)]
        for at in np.unique(self.parts[found], return_index=True)[1].tolist():
            other = int(found[at])
            if merge:
                self.parts[self.parts == self.parts[other]] = part
            yield other

    def links(self, block: int = 64) -> Iterator[tuple[int, int]]:
        """A spanning forest of the sets that are alike; neighbours in the order first, then what the index leaves."""
        for k in range(1, len(self.sets)):
            for other in self.settle(self.sets[k], int(self.parts[k]), np.array([k - 1])):
                yield k, other
        if len(np.unique(self.parts)) < 2:
            return
        index = GrayIndex(self.fps, np.zeros(len(self.fps), np.int64))
        for low in range(0, len(self.fps), block):
            a, b = index.search(low, min(low + block, len(self.fps)), self.distance)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else a
            for start, end in zip(cuts, [*cuts[1:], len(a)], strict=False):
                k = int(a[start])
                for other in self.settle(self.sets[k], int(self.parts[k]), b[start:end]):
                    yield k, other

    def links_to(self, fp: np.uint64, own: np.ndarray, part: int) -> Iterator[int]:
        """A set of each other part that is alike to a set from elsewhere."""
        near = np.flatnonzero(np.bitwise_count(self.fps ^ fp) <= self.distance)
        yield from self.settle(own, part, near, merge=False)


def described(words: int) -> Callable:
    """Rows (doc_id, text_hash, text) to (doc_id, text_hash, node, fp, n, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, sizes, keys = [], [], [], []
            for text in utf8(batch.column(2)):
                hashes = shingles(text, words)
                nodes.append(name(hashes))
                prints.append(majority(hashes.tolist()) if len(hashes) else 0)
                sizes.append(len(hashes))
                keys.append(bands(hashes))
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "fp", "n", "bands"])

    return run


DESCRIBED = "doc_id long, text_hash long, node long, fp long, n long, bands array<long>"


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((name(h), h.tobytes()) for batch in batches for h in (shingles(text, words) for text in utf8(batch.column(0))))
        yield from batched(SETS, ((row, len(row[1])) for row in rows))

    return run


def _settled(similarity: float, distance: int):
    """Over rows (root, unit, sent, node, fp, part, hashes) by root and unit, those sent from other units last: links."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        current, held, unit, names = None, [], None, []

        def made() -> Unit:
            prints = np.array([x[1] for x in held], np.int64).view(np.uint64)
            order = np.argsort(gray_rank(prints), kind="stable")
            names[:] = [held[k][0] for k in order.tolist()]
            return Unit(prints[order], [np.frombuffer(held[k][3], np.uint64) for k in order.tolist()], np.array([held[k][2] for k in order.tolist()], np.int64), similarity, distance)

        def ended() -> Iterator[tuple[int, int]]:
            if unit is None and len(held) > 1:
                yield from ((names[a], names[b]) for a, b in made().links())

        for batch in batches:
            for root, number, sent, node, fp, part, hashes in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if (root, number) != current:
                    yield from ended()
                    current, held, unit = (root, number), [], None
                if not sent:
                    if not held or held[-1][0] != node:
                        held.append((node, fp, part, hashes))
                    continue
                if unit is None:
                    unit = made() if held else False
                if unit:
                    own = np.frombuffer(hashes, np.uint64)
                    yield from ((node, names[k]) for k in unit.links_to(np.int64(fp).view(np.uint64), own, part))
        yield from ended()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(LINKS, ((pair, 0) for pair in links(batches)))

    return run


def _candidates(nodes: DataFrame) -> DataFrame:
    """Edges that connect the nodes of each band's key to the least of them."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    least = keys.groupBy("key").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "v")
    return keys.join(least, "key").where("node <> v").select(F.col("node").alias("u"), "v").distinct()


def _with_parts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The nodes with the part that the links put them in."""
    found = components(links).select(F.col("u").alias("_node"), F.col("root").alias("_part"))
    return nodes.join(found, F.col("node") == F.col("_node"), "left").withColumn("part", F.coalesce("_part", "node")).drop("_node", "_part")


def _units(rows: Column, hashes: Column, unit_rows: int, unit_hashes: int) -> Column:
    return F.greatest(F.ceil(rows / unit_rows), F.ceil(hashes / unit_hashes), F.lit(1)).cast("int")


def _cell(root: np.ndarray | int, hashes: np.ndarray) -> np.ndarray:
    """The cell of each hash in a group."""
    mixed = (hashes ^ np.uint64(root & (1 << 64) - 1)) * FACTORS[0]
    return (mixed >> np.uint64(44)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, ..., hashes) to (cell, count) over a partition."""
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        for root, hashes in zip(batch.column("root").to_pylist(), batch.column("hashes").to_pylist(), strict=True):
            np.add.at(counts, _cell(root, np.frombuffer(hashes, np.uint64)), 1)
    cells = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "count"])


def rarest(root: int, hashes: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """A set's rarest hashes, so many that no set alike misses all of them."""
    if not len(hashes):
        return hashes
    kept = len(hashes) - int(np.ceil(similarity * len(hashes) - EPSILON)) + 1
    return hashes[np.lexsort((hashes, counts[_cell(root, hashes)]))[:kept]]


def _postings(counts: np.ndarray, similarity: float):
    """Rows (root, node, fp, n, part, hashes) to (root, node, fp, n, part, hash), one for each of the rarest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(batch.column("root").to_pylist(), batch.column("hashes").to_pylist(), strict=True)
            found = [rarest(root, np.frombuffer(hashes, np.uint64), counts, similarity) for root, hashes in own]
            if found:
                rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                out = batch.select(["root", "node", "fp", "n", "part"]).take(rows)
                yield out.append_column("hash", pa.array(np.concatenate(found).view(np.int64)))

    return run


def _sent(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (root, node, fp, part) dealt into their groups' units, and those outside the largest part sent to all units.

    groups: root, units, largest.
    """
    own = rows.join(groups, "root").withColumn("unit", F.pmod(F.xxhash64(F.lit("unit"), "node"), "units").cast("int"))
    columns = ["root", "unit", "sent", "node", "fp", "part"]
    stragglers = own.where("units > 1 and part <> largest").withColumn("unit", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
    return own.withColumn("sent", F.lit(False)).select(*columns).union(stragglers.withColumn("sent", F.lit(True)).select(*columns))


def _groups(rows: DataFrame, unit_rows: int, unit_hashes: int) -> DataFrame:
    """Groups (root, rows, outside, units, largest) of rows (root, part, n) that have more than one part."""
    sizes = rows.groupBy("root", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("hashes"))
    whole = sizes.groupBy("root").agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("rows", "part")).alias("largest"), F.max("rows").alias("most"), F.sum("rows").alias("rows"), F.sum("hashes").alias("hashes"))
    return whole.where("parts > 1").select("root", "rows", (F.col("rows") - F.col("most")).alias("outside"), _units(F.col("rows"), F.col("hashes"), unit_rows, unit_hashes).alias("units"), "largest")


def across(parted: DataFrame, sets: DataFrame, similarity: float, unit_rows: int, unit_hashes: int) -> DataFrame:
    """Rows (root, unit, sent, node, fp, part) by which nodes of different parts meet wherever their sets may be alike.

    parted: root, node, fp, n, part; sets: node, hashes.
    """
    parted = parted.select("root", "node", "fp", "n", "part").distinct()
    groups = staged(_groups(parted, unit_rows, unit_hashes), "open-groups")
    few = F.col("outside") * F.col("units") <= F.col("rows")
    sent = _sent(parted, groups.where(few).select("root", "units", "largest"))
    many = groups.where(~few)
    if many.isEmpty():
        return sent
    apart = parted.join(many.select("root"), "root", "left_semi")
    with_sets = staged(apart.join(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "node").select("root", "node", "fp", "n", "part", "hashes"), "open-sets")
    counts = np.zeros(CELLS, np.int64)
    cells = with_sets.select("root", "hashes").mapInArrow(_cell_counts, "cell long, count long").groupBy("cell").agg(F.sum("count").alias("count")).toArrow()
    counts[cells["cell"].to_numpy()] = cells["count"].to_numpy()
    postings = staged(with_sets.mapInArrow(_postings(counts, similarity), "root long, node long, fp long, n long, part long, hash long"), "postings")
    # Of hashes that the same nodes have, told by 128 bits, one is enough.
    alike_by = postings.groupBy("root", "hash").agg(F.min("part").alias("_a"), F.max("part").alias("_b"), F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64(F.lit("again"), "node")).alias("_y"))
    mixed = alike_by.where("_a <> _b").groupBy("root", "_x", "_y").agg(F.min("hash").alias("hash")).select("root", "hash")
    met = staged(postings.join(mixed, ["root", "hash"]).select(F.xxhash64("root", "hash").alias("root"), "node", "fp", "n", "part"), "met")
    return sent.union(_sent(met, _groups(met, unit_rows, unit_hashes).select("root", "units", "largest")))


def wording_links(slim: DataFrame, nodes: DataFrame, words: int, similarity: float, distance: int = DISTANCE, unit_rows: int = 4096, unit_hashes: int = 1 << 22, small: int = 200_000) -> DataFrame:
    """Links (u, v) that connect all nodes at ``similarity`` or more.

    slim: doc_id, text_hash, text; nodes: node, fp, n, bands, and ``least``, a struct of the identifier
    and the text's hash of one document of the node. At most ``small`` nodes with candidates, by a count,
    are broadcast to the texts; else each text is shuffled once.
    """
    linked = components(_candidates(nodes))
    grouped = linked.union(linked.select(F.col("root").alias("u"), "root").distinct()).select(F.col("u").alias("node"), "root")
    members = nodes.join(grouped, "node").select("root", "node", "fp", "n", "least")
    units = members.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("hashes")).select("root", _units(F.col("rows"), F.col("hashes"), unit_rows, unit_hashes).alias("units"))
    dealt = staged(members.join(units, "root").withColumn("unit", F.pmod(F.xxhash64(F.lit("unit"), "node"), "units").cast("int")).withColumn("part", F.col("node")), "candidate-groups")
    wanted = dealt.select(F.col("least.doc_id").alias("_id"), F.col("least.text_hash").alias("_hash"))
    wanted = F.broadcast(wanted) if dealt.count() <= small else wanted
    own = slim.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_semi").select("text")
    sets = staged(own.mapInArrow(_sets(words), "node long, hashes binary"), "shingle-sets")
    columns = ["root", "unit", "sent", "node", "fp", "part", "hashes"]

    def settled(rows: DataFrame) -> DataFrame:
        """Links of rows (root, unit, sent, node, fp, part)."""
        whole = rows.join(sets, "node").select(*columns).repartition("root", "unit").sortWithinPartitions("root", "unit", "sent", "node")
        return whole.mapInArrow(_settled(similarity, distance), "u long, v long")

    here, away = F.lit(False).alias("sent"), F.lit(True).alias("sent")
    links = staged(settled(dealt.select("root", "unit", here, "node", "fp", "part")), "links")
    split = dealt.where("units > 1")
    if split.isEmpty():
        return links
    # One node of each part that the units' links make.
    parted = staged(_with_parts(split.drop("part"), links), "parts")
    heads = parted.where("part = node")
    few = heads.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("hashes")).select("root", _units(F.col("rows"), F.col("hashes"), unit_rows, unit_hashes).alias("_units"))
    again = heads.join(few, "root").select("root", F.pmod(F.xxhash64(F.lit("head"), "node"), "_units").cast("int").alias("unit"), here, "node", "fp", "part")
    links = links.union(staged(settled(again), "links"))
    parted = staged(_with_parts(split.drop("part"), links), "parts")
    return links.union(staged(settled(across(parted, sets, similarity, unit_rows, unit_hashes)), "links"))
