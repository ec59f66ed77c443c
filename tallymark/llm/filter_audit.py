"""How document filters interact: every order of five filters, counted by part and step.

What an order removes at each step follows from the number of documents of each set of failed filters (a
mask of five bits), so documents are read once and all orders come from 32 counts a part.

Four filters look at one text. The fifth fails a text that a smaller identifier has too, and runs as a
fingerprint-routed RDD. A scan task keeps chains of the full texts it saw under their XXH64, each with its
smallest identifier; a row that is not the smallest is settled there, so a text leaves a task once a
flush. The smallest ones are partitioned by the fingerprint and sorted on disk where memory ends; the owner
reads one chain of a fingerprint at a time, compares full texts, and emits the identifiers that are not the
minimum. Fingerprints with more rows or bytes than a partition's fair share (at most two for each partition,
so the list is small) are first owned in salted partitions and then once more. Settled rows join the labels
without text, already counted by identifier, part and mask; ``combineByKey`` merges the vectors of counts.

Null text counts as empty, a null part as the empty string. A null identifier is no smaller than any other;
rows that repeat an identifier and its text do not fail for one another. Several labels of an identifier: it is good or
toxic if any says so; null labels say nothing. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby, permutations

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import ship_package, staged

#: The filters' letters, and the characters that two of them look for.
FILTERS = "ABCDE"
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
COPY = 1 << FILTERS.index("E")

SETTLED = "doc_id long, part string, mask int, n long"
ROWS = "fingerprint long, doc_id long, part string, mask int, n long, text string"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: str) -> int:
    """The filters among the first four that a text fails, as bits."""
    body = text.encode()
    words = body.split()  # bytes split at [\x20\x09-\x0D] alone
    capitals = len(body) - len(body.translate(None, CAPITALS))
    failed = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words), 100 * capitals > CAPITAL_PERCENT * len(text), len(body.translate(None, MARKS)) < len(body))
    return sum(x << k for k, x in enumerate(failed))


def _order(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0


class Chains:
    """Texts by fingerprint, each with the rows of its smallest identifier; the others' rows are settled."""

    def __init__(self):
        self.chains: dict[int, dict[str, list]] = defaultdict(dict)
        self.settled: Counter = Counter()
        self.bytes = 0

    def add(self, fingerprint: int, doc_id: int | None, text: str, mask: int, parts: Iterable[tuple[str, int]]) -> None:
        chain = self.chains[fingerprint]
        held = chain.get(text)
        if held is None:
            chain[text] = [doc_id, mask, Counter(dict(parts))]
            self.bytes += len(text) + 500
        elif _order(doc_id) > _order(held[0]):
            self._settle(doc_id, mask, parts)
        else:
            if _order(doc_id) < _order(held[0]):
                self._settle(held[0], mask, held[2].items())
                held[0], held[2] = doc_id, Counter()
            for part, n in parts:
                held[2][part] += n

    def _settle(self, doc_id: int | None, mask: int, parts: Iterable[tuple[str, int]]) -> None:
        for part, n in parts:
            if (doc_id, part, mask | COPY) not in self.settled:
                self.bytes += 300
            self.settled[doc_id, part, mask | COPY] += n

    def smallest(self) -> Iterator[tuple]:
        """The rows that may stay: fingerprint, identifier, text, mask, numbers by part."""
        for fingerprint, chain in self.chains.items():
            for text, (doc_id, mask, parts) in chain.items():
                yield fingerprint, doc_id, text, mask, list(parts.items())

    def copies(self) -> Iterator[tuple]:
        """Settled rows: identifier, part, mask, number."""
        for (doc_id, part, mask), n in self.settled.items():
            yield doc_id, part, mask, n


def _spread(doc_id: int | None, part: str, mask: int) -> int:
    return xxhash.xxh64_intdigest(f"{doc_id} {mask} {part}") >> 1


def _scanned(flush_bytes: int, hot: frozenset[int], salts: int):
    """Rows of a scan task keyed by (place, fingerprint): texts by fingerprint, hot ones by a salt too; settled rows anywhere."""

    def run(index: int, rows: Iterable) -> Iterator[tuple]:
        def out(chains: Chains) -> Iterator[tuple]:
            for row in chains.smallest():
                place = _spread(index % salts, "", row[0]) if row[0] in hot else row[0]
                yield (place, row[0]), row[1:]
            for row in chains.copies():
                yield (_spread(*row[:3]), 0), row

        chains = Chains()
        for doc_id, part, text, fingerprint in rows:
            chains.add(fingerprint, doc_id, text, text_mask(text), [(part, 1)])
            if chains.bytes > flush_bytes:
                yield from out(chains)
                chains = Chains()
        yield from out(chains)

    return run


def _owned(hot: frozenset[int]):
    """Within a sorted partition: settled rows pass, each fingerprint's chain is compared on its own; hot texts go on."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (_, fingerprint), group in groupby(rows, key=lambda row: row[0]):
            chains = Chains()
            for _, row in group:
                if isinstance(row[3], list):  # a text and the numbers of its rows by part
                    doc_id, text, mask, parts = row
                    chains.add(fingerprint, doc_id, text, mask, parts)
                    if len(chains.settled) > 10_000:
                        yield from ((None, *x, None) for x in chains.copies())
                        chains.settled.clear()
                else:
                    yield None, *row, None
            yield from ((None, *x, None) for x in chains.copies())
            for _, doc_id, text, mask, parts in chains.smallest():
                for part, n in parts:
                    yield fingerprint, doc_id, part, mask, n, text if fingerprint in hot else None

    return run


def _routed(rows: RDD, partitions: int) -> RDD:
    return rows.repartitionAndSortWithinPartitions(partitions, lambda key: key[0] % partitions)


def settled_masks(docs: DataFrame, id_col: str, text_col: str, part_col: str, flush_bytes: int = 24 << 20) -> DataFrame:
    """Numbers of rows by identifier, part and mask: doc_id, part, mask, n; an identifier's rows may come in several."""
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("fingerprint", F.xxhash64("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    loads = slim.groupBy("fingerprint").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    loads = staged(loads, "fingerprint-loads")
    rows, size = loads.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    heavy = loads.where((F.col("n") > max(2, rows // partitions)) | ((F.col("bytes") > size // partitions) & (F.col("n") > 1)))
    hot = frozenset(x for (x,) in heavy.select("fingerprint").toLocalIterator())  # at most two for each partition
    found = slim.rdd.mapPartitionsWithIndex(_scanned(flush_bytes, hot, partitions))
    owned = spark.createDataFrame(_routed(found, partitions).mapPartitions(_owned(hot)), ROWS, verifySchema=False)
    owned = staged(owned, "settled-masks")
    done = owned.where("text is null").select("doc_id", "part", "mask", "n")
    if not hot:
        return done
    again = owned.where("text is not null").select("fingerprint", "doc_id", "text", "mask", "part", "n").rdd.map(lambda r: ((r[0], r[0]), (r[1], r[2], r[3], [(r[4], r[5])])))
    last = spark.createDataFrame(_routed(again, partitions).mapPartitions(_owned(frozenset())), ROWS, verifySchema=False)
    return done.unionByName(last.select("doc_id", "part", "mask", "n"))


def _report(rows: Iterable[tuple[str, np.ndarray]]) -> Iterator[tuple]:
    """All orders and steps of each part's counts (masks x all, good, toxic)."""
    masks = np.arange(1 << len(FILTERS))
    fails = [(masks >> k & 1).astype(bool) for k in range(len(FILTERS))]
    for part, counts in rows:
        made, shapley = [], Counter()
        for order in permutations(range(len(FILTERS))):
            left = np.ones(len(masks), bool)
            for step, k in enumerate(order, 1):
                here, before = left & fails[k], fails[k] & ~left
                left &= ~fails[k]
                removed, good, toxic = (int(x) for x in counts[here].sum(0))
                shapley[k] += removed
                made.append((part, "".join(FILTERS[x] for x in order), step, int(counts[left, 0].sum()), removed, int(counts[before, 0].sum()), int(counts[1 << k, 0]), good, toxic, k))
        for row in made:
            yield *row[:-1], shapley[row[-1]]


def _vector(row: tuple) -> np.ndarray:
    counts = np.zeros((1 << len(FILTERS), 3), np.int64)
    return _counted(counts, row)


def _counted(counts: np.ndarray, row: tuple) -> np.ndarray:
    mask, n, good, toxic = row
    counts[mask] += (n, n * good, n * toxic)
    return counts


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, as in ``REPORT``."""
    spark = docs.sparkSession
    masks = settled_masks(docs, id_col, text_col, part_col).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max(F.when(F.col(a) == 1, 1)), F.lit(0)).alias(b) for a, b in (("quality", "good"), ("toxic", "bad"))]
    )
    joined = masks.join(told, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0)))
    vectors = joined.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(_vector, _counted, lambda a, b: a + b)
    return spark.createDataFrame(vectors.mapPartitions(_report), REPORT, verifySchema=False)
