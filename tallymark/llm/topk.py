"""Exact top-k inner products by a three-phase uniform threshold.

A component x becomes floor(scale * x), so scores are exact integers. The components are cut into
lists of consecutive dimensions, each list held apart, and a vector's score is the sum of its partial
scores in the lists. Phase one gathers from each list the k best entries of each query and scores
these vectors fully: the k-th best score is a safe cutoff t. Phase two hands each list t / lists and
collects every entry that reaches it: a vector below it in every list has a score below t. An entry is
left out if even the largest product that the norms of the unseen parts allow keeps it below t. Phase
three sends an entry that some list did not collect, as two identifiers, to that list, which resolves
its parts exactly by products of whole blocks; no vector is moved for an entry.

Queries come in blocks of bounded size against blocks of rows, so no task holds all of either; a task
multiplies ``STEP`` queries at a time. Of
equal vectors only the k + 1 with the smallest identifiers can be in any result, so only they are
candidates; a partial limit before the shuffle keeps a common vector from filling a task.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an
identifier. A shorter vector's missing components count as zero. Repeated rows are one. Scores outside
a long are held at its limits. Without queries or candidates there are no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import ship_package, staged

#: Fewer lists mean higher cutoffs and fewer entries; one alone would be a plain scan.
LISTS = 2
EXACT = float(1 << 53)
STEP = 512
#: A part is sent as two longs, a multiple of this and a rest, as sums of parts may need more than one.
HALF = 1 << 62


def _whole_vectors(scale: float):
    """Valid vectors as little-endian doubles that hold integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies, squares = [], [], []
            for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vec_id is None or x is None or any(c is None for c in x):
                    continue
                made = np.floor(scale * np.array(x, np.float64))
                if np.isfinite(made).all():
                    ids.append(vec_id)
                    bodies.append((made + 0.0).astype("<f8").tobytes())  # -0.0 becomes 0.0
                    squares.append(float(made @ made))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.binary()), pa.array(squares, pa.float64())], names=["vec_id", "body", "square"])

    return run


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for k, body in enumerate(column.to_pylist()):
        row = np.frombuffer(body, "<f8")
        out[k, : len(row)] = row
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, each pair's; in doubles where these are exact, else in whole numbers."""
    if not queries.size or not rows.size or np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] < EXACT:
        return queries @ rows.T
    as_int = lambda x: np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)
    return as_int(queries) @ as_int(rows).T


def clamp(score: int | float) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _halves(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores as multiples of HALF and rests."""
    if scores.dtype != object:
        return np.zeros(len(scores), np.int64), scores.astype(np.int64)
    high = [min(max(x // HALF, -(1 << 60)), 1 << 60) for x in scores.tolist()]
    return np.array(high, np.int64), np.array([x % HALF for x in scores.tolist()], np.int64)


def _table(query_id: np.ndarray, which: int, vec_id: np.ndarray, scores: np.ndarray) -> pa.Table:
    high, low = _halves(scores)
    return pa.table({"query_id": pa.array(query_id, pa.int64()), "list": pa.array(np.full(len(query_id), which, np.int32)), "vec_id": pa.array(vec_id, pa.int64()), "high": pa.array(high), "low": pa.array(low)})


ENTRIES = "query_id long, list int, vec_id long, high long, low long"


def _entries(k: int, lists: int, width: int, cutoff: bool):
    """One list's entries for a block of queries and one of rows: the k best, or all that reach the cutoff."""

    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asked = np.array(rows.column("vec_id").to_pylist(), np.int64), np.array(queries.column("query_id").to_pylist(), np.int64)
        bodies, wanted = _matrix(rows.column("body"), width), _matrix(queries.column("body"), width)
        # The norms of what the other lists hold of each vector, a little rounded up.
        rest = [np.sqrt(np.maximum(np.array(x.column("square").to_pylist(), float) * (1 + 1e-9) - (m * m).sum(1), 0)) for x, m in ((queries, wanted), (rows, bodies))]
        made = []
        for at in range(0, len(asked) if len(ids) else 0, STEP):
            own = asked[at : at + STEP]
            part = products(wanted[at : at + STEP], bodies)
            if cutoff:
                tau = np.array([-np.inf if t is None else t for t in queries.column("tau").to_pylist()[at : at + STEP]], part.dtype)
                who, what = np.nonzero((part * lists >= tau[:, None]) & (ids != own[:, None]))
                if part.dtype != object:
                    with np.errstate(invalid="ignore"):
                        most = np.nan_to_num(part[who, what] + rest[0][at + who] * rest[1][what] * (1 + 1e-9) + 1, nan=np.inf)
                    who, what = who[most >= tau[who]], what[most >= tau[who]]
            else:
                first = min(k + 1, len(ids))  # one more, as a query's own vector does not count
                order = np.argsort(-part, axis=1, kind="stable") if part.dtype == object else np.argpartition(-part, first - 1, axis=1)
                who, what = np.repeat(np.arange(len(own)), first), order[:, :first].ravel()
                other = ids[what] != own[who]
                who, what = who[other], what[other]
            made.append(_table(own[who], key[2].as_py(), ids[what], part[who, what]))
        return pa.concat_tables(made) if made else _table(asked[:0], 0, asked[:0], np.zeros(0))

    return run


def _parts(width: int):
    """One list's parts for the wanted pairs of a block of queries and one of rows; both blocks are in one table."""

    def run(key: tuple, both: pa.Table, pairs: pa.Table) -> pa.Table:
        kind, ids, bodies = np.array(both.column("kind").to_pylist(), np.int64), np.array(both.column("id").to_pylist(), np.int64), _matrix(both.column("body"), width)
        queries, rows = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
        queries, rows = queries[np.argsort(ids[queries])], rows[np.argsort(ids[rows])]
        asked, found = np.array(pairs.column("query_id").to_pylist(), np.int64), np.array(pairs.column("vec_id").to_pylist(), np.int64)
        order = np.argsort(asked, kind="stable")
        asked, found = asked[order], found[order]
        who, what = np.searchsorted(ids[queries], asked), np.searchsorted(ids[rows], found)
        made = []
        for at in range(0, len(queries), STEP):
            low, high = np.searchsorted(who, (at, at + STEP))
            if low < high:
                part = products(bodies[queries[at : at + STEP]], bodies[rows])
                made.append(_table(asked[low:high], key[2].as_py(), found[low:high], part[who[low:high] - at, what[low:high]]))
        return pa.concat_tables(made) if made else _table(asked[:0], 0, asked[:0], np.zeros(0))

    return run


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full scores of (query_id, vec_id, query's body, vector's body)."""
    for batch in batches:
        found = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(a, "<f8"), np.frombuffer(b, "<f8")
            n = min(len(x), len(y))
            found.append(clamp(products(x[None, :n], y[None, :n])[0, 0]) if n else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, lists: int = LISTS, query_block: int = 1 << 15, row_block: int = 8192) -> DataFrame:
    """One row per query and rank: query_id, rank, vec_id, score. ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    ship_package(spark)
    is_query = F.col("vec_id") % 100 == 0 if is_query is None else is_query
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    whole = staged(raw.mapInArrow(_whole_vectors(scale), "vec_id long, body binary, square double").distinct(), "vectors")
    width, n = whole.agg(F.max(F.octet_length("body")), F.count(F.lit(1))).first()
    cut = -(-(width or 0) // 8 // lists) or 1  # dimensions of a list
    n_queries = whole.where(is_query).count()
    first = Window.partitionBy("body").orderBy("vec_id")
    candidates = staged(whole.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth"), "candidates")
    q_blocks, r_blocks = max(1, -(-n_queries // query_block)), max(8, -(-n // row_block))
    block_of = lambda name, n_blocks: F.pmod(F.xxhash64(name), F.lit(n_blocks)).cast("int")
    key = ("qb", "rb", "list")

    def listed(frame: DataFrame, name: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        """Each row's parts, one for each list and block of the other side."""
        part = F.col("body").substr(F.col("list") * cut * 8 + 1, F.lit(cut * 8))
        dealt = frame.withColumn(own, block_of(name, own_n))
        return dealt.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1)))).withColumn("body", part).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))

    rows = listed(candidates, "vec_id", "rb", r_blocks, "qb", q_blocks)

    def gathered(asked: DataFrame, cutoff: bool) -> DataFrame:
        blocks = listed(asked, "query_id", "qb", q_blocks, "rb", r_blocks)
        return rows.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(_entries(k, lists, cut, cutoff), ENTRIES)

    def resolved(pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """Full scores of a few pairs for each query."""
        both = pairs.join(asked.select("query_id", F.col("body").alias("q")), "query_id").join(candidates, "vec_id")
        return both.select("query_id", "vec_id", "q", "body").mapInArrow(_resolved, "query_id long, vec_id long, score long")

    asked = whole.where(is_query).select(F.col("vec_id").alias("query_id"), "body", "square")
    best = Window.partitionBy("query_id", "list").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    seen = gathered(asked, False).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).select("query_id", "vec_id").distinct()
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    tau = resolved(seen, asked).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k).select("query_id", F.col("score").alias("tau"))
    cut_off = staged(asked.join(tau, "query_id", "left"), "cutoffs")
    entries = staged(gathered(cut_off, True), "entries")
    # The lists that did not collect an entry give its other parts.
    seen_by = entries.groupBy("query_id", "vec_id").agg(F.bit_or(F.expr("shiftleft(1L, list)")).alias("lists")).where(F.col("lists") < (1 << lists) - 1)
    unseen = seen_by.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1)))).where("getbit(lists, list) = 0")
    pairs = unseen.select(block_of("query_id", q_blocks).alias("qb"), block_of("vec_id", r_blocks).alias("rb"), "list", "query_id", "vec_id")
    sides = [rows.select(*key, F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "body"), listed(asked, "query_id", "qb", q_blocks, "rb", r_blocks).select(*key, F.lit(1).alias("kind"), F.col("query_id").alias("id"), "body")]
    others = sides[0].union(sides[1]).groupBy(*key).cogroup(pairs.groupBy(*key)).applyInArrow(_parts(cut), ENTRIES)
    sums = entries.union(others).groupBy("query_id", "vec_id").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    score = F.expr(f"cast(least(greatest(cast(high * {HALF}BD + low as decimal(38,0)), {-(1 << 63)}BD), {(1 << 63) - 1}BD) as bigint)")
    return sums.select("query_id", "vec_id", score.alias("score")).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
