"""Two towers trained on pairs: an embedding of each user and item such that pairs have a high cosine and other pairs a low one.

The embeddings are one frame (side, key, vec, speed), a row a key, written to the shared folder after every
step. The labelled pairs are sorted and cut once into chunks of at most ``unit``, each a row with its keys and the
pairs as places among them. A step sends a vector to each chunk that names its key, takes there the gradient of
the squared error of the cosine, summed by the chunk's keys, sums these by key, and moves each vector along its
mean gradient, with momentum, on the unit sphere. So what a step joins and shuffles is keys of chunks, not pairs,
and a key that holds a third of the pairs is spread over a third of the chunks. Nothing but the loss comes to the
driver, so tables may be of any size.

The vectors are broadcast if a count shows at most ``small`` keys in all. The similarity of pairs joins them to
both sides: one of at most ``small`` keys is broadcast, else pairs join it by key and salt, so a key that holds a
third of the pairs meets ``salts`` copies of its vector in as many tasks.

Pairs with a null key are left out, a repeated pair weighs as often as it occurs, and no pairs give empty
towers. Keys are compared as strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.session import shared_path, ship_package, staged, unstaged

USER, ITEM = 0, 1
_CHUNK = "chunk long, users array<string>, items array<string>, of_user array<int>, of_item array<int>, y array<double>, w array<double>"
_SLOPES = "side int, key string, slope array<double>, loss double, w double"


@dataclass(frozen=True)
class Towers:
    """The embeddings (side, key, vec, ...), the loss before each step, the pairs (user, item, n), and the number of keys of a side."""

    table: DataFrame
    losses: list[float]
    pairs: DataFrame
    keys: dict[int, int]
    small: int
    salts: int

    def side(self, side: int) -> DataFrame:
        """(key, vec) of a side."""
        return self.table.where(F.col("side") == side).select("key", "vec")

    def similarity(self, pairs: DataFrame) -> DataFrame:
        """The pairs (user, item, ...) with their cosine; those with a key that was not learned go."""
        few = {side for side in (USER, ITEM) if self.keys.get(side, 0) <= self.small}
        return _joined(pairs, self.table, few, self.salts).withColumn("similarity", _dot(F.col("_u"), F.col("_v"))).select(*pairs.columns, "similarity")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _bound(value: Column, found: Callable[[Column], Column]) -> Column:
    """What a function makes of a value that is evaluated once, not wherever a lambda names it."""
    return F.transform(F.array(value), found)[0]


def _unit(a: Column) -> Column:
    divided = lambda own, length: F.when(length > 0, F.transform(own, lambda x: x / length)).otherwise(own)
    return _bound(a, lambda own: _bound(F.sqrt(_dot(own, own)), lambda length: divided(own, length)))


def _start(keys: DataFrame, dims: int, seed: int) -> DataFrame:
    """(side, key) with a vector drawn from the key's hash."""
    drawn = F.array(*[F.xxhash64(F.lit(seed), F.lit(j), "side", "key") / F.lit(float(1 << 63)) for j in range(dims)])
    zeros = F.array_repeat(F.lit(0.0), dims)
    return keys.withColumn("vec", drawn).select("side", "key", _unit(F.col("vec")).alias("vec"), zeros.alias("speed"), F.lit(0.0).alias("loss"), F.lit(0.0).alias("weight"))


def _joined(pairs: DataFrame, table: DataFrame, few: set[int], salts: int) -> DataFrame:
    """The pairs with both vectors, _u and _v; a side in ``few`` is broadcast."""
    for side, key, other, vec in ((USER, "user", "item", "_u"), (ITEM, "item", "user", "_v")):
        own = table.where(F.col("side") == side).select(F.col("key").alias("_key"), F.col("vec").alias(vec))
        match = F.col(key).cast("string") == F.col("_key")
        if side in few:
            pairs = pairs.join(F.broadcast(own), match).drop("_key")
            continue
        own = own.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = pairs.withColumn("_own", F.pmod(F.xxhash64(F.col(other).cast("string")), F.lit(salts)).cast("int"))
        pairs = dealt.join(own, match & (F.col("_own") == F.col("_salt"))).drop("_key", "_own", "_salt")
    return pairs


def shuffled_pairs(pairs: DataFrame, each: int = 1, seed: int = 17, small: int = 200_000) -> DataFrame:
    """(user, item, n): pairs of the same users with other items, ``each`` draws a pair, none of them among the pairs.

    pairs: user, item, n, each pair once. As many slots as there are items hold one item each or none; a draw is
    a slot by hash, and draws of empty slots and of pairs that exist are left out.
    """
    items = pairs.select("item").distinct()
    count = items.count()
    if not count:
        return pairs.select("user", "item", "n").limit(0)
    slot = lambda *parts: F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(count))
    slots = items.groupBy(slot("item").alias("_slot")).agg(F.min_by("item", F.xxhash64(F.lit(seed + 1), "item")).alias("_item"))
    draws = pairs.withColumn("_draw", F.explode(F.sequence(F.lit(1), F.lit(each)))).select("user", "n", slot("user", "item", "_draw").alias("_slot"))
    found = draws.join(F.broadcast(slots) if count <= small else slots, "_slot").select("user", F.col("_item").alias("item"), "n")
    return found.groupBy("user", "item").agg(F.sum("n").alias("n")).join(pairs.select("user", "item"), ["user", "item"], "left_anti")


def counted(pairs: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """(user, item, n): each pair of strings once, with how often it occurs."""
    keys = pairs.select(F.col(user).cast("string").alias("user"), F.col(item).cast("string").alias("item"))
    return keys.where(F.col("user").isNotNull() & F.col("item").isNotNull()).groupBy("user", "item").agg(F.count(F.lit(1)).alias("n"))


def _cut(rows: DataFrame, unit: int) -> DataFrame:
    """The rows (user, item, y, w) in chunks of at most ``unit``: users and items, each key once, and where among them a row's keys are.

    Sorted by user, so that most users lie in one chunk; by item too, so that a user of many rows is in many chunks.
    """

    def chunk(rows: pa.Table, number: int) -> pa.RecordBatch:
        keys = [rows[c].combine_chunks().dictionary_encode() for c in ("user", "item")]
        keys = [k.combine_chunks() if isinstance(k, pa.ChunkedArray) else k for k in keys]
        values = [k.dictionary for k in keys] + [k.indices for k in keys] + [pa.array(rows[c].to_numpy()) for c in ("y", "w")]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], ["chunk", "users", "items", "of_user", "of_item", "y", "w"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, count = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            while count + batch.num_rows >= unit:
                own = unit - count
                yield chunk(pa.Table.from_batches([*held, batch.slice(0, own)]), number)
                number, held, count, batch = number + 1, [], 0, batch.slice(own)
            held.append(batch)
            count += batch.num_rows
        if count:
            yield chunk(pa.Table.from_batches(held), number)

    ship_package(rows.sparkSession)
    dealt = rows.select("user", "item", "y", "w").repartitionByRange("user", "item").sortWithinPartitions("user", "item")
    return staged(dealt.mapInArrow(chunks, _CHUNK), "tower-chunks")


def _slopes(chunk: pa.Table, vectors: pa.Table) -> pa.Table:
    """The gradients of a chunk's pairs, summed by key, from the vectors (side, place, vec) of all its keys."""
    column = lambda name: chunk[name].combine_chunks().flatten()
    y, w = (column(c).to_numpy() for c in ("y", "w"))
    side, place = (vectors[c].to_numpy() for c in ("side", "place"))
    found = vectors["vec"].combine_chunks().flatten().to_numpy().reshape(len(side), -1)
    keys, at, own = [], [], []
    for s, names, places in ((USER, "users", "of_user"), (ITEM, "items", "of_item")):
        keys.append(column(names))
        at.append(column(places).to_numpy())
        own.append(np.empty((len(keys[-1]), found.shape[1])))
        own[-1][place[side == s]] = found[side == s]
    near = [vec[places] for vec, places in zip(own, at, strict=True)]
    cosine = np.einsum("ij,ij->i", *near)
    left = y - cosine
    pull, loss, out = left * w, left * left * w, []
    for s in (USER, ITEM):
        total = lambda values, s=s: np.bincount(at[s], values, len(keys[s]))
        slope = np.stack([total(pull * other) for other in near[1 - s].T], axis=1) - total(pull * cosine)[:, None] * own[s]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(slope) + 1) * slope.shape[1], pa.int32()), pa.array(slope.ravel()))
        sides = pa.array(np.full(len(slope), s, np.int32))
        out.append(pa.Table.from_arrays([sides, keys[s], lists, pa.array(total(loss)), pa.array(total(w))], ["side", "key", "slope", "loss", "w"]))
    return pa.concat_tables(out)


def _step(table: DataFrame, rows: DataFrame, dims: int, rate: float, momentum: float, broadcast: bool, unit: int) -> DataFrame:
    """The table after one step over rows (user, item, y, w), whose keys it has."""
    return _moved(table, _cut(rows, unit), dims, rate, momentum, broadcast)


def _moved(table: DataFrame, chunks: DataFrame, dims: int, rate: float, momentum: float, broadcast: bool) -> DataFrame:
    """The table after one step over rows that are cut into chunks."""
    named = [chunks.select(F.col("chunk").alias("to"), F.lit(side).alias("side"), F.posexplode(names).alias("place", "key")) for side, names in ((USER, "users"), (ITEM, "items"))]
    vectors = table.select("side", "key", "vec")
    sent = named[0].unionByName(named[1]).join(F.broadcast(vectors) if broadcast else vectors, ["side", "key"]).select("to", "side", "place", "vec")
    each = chunks.groupBy("chunk").cogroup(sent.groupBy("to")).applyInArrow(_slopes, _SLOPES)
    summed = each.groupBy("side", "key").agg(F.array(*[F.sum(F.get("slope", F.lit(j))) for j in range(dims)]).alias("_slope"), F.sum("loss").alias("_loss"), F.sum("w").alias("_w"))
    speed = F.when(F.col("_w") > 0, F.zip_with("speed", "_slope", lambda s, g: momentum * s + g / F.col("_w"))).otherwise(F.col("speed"))
    moved = table.join(summed, ["side", "key"], "left").withColumn("speed", speed).withColumn("vec", F.zip_with("vec", "speed", lambda x, s: x + rate * s))
    return moved.select("side", "key", _unit(F.col("vec")).alias("vec"), "speed", F.coalesce("_loss", F.lit(0.0)).alias("loss"), F.coalesce("_w", F.lit(0.0)).alias("weight"))


def train_towers(pairs: DataFrame, user: str = "user", item: str = "item", dims: int = 16, steps: int = 12, rate: float = 3.0, momentum: float = 0.8, negatives: int = 4, seed: int = 17, small: int = 200_000, salts: int = 16, unit: int = 1 << 15) -> Towers:
    """Towers of pairs (user, item, ...), against ``negatives`` shuffled pairs for each, which weigh as much together as it does."""
    spark = pairs.sparkSession
    own = staged(counted(pairs, user, item), "tower-pairs")
    others = shuffled_pairs(own, negatives, seed, small)
    row = lambda frame, y, weight: frame.select("user", "item", F.lit(y).alias("y"), (F.col("n") * weight).cast("double").alias("w"))
    rows = staged(row(own, 1.0, negatives).unionByName(row(others, 0.0, 1)), "tower-rows")
    chunks = _cut(rows, unit)
    keys = own.select(F.lit(USER).alias("side"), F.col("user").alias("key")).distinct().union(own.select(F.lit(ITEM), "item").distinct())
    paths = [shared_path(spark, "towers")]
    table = staged(_start(keys, dims, seed), "towers", path=paths[0])
    count, losses = {r["side"]: r["count"] for r in table.groupBy("side").count().collect()}, []
    for _ in range(steps if count else 0):
        paths.append(shared_path(spark, "towers"))
        table = staged(_moved(table, chunks, dims, rate, momentum, sum(count.values()) <= small), "towers", path=paths[-1])
        loss, weight = table.where(F.col("side") == USER).agg(F.sum("loss"), F.sum("weight")).first()
        losses.append(loss / weight)
        unstaged(spark, paths[-2])
    return Towers(table, losses, own, count, small, salts)
