"""Label samples: day windows of lines, merging by user, balancing, splitting, repeating."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.arrays import latest_merge, strict_argmax
from tallymark.operators.rules import once
from tallymark.operators.tagging import with_label
from tallymark.session import ship_package


def last_days(date: Column, end: str, days: int) -> Column:
    """True in the ``days`` days that end at ``end`` (yyyyMMdd, as is ``date``). Both ends are literals, so partitions are pruned."""
    from datetime import datetime, timedelta

    last = datetime.strptime(end, "%Y%m%d")
    return date.between((last - timedelta(days=days - 1)).strftime("%Y%m%d"), end)


def public_version(source: Column) -> Column:
    """True for a source name of more than one character without ``oem``; null is false."""
    return F.coalesce(~source.contains("oem") & (F.length(source) > 1), F.lit(False))


def label_then_merge(lines: DataFrame, rules: list[str], user: str = "userid", date: str = "date", data: str = "data", limit: int = 1000, **options) -> DataFrame:
    """Label each day's row, merge the labelled rows by user, and label again from the summed tags."""
    labelled = with_label(lines, rules, data=data, **options).drop("label")
    merged = latest_merge(labelled, user, date, data, limit, "tags", len(rules))
    return once(merged, "label", strict_argmax(F.col("tags"))).where("label is not null")


def merge_then_label(lines: DataFrame, rules: list[str], user: str = "userid", date: str = "date", data: str = "data", limit: int = 1000, **options) -> DataFrame:
    """Merge rows by user, then label."""
    return with_label(latest_merge(lines, user, date, data, limit), rules, data=data, **options)


def draw(key: str, seed: int) -> Column:
    """A number below 2**32 that depends on a key alone: the first eight digits of the MD5 of seed and key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")


def balanced(frame: DataFrame, count: int, label: str = "label", values: tuple = (0.0, 1.0), seed: int = 17, key: str | None = None) -> DataFrame:
    """About ``count`` rows of each label, all if there are fewer; other labels go.

    With a key, rows are drawn by it, so that reruns agree however the rows lie; a null key is not drawn.
    """
    if key is not None:
        counts = frame.where(F.col(label).isin(list(values))).groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
        drawn = frame.join(F.broadcast(counts), F.col(label) == F.col("_label"))  # a row for each of the values
        return drawn.where(draw(key, seed) * F.col("_n") < F.lit(count * (1 << 32))).drop("_label", "_n")
    found = {r[label]: r["count"] for r in frame.where(F.col(label).isin(list(values))).groupBy(label).count().collect()}
    return frame.sampleBy(label, {k: min(1.0, count / n) for k, n in found.items()}, seed)


def uniform(frame: DataFrame, share: float, seed: int = 17, key: str | None = None) -> DataFrame:
    """A share of the rows; with a key drawn by it."""
    if key is not None:
        return frame.where(draw(key, seed) < round(share * (1 << 32)))
    return frame.sample(False, share, seed)


def hash_split(frame: DataFrame, key: str, share: float = 0.7, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of a key: the same key is always in the same part, however the rows lie. A null key is in the first."""
    first = F.col(key).isNull() | (draw(key, seed) < round(share * (1 << 32)))
    return frame.where(first), frame.where(~first)


def random_split(frame: DataFrame, weights: list[float], seed: int = 17) -> list[DataFrame]:
    return frame.randomSplit(weights, seed)


def shuffled(frame: DataFrame, seed: int = 17, partition_local: bool = False) -> DataFrame:
    """Rows in random order: over all, or within each partition without a shuffle."""
    drawn = frame.withColumn("_draw", F.rand(seed))
    return (drawn.sortWithinPartitions("_draw") if partition_local else drawn.orderBy("_draw")).drop("_draw")


def epochs(frame: DataFrame, n: int) -> DataFrame:
    """The rows n times, without a join."""
    return frame.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_epoch") if n > 0 else frame.limit(0)


def buffered_shuffle(rows: Iterable, flat_map: Callable[..., Iterable] = lambda x: (x,), buffer_size: int = 2000, refill: int = 10, seed: int | None = None) -> Iterator:
    """Items in random order from a buffer of bounded size, for use within a partition. A buffer of 1 or less keeps the order."""
    rng, buffer = random.Random(seed), []
    for item in (y for x in rows for y in flat_map(x)):
        if buffer_size <= 1:
            yield item
            continue
        buffer.append(item)
        if len(buffer) >= buffer_size:
            for _ in range(min(refill, len(buffer))):
                k = rng.randrange(len(buffer))
                buffer[k], buffer[-1] = buffer[-1], buffer[k]
                yield buffer.pop()
    rng.shuffle(buffer)
    yield from buffer


def buffered(frame: DataFrame, buffer_size: int = 2000, refill: int = 10, seed: int | None = None) -> DataFrame:
    """The rows of each partition in the order of buffered_shuffle, without a shuffle between partitions."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list = []
        rows = (row for batch in batches for row in batch.to_pylist())
        for row in buffered_shuffle(rows, buffer_size=buffer_size, refill=refill, seed=seed):
            held.append(row)
            if len(held) >= buffer_size:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(frame.schema)
    ship_package(frame.sparkSession)
    return frame.mapInArrow(run, frame.schema)
