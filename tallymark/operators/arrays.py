"""Sums, merges and filters over arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many elements, sums are one aggregate each; beyond, elements are exploded.
WIDE = 256


def any_nonzero(values: Column) -> Column:
    """True if an element is not 0; a null array is false."""
    return F.coalesce(F.exists(values, lambda x: x != 0), F.lit(False))


def strict_argmax(values: Column) -> Column:
    """The index of the largest element as a double; null if another equals it or there is just one element."""
    ordered = F.sort_array(values, asc=False)
    return F.when((F.size(values) >= 2) & (ordered[0] > ordered[1]), (F.array_position(values, ordered[0]) - 1).cast("double"))


def sum_arrays(frame: DataFrame, key: str, column: str, width: int) -> DataFrame:
    """(key, column): elementwise sums by key of arrays of ``width`` elements, as array<int>.

    Null arrays and elements count as zeros. Partial sums are made before the shuffle either way.
    """
    if width <= WIDE:
        sums = [F.coalesce(F.sum(F.try_element_at(F.col(column), F.lit(k + 1))), F.lit(0)).cast("int") for k in range(width)]
        sums_only = frame.groupBy(key).agg(*[s.alias(f"_{k}") for k, s in enumerate(sums)]) if sums else frame.select(key).distinct()
        return sums_only.select(key, F.array(*[F.col(f"_{k}") for k in range(width)]).cast("array<int>").alias(column))
    parts = frame.select(key, F.posexplode_outer(column).alias("place", "value")).groupBy(key, "place").agg(F.sum("value").cast("int").alias("value"))
    found = parts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("place").isNotNull() & F.col("value").isNotNull(), F.struct("place", "value")))).alias("found"))
    return found.select(key, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.coalesce(F.try_element_at(F.col("found"), k), F.lit(0))).alias(column))


def positive_map(names: list[str], scores: Column) -> Column:
    """name -> score for the scores above 0."""
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in names]).cast("array<string>"), scores), lambda _, v: v > 0)


def merge_sum_maps(a: Column, b: Column) -> Column:
    """The sum of two maps by key; a missing key counts as 0 and a null map as empty."""
    if_null = lambda m: F.coalesce(m, F.create_map().cast("map<string,double>"))
    return F.map_zip_with(if_null(a), if_null(b), lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def sum_maps(frame: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column): the sum by map key of all maps of a key."""
    each = frame.select(key, F.explode_outer(column).alias("_k", "_v")).groupBy(key, "_k").agg(F.sum("_v").alias("_v"))
    return each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("_k").isNotNull(), F.struct("_k", "_v")))).alias(column))


def latest_merge(frame: DataFrame, key: str, date: str, data: str, limit: int, tags: str | None = None, width: int = 0) -> DataFrame:
    """One row per key: the other columns of its latest row, and ``data`` of all its rows.

    Lines are put together from the oldest day to the newest, and the newest ``limit`` stay. Equal
    dates are ordered by their lines. With ``tags``, these arrays of ``width`` elements are summed.

    At most the newest ``limit`` rows with lines can give lines, so a key with many rows is cut to
    them, before the shuffle in part, and never collected whole.
    """
    lines = F.coalesce(data, F.array().cast("array<string>"))
    others = [c for c in frame.columns if c not in (key, data, tags)]
    sums = [F.coalesce(F.sum(F.try_element_at(F.col(tags), F.lit(k + 1))), F.lit(0)).cast("int").alias(f"_t{k}") for k in range(width)] if tags else []
    latest = frame.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(F.col(date), lines)).alias("_latest"), *sums)
    newest_first = Window.partitionBy("_key").orderBy(F.desc("_date"), F.desc("_lines"))
    rows = frame.select(F.col(key).alias("_key"), F.col(date).alias("_date"), lines.alias("_lines")).where(F.size("_lines") > 0)
    few = rows.withColumn("_nth", F.row_number().over(newest_first)).where(F.col("_nth") <= limit)
    tail = F.slice("_lines", F.greatest(F.size("_lines") - limit + 1, F.lit(1)), F.lit(limit))
    merged = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_nth")).alias("n"), tail.alias("x")))), lambda p: p["x"]))
    gathered = few.groupBy("_key").agg(merged.alias("_data"))
    joined = latest.join(gathered, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_data", F.coalesce("_data", F.array().cast("array<string>")))
    newest = F.when(F.size("_data") > limit, F.slice("_data", -limit, limit)).otherwise(F.col("_data"))
    out = [F.col(key), *[F.col(f"_latest.{c}").alias(c) for c in others], newest.alias(data)]
    if tags:
        out.append(F.array(*[F.col(f"_t{k}") for k in range(width)]).cast("array<int>").alias(tags))
    return joined.select(*out)
