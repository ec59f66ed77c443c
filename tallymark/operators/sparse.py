"""Sparse vectors as columns, and lookups in dictionaries of any size a process can hold.

The working form is struct(size, indices, values) with indices in order, made by column expressions or from
Arrow arrays; it becomes an ML vector only where a stage asks for one, inside the JVM. A dictionary travels
with the function that uses it, which Spark broadcasts when large, so the plan does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.session import ship_active

PARTS = "struct<indices:array<int>,values:array<double>>"


def sparse(size: Column | int, parts: Column) -> Column:
    """The working form of struct(indices, values); null parts give null."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(parts.isNotNull(), F.struct(size.cast("int").alias("size"), parts["indices"].alias("indices"), parts["values"].alias("values")))


def sparse_list(values: Column) -> Column:
    """A list of numbers in the working form: what is 0 or null is not stored."""
    numbered = F.transform(values.cast("array<double>"), lambda x, k: F.struct(k.alias("k"), x.alias("x")))
    kept = F.filter(numbered, lambda p: p["x"] != 0)
    return F.when(values.isNotNull(), F.struct(F.size(values).alias("size"), F.transform(kept, lambda p: p["k"]).alias("indices"), F.transform(kept, lambda p: p["x"]).alias("values")))


def to_vector(column: Column) -> Column:
    """The working form as an ML vector: read back, as the struct that such a vector is, under the vector's type."""
    stored = F.struct(F.lit(0).cast("byte").alias("type"), column["size"].alias("size"), column["indices"].alias("indices"), column["values"].alias("values"))
    made = F.from_json(F.to_json(F.struct(stored.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return F.when(column.isNotNull(), made)


def to_dense(column: Column) -> Column:
    """The working form as array<double>: zeros up to each value, and after the last."""
    before = F.concat(F.array(F.lit(-1)), column["indices"])
    runs = F.zip_with(F.zip_with(column["indices"], before, lambda k, b: k - b - 1), column["values"], lambda gap, x: F.when(x.isNotNull(), F.concat(F.array_repeat(F.lit(0.0), gap), F.array(x))))
    rest = column["size"] - 1 - F.element_at(before, -1)
    return F.concat(F.flatten(F.filter(runs, lambda r: r.isNotNull())), F.array_repeat(F.lit(0.0), rest))


class Places:
    """A dictionary's keys and numbers as Arrow arrays."""

    def __init__(self, dictionary: dict[str, int]):
        self.keys, self.numbers = pa.array(list(dictionary), pa.string()), np.array([*dictionary.values(), -1], np.int32)

    def __call__(self, names: pa.Array) -> np.ndarray:
        """Each name's number, -1 for others and null."""
        return self.numbers[pc.index_in(names, value_set=self.keys).fill_null(-1).to_numpy(zero_copy_only=False)]


def ends_of(rows: np.ndarray, n: int) -> pa.Array:
    """Offsets of the items of each of n rows from their sorted row numbers."""
    return pa.array(np.cumsum(np.r_[0, np.bincount(rows, minlength=n)]), pa.int32())


def rows_of(lists: pa.ListArray) -> np.ndarray:
    """The row number of each item of a list column; null lists have none."""
    return np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))


def numbers_of(names: Column, dictionary: dict[str, int], missing: int = -1) -> Column:
    """An array of names as array<int> of their numbers; null counts as empty."""
    places = Places(dictionary)
    ship_active()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            found = places(lists.flatten())
            yield pa.ListArray.from_arrays(ends_of(rows_of(lists), len(lists)), pa.array(np.where(found < 0, missing, found).astype(np.int32)))

    return run(names)


def number_of(name: Column, dictionary: dict[str, int]) -> Column:
    """A name's number, null if it has none."""
    places = Places(dictionary)
    ship_active()

    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for names in batches:
            found = places(names)
            yield pa.array(found, mask=found < 0)

    return run(name)


def parts_of(rows: np.ndarray, places: np.ndarray, values: np.ndarray, n: int) -> pa.StructArray:
    """struct(indices, values) of n rows from items sorted by row and place; zeros are not stored."""
    kept = values != 0
    ends = ends_of(rows[kept], n)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(places[kept], pa.int32())), pa.ListArray.from_arrays(ends, pa.array(values[kept], pa.float64()))], ["indices", "values"])
