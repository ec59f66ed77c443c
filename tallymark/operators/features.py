"""Encoding of lines, app lists and profiles into ids and vectors, and the dictionaries they need."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.records import app_records
from tallymark.operators.sparse import PARTS, Places, number_of, numbers_of, parts_of, rows_of, sparse_list, to_dense, to_vector
from tallymark.operators.sparse import sparse as sparse_of
from tallymark.session import ship_active

# Ids of the vocabulary's first entries, as the encoder uses them.
PAD, UNKNOWN, END, QUERY, NO_QUERY = 0, 1, 2, 4, 5


def vocabulary_of(lines: list[str]) -> dict[str, int]:
    """Token -> line number; of equal tokens the last."""
    return {x.strip(): k for k, x in enumerate(lines)}


def top_names(frame: DataFrame, column: str, k: int) -> DataFrame:
    """(name, n): the k most frequent first fields of packed records in an array column, ties by name."""
    names = frame.select(F.explode(column).alias("record")).where("record is not null").select(F.substring_index("record", ":", 1).alias("name"))
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(k)


def category_dictionary(frame: DataFrame, columns: list[str], missing: str = "-1") -> DataFrame:
    """(field, value, index): each field's distinct values in order, from 0; null is ``missing``."""
    long = frame.select(*[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in columns]).unpivot([], columns, "field", "value").distinct()
    return long.withColumn("index", F.row_number().over(Window.partitionBy("field").orderBy("value")) - 1)


class Encoder:
    """Encodes with a vocabulary of characters and a list of apps, both dictionaries on every executor.

    An app's id is its place after the vocabulary's ``lines``; an app without one is unknown.
    """

    def __init__(self, vocabulary: dict[str, int], apps: dict[str, int] | None = None, categories: dict[str, dict[str, int]] | None = None, max_length: int = 1000, need_app: bool = True, need_query: bool = True, app_length: int | None = None, pad: bool = True, lines: int | None = None):
        self.vocabulary, self.apps, self.categories = vocabulary, apps or {}, categories or {}
        self.max_length, self.need_app, self.need_query, self.app_length, self.pad = max_length, need_app, need_query, app_length, pad
        self.lines = max(vocabulary.values(), default=-1) + 1 if lines is None else lines

    def app_id(self, name: str) -> int:
        return self.lines + self.apps[name] if name in self.apps else self.vocabulary.get(name, UNKNOWN)

    def line_ids(self, data: list[str] | None) -> list[int]:
        """Per line [app][query][characters][end], one after another, cut and padded. A line without three fields is skipped."""
        out: list[int] = []
        for line in data if data is not None else ():
            part = line.split(":", 3) if line is not None else []
            if len(part) < 3:
                continue
            if self.need_app:
                out.append(self.app_id(part[0]))
            if self.need_query:
                out.append(QUERY if len(part) > 3 and part[3] == "1" else NO_QUERY)
            out += [self.vocabulary.get(c, UNKNOWN) for c in part[2]]
            out.append(END)
            if len(out) >= self.max_length:
                break
        out = out[: self.max_length]
        return out + [PAD] * (self.max_length - len(out)) if self.pad else out

    def lines_column(self, data: Column) -> Column:
        """line_ids as array<bigint>; null counts as no line."""
        encode = self.line_ids
        ship_active()

        @F.pandas_udf("array<bigint>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(encode)

        return run(data)

    def lines_vector(self, data: Column) -> Column:
        return array_to_vector(self.lines_column(data).cast("array<double>"))

    def app_list(self, apps: Column) -> Column:
        """Multi-hot array<int> over the app list; unknown apps and malformed records are skipped."""
        return self.app_features(apps)["list"]

    def app_index(self, apps: Column) -> Column:
        """Places in the app list, unknown as 1, cut and padded with 0 to app_length."""
        length = self.app_length or len(self.apps)
        apps = F.filter(F.coalesce(apps, F.array().cast("array<string>")), lambda x: x.isNotNull())
        names = numbers_of(F.transform(F.slice(apps, 1, length), lambda x: F.substring_index(x, ":", 1)), self.apps, UNKNOWN)
        cut = F.slice(names, 1, length)
        return F.concat(cut, F.array_repeat(F.lit(PAD), F.lit(length) - F.size(cut)))

    def app_features(self, apps: Column, data: Column | None = None, sparse: bool = False) -> Column:
        """struct(list, freq, dur, sys) over the app list, dense arrays or sparse vectors.

        Records are app:is_sys:freq:dur:extra. An empty number is 0; an is_sys of ``2`` or empty is -1; a
        record with a malformed number or too few fields is skipped; of an app's records the last
        counts. With ``data``, the apps of the lines are in the list too.
        """
        parts = self.app_parts(apps, data)
        kinds = ("list", "freq", "dur", "sys")
        made = [sparse_of(len(self.apps), parts[k]) for k in kinds]
        return F.struct(*[(to_vector(x) if sparse else to_dense(x)).alias(k) for k, x in zip(kinds, made, strict=True)])

    def app_parts(self, apps: Column, data: Column | None = None) -> Column:
        """app_features as struct(list, freq, dur, sys) of struct(indices, values)."""
        places = Places(self.apps)
        records = F.transform(F.filter(F.coalesce(apps, F.array().cast("array<string>")), lambda x: x.isNotNull()), _app_values)
        records = F.filter(records, lambda r: r["freq"].isNotNull() & r["dur"].isNotNull() & r["sys"].isNotNull())
        lines = F.transform(F.coalesce(F.lit(None) if data is None else data, F.array()).cast("array<string>"), lambda x: F.substring_index(x, ":", 1))

        ship_active()

        @F.arrow_udf(f"struct<list:{PARTS},freq:{PARTS},dur:{PARTS},sys:{PARTS}>")
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for own, more in batches:
                n, items = len(own), own.flatten()
                row, place = rows_of(own), places(items.field("name"))
                order = np.lexsort((np.arange(len(row)), place, row))  # of an app's records the last counts
                key = row[order] * (1 << 32) + place[order]
                order = order[np.r_[key[1:] != key[:-1], True] & (place[order] >= 0)] if len(order) else order
                row, place = row[order], place[order]
                found, line = places(more.flatten()), rows_of(more)
                key = np.unique(np.r_[row * (1 << 32) + place, line[found >= 0] * (1 << 32) + found[found >= 0]])
                parts = [parts_of(key >> 32, key & 0xFFFFFFFF, np.ones(len(key)), n)]
                parts += [parts_of(row, place, items.field(k).to_numpy(zero_copy_only=False)[order], n) for k in ("freq", "dur", "sys")]
                yield pa.StructArray.from_arrays(parts, ["list", "freq", "dur", "sys"])

        return run(records, lines)

    def profile(self, fields: dict[str, Column]) -> Column:
        """Concatenated one-hot array<double> of the fields in the dictionaries; an unknown value gives zeros."""
        found = self.profile_sparse(fields)
        return to_dense(found)

    def profile_sparse(self, fields: dict[str, Column]) -> Column:
        """profile as struct(size, indices, values)."""
        places, before = [], 0
        for name, values in self.categories.items():
            value = F.coalesce(fields[name].cast("string") if name in fields else F.lit(None).cast("string"), F.lit("-1"))
            places.append(number_of(value, {v: before + k for k, v in enumerate(sorted(values, key=values.get))}))
            before += len(values)
        indices = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
        return F.struct(F.lit(before).alias("size"), indices.alias("indices"), F.transform(indices, lambda _: F.lit(1.0)).alias("values"))


# Fixed value: how the numbers of an app record may be written.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _app_values(record: Column) -> Column:
    """struct(name, freq, dur, sys) of a record app:is_sys:freq:dur[:...]; a malformed or missing number is null."""
    part = F.split(record, ":", -1)
    number = lambda k: F.when(F.get(part, F.lit(k)) == "", 0.0).when(F.get(part, F.lit(k)).rlike(NUMBER), F.get(part, F.lit(k)).try_cast("double"))
    system = F.when(F.get(part, F.lit(1)).isin("", "2"), -1.0).otherwise(number(1))
    return F.struct(part[0].alias("name"), number(2).alias("freq"), number(3).alias("dur"), system.alias("sys"))


def dense_to_sparse(vector: Column) -> Column:
    """A vector with only its non-zero values stored."""
    values = vector_to_array(F.coalesce(vector, array_to_vector(F.array().cast("array<double>"))))  # which takes no null
    return F.when(vector.isNotNull(), to_vector(sparse_list(values)))


def list_to_sparse(values: Column) -> Column:
    """A list of numbers as such a vector."""
    return to_vector(sparse_list(values))


def vectors_to_arrays(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The frame with those of the columns that are vectors as arrays."""
    return frame.withColumns({c: vector_to_array(c) for c in columns if isinstance(frame.schema[c].dataType, VectorUDT)})


def largest_probability(probability: Column) -> Column:
    return F.array_max(vector_to_array(probability))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, null if one is all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def is_similar(a: Column, b: Column, least: float = 0.5) -> Column:
    """The category of a pair: 1 if its similarity is at least ``least``, else 0; null if one is all zeros."""
    return F.when(cosine(a, b) >= least, 1.0).when(cosine(a, b) < least, 0.0)


class LineEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The encoder as a pipeline stage: with a ``data`` column it replaces data and applist and adds appfreq, appdur and appsys; with applist alone it replaces that."""

    vocabulary = Param(Params._dummy(), "vocabulary", "lines of the vocabulary", TypeConverters.toListString)
    appNames = Param(Params._dummy(), "appNames", "lines of the app list", TypeConverters.toListString)
    maxLength = Param(Params._dummy(), "maxLength", "ids of a row", TypeConverters.toInt)
    needApp = Param(Params._dummy(), "needApp", "whether lines begin with their app", TypeConverters.toBoolean)
    needQuery = Param(Params._dummy(), "needQuery", "whether lines tell queries", TypeConverters.toBoolean)
    needPadZero = Param(Params._dummy(), "needPadZero", "whether rows are padded", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, vocabulary=None, appNames=None, maxLength=1000, needApp=True, needQuery=True, needPadZero=True):
        super().__init__()
        self._setDefault(appNames=[], maxLength=1000, needApp=True, needQuery=True, needPadZero=True)
        self._set(**self._input_kwargs)

    def setNeedPadZero(self, value: bool) -> LineEncoder:
        return self._set(needPadZero=value)

    def encoder(self) -> Encoder:
        get = lambda p: self.getOrDefault(p)
        lines = get(self.vocabulary)
        return Encoder(vocabulary_of(lines), vocabulary_of(get(self.appNames)), max_length=get(self.maxLength), need_app=get(self.needApp), need_query=get(self.needQuery), pad=get(self.needPadZero), lines=len(lines))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        encoder = self.encoder()
        if "data" in dataset.columns:
            apps = F.col("applist") if "applist" in dataset.columns else F.lit(None).cast("array<string>")
            found = dataset.withColumn("_apps", encoder.app_features(apps, F.col("data"), sparse=True))
            return found.withColumns({"data": encoder.lines_column(F.col("data")), "applist": F.col("_apps.list"), "appfreq": F.col("_apps.freq"), "appdur": F.col("_apps.dur"), "appsys": F.col("_apps.sys")}).drop("_apps")
        if "applist" in dataset.columns:
            return dataset.withColumn("applist", encoder.app_features(F.col("applist"), sparse=True)["list"])
        return dataset


def parsed_apps(apps: Column) -> Column:
    """App records of the five-field layout as structs."""
    return app_records(apps, "feature")
