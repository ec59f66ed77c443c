"""User identifiers and key-value cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def md5_id(user: Column) -> Column:
    """An identifier of 32 characters as it is, any other as its MD5; null stays null."""
    return F.when(F.length(user) == 32, user).otherwise(F.md5(user))


def combined_id(simei: Column, aid: Column, oem: Column) -> Column:
    """``simei`` if it has 32 characters, else ``aid``: raw for an oem of 2, otherwise the MD5 of it trimmed in lower case."""
    return F.when(F.length(simei) == 32, simei).when(oem == 2, aid).otherwise(md5_id(F.trim(F.lower(aid))))


def cell(value: Column, kind: T.DataType) -> Column:
    """A value as a cell's string: strings as they are, others as JSON."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return F.when(value, "true").otherwise("false") if isinstance(kind, T.BooleanType) else value.cast("string")


def filled(value: Column, kind: T.DataType) -> Column:
    """False for null, 0, false, the empty string, and empty arrays and maps."""
    if isinstance(kind, T.StringType):
        full = value != ""
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        full = F.size(value) > 0
    elif isinstance(kind, T.BooleanType):
        full = value
    elif isinstance(kind, T.NumericType):
        full = value != 0
    else:
        full = value.isNotNull()
    return F.coalesce(full, F.lit(False))


def to_long_form(frame: DataFrame, key: str, family: str = "t") -> DataFrame:
    """(rowkey, cf, qualifier, value): a row for each filled cell. A null key has no row."""
    cells = [F.struct(F.lit(f.name).alias("qualifier"), F.when(filled(F.col(f"`{f.name}`"), f.dataType), cell(F.col(f"`{f.name}`"), f.dataType)).alias("value")) for f in frame.schema if f.name != key]
    long = frame.select(F.col(key).cast("string").alias("rowkey"), F.explode(F.array(*cells)).alias("c"))
    return long.select("rowkey", F.lit(family).alias("cf"), "c.qualifier", "c.value").where("rowkey is not null and value is not null")


def from_long_form(long: DataFrame, qualifiers: list[str], key: str = "userid") -> DataFrame:
    """A row per rowkey with a column for each qualifier; of several values the largest."""
    return long.groupBy(F.col("rowkey").alias(key)).pivot("qualifier", qualifiers).agg(F.max("value"))


def cell_values(value: Column, schema: str) -> Column:
    """A cell of JSON lines as an array of parsed values; lines that do not parse are skipped."""
    return F.filter(F.transform(F.split(value, "\n"), lambda x: F.from_json(x, schema)), lambda x: x.isNotNull())
