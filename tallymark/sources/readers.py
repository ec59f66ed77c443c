"""Readers of tables, files and dictionaries. Schemas are declared, not inferred, where a file does not hold one."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A catalog table or view, with its columns and rows cut down before anything else."""
    frame = spark.table(name)
    frame = frame.where(where) if where else frame
    return frame.select(*columns) if columns else frame


def orc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """ORC files; vector columns need a schema, as ORC does not keep their type."""
    return (spark.read.schema(schema) if schema else spark.read).orc(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; values that do not parse are null."""
    return spark.read.option("header", True).schema(schema).csv(path)


def text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def key_values(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """(key, value) of the lines with exactly two fields; of several values of a key the largest."""
    part = F.split(F.col("value"), f"\\Q{separator}\\E", -1)
    pairs = spark.read.text(path).select(part.alias("p")).where(F.size("p") == 2).select(F.col("p")[0].alias("key"), F.col("p")[1].alias("value"))
    return pairs.groupBy("key").agg(F.max("value").alias("value"))


def key_value_map(spark: SparkSession, path: str, separator: str = "\t", most: int = 1_000_000) -> dict[str, str]:
    """key_values as a dictionary on the driver; more than ``most`` keys are an error."""
    rows = key_values(spark, path, separator).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path} has more than {most} keys")
    return {r.key: r.value for r in rows}


def local_map(path: str, separator: str = "\t", encoding: str = "utf8") -> dict[str, str]:
    """A local file's lines, cut at the first separator, both sides stripped; a line without one is an error."""
    with open(path, encoding=encoding) as lines:
        out = {}
        for line in lines:
            key, found, value = line.partition(separator)
            if not found:
                raise ValueError(f"{path}: no separator in {line!r}")
            out[key.strip()] = value.strip()
        return out


def json_dictionary(path: str) -> dict:
    """A local JSON file, keys in order."""
    with open(path, encoding="utf8") as file:
        return json.load(file)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(token, id): each stripped line of one file with its number from 0; of equal tokens the last. An empty file has none.

    Splits are read in parallel: a line's number is that of the lines in earlier splits, from sums over one row for each,
    and its place in its own, in which the reader's row numbers are consecutive.
    """
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    blocks = lines.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("block", (earlier - F.col("first")).alias("shift"))
    numbered = lines.join(starts, "block").select(F.trim("value").alias("token"), (F.col("row") + F.col("shift")).cast("int").alias("id"))
    return numbered.groupBy("token").agg(F.max("id").alias("id"))


def geojson_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """(name, part, rings) of all polygons of a folder's GeoJSON files, each one collection or a list of them.

    A row for each part of a MultiPolygon; other geometries and features without a name or place give none.
    """
    feature = "struct<properties:struct<name:string>,geometry:struct<type:string,coordinates:string>>"
    whole = spark.read.text(folder, wholetext=True).select(F.from_json("value", f"array<struct<features:array<{feature}>>>").alias("c"))
    each = whole.select(F.explode("c").alias("c")).select(F.explode("c.features").alias("f")).select("f.properties.name", "f.geometry.type", "f.geometry.coordinates")
    rings = "array<array<array<double>>>"
    parts = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", rings))).when(F.col("type") == "MultiPolygon", F.from_json("coordinates", f"array<{rings}>"))
    found = each.where("name is not null").select("name", F.posexplode(parts).alias("part", "rings"))
    return found.select("name", "part", F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))).alias("rings"))


def geojson_shapes(spark: SparkSession, folder: str) -> dict[str, dict]:
    """name -> geometry of all features of the GeoJSON files of a folder: a dictionary of places."""
    rows = spark.read.text(folder, wholetext=True).collect()
    out = {}
    for row in rows:
        whole = json.loads(row.value)
        for collection in whole if isinstance(whole, list) else [whole]:
            for feature in collection["features"]:
                out[feature["properties"]["name"]] = feature["geometry"]
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that it names."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
