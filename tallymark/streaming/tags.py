"""Rule tags over streams: an extension, as the rules' first phase is stateless and the second is a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.arrays import any_nonzero, positive_map
from tallymark.operators.rules import compile_rules, slot_values, tag_values


def tag_stream(lines: DataFrame, rules: list[str], names: list[str], data: str = "data") -> DataFrame:
    """Each row of a stream with a map of its positive tags; rows without one go."""
    compiled = compile_rules(rules)
    tags = tag_values(compiled, F.col("_slots"))
    return lines.withColumn("_slots", slot_values(compiled, F.col(data))).withColumn("_tags", tags).where(any_nonzero(F.col("_tags"))).withColumn("tags", positive_map(names, F.col("_tags"))).drop("_slots", "_tags")


def tag_windows(lines: DataFrame, rules: list[str], names: list[str], user: str = "userid", time: str = "time", data: str = "data", window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(window, user, tags): tags of each user's slots summed over a window, behind a watermark."""
    compiled = compile_rules(rules)
    scored = lines.withWatermark(time, late).select(F.col(time), F.col(user), slot_values(compiled, F.col(data)).alias("s"))
    summed = scored.groupBy(F.window(time, window).alias("window"), user).agg(*[F.sum(F.col("s")[k]).cast("int").alias(f"_{k}") for k in range(len(compiled.slots))])
    slots = F.array(*[F.col(f"_{k}") for k in range(len(compiled.slots))])
    tagged = summed.withColumn("_tags", tag_values(compiled, slots)).where(any_nonzero(F.col("_tags")))
    return tagged.select("window", user, positive_map(names, F.col("_tags")).alias("tags"))
