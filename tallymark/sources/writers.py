"""Writers of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.ids import to_long_form


def orc(frame: DataFrame, path: str, files: int | None = None, rows_per_file: int | None = None) -> None:
    """Overwrite as ORC; ``files`` fixes the number of files by a shuffle, ``rows_per_file`` bounds them without one."""
    writer = (frame.repartition(files) if files else frame).write.mode("overwrite")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).orc(path)


def parquet(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def text(frame: DataFrame, column: str, path: str) -> None:
    """The distinct values of a column, one a line."""
    frame.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().write.mode("overwrite").text(path)


def long_form(frame: DataFrame, key: str, path: str, family: str = "t") -> None:
    """The frame as cells (rowkey, cf, qualifier, value) for a key-value store's bulk load."""
    to_long_form(frame, key, family).write.mode("overwrite").parquet(path)


def lines(frame: DataFrame, column: str, path: str, most: int = 1_000_000) -> int:
    """A column as a local text file, in the frame's order; more than ``most`` rows are an error."""
    rows = frame.select(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} lines for a local file")
    with open(path, "w", encoding="utf8") as file:
        file.writelines(f"{r[0]}\n" for r in rows)
    return len(rows)


def above(frame: DataFrame, threshold: float | None, probability: str = "prob") -> DataFrame:
    """The rows above a threshold; None keeps all, and 0.0 is a threshold."""
    return frame if threshold is None else frame.where(F.col(probability) > threshold)
