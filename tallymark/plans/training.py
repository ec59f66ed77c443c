"""The training and daily prediction job: sample, balance, join apps, encode, fit, predict, save."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.features import LineEncoder
from tallymark.operators.samples import balanced, hash_split, last_days, merge_then_label, public_version
from tallymark.plans.paths import JobPaths
from tallymark.sources import readers, writers

_VECTORS = [T.StructField(k, VectorUDT()) for k in ("applist", "appfreq", "appdur", "appsys")]
_ENCODED = [T.StructField("userid", T.StringType()), T.StructField("data", T.ArrayType(T.LongType())), *_VECTORS]
TRAINING = T.StructType([*_ENCODED[:1], T.StructField("label", T.DoubleType()), *_ENCODED[1:]])
CONVERTED = T.StructType([*_ENCODED, T.StructField("date", T.StringType())])


class TrainingJob:
    """lines: (userid, data, fr, date); apps: (userid, applist, date). Each step's table is written and read again."""

    def __init__(self, spark: SparkSession, paths: JobPaths, lines: DataFrame, apps: DataFrame, encoder: LineEncoder, days: int = 7, limit: int = 1000, only_public: bool = False):
        self.spark, self.paths, self.encoder, self.days, self.limit, self.only_public = spark, paths, encoder, days, limit, only_public
        self.lines, self.apps = lines, apps

    def window(self, frame: DataFrame, end: str) -> DataFrame:
        frame = frame.where(last_days(F.col("date"), end, self.days))
        return frame.where(public_version(F.col("fr"))) if self.only_public and "fr" in frame.columns else frame

    def latest_apps(self, end: str) -> DataFrame:
        return self.window(self.apps, end).groupBy("userid").agg(F.max_by("applist", F.struct("date", "applist")).alias("applist"))

    def sample_corpus(self, rules: list[str]) -> None:
        merged = merge_then_label(self.window(self.lines, self.paths.sample_date), rules, limit=self.limit)
        writers.orc(merged.select("userid", "data", "label"), self.paths.sample("corpus"))

    def sample_balance(self, source: str, target: str, count: int = 100_000) -> None:
        writers.orc(balanced(readers.orc(self.spark, source), count), target)

    def sample_apps(self) -> None:
        corpus = readers.orc(self.spark, self.paths.sample("corpus_balance"))
        writers.orc(self.latest_apps(self.paths.sample_date).join(corpus, "userid"), self.paths.sample("applist"))

    def sample(self, rules: list[str], first: int = 1_000_000, second: int = 200_000) -> None:
        self.sample_corpus(rules)
        self.sample_balance(self.paths.sample("corpus"), self.paths.sample("corpus_balance"), first)
        self.sample_apps()
        self.sample_balance(self.paths.sample("applist"), self.paths.sample("applist_balance"), second)

    def train_convert(self) -> None:
        encoded = self.encoder.transform(readers.orc(self.spark, self.paths.sample("applist_balance"))).select(*TRAINING.fieldNames())
        for kind, part in zip(("train", "test"), hash_split(encoded, "userid"), strict=True):
            writers.orc(part, self.paths.sample(kind))

    def train_df(self) -> DataFrame:
        return readers.orc(self.spark, self.paths.sample("train"), TRAINING)

    def test_df(self) -> DataFrame:
        return readers.orc(self.spark, self.paths.sample("test"), TRAINING)

    def run_convert(self, overwrite: bool = True) -> None:
        """Merge lines and apps of the prediction's window, full outer by user, and encode; skipped if it is there and not to be overwritten."""
        if not overwrite and readers.exists(self.spark, self.paths.converted):
            return
        from tallymark.operators.arrays import latest_merge

        end = self.paths.predict_date
        lines = latest_merge(self.window(self.lines, end).select("userid", "data", "date"), "userid", "date", "data", self.limit)
        both = lines.select("userid", "data").join(self.latest_apps(end), "userid", "full")
        writers.orc(self.encoder.transform(both).withColumn("date", F.lit(end)).select(*CONVERTED.fieldNames()), self.paths.converted)

    def run_predict(self, load: Callable[[str], Model], rows_per_file: int = 1_000_000) -> None:
        predicted = load(self.paths.model).transform(readers.orc(self.spark, self.paths.converted, CONVERTED))
        writers.orc(predicted.select("userid", "prediction", "prob"), self.paths.result, rows_per_file=rows_per_file)

    def run_save(self, path: str, threshold: float | None = None) -> None:
        writers.long_form(writers.above(readers.orc(self.spark, self.paths.result), threshold), "userid", path)

    def run(self, predict_date: str, load: Callable[[str], Model], path: str, threshold: float | None = None) -> None:
        self.paths = self.paths.on(predict_date)
        self.run_convert(overwrite=False)
        self.run_predict(load)
        self.run_save(path, threshold)
