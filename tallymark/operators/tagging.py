"""Tagging rows and users by rules: as functions over frames and as ML transformers."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.arrays import any_nonzero, positive_map, strict_argmax, sum_arrays
from tallymark.operators.rules import RuleSet, compile_rules, once, tag_values, with_slots


def _scored(frame: DataFrame, rules: RuleSet, data: str, apps: str, matcher: str) -> DataFrame:
    """The frame with its slots, from whichever of the two columns it has."""
    return with_slots(frame, rules, data if data in frame.columns else None, apps if apps in frame.columns else None, matcher=matcher)


def with_tags(frame: DataFrame, rules: list[str], data: str = "data", apps: str = "apps", tags: str = "tags", scores: str | None = "scores", matcher: str = "auto") -> DataFrame:
    """The frame with its rows' tags and, unless scores is None, their slots."""
    compiled = compile_rules(rules)
    scored = once(_scored(frame, compiled, data, apps, matcher).drop(tags), tags, tag_values(compiled, F.col("_slots")))
    return scored.withColumn(scores, F.col("_slots")).drop("_slots") if scores else scored.drop("_slots")


def with_label(frame: DataFrame, rules: list[str], data: str = "data", apps: str = "apps", tags: str = "tags", label: str = "label", matcher: str = "auto") -> DataFrame:
    """The rows of which one rule scores strictly highest, with tags and that rule's index as label."""
    if len(rules) < 2:
        raise ValueError("a label needs two rules at least")
    tagged = with_tags(frame, rules, data, apps, tags, None, matcher)
    return once(tagged.drop(label), label, strict_argmax(F.col(tags))).where(F.col(label).isNotNull())


def row_tags(frame: DataFrame, rules: list[str], user: str = "userid", date: str = "date", **options) -> DataFrame:
    """(user, tags, date) of the rows with any tag."""
    return with_tags(frame, rules, scores=None, **options).select(user, "tags", date).where(any_nonzero(F.col("tags")))


def row_tag_map(frame: DataFrame, rules: list[str], names: list[str], user: str = "userid", date: str = "date", **options) -> DataFrame:
    """(user, tags as a map of the positive scores, date) of the rows with any tag."""
    return row_tags(frame, rules, user, date, **options).withColumn("tags", positive_map(names, F.col("tags"))).select(user, "tags", date)


def sub_scores(frame: DataFrame, rules: list[str], user: str = "userid", data: str = "data", apps: str = "apps", as_vector: bool = False, matcher: str = "auto") -> DataFrame:
    """Phase one: (user, sub_scores) of the rows with any slot."""
    scored = _scored(frame, compile_rules(rules), data, apps, matcher).select(user, F.col("_slots").alias("sub_scores")).where(any_nonzero(F.col("sub_scores")))
    return scored.withColumn("sub_scores", array_to_vector(F.col("sub_scores").cast("array<double>"))) if as_vector else scored


def user_tags(scores: DataFrame, rules: list[str], user: str = "userid") -> DataFrame:
    """Phase two: (user, sub_scores, tags) of the users with any tag, from rows of phase one."""
    compiled = compile_rules(rules)
    if scores.schema["sub_scores"].dataType.typeName() != "array":
        scores = scores.withColumn("sub_scores", vector_to_array("sub_scores").cast("array<int>"))
    summed = sum_arrays(scores, user, "sub_scores", len(compiled.slots))
    return once(summed, "tags", tag_values(compiled, F.col("sub_scores"))).where(any_nonzero(F.col("tags")))


def tag_map(tagged: DataFrame, names: list[str], tags: str = "tags") -> DataFrame:
    """The frame with its tags array as a map of the positive scores."""
    return tagged.withColumn(tags, positive_map(names, F.col(tags)))


class _RuleParams(Params):
    tagRules = Param(Params._dummy(), "tagRules", "rules, one for each tag", TypeConverters.toListString)
    dataCol = Param(Params._dummy(), "dataCol", "packed lines", TypeConverters.toString)
    appsCol = Param(Params._dummy(), "appsCol", "packed app records", TypeConverters.toString)
    tagsCol = Param(Params._dummy(), "tagsCol", "tags, as written", TypeConverters.toString)
    matcher = Param(Params._dummy(), "matcher", "native, arrow or auto", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(dataCol="data", appsCol="apps", tagsCol="tags", matcher="auto")

    def _options(self) -> dict:
        return {"data": self.getOrDefault(self.dataCol), "apps": self.getOrDefault(self.appsCol), "matcher": self.getOrDefault(self.matcher)}

    def _rules(self) -> list[str]:
        return self.getOrDefault(self.tagRules)


class LabelExtractor(Transformer, _RuleParams, DefaultParamsReadable, DefaultParamsWritable):
    """with_label as a pipeline stage."""

    labelCol = Param(Params._dummy(), "labelCol", "label, as written", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, tagRules=None, dataCol="data", appsCol="apps", tagsCol="tags", matcher="auto", labelCol="label"):
        super().__init__()
        self._setDefault(labelCol="label")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_label(dataset, self._rules(), tags=self.getOrDefault(self.tagsCol), label=self.getOrDefault(self.labelCol), **self._options())


class TagExtractor(Transformer, _RuleParams, DefaultParamsReadable, DefaultParamsWritable):
    """with_tags as a pipeline stage."""

    scoresCol = Param(Params._dummy(), "scoresCol", "slots, as written", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, tagRules=None, dataCol="data", appsCol="apps", tagsCol="tags", matcher="auto", scoresCol="scores"):
        super().__init__()
        self._setDefault(scoresCol="scores")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_tags(dataset, self._rules(), tags=self.getOrDefault(self.tagsCol), scores=self.getOrDefault(self.scoresCol), **self._options())


class UserTagger(Transformer, _RuleParams, DefaultParamsReadable, DefaultParamsWritable):
    """row_tags as a pipeline stage, with the two-phase path as methods."""

    userCol = Param(Params._dummy(), "userCol", "user", TypeConverters.toString)
    dateCol = Param(Params._dummy(), "dateCol", "date", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, tagRules=None, dataCol="data", appsCol="apps", tagsCol="tags", matcher="auto", userCol="userid", dateCol="date"):
        super().__init__()
        self._setDefault(userCol="userid", dateCol="date")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return row_tags(dataset, self._rules(), self.getOrDefault(self.userCol), self.getOrDefault(self.dateCol), **self._options())

    def tag_directly(self, dataset: DataFrame, names: list[str]) -> DataFrame:
        return row_tag_map(dataset, self._rules(), names, self.getOrDefault(self.userCol), self.getOrDefault(self.dateCol), **self._options())

    def sub_scores(self, dataset: DataFrame, as_vector: bool = False) -> DataFrame:
        return sub_scores(dataset, self._rules(), self.getOrDefault(self.userCol), as_vector=as_vector, **self._options())

    def tag_users(self, scores: DataFrame) -> DataFrame:
        return user_tags(scores, self._rules(), self.getOrDefault(self.userCol))

    def tags_to_map(self, tagged: DataFrame, names: list[str]) -> DataFrame:
        return tag_map(tagged, names, self.getOrDefault(self.tagsCol))
