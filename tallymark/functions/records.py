"""Parsers of packed behaviour lines, app records, geo records and video lists.

A malformed part gives null (or is skipped, where the result is an array); null in gives null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_line(line: Column) -> Column:
    """``app:time:corpus[:flag]`` as struct(app, corpus, is_query): the corpus may hold colons.

    A trailing ``:1`` makes a query; it and a trailing ``:0`` are no part of the corpus. A line with
    fewer than two colons has an empty corpus.
    """
    head = F.substring_index(line, ":", 2)  # the whole line if it has no second colon
    rest = F.substring(line, F.length(head) + 2, F.length(line))
    flagged = rest.endswith(":0") | rest.endswith(":1")
    return F.struct(
        F.substring_index(line, ":", 1).alias("app"),
        F.when(flagged, F.substring(rest, F.lit(1), F.length(rest) - 2)).otherwise(rest).alias("corpus"),
        (flagged & rest.endswith(":1")).alias("is_query"),
    )


def rule_lines(data: Column) -> Column:
    """Every non-null line parsed; a null array is an empty one."""
    return F.transform(F.filter(F.coalesce(data, F.array().cast("array<string>")), lambda x: x.isNotNull()), rule_line)


def feature_line(line: Column) -> Column:
    """``app:time:corpus[:flag]`` by position: corpus is the third field only; null with fewer than three."""
    part = F.split(line, ":", 4)
    return F.when(F.size(part) >= 3, F.struct(part[0].alias("app"), part[2].alias("corpus"), (F.coalesce(F.try_element_at(part, F.lit(4)), F.lit("")) == "1").alias("is_query")))


def app_record(record: Column, layout: str = "rule") -> Column:
    """An app record as struct(app, freq, dur, is_sys): ``rule`` is app:freq:dur:is_sys, ``feature`` app:is_sys:freq:dur:extra.

    A number that is missing or malformed is null.
    """
    part = F.split(record, ":", -1)
    place = {"rule": {"freq": 2, "dur": 3, "is_sys": 4}, "feature": {"is_sys": 2, "freq": 3, "dur": 4}}[layout]
    field = lambda name: F.try_element_at(part, F.lit(place[name]))
    return F.struct(part[0].alias("app"), field("freq").try_cast("int").alias("freq"), field("dur").try_cast("double").alias("dur"), field("is_sys").try_cast("int").alias("is_sys"))


def app_records(records: Column, layout: str = "rule") -> Column:
    """Every non-null record parsed; a null array is an empty one."""
    return F.transform(F.filter(F.coalesce(records, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: app_record(x, layout))


def geo_record(record: Column) -> Column:
    """``tag:lng,lat`` as struct(tag, lng, lat), null unless both numbers parse."""
    place = F.split(F.substring_index(record, ":", -1), ",")
    lng, lat = (F.try_element_at(place, F.lit(k)).try_cast("double") for k in (1, 2))
    return F.when(lng.isNotNull() & lat.isNotNull(), F.struct(F.substring_index(record, ":", 1).alias("tag"), lng.alias("lng"), lat.alias("lat")))


def first_geo(geo: Column) -> Column:
    """The first record of an array that parses."""
    return F.try_element_at(F.filter(F.transform(geo, geo_record), lambda x: x.isNotNull()), F.lit(1))


def impressions(videos: Column) -> Column:
    """``vid:aid:label,...`` as array of struct(vid, aid, label); malformed entries are skipped."""

    def one(entry: Column) -> Column:
        part = F.split(entry, ":")
        number = lambda k: F.try_element_at(part, F.lit(k)).try_cast("long")
        return F.struct(number(1).alias("vid"), number(2).alias("aid"), number(3).alias("label"))

    return F.filter(F.transform(F.split(videos, ","), one), lambda x: x["vid"].isNotNull() & x["aid"].isNotNull() & x["label"].isNotNull())
