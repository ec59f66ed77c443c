"""Lookups that are no equality joins: points near places, points in polygons, numbers in ranges."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.geo import RADIUS, degrees_of, haversine, plane_point
from tallymark.session import ship_active

#: A side is broadcast only if it has at most so many rows, which is checked; else it is shuffled.
SMALL = 100_000


def within_radius(points: DataFrame, places: DataFrame, metres: float, key: str = "aid", lng: str = "lng", lat: str = "lat", metric: str = "plane") -> DataFrame:
    """(key) of the points with a place at most ``metres`` away, each key once.

    metric ``plane`` scales each longitude by its own latitude before measuring in degrees;
    ``haversine`` is the distance on the sphere. Points and places are put into grid cells of that
    size, and a point is compared with the places of its own and the eight cells around it. A cell's
    places are distinct, so a cell with many points costs each of them only the places nearby.
    """
    degrees = degrees_of(metres) if metric == "plane" else math.degrees(metres / RADIUS) * (1 + 1e-9)

    def coordinates(frame: DataFrame) -> tuple[Column, Column]:
        x, y = F.col(lng).cast("double"), F.col(lat).cast("double")
        return plane_point(x, y) if metric == "plane" else (x, y)

    x, y = coordinates(points)
    cell_y = lambda c: F.floor(c / degrees).cast("long")
    mine = points.select(F.col(key), x.alias("px"), y.alias("py")).where("px is not null and py is not null").dropDuplicates()
    px, py = coordinates(places)
    theirs = places.select(px.alias("qx"), py.alias("qy")).where("qx is not null and qy is not null").distinct()
    if metric == "plane":
        around = F.explode(F.array(*[F.struct((F.floor(F.col("qx") / degrees) + a).cast("long").alias("cx"), (cell_y(F.col("qy")) + b).alias("cy")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
        left = mine.withColumn("cx", F.floor(F.col("px") / degrees).cast("long")).withColumn("cy", cell_y(F.col("py")))
        near = F.sqrt(F.pow(F.col("px") - F.col("qx"), F.lit(2)) + F.pow(F.col("py") - F.col("qy"), F.lit(2))) <= degrees
        cells = theirs.withColumn("c", around).select("qx", "qy", "c.cx", "c.cy")
        keys = ["cx", "cy"]
    else:
        # Rows of cells go around the sphere. A row's cells are as wide as the radius reaches in longitude from the
        # row's edge nearer to a pole; a row from which it reaches a pole is one cell. A place is put into the cells
        # around it in each row, by that row's width.
        def column(lng: Column, row: Column, step: int = 0) -> Column:
            edge = F.greatest(F.abs(row), F.abs(row + 1)) * degrees
            reach = F.asin(F.least(F.lit(math.sin(math.radians(min(degrees, 90.0)))) / F.cos(F.radians(edge)), F.lit(1.0)))
            n = F.when(edge + degrees < 90, F.greatest(F.floor(F.lit(2 * math.pi * (1 - 1e-9)) / reach), F.lit(1))).otherwise(1).cast("long")
            return F.pmod(F.floor((lng + 180) * n / 360).cast("long") + step, n)

        rows = theirs.withColumn("cy", F.explode(F.array(*[cell_y(F.col("qy")) + b for b in (-1, 0, 1)])))
        cells = rows.withColumn("cx", F.explode(F.array_distinct(F.array(*[column(F.col("qx"), F.col("cy"), a) for a in (-1, 0, 1)])))).select("qx", "qy", "cx", "cy")
        left = mine.withColumn("cy", cell_y(F.col("py"))).withColumn("cx", column(F.col("px"), F.col("cy")))
        near = haversine(F.col("px"), F.col("py"), F.col("qx"), F.col("qy")) <= metres
        keys = ["cx", "cy"]
    joined = left.alias("l").join(cells.alias("r"), [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys] + [near], "left_semi")
    return joined.select(key).distinct()


def in_polygon(lng: float, lat: float, rings: list[list[tuple[float, float]]]) -> bool:
    """Ray casting over a polygon's rings: a point in a hole is outside."""
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 > lat) != (y2 > lat) and lng < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def _polygons(geometry: dict) -> list[list[list[tuple[float, float]]]]:
    parts = geometry["coordinates"] if geometry["type"] == "MultiPolygon" else [geometry["coordinates"]]
    return [[[(p[0], p[1]) for p in ring] for ring in part] for part in parts]


def city_of(lng: Column, lat: Column, centres: dict[str, tuple[float, float]], shapes: dict[str, dict], nearest: int = 3, fallback: str = "nearest") -> Column:
    """The city of a point: of its ``nearest`` centres, in order, the first whose shape holds it.

    Points outside the box give ``foreign``; if no shape holds a point, the ``nearest`` (or the
    ``last``) of these centres is taken. Null coordinates give null. centres: city -> (lng, lat);
    shapes: city -> GeoJSON geometry. Both are dictionaries of places, checked to be small.
    """
    if len(centres) > SMALL:
        raise ValueError("too many centres for a dictionary")
    names = list(centres)
    at = np.array([centres[n] for n in names], float).reshape(-1, 2)
    polygons = {n: _polygons(g) for n, g in shapes.items()}

    def one(x: float, y: float) -> str | None:
        if np.isnan(x) or np.isnan(y):
            return None
        if not (73.5 <= x <= 135 and 4 <= y <= 53.5) or not names:
            return "foreign"
        order = np.argsort(((at - (x, y)) ** 2).sum(1), kind="stable")[:nearest]
        for k in order:
            if any(in_polygon(x, y, p) for p in polygons.get(names[k], [])):
                return names[k]
        return names[order[0 if fallback == "nearest" else -1]]

    ship_active()

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series([one(x, y) for x, y in zip(xs.astype(float), ys.astype(float), strict=True)], dtype=object)

    return run(lng.cast("double"), lat.cast("double"))


def city_centres(districts: DataFrame) -> DataFrame:
    """(province, city, lng, lat) from nested districts; ``市`` is stripped at both ends, and municipalities are their own city."""
    from tallymark.functions.ip import MUNICIPALITIES

    strip = lambda c: F.regexp_replace(F.regexp_replace(c, "^市+", ""), "市+$", "")
    outer = districts.select(F.explode("districts").alias("p"))
    own = outer.where(F.substring("p.name", 1, 2).isin(*MUNICIPALITIES)).select(F.substring("p.name", 1, 2).alias("province"), F.substring("p.name", 1, 2).alias("city"), F.col("p.center.longitude").alias("lng"), F.col("p.center.latitude").alias("lat"))
    rest = outer.where(~F.substring("p.name", 1, 2).isin(*MUNICIPALITIES)).select(F.col("p.name").alias("province"), F.explode("p.districts").alias("c"))
    return own.unionByName(rest.select("province", strip(F.col("c.name")).alias("city"), F.col("c.center.longitude").alias("lng"), F.col("c.center.latitude").alias("lat")))


#: Buckets from which a range is cut more coarsely.
SPREAD = 1 << 16


def range_lookup(rows: DataFrame, ranges: DataFrame, value: str, begin: str = "ip_begin", end: str = "ip_end", shift: int = 16) -> DataFrame:
    """Left join of each row to the range with the greatest begin at or below its value, if the value is at or below that range's end.

    Ranges are cut into buckets of ``2**shift`` numbers, and rows join the pieces of their own bucket. A range of
    ``SPREAD`` buckets or more is cut into buckets 2**16 times as wide, in a join of its own that only such ranges cause.
    A range counts in a bucket only where no later range begins before it, so ranges may overlap; each
    row meets the few pieces of its bucket and the best is kept by a maximum, not by a sort.
    """
    extra = [c for c in ranges.columns if c not in (begin, end)]
    unique = ranges.where(F.col(begin).isNotNull() & F.col(end).isNotNull()).groupBy(begin).agg(F.max_by(F.struct(end, *extra), F.struct(end, *extra)).alias("_r"))
    # The next range's begin bounds where this one is the greatest at or below a value.
    from pyspark.sql import Window

    part = F.shiftright(F.col(begin), 24)
    within = F.lead(begin).over(Window.partitionBy("_part").orderBy(begin))
    firsts = unique.withColumn("_part", part)
    heads = firsts.groupBy("_part").agg(F.min(begin).alias("_head"))
    following = heads.withColumn("_after", F.lead("_head").over(Window.orderBy("_part"))).select("_part", "_after")
    bounded = firsts.withColumn("_next", within).join(following, "_part").withColumn("_until", F.least(F.col(f"_r.{end}"), F.coalesce(F.col("_next"), F.col("_after"), F.lit((1 << 63) - 1)) - 1))
    bounded = bounded.where(F.col("_until") >= F.col(begin)).select(F.col(begin).alias("_from"), "_until", "_r")
    width, shifts = F.col("_until") - F.col("_from"), [shift]
    widest = bounded.agg(F.max(width)).first()[0] or 0
    while widest >> shifts[-1] >= SPREAD:
        shifts.append(shifts[-1] + 16)
    joined = rows
    for k, s in enumerate(shifts):
        own = bounded.where(F.shiftright(width, s) < SPREAD) if s < shifts[-1] else bounded
        own = own.where(F.shiftright(width, shifts[k - 1]) >= SPREAD) if k else own
        pieces = own.select(F.explode(F.sequence(F.shiftright("_from", s), F.shiftright("_until", s))).alias("_bucket"), "_from", "_until", F.struct(F.col("_from").alias(begin), "_r").alias(f"_hit{k}"))
        match = (F.shiftright(F.col(value), s) == F.col("_bucket")) & F.col(value).between(F.col("_from"), F.col("_until"))
        joined = joined.join(pieces, match, "left").drop("_bucket", "_from", "_until")
    hit = F.coalesce(*[F.col(f"_hit{k}") for k in range(len(shifts))])
    names = [c for c in joined.columns if not c.startswith("_hit")]
    return joined.withColumn("_hit", hit).select(*names, F.col(f"_hit.{begin}").alias(begin), F.col(f"_hit._r.{end}").alias(end), *[F.col(f"_hit._r.{c}").alias(c) for c in extra])


def hash_lookup(rows: DataFrame, entries: DataFrame, key: str, value: str, default: object = None, small: int = SMALL) -> DataFrame:
    """The rows with ``value`` from a dictionary frame by key; missing keys get the default.

    The dictionary is broadcast if a count shows that it has at most ``small`` rows.
    """
    one = entries.groupBy(key).agg(F.max(value).alias(value))
    side = F.broadcast(one) if one.limit(small + 1).count() <= small else one
    joined = rows.join(side, key, "left")
    return joined if default is None else joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def college_places(places: DataFrame) -> DataFrame:
    """Places (search_word, name, std_tag, di_tag, cp) that are colleges.

    First those by their tags, or by the college's name and a tag of a building; only for a search word
    with none of these, those by name at a gate or a bus stop. The college's name is the search word up
    to a tab or a bracket. Nulls count as empty.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    college = F.split(F.trim(F.split(text("search_word"), "\t")[0]), "（")[0]
    std, di, name = text("std_tag"), text("di_tag"), text("name")
    any_of = lambda c, words: F.coalesce(*[F.when(c.contains(w), True) for w in words], F.lit(False))
    # Tags of the map service.
    tagged = std.isin("教育培训;高等院校", "教育培训;成人教育")
    likely = std.isin("教育培训;其他", "教育培训;中学") & (any_of(di, ("大学", "高等院校")) | name.endswith("学院"))
    named = name.contains(college)
    first = tagged | likely | (named & any_of(di, ("宿舍", "食堂", "图书馆", "教学楼")))
    second = named & (di.contains("门") | (text("cp") == "bus"))
    marked = places.withColumn("_first", first).withColumn("_second", second)
    found = marked.groupBy(F.col("search_word").alias("_word")).agg(F.max("_first").alias("_any"))
    joined = marked.join(found, F.col("search_word").eqNullSafe(F.col("_word")))
    return joined.where(F.col("_first") | (~F.col("_any") & F.col("_second"))).select(*places.columns)
