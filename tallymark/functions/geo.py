"""Datum conversion, distances and boxes as column arithmetic. Null in gives null out."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Radius of the sphere, axis and eccentricity of the ellipsoid, and the projection's bands
# (lower border of each, then its ten coefficients).
RADIUS = 6370996.81
AXIS = 6378245.0
ECCENTRICITY = 0.00669342162296594323
BANDS = (12890594.86, 8362377.87, 5591021.0, 3481989.83, 1678043.12, 0.0)
COEFFICIENTS = (
    (1.410526172116255e-8, 0.00000898305509648872, -1.9939833816331, 200.9824383106796, -187.2403703815547, 91.6087516669843, -23.38765649603339, 2.57121317296198, -0.03801003308653, 17337981.2),
    (-7.435856389565537e-9, 0.000008983055097726239, -0.78625201886289, 96.32687599759846, -1.85204757529826, -59.36935905485877, 47.40033549296737, -16.50741931063887, 2.28786674699375, 10260144.86),
    (-3.030883460898826e-8, 0.00000898305509983578, 0.30071316287616, 59.74293618442277, 7.357984074871, -25.38371002664745, 13.45380521110908, -3.29883767235584, 0.32710905363475, 6856817.37),
    (-1.981981304930552e-8, 0.000008983055099779535, 0.03278182852591, 40.31678527705744, 0.65659298677277, -4.44255534477492, 0.85341911805263, 0.12923347998204, -0.04625736007561, 4482777.06),
    (3.09191371068437e-9, 0.000008983055096812155, 0.00006995724062, 23.10934304144901, -0.00023663490511, -0.6321817810242, -0.00663494467273, 0.03430082397953, -0.00466043876332, 2555164.4),
    (2.890871144776878e-9, 0.000008983055095805407, -3.068298e-8, 7.47137025468032, -0.00000353937994, -0.02145144861037, -0.00001234426596, 0.00010322952773, -0.00000323890364, 826088.5),
)
#: Series of the inland shift, as (amplitude, multiplier and divisor of the angle).
SHIFT_COMMON = ((20.0, 6.0, 1.0), (20.0, 2.0, 1.0))
SHIFT_LAT = ((20.0, 1.0, 1.0), (40.0, 1.0, 3.0), (160.0, 1.0, 12.0), (320.0, 1.0, 30.0))
SHIFT_LNG = ((20.0, 1.0, 1.0), (40.0, 1.0, 3.0), (150.0, 1.0, 12.0), (300.0, 1.0, 30.0))

Point = tuple[Column, Column]


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * x + F.lit(c)
    return total


def mercator_to_bd09(x: Column, y: Column) -> Point:
    """Projected metres to BD-09 degrees, rounded to 6 places. Signs are dropped: the projection's use is north and east."""
    x, y = F.abs(x.cast("double")), F.abs(y.cast("double"))
    lng = lat = None
    for low, c in zip(BANDS, COEFFICIENTS, strict=True):
        own_lng, own_lat = F.lit(c[0]) + F.lit(c[1]) * x, _polynomial(y / F.lit(c[9]), c[2:9])
        lng = F.when(y >= low, own_lng) if lng is None else lng.when(y >= low, own_lng)
        lat = F.when(y >= low, own_lat) if lat is None else lat.when(y >= low, own_lat)
    return F.bround(lng, 6), F.bround(lat, 6)


def bd09_to_gcj02(lng: Column, lat: Column) -> Point:
    turn = math.pi * 3000.0 / 180.0
    x, y = lng - 0.0065, lat - 0.006
    z = F.sqrt(x * x + y * y) - 0.00002 * F.sin(y * turn)
    theta = F.atan2(y, x) - 0.000003 * F.cos(x * turn)
    return z * F.cos(theta), z * F.sin(theta)


def mercator_to_gcj02(x: Column, y: Column) -> Point:
    return bd09_to_gcj02(*mercator_to_bd09(x, y))


def out_of_china(lng: Column, lat: Column) -> Column:
    """True on and outside the borders of the box in which coordinates are shifted."""
    return ~((lng > 73.66) & (lng < 135.05) & (lat > 3.86) & (lat < 53.55))


def _series(angle: Column, terms: tuple) -> Column:
    total = F.lit(0.0)
    for amplitude, multiplier, divisor in terms:
        total = total + amplitude * F.sin(angle * (multiplier * math.pi / divisor))
    return total * (2.0 / 3.0)


def _shift(lng: Column, lat: Column) -> Point:
    """The shift's two series, in metres before scaling."""
    common, root = _series(lng, SHIFT_COMMON), F.sqrt(F.abs(lng))
    d_lng = 300.0 + lng + 2.0 * lat + 0.1 * lng * lng + 0.1 * lng * lat + 0.1 * root + common + _series(lng, SHIFT_LNG)
    d_lat = -100.0 + 2.0 * lng + 3.0 * lat + 0.2 * lat * lat + 0.1 * lng * lat + 0.2 * root + common + _series(lat, SHIFT_LAT)
    return d_lng, d_lat


def gcj02_to_wgs84(lng: Column, lat: Column) -> Point:
    """One inverse step inside the box, as it is outside."""
    d_lng, d_lat = _shift(lng - 105.0, lat - 35.0)
    angle = F.radians(lat)
    w = 1.0 - ECCENTRICITY * F.sin(angle) * F.sin(angle)
    meridian = F.lit(AXIS * (1 - ECCENTRICITY)) / (w * F.sqrt(w))
    parallel = F.lit(AXIS) / F.sqrt(w) * F.cos(angle)
    outside = out_of_china(lng, lat)
    return F.when(outside, lng).otherwise(lng - F.degrees(d_lng / parallel)), F.when(outside, lat).otherwise(lat - F.degrees(d_lat / meridian))


def bd09_to_wgs84(lng: Column, lat: Column) -> Point:
    return gcj02_to_wgs84(*bd09_to_gcj02(lng, lat))


def mercator_to_wgs84(x: Column, y: Column) -> Point:
    return bd09_to_wgs84(*mercator_to_bd09(x, y))


def convert(frame: DataFrame, *steps: Callable[[Column, Column], Point], lng: str = "lng", lat: str = "lat") -> DataFrame:
    """The frame with its point converted, each step in a projection of its own.

    A step uses its input many times, so steps in one expression would multiply its size.
    """
    for step in steps:
        x, y = step(F.col(lng), F.col(lat))
        frame = frame.withColumns({lng: x, lat: y})
    return frame


def haversine(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Metres between two points on the sphere."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a - b) / 2), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lng1) - F.radians(lng2)) / 2), F.lit(2))
    return 2 * RADIUS * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bounds(lng: Column, lat: Column, metres: float) -> Column:
    """struct(lng_min, lng_max, lat_min, lat_max) of the box around a circle."""
    half = math.sin(metres / 2 / RADIUS)
    d_lng = F.degrees(2 * F.asin(F.lit(half) / F.cos(F.radians(lat))))
    d_lat = math.degrees(math.asin(2 * half))
    return F.struct((lng - d_lng).alias("lng_min"), (lng + d_lng).alias("lng_max"), (lat - d_lat).alias("lat_min"), (lat + d_lat).alias("lat_max"))


def degrees_of(metres: float) -> float:
    """The degrees of latitude of a distance."""
    return math.degrees(math.asin(2 * math.sin(metres / 2 / RADIUS)))


def plane_point(lng: Column, lat: Column, metres: float = 1000.0, places: int = 5) -> Point:
    """Latitude rounded, and longitude scaled so that a degree of either is as long at that latitude."""
    lat = F.bround(lat, places)
    half = math.sin(metres / 2 / RADIUS)
    d_lng = 2 * F.degrees(F.asin(F.lit(half) / F.cos(F.radians(lat))))
    return F.bround(lng * (F.lit(degrees_of(metres)) / d_lng), places), lat


def poi_row(name: Column, x: Column, y: Column, alias: Column, std_tag: Column, separator: str = ";") -> Column:
    """A place of the map service as a CSV line: name, its coordinates in three datums, joined aliases, tag.

    x and y are hundredths of projected metres. Null aliases and tag are empty; a null name or coordinate gives null.
    """
    # Each step's result is bound to a lambda's argument, as the next one names it many times over.
    bound = lambda pair, then: F.transform(F.array(F.struct(pair[0].alias("x"), pair[1].alias("y"))), then)[0]
    text = lambda *values: F.array(*[v.cast("string") for v in values])
    wgs = lambda bd, gcj: bound(gcj02_to_wgs84(gcj.x, gcj.y), lambda w: text(bd.x, bd.y, gcj.x, gcj.y, w.x, w.y))
    numbers = bound((x, y), lambda m: bound(mercator_to_bd09(m.x / 100, m.y / 100), lambda bd: bound(bd09_to_gcj02(bd.x, bd.y), lambda gcj: wgs(bd, gcj))))
    aliases = F.array_join(F.coalesce(alias, F.array().cast("array<string>")), separator)
    return F.when(name.isNotNull() & x.isNotNull() & y.isNotNull(), F.concat_ws(",", name, F.array_join(numbers, ",", ""), aliases, F.coalesce(std_tag, F.lit(""))))
