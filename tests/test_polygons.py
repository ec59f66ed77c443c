import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators.lookups import city_of, in_polygon
from tallymark.operators.polygons import POLYGONS, polygon_cells, with_city, with_shapes
from tallymark.sources.readers import geojson_polygons


def star(draw, x, y, r, n):
    """A ring with corners at growing angles."""
    turns = sorted(draw.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + (q := draw.uniform(r / 3, r)) * math.cos(t), y + q * math.sin(t)) for t in turns]


@pytest.fixture(scope="module")
def shapes():
    draw = random.Random(5)
    out = []
    for k in range(12):
        x, y = draw.uniform(80, 130), draw.uniform(10, 50)
        out.append((f"city{k}", 0, [star(draw, x, y, 4, 9), star(draw, x, y, 0.9, 5)]))  # a hole, or an island where it sticks out
        if k % 3 == 0:
            out.append((f"city{k}", 1, [star(draw, x + 5, y, 1, 30)]))
    out.append(("square", 0, [[(100.0, 20.0), (101.0, 20.0), (101.0, 21.0), (100.0, 21.0), (100.0, 20.0)]]))
    out.append(("tiny", 0, [[(110.01, 30.01), (110.02, 30.01), (110.015, 30.02)]]))
    return out


@pytest.fixture(scope="module")
def points(shapes):
    draw = random.Random(6)
    near = [(x + draw.uniform(-4, 4), y + draw.uniform(-4, 4)) for *_, rings in shapes for x, y in rings[0] for _ in range(6)]
    corners = [p for *_, rings in shapes for p in rings[0][:2]]
    return [*near, *corners, *[(draw.uniform(70, 140), draw.uniform(0, 60)) for _ in range(300)], (100.5, 20.5), (110.015, 30.013), (100.0, 20.5), (-0.05, -0.05)]


def frames(spark, shapes, points):
    named = [(k, None if x is None else float(x), None if y is None else float(y), 1, 2) for k, (x, y) in enumerate(points)]
    return spark.createDataFrame(named, "id long, lng double, lat double, IX int, shapes_ int"), spark.createDataFrame(shapes, POLYGONS)


@pytest.mark.parametrize("size", [0.1, 0.7, 5.0])
def test_cells_equal_ray_casting(spark, shapes, points, size):
    at, polygons = frames(spark, shapes, points)
    found = {r.id: r.shapes for r in with_shapes(at, "lng", "lat", polygons, size=size).collect()}
    assert found == {k: sorted({n for n, _, rings in shapes if in_polygon(x, y, rings)}) for k, (x, y) in enumerate(points)}


def test_inner_cells_carry_no_edges(spark, shapes):
    cells = polygon_cells(spark.createDataFrame(shapes, POLYGONS)).select(F.inline("shapes")).groupBy("inner").agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("edges")).collect()
    inner = next(r for r in cells if r.inner)
    assert inner.n > 1000 and (inner.edges is None or inner.edges < 0)


@pytest.mark.parametrize("fallback", ["nearest", "last"])
def test_cities_equal_the_plain_search(spark, shapes, points, fallback):
    draw = random.Random(7)
    centres = {n: (rings[0][0][0] + draw.uniform(-3, 3), rings[0][0][1]) for n, part, rings in shapes if part == 0}
    geometry = {}
    for n, _, rings in shapes:
        geometry.setdefault(n, {"type": "MultiPolygon", "coordinates": []})["coordinates"].append(rings)
    at, polygons = frames(spark, shapes, [*points, (None, 20.0), (float("nan"), 20.0), (135.0, 53.5), (73.5, 4.0)])
    found = {r.id: r.city for r in with_city(at, "lng", "lat", centres, polygons, fallback=fallback).collect()}
    want = {r.id: r.city for r in at.select("id", city_of(F.col("lng"), F.col("lat"), centres, geometry, fallback=fallback).alias("city")).collect()}
    assert found == want
    plan = with_city(at, "lng", "lat", centres, polygons)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_or_no_centres_and_polygons(spark, shapes, points):
    at, polygons = frames(spark, shapes, points[-3:])
    assert {r.city for r in with_city(at, "lng", "lat", {}, polygons).collect()} == {"foreign"}
    assert [r.city for r in with_city(at, "lng", "lat", {"one": (100.0, 20.0)}, polygons.limit(0)).orderBy("id").collect()] == ["one", "one", "foreign"]
    assert with_city(at.limit(0), "lng", "lat", {"one": (100.0, 20.0)}, polygons).count() == 0


def test_geojson_files(spark, tmp_path):
    ring = [[0, 0], [2, 0.5, 9], [1, 2], [0, 0]]
    feature = lambda name, kind, place: {"type": "Feature", "properties": {"name": name, "more": 1}, "geometry": {"type": kind, "coordinates": place}}
    one = {"type": "FeatureCollection", "features": [feature("a", "Polygon", [ring, ring]), feature("p", "Point", [1, 2])]}
    (tmp_path / "a.json").write_text(json.dumps([one, {"features": [feature("b", "MultiPolygon", [[ring], [ring, ring]])]}]))
    (tmp_path / "b.json").write_text(json.dumps({"features": [feature("c", "Polygon", [ring]), {"properties": {}, "geometry": None}]}))
    found = sorted((r.name, r.part, len(r.rings), tuple(r.rings[0][1])) for r in geojson_polygons(spark, str(tmp_path)).collect())
    assert found == [("a", 0, 2, (2.0, 0.5)), ("b", 0, 1, (2.0, 0.5)), ("b", 1, 2, (2.0, 0.5)), ("c", 0, 1, (2.0, 0.5))]
