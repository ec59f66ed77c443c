"""Which polygons hold a point, by cells of a grid, and the city of a point.

Each polygon is cut into cells. A cell that no edge touches lies wholly inside or outside, so an equality
join on cells settles its points; a border cell carries the edges that cross its row, and ray casting over
these, in column expressions, settles the rest. Everything runs in the JVM. A polygon's parts and
holes are rings whose crossings are counted together, so a point in a hole is outside.

A point on an edge belongs to the side that the crossing rule gives: edges to its right, half open in latitude.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.lookups import SMALL

#: The box outside which a point is foreign.
WEST, EAST, SOUTH, NORTH = 73.5, 135.0, 4.0, 53.5
#: Degrees of a cell, and of the cells that list which centres may be near.
CELL, WIDE = 0.1, 1.0
POLYGONS = "name string, part int, rings array<array<struct<x:double,y:double>>>"


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("int")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """(name, part, x1, y1, x2, y2) of all rings, each closed; edges along a parallel cross no ray and are left out."""
    points = F.transform("ring", lambda p, k: F.struct(p.alias("a"), F.coalesce(F.get("ring", k + 1), F.get("ring", F.lit(0))).alias("b")))
    edges = polygons.select("name", "part", F.explode("rings").alias("ring")).select("name", "part", F.explode(points).alias("e"))
    return edges.select("name", "part", *[F.col(f"e.{end}.{c}").alias(f"{c}{k}") for k, end in ((1, "a"), (2, "b")) for c in "xy"])


def polygon_cells(polygons: DataFrame, size: float = CELL) -> DataFrame:
    """One row per cell: ix, iy, shapes (name, inner, edges). Edges are those of the cell's row, for border cells only."""
    edges = polygon_edges(polygons)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.select("*", F.explode(F.sequence(_cell(low, size), _cell(high, size))).alias("iy"))
    # Where the edge enters and leaves the row of cells.
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")))
    bottom, top = F.greatest(low, F.col("iy") * size), F.least(high, (F.col("iy") + 1) * size)
    flat = F.col("y1") == F.col("y2")
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(at(bottom), at(top)))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(at(bottom), at(top)))
    rows = rows.select("*", (left - 1e-9).alias("left"), (right + 1e-9).alias("right"))
    edge = F.struct("x1", "y1", "x2", "y2")
    strips = rows.groupBy("name", "part", "iy").agg(
        F.collect_list(F.when(~flat, edge)).alias("edges"), F.collect_list(F.struct(_cell(F.col("left"), size).alias("a"), _cell(F.col("right"), size).alias("b"))).alias("touched"),
        F.min(_cell(F.col("left"), size)).alias("first"), F.max(_cell(F.col("right"), size)).alias("last"),
    )
    cells = strips.select("*", F.explode(F.sequence("first", "last")).alias("ix"))
    border = F.exists("touched", lambda t: F.col("ix").between(t["a"], t["b"]))
    middle = holds((F.col("ix") + 0.5) * size, (F.col("iy") + 0.5) * size, F.col("edges"))
    found = cells.select("name", "ix", "iy", "edges", border.alias("border"), middle.alias("middle")).where("border or middle")
    shape = F.struct("name", (~F.col("border")).alias("inner"), F.when(F.col("border"), F.col("edges")).alias("edges"))
    return found.groupBy("ix", "iy").agg(F.collect_list(shape).alias("shapes"))


def holds(x: Column, y: Column, edges: Column) -> Column:
    """Whether a ray to the right of a point crosses an odd number of edges."""
    crossed = F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.size(crossed) % 2 == 1


def with_shapes(points: DataFrame, lng: str, lat: str, polygons: DataFrame, out: str = "shapes", size: float = CELL) -> DataFrame:
    """The points with the names of the polygons that hold them, in order; none gives an empty array."""
    own = "_".join(["_cells", *points.columns])  # longer than any column, so no clash
    cells = polygon_cells(polygons, size).toDF(f"{own}_x", f"{own}_y", own)
    joined = points.join(cells, (_cell(F.col(lng), size) == cells[f"{own}_x"]) & (_cell(F.col(lat), size) == cells[f"{own}_y"]), "left")
    inside = F.filter(own, lambda s: s["inner"] | holds(F.col(lng), F.col(lat), s["edges"]))
    names = F.coalesce(F.array_sort(F.array_distinct(F.transform(inside, lambda s: s["name"]))), F.array().cast("array<string>"))
    return joined.select(*points.columns, names.alias(out))


def near_lists(centres: dict[str, tuple[float, float]], nearest: int, size: float = WIDE) -> list[tuple[int, int, list[tuple]]]:
    """For each wide cell of the box, the centres that can be among the nearest ones of a point in it.

    If the k-th nearest centre of the cell's middle is d away, the k nearest of any of its points are at
    most d and the cell's diagonal away from the middle.
    """
    names = list(centres)
    at = np.array([centres[n] for n in names], float).reshape(-1, 2)
    out = []
    for ix in range(int(WEST // size), int(EAST // size) + 1):
        for iy in range(int(SOUTH // size), int(NORTH // size) + 1):
            away = np.hypot(*(at - ((ix + 0.5) * size, (iy + 0.5) * size)).T)
            reach = np.partition(away, min(nearest, len(away)) - 1)[min(nearest, len(away)) - 1] + size * 2**0.5 + 1e-9
            out.append((ix, iy, [(names[k], k, float(at[k, 0]), float(at[k, 1])) for k in np.flatnonzero(away <= reach).tolist()]))
    return out


def with_city(
    points: DataFrame, lng: str, lat: str, centres: dict[str, tuple[float, float]], polygons: DataFrame, out: str = "city", nearest: int = 3, fallback: str = "nearest", size: float = CELL
) -> DataFrame:
    """The points with their city: of the ``nearest`` centres, in order, the first whose polygon holds the point.

    Points outside the box give ``foreign``; if no polygon holds a point, the ``nearest`` (or the ``last``)
    of these centres is taken. Null coordinates give null. centres: city -> (lng, lat), checked to be a
    small dictionary; its lists by wide cell are broadcast, bounded by the box and that size.
    """
    if len(centres) > SMALL:
        raise ValueError("too many centres for a dictionary")
    known = F.col(lng).isNotNull() & F.col(lat).isNotNull() & ~F.isnan(F.col(lng).cast("double")) & ~F.isnan(F.col(lat).cast("double"))
    within = F.col(lng).between(WEST, EAST) & F.col(lat).between(SOUTH, NORTH)
    if not centres:
        return points.withColumn(out, F.when(known, F.lit("foreign")))
    own = "_".join(["_near", *points.columns])
    lists = points.sparkSession.createDataFrame(near_lists(centres, nearest), "ix int, iy int, near array<struct<name:string,nth:int,x:double,y:double>>").toDF(f"{own}_x", f"{own}_y", own)
    shaped = with_shapes(points, lng, lat, polygons, f"{own}_shapes", size)
    joined = shaped.join(F.broadcast(lists), (_cell(F.col(lng), WIDE) == lists[f"{own}_x"]) & (_cell(F.col(lat), WIDE) == lists[f"{own}_y"]), "left")
    apart = lambda c: (c["x"] - F.col(lng)) * (c["x"] - F.col(lng)) + (c["y"] - F.col(lat)) * (c["y"] - F.col(lat))
    ranked = F.slice(F.array_sort(F.transform(own, lambda c: F.struct(apart(c).alias("away"), c["nth"].alias("nth"), c["name"].alias("name")))), 1, nearest)
    joined = joined.withColumn(f"{own}_ranked", ranked)
    ranked = F.col(f"{own}_ranked")
    held = F.filter(ranked, lambda c: F.array_contains(f"{own}_shapes", c["name"]))
    other = F.element_at(ranked, 1 if fallback == "nearest" else -1)
    city = F.when(~known, F.lit(None).cast("string")).when(~within, "foreign").otherwise(F.coalesce(F.get(held, F.lit(0)), other)["name"])
    return joined.select(*points.columns, city.alias(out))
