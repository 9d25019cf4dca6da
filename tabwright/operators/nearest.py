"""The nearest of many centres, exactly, without comparing every row with every centre."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.geo import haversine_miles
from tabwright.sources.staging import stage

#: More than rounding takes from a distance between points of the unit sphere.
SLACK = 1e-9


def _point(lat: Column, lon: Column) -> list[Column]:
    """A place on the unit sphere: straight distances there rise with those on the ground, also across poles and the date line."""
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def _cells(width: float) -> list[Column]:
    return [F.floor(F.col(axis) / width).cast("long").alias(f"c{axis}") for axis in "xyz"]


def _around(rings: int) -> list[Column]:
    """The cell and those around it, as rows; cells stand in cx, cy, cz."""
    steps = [F.lit(i) for i in range(-rings, rings + 1)]
    boxes = [F.struct(*[(F.col(f"c{axis}") + s).alias(f"n{axis}") for axis, s in zip("xyz", at)]) for at in
             ((a, b, c) for a in steps for b in steps for c in steps)]
    return [F.inline(F.array(*boxes))]


def nearest(rows: DataFrame, centres: DataFrame, key: str, centre: str, lat: str = "latitude", lon: str = "longitude",
            centre_lat: str = "latitude", centre_lon: str = "longitude", cell: float | None = None) -> DataFrame:
    """(key, nearest, miles) for every row; of centres equally far, the one of the smallest id.

    Rows and centres lie in cubes of a grid, in levels of which each doubles the width. A cube with rows looks for the finest
    level that has a centre in its own cube or one of those around it. That bounds the distance of its nearest centre, so that
    all that may be nearest to any of its rows lie in the cubes around it two levels up; of these, only centres no farther from the
    middle of the cube than its nearest one and its diameter remain. Only rows of a cube and these centres are compared.

    ``key`` tells rows apart. ``cell`` is the width of the finest cubes in radii of the earth; by default, a centre would
    have sixteen cubes if they were spread evenly. Choose smaller ones where many centres crowd together. Rows and centres without a place take no part; such rows have no nearest centre.
    """
    spots = centres.select(F.col(centre).alias("id"), F.col(centre_lat).cast("double").alias("to_lat"), F.col(centre_lon).cast("double").alias("to_lon"))
    spots = stage(spots.dropna().withColumns(dict(zip("xyz", _point(F.col("to_lat"), F.col("to_lon"))))))
    placed = rows.select(F.col(key).alias("key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    placed = placed.withColumns(dict(zip("xyz", _point(F.col("lat"), F.col("lon")))))
    width = cell or max(1e-6, math.sqrt(4 * math.pi / max(spots.count(), 1)) / 4)
    levels = max(1, math.ceil(math.log2(2 / width)) + 2)
    known = stage(placed.where("lat IS NOT NULL AND lon IS NOT NULL").select("key", "lat", "lon", *_cells(width)))
    boxes = stage(known.select("cx", "cy", "cz").distinct())

    def at_level(df: DataFrame) -> DataFrame:
        """Each cube's own number on every level."""
        wider = [F.floor(F.col(f"c{axis}") / F.pow(F.lit(2.0), F.col("level"))).cast("long").alias(f"c{axis}") for axis in "xyz"]
        rest = [c for c in df.columns if c not in ("cx", "cy", "cz")]
        return df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels + 1)))).select("level", *rest, *wider)

    taken = stage(at_level(spots.select("id", "to_lat", "to_lon", "x", "y", "z", *_cells(width))).withColumnsRenamed({f"c{a}": f"n{a}" for a in "xyz"}))
    occupied = taken.select("level", "nx", "ny", "nz").distinct()
    numbered = boxes.select(F.struct("cx", "cy", "cz").alias("box"), "cx", "cy", "cz")
    looking = at_level(numbered).where(F.col("level") < levels).select("level", "box", *_around(1))
    found = looking.join(occupied, ["level", "nx", "ny", "nz"], "left_semi").groupBy("box").agg((F.min("level") + 2).alias("level"))
    wider = [F.floor(F.col("box")[f"c{axis}"] / F.pow(F.lit(2.0), F.col("level"))).cast("long").alias(f"c{axis}") for axis in "xyz"]
    candidates = found.select("box", "level", *wider).select("box", "level", *_around(1)).join(taken, ["level", "nx", "ny", "nz"])
    away = [F.pow((F.col("box")[f"c{axis}"] + 0.5) * width - F.col(axis), 2) for axis in "xyz"]
    candidates = stage(candidates.select("box", "id", "to_lat", "to_lon", F.sqrt(away[0] + away[1] + away[2]).alias("away")))
    least = candidates.groupBy("box").agg(F.min("away").alias("least"))
    near = candidates.join(least, "box").where(F.col("away") <= F.col("least") + width * math.sqrt(3) + SLACK)
    near = stage(near.select("box.cx", "box.cy", "box.cz", "id", "to_lat", "to_lon"))
    compared = known.join(near, ["cx", "cy", "cz"]).select(
        "key", "id", haversine_miles(F.col("lat"), F.col("lon"), F.col("to_lat"), F.col("to_lon")).alias("miles"))
    best = compared.groupBy("key").agg(F.min(F.struct("miles", "id")).alias("best"))
    found_rows = best.select("key", F.col("best.id").alias("nearest"), F.col("best.miles").alias("miles"))
    everything = placed.select("key").join(found_rows, "key", "left")
    return everything.withColumnRenamed("key", key)
