"""Regions of points by polygon: a grid cover, an equi-join on cells, the exact test at borders only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Cells that one polygon's bounding box may have; a finer grid than that is refused.
MOST_CELLS = 1_000_000


def edges(ring: Column) -> Column:
    """Edges (x1, y1, x2, y2) of a ring of (lon, lat), closed or not."""
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(
        a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
    ))


def _crosses(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a ray to the right crosses the edge; an edge with a missing end is not crossed."""
    across = (e["y1"] > lat) != (e["y2"] > lat)
    found = across & (lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / F.when(across, e["y2"] - e["y1"]) + e["x1"])
    return F.coalesce(found, F.lit(False))


def inside(lon: Column, lat: Column, sides: Column) -> Column:
    """Whether a ray to the right crosses an odd number of edges. An edge holds its lower end and
    not its upper one, so a point on a shared border belongs to one neighbour only."""
    return F.size(F.filter(sides, lambda e: _crosses(lon, lat, e))) % 2 == 1


def _inside_cell(lon: Column, lat: Column, region: Column) -> Column:
    """As ``inside`` for a point of a border cell, from what the cell carries: the edges that come
    into it, the parity of the others at the height of its middle, and the heights at which that changes."""
    crossed = F.size(F.filter(region["sides"], lambda e: _crosses(lon, lat, e)))
    turned = F.size(F.filter(region["turns"], lambda y: (y > lat) != (y > region["middle"])))
    return ~F.isnan(lon) & ~F.isnan(lat) & ((crossed + turned + region["beyond"]) % 2 == 1)


def cell_of(lon: Column, lat: Column, size: float) -> tuple[Column, Column]:
    return F.floor(lon / size).cast("long"), F.floor(lat / size).cast("long")


def _loose_ends(sides: Column) -> Column:
    """Corners that end one edge only, as the other one misses an end."""
    def whole(e: Column) -> Column:
        return e["x1"].isNotNull() & e["y1"].isNotNull() & e["x2"].isNotNull() & e["y2"].isNotNull()

    following = F.concat(F.slice(sides, 2, F.size(sides)), F.slice(sides, 1, 1))
    corners = F.zip_with(sides, following, lambda e, f: F.when(whole(e) != whole(f), F.struct(e["x2"].alias("x"), e["y2"].alias("y"))))
    return F.filter(corners, lambda v: v.isNotNull())


def covered_cells(polygons: DataFrame, size: float, key: str = "gu") -> DataFrame:
    """cell_x, cell_y and the regions there, by name: whole where no edge comes near, else with edges.

    ``polygons`` has the region and its ring, an array of (lon, lat). A cell that the bounding
    box of an edge touches is a border cell; any other is inside or outside as a whole, as its
    middle is. A region may have several rows (rings); a ring of fewer than three corners
    covers nothing. Cells outside of all rings are left out.

    A border cell carries the edges that come into it, not the ring: an edge is in as many rows
    as cells it passes. Every other edge passes a ray from the cell on one side. ``beyond`` is
    the number of those crossed at the height of the ``middle``, modulo 2; it changes only at
    ``turns``, the corners to the right of the cell where an edge that comes into it goes on as
    one that doesn't.
    """
    sides = edges(F.col("ring"))
    shaped = polygons.where(F.col(key).isNotNull() & (F.size("ring") >= 3)).select(F.col(key).alias("region"), sides.alias("sides"))

    def ends(axis: str, pick) -> Column:
        return pick(F.transform("sides", lambda e: e[axis]))

    low_x, low_y = cell_of(ends("x1", F.array_min), ends("y1", F.array_min), size)
    high_x, high_y = cell_of(ends("x1", F.array_max), ends("y1", F.array_max), size)
    boxed = shaped.withColumns({"low_x": low_x, "low_y": low_y, "high_x": high_x, "high_y": high_y})
    cells = (F.col("high_x") - F.col("low_x") + 1) * (F.col("high_y") - F.col("low_y") + 1)
    checked = boxed.where(F.when(cells <= MOST_CELLS, True).otherwise(
        F.raise_error(F.concat(F.lit("the grid is too fine for region "), F.col("region").cast("string"))).cast("boolean")
    ))
    # cells count as larger by a margin far above rounding, so that sides are never in doubt
    largest = F.array_max(F.transform("sides", lambda e: F.greatest(F.abs(e["x1"]), F.abs(e["y1"]))))
    ringed = checked.withColumns({"margin": F.coalesce(1e-9 * largest, F.lit(0.0)), "loose": _loose_ends(F.col("sides"))})
    left, bottom, margin = F.col("cell_x") * size, F.col("cell_y") * size, F.col("margin")
    west, east, south, north = left - margin, left + size + margin, bottom - margin, bottom + size + margin

    def level(e: Column) -> Column:
        return F.coalesce((F.least(e["y1"], e["y2"]) <= north) & (F.greatest(e["y1"], e["y2"]) >= south), F.lit(True))

    def near(e: Column) -> Column:
        return (
            (F.least(e["x1"], e["x2"]) <= left + size) & (F.greatest(e["x1"], e["x2"]) >= left)
            & (F.least(e["y1"], e["y2"]) <= bottom + size) & (F.greatest(e["y1"], e["y2"]) >= bottom)
        )

    def comes_in(e: Column) -> Column:
        turns = [(e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]) for x in (west, east) for y in (south, north)]
        beside = (F.least(*turns) > 0) | (F.greatest(*turns) < 0)
        return F.coalesce((F.least(e["x1"], e["x2"]) <= east) & (F.greatest(e["x1"], e["x2"]) >= west) & ~beside, F.lit(False))

    rows = ringed.withColumn("cell_y", F.explode(F.sequence("low_y", "high_y"))).withColumn("sides", F.filter("sides", level))
    rows = rows.repartition("region", "cell_y")  # few rings still make many tasks
    told = rows.withColumn("cell_x", F.explode(F.sequence("low_x", "high_x"))).withColumn("border", F.exists("sides", near)).where(
        F.col("border") | inside(left + size / 2, bottom + size / 2, F.col("sides"))
    )
    inner = told.withColumn("inner", F.when(F.col("border"), F.filter("sides", comes_in)))
    middle = bottom + size / 2
    others = F.filter("sides", lambda e: ~comes_in(e) & _crosses(left + size / 2, middle, e))
    corners = F.concat(
        F.transform("inner", lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y"))),
        F.transform("inner", lambda e: F.struct(e["x2"].alias("x"), e["y2"].alias("y"))), F.col("loose"),
    )
    turning = F.filter(corners, lambda v: (v["x"] > east) & (v["y"] >= south) & (v["y"] <= north))
    region = F.struct(
        "region", (~F.col("border")).alias("whole"), F.col("inner").alias("sides"),
        F.when(F.col("border"), F.transform(turning, lambda v: v["y"])).alias("turns"), middle.alias("middle"),
        F.when(F.col("border"), F.size(others) % 2).alias("beyond"),
    )
    return inner.groupBy("cell_x", "cell_y").agg(F.sort_array(F.collect_list(region)).alias("regions"))


def attach_region_by_area(points: DataFrame, polygons: DataFrame, size: float, key: str = "gu") -> DataFrame:
    """Add the region whose polygon holds the point (lon, lat); NULL where none does.

    Points meet only the regions of their own cell, by an equi-join with one row per cell,
    which Spark broadcasts where it measures it small enough and else merges, splitting a
    cell with very many points. Where polygons overlap the smallest name counts. Points with
    a missing coordinate have no region; rows and all other columns stay as they are.
    """
    cover = covered_cells(polygons, size, key)
    cell_x, cell_y = cell_of(F.col("lon"), F.col("lat"), size)
    point, found = "point", "found"
    while {point, found} & set(points.columns):
        point, found = f"_{point}", f"_{found}"
    own = points.select(F.struct(*points.columns).alias(point), cell_x.alias("cell_x"), cell_y.alias("cell_y"))
    met = own.join(cover, ["cell_x", "cell_y"], "left")
    lon, lat = F.col(point)["lon"], F.col(point)["lat"]
    holds = F.filter("regions", lambda r: r["whole"] | F.coalesce(_inside_cell(lon, lat, r), F.lit(False)))
    return met.select(point, F.try_element_at(holds, F.lit(1))["region"].alias(found)).select(f"{point}.*", F.col(found).alias(key))
