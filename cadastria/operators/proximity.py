"""Points within a radius of sites, through an equi-join on grid cells of two levels.

Rows of cells are as high as the radius; each row is cut into a whole number of cells around the
globe, wide enough at the row's largest latitude, so cells wrap at 180 degrees and a row at a pole is
one cell. Every site is copied to the cells around it and a point looks only into its own cell: each
pair in reach meets exactly once.

A cell with more than its share of the points is cut into quarters, and those again while they hold
more than a share, so a dense town is spread over all tasks; sites are copied to the quarters they
reach only. What is still more than a share in a smallest quarter is dealt to several parts by the
hash of the point's columns, each with the sites. There are fewer dense cells than shares, so the table of
quarters is small whatever the number of points. Points should be distinct: equal rows stay together.

Few points and sites may have very many pairs, so the work is dealt out by pairs, not by the bytes of the two sides:
both are put in as many partitions as pairs in the same cells call for, which Spark then neither merges nor leaves in the
few files of the sites. Sites are dealt out before they are copied, too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K

_M_PER_DEGREE = math.radians(1.0) * K.EARTH_RADIUS_M
_MARGIN = 1.01
#: Times a dense cell may be halved each way; what a smallest quarter holds beyond a share is dealt to parts.
DEPTH = 4
_DEALT = ["_row", "_col", "_level", "_i", "_j", "_part"]
#: Pairs of a point and a site in the same cell, within reach or not, that a task is to meet.
PAIRS_A_TASK = 1 << 21


def cell_row(lat: Column, radius_m: float) -> Column:
    return F.floor(lat / (radius_m / _M_PER_DEGREE * _MARGIN))


def cells_of_row(row: Column, radius_m: float) -> Column:
    """Cells around the globe: a point of the row reaches no further than one cell to either side."""
    height = radius_m / _M_PER_DEGREE * _MARGIN
    far = F.least(F.greatest(F.abs(row * height), F.abs((row + 1) * height)), F.lit(90.0))
    reach = F.lit(math.sin(math.radians(height))) / F.greatest(F.cos(F.radians(far)), F.lit(1e-9))
    return F.when(reach >= 1.0, 1).otherwise(
        F.greatest(F.floor(360.0 / F.degrees(F.asin(reach))), F.lit(1))).cast("long")


def cell_column(lon: Column, row: Column, radius_m: float) -> Column:
    n = cells_of_row(row, radius_m)
    return F.least(F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / 360.0 * n), n - 1)


def _place(lat: Column, lon: Column, radius_m: float) -> dict[str, Column]:
    """Cell of a point and its smallest quarter there."""
    row = cell_row(lat, radius_m)
    col = cell_column(lon, row, radius_m)
    side = 1 << DEPTH
    up = lat / (radius_m / _M_PER_DEGREE * _MARGIN) - row
    along = F.pmod(lon + 180.0, F.lit(360.0)) / 360.0 * cells_of_row(row, radius_m) - col
    quarter = lambda share: F.greatest(F.least(F.floor(share * side), F.lit(side - 1)), F.lit(0)).cast("int")
    return {"_row": row, "_col": col, "_y": quarter(up), "_x": quarter(along)}


def dense_quarters(placed: DataFrame, shares: int) -> DataFrame:
    """(_row, _col, _y, _x, _level, _parts) of the smallest quarters of dense cells that hold points.

    A quarter of level k is a cell halved k times each way; ``_level`` is that of the quarter to use, the first with
    at most one of ``shares`` equal shares of the points. At most ``shares`` x 4^DEPTH rows.
    """
    cell, spot = ["_row", "_col"], ["_y", "_x"]
    smallest = placed.filter(F.col("_row").isNotNull() & F.col("_col").isNotNull()).groupBy(*cell, *spot).agg(
        F.count("*").alias("n"))
    total = smallest.select(F.sum("n")).scalar()
    over = lambda n: n * shares > total
    dense = smallest.groupBy(*cell).agg(F.sum("n").alias("held")).filter(over(F.col("held"))).select(*cell)
    nodes = smallest.join(F.broadcast(dense), cell).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))))
    above = [F.expr(f"shiftright({c}, {DEPTH} - level)") for c in spot]
    held = F.sum("n").over(Window.partitionBy(*cell, "level", *above))
    return nodes.withColumn("held", held).groupBy(*cell, *spot).agg(
        F.least(F.sum(over(F.col("held")).cast("int")), F.lit(DEPTH)).alias("_level"),
        F.greatest(F.max(F.when(F.col("level") == DEPTH, F.ceil(F.col("n") * shares / total))), F.lit(1)).cast("int").alias("_parts"))


def _in_reach(slat: Column, slon: Column, radius_m: float) -> Column:
    """Whether a quarter (``_row``, ``_col``, ``_level``, ``_i``, ``_j``) may hold points within the radius of a site.

    No point of it is nearer than its nearest latitude, nor than its nearest meridian.
    """
    height = radius_m / _M_PER_DEGREE * _MARGIN
    width = 360.0 / cells_of_row(F.col("_row"), radius_m)
    size = F.pow(F.lit(2.0), -F.col("_level"))
    low, west = (F.col("_row") + F.col("_i") * size) * height, (F.col("_col") + F.col("_j") * size) * width - 180.0
    north = F.greatest(low - slat, slat - low - height * size, F.lit(0.0))
    past = F.pmod(slon - west, F.lit(360.0))  # degrees east of its western edge
    aside = F.when(past <= width * size, 0.0).otherwise(F.least(past - width * size, 360.0 - past, F.lit(90.0)))
    across = F.degrees(F.asin(F.cos(F.radians(slat)) * F.sin(F.radians(aside))))
    return F.greatest(north, across) <= height


def within_radius(points: DataFrame, sites: DataFrame, radius_m: float,
                  point_at: tuple[str, str], site_at: tuple[str, str], shares: int | None = None) -> DataFrame:
    """Inner range join, bounds included; adds ``distance_m``. Sites keep their other columns.

    No task gets much more than one of ``shares`` (four for each shuffle partition, or for each task) of the points, nor
    much more than ``PAIRS_A_TASK`` pairs.
    """
    plat, plon = F.col(point_at[0]), F.col(point_at[1])
    slat, slon = F.col(site_at[0]), F.col(site_at[1])
    around = site_cells(sites, radius_m, site_at)
    tasks = max(1, math.ceil(cell_pairs(points, around, radius_m, point_at) / PAIRS_A_TASK))
    shares = max(shares or 4 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * tasks)
    found, quarters = dealt_points(points, radius_m, point_at, shares)
    cells = dealt_sites(around, quarters, radius_m, site_at, tasks)
    return (
        found.repartition(tasks, *_DEALT).join(cells.repartition(tasks, *_DEALT), _DEALT)
        .withColumn("distance_m", C.haversine_m(plat, plon, slat, slon))
        .filter(F.col("distance_m") <= radius_m)
        .drop(*_DEALT)
    )


def site_cells(sites: DataFrame, radius_m: float, at: tuple[str, str]) -> DataFrame:
    """Every site once for each of the 3 x 3 cells around it, fewer where rows have fewer cells."""
    return (
        sites.withColumn("_row0", cell_row(F.col(at[0]), radius_m))
        .withColumn("_row", F.explode(F.sequence(F.col("_row0") - 1, F.col("_row0") + 1)))
        .withColumn("_col0", cell_column(F.col(at[1]), F.col("_row"), radius_m))
        .withColumn("_n", cells_of_row(F.col("_row"), radius_m))
        .withColumn("_col", F.explode(F.array_distinct(F.array(
            *[F.pmod(F.col("_col0") + d, F.col("_n")) for d in (-1, 0, 1)]))))
        .drop("_row0", "_col0", "_n")
    )


def cell_pairs(points: DataFrame, around: DataFrame, radius_m: float, at: tuple[str, str]) -> float:
    """How many pairs of a point and a site meet in a cell; only counts of cells are joined."""
    row = cell_row(F.col(at[0]), radius_m)
    held = points.select(row.alias("_row"), cell_column(F.col(at[1]), row, radius_m).alias("_col")).groupBy("_row", "_col").agg(
        F.count("*").alias("_points"))
    reached = around.groupBy("_row", "_col").agg(F.count("*").alias("_sites"))
    return held.join(reached, ["_row", "_col"]).agg(
        F.sum(F.col("_points").cast("double") * F.col("_sites"))).first()[0] or 0.0


def dealt_points(points: DataFrame, radius_m: float, at: tuple[str, str], shares: int) -> tuple[DataFrame, DataFrame]:
    """Points with the cell, quarter and part they are joined by, and the quarters of dense cells in use."""
    placed = points.withColumns(_place(F.col(at[0]), F.col(at[1]), radius_m))
    smallest = dense_quarters(placed.select("_row", "_col", "_y", "_x"), shares)
    up = lambda c: F.expr(f"shiftright({c}, {DEPTH} - _level)")
    used = smallest.select("_row", "_col", "_level", up("_y").alias("_i"), up("_x").alias("_j"), "_parts")
    # a quarter that is large enough to be used whole has no parts of its own
    quarters = used.groupBy("_row", "_col", "_level", "_i", "_j").agg(
        F.max(F.when(F.col("_level") == DEPTH, F.col("_parts")).otherwise(1)).alias("_parts"))
    known = placed.join(F.broadcast(smallest), ["_row", "_col", "_y", "_x"], "left").withColumns({
        "_i": up("_y"), "_j": up("_x"),
        "_part": F.when(F.col("_level") == DEPTH, F.pmod(F.xxhash64(*points.columns), F.col("_parts")).cast("int"))})
    return known.drop("_y", "_x", "_parts").fillna(0, ["_level", "_i", "_j", "_part"]), quarters


def dealt_sites(around: DataFrame, quarters: DataFrame, radius_m: float, at: tuple[str, str], tasks: int) -> DataFrame:
    """Sites with the cell, quarter and part they are joined by, once for each.

    Few sites may have very many copies, though no more than pairs, so sites are spread over the tasks before they are copied.
    """
    return (
        around.repartition(tasks).join(F.broadcast(quarters), ["_row", "_col"], "left")
        .filter(F.col("_level").isNull() | _in_reach(F.col(at[0]), F.col(at[1]), radius_m))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))))
        .drop("_parts").fillna(0, ["_level", "_i", "_j"])
    )


def nearest_site(pairs: DataFrame, keys: list[str], name: str, extra: list[str],
                 near_m: float | None = None) -> DataFrame:
    """Nearest site per point (ties: smallest name) and distinct site names within ``near_m``.

    One aggregation per point, combined before the shuffle: it moves points, not pairs. Only the names
    within ``near_m`` of a point are held.
    """
    best = F.struct(F.col("distance_m"), F.col(name), *[F.col(e) for e in extra])
    aggs = [F.min(best).alias("_top")]
    if near_m is not None:
        names = F.collect_set(F.when(F.col("distance_m") <= near_m, F.col(name)))
        aggs.append(F.size(names).cast("long").alias("nb_sites_near"))
    return pairs.groupBy(*keys).agg(*aggs).select(
        *keys, F.col("_top.distance_m").alias("distance_m"), F.col(f"_top.{name}").alias(name),
        *[F.col(f"_top.{e}").alias(e) for e in extra],
        *(["nb_sites_near"] if near_m is not None else []),
    )
