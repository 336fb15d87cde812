"""Tag points with the boxes that contain them.

Grid equi-join, never a nested loop, on grids of several sizes: along each axis a
zone picks the finest grid (the base cell times a power of two) of which it needs
at most three cells, so a zone becomes at most nine rows however large it is. A
point falls in one cell of every grid that some zone uses; the equi-join on grid
and cell is refined with the exact bounds, so a point is compared only with zones
about as large as the cell. Spark broadcasts the cells if they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage

DEFAULT_CELL = 1.0
#: Cells of a zone along one axis, at most.
CELLS_A_SIDE = 3
#: Grids along one axis: the base cell doubled so often at most.
MAX_LEVEL = 60


def _inside(lat: str, lon: str):
    return (
        F.col(lat).between(F.col("_z_min_lat"), F.col("_z_max_lat"))
        & F.col(lon).between(F.col("_z_min_lon"), F.col("_z_max_lon"))
    )


def level_of(side: Column, cell: float) -> Column:
    """The finest grid on which a side of this length is at most two cells long
    (and so touches three)."""
    return F.least(F.greatest(F.ceil(F.log2(F.greatest(side, F.lit(cell)) / F.lit(2 * cell))), F.lit(0)), F.lit(MAX_LEVEL)).cast("int")


def _cell(value: Column, level: Column, cell: float) -> Column:
    return F.floor(value / (F.lit(cell) * F.pow(F.lit(2.0), level)))


def zone_cells(zones: DataFrame, cell: float = DEFAULT_CELL) -> DataFrame:
    """``zones`` (zone_id, min_lat, max_lat, min_lon, max_lon) as rows of grid and
    cell. Boxes with a NULL bound, or turned around, contain nothing and give no
    row."""
    z = zones.select("zone_id", F.col("min_lat").alias("_z_min_lat"), F.col("max_lat").alias("_z_max_lat"),
                     F.col("min_lon").alias("_z_min_lon"), F.col("max_lon").alias("_z_max_lon"))
    z = z.where((F.col("_z_min_lat") <= F.col("_z_max_lat")) & (F.col("_z_min_lon") <= F.col("_z_max_lon")))
    for axis in ("lat", "lon"):
        lo, hi = F.col(f"_z_min_{axis}"), F.col(f"_z_max_{axis}")
        z = z.withColumn(f"_level_{axis}", level_of(hi - lo, cell))
        level = F.col(f"_level_{axis}")
        z = z.withColumn(f"_cell_{axis}", F.explode(F.sequence(_cell(lo, level, cell), _cell(hi, level, cell))))
    return z


def tag_points(
    points: DataFrame,
    zones: DataFrame,
    lat: str,
    lon: str,
    zone_id: str = "zone_id",
    cell_size: float | None = None,
) -> DataFrame:
    """Left join: one output row per (point, containing zone); NULL zone if none.

    ``zones`` has ``zone_id, min_lat, max_lat, min_lon, max_lon``; ``cell_size``
    is the finest grid (default 1 unit), best near the size of a small zone.
    Points with a NULL coordinate are in no zone.
    """
    cs = float(cell_size or DEFAULT_CELL)
    cells = zone_cells(zones, cs).withColumnRenamed("zone_id", zone_id)
    # pairs of grids that zones use: at most MAX_LEVEL + 1 squared, mostly a few
    grids = [(r[0], r[1]) for r in cells.select("_level_lat", "_level_lon").distinct().collect()]
    if not grids:
        return points.withColumn(zone_id, F.lit(None).cast(zones.schema["zone_id"].dataType))
    if len(grids) > 1:  # a point meets several grids: its row is numbered, once and for all
        points = stage(points.withColumn("_row", F.monotonically_increasing_id()), "geo-points")
    at = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in sorted(grids)])
    p = (points.withColumn("_grid", F.explode(at))
         .withColumn("_p_lat", _cell(F.col(lat), F.col("_grid.a"), cs)).withColumn("_p_lon", _cell(F.col(lon), F.col("_grid.b"), cs)))
    cond = ((F.col("_grid.a") == F.col("_level_lat")) & (F.col("_grid.b") == F.col("_level_lon"))
            & (F.col("_p_lat") == F.col("_cell_lat")) & (F.col("_p_lon") == F.col("_cell_lon")) & _inside(lat, lon))
    if len(grids) == 1:
        return p.join(cells, cond, "left").select(*points.columns, zone_id)
    hits = p.join(cells, cond).select("_row", zone_id)
    return points.join(hits, "_row", "left").select(*[c for c in points.columns if c != "_row"], zone_id)
