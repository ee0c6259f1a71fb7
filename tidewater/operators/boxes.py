"""J9 for boxes given as a table: a cell index instead of a range join.

Every box is covered by cells of a degree grid; a cell lists its boxes in their
order.  A point looks up its own cell with an equi-join and takes the first of
the listed boxes that really contains it, so a point has at most one match in
the join, whatever the number of boxes, and nothing is compared pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(v: Column, degrees: float) -> Column:
    return F.floor(v / F.lit(float(degrees))).cast("int")


def cover(boxes: DataFrame, degrees: float = 1.0) -> DataFrame:
    """``cell_lat, cell_lon, boxes``: the boxes (``box, ord, lat0, lon0, lat1, lon1``) that touch a cell, in order."""
    each = boxes.select("*", F.explode(F.sequence(_cell(F.col("lat0"), degrees), _cell(F.col("lat1"), degrees))).alias("cell_lat"))
    each = each.select("*", F.explode(F.sequence(_cell(F.col("lon0"), degrees), _cell(F.col("lon1"), degrees))).alias("cell_lon"))
    return each.groupBy("cell_lat", "cell_lon").agg(F.array_sort(F.collect_list(
        F.struct("ord", "box", "lat0", "lon0", "lat1", "lon1"))).alias("boxes"))


def assign_boxes(points: DataFrame, boxes: DataFrame, degrees: float = 1.0) -> DataFrame:
    """``points`` (``lat, lon``, any others) with ``box``: the first box by ``ord`` that contains the point, edges
    inclusive; null outside all boxes and for points without coordinates.

    Boxes whose ends are turned round contain nothing.  Smaller cells list fewer
    boxes each and are more; a degree suits ports and anchorages."""
    real = boxes.where("lat0 <= lat1 and lon0 <= lon1")
    index = cover(real, degrees).withColumnsRenamed({"cell_lat": "_cell_lat", "cell_lon": "_cell_lon", "boxes": "_boxes"})
    at = points.withColumn("_cell_lat", _cell(F.col("lat"), degrees)).withColumn("_cell_lon", _cell(F.col("lon"), degrees))
    inside = F.filter("_boxes", lambda b: F.col("lat").between(b.lat0, b.lat1) & F.col("lon").between(b.lon0, b.lon1))
    met = at.join(index, ["_cell_lat", "_cell_lon"], "left")
    return met.withColumn("box", F.try_element_at(inside, F.lit(1)).box).select(*points.columns, "box")
