"""The nearest marker of every point, by cells of halving size; no point meets more than a few markers.

Cells of the size of the reach come first: a marker within reach lies in a point's own or a neighbouring cell. Then pairs of point and
cell go down level by level to the occupied quarters of each cell. A quarter stays for a point if its near edge isn't farther than the
far corner of the nearest other one, so that a few are left for each point, however dense the markers are. At the last level no
cell has more than LEAF different places, and distances are taken. Each step is a join on cells that can be split if one is hot.

Markers in one place count as the one with the smallest id; of equal distances the smallest id is nearest. Points without a
marker within reach have no row; nor have points or markers without a place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import checkpointed

#: Different places in a cell of the last level, and levels at most (places that are nearer to each other than reach / 2**40 share a cell).
LEAF = 32
MOST_LEVELS = 40


def _cell(c: str, unit: float, level: int) -> Column:
    """Multiplying by a power of two is exact, so a cell's quarters are its own."""
    return F.floor(F.col(c) / unit * float(1 << level)).cast("bigint")


def nearest(points: DataFrame, markers: DataFrame, reach: float, leaf: int = LEAF) -> DataFrame:
    """id, marker_id and distance of every point with a marker within reach; both tables have id, x and y (numbers)."""
    unit = reach * (1 + 1e-9)
    places = markers.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x is not null and y is not null")
    places = checkpointed(places.groupBy("x", "y").agg(F.min("id").alias("marker_id")))

    def occupied(level: int) -> DataFrame:
        return places.groupBy(_cell("x", unit, level).alias("cx"), _cell("y", unit, level).alias("cy")).agg(F.count(F.lit(1)).alias("n"))

    last = 0
    while last < MOST_LEVELS and (occupied(last).agg(F.max("n")).first()[0] or 0) > leaf:
        last += 1
    own = points.select("id", F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py")).where("px is not null and py is not null").withColumn("_p", F.monotonically_increasing_id())
    around = F.array(*[F.struct((F.floor(F.col("px") / unit).cast("bigint") + a).alias("cx"), (F.floor(F.col("py") / unit).cast("bigint") + b).alias("cy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    pairs = checkpointed(own.select("_p", "id", "px", "py", F.inline(around)))
    for level in range(last + 1):
        cells = occupied(level).drop("n")
        if level == 0:
            pairs = pairs.join(cells, ["cx", "cy"])
        else:
            half = lambda c: F.floor(F.col(c) / 2).cast("bigint")
            quarters = cells.select(half("cx").alias("_ux"), half("cy").alias("_uy"), "cx", "cy")
            above = pairs.withColumnsRenamed({"cx": "_ax", "cy": "_ay"})
            pairs = above.join(quarters, (F.col("_ax") == F.col("_ux")) & (F.col("_ay") == F.col("_uy"))).drop("_ax", "_ay", "_ux", "_uy")
        side = unit / float(1 << level)
        edge = lambda p, c: (F.col(c) * side - F.col(p), F.col(p) - (F.col(c) + 1) * side)
        near = lambda p, c: F.greatest(*edge(p, c), F.lit(0.0))
        far = lambda p, c: F.greatest(*[F.abs(e) for e in edge(p, c)])
        bounds = {"_near": F.hypot(near("px", "cx"), near("py", "cy")), "_far": F.hypot(far("px", "cx"), far("py", "cy"))}
        limit = F.least(F.min("_far").over(Window.partitionBy("_p")), F.lit(reach)) * (1 + 1e-9)  # a point has a few cells
        pairs = checkpointed(pairs.withColumns(bounds).withColumn("_limit", limit).where("_near <= _limit").drop("_near", "_far", "_limit"))
    placed = places.withColumns({"cx": _cell("x", unit, last), "cy": _cell("y", unit, last)})
    met = pairs.join(placed, ["cx", "cy"]).withColumn("distance", F.sqrt(F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2))).where(F.col("distance") <= reach)
    best = met.groupBy("_p").agg(F.first("id").alias("id"), F.min(F.struct("distance", "marker_id")).alias("b"))
    return best.select("id", "b.marker_id", "b.distance")
