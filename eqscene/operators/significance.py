"""Which earthquakes count: magnitude, depth, alert, and nearness to land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.operators.geo import cells

ALERTS = ("green", "yellow", "orange", "red")
#: Degrees of a band; coastline segments are about as long, so each is in one or two.
BAND = 0.1


def strong(rules: str = "historic") -> Column:
    """The predicate without the coast; a null in what is tested is a no."""
    mag, depth = F.col("mag"), F.col("depth_km")
    if rules == "historic":
        return (mag >= 6.0) & F.col("alert").isin(*ALERTS) & (depth <= 40)
    if rules == "forward":
        return ((mag >= 5.5) & (depth <= 15)) | ((mag >= 6.0) & (depth <= 40))
    if rules == "v1":
        return (mag >= 6.0) & (depth <= 40)
    raise ValueError(f"no such rules: {rules}")


def near_line(points: DataFrame, segments: DataFrame, dist: float = 1.0, key: str = "event_id") -> DataFrame:
    """Keys of ``points`` (lon, lat) inside a ring, or nearer than ``dist`` to a segment.

    Two equi-joins on cells: narrow latitude bands for the crossings of a ray to the east
    (odd for a ring that holds the point), and squares of ``dist`` or more, with a point's
    neighbours, for the distance. Half-open ends make a shared corner count once.
    """
    band = BAND
    at = points.select(F.col(key), "lon", "lat").filter("lon IS NOT NULL AND lat IS NOT NULL")
    tall = segments.filter("y1 <> y2").withColumn("band", F.explode(cells(F.least("y1", "y2"), F.greatest("y1", "y2"), band)))
    crossing = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (
        F.col("lon") < F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    )
    inside = (
        at.withColumn("band", F.floor(F.col("lat") / band))
        .join(tall, "band")
        .filter(crossing)
        .groupBy(key, "ring_id")
        .agg((F.count("*") % 2).alias("odd"))
        .filter("odd = 1")
        .select(key)
    )
    size = max(dist, 1.0)
    squares = segments.withColumn("cx", F.explode(cells(F.least("x1", "x2"), F.greatest("x1", "x2"), size))).withColumn(
        "cy", F.explode(cells(F.least("y1", "y2"), F.greatest("y1", "y2"), size))
    )
    about = at.withColumn("cx", F.explode(cells(F.col("lon") - size, F.col("lon") + size, size))).withColumn(
        "cy", F.explode(cells(F.col("lat") - size, F.col("lat") + size, size))
    )
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    along = ((F.col("lon") - F.col("x1")) * dx + (F.col("lat") - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = F.col("lon") - F.col("x1") - t * dx, F.col("lat") - F.col("y1") - t * dy
    close = about.join(squares, ["cx", "cy"]).filter(ex * ex + ey * ey < dist * dist).select(key)
    return inside.unionByName(close).distinct()


def significant(quakes: DataFrame, coastline: DataFrame, rules: str = "historic", buffer_deg: float = 1.0) -> DataFrame:
    """``quakes`` that pass the rules and lie on or near land."""
    passed = quakes.filter(strong(rules))
    return passed.join(near_line(passed, coastline, buffer_deg), "event_id", "left_semi")
