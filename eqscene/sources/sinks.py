"""Sinks. Files are written by Spark's writers, one directory a sink."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqscene.functions.scalars import display_round
from eqscene.schemas import BELT

POINTER = "number long, version string, batch string"

#: The columns and property names that readers of the exports expect.
CSV_COLUMNS = ("Place", "Magnitude", "Date", "Time_utc", "Longitude", "Latitude", "Depth_km", "Alert", "URL")


def significant_rows(quakes: DataFrame) -> DataFrame:
    """The nine columns of the export of significant events."""
    values = (
        F.col("place"),
        F.col("mag"),
        F.date_format("event_time", "yyyy-MM-dd"),
        F.date_format("event_time", "HH:mm:ss"),
        F.col("lon"),
        F.col("lat"),
        F.col("depth_km"),
        F.col("alert"),
        F.col("url"),
    )
    return quakes.select(*(v.alias(c) for v, c in zip(values, CSV_COLUMNS, strict=True)))


def feature(geometry_type: str, coordinates: Column, properties: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
            properties.alias("properties"),
        )
    )


def box_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """A box as a closed ring of [x, y] pairs."""
    corners = ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny))
    return F.array(*(F.array(x, y) for x, y in corners))


def write_significant(quakes: DataFrame, path: str) -> None:
    significant_rows(quakes).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    names = [c.lower() if c != "URL" else "url" for c in CSV_COLUMNS]
    rows = significant_rows(quakes).toDF(*names)
    rows.select(feature("Point", F.array("longitude", "latitude"), F.struct(*names)).alias("value")).write.mode("overwrite").text(f"{path}/geojson")


def write_jobs(jobs: DataFrame, path: str) -> None:
    """One job a line; nothing is written for an empty list."""
    if not jobs.isEmpty():
        jobs.write.mode("overwrite").json(path)


def job_array(jobs: DataFrame) -> DataFrame:
    """One JSON array of a bounded list, for tools that want one file."""
    return jobs.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))


def event_info(quakes: DataFrame, jobs: DataFrame) -> DataFrame:
    """Title, epicentre and time of each event that has a job."""
    had = jobs.select("event_id").distinct()
    return quakes.join(had, "event_id", "left_semi").select(
        "event_id",
        "title",
        F.struct(
            F.col("lat").alias("latitude"),
            F.col("lon").alias("longitude"),
            "depth_km",
            F.coalesce("url", F.lit("")).alias("event_url"),
        ).alias("epicenter"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("time"),
    )


def write_event_info(quakes: DataFrame, jobs: DataFrame, path: str) -> None:
    event_info(quakes, jobs).write.mode("overwrite").json(path)


def scene_features(selected: DataFrame) -> DataFrame:
    """One feature per scene of a selected mosaic; ``scenes`` holds granule_id, cloud_cover and ring."""
    return selected.select("*", F.explode("scenes").alias("s")).filter("s.ring IS NOT NULL").select(
        "event_id",
        feature(
            "Polygon",
            F.array(F.transform("s.ring", lambda p: F.array(p["x"], p["y"]))),
            F.struct(
                F.col("title").alias("earthquake"),
                "role",
                F.col("acq_date").alias("date"),
                F.col("orbit_id").alias("orbit"),
                "platform",
                F.col("s.granule_id").alias("granule_id"),
                F.col("s.cloud_cover").alias("cloud_cover"),
                display_round(F.col("coverage"), 1).alias("coverage_pct"),
            ),
        ).alias("value"),
    )


def write_scene_features(selected: DataFrame, path: str) -> None:
    scene_features(selected).write.mode("overwrite").partitionBy("event_id").text(path)


def write_catalogue(scenes: DataFrame, path: str, mode: str = "append") -> None:
    """Scenes (as ``read_scenes`` gives them) as Parquet, a directory for each month and belt of longitude, sorted by path in each file.

    ``readers.scene_catalogue`` reads the directories that events touch. The widest scene is
    kept beside them, as a scene lies in the belt of its western side.
    """
    start, west = F.col("start_time"), F.col("bbox.minx")
    rows = scenes.withColumns({"month": F.year(start) * 12 + F.month(start), "belt": F.floor(west / BELT).cast("int")})
    # a month of a belt may hold many of the scenes: it is dealt to several tasks
    rows.repartition("month", "belt", F.pmod(F.xxhash64("path_number"), F.lit(16))).sortWithinPartitions("month", "belt", "path_number", "start_time").write.mode(mode).partitionBy("month", "belt").parquet(f"{path}/scenes")
    scenes.agg(F.max(F.col("bbox.maxx") - west).alias("widest")).write.mode(mode).parquet(f"{path}/widest")


def sync_actions(old: DataFrame, new: DataFrame) -> DataFrame:
    """``event_id, action``: what a save does to each event's entry."""
    o = old.select("event_id", F.lit(True).alias("was")).distinct()
    n = new.select("event_id", F.lit(True).alias("will")).distinct()
    return o.join(n, "event_id", "full_outer").select(
        "event_id", F.when(F.col("will").isNull(), "delete").when(F.col("was").isNull(), "insert").otherwise("update").alias("action")
    )


def save_tracker(state: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """The whole tracker as a new version beside the old ones; the actions by event (insert, update, delete) that lead to it.

    A version counts when its pointer is there, which is written last, as one file; so a
    ``state`` that is read from the version before may be saved, and a save that is broken
    off leaves the old version. A ``batch`` that was saved before is not saved again. One
    writer at a time.
    """
    spark = state.sparkSession
    old = load_tracker(spark, path)
    if saved_batch(spark, path, batch):
        return sync_actions(old, old)
    known = _pointers(spark, path)
    version = uuid4().hex
    state.write.parquet(f"{path}/versions/{version}")
    number = (known.agg(F.max("number")).first()[0] or 0) + 1
    spark.createDataFrame([(number, version, batch)], POINTER).coalesce(1).write.parquet(f"{path}/pointers/{version}")
    new = spark.read.schema(state.schema).parquet(f"{path}/versions/{version}")
    return sync_actions(new.limit(0) if old is None else old, new)


def saved_batch(spark: SparkSession, path: str, batch: str | None) -> bool:
    """Whether a version was saved for the batch."""
    return batch is not None and not _pointers(spark, path).filter(F.col("batch") == batch).isEmpty()


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], POINTER).write.mode("ignore").parquet(f"{path}/pointers/first")
    return spark.read.schema(POINTER).option("recursiveFileLookup", "true").parquet(f"{path}/pointers")


def load_tracker(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version that was saved whole; None before the first."""
    last = _pointers(spark, path).orderBy(F.desc("number")).first()
    return None if last is None else spark.read.parquet(f"{path}/versions/{last.version}")


def write_tracker(state: DataFrame, path: str) -> None:
    """The whole state: absent events go, as the directory is replaced."""
    state.write.mode("overwrite").json(path)


def write_split_jobs(jobs: DataFrame, path: str) -> None:
    """``jobs`` with ``frame_group``, a directory for each group."""
    jobs.write.mode("overwrite").partitionBy("frame_group").json(path)


def write_summary(detail: DataFrame, totals: DataFrame, path: str) -> None:
    detail.write.mode("overwrite").option("header", True).csv(f"{path}/detail")
    totals.write.mode("overwrite").option("header", True).csv(f"{path}/totals")


def write_aoi(aois: DataFrame, path: str) -> None:
    ring = box_ring(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    aois.select("event_id", feature("Polygon", F.array(ring), F.struct("event_id", "source")).alias("value")).write.mode("overwrite").partitionBy("event_id").text(path)


def write_frames(tracks: DataFrame, path: str) -> None:
    """Track footprints as text columns, lists joined by commas."""
    tracks.withColumn("frames", F.array_join(F.transform("frames", lambda f: f.cast("string")), ",")).write.mode("overwrite").option("header", True).csv(path)


def write_partials(jobs: DataFrame, path: str) -> None:
    jobs.repartition("event_id").write.mode("overwrite").partitionBy("event_id").json(path)


def write_boxes(boxes: DataFrame, path: str) -> None:
    """Per earthquake, and all together."""
    boxes.write.mode("overwrite").partitionBy("earthquake_name").json(f"{path}/products")
    boxes.write.mode("overwrite").json(f"{path}/combined")
