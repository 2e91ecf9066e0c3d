"""Readers: landed JSON and tables to DataFrames with declared schemas.

Each returns a lazy DataFrame; filters given as parameters are plain predicates, so that
they are pushed into Parquet scans when the feed has been landed as Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eqscene import schemas
from eqscene.functions import scalars as s


def _json(spark: SparkSession, schema, path: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def quakes_of(feed: DataFrame) -> DataFrame:
    """One row for each feature of a feed; a missing geometry gives null coordinates."""
    f = feed.select(F.explode("features").alias("f"))
    p = F.col("f.properties")
    point = F.col("f.geometry.coordinates")
    known = ("title", "place", "url", "mag", "alert", "time")
    return f.select(
        F.col("f.id").alias("event_id"),
        *(p[k].alias(k) for k in ("title", "place", "url")),
        p["mag"].try_cast("double").alias("mag"),
        p["alert"].alias("alert"),
        p["time"].try_cast("bigint").alias("time_ms"),
        s.epoch_ms_to_second(p["time"].try_cast("bigint")).alias("event_time"),
        *(F.get(point, F.lit(i)).alias(n) for i, n in enumerate(("lon", "lat", "depth_km"))),
        F.map_filter(p, lambda k, _: ~k.isin(*known)).alias("extra"),
    )


def filter_quakes(quakes: DataFrame, start=None, end=None, min_mag=None, max_depth=None) -> DataFrame:
    """The feed's own predicates, as far as given; days are closed intervals."""
    for value, condition in (
        (start, lambda v: F.col("event_time") >= F.lit(v)),
        (end, lambda v: F.col("event_time") <= F.lit(v)),
        (min_mag, lambda v: F.col("mag") >= v),
        (max_depth, lambda v: F.col("depth_km") <= v),
    ):
        if value is not None:
            quakes = quakes.filter(condition(value))
    return quakes


def read_quakes(spark: SparkSession, path: str, start=None, end=None, min_mag=None, max_depth=None) -> DataFrame:
    return filter_quakes(quakes_of(_json(spark, schemas.FEED, path)), start, end, min_mag, max_depth)


def stream_quakes(spark: SparkSession, path: str, now: str | None = None, lookback: str = "48 hours") -> DataFrame:
    """The feed as a stream of files, cut to the look-back from ``now`` (default: each batch's time)."""
    quakes = quakes_of(spark.readStream.schema(schemas.FEED).option("multiLine", True).json(path))
    until = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return quakes.filter(F.col("event_time") >= until - F.expr(f"INTERVAL {lookback}"))


def _ring(coordinates: Column) -> Column:
    return F.transform(F.get(coordinates, F.lit(0)), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))


def ring_box(ring: Column) -> Column:
    """The bounding box of a ring, as a struct."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")
    )


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (file, at, ...) with ``pos``: unique over all files, by their names and then by place.

    Only the names of the files are numbered together, and Spark chooses how they are joined.
    """
    files = rows.select("file").distinct().withColumn("number", F.row_number().over(Window.orderBy("file")) - 1)
    return rows.join(files, "file").withColumn("pos", F.col("number") * F.lit(1 << 32) + F.col("at")).drop("number")


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Radar scenes in the order of files and places (``pos``); a start time that can't be read is null."""
    f = _placed(_json(spark, schemas.SCENE_FILE, path).select(F.posexplode("features").alias("at", "f"), F.col("_metadata.file_path").alias("file")))
    p = F.col("f.properties")
    ring = _ring(F.col("f.geometry.coordinates"))
    return f.select(
        p["fileID"].alias("file_id"),
        s.iso_second(p["startTime"]).alias("start_time"),
        s.iso_date(p["startTime"]).alias("acq_date"),
        p["flightDirection"].alias("flight_direction"),
        p["pathNumber"].alias("path_number"),
        p["frameNumber"].alias("frame_number"),
        p["beamModeType"].alias("beam"),
        p["processingLevel"].alias("level"),
        ring.alias("ring"),
        ring_box(ring).alias("bbox"),
        "pos",
        "file",
    )


def catalogue_filter(scenes: DataFrame, direction=None, path=None, beam="IW", level="SLC") -> DataFrame:
    """Level, beam and orbit; a scene without beam or level passes those."""
    out = scenes.filter((F.coalesce("beam", F.lit(beam)) == beam) & (F.coalesce("level", F.lit(level)) == level))
    if direction is not None:
        out = out.filter(F.col("flight_direction") == direction)
    return out if path is None else out.filter(F.col("path_number") == path)


def read_optical(spark: SparkSession, path: str, max_cloud: float = 20.0, name_part: str = "MSIL1C") -> DataFrame:
    """Optical scenes; ``pos`` is the order of files and places, a tie-break of equal start times."""
    f = _placed(_json(spark, schemas.OPTICAL_FILE, path).select(F.posexplode("value").alias("at", "f"), F.col("_metadata.file_path").alias("file")))
    name = F.col("f.Name")
    return f.select(
        name.alias("granule_id"),
        s.iso_date(F.col("f.ContentDate.Start")).alias("acq_date"),
        s.iso_second(F.col("f.ContentDate.Start")).alias("start_time"),
        s.first_attr(F.col("f.Attributes"), "cloudCover").alias("cloud_cover"),
        s.platform(name).alias("platform"),
        s.orbit_id(name).alias("orbit_id"),
        s.tile_id(name).alias("tile_id"),
        s.wkt_ring(F.col("f.Footprint")).alias("ring"),
        "pos",
    ).filter(name_filter(F.col("granule_id"), name_part) & (F.col("cloud_cover") <= max_cloud))


def name_filter(name: Column, part: str) -> Column:
    return name.contains(part)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of one or many lists, with file, place (``pos``) and both granule lists beside the parameters."""
    jobs = _json(spark, schemas.JOB, path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file"), F.monotonically_increasing_id().alias("read")
    )  # a list is read by one task, in its order
    jobs = jobs.withColumn("at", F.row_number().over(Window.partitionBy("file").orderBy("read")) - 1).drop("read")
    granules = (F.col(f"job_parameters.{c}").alias(c) for c in ("granules", "secondary_granules"))
    return _placed(jobs).select(*schemas.JOB.fieldNames(), *granules, "source_file", "pos")


def read_tracker(spark: SparkSession, path: str) -> DataFrame:
    """One row per state file; the id is the file's stem; files that aren't JSON are skipped."""
    raw = (
        spark.read.schema(StructType([*schemas.TRACKER.fields, StructField("_bad", StringType())]))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .json(path)
        .select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("event_id"))
    )
    return raw.filter("_bad IS NULL AND tracks IS NOT NULL").drop("_bad")


_PAIR = r"\[\s*(-?[0-9.eE+-]+)\s*,\s*(-?[0-9.eE+-]+)"


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """``file, minx, miny, maxx, maxy, n_points``: the box of each file's geometries, null if it has none.

    Geometries of any type are taken from a collection's features, a feature or by themselves
    (also those of a geometry collection); other numbers of the file, as in a ``bbox`` or in
    properties, are not coordinates. A third coordinate is ignored.
    """
    one = "struct<type:string,coordinates:string,geometries:array<struct<coordinates:string>>>"
    shape = F.from_json("value", f"features array<struct<geometry:{one}>>, geometry {one}, type string, coordinates string, geometries array<struct<coordinates:string>>")
    file = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), shape.alias("s"))
    whole = F.concat(
        F.coalesce(F.transform("s.features", lambda f: f["geometry"]), F.array().cast(f"array<{one}>")),
        F.array(F.col("s.geometry"), F.struct(F.col("s.type").alias("type"), F.col("s.coordinates").alias("coordinates"), F.col("s.geometries").alias("geometries"))),
    )
    texts = F.flatten(F.transform(F.filter(whole, lambda g: g.isNotNull()), lambda g: F.concat(F.array(g["coordinates"]), F.coalesce(F.transform(g["geometries"], lambda x: x["coordinates"]), F.array().cast("array<string>")))))
    # a point's text has no inner brackets, those of all other types have a pair in each
    found = file.select("file", F.array_join(F.filter(texts, lambda t: t.isNotNull()), " ").alias("text"))
    at = lambda k: F.transform(F.regexp_extract_all("text", F.lit(_PAIR), F.lit(k)), lambda c: c.try_cast("double"))
    found = found.select("file", at(1).alias("x"), at(2).alias("y"))
    return found.select(
        "file", F.array_min("x").alias("minx"), F.array_min("y").alias("miny"), F.array_max("x").alias("maxx"), F.array_max("y").alias("maxy"), F.size("x").cast("long").alias("n_points")
    )


def read_shape_bbox(spark: SparkSession, path: str) -> DataFrame:
    """The bounding box of all geometries of one or many files; none at all is an error."""
    return read_shapes(spark, path).agg(
        *(f(c).alias(c) for f, c in ((F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))), F.coalesce(F.sum("n_points"), F.lit(0)).alias("n_points")
    ).filter(F.assert_true(F.col("n_points") > 0, "the shape has no geometry").isNull())


def read_coastline(spark: SparkSession, path: str) -> DataFrame:
    """Segments of all LineStrings, open ones closed: ``ring_id, seg, x1, y1, x2, y2``; others are dropped.

    A ring's id is unique over all files: a ring of one file within one of another stays a ring of its own.
    """
    f = _placed(_json(spark, schemas.LINES, path).select(F.posexplode("features").alias("at", "f"), F.col("_metadata.file_path").alias("file"))).withColumnRenamed("pos", "ring_id")
    c = F.col("f.geometry.coordinates")
    closed = F.when(F.get(c, F.lit(0)) == F.element_at(c, -1), c).otherwise(F.concat(c, F.slice(c, 1, 1)))
    lines = f.filter((F.col("f.geometry.type") == "LineString") & (F.size(c) >= 2)).select("ring_id", closed.alias("c"))
    return lines.select(
        "ring_id",
        F.posexplode(F.arrays_zip(F.slice("c", F.lit(1), F.size("c") - 1).alias("a"), F.slice("c", F.lit(2), F.size("c") - 1).alias("b"))).alias("seg", "ab"),
    ).select(
        "ring_id",
        "seg",
        *(F.get(F.col(f"ab.{end}"), F.lit(i)).alias(f"{axis}{k}") for k, end in ((1, "a"), (2, "b")) for i, axis in enumerate("xy")),
    )


def compile_features(docs: DataFrame) -> DataFrame:
    """``value`` (JSON text) to one row per feature: a collection's features, a feature itself, nothing else."""
    kind = F.get_json_object("value", "$.type")
    many = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    return docs.select(
        "*",
        F.posexplode(
            F.when(kind == "FeatureCollection", F.coalesce(many, F.array().cast("array<string>")))
            .when(kind == "Feature", F.array("value"))
            .otherwise(F.array().cast("array<string>"))
        ).alias("at", "feature"),
    )


def pick_fault_url(contents: Column) -> Column:
    """The url of the first key (as the map lists them) that ends in FFM.geojson, or null."""
    hits = F.filter(F.map_entries(contents), lambda e: e["key"].endswith("FFM.geojson"))
    return F.get(hits, F.lit(0))["value"]["url"]


def read_fault_urls(spark: SparkSession, path: str) -> DataFrame:
    """``event_id, fault_url`` of event details: the first product's contents."""
    d = _json(spark, schemas.DETAIL, path)
    products = F.col("properties.products")["finite-fault"]
    return d.select(F.col("id").alias("event_id"), pick_fault_url(F.get(products, F.lit(0))["contents"]).alias("fault_url"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, schemas.MANIFEST, path)


def scene_catalogue(spark: SparkSession, path: str, events: DataFrame | None = None) -> DataFrame:
    """Scenes landed by ``sinks.write_catalogue``: all, or those in months and belts that the boxes and windows of ``events`` touch.

    The months and belts are read from the events and put into the plan as constants, so that
    only their directories are listed and read; they are as many as the calendar and the globe have.
    """
    scenes = spark.read.parquet(f"{path}/scenes")
    if events is None:
        return scenes
    widest = spark.read.parquet(f"{path}/widest").agg(F.max("widest")).first()[0] or 0.0
    month = lambda c: F.year(c) * 12 + F.month(c)
    belt = lambda c: F.floor(c / schemas.BELT).cast("int")
    touched = events.select(
        F.explode(F.sequence(month("window_start"), month("window_end"))).alias("month"), F.sequence(belt(F.col("minx") - widest), belt(F.col("maxx"))).alias("belts")
    ).select("month", F.explode("belts").alias("belt")).distinct().groupBy("month").agg(F.sort_array(F.collect_set("belt")).alias("belts")).collect()
    by_belts: dict[tuple, list[int]] = {}
    for r in touched:
        by_belts.setdefault(tuple(r.belts), []).append(r.month)
    keep = F.lit(False)
    for belts, months in by_belts.items():
        keep |= F.col("month").isin(months) & F.col("belt").isin(list(belts))
    return scenes.filter(keep)
