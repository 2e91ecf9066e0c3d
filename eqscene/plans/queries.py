"""One query per operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqscene.functions import scalars as s
from eqscene.operators import catalog, delivery, geo, jobs, optical, pairing
from eqscene.operators.significance import near_line, significant, strong
from eqscene.plans import runs
from eqscene.plans import views as v
from eqscene.plans.landing import landed, shared_dir
from eqscene.sources import readers, sinks
from eqscene.streaming import forward, tracker

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RATIO = 0.5  # at 0.95 the tables have hardly a pair


def _query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _ids(column: str, name: str = "scene_id") -> Column:
    return F.array_join(F.transform(column, lambda x: x[name]), ",")


def _scenes(spark: SparkSession, d: str) -> DataFrame:
    return v.track_scenes(spark, d)


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    return pairing.filter_coverage(pairing.with_max_coverage(pairing.mosaics(_scenes(spark, d))), RATIO)


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "track", "secondary_date", "reference_date",
        _ids("secondary_scenes").alias("secondary"), _ids("reference_scenes").alias("reference"),
        *(["timing"] if "timing" in df.columns else []),
    )


def _land(spark: SparkSession, d: str) -> DataFrame:
    return _sides(v.view(spark, d, v.LAND))


def _sides(boxes: DataFrame) -> DataFrame:
    """The rings' four sides as segments."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    corners = ((x1, y1, x2, y1), (x2, y1, x2, y2), (x2, y2, x1, y2), (x1, y2, x1, y1))
    sides = F.array(*(F.struct(*(c.alias(n) for c, n in zip(k, ("x1", "y1", "x2", "y2"), strict=True))) for k in corners))
    return boxes.select("ring_id", F.inline(sides))


def _ring(x1: str, y1: str, x2: str, y2: str) -> Column:
    """The four corners of a box."""
    corners = ((x1, y1), (x2, y1), (x2, y2), (x1, y2))
    return F.array(*(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in corners))


def _footprints(spark: SparkSession, d: str) -> DataFrame:
    return v.footprints(spark, d).withColumn("ring", _ring("x1", "y1", "x2", "y2"))


def _optical(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.OPTICAL).withColumn("ring", _ring("x1", "y1", "x2", "y2"))


def _on_land(spark: SparkSession, d: str, rules: str) -> DataFrame:
    return significant(v.view(spark, d, v.QUAKE), _land(spark, d), rules, 10.0).select("event_id", "mag", "depth_km")


@_query
def significant_historic_land(spark: SparkSession, d: str) -> DataFrame:
    return _on_land(spark, d, "historic")


@_query
def significant_forward_land(spark: SparkSession, d: str) -> DataFrame:
    return _on_land(spark, d, "forward")


@_query
def significant_v1_land(spark: SparkSession, d: str) -> DataFrame:
    return _on_land(spark, d, "v1")


@_query
def significant_historic(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.QUAKE).filter(strong("historic")).select("event_id", "mag", "depth_km", "alert")


@_query
def significant_forward(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.QUAKE).filter(strong("forward")).select("event_id", "mag", "depth_km")


@_query
def significant_v1(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.QUAKE).filter(strong("v1")).select("event_id", "mag", "depth_km")


@_query
def significant_export(spark: SparkSession, d: str) -> DataFrame:
    rows = sinks.significant_rows(v.view(spark, d, v.QUAKE).filter(strong("historic")))
    return rows.toDF(*(c.lower() for c in rows.columns))


@_query
def event_info(spark: SparkSession, d: str) -> DataFrame:
    found = sinks.event_info(v.view(spark, d, v.QUAKE), pairing.bracket_pair(_accepted(spark, d)))
    return found.select("event_id", "title", "epicenter.*", "time")


@_query
def aoi_box(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.QUAKE).select("event_id", *s.square_aoi(F.col("lon"), F.col("lat")))


@_query
def window_bounds(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.QUAKE).select("event_id", *s.window_bounds(F.col("event_time"), 90, 30))


@_query
def day_delta_floor(spark: SparkSession, d: str) -> DataFrame:
    return _scenes(spark, d).select("event_id", "pos", s.day_delta(F.col("acq_date"), F.col("event_time")).alias("delta"))


@_query
def asof_pre(spark: SparkSession, d: str) -> DataFrame:
    return pairing.asof_before(_scenes(spark, d), RATIO).select("event_id", "track", "acq_date", "coverage", _ids("scenes").alias("scenes"))


@_query
def asof_post(spark: SparkSession, d: str) -> DataFrame:
    return pairing.asof_after(_scenes(spark, d), RATIO).select("event_id", "track", "acq_date", "coverage", _ids("scenes").alias("scenes"))


@_query
def asof_footprints(spark: SparkSession, d: str) -> DataFrame:
    """Dates before and after the rupture, by the union of overlapping footprints."""
    scenes = _footprints(spark, d)
    found = pairing.asof_before(scenes).withColumn("side", F.lit("pre")).unionByName(pairing.asof_after(scenes).withColumn("side", F.lit("post")))
    return found.select("side", "event_id", "track", "acq_date", F.round("coverage", 6).alias("coverage"), _ids("scenes").alias("scenes"))


@_query
def pairs_footprints(spark: SparkSession, d: str) -> DataFrame:
    """Co-seismic pairs, by the union of overlapping footprints."""
    return _pairs(pairing.radar_pairs(_footprints(spark, d)))


def _waiting(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_id") % 3 > 0, tracker.AWAITING).otherwise(tracker.FAILED)
    area = v.view(spark, d, v.AREA).withColumns({"event_time": F.col("window_start"), "status": status})
    one, members = catalog.shared(area, *geo.BOX, "window_start", "window_end", "event_time", "status")
    listed, scenes = catalog.met_tracks(one, v.view(spark, d, v.SCENE).withColumn("ring", _ring("minx", "miny", "maxx", "maxy")), 40.0)
    waiting = listed.withColumn("track", F.concat_ws("_", "flight_direction", "path_number"))
    return catalog.for_all(tracker.waiting_input(waiting, scenes, 40.0), members)


@_query
def waiting_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Mosaics after the rupture that a pass over the waiting tracks puts before the state machine."""
    return _waiting(spark, d).select("event_id", "track", "kind", "acq_date", "start_time", "pos", F.round("area", 6).alias("area"))


@_query
def track_state_stream(spark: SparkSession, d: str) -> DataFrame:
    """One pass of the stateful stream over waiting tracks, their later mosaics and their results."""
    root = f"{shared_dir(spark)}/state-{uuid4().hex}"
    fields = [f.split() for f in tracker.STATE_INPUT.split(", ")]
    typed = lambda df: df.select(*(F.col(c).cast(t) for c, t in fields))
    found = _waiting(spark, d)
    results = found.filter("event_id % 2 = 0").select("event_id", "track", "event_time").distinct()
    blank = {c: F.lit(None) for c, _ in fields if c not in results.columns}
    results = results.withColumns({**blank, "kind": F.lit("result"), "result": F.lit("Success")})
    typed(found).unionByName(typed(results)).write.parquet(f"{root}/in")
    stream = tracker.track_state(spark.readStream.schema(tracker.STATE_INPUT).parquet(f"{root}/in"))
    write = stream.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
    with forward.state_settings(spark):
        write.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(tracker.STATE_OUTPUT).parquet(f"{root}/out").select("event_id", "track", "status", "post_date")


@_query
def discovery_run(spark: SparkSession, d: str) -> DataFrame:
    """The stream of discovery over landed quakes, held against the known ones."""
    root = f"{shared_dir(spark)}/discovery-{uuid4().hex}"
    feed = v.view(spark, d, v.QUAKE).withColumn("revision", F.col("event_id")).withColumn("event_id", F.col("region").cast("string"))
    feed.write.parquet(f"{root}/in")
    v.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("event_id")).write.parquet(f"{root}/known/first")
    stream = spark.readStream.schema(feed.schema).parquet(f"{root}/in")
    tracker.discovery_stream(stream, f"{root}/known", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(feed.schema).parquet(f"{root}/out").select("event_id", "revision", "mag", "event_time")


@_query
def discovery_stateless(spark: SparkSession, d: str) -> DataFrame:
    """Three polls of one day, each with a row of an event at most, as a stream that keeps ids only."""
    root = f"{shared_dir(spark)}/polls-{uuid4().hex}"
    day = F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(mins=(F.col("event_id") % 1440).cast("int"))
    rows = v.view(spark, d, v.QUAKE).groupBy("region", (F.col("event_id") % 3).alias("poll")).agg(F.max_by(F.struct("event_id", "mag", "depth_km"), "event_id").alias("r")).select("region", "poll", "r.*")
    rows = rows.select(F.col("region").cast("string").alias("event_id"), "poll", F.col("event_id").alias("revision"), "mag", "depth_km", day.alias("event_time"))
    for poll in range(3):
        rows.filter(F.col("poll") == poll).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = tracker.first_seen(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"))
    stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out").select("event_id", "poll", "revision", "mag")


@_query
def pending_queue(spark: SparkSession, d: str) -> DataFrame:
    """Three checks of the queue, as events and scenes come in: the check in which each event left it, 0 for those that wait."""
    path = f"{shared_dir(spark)}/pending-{uuid4().hex}"
    quakes = v.view(spark, d, v.QUAKE).filter(strong("v1")).withColumn("event_time", F.col("event_time").cast("timestamp"))
    box = lambda e, half: e.select(F.col("event_id").cast("string"), *((F.col(c) + x).alias(n) for c, x, n in zip(("lon", "lat", "lon", "lat"), (-half, -half, half, half), geo.BOX, strict=True)))
    scenes = v.view(spark, d, v.SCENE).withColumn("start_time", F.col("start_time").cast("timestamp")).withColumn("ring", _ring(*geo.BOX)).withColumn("bbox", readers.ring_box(F.col("ring")))
    left = []
    for check in (1, 2, 3):
        new = quakes.filter(F.col("event_id") % 3 + 1 == check)
        fault = box(quakes.filter(F.col("event_id") % 2 <= check - 2), 100)  # faults come with the second and the third check
        done = tracker.check_pending(spark, path, str(check), new, scenes.filter(F.col("pos") % 4 < check + 1), "2024-12-31 00:00:00", fault, cell=100.0)
        left.append(done.select("event_id").distinct().withColumn("left_at", F.lit(check)))
    stays = sinks.load_tracker(spark, path).select("event_id", F.lit(0).alias("left_at"))
    return stays.unionByName(left[0]).unionByName(left[1]).unionByName(left[2])


@_query
def forward_run(spark: SparkSession, d: str) -> DataFrame:
    """Passes of a forward run over quakes and scenes that come in two parts, then over the results and the acknowledgements of its jobs."""
    root = f"{shared_dir(spark)}/forward-{uuid4().hex}"
    quakes = v.view(spark, d, v.QUAKE).withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn("revision", F.lit(1))
    scenes = v.view(spark, d, v.SCENE).withColumn("ring", _ring(*geo.BOX)).withColumn("start_time", F.col("start_time").cast("timestamp"))
    scenes = scenes.select("file_id", "start_time", "acq_date", "flight_direction", "path_number", "frame_number", "ring", "pos")
    keyed = "event_id string, track string"
    landed_as = {"feed": quakes.schema, "scenes": scenes.schema, "results": f"{keyed}, result string", "acks": keyed}
    for name, schema in landed_as.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
    land = lambda df, name: df.write.mode("append").parquet(f"{root}/{name}")
    boxed = lambda df: df.withColumn("bbox", readers.ring_box(F.col("ring")))
    about = lambda e: e.select("event_id", *((F.col(c) + x).alias(n) for c, x, n in zip(("lon", "lat", "lon", "lat"), (-50, -50, 50, 50), geo.BOX, strict=True)))
    run = forward.Forward(spark, f"{root}/run", _land(spark, d), lambda: boxed(spark.read.schema(scenes.schema).parquet(f"{root}/scenes")), cell=50.0, aois=about)

    def go() -> None:
        of = {name: spark.readStream.schema(schema).parquet(f"{root}/{name}") for name, schema in landed_as.items()}
        run.run_pass(of["feed"], boxed(of["scenes"]), of["results"], of["acks"])

    for part in (0, 1):
        land(quakes.filter(F.col("event_id") % 2 == part), "feed")
        land(scenes.filter((F.col("pos") % 3 == 0) == (part == 1)), "scenes")
        go()
    number = F.col("event_id").cast("long")
    result = F.when(number % 5 == 0, "Failed: run").otherwise("Success")
    land(run.read("jobs").filter(number % 3 > 0).select("event_id", "track", result.alias("result")), "results")
    go()
    land(run.read("jobs").filter(number % 4 > 0).select("event_id", "track"), "acks")
    go()
    jobs_due = run.read("jobs").select("event_id", "track", "name", "job_parameters")
    return run.state().join(jobs_due, ["event_id", "track"], "left").select(
        "event_id", "track", "reference_date", "post_date", "status", F.array_join("job_parameters.secondary_granules", ",").alias("secondary"),
        F.array_join("job_parameters.granules", ",").alias("reference"),
    )


@_query
def coseismic_pair(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(pairing.bracket_pair(_accepted(spark, d)))


@_query
def pairs_sequential(spark: SparkSession, d: str) -> DataFrame:
    a = _accepted(spark, d)
    return _pairs(pairing.sequential_pairs(a, "pre").unionByName(pairing.sequential_pairs(a, "post")))


@_query
def pairs_all(spark: SparkSession, d: str) -> DataFrame:
    a = _accepted(spark, d)
    return _pairs(pairing.all_pairs(a, "pre").unionByName(pairing.all_pairs(a, "post")))


@_query
def pairs_labelled(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(pairing.radar_pairs(_scenes(spark, d), "sequential", RATIO))


@_query
def pairs_v1(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(pairing.radar_pairs(_scenes(spark, d), "coseismic", RATIO, "v1"))


@_query
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    m = pairing.with_max_coverage(pairing.mosaics(_scenes(spark, d)))
    return m.select("event_id", "track", "acq_date", "coverage", "max_coverage", F.col("start_time").alias("first_time"))


@_query
def frames_complete(spark: SparkSession, d: str) -> DataFrame:
    return pairing.frames_complete(_scenes(spark, d)).select("event_id", "track", "acq_date", "n_scenes")


@_query
def track_frames(spark: SparkSession, d: str) -> DataFrame:
    t = catalog.tracks(_scenes(spark, d))
    return t.select(
        "event_id", "flight_direction", "path_number",
        F.size("frame_times").cast("long").alias("n_frame_times"),
        F.array_join(F.transform("frames", lambda x: x.cast("string")), ",").alias("frames"),
    )


@_query
def scene_event_join(spark: SparkSession, d: str) -> DataFrame:
    met = catalog.scene_events(v.view(spark, d, v.AREA), v.view(spark, d, v.SCENE), 40.0)
    return met.select("event_id", "file_id", "path_number", "acq_date")


@_query
def track_scene_join(spark: SparkSession, d: str) -> DataFrame:
    return catalog.listed_scenes(v.view(spark, d, v.AREA), v.view(spark, d, v.SCENE), "aoi", 40.0).select("event_id", "path_number", "file_id")


@_query
def track_frame_join(spark: SparkSession, d: str) -> DataFrame:
    found = catalog.listed_scenes(v.view(spark, d, v.AREA), v.view(spark, d, v.SCENE), "frame", 40.0)
    return found.select("event_id", "path_number", "frame_number", "file_id")


@_query
def mosaic_coverage(spark: SparkSession, d: str) -> DataFrame:
    area, members = catalog.shared(v.view(spark, d, v.AREA), *geo.BOX, "window_start", "window_end")
    few = catalog.are_few(area, 40.0)
    scenes = v.view(spark, d, v.SCENE)
    met = catalog.scene_events(area, catalog.dealt(scenes, "path_number") if few else scenes, 40.0, few=few)
    ring = _ring(*(f"scene_{c}" for c in geo.BOX))
    boxes = [F.col(c).cast("double") for c in geo.BOX]
    grouped = met.withColumn("ring", ring).groupBy("event_id", "path_number", "acq_date", *geo.BOX).agg(F.count("*").alias("n_scenes"), F.collect_list("ring").alias("rings"))
    return catalog.for_all(grouped.select("event_id", "path_number", "acq_date", "n_scenes", F.round(geo.mosaic_area("rings", *boxes), 6).alias("area")), members)


@_query
def direction_coverage(spark: SparkSession, d: str) -> DataFrame:
    """What all scenes of a direction cover of a belt: mosaics that grow with the catalogue, cut into bands."""
    belt = {"minx": F.lit(-1700.0), "miny": F.lit(-500.0), "maxx": F.lit(1700.0), "maxy": F.lit(500.0)}
    scenes = v.view(spark, d, v.SCENE).withColumn("ring", _ring(*geo.BOX)).select("flight_direction", "ring").withColumns(belt)
    return geo.banded_areas(scenes, ["flight_direction"], 20.0).select("flight_direction", F.round("area", 3).alias("area"))


@_query
def bbox_agg(spark: SparkSession, d: str) -> DataFrame:
    return geo.bbox_agg(v.view(spark, d, v.SCENE), ["path_number"])


@_query
def aoi_precedence(spark: SparkSession, d: str) -> DataFrame:
    area = v.view(spark, d, v.AREA)
    land = v.view(spark, d, v.LAND).select(
        F.col("ring_id").cast("long").alias("event_id"), *(F.col(a).alias(b) for a, b in zip(("x1", "y1", "x2", "y2"), geo.BOX, strict=True))
    )
    user = area.select("event_id", *(F.col(c).cast("double").alias(c) for c in geo.BOX))
    return catalog.resolve_aoi(v.view(spark, d, v.QUAKE), land, user)


def near_line_join(spark: SparkSession, d: str) -> DataFrame:
    return near_line(v.view(spark, d, v.QUAKE), _land(spark, d), 10.0)


QUERIES["near_line"] = near_line_join


@_query
def tile_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return optical.dedupe_tiles(_optical(spark, d)).select("event_id", "orbit_id", "acq_date", "tile_id", "granule_id")


@_query
def optical_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = optical.candidates(optical.dedupe_tiles(_optical(spark, d)))
    return c.select("event_id", "orbit_id", "acq_date", F.round("cc", 6).alias("cc"), "tile_count", F.round("coverage", 6).alias("coverage"), "delta", "side")


@_query
def optical_best_pair(spark: SparkSession, d: str) -> DataFrame:
    c = optical.candidates(optical.dedupe_tiles(_optical(spark, d)))
    return optical.best_pair(c).select("event_id", "orbit_id", "side", "acq_date", _ids("scenes", "granule_id").alias("scenes"))


@_query
def optical_partial(spark: SparkSession, d: str) -> DataFrame:
    c = optical.candidates(optical.dedupe_tiles(_optical(spark, d)))
    return optical.partial_best(c).select("event_id", "orbit_id", "side", "acq_date", F.round("cc", 6).alias("cc"))


@_query
def optical_jobs(spark: SparkSession, d: str) -> DataFrame:
    scenes = _optical(spark, d)
    titles = v.table(spark, d, "supplier").select(F.col("s_suppkey").alias("event_id"), F.col("s_name").alias("title"))
    p = F.col("job_parameters")
    return optical.optical_pairs(scenes, titles).select(
        "event_id", "orbit_id", "name", "status_note",
        F.array_join(p["reference"], ",").alias("reference"), F.array_join(p["secondary"], ",").alias("secondary"),
    )


@_query
def optical_run(spark: SparkSession, d: str) -> DataFrame:
    """Events and optical scenes to jobs."""
    events = v.view(spark, d, v.OPTICAL_EVENT)
    scenes = v.view(spark, d, v.OPTICAL_SCENE).withColumn("ring", _ring("x1", "y1", "x2", "y2"))
    p = F.col("job_parameters")
    return runs.process_optical(events, events, scenes, 10.0, (90, 30), True).select(
        "event_id", "orbit_id", "name", "status_note",
        F.array_join(p["reference"], ",").alias("reference"), F.array_join(p["secondary"], ",").alias("secondary"),
    )


@_query
def historic_run(spark: SparkSession, d: str) -> DataFrame:
    """A feed, its coastline and areas of the user to radar jobs."""
    quakes = v.view(spark, d, v.QUAKE)
    user = quakes.select("event_id", *((F.col(c) + x).alias(n) for c, x, n in zip(("lon", "lat", "lon", "lat"), (-400, -400, 400, 400), geo.BOX, strict=True)))
    scenes = v.view(spark, d, v.SCENE).withColumn("ring", _ring(*geo.BOX)).withColumn("bbox", readers.ring_box(F.col("ring")))
    p = F.col("job_parameters")
    return runs.historic(quakes, _land(spark, d), scenes, user=user, cell=400.0).select(
        "event_id", "secondary_date", "reference_date",
        F.array_join(p["secondary_granules"], ",").alias("secondary"), F.array_join(p["granules"], ",").alias("reference"),
    )


def _historic_optical(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """A historic run over the optical events, of which some are weak or far from land."""
    events = v.view(spark, d, v.OPTICAL_EVENT)
    known = {"mag": F.lit(5.0) + F.col("event_id") % 40 / 10.0, "alert": F.lit("green"), "depth_km": F.lit(10.0), "lon": F.col("minx") + 3, "lat": F.col("miny") + 3, "url": F.lit(None).cast("string")}
    ring = {"x1": F.col("n_nationkey") * 7 % 34 - 1.0, "y1": F.col("n_nationkey") * 5 % 34 - 1.0}
    land = _sides(v.table(spark, d, "nation").withColumns(ring).select(F.col("n_nationkey").alias("ring_id"), "x1", "y1", (F.col("x1") + 4).alias("x2"), (F.col("y1") + 4).alias("y2")))
    scenes = v.view(spark, d, v.OPTICAL_SCENE).withColumns({"ring": _ring("x1", "y1", "x2", "y2"), "platform": s.platform(F.col("granule_id"))})
    return runs.historic_outputs(events.withColumns(known), land, scenes, "optical", user=events.select("event_id", *geo.BOX), cell=10.0)


@_query
def historic_optical_run(spark: SparkSession, d: str) -> DataFrame:
    """Feed, coastline and optical scenes to jobs."""
    p = F.col("job_parameters")
    return _historic_optical(spark, d)["jobs"].select("event_id", "orbit_id", "name", "status_note", F.array_join(p["reference"], ",").alias("reference"), F.array_join(p["secondary"], ",").alias("secondary"))


@_query
def selected_scenes(spark: SparkSession, d: str) -> DataFrame:
    """The footprints of the scenes that the complete pairs of a historic run hold."""
    of = lambda k, t="string": F.get_json_object("value", f"$.properties.{k}").cast(t).alias(k)
    corner = F.get_json_object("value", "$.geometry.coordinates[0][0][0]").cast("double").alias("x")
    names = (of("earthquake"), of("role"), of("date"), of("orbit"), of("platform"), of("granule_id"), of("cloud_cover", "double"), of("coverage_pct", "double"))
    return _historic_optical(spark, d)["features"].select("event_id", *names, corner)


@_query
def read_feed(spark: SparkSession, d: str) -> DataFrame:
    """Quakes landed as feed files, read with the feed's own predicates."""
    p = F.struct("title", "place", "url", "mag", "alert", F.unix_millis(F.col("event_time").cast("timestamp")).alias("time"))
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat", "depth_km").alias("coordinates"))
    quakes = v.view(spark, d, v.QUAKE)
    path = landed(quakes, "event_id", F.struct(F.col("event_id").cast("string").alias("id"), p.alias("properties"), point.alias("geometry")), "features")
    found = readers.read_quakes(spark, path, min_mag=6.0, max_depth=40.0)
    return found.select("event_id", "title", "place", "url", "mag", "alert", "lon", "lat", "depth_km", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


@_query
def read_radar_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Scenes landed as catalogue files, read with their boxes."""
    scenes = v.view(spark, d, v.SCENE)
    corner = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    corners = F.array(*(corner(x, y) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))))
    p = F.struct(
        F.col("file_id").alias("fileID"), F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startTime"), F.col("path_number").alias("pathNumber"),
        F.col("frame_number").alias("frameNumber"), F.col("flight_direction").alias("flightDirection"),
    )
    item = F.struct(p.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates")).alias("geometry"))
    found = readers.catalogue_filter(readers.read_scenes(spark, landed(scenes, "pos", item, "features")), direction="ASCENDING")
    return found.select("file_id", "acq_date", "flight_direction", F.col("path_number").cast("long").alias("path_number"), "frame_number", "bbox.*")


@_query
def read_optical_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Optical scenes landed as catalogue files; those with too many clouds or of another level are left out."""
    scenes = v.view(spark, d, v.OPTICAL_SCENE)
    level = F.when(F.col("pos") % 4 == 0, "MSIL2A").otherwise("MSIL1C")
    name = F.concat(F.lit("S2A_"), level, F.lit("_R"), "orbit_id", F.lit("_"), F.lpad(F.substring("tile_id", 2, 9), 5, "0"), F.lit("_"), F.col("pos").cast("string"))
    name = F.regexp_replace(name, r"_(\d{5})_", "_T$1_")
    corners = F.concat_ws(", ", *(F.concat_ws(" ", x, y) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"), ("x1", "y1"))))
    item = F.struct(
        name.alias("Name"),
        F.struct(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Start")).alias("ContentDate"),
        F.concat(F.lit("geography'SRID=4326;POLYGON (("), corners, F.lit("))'")).alias("Footprint"),
        F.array(F.struct(F.lit("cloudCover").alias("Name"), F.col("cloud_cover").cast("string").alias("Value"))).alias("Attributes"),
    )
    found = readers.read_optical(spark, landed(scenes, "pos", item, "value"), 15.0)
    return found.select("granule_id", "acq_date", "cloud_cover", "orbit_id", "tile_id", F.inline(F.array(readers.ring_box(F.col("ring")))))


@_query
def read_job_lists(spark: SparkSession, d: str) -> DataFrame:
    """Jobs landed as lists, read and curated."""
    path = landed(_full_job(spark, d), "pos", F.struct("name", "job_type", "job_parameters"), most=4000)
    kept = jobs.dedupe_jobs(readers.read_jobs(spark, path), "sorted")[0]
    return kept.groupBy(F.concat_ws(",", "granules").alias("reference"), F.concat_ws(",", "secondary_granules").alias("secondary")).agg(F.count("*").alias("n"))


@_query
def read_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Footprints landed as files whose features also have boxes and pairs of numbers that are no coordinates."""
    scenes = v.view(spark, d, v.SCENE)
    corner = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    corners = F.array(*(corner(x, y) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "miny"))))
    far = F.array(F.lit(-9999.0), F.lit(9999.0))
    item = F.struct(far.alias("bbox"), F.struct(far.alias("pair")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates"), far.alias("bbox")).alias("geometry"))
    found = readers.read_shapes(spark, landed(scenes, "pos", item, "features"))
    return found.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "minx", "miny", "maxx", "maxy", "n_points")


@_query
def catalogue_join(spark: SparkSession, d: str) -> DataFrame:
    """Scenes landed by month and belt, joined with areas, of whose months and belts alone the directories are read."""
    path = f"{shared_dir(spark)}/catalogue-{uuid4().hex}"
    scenes = v.view(spark, d, v.SCENE).withColumn("bbox", F.struct(*geo.BOX)).drop(*geo.BOX)
    sinks.write_catalogue(scenes, path)
    area = v.view(spark, d, v.AREA)
    found = readers.scene_catalogue(spark, path, area).select("file_id", "path_number", "acq_date", "start_time", "bbox.*")
    return catalog.scene_events(area, found, 40.0).select("event_id", "file_id", "path_number", "acq_date")


@_query
def read_coastline(spark: SparkSession, d: str) -> DataFrame:
    """Rings landed as lines, read as segments; open lines are closed."""
    land = v.view(spark, d, v.LAND)
    line = F.array(*(F.array(x, y) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))))
    item = F.struct(F.struct(F.when(F.col("ring_id") % 5 == 0, "Point").otherwise("LineString").alias("type"), line.alias("coordinates")).alias("geometry"))
    return readers.read_coastline(spark, landed(land, "ring_id", item, "features")).select("seg", "x1", "y1", "x2", "y2")


@_query
def attr_lookup(spark: SparkSession, d: str) -> DataFrame:
    attrs = F.array(F.struct(F.lit("k").alias("Name"), F.get_json_object("props", "$.k").alias("Value")))
    return v.table(spark, d, "events").select("event_id", s.first_attr(attrs, "k").alias("k"), s.first_attr(attrs, "other").alias("other"))


@_query
def title_snake(spark: SparkSession, d: str) -> DataFrame:
    return v.table(spark, d, "documents").select("doc_id", s.snake_title(F.col("text")).alias("snake"))


@_query
def name_magnitude(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("name")
    return v.view(spark, d, v.JOB_SPARK).select("pos", *(s.name_magnitude(name, k).alias(k) for k in ("start", "bounded", "tenths")))


@_query
def job_name_parse(spark: SparkSession, d: str) -> DataFrame:
    return jobs.named(v.view(spark, d, v.JOB_SPARK)).select("pos", "event_name", "track", "direction", "path", "bad_name")


@_query
def work_path(spark: SparkSession, d: str) -> DataFrame:
    p = pairing.radar_pairs(_scenes(spark, d), "coseismic", RATIO)
    path = s.work_path("root", F.col("event_id").cast("string"), F.lit("ASCENDING"), F.col("track"), F.col("timing"), F.col("secondary_date"), F.col("reference_date"))
    return p.select("event_id", "track", path.alias("path"))


@_query
def strip_names(spark: SparkSession, d: str) -> DataFrame:
    scene = F.concat(F.col("file_id"), F.when(F.col("pos") % 2 == 0, F.lit("-SLC")).otherwise(F.lit(".SAFE")))
    return v.view(spark, d, v.SCENE).select("pos", s.strip_suffix(scene).alias("bare"), s.strip_archive(scene).alias("plain"), s.direction_code(F.col("flight_direction")).alias("code"), s.path3(F.col("path_number")).alias("path"))


def _expected(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = v.view(spark, d, f"{v.DELIVERED} FROM {name}")
    return rows.select("doc_id", s.delivery_key("share", F.col("year"), F.col("event"), F.col("file")).alias("key")).filter("key IS NOT NULL")


@_query
def delivery_keys(spark: SparkSession, d: str) -> DataFrame:
    return _expected(spark, d, "documents")


@_query
def delivery_missing(spark: SparkSession, d: str) -> DataFrame:
    return delivery.missing(_expected(spark, d, "documents"), _expected(spark, d, "labels")).select("doc_id", "key")


@_query
def delivery_present(spark: SparkSession, d: str) -> DataFrame:
    return delivery.present(_expected(spark, d, "documents"), _expected(spark, d, "labels")).select("doc_id", "key")


@_query
def delivery_totals(spark: SparkSession, d: str) -> DataFrame:
    return delivery.delivery_totals(_expected(spark, d, "documents"), _expected(spark, d, "labels"))


@_query
def dirs_without_browse(spark: SparkSession, d: str) -> DataFrame:
    pages = v.view(spark, d, v.PAGE_KEY)
    return delivery.dirs_without(pages, pages)


@_query
def ffm_url_pick(spark: SparkSession, d: str) -> DataFrame:
    pages = v.table(spark, d, "pages").withColumn("name", F.when(F.col("page_id") % 3 == 0, F.lit("a_FFM.geojson")).otherwise(F.lit("shake.xml")))
    contents = F.map_from_arrays(F.array(F.lit("first"), F.col("name")), F.array(F.struct(F.lit("x").alias("url")), F.struct(F.col("url").alias("url"))))
    return pages.select("page_id", readers.pick_fault_url(contents).alias("fault_url"))


@_query
def geojson_compile(spark: SparkSession, d: str) -> DataFrame:
    feature = F.concat(F.lit('{"type":"Feature","id":'), F.col("page_id").cast("string"), F.lit("}"))
    k = F.col("page_id") % 3
    value = (
        F.when(k == 0, feature)
        .when(k == 1, F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit(","), feature, F.lit("]}")))
        .otherwise(F.lit('{"type":"Point"}'))
    )
    docs = v.table(spark, d, "pages").select("page_id", value.alias("value"))
    return readers.compile_features(docs).select("page_id", F.col("at").cast("long").alias("at"), F.get_json_object("feature", "$.id").cast("long").alias("feature_id"))


@_query
def product_boxes(spark: SparkSession, d: str) -> DataFrame:
    scenes = v.view(spark, d, v.SCENE).select(
        F.concat(F.lit("root/m_"), (F.col("pos") % 90).cast("string"), F.lit("_place/prod/"), F.col("file_id"), F.lit(".nc")).alias("path"),
        F.array(*(F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy")))).alias("ring"),
    )
    return delivery.product_boxes(scenes).select("filename", "earthquake_name", "magnitude", "box.*")


@_query
def mainshocks_kept(spark: SparkSession, d: str) -> DataFrame:
    return jobs.dedupe_jobs(v.view(spark, d, v.JOB_SPARK))[0].select("pos", "name")


@_query
def mainshocks_removed(spark: SparkSession, d: str) -> DataFrame:
    return jobs.dedupe_jobs(v.view(spark, d, v.JOB_SPARK))[1].select("pos", "name")


def _turned(spark: SparkSession, d: str) -> DataFrame:
    """Jobs half of whose lists stand in reverse order, so that the two keys differ."""
    turned = {c: F.when(F.col("pos") % 2 == 0, F.reverse(c)).otherwise(F.col(c)) for c in ("granules", "secondary_granules")}
    return v.view(spark, d, v.JOB_SPARK).withColumns(turned)


@_query
def dedupe_sorted_key(spark: SparkSession, d: str) -> DataFrame:
    return jobs.dedupe_jobs(_turned(spark, d), "sorted")[0].select("pos", "name")


@_query
def dedupe_ordered_key(spark: SparkSession, d: str) -> DataFrame:
    return jobs.dedupe_jobs(_turned(spark, d))[0].select("pos", "name")


@_query
def jobs_conforming(spark: SparkSession, d: str) -> DataFrame:
    return v.view(spark, d, v.JOB_SPARK).select("pos", jobs.conforms().alias("ok"))


@_query
def exclude_platform(spark: SparkSession, d: str) -> DataFrame:
    return jobs.exclude_platform(v.view(spark, d, v.JOB_SPARK)).select("pos", "name")


@_query
def frame_groups(spark: SparkSession, d: str) -> DataFrame:
    return jobs.frame_groups(v.view(spark, d, v.JOB_SPARK))


@_query
def job_summary(spark: SparkSession, d: str) -> DataFrame:
    return jobs.job_summary(v.view(spark, d, v.JOB_SPARK))


@_query
def tracks_per_event(spark: SparkSession, d: str) -> DataFrame:
    return jobs.tracks_per_event(v.view(spark, d, v.JOB_SPARK))


def _full_job(spark: SparkSession, d: str) -> DataFrame:
    t = F.split(F.col("name"), "-")
    direction = s.direction_name(F.substring(F.get(t, F.lit(1)), 1, 1))
    return v.view(spark, d, v.JOB_SPARK).select("pos", *s.radar_job(F.get(t, F.lit(0)), direction, F.substring(F.get(t, F.lit(1)), 2, 3), F.col("granules"), F.col("secondary_granules")))


@_query
def job_struct(spark: SparkSession, d: str) -> DataFrame:
    return _full_job(spark, d).select("pos", "name", "job_type", F.to_json("job_parameters").alias("parameters"))


@_query
def local_params(spark: SparkSession, d: str) -> DataFrame:
    t = F.split(F.col("name"), "-")
    day = F.lit("2024-01-02")
    p = s.local_params(F.get(t, F.lit(0)), F.lit("co-seismic"), s.direction_name(F.substring(F.get(t, F.lit(1)), 1, 1)), F.substring(F.get(t, F.lit(1)), 2, 3).cast("int"), F.array(F.size("granules")), day, day, F.col("granules"), F.col("secondary_granules"))
    return v.view(spark, d, v.JOB_SPARK).select("pos", p.alias("p")).select("pos", "p.title", F.col("p.flight-direction").alias("direction"), F.col("p.path-number").alias("path"), F.array_join("p.reference-scenes", ",").alias("reference"), F.col("p.output-resolution").alias("resolution"))


@_query
def footprint_ring(spark: SparkSession, d: str) -> DataFrame:
    x = lambda c: F.col(c).cast("string")
    corners = F.concat_ws(", ", *(F.concat_ws(" ", x(a), x(b)) for a, b in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "miny"))))
    scenes = v.view(spark, d, v.SCENE).withColumn("ring", s.wkt_ring(F.concat(F.lit("geography'SRID=4326;POLYGON (("), corners, F.lit("))'"))))
    return scenes.select("pos", F.size("ring").cast("long").alias("n"), readers.ring_box(F.col("ring")).alias("b")).select("pos", "n", "b.*")


@_query
def missing_local(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t: v.view(spark, d, f"{v.DELIVERED} FROM {t}").select("doc_id", "file")
    return delivery.missing_local(key("documents"), key("labels")).select("doc_id", "file")


@_query
def tracker_orphans(spark: SparkSession, d: str) -> DataFrame:
    tracks = tracker.init_tracks(_scenes(spark, d), RATIO)
    return tracker.orphans(_scenes(spark, d).select("event_id", "track").distinct(), tracks)


@_query
def set_resolution(spark: SparkSession, d: str) -> DataFrame:
    p = s.set_resolution(F.col("job_parameters"), 30)
    return _full_job(spark, d).select("pos", p["output_resolution"].alias("output_resolution"), F.array_join(p["granules"], ",").alias("granules"))


@_query
def curation_funnel(spark: SparkSession, d: str) -> DataFrame:
    return jobs.curation_funnel(v.view(spark, d, v.JOB_SPARK))


@_query
def curation_run(spark: SparkSession, d: str) -> DataFrame:
    """Where each job of the list goes, and the group that it is filed under."""
    out = jobs.curate(v.view(spark, d, v.JOB_SPARK))
    parts = [out[k].select("pos", F.lit(k).alias("goes"), "frame_group") for k in ("kept", "removed", "nonconforming")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def new_events_anti(spark: SparkSession, d: str) -> DataFrame:
    known = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"))
    return tracker.new_events(v.view(spark, d, v.QUAKE).filter(strong("forward")), known).select("event_id", "mag")


@_query
def complete_partial(spark: SparkSession, d: str) -> DataFrame:
    every = jobs.named(v.view(spark, d, v.JOB_SPARK))
    partial, done = every.filter(F.size("granules") == 0), every.filter(F.size("granules") > 0)
    best = done.groupBy("event_name", "track").agg(F.min_by("granules", "pos").alias("granules"))
    found = tracker.complete_partial(partial, best, ["event_name", "track"])
    return found.select("pos", "event_name", "track", F.array_join("granules", ",").alias("granules"))


@_query
def completion_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = v.table(spark, d, "orders").select(
        F.col("o_custkey").alias("event_id"),
        F.col("o_orderpriority").alias("track"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Failed: run")).otherwise(F.lit("Success")).alias("status"),
    )
    return tracker.completion_summary(rows)


@_query
def los_to_phase(spark: SparkSession, d: str) -> DataFrame:
    grid = v.table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("x", "los"))
    return grid.select("vec_id", F.col("x").cast("long").alias("x"), F.round(s.los_to_phase(F.col("los")).cast("double"), 4).alias("phase"))


@_query
def tracker_init(spark: SparkSession, d: str) -> DataFrame:
    t = tracker.init_tracks(_scenes(spark, d), RATIO)
    return t.select("event_id", "track", "reference_date", F.array_join("secondary_granules", ",").alias("secondary"), "status")


def _state(spark: SparkSession, d: str) -> DataFrame:
    scenes = _scenes(spark, d)
    tracks = tracker.init_tracks(scenes, RATIO)
    both = tracks.select("event_id", "track")
    n = F.col("event_id") + F.col("track")
    results = both.filter(n % 7 != 0).withColumn("result", F.when(n % 5 == 0, F.lit("Failed: run")).otherwise(F.lit("Success")))
    return tracker.fold_state(tracks, pairing.asof_after(scenes, RATIO), results, both.filter(F.col("event_id") % 2 == 0))


@_query
def tracker_state(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d)


@_query
def tracker_gc(spark: SparkSession, d: str) -> DataFrame:
    return tracker.collect_finished(_state(spark, d))


@_query
def tracker_sync(spark: SparkSession, d: str) -> DataFrame:
    state = _state(spark, d)
    return tracker.sync_actions(state, state.filter(F.col("status") != tracker.REMOVED))


@_query
def tracker_saved(spark: SparkSession, d: str) -> DataFrame:
    """The tracker saved, read, and saved again where it was read from without the tracks that are done."""
    path = f"{shared_dir(spark)}/tracker-{uuid4().hex}"
    sinks.save_tracker(_state(spark, d), path, "1")
    actions = sinks.save_tracker(sinks.load_tracker(spark, path).filter(F.col("status") != tracker.REMOVED), path, "2")
    left = sinks.load_tracker(spark, path).groupBy("event_id").agg(F.count("*").alias("n_tracks"))
    return actions.join(left, "event_id", "left").select("event_id", "action", F.coalesce("n_tracks", F.lit(0)).alias("n_tracks"))


@_query
def pending_resolve(spark: SparkSession, d: str) -> DataFrame:
    return tracker.resolve_pending(_scenes(spark, d), v.view(spark, d, v.QUAKE), RATIO)


@_query
def stream_discovery(spark: SparkSession, d: str) -> DataFrame:
    feed = v.view(spark, d, v.QUAKE).withColumnRenamed("event_id", "revision").withColumnRenamed("region", "event_id")
    known = v.table(spark, d, "supplier").select(F.col("s_suppkey").alias("event_id"))
    return tracker.discover(feed, known).select("event_id", "revision", "mag", "event_time")


@_query
def stream_feed(spark: SparkSession, d: str) -> DataFrame:
    """Quakes landed as feed files and read as a stream: the look-back of 48 hours, then the feed's least magnitude."""
    root = f"{shared_dir(spark)}/feed-{uuid4().hex}"
    p = F.struct("title", "mag", F.unix_millis(F.col("event_time").cast("timestamp")).alias("time"))
    point = F.struct(F.array("lon", "lat", "depth_km").alias("coordinates"))
    path = landed(v.view(spark, d, v.QUAKE), "event_id", F.struct(F.col("event_id").cast("string").alias("id"), p.alias("properties"), point.alias("geometry")), "features")
    stream = readers.filter_quakes(readers.stream_quakes(spark, f"{path}/*", "2024-01-20 00:00:00"), min_mag=5.5).drop("extra")
    stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out").select("event_id", "title", "mag", "lon", "lat", "depth_km", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


@_query
def read_tracker_files(spark: SparkSession, d: str) -> DataFrame:
    """Tracks landed as a file for each event, every fifth of which is broken off."""
    path = f"{shared_dir(spark)}/tracker-{uuid4().hex}"
    rows = v.table(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.max("l_shipdate").cast("date").cast("string").alias("reference_date"))
    entry = F.struct(F.concat(F.lit("A00"), F.col("l_linenumber").cast("string")).alias("key"), F.struct(F.col("l_linenumber").cast("int").alias("path_number"), "reference_date", F.lit(tracker.AWAITING).alias("status")).alias("value"))
    files = rows.groupBy("l_suppkey").agg(F.to_json(F.struct(F.concat(F.lit("ev"), F.col("l_suppkey").cast("string")).alias("title"), F.map_from_entries(F.collect_list(entry)).alias("tracks"))).alias("value"))
    files.withColumn("value", F.when(F.col("l_suppkey") % 5 == 0, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))).repartition("l_suppkey").write.partitionBy("l_suppkey").text(path)
    return readers.read_tracker(spark, f"{path}/*").select("title", F.explode("tracks")).select("title", F.col("key").alias("track"), "value.path_number", "value.reference_date", "value.status")


@_query
def manifest_missing(spark: SparkSession, d: str) -> DataFrame:
    """Manifests landed as files; their files and browse images that are not in the store."""
    rows = v.view(spark, d, f"{v.DELIVERED} FROM documents")
    browse = F.when(F.col("doc_id") % 3 == 0, F.array(F.concat(F.lit("prod."), F.col("doc_id").cast("string"), F.lit(".png"))))
    item = F.struct(
        F.concat("event", F.lit("-D"), F.col("doc_id").cast("string")).alias("name"), "year", F.array(F.struct(F.col("file").alias("filename"))).alias("files"), browse.alias("browse_images")
    )
    expected = delivery.expected_keys(readers.read_manifest(spark, landed(rows, "doc_id", item)), "share")
    return delivery.missing(expected, _expected(spark, d, "labels")).select("name", "file", "key")


@_query
def job_export(spark: SparkSession, d: str) -> DataFrame:
    """Job lists written by direction and read back; the list of a direction without jobs is not written."""
    path = f"{shared_dir(spark)}/jobs-{uuid4().hex}"
    every = _full_job(spark, d)
    for code in "ADX":
        sinks.write_jobs(every.filter(F.col("name").rlike(f"-{code}[0-9]+$")), f"{path}/{code}")
    found = spark.read.schema(every.schema).option("recursiveFileLookup", "true").json(path)
    return found.select("pos", "name", "job_type", F.regexp_extract(F.col("_metadata.file_path"), r"/([ADX])/[^/]*$", 1).alias("code"), F.array_join("job_parameters.granules", ",").alias("granules"))


@_query
def job_split_export(spark: SparkSession, d: str) -> DataFrame:
    """Jobs written to a directory for each number of frames, and read back."""
    path = f"{shared_dir(spark)}/split-{uuid4().hex}"
    rows = v.view(spark, d, v.JOB_SPARK).select("pos", "name", "granules", "secondary_granules", jobs.frame_group().alias("frame_group"))
    sinks.write_split_jobs(rows, path)
    return spark.read.schema(rows.schema).json(path).select("pos", "name", F.array_join("granules", ",").alias("granules"), "frame_group")


@_query
def summary_export(spark: SparkSession, d: str) -> DataFrame:
    """Totals and tracks of each event, written as tables of text and read back."""
    path = f"{shared_dir(spark)}/summary-{uuid4().hex}"
    rows = v.view(spark, d, v.JOB_SPARK)
    sinks.write_summary(jobs.tracks_per_event(rows), jobs.job_summary(rows), path)
    text = lambda name, *columns: spark.read.option("header", True).schema(", ".join(columns)).csv(f"{path}/{name}")
    detail = text("detail", "event_name string", "num_tracks long", "tracks string")
    total = text("totals", "n_events long", "n_jobs long").select(F.lit("all").alias("event_name"), F.col("n_events").alias("num_tracks"), F.col("n_jobs").cast("string").alias("tracks"))
    return detail.unionByName(total)


@_query
def aoi_export(spark: SparkSession, d: str) -> DataFrame:
    """Areas written as closed rings, a directory for each event, and read back."""
    path = f"{shared_dir(spark)}/aois-{uuid4().hex}"
    events = v.view(spark, d, v.OPTICAL_EVENT)
    fault = events.filter("event_id % 3 = 0").select("event_id", *geo.BOX)
    points = events.select("event_id", F.col("minx").alias("lon"), F.col("miny").alias("lat"))
    sinks.write_aoi(catalog.resolve_aoi(points, fault, fault.limit(0)), path)
    ring = F.from_json(F.get_json_object("value", "$.geometry.coordinates[0]"), "array<array<double>>")
    found = spark.read.schema("value string, event_id long").text(path).select("event_id", F.get_json_object("value", "$.properties.source").alias("source"), ring.alias("r"))
    at = lambda i, k: F.get(F.get("r", F.lit(i)), F.lit(k))
    closed = F.get("r", F.lit(0)) == F.element_at("r", -1)
    return found.select("event_id", "source", at(0, 0).alias("minx"), at(0, 1).alias("miny"), at(2, 0).alias("maxx"), at(2, 1).alias("maxy"), F.size("r").cast("long").alias("n"), closed.alias("closed"))


@_query
def frames_export(spark: SparkSession, d: str) -> DataFrame:
    """Frames of each event's tracks, written with the lists as text and read back."""
    path = f"{shared_dir(spark)}/frames-{uuid4().hex}"
    sinks.write_frames(catalog.tracks(_scenes(spark, d)).select("event_id", "flight_direction", "path_number", "frames"), path)
    return spark.read.option("header", True).schema("event_id long, flight_direction string, path_number long, frames string").csv(path)


@_query
def partial_jobs_completed(spark: SparkSession, d: str) -> DataFrame:
    """Partial jobs of waiting tracks written by event; read back, completed by the first later date, written as a list, and read."""
    path = f"{shared_dir(spark)}/partial-{uuid4().hex}"
    scenes = _scenes(spark, d)
    none = F.array().cast("array<string>")
    partial = tracker.init_tracks(scenes, RATIO).withColumn("name", F.concat(F.lit("e"), F.col("event_id").cast("string")))
    partial = partial.select("event_id", "track", *s.radar_job(F.col("name"), F.lit("ASCENDING"), F.col("track").cast("string"), none, F.col("secondary_granules")))
    sinks.write_partials(partial, f"{path}/partial")
    back = spark.read.schema(partial.schema).json(f"{path}/partial").withColumn("granules", none)
    later = pairing.asof_after(scenes, RATIO).select("event_id", "track", F.transform("scenes", lambda x: x["scene_id"]).alias("granules"))
    full = tracker.complete_partial(back, later, ["event_id", "track"])
    full = full.withColumn("job_parameters", F.col("job_parameters").withField("granules", F.col("granules")))
    sinks.write_jobs(full, f"{path}/full")
    return spark.read.schema(full.schema).json(f"{path}/full").select("event_id", "track", "name", F.array_join("job_parameters.secondary_granules", ",").alias("secondary"), F.array_join("job_parameters.granules", ",").alias("reference"))


@_query
def platforms(spark: SparkSession, d: str) -> DataFrame:
    """Platforms by the beginning of a granule's name."""
    name = F.concat(F.lit("S2"), F.element_at(F.array(*(F.lit(x) for x in "ABCX")), (F.col("l_suppkey") % 4 + 1).cast("int")), F.lit("_MSIL1C_"), F.col("l_orderkey").cast("string"))
    return v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", s.platform(name).alias("platform"))


@_query
def display_rounding(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates to three places, depths to one (thirds of whole numbers, so no ties)."""
    third = lambda c: F.col(c) / 3
    return v.view(spark, d, v.QUAKE).select("event_id", *(s.display_round(third(c), n).alias(c) for c, n in (("lon", 3), ("lat", 3), ("depth_km", 1))))


@_query
def transitions_by_pass(spark: SparkSession, d: str) -> DataFrame:
    """Two passes over waiting tracks: an acknowledgement that comes with the result is too early, the one after it counts."""
    root = f"{shared_dir(spark)}/passes-{uuid4().hex}"
    fields = [f.split() for f in tracker.STATE_INPUT.split(", ")]
    typed = lambda df: df.select(*(F.col(c).cast(t) for c, t in fields))
    found = _waiting(spark, d)
    track = found.select("event_id", "track", "event_time").distinct()
    of_kind = lambda df, kind, result=None: typed(df.withColumns({**{c: F.lit(None) for c, _ in fields if c not in df.columns}, "kind": F.lit(kind), "result": F.lit(result) if result is None else result}))
    result = F.when(F.col("event_id") % 5 == 0, "Failed: run").otherwise("Success")
    first = typed(found).unionByName(of_kind(track, "result", result)).unionByName(of_kind(track, "ack"))
    for n, rows in enumerate((first, of_kind(track.filter("event_id % 2 = 0"), "ack"))):
        rows.write.mode("append").parquet(f"{root}/in")
        stream = tracker.track_state(spark.readStream.schema(tracker.STATE_INPUT).parquet(f"{root}/in"))
        write = stream.writeStream.outputMode("update").foreachBatch(lambda df, _, n=n: df.write.mode("overwrite").parquet(f"{root}/out/pass={n + 1}"))
        with forward.state_settings(spark):
            write.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{tracker.STATE_OUTPUT}, pass long").parquet(f"{root}/out").select("event_id", "track", "pass", "status", "post_date")
