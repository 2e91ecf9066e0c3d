import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eqscene.operators import jobs
from eqscene.operators.significance import near_line
from eqscene.sources import readers, sinks


def test_feed(spark, tmp_path):
    feed = {"type": "FeatureCollection", "features": [
        {"id": "a", "properties": {"mag": 6.1, "alert": None, "time": 1700000000999, "title": "M 6.1", "extra": "x"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}},
        {"id": "b", "properties": {"mag": None, "time": 1}, "geometry": None},
    ]}
    (tmp_path / "f.json").write_text(json.dumps(feed))
    rows = {r.event_id: r for r in readers.read_quakes(spark, str(tmp_path)).collect()}
    assert (rows["a"].lon, rows["a"].depth_km, rows["a"].mag, rows["a"].extra) == (1.0, 3.0, 6.1, {"extra": "x"})
    assert rows["b"].lon is None and rows["b"].mag is None
    assert readers.read_quakes(spark, str(tmp_path), min_mag=6.0, max_depth=40).count() == 1


def test_tracker_directory_skips_what_is_not_json(spark, tmp_path):
    good = {"title": "t", "time": 1, "aoi": None, "tracks": {"ASCENDING_18": {"status": "AWAITING_POST_SEISMIC", "path_number": 18}}}
    (tmp_path / "us1.json").write_text(json.dumps(good))
    (tmp_path / "us2.json").write_text("{not json")
    assert readers.read_tracker(spark, str(tmp_path)).count() == 1  # and once more: the schema is as it was
    rows = readers.read_tracker(spark, str(tmp_path)).collect()
    assert [(r.event_id, list(r.tracks)) for r in rows] == [("us1", ["ASCENDING_18"])]


def test_coastline_and_shape(spark, tmp_path):
    line = {"features": [{"geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 0], [1, 1]]}}]}
    (tmp_path / "c.json").write_text(json.dumps(line))
    rows = readers.read_coastline(spark, str(tmp_path / "c.json")).collect()
    assert sorted((r.x1, r.y1, r.x2, r.y2) for r in rows) == [(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 0)]
    assert tuple(readers.read_shape_bbox(spark, str(tmp_path / "c.json")).first())[:4] == (0, 0, 1, 1)
    (tmp_path / "none.json").write_text('{"features": []}')
    with pytest.raises(Exception, match="no geometry"):
        readers.read_shape_bbox(spark, str(tmp_path / "none.json")).collect()


def test_scenes_keep_file_order(spark, tmp_path):
    ring = [[[0, 0], [2, 0], [2, 1], [0, 0]]]
    scene = lambda i, t: {"properties": {"fileID": i, "startTime": t, "pathNumber": 18, "frameNumber": 1, "flightDirection": "ASCENDING"}, "geometry": {"type": "Polygon", "coordinates": ring}}
    (tmp_path / "s.json").write_text(json.dumps({"features": [scene("x-SLC", "2024-01-02T03:04:05Z"), scene("y", "bad")]}))
    rows = {r.file_id: r for r in readers.catalogue_filter(readers.read_scenes(spark, str(tmp_path)), "ASCENDING", 18).collect()}
    (tmp_path / "t.json").write_text(json.dumps({"features": [scene("z", "2024-01-02T03:04:05Z")] * 2}))
    assert [r.pos for r in readers.read_scenes(spark, str(tmp_path)).orderBy("pos").collect()] == [0, 1, 1 << 32, (1 << 32) + 1]
    assert rows["x-SLC"].pos == 0 and rows["x-SLC"].bbox.maxx == 2 and rows["y"].acq_date is None


def test_round_trip_of_jobs_and_exports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    job = {"name": "e-A001", "job_type": "T", "job_parameters": {"granules": ["a"], "secondary_granules": [], "output_resolution": 90}}
    (tmp_path / "in" / "l.json").write_text(json.dumps([job, job]))
    read = readers.read_jobs(spark, str(tmp_path / "in"))
    assert read.count() == 2
    sinks.write_jobs(read.select("name", "job_type", "job_parameters"), str(tmp_path / "out"))
    assert readers.read_jobs(spark, str(tmp_path / "out")).first().job_parameters.granules == ["a"]
    sinks.write_jobs(read.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_job_lists_go_from_reader_to_curation(spark, tmp_path):
    job = lambda n, *g: {"name": n, "job_type": "T", "job_parameters": {"granules": list(g), "secondary_granules": ["S1A_IW_SLC__1SDV_x"]}}
    (tmp_path / "a.json").write_text(json.dumps([job("m_60_x-A001", "S1A_IW_SLC__1SDV_1", "S1A_IW_SLC__1SDV_2"), job("m_70_y-A001", "S1A_EW_SLC__1SDV_3")]))
    (tmp_path / "b.json").write_text(json.dumps([job("m_65_z-A001", "S1A_IW_SLC__1SDV_2", "S1A_IW_SLC__1SDV_1"), job("m_60_w-A001", "S1A_IW_SLC__1SDV_1", "S1A_IW_SLC__1SDV_2")]))
    read = readers.read_jobs(spark, str(tmp_path))
    names = lambda df: sorted(r.name for r in df.collect())
    assert [r.name[:4] for r in read.orderBy("pos").collect()] == ["m_60", "m_70", "m_65", "m_60"]
    assert names(jobs.dedupe_jobs(read)[1]) == ["m_60_w-A001"]
    assert names(jobs.dedupe_jobs(read, "sorted")[1]) == ["m_60_w-A001", "m_60_x-A001"]
    assert names(jobs.conforming(read)[1]) == ["m_70_y-A001"]


def test_compile_features(spark):
    rows = [('{"type":"Feature","id":1}',), ('{"type":"FeatureCollection","features":[{"id":2},{"id":3}]}',), ('{"type":"Point"}',)]
    assert readers.compile_features(spark.createDataFrame(rows, "value string")).count() == 3


def test_only_geometries_are_coordinates(spark, tmp_path):
    files = {
        "all.json": {"type": "FeatureCollection", "bbox": [-170, -80, 100, 200], "features": [
            {"bbox": [-170, -80], "properties": {"pair": [500, 500]}, "geometry": {"type": "Polygon", "coordinates": [[[1, 1], [2, 1.5], [1e0, 2], [1, 1]]]}},
            {"properties": {}, "geometry": {"type": "Point", "coordinates": [3, -1.25, 700]}},
            {"geometry": {"type": "MultiPolygon", "coordinates": [[[[1.5, 1.5, 9], [1.6, 1.5, 9], [1.5, 1.6, 9]]], [[[0, 0], [1, 0], [0, 1]]]]}},
            {"geometry": None}]},
        "feature.json": {"type": "Feature", "properties": {"c": [9, 9]}, "geometry": {"type": "LineString", "coordinates": [[5, 6], [7, 8]]}},
        "bare.json": {"type": "GeometryCollection", "geometries": [{"type": "MultiPoint", "coordinates": [[5, 5], [6, 6]]}]},
        "empty.json": {"type": "FeatureCollection", "features": [], "bbox": [0, 0, 1, 1]},
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content))
    (tmp_path / "nothing.json").write_text("")
    rows = {r.file.rsplit("/", 1)[1]: (r.minx, r.miny, r.maxx, r.maxy, r.n_points) for r in readers.read_shapes(spark, str(tmp_path)).collect()}
    assert rows["all.json"] == (0, -1.25, 3, 2, 11) and rows["feature.json"] == (5, 6, 7, 8, 2) and rows["bare.json"] == (5, 5, 6, 6, 2)
    assert rows["empty.json"] == (None, None, None, None, 0)
    with pytest.raises(Exception, match="no geometry"):
        readers.read_shape_bbox(spark, str(tmp_path / "nothing.json")).collect()


def test_rings_of_two_files_stay_apart(spark, tmp_path):
    box = lambda a, b: {"features": [{"geometry": {"type": "LineString", "coordinates": [[a, a], [b, a], [b, b], [a, b]]}}]}
    (tmp_path / "land.json").write_text(json.dumps(box(0, 30)))
    (tmp_path / "island.json").write_text(json.dumps(box(10, 20)))  # within the other: both hold its points
    points = spark.createDataFrame([(1, 15.0, 15.0), (2, 5.0, 5.0), (3, 40.0, 40.0)], "event_id int, lon double, lat double")
    assert sorted(r.event_id for r in near_line(points, readers.read_coastline(spark, str(tmp_path))).collect()) == [1, 2]


def test_events_read_their_part_of_the_catalogue(spark, tmp_path):
    ring = "array<struct<x:double,y:double>>"
    rows = [(f"s{m}{x}", datetime(2024, m, 5), 1, [(x, 0.0), (x + 3, 0.0), (x + 3, 3.0)]) for m in range(1, 13) for x in (-100.0, -16.0, 0.0, 29.0, 90.0)]
    scenes = spark.createDataFrame(rows, f"file_id string, start_time timestamp, path_number int, ring {ring}").withColumn("bbox", readers.ring_box(F.col("ring")))
    path = str(tmp_path / "catalogue")
    sinks.write_catalogue(scenes, path)
    events = spark.createDataFrame([(1, -14.0, 0.0, -13.5, 1.0, datetime(2024, 2, 20), datetime(2024, 4, 10))], "event_id int, minx double, miny double, maxx double, maxy double, window_start timestamp, window_end timestamp")
    found = readers.scene_catalogue(spark, path, events)
    assert sorted({(r.month % 12, r.belt) for r in found.collect()}) == [(m, -2) for m in (2, 3, 4)]  # the scene at -16 reaches in from the belt to the west
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(found.inputFiles()) <= len(readers.scene_catalogue(spark, path).inputFiles())
    none = readers.scene_catalogue(spark, path, events.limit(0))
    assert none.count() == 0 and readers.scene_catalogue(spark, path).count() == len(rows)


def test_a_tracker_is_saved_where_it_was_read(spark, tmp_path):
    path = str(tmp_path / "tracker")
    state = lambda *ids: spark.createDataFrame([(i, 1) for i in ids], "event_id string, n int")
    actions = lambda df: {r.event_id: r.action for r in df.collect()}
    assert actions(sinks.save_tracker(state("a", "b"), path, "1")) == {"a": "insert", "b": "insert"}
    old = sinks.load_tracker(spark, path)
    again = old.filter("event_id <> 'a'").unionByName(state("c"))
    assert actions(sinks.save_tracker(again, path, "2")) == {"a": "delete", "b": "update", "c": "insert"}
    assert sorted(r.event_id for r in old.collect()) == ["a", "b"]  # a reader of the old version still has it
    sinks.save_tracker(state("x"), path, "2")  # the same batch once more
    assert sorted(r.event_id for r in sinks.load_tracker(spark, path).collect()) == ["b", "c"]
    state("lost").write.parquet(f"{path}/versions/broken-off")
    assert sorted(r.event_id for r in sinks.load_tracker(spark, path).collect()) == ["b", "c"]


def test_files_of_the_smaller_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("e", "user", 0.0, 1.0, 2.0, 3.0, [3, 1], "2", "m_60_there")], "event_id string, source string, minx double, miny double, maxx double, maxy double, frames array<int>, frame_group string, name string")
    sinks.write_aoi(rows, str(tmp_path / "aoi"))
    ring = json.loads(spark.read.text(str(tmp_path / "aoi")).first().value)["geometry"]["coordinates"][0]
    assert ring[0] == ring[-1] == [0.0, 1.0] and len(ring) == 5
    sinks.write_frames(rows.select("event_id", "frames"), str(tmp_path / "frames"))
    assert spark.read.option("header", True).csv(str(tmp_path / "frames")).first().frames == "3,1"
    sinks.write_split_jobs(rows.select("name", "frame_group"), str(tmp_path / "split"))
    assert (tmp_path / "split/frame_group=2").is_dir()
    sinks.write_partials(rows.select("event_id", "name"), str(tmp_path / "partial"))
    assert (tmp_path / "partial/event_id=e").is_dir()
    sinks.write_summary(rows.select("name"), spark.createDataFrame([(1,)], "n_jobs int"), str(tmp_path / "summary"))
    assert spark.read.option("header", True).csv(str(tmp_path / "summary/totals")).first().n_jobs == "1"
    files = [{"name": "m_60_a-A001", "year": "2024", "files": [{"filename": "p.nc", "s3": {"bucket": "b", "key": "k"}}], "browse_images": ["p.png"]}]
    (tmp_path / "manifest.json").write_text(json.dumps(files))
    got = readers.read_manifest(spark, str(tmp_path / "manifest.json")).first()
    assert (got.year, got.files[0].s3.key, got.browse_images) == ("2024", "k", ["p.png"])
