"""Sinks and what reads them again."""

import json
import os

from pyspark.sql import functions as F

from eqscene.functions import scalars as s
from eqscene.operators import jobs
from eqscene.sources import readers, sinks
from eqscene.streaming import tracker

LISTS = "pos long, name string, granules array<string>, secondary_granules array<string>"


def _jobs(spark):
    return spark.createDataFrame(
        [(0, "m_60_a-A001", ["S1A_IW_SLC__1SDV_1"], ["S1A_IW_SLC__1SDV_2"]), (1, "m_60_a-D002", ["x", "y"], ["z"]), (2, "m_70_b-A001", [], []), (3, "m_70_b-A001", None, None)],
        LISTS,
    )


def _files(path):
    return [os.path.join(p, f) for p, _, files in os.walk(path) for f in files if not f.startswith((".", "_"))]


def test_no_jobs_no_list(spark, tmp_path):
    sinks.write_jobs(_jobs(spark).filter("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    sinks.write_jobs(_jobs(spark), str(tmp_path / "some"))
    lines = [json.loads(x) for f in _files(tmp_path / "some") for x in open(f)]
    assert sorted(x["pos"] for x in lines) == [0, 1, 2, 3]


def test_split_by_frames(spark, tmp_path):
    rows = _jobs(spark).withColumn("frame_group", jobs.frame_group())
    sinks.write_split_jobs(rows, str(tmp_path / "split"))
    back = spark.read.schema(rows.schema).json(str(tmp_path / "split"))
    assert {(r.pos, r.frame_group) for r in back.collect()} == {(0, "1"), (1, "mismatched"), (2, "0"), (3, "0")}


def test_summary(spark, tmp_path):
    sinks.write_summary(jobs.tracks_per_event(_jobs(spark)), jobs.job_summary(_jobs(spark)), str(tmp_path))
    detail = spark.read.option("header", True).csv(str(tmp_path / "detail")).collect()
    assert {(r.event_name, r.num_tracks, r.tracks) for r in detail} == {("m_60_a", "2", "A001 D002"), ("m_70_b", "1", "A001")}
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "totals")).first()) == ("2", "4")


def test_areas_and_frames(spark, tmp_path):
    box = spark.createDataFrame([(7, 1.0, 2.0, 3.0, 4.0, "user")], "event_id long, minx double, miny double, maxx double, maxy double, source string")
    sinks.write_aoi(box, str(tmp_path / "aoi"))
    (file,) = _files(tmp_path / "aoi")
    shape = json.loads(open(file).read())
    assert "event_id=7" in file and shape["properties"] == {"event_id": 7, "source": "user"}
    assert shape["geometry"] == {"type": "Polygon", "coordinates": [[[1.0, 2.0], [3.0, 2.0], [3.0, 4.0], [1.0, 4.0], [1.0, 2.0]]]}
    b = readers.read_shape_bbox(spark, file).first()
    assert (b.minx, b.miny, b.maxx, b.maxy, b.n_points) == (1.0, 2.0, 3.0, 4.0, 5)
    tracks = spark.createDataFrame([(7, [3, 4]), (8, []), (9, None)], "event_id long, frames array<int>")
    sinks.write_frames(tracks, str(tmp_path / "frames"))
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "frames")).collect()} == {("7", "3,4"), ("8", None), ("9", None)}


def test_partial_jobs_one_file_an_event(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 3).alias("event_id"), F.col("id").cast("string").alias("track")).repartition(8)
    sinks.write_partials(rows, str(tmp_path / "p"))
    assert len(_files(tmp_path / "p")) == 3
    back = spark.read.schema(rows.schema).json(str(tmp_path / "p"))
    assert back.select(*rows.columns).exceptAll(rows).isEmpty() and back.count() == 40
    found = spark.createDataFrame([(1, "4", ["g"])], "event_id long, track string, granules array<string>")
    done = tracker.complete_partial(back.withColumn("granules", F.lit(None).cast("array<string>")), found, ["event_id", "track"])
    assert [tuple(r) for r in done.collect()] == [(1, "4", ["g"])]


def test_platforms_and_rounding(spark):
    rows = spark.createDataFrame([("S2A_MSIL1C_x", 1.23449), ("S2B_", -0.04), ("S2C", 12.26), ("S2X", None), ("XS2A", 3.0), (None, 0.0)], "name string, x double")
    got = [tuple(r) for r in rows.select(s.platform(F.col("name")), s.display_round(F.col("x"), 3), s.display_round(F.col("x"), 1)).collect()]
    assert [g[0] for g in got] == ["sentinel-2a", "sentinel-2b", "sentinel-2c", "sentinel-2", "sentinel-2", "sentinel-2"]
    assert [g[1:] for g in got] == [(1.234, 1.2), (-0.04, 0.0), (12.26, 12.3), (None, None), (3.0, 3.0), (0.0, 0.0)]
