from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eqscene.operators import optical, pairing

T = datetime(2024, 1, 10, 12)
SCHEMA = "event_id long, track string, event_time timestamp, acq_date date, start_time timestamp, pos long, scene_id string, frame_number int, area double"


def scenes(spark, rows):
    """rows: (day, hour, area) in input order."""
    out = [(1, "A", T, date(2024, 1, d), datetime(2024, 1, d, h), i, f"s{i}", i % 2, float(a)) for i, (d, h, a) in enumerate(rows)]
    return spark.createDataFrame(out, SCHEMA)


def accepted(df, ratio=0.95):
    return pairing.filter_coverage(pairing.with_max_coverage(pairing.mosaics(df)), ratio)


def days(df):
    return sorted((r.secondary_date.day, r.reference_date.day) for r in df.collect())


def test_threshold_is_strict_and_needs_coverage(spark):
    df = scenes(spark, [(1, 1, 95), (2, 1, 100), (3, 1, 95.1)])
    assert sorted(r.acq_date.day for r in accepted(df).collect()) == [2, 3]
    assert accepted(scenes(spark, [(1, 1, 0)])).count() == 0


def test_bracketing_pair_and_a_date_on_the_rupture(spark):
    rows = [(1, 1, 10), (5, 1, 10), (12, 1, 10), (15, 1, 10)]
    assert days(pairing.bracket_pair(accepted(scenes(spark, rows)))) == [(5, 12)]
    blocked = scenes(spark, [*rows, (10, 12, 10)])  # exactly at the rupture: neither side, and in between
    assert days(pairing.bracket_pair(accepted(blocked))) == []
    assert days(pairing.sequential_pairs(accepted(blocked), "pre")) == [(1, 5)]


def test_first_scene_stands_for_its_date(spark):
    df = scenes(spark, [(10, 15, 5), (10, 9, 5), (5, 1, 10)])  # input order: the later scene first
    assert {r.acq_date.day: r.start_time.hour for r in pairing.mosaics(df).collect()} == {10: 15, 5: 1}
    # as-of takes scenes one by one: half of day 10 lies before the rupture
    assert [r.acq_date.day for r in pairing.asof_before(df, 0.4).collect()] == [10]
    assert [r.acq_date.day for r in pairing.asof_before(df, 0.6).collect()] == [5]


def test_asof_after_counts_later_dates_only(spark):
    df = scenes(spark, [(1, 1, 100), (12, 1, 10), (13, 1, 11)])
    assert [r.acq_date.day for r in pairing.asof_after(df, 0.95).collect()] == [13]
    assert pairing.asof_before(df).first().acq_date.day == 1


def test_all_pairs_number(spark):
    df = scenes(spark, [(d, 1, 10) for d in range(1, 7)])
    assert len(days(pairing.all_pairs(accepted(df), "pre"))) == 15
    labelled = pairing.radar_pairs(scenes(spark, [(d, 1, 10) for d in (1, 2, 12, 13)]), "sequential")
    assert sorted(r.timing for r in labelled.collect()) == ["co_seismic", "post_seismic", "pre_seismic"]
    with pytest.raises(ValueError):
        pairing.radar_pairs(df, "other")


def test_v1_wants_a_frame_each_and_whole_days(spark):
    df = scenes(spark, [(9, 1, 1), (10, 1, 1), (10, 2, 1), (11, 1, 1)])
    assert {r.acq_date.day for r in pairing.frames_complete(df).collect()} == {9, 10, 11}
    pair = pairing.radar_pairs(df, rules="v1").collect()
    assert pair == []  # the rupture's day is neither side and lies between


def box(x1, y1, x2, y2):
    return [(float(x), float(y)) for x, y in ((x1, y1), (x2, y1), (x2, y2), (x1, y2))]


def with_aoi(df):
    return df.withColumns({c: F.lit(x) for c, x in (("minx", 0.0), ("miny", 0.0), ("maxx", 10.0), ("maxy", 10.0))})


HALF, TENTH = box(0, 0, 5, 10), box(0, 0, 1, 10)


def test_overlapping_tiles_count_once(spark):
    schema = "event_id long, event_time timestamp, orbit_id string, tile_id string, acq_date date, cloud_cover double, pos long, granule_id string, ring array<struct<x:double,y:double>>"
    d = date(2024, 1, 2)
    rows = [(1, T, "001", t, d, 5.0, i, t, r) for i, (t, r) in enumerate([("a", box(0, 0, 6, 10)), ("b", box(1, 0, 7, 10)), ("c", box(-9, 2, 3, 4)), ("d", None)])]
    found = optical.candidates(with_aoi(spark.createDataFrame(rows, schema))).first()
    assert (found.tile_count, round(found.coverage, 6)) == (4, 70.0)


def test_overlapping_frames_count_once(spark):
    schema = "event_id long, track string, event_time timestamp, acq_date date, start_time timestamp, pos long, scene_id string, ring array<struct<x:double,y:double>>"
    rings = {5: [box(0, 0, 6, 10), box(1, 0, 7, 10)], 8: [box(0, 0, 9, 10)], 9: [None], 12: [box(0, 0, 5, 10), box(5, 0, 10, 10)]}
    rows = [(1, "A", T, date(2024, 1, d), datetime(2024, 1, d, 6), d * 10 + i, f"s{d}{i}", r) for d, many in rings.items() for i, r in enumerate(many)]
    df = with_aoi(spark.createDataFrame(rows, schema))
    assert {r.acq_date.day: round(r.coverage, 6) for r in pairing.mosaics(df).collect()} == {5: 70.0, 8: 90.0, 9: 0.0, 12: 100.0}
    assert pairing.asof_before(df, 0.65).first().acq_date.day == 8
    assert pairing.asof_before(df, 0.95).count() == 0
    assert [r.id for r in pairing.asof_after(df).selectExpr("explode(scenes.scene_id) AS id").collect()] == ["s120", "s121"]


def test_optical_ties_and_partial_orbits(spark):
    schema = "event_id long, event_time timestamp, orbit_id string, tile_id string, acq_date date, cloud_cover double, pos long, granule_id string, ring array<struct<x:double,y:double>>"
    rows = [
        (1, T, "001", "T1", date(2024, 1, 2), 5.0, 0, "a.SAFE", HALF),
        (1, T, "001", "T1", date(2024, 1, 2), 5.0, 1, "b.SAFE", HALF),
        (1, T, "001", "T1", date(2024, 1, 10), 5.0, 2, "c.SAFE", HALF),  # the rupture's day is before it
        (1, T, "001", "T1", date(2024, 1, 12), 9.0, 3, "d.SAFE", HALF),
        (1, T, "002", "T1", date(2024, 1, 3), 7.0, 4, "e.SAFE", TENTH),
        (1, T, None, "T1", date(2024, 1, 3), 7.0, 5, "f.SAFE", TENTH),
    ]
    df = with_aoi(spark.createDataFrame(rows, schema))
    assert sorted(r.granule_id for r in optical.dedupe_tiles(df).collect()) == ["a.SAFE", "c.SAFE", "d.SAFE", "e.SAFE"]
    jobs = {r.orbit_id: r for r in optical.optical_pairs(df, spark.createDataFrame([(1, "t")], "event_id long, title string")).collect()}
    assert jobs["001"].name == "t-S2-R001-2024-01-10_2024-01-12"
    assert jobs["001"].status_note is None and jobs["001"].job_parameters.reference == ["c"]
    assert jobs["002"].name == "t-S2-R002-2024-01-03_MISSING" and jobs["002"].status_note == "PARTIAL"
