from datetime import date, datetime

from eqscene.sources import sinks
from eqscene.streaming import tracker

T = datetime(2024, 1, 10, 12)


def test_discovery_takes_the_latest_significant_revision(spark):
    rows = [(1, 1, T, 5.0, 10.0), (1, 2, datetime(2024, 1, 11), 6.5, 10.0), (2, 1, T, 6.5, 10.0), (3, 1, T, 4.0, 1.0)]
    feed = spark.createDataFrame(rows, "event_id long, revision long, event_time timestamp, mag double, depth_km double")
    known = spark.createDataFrame([(2,)], "event_id long")
    assert [(r.event_id, r.revision) for r in tracker.discover(feed, known).collect()] == [(1, 2)]


def test_a_batch_that_is_run_again_gives_the_same_events(spark, tmp_path):
    schema = "event_id string, revision long, event_time timestamp, mag double, depth_km double"
    feed = lambda *ids: spark.createDataFrame([(i, 1, T, 6.5, 10.0) for i in ids], schema)
    known, out = str(tmp_path / "known"), str(tmp_path / "out")
    spark.createDataFrame([("old",)], "event_id string").write.parquet(known)
    batch = tracker.discovery_batch(known, out)
    found = lambda n: {r.event_id for r in spark.read.parquet(f"{out}/batch={n}").collect()}
    batch(feed("old", "a"), 0)
    batch(feed("old", "a"), 0)
    assert found(0) == {"a"}
    batch(feed("a", "b"), 1)
    batch(feed("a", "b"), 1)
    assert found(1) == {"b"} and found(0) == {"a"}


def test_stream_gives_the_state_of_the_batch_fold(spark, tmp_path):
    source = tmp_path / "in"
    day = lambda d, a: ("e", "A_1", "scene", T, date(2024, 1, d), datetime(2024, 1, d, 6), d, float(a), None)
    event = lambda kind, r=None, e="e": (e, "A_1", kind, T, None, None, None, None, r)
    batches = [
        [day(5, 9), day(12, 4)],
        [day(12, 6), event("result", "Success")],
        [event("ack")],
        [event("result", "Failed: x", "f"), ("f", "A_1", "scene", T, date(2024, 1, 13), datetime(2024, 1, 13), 1, 1.0, None)],
        [event("ack", None, "f")],
        [event("ack", None, "f")],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, tracker.STATE_INPUT).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(tracker.STATE_INPUT).parquet(str(source))
        query = (
            tracker.track_state(stream)
            .writeStream.outputMode("update")
            .foreachBatch(lambda df, n, i=i: df.write.mode("append").parquet(str(tmp_path / "out")))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
    seen = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.event_id, r.status, r.post_date.day) for r in seen) == [
        ("e", tracker.READY, 12), ("e", tracker.REMOVED, 12), ("f", tracker.FAILED, 13), ("f", tracker.READY, 13),
    ]
    keys = "event_id string, track string"
    tracks = spark.createDataFrame([("e", "A_1", date(2024, 1, 5)), ("f", "A_1", date(2024, 1, 5))], f"{keys}, reference_date date")
    later = spark.createDataFrame([("e", "A_1", date(2024, 1, 12)), ("f", "A_1", date(2024, 1, 13))], f"{keys}, acq_date date")
    results = spark.createDataFrame([("e", "A_1", "Success"), ("f", "A_1", "Failed: x")], f"{keys}, result string")
    acks = spark.createDataFrame([("e", "A_1"), ("f", "A_1")], keys)
    folded = {r.event_id: r.status for r in tracker.fold_state(tracks, later, results, acks).collect()}
    assert folded == {"e": tracker.REMOVED, "f": tracker.FAILED}
    assert [r.event_id for r in tracker.collect_finished(tracker.fold_state(tracks, later, results, acks)).collect()] == ["e"]


def test_waiting_tracks_take_whole_mosaics(spark):
    ring = lambda *x: [(a, b) for a, b in ((x[0], x[1]), (x[2], x[1]), (x[2], x[3]), (x[0], x[3]))]
    footprints = {(9, 0): ring(0.0, 0.0, 1.0, 1.0), (12, 0): ring(0.0, 0.0, 0.6, 1.0), (12, 1): ring(0.4, 0.0, 0.8, 1.0), (13, 0): ring(0.0, 0.0, 1.0, 1.0)}
    rows = [(f"s{d}{i}", "ASCENDING", 1, date(2024, 1, d), datetime(2024, 1, d, 6), d * 10 + i, r, r[0][0], 0.0, r[1][0], 1.0) for (d, i), r in footprints.items()]
    scenes = spark.createDataFrame(
        rows, "file_id string, flight_direction string, path_number int, acq_date date, start_time timestamp, pos long, ring array<struct<x:double,y:double>>, minx double, miny double, maxx double, maxy double"
    )
    tracks = spark.createDataFrame(
        [(e, f"{e}_1", "ASCENDING", 1, s, T, datetime(2024, 1, 1), datetime(2024, 2, 1), 0.0, 0.0, 1.0, 1.0) for e, s in (("w", tracker.AWAITING), ("f", tracker.FAILED))],
        "event_id string, track string, flight_direction string, path_number int, status string, event_time timestamp, window_start timestamp, window_end timestamp, minx double, miny double, maxx double, maxy double",
    )
    found = tracker.waiting_input(tracks, scenes)
    assert set(found.columns) == {part.split()[0] for part in tracker.STATE_INPUT.split(", ")}
    assert sorted((r.event_id, r.kind, r.acq_date.day, round(r.area, 9)) for r in found.collect()) == [("w", "mosaic", 12, 0.8), ("w", "mosaic", 13, 1.0)]


def test_sync(spark):
    old, new = (spark.createDataFrame([(x,) for x in v], "event_id string") for v in ("ab", "bc"))
    assert {r.event_id: r.action for r in tracker.sync_actions(old, new).collect()} == {"a": "delete", "b": "update", "c": "insert"}


def test_a_check_of_the_queue_can_be_run_again(spark, tmp_path):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    schema = "file_id string, start_time timestamp, acq_date date, flight_direction string, path_number int, frame_number int, pos long, ring array<struct<x:double,y:double>>, bbox struct<minx:double,miny:double,maxx:double,maxy:double>"
    scenes = lambda *days, p="S1A": spark.createDataFrame([(f"{p}_{d}", datetime(2024, 1, d), date(2024, 1, d), "ASCENDING", 7, 1, d, ring, (0.0, 0.0, 1.0, 1.0)) for d in days], schema)
    quakes = lambda *ids: spark.createDataFrame([(i, "M 6 - X", T, 0.5, 0.5) for i in ids], "event_id string, title string, event_time timestamp, lon double, lat double")
    path, now = str(tmp_path / "queue"), "2024-06-01 00:00:00"
    waits = lambda: sorted(r.event_id for r in sinks.load_tracker(spark, path).collect())
    assert tracker.check_pending(spark, path, "1", quakes("a", "a"), scenes(2), now).count() == 0 and waits() == ["a"]
    away = spark.createDataFrame([("b", 50.0, 50.0, 51.0, 51.0)], "event_id string, minx double, miny double, maxx double, maxy double")
    third = scenes(2).unionByName(scenes(15, p="S1C"))
    assert tracker.check_pending(spark, path, "2", quakes("a", "b"), third, now, away).count() == 0 and waits() == ["a", "b"]
    both = scenes(2, 15)
    assert [r.event_id for r in tracker.check_pending(spark, path, "3", quakes(), both, now, away).collect()] == ["a"] and waits() == ["b"]
    assert [r.event_id for r in tracker.check_pending(spark, path, "3", quakes("c"), both, now).collect()] == ["a"] and waits() == ["b"]  # once more
    done = tracker.check_pending(spark, path, "4", quakes(), both, now).collect()  # without the fault the AOI is the square again
    assert [(r.event_id, r.name, r.reference_date.day) for r in done] == [("b", "m_6_x-A007", 15)] and waits() == []
