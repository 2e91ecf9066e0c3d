import pytest

from eqscene.operators import delivery, jobs

SCHEMA = "pos long, name string, granules array<string>, secondary_granules array<string>"
ROWS = [
    (0, "m_60_a-A001", ["S1A_IW_1SDV_1", "S1A_IW_1SDV_2"], ["S1A_IW_1SDV_0"]),
    (1, "m_70_b-A001", ["S1A_IW_1SDV_1", "S1A_IW_1SDV_2"], ["S1A_IW_1SDV_0"]),
    (2, "m_70_c-D002", ["S1A_IW_1SDV_1", "S1A_IW_1SDV_2"], ["S1A_IW_1SDV_0"]),
    (3, "m_50_a-A001", ["S1A_IW_1SDV_2", "S1A_IW_1SDV_1"], ["S1A_IW_1SDV_0"]),
    (4, "m_61_d-A001", ["S1C_WV_1SSV_9"], ["S1A_IW_1SSH_8"]),
    (5, "nodash", [], None),
]


@pytest.fixture
def listed(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_dedupe(listed):
    kept, removed = jobs.dedupe_jobs(listed)
    assert sorted(r.pos for r in kept.collect()) == [1, 3, 4, 5]
    assert sorted(r.pos for r in removed.collect()) == [0, 2]
    assert sorted(r.pos for r in jobs.dedupe_jobs(listed, "sorted")[0].collect()) == [1, 4, 5]
    with pytest.raises(ValueError):
        jobs.dedupe_jobs(listed, "other")


def test_conformance_and_groups(listed):
    yes, no = jobs.conforming(listed)
    assert [r.pos for r in no.collect()] == [4] and yes.count() == 5
    assert sorted(r.pos for r in jobs.exclude_platform(listed).collect()) == [0, 1, 2, 3, 5]
    assert {r.frame_group: r.n_jobs for r in jobs.frame_groups(listed).collect()} == {"mismatched": 4, "1": 1, "0": 1}


def test_counts(listed):
    assert tuple(jobs.job_summary(listed).first()) == (5, 6)
    assert {r.event_name: (r.num_tracks, r.tracks) for r in jobs.tracks_per_event(listed).collect()}["m_70_b"] == (1, "A001")
    funnel = {r.step: (r.n_events, r.n_jobs) for r in jobs.curation_funnel(listed).collect()}
    assert funnel == {"all": (5, 6), "deduplicated": (3, 4), "conforming": (2, 3)}
    parts = jobs.curate(listed)
    assert parts["kept"].count() + parts["removed"].count() + parts["nonconforming"].count() == 6


def test_delivery(spark):
    expected = spark.createDataFrame([("p/1/a.zip",), ("p/2/b.zip",)], "key string")
    listing = spark.createDataFrame([("p/1/a.zip",), ("p/1/x/a.png",), ("q/c.png",)], "key string")
    assert [r.key for r in delivery.missing(expected, listing).collect()] == ["p/2/b.zip"]
    assert tuple(delivery.delivery_totals(expected, listing).first()) == (1, 1)
    dirs = spark.createDataFrame([("p/1",), ("p/2",), ("p",), ("p/1",)], "dir string")
    assert [r.dir for r in delivery.dirs_without(dirs, listing).collect()] == ["p/2"]
    manifest = spark.createDataFrame([("e-A001", None, [("a.zip",)], None), ("e-A001", "2024", [("d/a.zip",)], ["b.png"])], "name string, year string, files array<struct<filename:string>>, browse_images array<string>")
    assert sorted(r.key for r in delivery.expected_keys(manifest, "s").collect()) == ["s/2024/e/a/a.zip", "s/2024/e/b/b.png"]
