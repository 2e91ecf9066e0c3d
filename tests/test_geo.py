import numpy as np
import pytest
from pyspark.sql import functions as F

from eqscene.operators import catalog
from eqscene.operators.geo import BOX, banded_areas, mosaic_area, union_area
from eqscene.operators.significance import near_line, significant


def rectangle(rng):
    w, h, turn = rng.uniform(0.2, 1), rng.uniform(0.2, 1), rng.uniform(0, np.pi)
    corners = np.array([(-w, -h), (w, -h), (w, h), (-w, h)]) / 2
    c, s = np.cos(turn), np.sin(turn)
    return corners @ np.array([(c, s), (-s, c)]) + rng.uniform(0, 1, 2)


def test_union_area_against_a_grid():
    rng = np.random.default_rng(0)
    grid = (np.arange(600) + 0.5) / 600
    x, y = np.meshgrid(grid, grid)
    for _ in range(12):
        rings = [rectangle(rng) for _ in range(rng.integers(1, 5))]
        covered = np.zeros(x.shape, bool)
        for r in rings:
            inside = np.zeros(x.shape, bool)
            for a, b in zip(r, np.roll(r, -1, 0), strict=True):
                hit = (a[1] > y) != (b[1] > y)
                with np.errstate(divide="ignore", invalid="ignore"):
                    inside ^= hit & (x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]))
            covered |= inside
        area = union_area(rings, (0, 0, 1, 1))
        assert area == pytest.approx(covered.mean(), abs=3e-3)
        assert area == pytest.approx(union_area(rings[::-1], (0, 0, 1, 1)), rel=1e-9)
        assert area <= sum(union_area([r], (0, 0, 1, 1)) for r in rings) + 1e-12
    assert union_area([], (0, 0, 1, 1)) == 0
    assert union_area([np.array([(0, 0), (1, 0), (1, 1), (0, 1.0)])], (1, 1, 0, 0)) == 0


def test_union_of_many_rings_and_of_one_ring_over_itself():
    rng = np.random.default_rng(1)
    rings = [rectangle(rng) / 40 + rng.uniform(-0.02, 1.02, 2) for _ in range(400)]
    grid = (np.arange(900) + 0.5) / 900
    x, y = np.meshgrid(grid, grid)
    covered = np.zeros(x.shape, bool)
    for r in rings:
        rows = (y[:, 0] >= r[:, 1].min()) & (y[:, 0] <= r[:, 1].max())
        inside = np.zeros((rows.sum(), x.shape[1]), bool)
        for a, b in zip(r, np.roll(r, -1, 0), strict=True):
            hit = (a[1] > y[rows]) != (b[1] > y[rows])
            inside ^= hit & (x[rows] < a[0] + (y[rows] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]))
        covered[rows] |= inside
    assert union_area(rings, (0, 0, 1, 1)) == pytest.approx(covered.mean(), abs=1e-3)
    knot = np.array([(0, 0), (1, 1), (1, 0), (0, 1.0)])  # crosses itself in the middle
    assert union_area([knot], (0, 0, 1, 1)) == pytest.approx(0.5)
    assert union_area([knot] * 3, (0, 0, 1, 1)) == pytest.approx(0.5)


def test_mosaic_column_leaves_out_null_rings(spark):
    square = [(0.0, 0.0), (0.5, 0.0), (0.5, 1.0), (0.0, 1.0)]
    df = spark.createDataFrame([([square, None], 0.0, 0.0, 1.0, 1.0), (None, 0.0, 0.0, 1.0, 1.0)], "rings array<array<struct<x:double,y:double>>>, minx double, miny double, maxx double, maxy double")
    assert [r.a for r in df.select(mosaic_area("rings", *BOX).alias("a")).collect()] == [0.5, 0.0]


def test_near_line_and_significance(spark):
    land = spark.createDataFrame([(0, 0.0, 0.0, 10.0, 0.0), (0, 10.0, 0.0, 10.0, 10.0), (0, 10.0, 10.0, 0.0, 10.0), (0, 0.0, 10.0, 0.0, 0.0)], "ring_id int, x1 double, y1 double, x2 double, y2 double")
    rows = [("inside", 5.0, 5.0), ("near", 10.9, 5.0), ("edge", 11.0, 5.0), ("corner", 10.8, 10.8), ("diagonal", 10.6, 10.6), ("level", -5.0, 10.0), ("null", None, 5.0)]
    points = spark.createDataFrame(rows, "event_id string, lon double, lat double")
    assert {r.event_id for r in near_line(points, land).collect()} == {"inside", "near", "diagonal"}
    quakes = points.withColumns({"mag": F.lit(6.0), "depth_km": F.lit(40.0), "alert": F.when(F.col("event_id") != "near", "green")})
    assert {r.event_id for r in significant(quakes, land).collect()} == {"inside", "diagonal"}
    assert {r.event_id for r in significant(quakes, land, "forward").collect()} == {"inside", "near", "diagonal"}


def test_scene_join_counts_each_pair_once(spark):
    e = spark.sql("SELECT 1 AS event_id, -5.0D AS minx, -5.0D AS miny, 9.0D AS maxx, 9.0D AS maxy, TIMESTAMP '2024-01-01' AS window_start, TIMESTAMP '2024-04-01' AS window_end")
    s = spark.sql("SELECT * FROM VALUES ('a', -9.0D, -9.0D, 12.0D, 12.0D, TIMESTAMP '2024-02-02'), ('touch', 9.0D, 0.0D, 12.0D, 1.0D, TIMESTAMP '2024-02-02'), ('late', 0.0D, 0.0D, 1.0D, 1.0D, TIMESTAMP '2024-04-02') AS t(file_id, minx, miny, maxx, maxy, start_time)")
    assert [r.file_id for r in catalog.scene_events(e, s, 2.0).collect()] == ["a"]


def test_many_mosaics_at_once_and_large_ones_by_bands(spark):
    rng = np.random.default_rng(3)
    box = (0.1, 0.2, 0.9, 0.8)
    mosaics = [[rectangle(rng) for _ in range(n)] for n in (1, 0, 3, 7, 70, 2)]
    rows = [(k, [[(float(a), float(b)) for a, b in r] for r in m], *box) for k, m in enumerate(mosaics)] + [(6, None, *box), (7, [[(0.0, 0.0), (1.0, 1.0)], None], *box), (8, [], None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, rings array<array<struct<x:double,y:double>>>, minx double, miny double, maxx double, maxy double")
    got = {r.k: r.area for r in df.select("k", mosaic_area("rings", *BOX).alias("area")).coalesce(1).collect()}
    want = {k: union_area(m, box) for k, m in enumerate(mosaics)}
    assert got == pytest.approx({**want, 6: 0.0, 7: 0.0, 8: None})
    by_band = {r.k: r.area for r in banded_areas(df.filter("k < 6").select("k", *BOX, F.explode("rings").alias("ring")), ["k"], 0.07).collect()}
    assert by_band == pytest.approx({k: a for k, a in want.items() if mosaics[k]})


def test_rings_with_common_sides_and_corners():
    unit = lambda x, y: np.array([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)], float)
    assert union_area([unit(x, y) for x in range(4) for y in range(4)] * 3, (0, 0, 4, 4)) == pytest.approx(16)
    star = [np.array([(2, 0), (4, 4), (0, 1.5), (4, 1.5), (0, 4)], float)] * 5  # over itself, five times the same
    assert union_area(star, (0, 0, 4, 4)) == pytest.approx(union_area(star[:1], (0, 0, 4, 4)))
    bow = np.array([(0, 0), (2, 2), (2, 0), (0, 2)], float)
    assert union_area([bow, bow[::-1], unit(0, 0)], (0, 0, 2, 2)) == pytest.approx(2.5)


@pytest.mark.parametrize("few", [400_000, 0])
def test_areas_alike_are_searched_once_and_each_gets_its_scenes(spark, monkeypatch, few):
    """Areas with the same box and window are searched once (each was searched by itself before); the rows are those of a plain join."""
    monkeypatch.setattr("eqscene.operators.catalog.FEW", few)
    day = lambda n: F.make_timestamp(F.lit(2024), F.lit(1), n, F.lit(0), F.lit(0), F.lit(0))
    n = F.col("event_id")
    areas = spark.range(30).withColumnRenamed("id", "event_id").select("event_id", (n % 3).alias("minx"), (n % 2).alias("miny"), (n % 3 + 1).alias("maxx"), (n % 2 + 1).alias("maxy"), day(F.lit(2)).alias("window_start"), day((n % 2 + 5).cast("int")).alias("window_end"))
    i = F.col("pos")
    scenes = spark.range(40).withColumnRenamed("id", "pos").select("pos", i.cast("string").alias("file_id"), (i % 4).alias("path_number"), F.lit("ASCENDING").alias("flight_direction"), (i % 3).cast("int").alias("frame_number"), day((i % 8 + 1).cast("int")).alias("start_time"), (i % 5 / 2).alias("minx"), (i % 3 / 2).alias("miny"), (i % 5 / 2 + 1).alias("maxx"), (i % 3 / 2 + 1).alias("maxy"))
    one, members = catalog.shared(areas, "minx", "miny", "maxx", "maxy", "window_start", "window_end")
    assert one.count() == 6 and members.count() == 30
    a, s = areas.alias("a"), scenes.alias("s")
    plain = a.join(s, (F.col("a.minx") < F.col("s.maxx")) & (F.col("s.minx") < F.col("a.maxx")) & (F.col("a.miny") < F.col("s.maxy")) & (F.col("s.miny") < F.col("a.maxy")) & F.col("start_time").between(F.col("window_start"), F.col("window_end")))
    pairs = sorted(map(tuple, plain.select("event_id", "file_id").collect()))
    assert len(pairs) > 100 and sorted(map(tuple, catalog.listed_scenes(areas, scenes, "aoi", 1.0).select("event_id", "file_id").collect())) == pairs
    frames = plain.select("event_id", "path_number", "frame_number", "window_start", "window_end").distinct().join(scenes, ["path_number", "frame_number"]).filter("start_time BETWEEN window_start AND window_end")
    assert sorted(map(tuple, catalog.listed_scenes(areas, scenes, "frame", 1.0).select("event_id", "file_id").collect())) == sorted(map(tuple, frames.select("event_id", "file_id").collect()))
