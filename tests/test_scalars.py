from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eqscene.functions import scalars as s




def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("title", "snake"),
    [
        ("M 5.5 - 128 km NW of Vallenar, Chile", "m_55_128_km_nw_of_vallenar_chile"),
        ("M 7.7 - 2025 Mandalay, Burma (Myanmar) Earthquake", "m_77_2025_mandalay_burma_myanmar_earthquake"),
        ("  Ñuñoa\tà  Ö ", "nunoa_a_o"),
        ("日本", ""),
        ("Việt Nam ﬁn Ａ ½ Ⅳ", "viet_nam_fin_a_12_iv"),
    ],
)
def test_snake_title(spark, title, snake):
    plain = s.snake_title(F.lit(title))
    hyphen = title.replace(" - ", "  ")
    assert value(spark, s.snake_title(F.lit(hyphen))) == snake
    assert value(spark, plain) == snake


def test_name_magnitude_variants(spark):
    got = {n: tuple(value(spark, s.name_magnitude(F.lit(n), k)) for k in ("start", "bounded", "tenths")) for n in ("m_77_x", "m_77", "am_66_", "none")}
    assert got == {"m_77_x": (77, 77, 7.7), "m_77": (77, -1, 7.7), "am_66_": (-1, -1, 6.6), "none": (-1, -1, None)}
    with pytest.raises(ValueError):
        s.name_magnitude(F.lit("m_1"), "other")


def test_job_name_splits_at_the_last_dash(spark):
    rows = spark.createDataFrame([("a-b-A018",), ("nodash",)], "name string").select(*s.split_job_name(F.col("name"))).collect()
    assert [tuple(r) for r in rows] == [("a-b", "A018", False), (None, None, True)]
    assert value(spark, s.track_path(F.lit("ASCENDING18"))) == "18"
    assert value(spark, s.track_path(F.lit("D099"))) == "099"


def test_day_delta_rounds_down_before_the_sign_goes(spark):
    t = F.lit(datetime(2024, 1, 10, 12))
    assert value(spark, s.day_delta(F.lit(date(2024, 1, 8)), t)) == 3
    assert value(spark, s.day_delta(F.lit(date(2024, 1, 12)), t)) == 1
    assert value(spark, s.day_delta(F.lit(date(2024, 1, 10)), t)) == 1


def test_windows_reach_whole_days(spark):
    low, high = s.window_bounds(F.lit(datetime(2024, 3, 1, 5, 6, 7)), 90, 30)
    assert value(spark, low) == datetime(2023, 12, 2)
    assert value(spark, high) == datetime(2024, 3, 31, 23, 59, 59)


def test_footprints(spark):
    ring = value(spark, s.wkt_ring(F.lit("geography'SRID=4326;POLYGON ((0 0, 1 0, 1 2, 0 0))'")))
    assert [(p.x, p.y) for p in ring] == [(0, 0), (1, 0), (1, 2), (0, 0)]
    assert value(spark, s.wkt_ring(F.lit("SRID=4326;POINT (1 2)"))) is None
    assert value(spark, s.wkt_ring(F.lit("POLYGON ((a b, 1 0))"))) is None


def test_small_ones(spark):
    assert value(spark, s.epoch_ms_to_second(F.lit(1700000000999))) == datetime(2023, 11, 14, 22, 13, 20)
    assert value(spark, s.strip_suffix(F.lit("S1A-SLC-SLC"))) == "S1A-SLC"
    assert value(spark, s.iso_second(F.lit("not a time"))) is None
    assert value(spark, s.orbit_id(F.lit("S2A_MSIL1C_2024_N0500_R022_T33UUP_x"))) == "022"
    assert value(spark, s.tile_id(F.lit("S2A_MSIL1C_2024_N0500_R022_T33UUP_x"))) == "33UUP"
    assert value(spark, s.tile_id(F.lit("none"))) is None
    assert value(spark, s.platform(F.lit("S2B_x"))) == "sentinel-2b"
    assert value(spark, s.delivery_key("p", F.lit("2024"), F.lit("e"), F.lit("d/a.b.zip"))) == "p/2024/e/a.b/a.b.zip"
    assert value(spark, s.delivery_key("p", F.lit(None).cast("string"), F.lit("e"), F.lit("a"))) is None
    assert value(spark, s.event_from_path(F.lit("a/b/c/d"))) == "b"
    assert value(spark, s.los_to_phase(F.lit(0.056))) == pytest.approx(12.566371, rel=1e-6)
    assert value(spark, s.direction_code(F.lit("other"))) == "D"
    assert value(spark, s.path3(F.lit(7))) == "007"
