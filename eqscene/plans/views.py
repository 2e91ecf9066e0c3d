"""The driver's tables seen as quakes, scenes, areas, jobs and deliveries.

Each view is one SELECT that Spark and DuckDB evaluate alike; it is used as it stands by
the queries (through Spark SQL) and by their SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUAKE = """
SELECT event_id, user_id AS region, ts AS event_time,
       CAST(5 AS DOUBLE) + (event_id % 40) / CAST(10 AS DOUBLE) AS mag,
       (event_id * 7 % 600) / CAST(10 AS DOUBLE) AS depth_km,
       CASE event_id % 6 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'orange' WHEN 3 THEN 'red' WHEN 4 THEN 'pending' END AS alert,
       CAST((event_id * 7919) % 3600 - 1800 AS DOUBLE) AS lon,
       CAST((event_id * 104729) % 1600 - 800 AS DOUBLE) AS lat,
       concat('M ', CAST(event_id % 9 AS VARCHAR(9)), ' - Region ', CAST(user_id AS VARCHAR(20))) AS title,
       concat('Region ', CAST(user_id AS VARCHAR(20))) AS place,
       concat('event/', CAST(event_id AS VARCHAR(20))) AS url
FROM events WHERE event_type = 'error'"""

SCENE = """
SELECT event_id AS pos, concat('S', CAST(event_id AS VARCHAR(20))) AS file_id, user_id AS path_number,
       CASE WHEN user_id % 2 = 0 THEN 'ASCENDING' ELSE 'DESCENDING' END AS flight_direction,
       CAST(event_id % 7 AS INT) AS frame_number, ts AS start_time, CAST(ts AS DATE) AS acq_date,
       CAST(round(value * 100) AS BIGINT) AS area,
       (event_id * 104729) % 3600 - 1800 AS minx, (event_id * 7919) % 1600 - 800 AS miny,
       (event_id * 104729) % 3600 - 1770 AS maxx, (event_id * 7919) % 1600 - 770 AS maxy
FROM events WHERE event_type <> 'error'"""

#: Scenes of each quake's region from ten days before to five days after.
TRACK_SCENE = f"""
SELECT q.event_id, s.path_number AS track, q.event_time, s.acq_date, s.start_time, s.pos, s.file_id AS scene_id,
       s.frame_number, s.flight_direction, s.path_number, s.area
FROM ({QUAKE}) q JOIN ({SCENE}) s ON s.path_number = q.region
WHERE s.start_time BETWEEN q.event_time - INTERVAL 10 DAY AND q.event_time + INTERVAL 5 DAY"""

#: The same scenes with footprints that overlap, over an area of 10 by 10, dated by the week.
_FOOTPRINT_COLUMNS = """
SELECT event_id, track, event_time, CAST(date_trunc('week', start_time) AS DATE) AS acq_date, start_time, pos, scene_id, frame_number,
       CAST(pos * 7 % 9 - 2 AS INT) AS x1, CAST(pos * 11 % 8 - 2 AS INT) AS y1, CAST(pos * 7 % 9 + 2 + pos % 4 AS INT) AS x2, CAST(pos * 11 % 8 + 3 + pos % 3 AS INT) AS y2,
       CAST(0 AS DOUBLE) AS minx, CAST(0 AS DOUBLE) AS miny, CAST(10 AS DOUBLE) AS maxx, CAST(10 AS DOUBLE) AS maxy"""
FOOTPRINT = f"{_FOOTPRINT_COLUMNS} FROM ({TRACK_SCENE})"

#: One-degree areas (in tenths) with a window of ten days each.
AREA = """
SELECT c_custkey AS event_id, (c_custkey * 7919) % 3600 - 1800 AS minx, (c_custkey * 104729) % 1600 - 800 AS miny,
       (c_custkey * 7919) % 3600 - 1790 AS maxx, (c_custkey * 104729) % 1600 - 790 AS maxy,
       TIMESTAMP_NTZ '2024-01-01 00:00:00' + (c_custkey % 20) * INTERVAL 1 DAY AS window_start,
       TIMESTAMP_NTZ '2024-01-11 00:00:00' + (c_custkey % 20) * INTERVAL 1 DAY AS window_end
FROM customer"""

#: Rings of 30 by 20 degrees (in tenths), one for each nation.
LAND = """
SELECT n_nationkey AS ring_id, CAST((n_nationkey * 7919) % 3600 - 1800 AS DOUBLE) AS x1, CAST((n_nationkey * 104729) % 1600 - 800 AS DOUBLE) AS y1,
       CAST((n_nationkey * 7919) % 3600 - 1500 AS DOUBLE) AS x2, CAST((n_nationkey * 104729) % 1600 - 600 AS DOUBLE) AS y2
FROM nation"""

OPTICAL = """
SELECT l_suppkey AS event_id, TIMESTAMP_NTZ '1995-06-17 12:00:00' + (l_suppkey % 30) * INTERVAL 1 DAY AS event_time,
       lpad(CAST(l_linenumber AS VARCHAR(9)), 3, '0') AS orbit_id, concat('T00', CAST(l_partkey % 5 AS VARCHAR(9))) AS tile_id,
       CAST(l_shipdate AS DATE) AS acq_date, CAST(CAST(l_quantity AS INT) % 21 AS DOUBLE) AS cloud_cover,
       l_orderkey * 10 + l_linenumber AS pos, concat('S2A_', CAST(l_orderkey * 10 + l_linenumber AS VARCHAR(20)), '.SAFE') AS granule_id,
       l_partkey % 5 * 2 - 1 AS x1, l_partkey % 2 * 4 AS y1, l_partkey % 5 * 2 + 3 AS x2, l_partkey % 2 * 4 + 6 AS y2,
       CAST(0 AS DOUBLE) AS minx, CAST(0 AS DOUBLE) AS miny, CAST(10 AS DOUBLE) AS maxx, CAST(10 AS DOUBLE) AS maxy
FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP_NTZ '1995-06-17 12:00:00' + (l_suppkey % 30 - 90) * INTERVAL 1 DAY
  AND TIMESTAMP_NTZ '1995-06-17 12:00:00' + (l_suppkey % 30 + 90) * INTERVAL 1 DAY"""

#: Optical scenes and events of a small world of 40 by 40, not yet joined.
OPTICAL_SCENE = """
SELECT o_orderkey AS pos, concat('S2A_', CAST(o_orderkey AS VARCHAR(20)), '.SAFE') AS granule_id, o_orderdate AS start_time,
       CAST(o_orderdate AS DATE) AS acq_date, CAST(o_custkey % 21 AS DOUBLE) AS cloud_cover, lpad(CAST(o_custkey % 3 AS VARCHAR(9)), 3, '0') AS orbit_id,
       concat('T00', CAST(o_orderkey % 4 AS VARCHAR(9))) AS tile_id,
       o_custkey * 7 % 31 AS x1, o_custkey * 11 % 29 AS y1, o_custkey * 7 % 31 + 9 AS x2, o_custkey * 11 % 29 + 11 AS y2
FROM orders"""
OPTICAL_EVENT = """
SELECT s_suppkey AS event_id, s_name AS title, TIMESTAMP_NTZ '1995-06-17 12:00:00' + (s_suppkey % 30) * INTERVAL 1 DAY AS event_time,
       CAST(s_suppkey * 7 % 34 AS DOUBLE) AS minx, CAST(s_suppkey * 5 % 34 AS DOUBLE) AS miny,
       CAST(s_suppkey * 7 % 34 + 6 AS DOUBLE) AS maxx, CAST(s_suppkey * 5 % 34 + 6 AS DOUBLE) AS maxy
FROM supplier"""

_GRANULE = "concat(CASE l_suppkey % 3 WHEN 0 THEN 'S1A_IW_SLC__1SDV_' WHEN 1 THEN 'S1B_IW_SLC__1SSV_' ELSE 'S1C_WV_SLC__1SSH_' END, CAST(l_suppkey % 7 AS VARCHAR(9)))"
_NAME = """concat('m_', CAST(55 + o_orderkey % 30 AS VARCHAR(20)), '_near_place_', CAST(o_custkey % 50 AS VARCHAR(20)), '-',
       CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'D' END, lpad(CAST(o_custkey % 175 AS VARCHAR(20)), 3, '0'))"""


def _job(lists: str) -> str:
    return f"""
SELECT o_orderkey AS pos, {_NAME} AS name, o_custkey, o_orderstatus, {lists}
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderstatus"""


JOB_SPARK = _job(
    f"array_sort(collect_set(CASE WHEN l_linestatus = 'O' THEN {_GRANULE} END)) AS granules, "
    f"array_sort(collect_set(CASE WHEN l_linestatus = 'F' THEN {_GRANULE} END)) AS secondary_granules"
)
JOB_SQL = _job(
    f"coalesce(list_sort(list_distinct(list({_GRANULE}) FILTER (l_linestatus = 'O'))), []) AS granules, "
    f"coalesce(list_sort(list_distinct(list({_GRANULE}) FILTER (l_linestatus = 'F'))), []) AS secondary_granules"
)

DELIVERED = """
SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN CAST(2015 + doc_id % 10 AS VARCHAR(9)) END AS year,
       concat('ev', CAST(doc_id % 20 AS VARCHAR(9))) AS event, concat('dir/prod.', CAST(doc_id AS VARCHAR(20)), '.zip') AS file"""

PAGE_KEY = """
SELECT concat('d/', CAST(page_id % 97 AS VARCHAR(9))) AS dir,
       concat('d/', CAST(page_id % 97 AS VARCHAR(9)), '/p/', CAST(page_id AS VARCHAR(20)), CASE WHEN page_id % 5 = 0 THEN '.png' ELSE '.zip' END) AS key
FROM pages"""


def duck(sql: str) -> str:
    """The text for DuckDB, which has no separate name for timestamps without a zone."""
    return sql.replace("TIMESTAMP_NTZ '", "TIMESTAMP '").replace("VARCHAR(9)", "VARCHAR").replace("VARCHAR(20)", "VARCHAR")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view's rows, over the Parquet tables of a directory."""
    sql = sql.replace("VARCHAR(9)", "STRING").replace("VARCHAR(20)", "STRING")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}" in sql}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(sql, **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fortnight(time: Column) -> Column:
    return F.floor(F.datediff(time, F.lit("1970-01-01").cast("date")) / 15)


def track_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``TRACK_SCENE``, joined on buckets of 15 days besides the region: a quake's window lies in two of them."""
    quakes = view(spark, sf_dir, QUAKE).select(
        "event_id", "region", "event_time", (F.col("event_time") - F.expr("INTERVAL 10 DAY")).alias("least"), (F.col("event_time") + F.expr("INTERVAL 5 DAY")).alias("most")
    ).withColumn("bucket", F.explode(F.sequence(_fortnight(F.col("least")), _fortnight(F.col("most")))))
    scenes = view(spark, sf_dir, SCENE).withColumn("bucket", _fortnight(F.col("start_time")))
    met = quakes.join(scenes, (F.col("region") == F.col("path_number")) & (quakes["bucket"] == scenes["bucket"]) & F.col("start_time").between(F.col("least"), F.col("most")))
    return met.select(
        "event_id", F.col("path_number").alias("track"), "event_time", "acq_date", "start_time", "pos", F.col("file_id").alias("scene_id"),
        "frame_number", "flight_direction", "path_number", "area",
    )


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``FOOTPRINT``."""
    return spark.sql(_FOOTPRINT_COLUMNS + " FROM {scenes}", scenes=track_scenes(spark, sf_dir))
