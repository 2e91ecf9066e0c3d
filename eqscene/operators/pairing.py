"""Mosaics of a date, their coverage, and the pairs of dates about a rupture.

Input is one row per event, track and scene: ``event_id, track, event_time, acq_date,
start_time, pos, scene_id`` and, where needed, ``frame_number``; and either ``ring``, the
footprint, and the box of the event's AOI, or ``area``. The coverage of a mosaic is the
area of the AOI that the union of its footprints covers; areas are added up, so they must
be of scenes that do not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eqscene.operators.geo import BOX, mosaic_area

KEYS = ("event_id", "track")


def _side(kind: str) -> Column:
    t = F.col("start_time")
    return t < F.col("event_time") if kind == "pre" else t > F.col("event_time")


def split_side(df: DataFrame, kind: str) -> DataFrame:
    """Strictly before (``pre``) or after (``post``) the rupture."""
    return df.filter(_side(kind))


def has_footprints(scenes: DataFrame) -> bool:
    return {"ring", *BOX} <= set(scenes.columns)


def _dates(scenes: DataFrame, covers: dict[str, Column], *others: Column, dealt: bool = False) -> DataFrame:
    """One row per date, with the coverage of the scenes for which each of ``covers`` holds (null: of none).

    ``dealt`` scenes lie by track already (``catalog.dealt``) and are not moved again.
    """
    united = has_footprints(scenes)
    what = "ring" if united else "area"
    fold = F.collect_list if united else F.sum
    dates = (
        (scenes if dealt else scenes.repartition(*KEYS))
        .groupBy(*KEYS, "event_time", "acq_date", *(BOX if united else ()))
        .agg(*(fold(F.when(c, F.col(what))).alias(n) for n, c in covers.items()), *(F.max(c).alias(f"__{n}") for n, c in covers.items()), *others)
    )
    if united:
        dates = dates.withColumns({n: F.when(F.col(f"__{n}"), mosaic_area(F.col(n), *BOX)) for n in covers}).drop(*BOX)
    return dates.drop(*(f"__{n}" for n in covers))


def mosaics(scenes: DataFrame, *others: Column, dealt: bool = False) -> DataFrame:
    """One row per date: coverage, scenes in input order, the first scene's time, and ``others``.

    Rows are dealt out by (event, track), a part of the grouping key, so that the windows
    over tracks that follow need no exchange of their own.
    """
    return _dates(
        scenes,
        {"coverage": F.lit(True)},
        F.min_by("start_time", "pos").alias("start_time"),
        F.count("*").alias("n_scenes"),
        F.array_sort(F.collect_list(F.struct("pos", "scene_id"))).alias("scenes"),
        *others,
        dealt=dealt,
    )


def with_max_coverage(df: DataFrame) -> DataFrame:
    return df.withColumn("max_coverage", F.max("coverage").over(Window.partitionBy(*KEYS)))


def filter_coverage(df: DataFrame, ratio: float = 0.95) -> DataFrame:
    """Strictly more than ``ratio`` of the track's greatest coverage, which must be positive."""
    return df.filter((F.col("max_coverage") > 0) & (F.col("coverage") / F.col("max_coverage") > ratio))


def frames_complete(scenes: DataFrame) -> DataFrame:
    """Dates each of whose scenes has a frame of its own."""
    return (
        scenes.groupBy(*KEYS, "event_time", "acq_date")
        .agg(F.count("*").alias("n_scenes"), F.count_distinct("frame_number").alias("n_frames"))
        .filter("n_scenes = n_frames")
    )


def _asof(scenes: DataFrame, ratio: float, kind: str) -> DataFrame:
    """Scenes are sorted to a side one by one, then grouped. The greatest coverage is that of all
    dates before the rupture's search (``pre``), of later dates only (``post``).
    """
    grouped = _dates(
        scenes,
        {"whole": F.lit(True), "coverage": _side(kind)},
        F.array_sort(F.collect_list(F.when(_side(kind), F.struct("pos", "scene_id")))).alias("scenes"),
    )
    most = F.max("whole" if kind == "pre" else "coverage").over(Window.partitionBy(*KEYS))
    order = F.desc("acq_date") if kind == "pre" else F.asc("acq_date")
    return (
        filter_coverage(grouped.withColumn("max_coverage", most).filter("coverage IS NOT NULL"), ratio)
        .withColumn("rank", F.row_number().over(Window.partitionBy(*KEYS).orderBy(order)))
        .filter("rank = 1")
        .drop("rank", "whole")
    )


def asof_before(scenes: DataFrame, ratio: float = 0.95) -> DataFrame:
    """The latest date before the rupture with enough coverage."""
    return _asof(scenes, ratio, "pre")


def asof_after(scenes: DataFrame, ratio: float = 0.95) -> DataFrame:
    """The earliest date after the rupture with enough coverage."""
    return _asof(scenes, ratio, "post")


def _next(column: str) -> Column:
    return F.lead(column).over(Window.partitionBy(*KEYS).orderBy("acq_date"))


def _pair(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "event_time", "secondary_date", "reference_date", "secondary_scenes", "reference_scenes")


def _with_next(df: DataFrame) -> DataFrame:
    return df.select(
        *KEYS,
        "event_time",
        F.col("acq_date").alias("secondary_date"),
        F.col("scenes").alias("secondary_scenes"),
        F.col("start_time").alias("t1"),
        _next("acq_date").alias("reference_date"),
        _next("scenes").alias("reference_scenes"),
        _next("start_time").alias("t2"),
    ).filter("reference_date IS NOT NULL")


def bracket_pair(accepted: DataFrame) -> DataFrame:
    """The first neighbouring dates with one before and one after the rupture, both strictly."""
    first = F.row_number().over(Window.partitionBy(*KEYS).orderBy("secondary_date"))
    return _pair(_with_next(accepted).filter("t1 < event_time AND event_time < t2").withColumn("rank", first).filter("rank = 1"))


def sequential_pairs(accepted: DataFrame, kind: str) -> DataFrame:
    """Each date with the next, on one side of the rupture."""
    return _pair(_with_next(split_side(accepted, kind)))


def all_pairs(accepted: DataFrame, kind: str) -> DataFrame:
    """Each date with every later one, on one side of the rupture. A track has a few dozen dates."""
    own = split_side(accepted, kind)
    a = own.select(*KEYS, "event_time", F.col("acq_date").alias("secondary_date"), F.col("scenes").alias("secondary_scenes"))
    b = own.select(*KEYS, F.col("acq_date").alias("reference_date"), F.col("scenes").alias("reference_scenes"))
    return _pair(a.join(b, list(KEYS)).filter("secondary_date < reference_date"))


MODES = ("coseismic", "sequential", "all")


def radar_pairs(scenes: DataFrame, mode: str = "coseismic", ratio: float = 0.95, rules: str = "v2", dealt: bool = False) -> DataFrame:
    """Pairs with their ``timing``. ``v1`` accepts dates by complete frames and compares whole days."""
    if mode not in MODES:
        raise ValueError(f"no such pairing mode: {mode}")
    if rules == "v1":  # frames are counted with the mosaics, as ``frames_complete`` counts them, so scenes are met once
        dates = mosaics(scenes, F.size(F.collect_set("frame_number")).alias("n_frames"), dealt=dealt).filter("n_scenes = n_frames")
        dates = dates.withColumn("event_time", F.date_trunc("day", "event_time")).withColumn(
            "start_time", F.col("acq_date").cast(scenes.schema["start_time"].dataType)
        )
    else:
        dates = filter_coverage(with_max_coverage(mosaics(scenes, dealt=dealt)), ratio)
    if mode == "coseismic":
        return bracket_pair(dates).withColumn("timing", F.lit("co-seismic"))
    more = sequential_pairs if mode == "sequential" else all_pairs
    return (
        more(dates, "pre")
        .withColumn("timing", F.lit("pre_seismic"))
        .unionByName(bracket_pair(dates).withColumn("timing", F.lit("co_seismic")))
        .unionByName(more(dates, "post").withColumn("timing", F.lit("post_seismic")))
    )
