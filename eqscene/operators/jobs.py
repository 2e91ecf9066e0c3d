"""Curation of job lists: deduplicate, check, split, count.

A job is ``name, granules, secondary_granules`` and what else it has; ``pos`` is its place
in the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eqscene.functions.scalars import name_magnitude, split_job_name, track_direction, track_path


def _key(key: str) -> list[Column]:
    pair = (F.coalesce("granules", F.array()), F.coalesce("secondary_granules", F.array()))
    if key == "ordered":
        return list(pair)
    if key == "sorted":
        return [F.array_sort(c) for c in pair]
    raise ValueError(f"no such key: {key}")


def ranked(jobs: DataFrame, key: str = "ordered") -> DataFrame:
    """``jobs`` with ``keep``: the greatest magnitude of each pair of granule lists, then the earlier."""
    magnitude = name_magnitude(F.col("name"), "start" if key == "ordered" else "bounded")
    w = Window.partitionBy("__key").orderBy(F.desc("__mag"), "pos")
    return (
        jobs.withColumn("__key", F.md5(F.to_json(F.struct(*_key(key)))))
        .withColumn("__mag", magnitude)
        .withColumn("keep", F.row_number().over(w) == 1)
        .drop("__key", "__mag")
    )


def dedupe_jobs(jobs: DataFrame, key: str = "ordered") -> tuple[DataFrame, DataFrame]:
    """Kept and removed jobs."""
    flagged = ranked(jobs, key)
    return flagged.filter("keep").drop("keep"), flagged.filter("NOT keep").drop("keep")


def conforms() -> Column:
    """Every granule of both lists is in the wide mode and of a vertical polarisation."""
    every = F.concat(F.coalesce("granules", F.array()), F.coalesce("secondary_granules", F.array()))
    return F.forall(every, lambda g: g.contains("IW") & (g.contains("1SDV") | g.contains("1SSV")))


def conforming(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    return jobs.filter(conforms()), jobs.filter(~conforms())


def exclude_platform(jobs: DataFrame, prefix: str = "S1C_") -> DataFrame:
    """Jobs without any granule of a platform."""
    every = F.concat(F.coalesce("granules", F.array()), F.coalesce("secondary_granules", F.array()))
    return jobs.filter(~F.exists(every, lambda g: g.startswith(prefix)))


def frame_group() -> Column:
    """The common length of both lists, or ``mismatched``."""
    n, m = F.size(F.coalesce("granules", F.array())), F.size(F.coalesce("secondary_granules", F.array()))
    return F.when(n == m, n.cast("string")).otherwise("mismatched")


def frame_groups(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(frame_group().alias("frame_group")).agg(F.count("*").alias("n_jobs"))


def named(jobs: DataFrame) -> DataFrame:
    """``jobs`` with event, track, direction and path of their names."""
    out = jobs.select("*", *split_job_name(F.col("name")))
    return out.withColumn("direction", track_direction(F.col("track"))).withColumn("path", track_path(F.col("track")))


def job_summary(jobs: DataFrame) -> DataFrame:
    return named(jobs).agg(F.count_distinct("event_name").alias("n_events"), F.count("*").alias("n_jobs"))


def tracks_per_event(jobs: DataFrame) -> DataFrame:
    return (
        named(jobs)
        .filter("NOT bad_name")
        .groupBy("event_name")
        .agg(F.count_distinct("track").alias("num_tracks"), F.array_join(F.array_sort(F.collect_set("track")), " ").alias("tracks"))
    )


def flagged(jobs: DataFrame) -> DataFrame:
    """``jobs`` with ``keep`` (of ``ranked``), ``ok`` (conforming), ``frame_group`` and the parts of their names."""
    return named(ranked(jobs)).withColumns({"ok": conforms(), "frame_group": frame_group()})


def curation_funnel(jobs: DataFrame) -> DataFrame:
    """Events and jobs after each step, in one pass: all, deduplicated, conforming."""
    return _funnel(flagged(jobs))


def _funnel(flags: DataFrame) -> DataFrame:
    done = F.col("keep") & F.col("ok")
    steps = (("all", F.lit(True)), ("deduplicated", F.col("keep")), ("conforming", done))
    # an event's rows become one before events are counted
    each = flags.groupBy("event_name").agg(*(F.count_if(c).alias(s) for s, c in steps))
    counted = each.agg(*(F.coalesce(F.sum(s), F.lit(0)).alias(f"{s}_jobs") for s, _ in steps), *(F.count_if((F.col(s) > 0) & F.col("event_name").isNotNull()).alias(f"{s}_events") for s, _ in steps))
    rows = F.array(
        *(
            F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.col(f"{s}_events").alias("n_events"), F.col(f"{s}_jobs").alias("n_jobs"))
            for i, (s, _) in enumerate(steps)
        )
    )
    return counted.select(F.inline(rows))


def curate(jobs: DataFrame) -> dict[str, DataFrame]:
    """All outputs of the curation, from one flagged frame that is written once (one scan and one window for all of them)."""
    from eqscene.plans.landing import staged

    flags = staged(flagged(jobs), "curation")
    added = ("keep", "ok", "event_name", "track", "bad_name", "direction", "path")
    kept = flags.filter("keep AND ok").drop(*(c for c in added if c not in jobs.columns))
    return {
        "kept": kept,
        "removed": flags.filter("NOT keep").drop("keep", "ok"),
        "nonconforming": flags.filter("keep AND NOT ok").drop("keep", "ok"),
        "groups": frame_groups(kept),
        "summary": job_summary(kept),
        "tracks": tracks_per_event(kept),
        "funnel": _funnel(flags),
    }
