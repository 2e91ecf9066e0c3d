"""Events that wait for their later scene: discovery, state by track, completion.

States of a track: AWAITING_POST_SEISMIC until a later date covers enough and the job's
result is in, READY_FOR_EMAIL until it is acknowledged, then removed, or
FAILED_NEEDS_ATTENTION (for good) if the job failed. One transition is made per pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eqscene.functions.scalars import has_failures, snake_title
from eqscene.operators.catalog import CELL, resolve_aoi, track_scenes
from eqscene.operators.geo import BOX, mosaic_area
from eqscene.operators.pairing import asof_before, bracket_pair, filter_coverage, mosaics, split_side, with_max_coverage
from eqscene.operators.significance import strong
from eqscene.sources import sinks
from eqscene.sources.sinks import sync_actions as sync_actions

AWAITING, READY, FAILED, REMOVED = "AWAITING_POST_SEISMIC", "READY_FOR_EMAIL", "FAILED_NEEDS_ATTENTION", "REMOVED"


def new_events(events: DataFrame, known: DataFrame, key: str = "event_id") -> DataFrame:
    """Events that are not tracked or pending (or finished within the look-back)."""
    return events.join(known.select(key).distinct(), key, "left_anti")


def discover(feed: DataFrame, known: DataFrame, rules: str = "forward", key: str = "event_id") -> DataFrame:
    """Significant rows first, then the latest of each event, then those not known.

    An event that a later poll revises upwards is found then.
    """
    latest = Window.partitionBy(key).orderBy(F.desc("event_time"), F.desc("revision"))
    rows = feed.filter(strong(rules)).withColumn("__rank", F.row_number().over(latest)).filter("__rank = 1").drop("__rank")
    return new_events(rows, known, key)


def discovery_batch(known_path: str, out_path: str, rules: str = "forward") -> Callable[[DataFrame, int], None]:
    """What is done with one batch of a stream: each batch is held against the snapshot at ``known_path`` and put into both.

    Both are written under the batch's number, and a batch that is run again does not
    hold its own ids against itself: it writes the same rows once more.
    """

    def batch(df: DataFrame, number: int) -> None:
        own = F.col("_metadata.file_path").contains(f"/batch={number}/")
        read = df.sparkSession.read.schema("event_id string").option("recursiveFileLookup", "true")
        known = read.parquet(known_path).filter(~own)
        found = discover(df, known, rules).persist()
        found.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        found.select("event_id").write.mode("overwrite").parquet(f"{known_path}/batch={number}")
        found.unpersist()

    return batch


def discovery_stream(feed: DataFrame, known_path: str, out_path: str, checkpoint: str, rules: str = "forward"):
    """``discover`` for a stream, by ``discovery_batch``."""
    batch = discovery_batch(known_path, out_path, rules)
    return feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(feed: DataFrame, rules: str = "forward", lookback: str = "48 hours", key: str = "event_id") -> DataFrame:
    """A stream's significant rows, each event once: for a sink that keeps no snapshot.

    Rows are told apart after the rules, so an event that a later poll revises upwards is
    given out then; its id is kept for the look-back only. An event that came to nothing is
    not tried again.
    """
    return feed.filter(strong(rules)).withWatermark("event_time", lookback).dropDuplicatesWithinWatermark([key])


def init_tracks(scenes: DataFrame, ratio: float = 0.95) -> DataFrame:
    """A waiting row for each event and track with a covered date before the rupture."""
    return asof_before(scenes, ratio).select(
        "event_id",
        "track",
        F.col("acq_date").alias("reference_date"),
        F.transform("scenes", lambda s: s["scene_id"]).alias("secondary_granules"),
        F.lit(AWAITING).alias("status"),
    )


def complete_partial(partials: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Partial jobs with the granules that were found for their key; those without stay out."""
    later = found.select(*keys, F.col("granules").alias("__granules"))
    return partials.drop("granules").join(later, keys).withColumnRenamed("__granules", "granules")


def next_status(found: Column, result: Column, acknowledged: Column) -> Column:
    """The state after all passes, of whether a later date was found, the result, and its acknowledgement."""
    done = found & result.isNotNull()
    return (
        F.when(~done, AWAITING)
        .when(~acknowledged, READY)
        .when(result.startswith("Failed"), FAILED)
        .otherwise(REMOVED)
    )


def fold_state(tracks: DataFrame, later: DataFrame, results: DataFrame, acks: DataFrame) -> DataFrame:
    """Batch form of ``track_state``: every track's last state, removed ones included."""
    keys = ["event_id", "track"]
    return (
        tracks.select(*keys, "reference_date")
        .join(later.select(*keys, F.col("acq_date").alias("post_date")), keys, "left")
        .join(results.select(*keys, "result"), keys, "left")
        .join(acks.select(*keys, F.lit(True).alias("ack")).distinct(), keys, "left")
        .select(
            *keys,
            "reference_date",
            "post_date",
            next_status(F.col("post_date").isNotNull(), F.col("result"), F.coalesce("ack", F.lit(False))).alias("status"),
        )
    )


STATE_INPUT = (
    "event_id string, track string, kind string, event_time timestamp, acq_date date, start_time timestamp, "
    "pos bigint, area double, result string"
)
STATE_OUTPUT = "event_id string, track string, status string, post_date date"


def waiting_input(tracks: DataFrame, scenes: DataFrame, cell: float = CELL) -> DataFrame:
    """The later mosaics of waiting tracks, as STATE_INPUT rows of the kind ``mosaic``: one for each
    date after the rupture, with the area of the AOI under the union of all its footprints.

    ``tracks``: event_id, track, flight_direction, path_number, status, event_time, box and
    window of the search; ``scenes``: file_id, flight_direction, path_number, acq_date,
    start_time, pos, ring and box. Tracks in other states take no scenes.
    """
    waiting = tracks.filter(F.col("status") == AWAITING)
    keys = ("event_id", "flight_direction", "path_number")
    found = track_scenes(waiting, scenes, cell=cell).join(waiting.select(*keys, "track", "event_time", *BOX), list(keys))
    # grouped by the whole track, so scenes that lie by track stay there
    dates = split_side(found, "post").groupBy(*keys, "track", "event_time", "acq_date", *BOX).agg(
        F.min_by("start_time", "pos").alias("start_time"), F.min("pos").alias("pos"), F.collect_list("ring").alias("rings")
    )
    area = mosaic_area("rings", *(F.col(c).cast("double") for c in BOX))
    none = F.lit(None).cast("string").alias("result")
    return dates.select("event_id", "track", F.lit("mosaic").alias("kind"), "event_time", "acq_date", "start_time", "pos", area.alias("area"), none)


class TrackProcessor(StatefulProcessor):
    """Per (event, track): areas by later date, result and acknowledgement; decides at the end of each batch.

    A ``scene`` adds its area to its date's; a ``mosaic`` says what the whole date covers.

    The greatest coverage is that of later dates seen so far, so the only date may be
    accepted while it is still filling up. Later scenes are never too late: no time-out.
    """

    def __init__(self, ratio: float = 0.95) -> None:
        self.ratio = ratio

    def init(self, handle: StatefulProcessorHandle) -> None:
        # one value, as each call of the state store costs more than what a track's few dates take
        self.state = handle.getValueState("state", "status string, post_date date, result string, days array<int>, areas array<double>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, post_date, result, days, covered = self.state.get() or (AWAITING, None, None, [], [])
        if status == REMOVED:  # nothing is kept of a track that is done, whatever still comes
            return
        before, acknowledged, areas = status, False, {date.fromordinal(d): a for d, a in zip(days, covered, strict=True)}
        for r in rows:
            if r.kind == "scene" and r.start_time > r.event_time:
                areas[r.acq_date] = areas.get(r.acq_date, 0.0) + r.area
            elif r.kind == "mosaic" and r.start_time > r.event_time:
                areas[r.acq_date] = r.area
            elif r.kind == "result":
                result = r.result
            elif r.kind == "ack":
                acknowledged = True
        if status == AWAITING:
            most = max(areas.values(), default=0.0)
            if post_date is None:
                post_date = min((d for d, a in areas.items() if most > 0 and a / most > self.ratio), default=None)
            if post_date is not None and result is not None:
                status = READY
        elif status == READY and acknowledged:
            status = FAILED if result.startswith("Failed") else REMOVED
        if status == REMOVED:
            areas = {}
        self.state.update((status, post_date, result, [d.toordinal() for d in areas], [float(a) for a in areas.values()]))
        if status != before:
            yield Row(event_id=key[0], track=key[1], status=status, post_date=post_date)

    def close(self) -> None:
        pass


def track_state(stream: DataFrame, ratio: float = 0.95) -> DataFrame:
    """Transitions of every track, of a stream of STATE_INPUT rows (RocksDB state store)."""
    return stream.groupBy("event_id", "track").transformWithState(
        statefulProcessor=TrackProcessor(ratio), outputStructType=STATE_OUTPUT, outputMode="Update", timeMode="None"
    )


def collect_finished(state: DataFrame) -> DataFrame:
    """Events all of whose tracks are removed."""
    return state.groupBy("event_id").agg(F.bool_and(F.col("status") == REMOVED).alias("done")).filter("done").select("event_id")


def check_pending(
    spark: SparkSession, path: str, batch: str, new: DataFrame, scenes: DataFrame, now: str, fault: DataFrame | None = None, resolution: int = 90, cell: float = CELL
) -> DataFrame:
    """One check of the queue at ``path``: the jobs of events that leave it.

    ``new`` events (``event_id, title, event_time, lon, lat``) join those that wait. Each
    event's AOI is taken anew, as its fault may have come meanwhile; with any job by the rules
    of v1 over scenes up to ``now`` it leaves the queue, else it stays. Jobs are written
    under the batch before the queue's next version is, so a batch that is run again after a
    failure, or after all, gives the same jobs and the same queue.
    """
    from eqscene.plans.runs import process_events

    columns = "event_id string, title string, event_time timestamp, lon double, lat double"
    new = new.select("event_id", "title", "event_time", "lon", "lat")
    new = new.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in columns.split(", ")))
    saved = sinks.saved_batch(spark, path, batch)
    if not saved:
        old = sinks.load_tracker(spark, path)
        waiting = new if old is None else old.unionByName(new.join(old.select("event_id"), "event_id", "left_anti"))
        waiting = waiting.dropDuplicates(["event_id"])
        none = waiting.select("event_id", *(F.lit(0.0).alias(c) for c in BOX)).limit(0)
        aois = resolve_aoi(waiting, none if fault is None else fault, none)
        made = process_events(waiting.withColumn("title", snake_title(F.col("title"))), aois, scenes, resolution=resolution, cell=cell, rules="v1", until=F.lit(now).cast("timestamp"))
        made.write.mode("overwrite").parquet(f"{path}/jobs/batch={batch}")
        jobs = spark.read.schema(made.schema).parquet(f"{path}/jobs/batch={batch}")
        sinks.save_tracker(waiting.join(jobs.select("event_id").distinct(), "event_id", "left_anti"), path, batch)
    return spark.read.parquet(f"{path}/jobs/batch={batch}")


def resolve_pending(scenes: DataFrame, pending: DataFrame, ratio: float = 0.95) -> DataFrame:
    """``event_id, resolved``: whether any track has an accepted pair."""
    pairs = bracket_pair(filter_coverage(with_max_coverage(mosaics(scenes)), ratio)).select("event_id", F.lit(True).alias("ok")).distinct()
    return pending.select("event_id").join(pairs, "event_id", "left").select("event_id", F.coalesce("ok", F.lit(False)).alias("resolved"))


def completion_summary(processed: DataFrame) -> DataFrame:
    """Jobs per event and track, with whether any failed."""
    return processed.groupBy("event_id", "track").agg(F.count("*").alias("n_jobs"), has_failures(F.col("status")).alias("any_failed"))


def orphans(partials: DataFrame, tracks: DataFrame) -> DataFrame:
    """Partial jobs that no track refers to."""
    return partials.join(tracks.select("event_id", "track"), ["event_id", "track"], "left_anti")
