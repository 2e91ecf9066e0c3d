"""Scalar functions: columns in, columns out, all of built-in expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names and settings that processors of the jobs expect (fixed values).
RADAR_JOB_TYPE, OPTICAL_JOB_TYPE = "ARIA_S1_COSEIS", "AUTORIFT"
FILTER_POWER, CHIP_SIZE, SEARCH_RANGE = 0.5, 24, 64

def _decomposed(least: int, most: int) -> dict[str, str]:
    """Characters that a canonical or compatibility decomposition takes apart into ASCII, by rule."""
    return {chr(c): d for c in range(0x80, 0x20000) if least <= len(d := unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) <= most}


_SINGLE, _SEVERAL = _decomposed(1, 1), _decomposed(2, 99)


def epoch_ms_to_second(ms: Column) -> Column:
    """Milliseconds since 1970 as a timestamp, cut to the second."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def snake_title(title: Column) -> Column:
    """Lower-case words joined by underscores; accents and marks dropped."""
    table = F.str_to_map(F.lit("\n".join(f"{c}\t{d}" for c, d in _SEVERAL.items())), F.lit("\n"), F.lit("\t"))
    taken = F.array_join(F.transform(F.split(title, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")
    some = F.when(title.rlike(f"[{''.join(_SEVERAL)}]"), taken).otherwise(title)
    # a plain title is not looked through letter by letter; what is no letter here, beyond ASCII or not, goes in one pass
    plain = F.when(title.rlike(r"[^\x00-\x7F]"), F.translate(some, "".join(_SINGLE), "".join(_SINGLE.values()))).otherwise(title)
    words = F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^A-Za-z0-9_\s]+", ""), r"\s+", " "))
    return F.lower(F.replace(words, F.lit(" "), F.lit("_")))


def square_aoi(lon: Column, lat: Column, side: float = 1.0) -> list[Column]:
    """A square about a point: minx, miny, maxx, maxy."""
    half = side / 2
    return [
        (lon - half).alias("minx"),
        (lat - half).alias("miny"),
        (lon + half).alias("maxx"),
        (lat + half).alias("maxy"),
    ]


def window_bounds(t: Column, before: int, after: int, whole_days: bool = True) -> list[Column]:
    """From ``before`` days before ``t`` to ``after`` days after; whole days reach to 23:59:59."""
    start, stop = t - F.make_dt_interval(F.lit(before)), t + F.make_dt_interval(F.lit(after))
    if whole_days:
        start = F.date_trunc("day", start)
        stop = F.date_trunc("day", stop) + F.make_dt_interval(F.lit(1)) - F.make_dt_interval(secs=F.lit(1))
    return [start.alias("window_start"), stop.alias("window_end")]


def strip_suffix(c: Column, suffix: str = "-SLC") -> Column:
    return F.when(c.endswith(suffix), F.substring(c, F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def strip_archive(c: Column) -> Column:
    return F.replace(c, F.lit(".SAFE"), F.lit(""))


def iso_second(c: Column) -> Column:
    """An ISO time cut to the second; null if it can't be read."""
    return F.date_trunc("second", F.try_to_timestamp(c))


def iso_date(c: Column) -> Column:
    return F.to_date(iso_second(c))


def direction_code(c: Column) -> Column:
    return F.when(c == "ASCENDING", "A").otherwise("D")


def direction_name(code: Column) -> Column:
    return F.when(code == "A", "ASCENDING").otherwise("DESCENDING")


def path3(c: Column) -> Column:
    return F.lpad(c.cast("string"), 3, "0")


def name_magnitude(name: Column, variant: str) -> Column:
    """The number after ``m_``: ``start`` and ``bounded`` as int or -1, ``tenths`` anywhere / 10 or null."""
    if variant == "start":
        pattern = r"^m_(\d+)"
    elif variant == "bounded":
        pattern = r"^m_(\d+)_"
    elif variant == "tenths":
        pattern = r"m_(\d+)"
    else:
        raise ValueError(f"no such variant: {variant}")
    found = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    return found.cast("double") / 10 if variant == "tenths" else F.coalesce(found.cast("int"), F.lit(-1))


def split_job_name(name: Column) -> list[Column]:
    """Event and track, split at the last dash; ``bad_name`` where there is none."""
    pattern = r"^(.*)-([^-]*)$"
    return [
        F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).alias("event_name"),
        F.when(name.contains("-"), F.regexp_extract(name, pattern, 2)).alias("track"),
        (~name.contains("-")).alias("bad_name"),
    ]


def track_direction(track: Column) -> Column:
    return F.when(track.startswith("A"), "Ascending").otherwise("Descending")


def track_path(track: Column) -> Column:
    """What follows the direction, short (A018) or long (ASCENDING18) form."""
    return F.regexp_replace(track, "^(ASCENDING|DESCENDING|A|D)", "")


def orbit_id(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"_R(\d{3})_", 1), F.lit(""))


def tile_id(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"_T(\w{5})_", 1), F.lit(""))


def platform(name: Column) -> Column:
    out = F.lit("sentinel-2")
    for p in ("S2A", "S2B", "S2C"):
        out = F.when(name.startswith(p), f"sentinel-{p[1:].lower()}").otherwise(out)
    return out


def wkt_ring(footprint: Column) -> Column:
    """The outer ring of a (MULTI)POLYGON text after a last semicolon; null if there is none."""
    wkt = F.replace(F.substring_index(footprint, ";", -1), F.lit("'"), F.lit(""))
    ring = F.regexp_extract(wkt, r"^\s*(?:MULTI)?POLYGON\s*\(+\s*([^()]+)\)", 1)
    points = F.transform(
        F.split(F.trim(ring), r"\s*,\s*"),
        lambda p: F.struct(
            F.get(F.split(p, r"\s+"), F.lit(0)).try_cast("double").alias("x"),
            F.get(F.split(p, r"\s+"), F.lit(1)).try_cast("double").alias("y"),
        ),
    )
    return F.when(ring != "", F.when(F.forall(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()), points))


def first_attr(attributes: Column, name: str, default: float = 0.0) -> Column:
    """The value of the first attribute of a name, as a number."""
    hit = F.get(F.filter(attributes, lambda a: a["Name"] == name), F.lit(0))
    return F.coalesce(hit["Value"].try_cast("double"), F.lit(default))


def radar_job(
    title: Column, direction: Column, path: Column, granules: Column, secondary: Column, resolution: Column | int = 90
) -> list[Column]:
    """``name, job_type, job_parameters`` of a radar pair."""
    resolution = F.lit(resolution) if isinstance(resolution, int) else resolution
    return [
        F.concat(title, F.lit("-"), direction_code(direction), path3(path)).alias("name"),
        F.lit(RADAR_JOB_TYPE).alias("job_type"),
        F.struct(
            F.transform(granules, lambda g: strip_suffix(g)).alias("granules"),
            F.transform(secondary, lambda g: strip_suffix(g)).alias("secondary_granules"),
            F.lit(-1).alias("frame_id"),
            F.lit(True).alias("estimate_ionosphere_delay"),
            F.lit(-1).alias("esd_coherence_threshold"),
            F.lit(True).alias("compute_solid_earth_tide"),
            F.lit(FILTER_POWER).alias("goldstein_filter_power"),
            F.lit(True).alias("unfiltered_coherence"),
            F.lit(True).alias("dense_offsets"),
            resolution.cast("int").alias("output_resolution"),
        ).alias("job_parameters"),
    ]


def local_params(
    title: Column, timing: Column, direction: Column, path: Column, frames: Column, reference_date: Column,
    secondary_date: Column, reference: Column, secondary: Column,
) -> Column:
    """The flat parameter object of a local run; its resolution is fixed at 30."""
    return F.struct(
        title.alias("title"),
        timing.alias("timing"),
        direction_name(direction_code(direction)).alias("flight-direction"),
        path.alias("path-number"),
        frames.alias("frame-numbers"),
        reference_date.alias("reference-date"),
        secondary_date.alias("secondary-date"),
        F.transform(reference, lambda g: strip_suffix(g)).alias("reference-scenes"),
        F.transform(secondary, lambda g: strip_suffix(g)).alias("secondary-scenes"),
        F.lit(-1).alias("frame-id"),
        F.lit(True).alias("estimate-ionosphere-delay"),
        F.lit(-1).alias("esd-coherence-threshold"),
        F.lit(True).alias("compute-solid-earth-tide"),
        F.lit(FILTER_POWER).alias("goldstein-filter-power"),
        F.lit(30).alias("output-resolution"),
        F.lit(True).alias("unfiltered-coherence"),
        F.lit(True).alias("dense-offsets"),
    )


def optical_job(title: Column, orbit: Column, before: Column, after: Column, reference: Column, secondary: Column, note: Column) -> list[Column]:
    """``name, job_type, job_parameters, status_note`` of an optical pair; the note is null if complete."""
    return [
        F.concat(title, F.lit("-S2-R"), orbit, F.lit("-"), before, F.lit("_"), after).alias("name"),
        F.lit(OPTICAL_JOB_TYPE).alias("job_type"),
        F.struct(
            F.transform(reference, lambda g: strip_archive(g)).alias("reference"),
            F.transform(secondary, lambda g: strip_archive(g)).alias("secondary"),
            F.lit(CHIP_SIZE).alias("chip_size"),
            F.lit(SEARCH_RANGE).alias("search_range"),
        ).alias("job_parameters"),
        note.alias("status_note"),
    ]


def display_round(c: Column, places: int) -> Column:
    return F.round(c, places)


def day_delta(date: Column, t: Column) -> Column:
    """Days from ``t`` to a date's midnight, rounded down before the sign is dropped."""
    seconds = F.unix_seconds(date.cast("timestamp")) - F.unix_seconds(t.cast("timestamp"))
    return F.abs(F.floor(seconds / 86400)).cast("long")


def delivery_key(prefix: str, year: Column, event: Column, file: Column) -> Column:
    """prefix/year/event/product/file, the product being the file's name without its ending; null without a year."""
    name = F.substring_index(file, "/", -1)
    product = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.when(year.isNotNull(), F.concat_ws("/", F.lit(prefix), year, event, product, name))


def work_path(root: str, title: Column, direction: Column, path: Column, timing: Column, secondary: Column, reference: Column) -> Column:
    code = F.concat(direction_code(direction), path3(path))
    stamp = F.concat(code, F.lit("_"), F.date_format(secondary, "yyyyMMdd"), F.lit("_"), F.date_format(reference, "yyyyMMdd"))
    return F.concat_ws("/", F.lit(root), title, code, timing, stamp)


def set_resolution(job_parameters: Column, resolution: int = 30) -> Column:
    return F.when(job_parameters.isNotNull(), job_parameters.withField("output_resolution", F.lit(resolution)))


def los_to_phase(displacement: Column, wavelength: float = 0.056) -> Column:
    """Displacement along the line of sight as unwrapped phase."""
    return (displacement.cast("double") * F.lit(4.0) * F.pi() / F.lit(wavelength)).cast("float")


def event_from_path(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-3))


def has_failures(status: Column) -> Column:
    """Aggregate: whether any status begins with ``Failed``."""
    return F.coalesce(F.bool_or(status.startswith("Failed")), F.lit(False))
