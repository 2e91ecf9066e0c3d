"""Operator 7: benchmark decontamination by winnowing.

Words are maximal runs of digits, a-z and non-ASCII characters after A-Z has been
lowered. Hashes of ``GRAM`` consecutive words are winnowed: of every ``SPAN``
consecutive hashes the least is kept. With ``GRAM + SPAN - 1 = 13`` any shared run of
13 words has a kept hash in common, in documents and items alike, so joining the kept
hashes finds every document that can hold a window. Items of fewer than 13 words are
one window each; their hash is looked for at every position, for the (at most 12)
lengths that occur.

Only documents with a joined fingerprint go on: their windows are joined with the
items' on two 64-bit hashes, and neighbouring hits are merged into spans, which gives
the words hit. Fingerprints are exploded without the text, and texts are read a second
time for candidates only.

The item side is broadcast when its bytes, added up, stay under a bound; beyond that the
same joins are shuffled.

Edge cases: null or empty texts have no words and are clean; every row has its row in the
result, repeated ones too; rows of one doc_id with unlike texts are judged apart; a null doc_id is kept as null; repeated items count once
per item_id, a null item_id as the text ``null``; an empty benchmark leaves all clean;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eqscene.llm._common import broadcast_if_small, staged, whole_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
GRAM = 6
SPAN = WINDOW - GRAM + 1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lowered and nothing else; plain ``lower`` serves texts that are all ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _positions(words: Column, width: int) -> Column:
    """1 .. number of runs of ``width`` words; empty if there is none."""
    n = F.size(words) - (width - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _grams(words: Column, width: int) -> Column:
    return F.transform(_positions(words, width), lambda i: F.xxhash64(F.slice(words, i, width)))


def _kept(grams: Column) -> Column:
    """The least of every SPAN neighbouring hashes, without repeats."""
    n = F.size(grams) - (SPAN - 1)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.array_min(F.slice(grams, i, SPAN))))


def _windows(words: Column, width: int) -> Column:
    return F.transform(
        _positions(words, width),
        lambda i: F.struct(
            i.alias("at"),
            F.lit(width).alias("width"),
            F.xxhash64(F.slice(words, i, width)).alias("h1"),
            F.xxhash64(F.lit(width), F.slice(words, i, width)).alias("h2"),
        ),
    )


def _key() -> Column:
    return F.xxhash64(F.col("doc_id"), whole_text()).alias("doc_key")


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, doc_key, n_words, n_hit, item_ids``.

    ``doc_key`` hashes doc_id and text and tells rows of one doc_id apart.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        words_of(whole_text()).alias("words"),
    ).filter(F.size("words") > 0)
    items = staged(items, "items")
    short = sorted(
        r[0]
        for r in items.filter(F.size("words") < WINDOW).select(F.size("words").alias("n")).distinct().collect()
    )  # at most 12 numbers

    item_marks = (
        items.withColumn("grams", _grams(F.col("words"), GRAM))
        .select(
            F.explode(
                F.when(F.size("words") >= WINDOW, _kept(F.col("grams"))).otherwise(
                    F.array(F.xxhash64(F.col("words")))
                )
            ).alias("mark")
        )
        .distinct()
    )
    item_marks = broadcast_if_small(staged(item_marks.withColumn("found", F.lit(True)), "marks"))

    worded = docs.select("doc_id", _key(), words_of(whole_text()).alias("words"))
    marked = worded.select("doc_id", "doc_key", "words", _grams(F.col("words"), GRAM).alias("grams"))
    marks = F.concat(_kept(F.col("grams")), *[_grams(F.col("words"), m) for m in short])
    seen = (
        marked.select("doc_id", "doc_key", F.size("words").cast("long").alias("n_words"), marks.alias("marks"))
        .select("doc_id", "doc_key", "n_words", F.posexplode_outer("marks").alias("place", "mark"))
        .join(item_marks, "mark", "left")
        .groupBy("doc_id", "doc_key", "n_words")
        .agg(
            F.coalesce(F.bool_or("found"), F.lit(False)).alias("candidate"),
            F.count_if(F.coalesce("place", F.lit(0)) == 0).cast("int").alias("copies"),
        )
    )
    seen = staged(seen, "seen")

    candidates = broadcast_if_small(
        seen.filter("candidate").select(F.col("doc_id").alias("c_id"), F.col("doc_key").alias("c_key"))
    )
    item_windows = broadcast_if_small(staged(
        items.select(
            "item_id",
            F.when(F.size("words") >= WINDOW, _windows(F.col("words"), WINDOW))
            .otherwise(
                F.array(
                    F.struct(
                        F.lit(1).alias("at"),
                        F.size("words").alias("width"),
                        F.xxhash64(F.col("words")).alias("h1"),
                        F.xxhash64(F.size("words"), F.col("words")).alias("h2"),
                    )
                )
            )
            .alias("w"),
        )
        .select("item_id", F.inline("w"))
        .select("item_id", "width", "h1", "h2")
        .distinct(),
        "windows",
    ))
    chosen = docs.select("doc_id", _key(), whole_text().alias("text")).join(
        candidates,
        F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("doc_key") == F.col("c_key")),
        "left_semi",
    )
    words = F.col("words")
    matches = staged(
        chosen.select("doc_id", "doc_key", words_of(F.col("text")).alias("words"))
        .dropDuplicates(["doc_id", "doc_key"])
        .select("doc_id", "doc_key", F.inline(F.concat(*[_windows(words, m) for m in (WINDOW, *short)])))
        .join(item_windows, ["width", "h1", "h2"])
        .select("doc_id", "doc_key", "at", "width", "item_id"),
        "matches",
    )
    hits = matches.groupBy("doc_id", "doc_key", "at").agg((F.col("at") + F.max("width")).alias("end"))
    found = (
        matches.select("doc_id", "doc_key", "item_id")
        .distinct()
        .groupBy(F.col("doc_id").alias("f_id"), F.col("doc_key").alias("f_key"))
        .agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )
    before = (
        Window.partitionBy("doc_id", "doc_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    )
    fresh = F.greatest(
        F.lit(0), F.col("end") - F.greatest(F.col("at"), F.coalesce(F.max("end").over(before), F.col("at")))
    )
    hit = (
        hits.withColumn("fresh", fresh)
        .groupBy(F.col("doc_id").alias("h_id"), F.col("doc_key").alias("h_key"))
        .agg(F.sum("fresh").cast("long").alias("n_hit"))
        .join(found, F.col("h_id").eqNullSafe(F.col("f_id")) & (F.col("h_key") == F.col("f_key")))
        .select("h_id", "h_key", "n_hit", "item_ids")
    )
    return (
        seen.join(hit, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("doc_key") == F.col("h_key")), "left")
        .select(
            "doc_id",
            "doc_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
        )
        .drop("copy")
    )


def is_contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = (
        find_contamination(docs, benchmark)
        .filter(is_contaminated())
        .select(F.col("doc_id").alias("bad_id"), F.col("doc_key").alias("bad_key"))
    )
    bad = broadcast_if_small(staged(bad, "contaminated"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), _key().alias("key"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key")), "left_anti").select("row.*")
