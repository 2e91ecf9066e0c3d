"""Operator 8: line deduplication by a deletion-neighbourhood join.

A line goes if an equal line, or one within one edit (a character put in, taken out or
replaced), stands earlier in the corpus, by (doc_id, line number); earlier lines count
whether they stay or go. Lines that are blank stay; lines of fewer than ``FUZZY_FROM``
characters go for equal lines only.

Deleting any one character of a line gives its variants. Two lines are within one edit
if one is a variant of the other, or if both have a variant in common by deletion at the
same place. So each variant is emitted as a hashed key (with and without its place), and
per key only the earliest line of each kind is kept and joined back: no pairs of a
group are formed. The candidate that comes back is verified by edit distance.

Two narrowing joins precede it, neither of which can lose a pair: within one edit, two
lines agree in their first or last half, and then outside one block of ``BLOCK``
characters. Variants are emitted only within blocks whose surroundings agree with
another line's, which also keeps very long lines near-linear.

Edge cases: a null text is kept as it is and has no lines; an empty text is one blank
line; rows that share a doc_id share positions, so repeated rows keep the same lines
and do not remove each other's; null doc_ids come first; an empty table gives no rows;
all other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import broadcast_if_small, staged, whole_text

FUZZY_FROM = 16
BLOCK = 64


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line`` of all lines that are not blank."""
    return (
        docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .filter(F.col("line").rlike(r"\S"))
        .select("doc_id", "line_no", "line")
    )


def _name() -> list[Column]:
    """Two 64-bit hashes of a line, which stand for it in shuffles."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]


def _halves() -> Column:
    """Keys of the first and last half, for the length of the shorter line of a pair."""
    line, length = F.col("line"), F.char_length("line")
    keys = []
    for n in (length - 1, length):
        half = (n / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), n, F.left(line, half)))
        keys.append(F.xxhash64(F.lit("last"), n, F.right(line, n - half)))
    return F.when(length >= FUZZY_FROM, F.array(*keys)).otherwise(F.array().cast("array<bigint>"))


def _blocks() -> Column:
    """(key, block) of what surrounds each block, for both lengths of the shorter line."""
    line, length = F.col("line"), F.char_length("line")

    def around(n: Column) -> Column:
        def block(j: Column) -> Column:
            rest = F.greatest(n - BLOCK * (j + 1), F.lit(0))
            key = F.xxhash64(n, j, F.left(line, BLOCK * j), F.right(line, rest))
            return F.struct(key.alias("key"), j.alias("block"))

        return F.transform(F.sequence(F.lit(0), (n / BLOCK).cast("int")), block)

    return F.concat(around(length - 1), around(length))


def _variants() -> Column:
    """(key, kind) for the line itself and each deletion within ``block``.

    Kinds: 0 the line as a variant of a longer one, 1 a variant without its place,
    2 a variant with its place, for replacements.
    """
    line, length, start = F.col("line"), F.char_length("line"), BLOCK * F.col("block")
    before = F.xxhash64(F.left(line, start))
    after = F.xxhash64(F.substring(line, start + BLOCK + 1, length))
    own = F.struct(
        F.xxhash64(
            before, F.substring(line, start + 1, F.lit(BLOCK - 1)), F.xxhash64(F.substring(line, start + BLOCK, length))
        ).alias("key"),
        F.lit(0).alias("kind"),
    )

    def rest(i: Column) -> Column:  # i: 0-based place of the deletion
        return F.concat(F.substring(line, start + 1, i - start), F.substring(line, i + 2, start + BLOCK - 1 - i))

    inside = F.when(start < length, F.sequence(start, F.least(start + BLOCK, length) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.concat(
        F.array(own),
        F.transform(inside, lambda i: F.struct(F.xxhash64(before, rest(i), after).alias("key"), F.lit(1).alias("kind"))),
        F.transform(
            inside,
            lambda i: F.struct(F.xxhash64(before, rest(i), after, length, i).alias("key"), F.lit(2).alias("kind")),
        ),
    )


def _shared(keyed: DataFrame, keep: list[str]) -> DataFrame:
    """The distinct ``keep`` columns of rows whose ``key`` occurs with several lines."""
    often = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    return keyed.join(often, "key").select(*keep).distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``h1, h2, first, near``: lines that occur again, or come near an earlier line.

    ``first`` is the earliest (doc_id, line_no) of the line; ``near`` says that even
    that one goes.
    """
    known = staged(
        _lines(docs)
        .select("doc_id", "line_no", *_name(), _halves().alias("halves"))
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "line_no")).alias("first"),
            F.count("*").alias("n"),
            F.first("halves").alias("halves"),
        ),
        "lines",
    )
    alike = staged(_shared(known.select("h1", "h2", "first", F.explode("halves").alias("key")), ["h1", "h2", "first"]), "alike")
    wanted = broadcast_if_small(alike)
    texts = staged(
        _lines(docs)
        .select("line", F.struct("doc_id", "line_no").alias("at"), *_name())
        .join(wanted, ["h1", "h2"])
        .filter(F.col("at").eqNullSafe(F.col("first")))
        .select("h1", "h2", "first", "line")
        .dropDuplicates(["h1", "h2"]),
        "texts",
    )
    near_blocks = _shared(texts.select("h1", "h2", F.inline(_blocks())), ["h1", "h2", "block"])
    variants = staged(
        texts.join(near_blocks, ["h1", "h2"]).select("h1", "h2", "first", F.inline(_variants())), "variants"
    )

    def least(kind: int) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("first", "h1", "h2"))).alias(f"least{kind}")

    groups = variants.groupBy("key").agg(F.count("*").alias("n"), *(least(k) for k in (0, 1, 2))).filter("n > 1")
    rival = (
        F.when(F.col("kind") == 0, F.col("least1")).when(F.col("kind") == 1, F.col("least0")).otherwise(F.col("least2"))
    )
    pairs = (
        variants.join(groups, "key")
        .select("h1", "h2", "first", rival.alias("rival"))
        .filter(F.col("rival.first") < F.col("first"))
        .groupBy("h1", "h2")
        .agg(F.min("rival").alias("rival"))
        .select("h1", "h2", F.col("rival.h1").alias("r1"), F.col("rival.h2").alias("r2"))
    )
    other = texts.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("line").alias("earlier"))
    near = (
        pairs.join(texts.select("h1", "h2", "line"), ["h1", "h2"])
        .join(other, ["r1", "r2"])
        .filter(F.levenshtein("line", "earlier", 1).between(0, 1))
        .select("h1", "h2", F.lit(True).alias("near"))
    )
    return staged(
        known.select("h1", "h2", "first", "n")
        .join(near, ["h1", "h2"], "left")
        .withColumn("near", F.coalesce("near", F.lit(False)))
        .filter("near or n > 1")
        .select("h1", "h2", "first", "near"),
        "repeated",
    )


def dedup_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_chars`` (if there is
    such a column) set to what is left. ``counts`` adds ``n_lines`` and ``n_removed``, in
    place of columns of these names.
    """
    bad = broadcast_if_small(repeated_lines(docs))
    gone = (
        _lines(docs)
        .select("doc_id", "line_no", *_name())
        .join(bad, ["h1", "h2"])
        .filter(F.col("near") | ~F.struct("doc_id", "line_no").eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.collect_set(F.struct("line_no", "h1")).alias("gone"))
    )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("whole"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("of")), "left")
    lines = F.split("whole", "\n", -1)
    kept = F.filter(
        F.transform(lines, lambda line, i: F.struct(line.alias("line"), F.struct(i.alias("line_no"), F.xxhash64(line).alias("h1")).alias("id"))),
        lambda x: ~F.array_contains(F.col("gone"), x["id"]),
    )
    text = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    n = F.when(F.col("whole").isNull(), 0).otherwise(F.size(lines)).cast("long")
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size(lines) - F.size(kept)).cast("long")
    done = joined.select("row", text.alias("new"), n.alias("lines"), removed.alias("removed"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("new").alias(c))
        elif c == "n_chars":
            out.append(F.char_length("new").cast(docs.schema[c].dataType).alias(c))
        elif not (counts and c in ("n_lines", "n_removed")):
            out.append(F.col("row")[c].alias(c))
    if counts:
        out += [F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed")]
    return done.select(*out)
