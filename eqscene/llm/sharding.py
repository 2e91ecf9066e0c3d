"""Operator 1: rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair has a score that depends on nothing else; a record goes
to the shard with the highest score. One more shard therefore takes records only
into itself, about ``1 / (n + 1)`` of them. Scores are 32-bit words of an MD5
digest, four to a digest; with weights ``w`` the score is ``w / -ln(u)``, ``u``
the word as a fraction, which gives shard ``i`` the share ``w_i / sum(w)``.

Slots number the records of a shard without gaps. A shard is never sorted as a
whole: it is cut into 4096 hashed cells, a window numbers the rows of a cell,
and the cells' counts (read from the key column alone) give each cell its offset.

Edge cases: a null key counts as the text ``null`` (so all null keys share a
shard); a null text has size 1 and the CRC of the empty text; repeated rows keep
separate slots; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eqscene.llm._common import whole_text

WORD = 2**32


def _words(key: Column, n: int) -> list[Column]:
    """n unsigned 32-bit words for a key, four from each digest."""
    digest = [F.md5(F.concat(key, F.lit(f":{j}")).cast("binary")) for j in range(-(-n // 4))]
    return [
        F.conv(F.substring(digest[i // 4], 8 * (i % 4) + 1, 8), 16, 10).cast("long") for i in range(n)
    ]


def _score(word: Column, weight: float | None) -> Column:
    if weight is None:
        return word
    return F.lit(float(weight)) / -F.log((word + 0.5) / WORD)


def rendezvous(key: Column, n_shards: int, weights: list[float] | None = None) -> Column:
    """The shard (0 .. n_shards - 1) of a key; equal scores go to the lower shard."""
    if n_shards < 1 or (weights is not None and len(weights) != n_shards):
        raise ValueError("one positive weight for each of at least one shard")
    if weights is not None and min(weights) <= 0:
        raise ValueError("weights are positive")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scored = [
        F.struct(_score(w, weights and weights[i]).alias("score"), F.lit(-i).alias("shard"))
        for i, w in enumerate(_words(text, n_shards))
    ]
    return (-F.array_max(F.array(*scored))["shard"]).cast("int")


def cell(key: Column) -> Column:
    """One of 4096 cells within a shard, of a digest of its own."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.substring(F.md5(F.concat(text, F.lit(":cell")).cast("binary")), 1, 3)


def assign_shards(
    docs: DataFrame, n_shards: int = 16, weights: list[float] | None = None, new_weight: float | None = None
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``weights`` are those of the shards today; ``new_weight`` (default: their
    mean) is that of the shard added for ``grown_shard``.
    """
    grown = None
    if weights is not None:
        grown = [*weights, new_weight or math.fsum(weights) / n_shards]
    elif new_weight is not None:
        weights, grown = [1.0] * n_shards, [1.0] * n_shards + [new_weight]
    key = F.col("doc_id")
    placed = [rendezvous(key, n_shards, weights).alias("shard"), cell(key).alias("cell")]

    sizes = docs.select(*placed).groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # at most n_shards * 4096 rows
    offsets = sizes.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    text = whole_text()
    rows = docs.select(
        key,
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *placed,
        rendezvous(key, n_shards + 1, grown).alias("grown_shard"),
    )
    order = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.join(F.broadcast(offsets), ["shard", "cell"])
        .withColumn("row", F.row_number().over(order))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("row") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
