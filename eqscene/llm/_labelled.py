"""Bounded samples of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import whole_text

_PARTS = 1 << 62


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; 0 for a null doc_id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int) -> DataFrame:
    """``doc_id, text, label`` of labelled rows with ``learn`` true.

    All of them, or if there are more than ``max_rows``, those with the least hashes,
    about ``0.95 * max_rows``. A document with several labels gets the greatest; null
    labels don't count. The chosen ids are broadcast: ``max_rows`` bounds them.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg((F.max(label) > 0).cast("int").alias("label"))
    )
    n = known.count()
    share = 1.0 if n <= max_rows else 0.95 * max_rows / n
    return _sampled(known, docs, share)


def _sampled(known: DataFrame, docs: DataFrame, share: float) -> DataFrame:
    """Labelled documents whose hash lies below a share of its whole range, however small the share is."""
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)) < int(share * _PARTS))
    return docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
