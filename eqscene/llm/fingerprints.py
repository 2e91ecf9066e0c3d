"""Operator 3: document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once; the high bits choose one of ``BINS`` bins and
the least of the other bits is kept there. Empty bins are filled by optimal
densification: bin ``b`` probes bins given by a hash of ``(b, attempt)``, the same for
all documents, until it meets one that was filled. The low ``BITS`` bits of each bin
are packed; of two unlike bins ``2 ** -BITS`` agree by chance, which ``likeness``
takes out: ``(agree - 2**-b) / (1 - 2**-b)``.

Edge cases: a text without words has the empty fingerprint, which is like another
empty one (1.0) and unlike any other (0.0); equal texts have equal fingerprints.

``fingerprint_with_next`` also pairs each document with the one of the next doc_id.
Nothing is sorted as a whole: quantiles of doc_id (at most ``MAX_RANGES`` numbers, the
only data that the driver sees) cut the table into ranges, the first document of each
range is sent to the range before it as well, and tasks read their sorted ranges as a
stream. Null doc_ids come last; rows of one doc_id follow the order of their texts.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from eqscene.llm._common import whole_text
from eqscene.llm._shingles import chunks, mix, shingle_hashes

BIN_BITS = 9
BINS = 1 << BIN_BITS
BITS = 4
RANGE_ROWS = 64
MAX_RANGES = 20_000
_EMPTY = np.uint64(2**64 - 1)


def _probes() -> Iterator[np.ndarray]:
    """For each attempt, the bin that each bin probes."""
    own = np.arange(BINS, dtype=np.uint64)
    for attempt in range(64 * BINS):
        yield (mix(own * np.uint64(64 * BINS) + np.uint64(attempt)) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def densify(bins: np.ndarray) -> np.ndarray:
    """Rows with at least one filled bin, all bins filled."""
    out = bins.copy()
    row, col = np.nonzero(bins == _EMPTY)
    for probe in _probes():
        if not len(row):
            break
        got = bins[row, probe[col]]
        out[row, col] = got
        row, col = row[got == _EMPTY], col[got == _EMPTY]
    return out


def fingerprints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each text BINS codes of BITS bits, and whether it has any word."""
    codes, some = np.zeros((len(texts), BINS), np.uint8), np.zeros(len(texts), bool)
    for i, j in chunks(texts):
        hashes, count = shingle_hashes(texts[i:j])
        bins = np.full((j - i) * BINS, _EMPTY, np.uint64)
        row = np.repeat(np.arange(j - i), count)
        at = row * BINS + (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        np.minimum.at(bins, at, hashes & np.uint64(2 ** (64 - BIN_BITS) - 1))
        some[i:j] = count > 0
        full = densify(bins.reshape(j - i, BINS)[count > 0])
        # the bin counts too, so that copies of one minimum agree by chance independently
        own = mix(full + np.arange(BINS, dtype=np.uint64) * np.uint64(2**56 + 2**33 + 1))
        codes[i:j][count > 0] = (own & np.uint64(2**BITS - 1)).astype(np.uint8)
    return codes, some


def packed(codes: np.ndarray, some: np.ndarray) -> list[str]:
    """Two codes to a byte, as base64 text; empty for a text without words."""
    raw = codes[:, ::2] << BITS | codes[:, 1::2]
    return [base64.b64encode(r.tobytes()).decode() if s else "" for r, s in zip(raw, some, strict=True)]


def unpacked(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    return np.stack([raw >> BITS, raw & (2**BITS - 1)], 1).ravel()


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Bias-corrected share of equal codes, row by row, within 0 to 1."""
    chance = 2.0**-BITS
    like = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1) if len(a) else np.zeros(0)
    return np.where(some_a & some_b, like, (~some_a & ~some_b).astype(float))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carried: tuple[list, list, list, list] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in ("range_no", "ahead", "doc_id", "text")]
        if carried:
            cols = [a + b for a, b in zip(carried, cols, strict=True)]
        carried = tuple(c[-1:] for c in cols)  # its next row comes with the next batch
        if out := _pairs(*cols, id_type=batch.schema.field("doc_id").type):
            yield out


def _pairs(ranges: list, ahead: list, ids: list, texts: list, id_type: pa.DataType) -> pa.RecordBatch | None:
    real = [i for i in range(len(ids) - 1) if not ahead[i] and ranges[i] == ranges[i + 1]]
    if not real:
        return None
    raw = [t.encode() for t in texts]
    edited = []
    for i in real:
        n = len(texts[i]) // 4
        edited.append((texts[i][: len(texts[i]) - n] + texts[i + 1][:n]).encode())
    codes, some = fingerprints(raw)
    codes_e, some_e = fingerprints(edited)
    own, after = np.array(real), np.array(real) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[i] for i in real], id_type),
            pa.array([len(texts[i]) for i in real], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array(packed(codes[own], some[own])),
            pa.array(packed(codes_e, some_e)),
            pa.array(likeness(codes[own], some[own], codes_e, some_e)),
            pa.array(likeness(codes[own], some[own], codes[after], some[after])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _bounds(docs: DataFrame, n: int, k: int) -> np.ndarray | None:
    """Ids at which about ``k`` ranges start, the least one first; None if there is no id.

    Ids that are not numbers have no quantiles: about ten ids for each range, chosen by their
    hash, stand for all. They only balance the ranges.
    """
    if isinstance(docs.schema["doc_id"].dataType, NumericType):
        quantiles = F.percentile_approx("doc_id", [i / k for i in range(k)], min(1_000_000, max(10_000, 100 * k)))
        found = docs.agg(F.min("doc_id").alias("least"), quantiles.alias("q")).first()
        return np.array(sorted({found["least"], *found["q"]})) if found["q"] else None
    least = docs.agg(F.min("doc_id")).first()[0]
    if least is None:
        return None
    share = max(1, n // (10 * k))
    some = sorted({r[0] for r in docs.filter("doc_id IS NOT NULL").filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("doc_id").distinct().collect()})
    out = np.empty(k, object)
    out[:] = [least, *(some[i * len(some) // k] if some else least for i in range(1, k))]
    return np.unique(out)


def fingerprint_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has the last quarter of the code points (rounded down) replaced by
    as many first ones, or all, of the next document; the first follows the last.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    n = docs.count()
    k = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    bounds = _bounds(docs, n, k)

    @F.pandas_udf("struct<range_no:int,first:boolean>")
    def placed(ids: pd.Series) -> pd.DataFrame:
        last = 0 if bounds is None else len(bounds) - 1
        there = ids.notna().to_numpy()
        number = np.full(len(ids), last)
        first = np.zeros(len(ids), bool)
        if bounds is not None:
            known = ids[there].to_numpy(bounds.dtype)
            number[there] = np.searchsorted(bounds, known, "right") - 1
            first[there] = bounds[number[there]] == known
        elif len(ids):
            first[:] = True  # nothing but null ids: any text of the one range may follow the last
        return pd.DataFrame({"range_no": number.astype("int32"), "first": first})

    count = 1 if bounds is None else len(bounds)
    own = F.struct(F.col("p.range_no").alias("range_no"), F.lit(False).alias("ahead"))
    before = F.struct(
        F.pmod(F.col("p.range_no") - 1, F.lit(count)).cast("int").alias("range_no"), F.lit(True).alias("ahead")
    )
    return (
        docs.select("doc_id", whole_text().alias("text"), placed("doc_id").alias("p"))
        .select(
            "doc_id",
            "text",
            F.inline(F.when(F.col("p.first"), F.array(own, before)).otherwise(F.array(own))),
        )
        .repartition("range_no")
        .sortWithinPartitions("range_no", "ahead", F.col("doc_id").asc_nulls_last(), "text")
        .mapInArrow(_stream, schema)
    )
