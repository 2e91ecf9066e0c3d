"""Operator 11: hard negatives by slot-decomposed selection, exact over all rows.

For an anchor and each of its positives (the best-scored rows of its label) the hard
negatives are the best rows of other labels whose score lies in a window given by the
positive's score. Windows of one anchor overlap. Their upper limits cut the scores into
disjoint slots: slot i holds what fits the i best positives' windows from above. Tasks
keep the best ``n_negatives`` of each slot as they read rows (the combiner), a window
function keeps the best of all tasks, and the list of a positive is the beginning of its
slot followed by all lower slots, of which the merges of suffixes need no more than
``n_negatives``, cut at its own lower limit.

Scores are integer inner products, made as matrix products of blocks of rows with blocks
of anchors. Rows and anchors are packed into blocks once, written, and dealt out as tiles:
a tile has a share of the anchors, held in memory and bounded, and a share of the rows,
read as a stream. A label may hold any share of the rows, as tiles don't go by label.

Edge cases: rows without an id, label or vector, or with a null or non-finite entry, take
no part; shorter vectors count as filled with zeros; ties go to the smaller vec_id; rows
of one vec_id are rows of their own, each an anchor if the id is one. An anchor without
positives or without rows in a window has no rows; a negative positive_score has an empty
window. No rows give no rows. Other columns are ignored. Entries beyond 2**43 in size, and
scores that don't fit a long, are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eqscene.llm._common import staged
from eqscene.llm.whitening import integers, whole_vector

#: Rows of a block, and bytes of its vectors as long integers.
BLOCK, BLOCK_BYTES = 4096, 4_000_000
#: Anchors that a task holds.
MOST_ANCHORS = 32_768
#: Anchors and rows scored at a time.
_STEP, _ROWS = 1024, 512
_PACKED = "block long, n int, wide int, largest long, ids binary, labels binary, vectors binary, anchors binary"
_NONE = np.iinfo(np.int64).min


def _pack(block: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, anchors: np.ndarray) -> pa.RecordBatch:
    largest = int(np.abs(x).max()) if x.size else 0
    kind = np.int16 if largest < 2**15 else np.int32 if largest < 2**31 else np.int64
    values = [block, len(ids), x.shape[1], largest, ids.tobytes(), labels.tobytes(), x.astype(kind).tobytes(), anchors.tobytes()]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["block", "n", "wide", "largest", "ids", "labels", "vectors", "anchors"])


class _Block:
    """Rows of a packed block. ``uid`` is the same for a row in whichever block it is."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        kind = np.int16 if row["largest"] < 2**15 else np.int32 if row["largest"] < 2**31 else np.int64
        self.x = np.frombuffer(row["vectors"], kind).reshape(row["n"], row["wide"])
        self.anchors = np.frombuffer(row["anchors"], np.int64)
        self.largest, self.block = row["largest"], row["block"]

    @property
    def uid(self) -> np.ndarray:
        return self.block * BLOCK + np.arange(len(self.ids))


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    """Blocks of rows; ``anchors`` has the numbers of those that are anchors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 24
        for batch in batches:
            widest = pc.max(pc.list_value_length(batch.column("v"))).as_py() or 1
            step = max(1, min(BLOCK, BLOCK_BYTES // (8 * widest)))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
                chosen = np.flatnonzero(part.column("anchor").to_numpy(zero_copy_only=False))
                yield _pack(at, ids, labels, integers(part.column("v"), scale, 0), chosen.astype(np.int64))
                at += 1

    return rows.mapInArrow(pack, _PACKED)


def _anchors(blocks: DataFrame) -> DataFrame:
    """The anchors of all blocks in blocks of their own, where ``anchors`` has their uids."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            wide = max(x.shape[1] for *_, x in held)
            x = np.concatenate([np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for *_, x in held])
            uid, ids, labels = (np.concatenate([h[k] for h in held]) for k in range(3))
            held.clear()
            return _pack(int(uid[0]), ids, labels, x, uid)

        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                if not len(b.anchors):
                    continue
                if held and (sum(len(h[0]) for h in held) + len(b.anchors)) * max(1, 8 * b.x.shape[1] * BLOCK // BLOCK_BYTES) > BLOCK:
                    yield flushed()
                held.append((b.uid[b.anchors], b.ids[b.anchors], b.labels[b.anchors], b.x[b.anchors].astype(np.int64)))
        if held:
            yield flushed()

    return blocks.mapInArrow(gather, _PACKED)


class _Best:
    """The best ``k`` of each group so far: scores falling, then ids and uids rising."""

    def __init__(self, groups: int, k: int):
        self.score, self.id, self.uid = (np.full((groups, k), v) for v in (_NONE, 0, 0))
        self.count, self.k = np.zeros(groups, np.int64), k

    @property
    def least(self) -> np.ndarray:
        """Of a full group its last score."""
        return self.score[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        if not len(group):
            return
        met = np.unique(group)
        old, at = np.nonzero(np.arange(self.k) < self.count[met, None])
        old = met[old]
        group = np.concatenate([old, group])
        score, ids, uid = (np.concatenate([a[old, at], b]) for a, b in ((self.score, score), (self.id, ids), (self.uid, uid)))
        order = np.lexsort((uid, ids, -score, group))
        group = group[order]
        place = np.arange(len(group))
        first = np.concatenate(([True], group[1:] != group[:-1]))
        rank = place - np.maximum.accumulate(np.where(first, place, 0))
        kept = rank < self.k
        group, rank, order = group[kept], rank[kept], order[kept]
        for mine, new in ((self.score, score), (self.id, ids), (self.uid, uid)):
            mine[group, rank] = new[order]
        self.count[met] = np.bincount(np.searchsorted(met, group), minlength=len(met))

    def all(self) -> tuple[np.ndarray, ...]:
        group, at = np.nonzero(np.arange(self.k) < self.count[:, None])
        return group, self.score[group, at], self.id[group, at], self.uid[group, at]


def _scores(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """Exact inner products of rows of ``a`` and ``b``; ``bound`` is at least the size of any."""
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and not -(2**63) < exact.min() <= exact.max() < 2**63:
        raise OverflowError("a score doesn't fit a long")
    return exact.astype(np.int64)


def _tiles(anchors: DataFrame, blocks: DataFrame, n_anchors: int, n_rows: int, wide: int) -> DataFrame:
    """Anchor blocks (``kind`` 0, of a share of the anchors) before row blocks (1, of a share of the rows), tile by tile, a partition each."""
    tasks = 3 * blocks.sparkSession.sparkContext.defaultParallelism
    row_bytes = 4 * wide + 16
    # a share more of anchors sends all rows once more, a share more of rows sends all anchors and their results
    shares = round((tasks * n_anchors * (row_bytes + 1600) / max(1, n_rows * row_bytes)) ** 0.5)
    shares = max(1, -(-n_anchors // MOST_ANCHORS), min(tasks, shares, -(-n_anchors // BLOCK)))
    parts = max(1, min(-(-tasks // shares), -(-n_rows // BLOCK)))
    share = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    held = anchors.withColumns({"kind": F.lit(0), "share": share("block", shares)}).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    read = blocks.withColumns({"kind": F.lit(1), "part": share("block", parts)}).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    both = held.unionByName(read, allowMissingColumns=True).withColumn("tile", F.col("share") * parts + F.col("part"))
    return both.repartitionById(shares * parts, "tile").sortWithinPartitions("tile", "kind", "block")


class _Held:
    """The anchors of a tile, and what each may take."""

    def __init__(self, rows: list[dict], k: int, slots: int):
        blocks = [_Block(r) for r in rows]
        wide = max((b.x.shape[1] for b in blocks), default=0)
        self.x = np.concatenate([np.pad(b.x, ((0, 0), (0, wide - b.x.shape[1]))) for b in blocks])
        self.uid, self.ids, self.labels = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("anchors", "ids", "labels"))
        self.holder = np.concatenate([np.full(len(b.ids), b.block) for b in blocks])
        self.largest = max(b.largest for b in blocks)
        self.best, self.slots = _Best(len(self.uid) * slots, k), slots
        if "limits" in rows[0] and rows[0]["limits"] is not None:
            at = {u: i for i, u in enumerate(self.uid.tolist())}
            self.upper, self.lower = np.full((len(at), slots), _NONE), np.full((len(at), slots), np.iinfo(np.int64).max)
            for r in rows:
                for one in r["limits"] or ():
                    i, m = at[one["anchor"]], len(one["upper"])
                    self.upper[i, :m], self.lower[i, :m] = one["upper"], one["lower"]
                    self.lower[i, : m - 1] = np.maximum(self.lower[i, : m - 1], np.array(one["upper"][1:], np.int64) + 1)

    def steps(self, b: _Block) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
        """Numbers of anchors, a slice of the block's rows, and their scores."""
        wide = min(self.x.shape[1], b.x.shape[1])
        bound = self.largest * b.largest * wide
        for i in range(0, len(self.uid), _STEP):
            for j in range(0, len(b.ids), _ROWS):
                yield np.arange(i, min(i + _STEP, len(self.uid))), slice(j, j + _ROWS), _scores(self.x[i : i + _STEP, :wide], b.x[j : j + _ROWS, :wide], bound)

    def positives(self, b: _Block) -> None:
        uid = b.uid
        for own, part, score in self.steps(b):
            fits = (self.labels[own, None] == b.labels[None, part]) & (score >= self.best.least[own, None]) & (self.uid[own, None] != uid[None, part])
            i, j = np.nonzero(fits)
            self.best.add(own[i], score[i, j], b.ids[part][j], uid[part][j])

    def negatives(self, b: _Block) -> None:
        uid = b.uid
        for own, part, score in self.steps(b):
            other = self.labels[own, None] != b.labels[None, part]
            found = []
            for slot in range(self.slots):
                group = own * self.slots + slot
                least = np.maximum(self.lower[own, slot], self.best.least[group])
                i, j = np.nonzero((score >= least[:, None]) & (score <= self.upper[own, slot][:, None]) & other)
                found.append((group[i], score[i, j], b.ids[part][j], uid[part][j]))
            self.best.add(*(np.concatenate(c) for c in zip(*found, strict=True)))

    def out(self) -> pa.RecordBatch:
        group, score, ids, uid = self.best.all()
        own, slot = np.divmod(group, self.slots)
        columns = {"anchor": self.uid[own], "anchor_id": self.ids[own], "holder": self.holder[own], "slot": slot.astype(np.int32), "score": score, "id": ids, "uid": uid}
        return pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})


def _selected(tiles: DataFrame, k: int, slots: int, method: str) -> DataFrame:
    """The best ``k`` rows of each anchor and slot: of each tile, then of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, tile = None, [], None
        for batch in batches:
            for k_row in range(batch.num_rows):
                row = batch.slice(k_row, 1).to_pylist()[0]
                if row["tile"] != tile:
                    if held:
                        yield held.out()
                    held, waiting, tile = None, [], row["tile"]
                if row["kind"] == 0:
                    waiting.append(row)
                    continue
                if waiting:
                    held, waiting = _Held(waiting, k, slots), []
                if held:
                    getattr(held, method)(_Block(row))
        if held:
            yield held.out()

    found = tiles.mapInArrow(run, "anchor long, anchor_id long, holder long, slot int, score long, id long, uid long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _share(part: int, of: int, up: bool) -> Column:
    """``score * part / of`` for a score of at least 0, rounded down or up, without overflow."""
    return F.expr(f"score div {of} * {part} + (score % {of} * {part} + {of - 1 if up else 0}) div {of}")


def mine(
    rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10,
    lower: tuple[int, int] = (30, 100), upper: tuple[int, int] = (90, 100), scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows of ``vec_id, label, embedding``.

    A negative's score is at least ``lower`` and at most ``upper`` (as fractions) of the
    positive's; components are ``floor(scale * c)``.
    """
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole_vector("embedding"))
    usable = usable.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    blocks = staged(_packed(usable, scale), "negatives-rows")
    anchors = staged(_anchors(blocks), "negatives-anchors")
    size = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("wide"), F.lit(0)).alias("wide")).first()
    n_anchors = anchors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    positives = staged(_selected(_tiles(anchors, blocks, n_anchors, size.n, size.wide), n_positives, 1, "positives").filter("score >= 0"), "negatives-positives")
    own = positives.select("anchor", "anchor_id", "holder", "rank", "id", "score", _share(*upper, up=False).alias("upper"), _share(*lower, up=True).alias("lower"))
    each = own.groupBy("holder", "anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "upper", "lower"))).alias("p"))
    # at most BLOCK anchors to a holder
    limits = each.groupBy(F.col("holder").alias("block")).agg(
        F.collect_list(F.struct("anchor", F.col("p.upper").alias("upper"), F.col("p.lower").alias("lower"))).alias("limits")
    )
    tiles = _tiles(anchors.join(limits, "block"), blocks, n_anchors, size.n, size.wide)
    best = _selected(tiles, n_negatives, n_positives, "negatives")
    slots = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "score", "id"))).alias("found"))
    # from the lowest slot up: each slot's best, then the merge of those below it, cut at n_negatives
    merged = F.transform(
        F.sequence(F.lit(0), F.lit(n_positives - 1)),
        lambda slot: F.slice(F.filter(F.col("found"), lambda f: f["slot"] >= slot), 1, n_negatives),
    )
    fits = F.filter(F.element_at("merged", F.col("rank")), lambda f: f["score"] >= F.col("lower"))
    return (
        own.join(slots.select("anchor", merged.alias("merged")), "anchor")
        .select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(fits).alias("at", "f"))
        .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias("negative_id"), "positive_score", F.col("f.score").alias("negative_score"))
    )
