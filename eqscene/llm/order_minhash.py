"""Operator 2: near-duplicates by Order MinHash, verified by banded alignment.

The k-mers are shingles of five words, each labelled with its occurrence number. A
sample hashes them with its own seed, takes the two least and keeps them in text order,
so that it is sensitive to moved text as well as to changed text. Each of ``BANDS``
samples is a key; texts that share a key are candidates. Of two texts whose shingles
have a Jaccard index of 0.4, some key agrees with a chance of 0.996, at 0.3 with 0.95.

Two texts are linked if they share a key and the edit distance of their words, found in
a band about the diagonal that is doubled until it holds the alignment, is at most
``1 - SIMILARITY`` of the longer. Nothing else decides. Classes are the connected
components of links.

What rules a pair out before its texts are read is implied by that distance: an edit
changes the number of words by one at most, and takes one word at most out of the bag of
words. Bags are compared by the counts of ``BINS`` bins of hashed words (profiles), whose
differences are never greater than those of the words. Texts travel as 32-bit codes of
their words, and many pairs of about the same length are aligned at once.

Equal texts are folded into one first. In a bucket every text is aligned with a lead,
the one whose buckets hold most others, unless links found so far have brought both into
one class; those left in other classes meet eight leads each. Then, in each bucket that
still holds texts of several classes, all texts from different ones are compared in
blocks of bounded size, by profiles and where these don't rule it out by alignment: no
candidate is dropped, and only links that bring two classes together leave a block. A
bucket of near copies that all come into one class costs one alignment each rather than
all pairs; one that stays divided costs a comparison for each pair across its classes
with compatible lengths.

Edge cases: texts without words (null and empty ones among them) are alike only if
equal, a null one counting as empty; a text of fewer than five words is one shingle; a
row with a null doc_id gets the class of an equal text, or null; rows of one doc_id with
equal texts are one document, with unlike texts they are judged apart; an empty table
gives no rows; other columns are ignored, or passed through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import broadcast_if_small, staged, whole_text
from eqscene.llm._components import components
from eqscene.llm._shingles import SHINGLE, byte_chunks, mix, shingle_hashes, word_hashes

SIMILARITY = 0.8
BANDS = 32
FIRST_BANDS = 2
LEADS = 8
BLOCK = 65_536
CELLS = 8_000_000
BINS = 256
#: A block of a bucket holds about so many bytes of codes.
BLOCK_BYTES = 2_000_000
#: Overlaps of bags are counted for so many words of either side at once.
TILE_WORDS = 200_000
#: Texts of up to so many words are aligned many at once, PAIRS of them.
SHORT, PAIRS = 2_000, 512
#: What a lead meets is dealt into so many parts, so that no lead is one hot key.
SALTS = 256
_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | np.uint64(1)
_TIE = np.uint64(0xD1342543DE82EF95)
_MOST = np.uint64(2**64 - 1)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """The shingles with their occurrence numbers hashed in."""
    order = np.argsort(shingles, kind="stable")
    run = shingles[order]
    new = np.append(True, run[1:] != run[:-1])
    at = np.arange(len(run))
    occurrence = np.empty(len(run), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(shingles + occurrence * _TIE)


def _two_least(values: np.ndarray) -> np.ndarray:
    """Columns of the two least values of each row (twice the same if there is one)."""
    row = np.arange(len(values))
    one = values.argmin(1)
    if values.shape[1] == 1:
        return np.stack([one, one], 1)
    values[row, one] = _MOST
    return np.stack([one, values.argmin(1)], 1)


def bands(shingles: np.ndarray) -> np.ndarray:
    """The BANDS keys of a text with at least one shingle."""
    own = labelled(shingles)
    found = []
    for i in range(0, len(own), BLOCK):
        part = (own[None, i : i + BLOCK] ^ _SEEDS[:, None]) * _FACTORS[:, None]
        found.append(_two_least(part) + i)
    at = np.concatenate(found, 1)
    if at.shape[1] > 2:
        pick = _two_least((own[at] ^ _SEEDS[:, None]) * _FACTORS[:, None])
        at = np.take_along_axis(at, pick, 1)
    at.sort(axis=1)
    return mix(own[at[:, 0]] * _TIE + own[at[:, 1]])


def word_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The edit distance of two word sequences if it is at most ``limit``."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1]
    tail = n if same.all() else int(same.argmin())
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return d if (d := max(len(a), len(b))) <= limit else None
    width = min(limit, 8)
    while abs(len(a) - len(b)) <= limit:
        if abs(len(a) - len(b)) <= width:
            near = _diagonals if len(a) * (2 * width + 1) <= CELLS else _rows
            if (d := near(a, b, width)) is not None:
                return d
        if width >= limit:
            break
        width = min(2 * width, limit)
    return None


def _diagonals(a: np.ndarray, b: np.ndarray, width: int) -> int | None:
    """Furthest reach on each diagonal of the band for 0, 1, 2, ... edits."""
    la, lb, k = len(a), len(b), np.arange(-width, width + 1)
    padded = np.zeros(max(la, lb) + 2 * width + 1, a.dtype)
    padded[width : width + lb] = b
    inside = np.zeros(len(padded), bool)
    inside[width : width + lb] = True
    equal = (sliding_window_view(padded, 2 * width + 1)[:la] == a[:, None]) & sliding_window_view(inside, 2 * width + 1)[:la]
    stop = np.full((la + 1, 2 * width + 1), la, np.int32)
    stop[:la] = np.where(equal, la, np.arange(la, dtype=np.int32)[:, None])
    stop = np.minimum.accumulate(stop[::-1], 0)[::-1]
    end, column = np.minimum(la, lb - k), np.arange(2 * width + 1)
    far = np.full(2 * width + 1, -(10**9))
    far[width] = stop[0, width]
    goal = width + lb - la
    for edits in range(width + 1):
        if far[goal] >= la:
            return edits
        step = far + 1
        step[1:] = np.maximum(step[1:], far[:-1])
        step[:-1] = np.maximum(step[:-1], far[1:] + 1)
        step = np.minimum(step, end)
        live = (step >= 0) & (step + k >= 0)
        far = np.where(live, stop[np.where(live, step, 0), column], -(10**9))
    return None


def _rows(a: np.ndarray, b: np.ndarray, width: int) -> int | None:
    """The same by rows of the band: memory of one row, for long texts."""
    big, lb = 10**9, len(b)
    k = np.arange(-width, width + 1)
    row = np.where(k >= 0, k, big).astype(np.int64)
    for i, word in enumerate(a):
        j = i + k  # column of b that a[i] meets on each diagonal
        valid = (j >= 0) & (j < lb)
        differs = np.ones(len(k), np.int64)
        differs[valid] = b[j[valid]] != word
        new = np.where(valid | (j < lb), row + differs, big)
        new[j == -1] = i + 1
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(j < -1) | (j >= lb)] = big
        row = np.minimum.accumulate(new - k) + k
        row[(j < -1) | (j >= lb)] = big
    d = int(row[width + lb - len(a)])
    return d if d <= width else None


def labels(words: np.ndarray) -> np.ndarray:
    """The bag of words as a sorted set: each word labelled with its occurrence number."""
    return np.sort(labelled(words)) if len(words) else words


def alike(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    """Whether two texts are near-duplicates: exact, by the edit distance of their words."""
    words, n = word_hashes([a.encode(), b.encode()])
    if not n.all():
        return a == b
    limit = int((1 - similarity) * n.max() + 1e-9)
    one, two = words[: n[0]], words[n[0] :]
    if len(np.intersect1d(labels(one), labels(two), assume_unique=True)) < n.max() - limit:
        return False
    return word_distance(one, two, limit) is not None


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list = []
        for _, _, texts in byte_chunks(batch.column("text")):
            hashes, count = shingle_hashes(texts)
            end = np.cumsum(count)
            keys += [bands(hashes[e - c : e]).view(np.int64) if c else [] for e, c in zip(end, count, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "h1", "h2")] + [pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "h1", "h2", "bands"],
        )


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in byte_chunks(batch.column("text")):
            words, n = word_hashes(texts)
            code, end = (words >> np.uint64(32)).astype(np.uint32), np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").slice(i, j - i), pa.array(n), pa.array([code[e - k : e].tobytes() for e, k in zip(end, n, strict=True)], pa.binary())],
                names=["rep", "n", "words"],
            )


def _opened(codes: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint32) for x in codes.to_pylist()]


def _profile(words: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.bincount(w % BINS, minlength=BINS) for w in words]).astype(np.int32) if words else np.zeros((0, BINS), np.int32)


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least share of the longer text's words that an edit changes, by profiles."""
    surplus = np.maximum(a - b, 0).sum(-1)
    n, m = a.sum(-1), b.sum(-1)
    return np.maximum(surplus, surplus - n + m) / np.maximum(np.maximum(n, m), 1)


def _features(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all words: the first, second, ... word of each bin are features of their own."""
    text = np.repeat(np.arange(len(words)), [len(w) for w in words])
    key = np.sort(text * BINS + np.concatenate(words).astype(np.int64) % BINS)
    at = np.arange(len(key))
    new = np.append(True, key[1:] != key[:-1])
    return key // BINS, (at - np.maximum.accumulate(np.where(new, at, 0))) * BINS + key % BINS


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many words each of ``a`` has in common with each of ``b`` at most: a product of 0-1 matrices."""
    sides = [_features(a), _features(b)]
    common = np.intersect1d(np.unique(sides[0][1]), np.unique(sides[1][1]), assume_unique=True)
    tables = []
    for (text, feature), n in zip(sides, (len(a), len(b)), strict=True):
        at = np.minimum(np.searchsorted(common, feature), max(len(common) - 1, 0))
        inside = common[at] == feature if len(common) else np.zeros(len(feature), bool)
        table = np.zeros((n, len(common)), np.float32)
        table[text[inside], at[inside]] = 1
        tables.append(table)
    return tables[0] @ tables[1].T


def _tiles(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TILE_WORDS, by their lengths."""
    start = total = 0
    for i, k in enumerate(n.tolist()):
        if i > start and total + k > TILE_WORDS:
            yield start, i
            start, total = i, 0
        total += k
    if start < len(n):
        yield start, len(n)


def within(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """For each pair whether its edit distance is at most ``1 - SIMILARITY`` of the longer."""
    size = np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    limit = ((1 - SIMILARITY) * size.max(1, initial=0) + 1e-9).astype(np.int64)
    out = np.zeros(len(a), bool)
    fits = np.abs(size[:, 0] - size[:, 1]) <= limit
    long = size.max(1, initial=0) > SHORT
    for k in np.flatnonzero(fits & long):
        out[k] = word_distance(a[k], b[k], int(limit[k])) is not None
    todo = np.flatnonzero(fits & ~long)
    todo = todo[np.argsort(size[todo, 0], kind="stable")]
    for k in range(0, len(todo), PAIRS):
        pick = todo[k : k + PAIRS]
        out[pick] = _rows_at_once([a[i] for i in pick], [b[i] for i in pick], size[pick], limit[pick])
    return out


def _rows_at_once(a: list[np.ndarray], b: list[np.ndarray], size: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The rows of many alignments in one band; those that can't end within their limit leave early."""
    w, big = int(limit.max()), 1 << 20
    one = np.full((len(a), int(size[:, 0].max()) + 1), -1, np.int64)
    two = np.full((len(a), one.shape[1] + 2 * w + 1), -2, np.int64)
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        one[k, : len(x)], two[k, w : w + len(y)] = x, y[: two.shape[1] - w]
    diagonal = np.arange(-w, w + 1, dtype=np.int32)
    row = np.broadcast_to(np.where(diagonal >= 0, diagonal, big), (len(a), 2 * w + 1)).astype(np.int32)
    out, at = np.zeros(len(a), bool), np.arange(len(a))
    la, goal, limit = size[:, 0], size[:, 1] - size[:, 0] + w, limit.copy()
    for i in range(one.shape[1]):
        done = la == i
        if done.any():
            out[at[done]] = row[done, goal[done]] <= limit[done]
        if done.any() or i % 16 == 15:
            keep = ~done & (row.min(1) <= limit)
            if not keep.any():
                break
            if not keep.all():
                one, two, row, at, la, goal, limit = one[keep], two[keep], row[keep], at[keep], la[keep], goal[keep], limit[keep]
        new = row + (two[:, i : i + 2 * w + 1] != one[:, i, None])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        if i < w:
            new[:, : w - i - 1], new[:, w - i - 1] = big, i + 1
        row = np.minimum.accumulate(new - diagonal, 1) + diagonal
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = _opened(batch.column("one")), _opened(batch.column("two"))
        near = np.flatnonzero(_bound(_profile(one), _profile(two)) <= 1 - SIMILARITY + 1e-9)
        linked = near[within([one[k] for k in near], [two[k] for k in near])]
        yield batch.select(["rep", "lead"]).take(pa.array(linked))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a block, or of two that meet: links that bring texts of unlike sides together, until none is left.

    A pair is looked at in the first band only whose key it shares.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            held = [c[row].values for c in (batch.column("xs"), batch.column("ys")) if c[row].is_valid]
            reps = pa.concat_arrays([x.field("rep") for x in held])
            words = [w for x in held for w in _opened(x.field("words"))]
            keys = np.concatenate([x.field("bands").flatten().to_numpy() for x in held]).reshape(len(reps), -1)
            keys = keys[:, : batch.column("band")[row].as_py()]
            _, side = np.unique(np.concatenate([x.field("side").to_numpy() for x in held]), return_inverse=True)
            block = np.repeat(np.arange(len(held)), [len(x) for x in held])
            order = np.argsort([len(w) for w in words], kind="stable")
            n = np.array([len(words[k]) for k in order])
            found: list[tuple[int, int]] = []
            pairs: list[tuple[int, int]] = []

            def settle() -> None:
                """Align what waits; a link gives both sides one number."""
                open_pairs = [(x, y) for x, y in pairs if side[x] != side[y]]
                pairs.clear()
                for (x, y), ok in zip(open_pairs, within([words[x] for x, _ in open_pairs], [words[y] for _, y in open_pairs]), strict=True):
                    if ok and side[x] != side[y]:
                        found.append((x, y))
                        side[side == side[y]] = side[x]

            for i, j in _tiles(n):
                stop = int(np.searchsorted(n, n[j - 1] / SIMILARITY + 1e-6, "right"))
                for k, m in _tiles(n[i:stop]):
                    xs, ys = order[i:j], order[i + k : i + m]
                    shared = _overlaps([words[x] for x in xs], [words[y] for y in ys])
                    near = shared >= SIMILARITY * np.maximum(n[i:j, None], n[i + k : i + m]) - 1e-6
                    near &= (side[xs][:, None] != side[ys]) & (np.arange(i, j)[:, None] < np.arange(i + k, i + m))
                    near &= (block[xs][:, None] != block[ys]) | (len(held) == 1)
                    one, two = np.nonzero(near)
                    for c in range(0, len(one), 4 * PAIRS):
                        x, y = xs[one[c : c + 4 * PAIRS]], ys[two[c : c + 4 * PAIRS]]
                        fresh = ~(keys[x] == keys[y]).any(1)
                        pairs += zip(x[fresh].tolist(), y[fresh].tolist(), strict=True)
                        if len(pairs) >= 4 * PAIRS:
                            settle()
            settle()
            yield pa.RecordBatch.from_arrays(
                [reps.take(pa.array([x for x, _ in found], pa.int64())), reps.take(pa.array([y for _, y in found], pa.int64()))], names=["rep", "lead"]
            )


def _side_by_side(pairs: DataFrame, of: DataFrame, what: str) -> DataFrame:
    """``pairs`` (rep, lead) with ``what`` of both, as ``one`` and ``two``; a lead of many pairs is dealt out."""
    dealt = pairs.select("rep", "lead", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt"))
    leads = dealt.select("lead", "salt").distinct().join(of.select(F.col("rep").alias("lead"), F.col(what).alias("two")), "lead")
    return dealt.join(of.select("rep", F.col(what).alias("one")), "rep").join(leads, ["lead", "salt"]).select("rep", "lead", "one", "two")


def _with_root(df: DataFrame, column: str, roots: DataFrame | None, name: str) -> DataFrame:
    """``df`` with the root of ``column`` so far, itself where it has no links."""
    if roots is None:
        return df.withColumn(name, F.col(column))
    of = roots.select(F.col("node").alias(column), F.col("root").alias("__root"))
    return df.join(of, column, "left").withColumn(name, F.coalesce("__root", column)).drop("__root")


def _compatible(n: str, m: str) -> Column:
    """Whether texts of n and m words can be alike at all."""
    return F.least(n, m) >= SIMILARITY * F.greatest(n, m) - 1e-6


def _aligned(pairs: DataFrame, codes: DataFrame, kind: str) -> DataFrame:
    """Those of ``pairs`` (rep, lead) that are alike."""
    pairs = staged(pairs.select("rep", "lead").distinct(), "pairs")
    used = broadcast_if_small(staged(pairs.select("rep").unionByName(pairs.select(F.col("lead").alias("rep"))).distinct(), "used"))
    near = _side_by_side(pairs, codes.join(used, "rep", "left_semi"), "words")
    return staged(near.mapInArrow(_verify, f"rep {kind}, lead {kind}"), "verdicts")


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The roots that ``links`` (rep, lead) give together with those so far."""
    edges = links.select(F.col("rep").alias("u"), F.col("lead").alias("v"))
    if roots is None:
        return components(edges)
    if edges.isEmpty():
        return roots
    return components(edges.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))


def _divided(members: DataFrame, roots: DataFrame | None, codes: DataFrame, reps: DataFrame, kind: str) -> DataFrame:
    """``rep, lead``: links between texts that share a bucket but no root.

    The texts of a bucket are dealt into blocks of about BLOCK_BYTES, those of a large
    class apart from all others, so that blocks of one class don't meet; pairs are formed
    inside a block, or a row of two.
    """
    bucket = ["band", "value"]
    rooted = staged(_with_root(members.select(*bucket, "rep", "n"), "rep", roots, "root"), "rooted")
    sides = rooted.groupBy(*bucket, "root").agg(F.sum(4 * F.col("n") + 200).alias("size"))
    large = F.col("size") >= BLOCK_BYTES
    mixed = sides.groupBy(*bucket).agg(F.count("*").alias("sides"), F.sum(F.when(~large, F.col("size"))).alias("small")).filter("sides > 1")
    parts = F.ceil(F.when(large, F.col("size")).otherwise(F.col("small")) / BLOCK_BYTES)
    dealt = sides.join(mixed, bucket).select(*bucket, "root", F.when(large, F.col("root")).alias("owner"), parts.alias("parts"))
    block = F.xxhash64("owner", F.pmod(F.xxhash64("rep"), F.col("parts")))
    blocks = staged(
        rooted.join(dealt, [*bucket, "root"])
        .withColumn("block", block)
        .join(codes.select("rep", "words").join(reps, "rep"), "rep")
        .groupBy(*bucket, "block")
        .agg(F.first("owner").alias("owner"), F.collect_list(F.struct("rep", F.xxhash64("root").alias("side"), "words", "bands")).alias("held")),
        "blocks",
    )
    inside = blocks.filter("owner IS NULL").select("band", F.col("held").alias("xs"), F.lit(None).cast(blocks.schema["held"].dataType).alias("ys"))
    one = blocks.select(*bucket, F.col("block").alias("b1"), F.col("owner").alias("o1"))
    two = blocks.select(*bucket, F.col("block").alias("b2"), F.col("owner").alias("o2"))
    meet = one.join(two, bucket).filter("b1 < b2 AND (o1 IS NULL OR o2 IS NULL OR o1 <> o2)").select(*bucket, "b1", "b2")
    met = meet.join(blocks.select(*bucket, F.col("block").alias("b1"), F.col("held").alias("xs")), [*bucket, "b1"]).join(
        blocks.select(*bucket, F.col("block").alias("b2"), F.col("held").alias("ys")), [*bucket, "b2"]
    )
    links = inside.unionByName(met.select("band", "xs", "ys")).mapInArrow(_across, f"rep {kind}, lead {kind}")
    return staged(links.select(F.greatest("rep", "lead").alias("rep"), F.least("rep", "lead").alias("lead")).distinct(), "divided")


def _links(members: DataFrame, texts: DataFrame, reps: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Verified links (rep, lead), and the roots they give; ``members`` are (band, value, rep).

    A text that has come into the class of a lead of its bucket meets no more leads there,
    so after the first wave of bands few alignments of a large group are left; buckets that
    stay divided into classes are gone through by pairs at the end.
    """
    codes = staged(texts.mapInArrow(_codes, f"rep {kind}, n long, words binary"), "codes")
    crowd = members.groupBy("band", "value").agg(F.count("*").alias("crowd"))
    rank = members.join(crowd, ["band", "value"]).groupBy("rep").agg(F.sum("crowd").alias("rank"))
    members = staged(members.join(rank.join(codes.select("rep", "n"), "rep"), "rep"), "members")
    first = F.col("band") < FIRST_BANDS
    found, roots, waiting = None, None, None
    for now, leads in ((members.filter(first), 1), (members.filter(~first), 1), (None, LEADS)):
        now = waiting if now is None else now
        chosen = (
            now.groupBy(F.col("band").alias("b"), F.col("value").alias("v"), F.pmod(F.xxhash64("rep"), F.lit(leads)).alias("part"))
            .agg(F.min(F.struct((-F.col("rank")).alias("rank"), "rep", "n")).alias("best"))
            .select("b", "v", F.col("best.rep").alias("lead"), F.col("best.n").alias("m"))
        )
        # a text that is in the class of a lead already doesn't meet it, so a class gives no rows for its other bands
        met = (F.col("band") == F.col("b")) & (F.col("value") == F.col("v")) & _compatible("n", "m")
        meeting = _with_root(now, "rep", roots, "r1").join(_with_root(chosen, "lead", roots, "r2"), met & (F.col("r1") != F.col("r2")))
        verdicts = _aligned(meeting, codes, kind)
        found = verdicts if found is None else found.unionByName(verdicts)
        roots = _merged(roots, verdicts)
        if now is waiting:
            break
        # done with leads: who is in the class of one that it met, and the leads themselves
        late = (
            _with_root(now, "rep", roots, "r1")
            .join(_with_root(chosen, "lead", roots, "r2"), met & (F.col("r1") == F.col("r2")), "left_anti")
            .select(*now.columns)
        )
        waiting = late if waiting is None else staged(late.unionByName(waiting), "waiting")
    across = _divided(members, roots, codes, reps, kind)
    return found.unionByName(across), _merged(roots, across)


def _hashed(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")


def _classes(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, class_id, copy_of, n_links`` for every row of ``docs``; texts are known by (h1, h2)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = whole_text()
    hashed = docs.select("doc_id", *_hashed(text), text.alias("text"))
    sketches = staged(
        hashed.mapInArrow(_sketch, f"doc_id {kind}, h1 long, h2 long, bands array<long>"), "sketches"
    )
    reps = staged(
        sketches.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
        .filter("first IS NOT NULL")
        .select(F.struct(F.col("first").alias("doc_id"), "h1", "h2").alias("rep"), "bands"),
        "reps",
    )
    keyed = reps.select("rep", F.posexplode("bands").alias("band", "value"))
    crowded = keyed.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").select("band", "value")
    members = staged(keyed.join(crowded, ["band", "value"]), "members")
    wanted = broadcast_if_small(staged(members.select("rep").distinct(), "wanted"))
    rep = F.struct("doc_id", "h1", "h2").alias("rep")
    texts = hashed.select(rep, "text").join(wanted, "rep", "left_semi").dropDuplicates(["rep"])
    form = f"struct<doc_id:{kind},h1:bigint,h2:bigint>"
    found, roots = _links(members, texts, reps, form)
    links = found.select(F.col("rep").alias("u"), F.col("lead").alias("v"))
    degree = (
        links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        .distinct()
        .groupBy(F.col("u").alias("rep"))
        .agg(F.count("*").alias("n_links"))
    )
    known = staged(
        reps.select("rep")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select(
            "rep.h1",
            "rep.h2",
            F.coalesce("root.doc_id", "rep.doc_id").alias("class_id"),
            F.col("rep.doc_id").alias("copy_of"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        ),
        "classes",
    )
    return sketches.select("doc_id", "h1", "h2").join(known, ["h1", "h2"], "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, copy_of, n_links`` for every row of ``docs``.

    ``class_id`` is the least doc_id of the class, ``copy_of`` that of equal texts,
    ``n_links`` the number of links that were verified for the text (those that tie the
    class together; within a class not every pair is aligned).
    """
    return _classes(docs).select("doc_id", "class_id", "copy_of", "n_links")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its class, with all their columns."""
    key = ["id", "h1", "h2"]
    later = _classes(docs).filter("class_id <> doc_id").select(F.col("doc_id").alias("id"), "h1", "h2").distinct()
    later = broadcast_if_small(staged(later, "later"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), *_hashed(whole_text()))
    return rows.join(later, key, "left_anti").select("row.*")


__all__ = ["SHINGLE", "SIMILARITY", "alike", "drop_near_duplicates", "near_duplicates", "word_distance"]
