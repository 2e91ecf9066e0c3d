"""Operator 9: SentencePiece encoding and decoding over a relational lattice.

No piece holds a space mark after another character, or a letter next to another kind
of character, so texts fall into units (marks and letters, marks and other characters)
that are encoded on their own. Distinct units are counted in Spark; each is exploded
into its substrings of at most the longest piece's length, these are equi-joined to the
piece table, and the joined edges are grouped by unit. The lattice is then folded with
higher-order aggregates:

* ``kind="unigram"``: Viterbi, the path of the greatest sum of scores;
* ``kind="bpe"``: the best-scored edge that spans exactly two present pieces is taken,
  leftmost first, until there is none. A BPE model's scores are merge ranks, not
  logarithms of chances, and the path with the greatest sum of them is not what such a
  model encodes; the lattice is the same, only the fold differs. One sweep over the
  edges in order of their rank does it unless taking an edge lets a better-ranked one in
  that had been passed over; such units, found by that rule, are folded step by step.

Units of more than ``LONG_UNIT`` characters are folded in an Arrow function with a heap
(BPE) or a window of back pointers (unigram) over the same pieces, in near-linear time
and memory.

Documents are encoded by looking their units up. The commonest units, as many as their
codes fit into ``lookup_bytes``, are read by each Python worker from the shared folder,
where the tasks that encoded them left them: the driver sees none. What a document holds
beyond them comes to it by a shuffled join, as a list of its own, so that the result is
the same for any bound. A unit is known by a 64-bit hash and a 32-bit check. The shared
folder must be one that pyarrow opens (local or mounted paths, hdfs, s3, gs).

Edge cases: null and empty texts have no tokens; characters without a piece become their
UTF-8 bytes' pieces (or the unknown piece if the model has none); spaces and the space
mark are the same; rows that share doc_id and text are encoded alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqscene.llm._common import staged, staged_at, whole_text
from eqscene.llm._shingles import mix

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LOOKUP_BYTES = 160_000_000
LONG_UNIT = 60
PART_UNITS = 20_000
#: Java and Python regular expression of a unit.
UNIT = rf"{MARK}*[\p{{L}}\p{{M}}]+|{MARK}*[^\p{{L}}\p{{M}}{MARK}]+|{MARK}+"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_CHARS, _COUNT_CHARS, _CHUNK_IDS = 250_000, 500_000, 200_000
#: Places of an edge's parts in one long: rank, start, end, whether its rank needs care, id.
_RANK, _START, _END, _CARE = 41, 33, 25, 24
_ID = (1 << _CARE) - 1
#: A bit above all bounds of a unit.
_AGAIN = 1 << 62


@dataclass
class Pieces:
    """A piece table: normal pieces with ids and scores, and the ids of the 256 bytes."""

    pieces: list[str]
    ids: list[int]
    scores: list[float]
    kind: str = "bpe"
    unknown: int = 0
    byte_ids: list[int] = field(default_factory=list)
    surface: dict[int, bytes] = field(default_factory=dict)

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)


def load_pieces(model: str = MODEL, kind: str = "bpe") -> Pieces:
    """The piece table of a SentencePiece model file, read on the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model)
    out = Pieces([], [], [], kind, m.unk_id())
    raw = {}
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            raw[int(piece[3:5], 16)] = i
            out.surface[i] = bytes([int(piece[3:5], 16)])
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            out.pieces.append(piece)
            out.ids.append(i)
            out.scores.append(m.get_score(i))
            out.surface[i] = piece.replace(MARK, " ").encode()
    out.byte_ids = [raw[b] for b in range(256)] if len(raw) == 256 else []
    return _checked(out)


def _checked(table: Pieces) -> Pieces:
    import regex

    odd = [p for p in table.pieces if not regex.fullmatch(UNIT, p)]
    if odd:
        raise ValueError(f"pieces that cross units, such as {odd[:3]}")
    return table


def piece_table(spark: SparkSession, table: Pieces) -> DataFrame:
    """``piece, head, score``: as many rows as the model has pieces, and the empty one.

    ``head`` holds the rank, the id, and for BPE whether the piece begins or ends another
    one of no worse rank with a piece beside it.
    """
    rank = {x: i for i, x in enumerate(sorted(set(table.scores), reverse=True))}
    ranked = {p: rank[x] for p, x in zip(table.pieces, table.scores, strict=True)}
    care = set()
    for p, r in ranked.items():
        for i in range(1, len(p) if table.kind == "bpe" else 1):
            one, two = p[:i], p[i:]
            if all(len(x) == 1 or x in ranked for x in (one, two)):
                care |= {x for x in (one, two) if len(x) > 1 and ranked[x] >= r}
    head = [ranked[p] << _RANK | (p in care) << _CARE | i for p, i in zip(table.pieces, table.ids, strict=True)]
    frame = pd.DataFrame({"piece": table.pieces, "head": head, "score": table.scores})
    pieces = spark.createDataFrame(frame, "piece string, head long, score double")
    return pieces.unionByName(spark.sql("SELECT '' AS piece, CAST(NULL AS BIGINT) AS head, 0D AS score"))


def units_of(docs: DataFrame) -> DataFrame:
    """``unit, n``: the distinct units of all texts and how often they occur."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _ranges(batch.column("text"), _COUNT_CHARS):
                h, check, starts, ends, _ = unit_hashes(texts)
                order = np.argsort(h, kind="stable")
                new = np.ones(len(h), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
                at = np.flatnonzero(new)
                first, flat = order[at], "".join(texts)
                spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flat[x:y] for x, y in spans], pa.string()), pa.array(np.diff(np.append(at, len(h))))], names=["unit", "n"]
                )

    rows = docs.select(whole_text().alias("text")).mapInArrow(counted, "unit string, n long")
    return rows.groupBy("unit").agg(F.sum("n").alias("n"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def lattice(units: DataFrame, pieces: DataFrame, table: Pieces, parts: int) -> DataFrame:
    """``unit, n, edges``: for each unit (uid, unit, n) its edges, best first.

    ``pieces`` is broadcast: a fixed table. Units are dealt out once, to ``parts`` tasks; exploding and
    joining keep the rows where their unit is, so grouping needs no further exchange. An
    empty substring, which the empty piece joins, keeps units without any edge. Of BPE
    pieces only those of two characters or more are edges: all others are there anyway.
    """
    length, least = F.char_length("unit"), 2 if table.kind == "bpe" else 1
    exploded = (
        units.repartition(parts, "uid")
        .select("uid", "unit", "n", F.explode(F.sequence(F.lit(0), F.greatest(length - least, F.lit(0)))).alias("start"))
        .select(
            "*",
            F.explode(
                F.sequence(F.when(F.col("start") == 0, 0).otherwise(least), F.least(length - F.col("start"), F.lit(table.longest)))
            ).alias("size"),
        )
        .select("uid", "unit", "n", "start", (F.col("start") + F.col("size")).alias("end"), F.substring("unit", F.col("start") + 1, F.col("size")).alias("part"))
    )
    # a join on one long alone, and the exact test as an order that is no second key
    same = (F.xxhash64("part") == F.xxhash64("piece")) & (F.col("part") >= F.col("piece")) & (F.col("part") <= F.col("piece"))
    packed = F.col("head") + F.shiftleft(F.col("start").cast("long"), _START) + F.shiftleft(F.col("end").cast("long"), _END)
    if table.kind == "bpe":
        low, high = _bit(F.col("start")), _bit(F.col("end"))
        opened = F.struct(packed.alias("code"), low.bitwiseOR(high).alias("bounds"), (high + high - low).alias("span"))
        edge = F.when(F.col("end") - F.col("start") > 1, opened)
    else:
        edge = F.when(packed.isNotNull(), F.struct("end", "start", "score", packed.alias("code")))
    return (
        exploded.join(F.broadcast(pieces), same)
        .groupBy("uid")
        .agg(F.first("unit").alias("unit"), F.first("n").alias("n"), F.sort_array(F.collect_list(edge)).alias("edges"))
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fits(bounds: Column, edge: Column) -> Column:
    """Whether one piece goes from the edge's start to a middle, and one from there to its end."""
    inside = bounds.bitwiseAND(edge["span"])
    return (F.bit_count(inside) == 3) & (inside.bitwiseAND(edge["bounds"]) == edge["bounds"])


def _taken(bounds: Column, edge: Column) -> Column:
    """``bounds`` without those inside ``edge``."""
    return bounds.bitwiseAND(F.bitwise_not(edge["span"].bitwiseXOR(edge["bounds"])))


def _stepwise(steps: Column, bounds: Column) -> Column:
    """BPE by its definition: each time the best edge that fits, until none does."""

    def step(state: Column, _: Column) -> Column:
        best = F.get(F.filter(steps, lambda e: _fits(state, e)), F.lit(0))
        return _let(best, lambda e: F.coalesce(_taken(state, e), state))

    return F.aggregate(steps, bounds, step)


def _merged(edges: Column, length: Column) -> Column:
    """BPE: the codes of the edges that stand at the end.

    The bounds between pieces are the bits of a long; edges are (code, bounds, span): the
    bits of their two ends, and of all places from one to the other.
    """
    single = _bit(length + 1) - 1

    def fold(steps: Column) -> Column:
        def lets_in(e: Column) -> Column:
            """Whether an edge before ``e`` holds it at one of its own ends: ``e`` may let that one in too late."""
            care = F.shiftright(e["code"], _CARE).bitwiseAND(1) == 1
            return care & F.exists(
                steps,
                lambda q: (q["code"] < e["code"])
                & (q["span"].bitwiseAND(e["span"]) == e["span"])
                & (q["bounds"].bitwiseAND(e["bounds"]) != 0),
            )

        def sweep(state: Column, e: Column) -> Column:
            return F.when(_fits(state, e), _taken(state, e).bitwiseOR(F.when(lets_in(e), F.lit(_AGAIN)).otherwise(F.lit(0)))).otherwise(state)

        swept = F.aggregate(steps, single, sweep)
        bounds = _let(swept, lambda state: F.when(state >= _AGAIN, _stepwise(steps, single)).otherwise(state))
        return _let(bounds, lambda x: F.transform(F.filter(steps, lambda e: x.bitwiseAND(e["span"]) == e["bounds"]), lambda e: e["code"]))

    return _let(edges, fold)


def _viterbi(edges: Column, length: Column) -> Column:
    """Unigram: the edges of the best path; characters without a piece are edges of a very low score."""
    low = -1e9
    by_end = F.array_sort(
        F.concat(
            F.transform(edges, lambda e: F.struct(e["end"].alias("end"), e["start"].alias("start"), e["score"].alias("score"))),
            F.transform(
                F.sequence(F.lit(0), length - 1),
                lambda s: F.struct((s + 1).alias("end"), s.alias("start"), F.lit(low).alias("score")),
            ),
        )
    )
    start = F.transform(
        F.sequence(F.lit(0), length),
        lambda i: F.struct(F.when(i == 0, 0.0).otherwise(-1e300).alias("score"), F.lit(-1).alias("back")),
    )

    def reach(state: Column, e: Column) -> Column:
        def better(through: Column) -> Column:
            return F.transform(
                state,
                lambda x, i: F.when(
                    (i == e["end"]) & (through > x["score"]), F.struct(through.alias("score"), e["start"].alias("back"))
                ).otherwise(x),
            )

        return _let(F.get(state, e["start"])["score"] + e["score"], better)

    def walk(best: Column) -> Column:
        """The places of the best path, from its end backwards."""
        return F.aggregate(
            F.sequence(F.lit(1), length),
            F.array(length),
            lambda path, _: _let(
                F.get(path, F.lit(0)),
                lambda at: F.when(at > 0, F.concat(F.array(F.get(best, at)["back"]), path)).otherwise(path),
            ),
        )

    def ends(path: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), length),
            lambda i: F.coalesce(F.get(path, F.nullif(F.array_position(path, i), F.lit(0)).cast("int")), F.lit(-1)),
        )

    best = _let(_let(F.aggregate(by_end, start, reach), walk), ends)
    return _let(best, lambda x: F.transform(F.filter(edges, lambda e: F.get(x, e["start"]) == e["end"]), lambda e: e["code"]))


def fold_python(unit: str, scores: dict[str, float], longest: int, kind: str) -> list[tuple[int, int]]:
    """(start, end) of the pieces: the folds above for one long unit, without a list of its edges."""
    n = len(unit)
    if kind == "bpe":
        end, begin, heap = list(range(1, n + 1)), list(range(-1, n)), []

        def offer(s: int, e: int) -> None:
            if (score := scores.get(unit[s:e])) is not None:
                heapq.heappush(heap, (-score, s, e))

        for i in range(n - 1):
            offer(i, i + 2)
        while heap:
            _, s, e = heapq.heappop(heap)
            middle = end[s]
            if middle < 0 or middle >= e or middle >= n or end[middle] != e:
                continue
            end[s], end[middle] = e, -1
            if e < n:
                begin[e] = s
                offer(s, end[e])
            if s > 0:
                offer(begin[s], e)
        return [(s, e) for s, e in enumerate(end) if e > 0]
    score, back = [0.0] + [-1e300] * n, [-1] * (n + 1)
    for e in range(1, n + 1):
        for s in range(max(0, e - longest), e):
            gain = scores.get(unit[s:e])
            for x in ([gain] if gain is not None else []) + ([-1e9] if s == e - 1 else []):
                if score[s] + x > score[e]:
                    score[e], back[e] = score[s] + x, s
    path, at = [], n
    while at > 0:
        path.append((back[at], at))
        at = back[at]
    return path[::-1]


class _Spelling:
    """The ids of single characters, as sorted code points; others as bytes or the unknown piece."""

    def __init__(self, table: Pieces):
        known = sorted((ord(p), i) for p, i in zip(table.pieces, table.ids, strict=True) if len(p) == 1)
        self.points = np.array([c for c, _ in known], np.int64)
        self.ids = np.array([i for _, i in known], np.int64)
        self.bytes, self.unknown = table.byte_ids, table.unknown

    def spell(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of characters in order, and how many each has."""
        at = np.minimum(np.searchsorted(self.points, code), max(len(self.points) - 1, 0))
        known = self.points[at] == code if len(self.points) else np.zeros(len(code), bool)
        lists = [[int(self.ids[k])] if ok else self._other(int(c)) for k, ok, c in zip(at, known, code, strict=True)] if not known.all() else None
        if lists is None:
            return self.ids[at], np.ones(len(code), np.int64)
        return np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists], np.int64)

    def _other(self, c: int) -> list[int]:
        return [self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]


def encode_units(units: DataFrame, table: Pieces, total: int) -> DataFrame:
    """``hash, check, n, ids`` for every unit of (uid, unit, n); ``total`` is their number."""
    parts = total // PART_UNITS + 1
    length, spelling = F.char_length("unit"), _Spelling(table)
    edged = lattice(units.filter(length <= LONG_UNIT), piece_table(units.sparkSession, table), table, parts)
    fold = _merged if table.kind == "bpe" else _viterbi
    scores, number = dict(zip(table.pieces, table.scores, strict=True)), dict(zip(table.pieces, table.ids, strict=True))

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of pieces at their places, those of all other characters between them."""
        for batch in batches:
            texts = batch.column("unit").to_pylist()
            if not texts:
                continue
            code, starts, ends = _joined(texts)
            count = batch.column("taken").value_lengths().to_numpy(zero_copy_only=False)
            taken = batch.column("taken").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            begin = np.repeat(starts, count)
            low, high = begin + (taken >> _START & 255), begin + (taken >> _END & 255)
            change = np.zeros(len(code) + 1, np.int64)
            np.add.at(change, low, 1)
            np.add.at(change, high, -1)
            single = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            ids, each = spelling.spell(code[single].astype(np.int64))
            place = np.concatenate([low, np.repeat(single, each)])
            order = np.argsort(place, kind="stable")
            size = np.bincount(np.searchsorted(starts, place, "right") - 1, minlength=len(texts))
            yield _coded(code, starts, ends, batch.column("n"), size, np.concatenate([taken & _ID, ids])[order])

    def long_finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column("unit").to_pylist()):
                ids: list[int] = []
                for s, e in fold_python(text, scores, table.longest, table.kind):
                    piece = text[s:e]
                    ids += [number[piece]] if piece in number else spelling._other(ord(piece))
                code, starts, ends = _joined([text])
                yield _coded(code, starts, ends, batch.column("n").slice(row, 1), np.array([len(ids)]), np.array(ids, np.int64))

    form = "hash long, check int, n long, ids array<int>"
    short = edged.select("unit", "n", fold(F.col("edges"), length).alias("taken")).mapInArrow(finished, form)
    return short.unionByName(units.filter(length > LONG_UNIT).select("unit", "n").mapInArrow(long_finished, form))


def _coded(code: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: pa.Array, size: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    hashes, check = _hashed(code, starts, ends)
    edge = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(hashes.view(np.int64)), pa.array(check.view(np.int32)), n, pa.ListArray.from_arrays(pa.array(edge), pa.array(ids, pa.int32()))],
        names=["hash", "check", "n", "ids"],
    )


_KIND = None


def _kinds() -> np.ndarray:
    """For each code point 0 for the mark, 1 for letters and their marks, 2 for others."""
    global _KIND
    if _KIND is None:
        import unicodedata

        _KIND = np.full(0x110000, 2, np.uint8)
        letters = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] in "LM"]
        _KIND[letters] = 1
        _KIND[ord(MARK)] = 0
    return _KIND


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of texts that are not empty, and where each starts and ends."""
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), ends - size, ends


def _hashed(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and a 32-bit check of each span; spans follow each other without a gap."""
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    powers = np.multiply.accumulate(np.full(int((ends - starts).max()), _BASE, np.uint64))
    value = (code.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(code)) - np.repeat(starts, ends - starts)]
    hashes = mix(np.add.reduceat(value, starts))
    value ^= value >> np.uint64(29)
    value *= _BASE
    return hashes, (np.add.reduceat(value, starts) >> np.uint64(32)).astype(np.uint32)


def unit_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of escaped texts: hash, check, start and end of each unit in the joined texts, and units a text."""
    code, begin, last = _joined(texts)
    if not len(code):
        none = np.empty(0, np.int64)
        return *_hashed(code, none, none), none, none, np.zeros(len(texts), np.int64)
    kind = _kinds()[code]
    first = np.empty(len(code), bool)
    first[0] = True
    first[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != 0)
    first[begin[last > begin]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(code))
    seen = np.concatenate(([0], np.cumsum(first)))
    return *_hashed(code, starts, ends), starts, ends, seen[last] - seen[begin]


@dataclass
class Lookup:
    """Sorted unit hashes with their checks, and where each one's ids are."""

    hashes: np.ndarray
    checks: np.ndarray
    first: np.ndarray
    size: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, checks: np.ndarray, size: np.ndarray, ids: np.ndarray) -> Lookup:
        order = np.argsort(hashes, kind="stable")
        first = (np.cumsum(size, dtype=np.int64) - size).astype(np.uint32 if len(ids) < 2**32 else np.int64)
        return cls(hashes[order], checks[order], first[order], size[order], ids)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The place of each unit, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out = np.where((self.hashes[at] == hashes) & (self.checks[at] == checks), at, -1)
        for k in np.flatnonzero((out < 0) & (self.hashes[at] == hashes)):  # two units of one hash
            i = int(at[k])
            while i < len(self.hashes) and self.hashes[i] == hashes[k]:
                if self.checks[i] == checks[k]:
                    out[k] = i
                i += 1
        return out


_HELD: dict[tuple[str, int], Lookup] = {}


def _loaded(folder: str, least: int) -> Lookup:
    """In a worker: the codes of ``folder`` whose unit is common enough. A worker holds one such table."""
    if (folder, least) not in _HELD:
        _HELD.clear()
        _HELD[folder, least] = _read(folder, least)
    return _HELD[folder, least]


def _read(folder: str, least: int) -> Lookup:
    from pyarrow import dataset, fs

    files, path = fs.FileSystem.from_uri(folder)
    common = dataset.field("common") >= least
    kept: tuple[list, list, list, list] = ([np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.int32)], [np.empty(0, np.int32)])
    for f in dataset.dataset(path, filesystem=files, format="parquet").get_fragments():
        for b in f.to_batches(columns=["hash", "check", "ids"], filter=common, use_threads=False, batch_readahead=1):
            ids = b.column("ids")
            flat = ids.flatten().to_numpy()
            kept[0].append(b.column("hash").to_numpy().view(np.uint64))
            kept[1].append(b.column("check").to_numpy().view(np.uint32))
            kept[2].append(ids.value_lengths().to_numpy().astype(np.int32))
            kept[3].append(flat.astype(np.uint16) if len(flat) and flat.max() < 2**16 else flat.astype(np.int32))
    if all(x.dtype == np.uint16 for x in kept[3][1:]):
        del kept[3][0]
        kept[3].append(np.empty(0, np.uint16))
    columns = []
    for part in kept:
        columns.append(np.concatenate(part))
        part.clear()
        pa.default_memory_pool().release_unused()
    return Lookup.of(*columns)


def _escape(text: str | None) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _ranges(column: pa.Array, most: int = _CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of about ``most`` characters, each with its escaped texts: only one is held as Python strings."""
    end = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + most, "right")))
        yield i, j, [_escape(t) for t in column.slice(i, j - i).to_pylist()]
        i = j


def _code_table(docs: DataFrame, table: Pieces) -> tuple[DataFrame, str]:
    """``hash, check, common, ids`` of all units, and the folder that holds it; ``common`` grows with the count."""
    counted = staged(units_of(docs).withColumn("uid", F.monotonically_increasing_id()), "units")
    coded = encode_units(counted, table, counted.count())
    return staged_at(coded.select("hash", "check", F.floor(F.log2("n") * 16).cast("int").alias("common"), "ids"), "codes")


def _least(codes: DataFrame, lookup_bytes: int) -> int | None:
    """The least ``common`` of which all codes fit, or None if they all do. One row for each sixteenth of a power of two."""
    weight = F.sum(F.size("ids") * 4 + 24).alias("bytes")
    held, least = 0, None
    for row in sorted(codes.groupBy("common").agg(weight).collect(), reverse=True):
        held += row["bytes"]
        if held > lookup_bytes:
            return row["common"] + 1 if least is None else least
        least = row["common"]
    return None


def encode(docs: DataFrame, table: Pieces | None = None, lookup_bytes: int = LOOKUP_BYTES, decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, token_ids`` for every row of ``docs``, and with ``decoded`` also ``text``, what the ids stand for."""
    table = table or load_pieces()
    codes, folder = _code_table(docs, table)
    least = _least(codes, lookup_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole_text().alias("text"))
    if least is None:
        rows = rows.withColumn("own", F.lit(None).cast("array<struct<hash:long,check:int,ids:array<int>>>"))
    else:
        rows = _with_own(rows, codes.filter(F.col("common") < least), folder, least)
    surface = _Surface(table) if decoded else None

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _loaded(folder, least or 0)
        for batch in batches:
            for i, j, texts in _ranges(batch.column("text")):
                count, ids = _looked_up(texts, batch.column("own").slice(i, j - i), known)
                edge = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                columns = {
                    "doc_id": batch.column("doc_id").slice(i, j - i),
                    "n_tokens": pa.array(count),
                    "token_ids": pa.ListArray.from_arrays(edge, pa.array(ids)),
                }
                if surface:
                    columns["text"] = pa.array(surface.spell(ids, count), pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(encoded, f"doc_id {kind}, n_tokens long, token_ids array<int>" + (", text string" if decoded else ""))


def _looked_up(texts: list[str], own: pa.Array, known: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """The number of tokens of each escaped text, and the ids of all in order."""
    hashes, checks, _, _, n = unit_hashes(texts)
    at = known.find(hashes, checks)
    size, first, flat = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), known.ids
    held = at >= 0
    size[held], first[held] = known.size[at[held]], known.first[at[held]]
    if not held.all():  # what these texts bring along
        brought = {(h["hash"], h["check"]): h["ids"] for row in own.to_pylist() for h in row or ()}
        extra = Lookup.of(
            np.array([h for h, _ in brought], np.int64).view(np.uint64),
            np.array([c for _, c in brought], np.int32).view(np.uint32),
            np.array([len(x) for x in brought.values()], np.int64),
            np.array([i for x in brought.values() for i in x], np.int32),
        )
        late = extra.find(hashes[~held], checks[~held])
        if late.min() < 0:
            raise RuntimeError("a unit without a code: the texts changed while they were encoded")
        size[~held], first[~held] = extra.size[late], extra.first[late]
        own_ids = extra.ids
    last = np.cumsum(size)
    place = np.repeat(first - (last - size), size) + np.arange(int(last[-1]) if len(last) else 0)
    if held.all():
        ids = flat[place]
    else:
        known_id = np.repeat(held, size)
        ids = np.empty(len(place), np.int32)
        ids[known_id], ids[~known_id] = flat[place[known_id]], own_ids[place[~known_id]]
    edge = np.concatenate(([0], last))[np.concatenate(([0], np.cumsum(n)))]
    return np.diff(edge), ids.astype(np.int32, copy=False)


def _with_own(rows: DataFrame, rare: DataFrame, folder: str, least: int) -> DataFrame:
    """``rows`` with the codes of the units that the table in ``folder`` lacks, as ``own``."""

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _ranges(batch.column("text")):
                hashes, checks, _, _, n = unit_hashes(texts)
                lacks = np.flatnonzero(_loaded(folder, least).find(hashes, checks) < 0)
                row = np.repeat(np.arange(i, j), n)[lacks]
                order = np.lexsort((hashes[lacks], row))
                lacks, row = lacks[order], row[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[lacks][1:] != hashes[lacks][:-1]) | (checks[lacks][1:] != checks[lacks][:-1])
                lacks, row = lacks[new], row[new]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row)), pa.array(hashes[lacks].view(np.int64)), pa.array(checks[lacks].view(np.int32))],
                    names=["key", "hash", "check"],
                )

    keyed = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    own = (
        keyed.select("key", "text")
        .mapInArrow(missing, "key long, hash long, check int")
        .join(rare.select("hash", "check", "ids"), ["hash", "check"])
        .groupBy("key")
        .agg(F.collect_set(F.struct("hash", "check", "ids")).alias("own"))
    )
    return keyed.join(own, "key", "left").select("doc_id", "text", "own")


class _Surface:
    """The bytes that ids stand for, packed."""

    def __init__(self, table: Pieces):
        self.top = max(table.surface, default=-1) + 2  # the last place stands for all other ids
        spelt = [table.surface.get(i, " ⁇ ".encode()) for i in range(self.top)]
        self.size = np.array([len(b) for b in spelt], np.int64)
        self.first, self.raw = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(spelt), np.uint8)

    def spell(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        ids = np.where((ids < 0) | (ids >= self.top), self.top - 1, ids)
        size = self.size[ids]
        last = np.cumsum(size)
        flat = self.raw[np.repeat(self.first[ids] - (last - size), size) + np.arange(int(last[-1]) if len(last) else 0)]
        edge = np.concatenate(([0], np.concatenate(([0], last))[np.cumsum(count)])).tolist()
        whole = flat.tobytes()
        return [whole[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(edge[:-1], edge[1:], strict=True)]


def decode(encoded: DataFrame, table: Pieces | None = None) -> DataFrame:
    """``encoded`` with ``text``, the text that its ``token_ids`` stand for."""
    surface = _Surface(table or load_pieces())

    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        count = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        end = np.cumsum(count)
        out: list[str] = []
        while len(out) < len(rows):  # about _CHUNK_IDS ids at a time
            i = len(out)
            j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + _CHUNK_IDS)))
            ids = rows.slice(i, j - i).flatten().to_numpy(zero_copy_only=False)
            out += surface.spell(ids.astype(np.int64), count[i:j])
        return pa.array(out, pa.string())

    return encoded.withColumn("text", text("token_ids"))
