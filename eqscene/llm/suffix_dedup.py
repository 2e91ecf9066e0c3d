"""Operator 6: repeated byte strings by a distributed difference-cover suffix sort.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a document with
a smaller doc_id; strings are judged on the input, and overlaps count.

1. Folding. Of equal texts (128 bits) those of later documents go at once; the others are
   kept in chunks, compressed.
2. Narrowing. The mark of a string is the least (the last of equal ones) of the ``SPAN``
   hashes of ``GRAM`` bytes in it; strings that follow each other and share their mark
   are a run. Hashes of marks travel packed, by chunks and buckets, ``PACKED`` bytes each,
   and those of several documents come back to their chunk. What the packing confuses is
   only looked at once more, as are hashes of one document that lies in two chunks.
3. Meeting. Equal strings have equal marks, so the bytes of the runs left go to the bucket
   of their mark, each distinct one of a chunk once, with its places. Runs of a mark that
   very many texts hold are dealt out string by string, by a hash of the whole string.
4. Difference cover. In a bucket, of the places modulo 3, residues 1 and 2 are sampled.
   The triples of 8-byte letters there are sorted and named by their ranks; pairs of
   names 24 bytes apart, which stand for 48 bytes, are sorted and named again. Recursion
   ends there, as strings are compared to ``WIDTH`` bytes only.
5. Merging. Two places of any residues have a distance of at most 2 at which both are
   sampled, so every string has two forms, each of a name and the two bytes that it
   lacks, and any two places share a form. Equal forms are equal strings; the least
   doc_id of each is what later places are held against, and what is to go comes back
   to the chunk as spans.

Edge cases: null and empty texts, and those under WIDTH bytes, lose nothing; a null
doc_id neither loses nor removes anything; rows that share a doc_id do not remove each
other's bytes, equal texts or not; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import broadcast_if_small, staged, whole_text
from eqscene.llm._shingles import mix

WIDTH = 50
GRAM = 24
SPAN = WIDTH - GRAM + 1
LETTERS = 24  # bytes of a triple
#: So many strings are marked at once; places share a number with hashes.
BATCH_BITS = 17
BATCH = (1 << BATCH_BITS) - WIDTH
#: Texts are kept in chunks of about so many bytes.
CHUNK = 4_000_000
#: A packed hash, its bits for a flag, and the bits of its bucket: one for about so many bytes of texts.
PACKED, FLAG_BITS, MOST_BITS, BUCKET_BYTES = 5, 3, 12, 4_000_000
NUMBER_BITS = 8 * PACKED - FLAG_BITS
#: Runs of a mark with about so many places are dealt out string by string.
HEAVY = 1 << 14
#: Buckets of more bytes of runs are worked on in parts, by this many more bits of the hash.
PART_BYTES, PART_BITS = 4_000_000, 8


def _letters(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one ordered number."""
    out = np.empty(max(len(raw) - 7, 0), np.uint64)
    for i in range(min(8, len(out))):
        out[i::8] = raw[i : i + (len(raw) - i) // 8 * 8].view(">u8")
    return out


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``count`` of each."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before, the first one included."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def runs(raw: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings that share their mark: first string, last, the mark's place, its hash.

    ``raw`` has texts of WIDTH bytes at least, which end at ``end``.
    """
    n = max(len(raw) - WIDTH + 1, 0)
    inside = np.ones(n, bool)
    for e in end[:-1].tolist():
        inside[e - WIDTH + 1 : e] = False
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    last = np.uint64((1 << BATCH_BITS) - 1)
    for low in range(0, n, BATCH):
        letter = _letters(raw[low : low + BATCH + WIDTH - 1])
        k = len(letter) + 8 - GRAM
        grams = mix(letter[:k] + mix(letter[8 : 8 + k] + mix(letter[16 : 16 + k])))
        # the place, counted from behind, in the low bits: the least is the last of equal ones
        least = (grams | last) - np.arange(k, dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        string = np.flatnonzero(inside[low : low + BATCH])
        at = (last - (least[string] & last)).astype(np.int64)
        new = _edges(at)
        out.append((string[new] + low, string[np.append(new[1:], len(at)) - 1] + low if len(at) else string, at[new] + low, grams[at[new]]))
    start, stop, place, value = (np.concatenate(c) for c in zip(*out, strict=True))
    new = _edges(place)  # a run may go on in the next batch
    # the least of many hashes are small numbers; mixed again they spread evenly
    return start[new], stop[np.append(new[1:], len(stop)) - 1] if len(stop) else stop, place[new], mix(value[new])


def marks(held: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of texts: the number of the text, the hash, its place there."""
    end = np.cumsum([len(p) for p in held], dtype=np.int64)
    _, _, place, value = runs(np.frombuffer(b"".join(held), np.uint8), end)
    row = np.searchsorted(end, place, "right")
    return row, value, place - np.append(0, end)[row]


def _packed(value: np.ndarray) -> bytes:
    """The low PACKED bytes of numbers."""
    return value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED].tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    out = np.zeros((len(held) // PACKED, 8), np.uint8)
    out[:, :PACKED] = np.frombuffer(held, np.uint8).reshape(-1, PACKED)
    return out.view("<u8").ravel()


def _squeezed(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(c.tobytes() for c in columns), codec="zstd", asbytes=True)


def _loosened(block: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(block, size, codec="zstd"), np.uint8)


def _order(docs: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Numbers in the order of doc_ids, equal ones for equal ids."""
    return np.unique(docs.to_numpy(zero_copy_only=False) if isinstance(docs, pa.Array) else docs.to_numpy(), return_inverse=True)[1]


def _pieces(most: int):
    """Rows (chunk, docs, sizes, size, block): whole texts, about ``most`` bytes together, compressed."""

    def told(docs: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
        ids, column = pa.concat_arrays(docs), pa.concat_arrays(texts)
        one = pa.array([0, len(ids)], pa.int32())
        raw = b"".join(column.to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid4().int >> 65], pa.int64()),
                pa.ListArray.from_arrays(one, ids),
                pa.ListArray.from_arrays(one, pc.binary_length(column).cast(pa.int32())),
                pa.array([len(raw)], pa.int64()),
                pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary()),
            ],
            names=["chunk", "docs", "sizes", "size", "block"],
        )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, texts, held = [], [], 0
        for b in batches:
            ids, column = b.column("doc_id"), b.column("text").cast(pa.binary())
            reach = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
            i = 0
            while i < len(reach):
                before = reach[i - 1] if i else 0
                j = min(int(np.searchsorted(reach, before + most - held)) + 1, len(reach))
                docs.append(ids[i:j])
                texts.append(column[i:j])
                held += int(reach[j - 1] - before)
                i = j
                if held >= most:
                    yield told(docs, texts)
                    docs, texts, held = [], [], 0
        if docs:
            yield told(docs, texts)

    return pieces


def _text(table: pa.Table | pa.RecordBatch, i: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of a row of pieces: doc_ids, the ends of their texts, and the texts."""
    sizes = table.column("sizes")[i].values.to_numpy(zero_copy_only=False)
    return table.column("docs")[i].values, np.cumsum(sizes, dtype=np.int64), _loosened(table.column("block")[i].as_py(), table.column("size")[i].as_py())


def _number(value: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of hashes, and under it what is packed of them."""
    return value >> np.uint64(64 - bits - NUMBER_BITS)


def _by_bucket(number: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Buckets of sorted numbers, and their numbers packed with a flag."""
    bucket = (number >> np.uint64(NUMBER_BITS)).astype(np.int64)
    held = (number << np.uint64(FLAG_BITS)) & np.uint64((1 << 8 * PACKED) - 1) | flag.astype(np.uint64)
    edge = _edges(bucket)
    return bucket[edge], [_packed(x) for x in np.split(held, edge[1:])] if len(edge) else []


def _tally(bits: int):
    """Rows (bucket, chunk, marks): distinct hashes of a chunk, with a class of their number if several documents hold them."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, chunk in enumerate(b.column("chunk").to_pylist()):
                docs, end, raw = _text(b, i)
                _, _, place, value = runs(raw, end)
                number, doc = _number(value, bits), _order(docs)[np.searchsorted(end, place, "right")]
                order = np.argsort(number)
                number, doc = number[order], doc[order]
                new = _edges(number)
                several = np.minimum.reduceat(doc, new) < np.maximum.reduceat(doc, new)
                count = np.diff(np.append(new, len(doc)))
                bucket, held = _by_bucket(number[new], np.where(several, np.minimum(1 + np.log2(count).astype(np.int64) // 2, 7), 0))
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array([chunk] * len(bucket), pa.int64()), pa.array(held, pa.binary())], names=["bucket", "chunk", "marks"])

    return tally


def _shared(heavy: int):
    """Of a bucket: for each chunk its hashes that several documents or chunks hold, flagged if about ``heavy`` places have them."""

    def shared(group: pa.Table) -> pa.Table:
        parts = [_unpacked(x) for x in group.column("marks").to_pylist()]
        bucket, chunk = group.column("bucket")[0].as_py(), group.column("chunk")
        held = np.concatenate(parts)
        grade = (held & np.uint64((1 << FLAG_BITS) - 1)).astype(np.int64)
        number = held >> np.uint64(FLAG_BITS)
        at = np.unique(number, return_inverse=True)[1]
        total = np.bincount(at, np.where(grade > 0, 2 * 4 ** np.maximum(grade - 1, 0), 1))[at]
        held = number << np.uint64(FLAG_BITS) | (total >= heavy).astype(np.uint64)
        cut = np.cumsum([0, *(len(x) for x in parts)]).tolist()
        kept = [_packed(held[i:j][total[i:j] > 1]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
        rows = [k for k, x in enumerate(kept) if x]
        return pa.table(
            {
                "chunk": chunk.take(pa.array(rows, pa.int64())),
                "bucket": pa.array([bucket] * len(rows), pa.int64()),
                "marks": pa.array([kept[k] for k in rows], pa.binary()),
            }
        )

    return shared


def _strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Byte strings that lie one after the other."""
    offset = np.append(0, np.cumsum(size)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offset), pa.py_buffer(data)])


def _flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and where each starts and the last one ends."""
    _, offset, data = strings.buffers()
    offset = np.frombuffer(offset, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8)[offset[0] : offset[-1]], offset - offset[0]


def _folded(strings: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct strings, which of them each is, and the first that is each of them."""
    coded = strings.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    return coded.dictionary, code, np.unique(code, return_index=True)[1]


def _single(distinct: pa.Array, bucket: np.ndarray, code: np.ndarray, where: np.ndarray, many: np.ndarray, bits: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The same runs and their places, but of ``many`` each string alone, in the bucket (and part) of its own hash."""
    data, offset = _flat(distinct)
    n = np.where(many, np.diff(offset) - WIDTH + 1, 0)
    at = _ranges(offset[:-1], n)
    alone, which, first = _folded(_strings(data[_ranges(at, np.full(len(at), WIDTH))], np.full(len(at), WIDTH)))
    letter, hashed = _letters(data), np.zeros(len(first), np.uint64)
    for i in (*range(0, WIDTH - 8, 8), WIDTH - 8):
        hashed = mix(hashed + letter[at[first] + i])
    few, of = np.flatnonzero(~many), many[code]
    base, count = (np.cumsum(n) - n)[code[of]], n[code[of]]
    return (
        pa.concat_arrays([distinct.take(pa.array(few)), alone]),
        np.concatenate([bucket[few], (hashed >> np.uint64(64 - bits - PART_BITS)).astype(np.int64)]),
        np.concatenate([np.cumsum(~many)[code[~of]] - 1, which[_ranges(base, count)] + len(few)]),
        np.concatenate([where[~of], _ranges(where[of], count)]),
    )


def _opened(bits: int):
    """Rows (bucket, chunk, docs, contexts, places, size, block): the distinct runs of a chunk whose mark is shared, and their places."""

    def opened(pieces: pa.Table, shared: pa.Table) -> pa.Table:
        docs, end, raw = _text(pieces, 0)
        out: list[list] = [[] for _ in range(6)]
        if len(shared):
            start, stop, _, value = runs(raw, end)
            number = _number(value, bits)
            parts = [_unpacked(x) for x in shared.column("marks").to_pylist()]
            held = np.concatenate(parts)
            of = np.repeat(shared.column("bucket").to_numpy().astype(np.uint64), [len(x) for x in parts])
            known = of << np.uint64(NUMBER_BITS) | held >> np.uint64(FLAG_BITS)
            order = np.argsort(known)
            known, heavy = known[order], (held[order] & np.uint64(1)).astype(bool)
            at = np.minimum(np.searchsorted(known, number), len(known) - 1)
            hit = known[at] == number
            where, size, many, bucket = start[hit], (stop - start)[hit] + WIDTH, heavy[at[hit]], (number[hit] >> np.uint64(NUMBER_BITS - PART_BITS)).astype(np.int64)
            distinct, code, first = _folded(_strings(raw[_ranges(where, size)], size))
            many, bucket = many[first], bucket[first]
            if many.any():
                distinct, bucket, code, where = _single(distinct, bucket, code, where, many, bits)
            by = np.argsort(bucket, kind="stable")
            data, offset = _flat(distinct.take(pa.array(by)))
            bucket, code = bucket[by], np.argsort(by)[code]
            order = np.argsort(code, kind="stable")
            where, places = where[order], np.bincount(code, minlength=len(by))
            text, reach = np.searchsorted(end, where, "right"), np.append(0, np.cumsum(places))
            part, bucket = bucket & ((1 << PART_BITS) - 1), bucket >> PART_BITS
            edge = [*_edges(bucket).tolist(), len(bucket)]
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                own, doc = np.unique(text[reach[i] : reach[j]], return_inverse=True)
                parts = [
                    np.diff(offset[i : j + 1]).astype(np.uint8),
                    part[i:j].astype(np.uint8),
                    places[i:j].astype("<i4"),
                    doc.astype("<i4"),
                    where[reach[i] : reach[j]].astype("<i4"),
                    data[offset[i] : offset[j]],
                ]
                row = (int(bucket[i]), docs.take(pa.array(own)), j - i, int(reach[j] - reach[i]), sum(p.nbytes for p in parts), _squeezed(*parts))
                for column, x in zip(out, row, strict=True):
                    column.append(x)
        ids = pa.concat_arrays(out[1]) if out[1] else docs[:0]
        cut = pa.array(np.cumsum([0, *map(len, out[1])]), pa.int32())
        return pa.table(
            {
                "bucket": pa.array(out[0], pa.int64()),
                "chunk": pa.array([pieces.column("chunk")[0].as_py()] * len(out[0]), pa.int64()),
                "docs": pa.ListArray.from_arrays(cut, ids),
                **{name: pa.array(column, pa.int64()) for name, column in zip(("contexts", "places", "size"), out[2:5], strict=True)},
                "block": pa.array(out[5], pa.binary()),
            }
        )

    return opened


def forms(p: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """For each place its two forms: kind (bytes before the name) and the name's place."""
    kind = np.array([[1, 2], [1, 0], [0, 2]])[p % 3]
    return (kind[:, 0], p + kind[:, 0]), (kind[:, 1], p + kind[:, 1])


def _names(*columns: np.ndarray) -> np.ndarray:
    """The ranks of rows of ordered numbers, equal ones for equal rows."""
    out = np.unique(columns[0], return_inverse=True)[1].astype(np.int64)
    for c in columns[1:]:
        out = np.unique(out << 32 | np.unique(c, return_inverse=True)[1], return_inverse=True)[1]
    return out


def least_of_strings(text: np.ndarray, p: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For the strings of WIDTH bytes at ``p``: the least ``doc`` of all equal ones, by a difference cover modulo 3."""
    (kind, q), (kind2, q2) = forms(p)
    kind, q, p2 = np.concatenate([kind, kind2]), np.concatenate([q, q2]), np.concatenate([p, p])
    first = np.zeros(len(text), bool)
    first[q] = True
    sampled = first.copy()
    sampled[LETTERS:] |= first[:-LETTERS]
    at, pair = np.flatnonzero(sampled), np.flatnonzero(first)
    letter = _letters(text)
    name = np.zeros(len(text), np.int64)
    name[at] = _names(letter[at], letter[at + 8], letter[at + 16])
    name[pair] = _names(name[pair], name[pair + LETTERS])
    # the two bytes that a name of 48 bytes lacks
    byte = text.astype(np.int64)
    rest = byte[np.where(kind == 0, p2 + 48, p2)] << 8 | byte[np.where(kind == 2, p2 + 1, p2 + 49)]
    form = name[q] << 18 | kind << 16 | rest
    order = np.argsort(form)
    new = _edges(form[order])
    out = np.empty(len(form), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(np.concatenate([doc, doc])[order], new), np.diff(np.append(new, len(form)))) if len(form) else 0
    return np.minimum(out[: len(p)], out[len(p) :])


def _repeated(most: int):
    """Of a bucket: for each chunk the spans (start, end) of places whose string starts in an earlier document."""

    def repeated(group: pa.Table) -> pa.Table:
        lengths, part, places, owner, where, texts, base = [], [], [], [], [], [], 0
        for i, (n, m, size, block) in enumerate(zip(*(group.column(c).to_pylist() for c in ("contexts", "places", "size", "block")), strict=True)):
            held = _loosened(block, size)
            length, of_part, count, doc, at, text = np.split(held, np.cumsum([n, n, 4 * n, 4 * m, 4 * m]))
            lengths.append(length.astype(np.int64))
            part.append(of_part.astype(np.int64))
            places.append(count.view("<i4").astype(np.int64))
            owner.append(doc.view("<i4").astype(np.int64) + base)
            where.append(at.view("<i4").astype(np.int64))
            texts.append(text)
            base += len(group.column("docs")[i].values)
        chunk = np.repeat(group.column("chunk").to_numpy(), [len(x) for x in where])
        doc = _order(pa.concat_arrays([group.column("docs")[i].values for i in range(len(group))]))[np.concatenate(owner)]
        length, part, places, where, text = (np.concatenate(x) for x in (lengths, part, places, where, texts))
        start, count = np.cumsum(length) - length, min(len(text) // most + 1, 1 << PART_BITS)
        out = []
        for k in range(count):
            # equal strings are in one part
            run = np.flatnonzero(part * count >> PART_BITS == k)
            place = _ranges((np.cumsum(places) - places)[run], places[run])
            low, high, row = _spans(text[_ranges(start[run], length[run])], length[run], places[run], doc[place], where[place])
            out.append((low, high, chunk[place[row]]))
        low, high, chunk = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((low, chunk))
        spans, edge = np.stack([low, high], 1).astype("<i4")[order], _edges(chunk[order])
        return pa.table({"chunk": pa.array(chunk[order][edge]), "spans": pa.array([x.tobytes() for x in np.split(spans, edge[1:])] if len(edge) else [], pa.binary())})

    return repeated


def _spans(text: np.ndarray, length: np.ndarray, places: np.ndarray, doc: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (start, end, row) of strings that start in an earlier document, too.

    Runs lie one after the other in ``text``, each with its number of places; each place has a row of ``doc`` and ``where``.
    """
    strings, code, _ = _folded(_strings(text, length))
    text, offset = _flat(strings) if len(strings) else (text, np.zeros(1, np.int64))
    of = np.repeat(code, places)
    low = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(low, of, doc)
    n = np.diff(offset) - WIDTH + 1
    first = np.cumsum(n) - n
    least = least_of_strings(text, _ranges(offset[:-1], n), np.repeat(low, n))
    row = np.flatnonzero(np.minimum.reduceat(least, first)[of] < doc) if len(of) else of
    n, first = n[of[row]], first[of[row]]
    gone = least[_ranges(first, n)] < np.repeat(doc[row], n)
    at, row = _ranges(where[row], n)[gone], np.repeat(row, n)[gone]
    new = _edges(row, at - np.arange(len(at)))
    return at[new], at[np.append(new[1:], len(at)) - 1] + WIDTH if len(at) else at, row[new]


def _strip(pieces: pa.Table, spans: pa.Table) -> pa.Table:
    docs, end, raw = _text(pieces, 0)
    start = np.append(0, end[:-1])
    held = np.frombuffer(b"".join(spans.column("spans").to_pylist()), "<i4").reshape(-1, 2)
    depth = np.bincount(held[:, 0], minlength=len(raw) + 1) - np.bincount(held[:, 1], minlength=len(raw) + 1)
    gone = np.cumsum(depth[:-1]) > 0
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[start] = gone[start]
    removed, kept = np.add.reduceat(gone.astype(np.int64), start), raw[~gone]
    return pa.table(
        {
            "doc_id": docs,
            "n_bytes": pa.array(end - start),
            "n_removed": pa.array(removed),
            "n_spans": pa.array(np.add.reduceat(opens.astype(np.int64), start)),
            "kept": _strings(kept, end - start - removed).cast(pa.binary()),
        }
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", whole_text().alias("text")).withColumns({"digest": F.unhex(F.md5("text")), "n": F.octet_length("text").cast("long")})
    copies = staged(
        texts.filter(f"doc_id IS NOT NULL AND n >= {WIDTH}").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"),
        "copies",
    )
    known = texts.join(broadcast_if_small(copies), "digest", "left")
    later, sorted_out = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)), F.col("doc_id").isNull() | (F.col("n") < WIDTH)
    pieces = staged(
        known.filter(~later & ~sorted_out).select("doc_id", "text").mapInArrow(_pieces(CHUNK), f"chunk long, docs array<{kind}>, sizes array<int>, size long, block binary"), "pieces"
    )
    total = pieces.agg(F.sum("size")).first()[0] or 0
    bits = min(max((total // BUCKET_BYTES).bit_length(), 4), MOST_BITS)
    by_chunk = pieces.groupBy("chunk")
    tallied = pieces.mapInArrow(_tally(bits), "bucket long, chunk long, marks binary")
    shared = tallied.groupBy("bucket").applyInArrow(_shared(HEAVY), "chunk long, bucket long, marks binary")
    opened = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        _opened(bits), f"bucket long, chunk long, docs array<{kind}>, contexts long, places long, size long, block binary"
    )
    spans = opened.groupBy("bucket").applyInArrow(_repeated(PART_BYTES), "chunk long, spans binary")
    stripped = by_chunk.cogroup(spans.groupBy("chunk")).applyInArrow(_strip, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    # the others lose all or nothing
    gone = later & ~sorted_out
    whole = known.filter(later | sorted_out).select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(0).alias("n_removed"),
        gone.cast("long").alias("n_spans"),
        F.when(gone, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"),
    )
    return stripped.unionByName(whole)
