"""Operator 12: token ids of documents, written and read as packed binary files.

``tokenise`` encodes whole texts with a tokenizer file of the ``tokenizers`` library and
ends each document with an id. ``write_ids`` sorts the documents by key over ranges of
keys and writes one file a partition, each id stream packed by Simple-8b
(:mod:`eqscene.llm.simple8b`) in blocks; ``read_ids`` reads the files back as documents.
Both go through the data source ``TokenIdFiles``, so writing and reading are Spark jobs:
tasks write under names of their own, the driver commits a list of files with their
counts (the only thing it sees), and a file of a lost task is never on that list.

A file is: blocks (words, then escapes, 8 bytes each, little-endian); the block table
(byte offset, values, words); the keys and lengths of the documents as an Arrow stream;
and a trailer with the sizes of these. A reader task takes one file, some documents at a
time, and decodes only the blocks that these touch.

The default tokenizer drops white space, so that its ids of a text are those of the
parts between spaces and line ends, one after the other. A worker therefore encodes each
such part once and keeps its ids (``by_words``; other tokenizers get whole texts); plain
letters go to the tokenizer's model without its normalizer, which only lowers them. The
store of parts is emptied when it is full, which only costs time.

Edge cases: a null or empty text has the end id alone; rows of one doc_id follow the
order of their texts' hashes, repeated rows stay; null doc_ids come first; an empty table
gives a list without files and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from eqscene.llm import simple8b
from eqscene.llm._common import shared_dir, whole_text
from eqscene.llm.simple8b import BLOCK

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Parts of texts that a worker keeps, and the longest that it keeps.
STORE, LONGEST = 900_000, 64
#: Bytes of text encoded, and ids packed or unpacked, at a time.
CHUNK_BYTES, CHUNK_IDS = 8_000_000, 1 << 19
MANIFEST = "_files.json"
_MAGIC = b"IDS8\x01\x00\x00\x00"
_TRAILER = struct.Struct("<qqq8s")
#: Letters of one byte in Latin-1, and what may follow them: these are always parts of their own.
_PLAIN = re.compile(r"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


class _Encoder:
    """In a worker: one tokenizer and the ids, as bytes, of the parts that it met."""

    held: dict[tuple[str, bool], _Encoder] = {}

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(file)
        self.pieces = self.model.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xAA, 0x100)}
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, file: str, by_words: bool) -> _Encoder:
        if (file, by_words) not in cls.held:
            cls.held[file, by_words] = cls(file)
        return cls.held[file, by_words]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def by_words(self, words: list[str]) -> list[bytes]:
        """The ids of different parts of texts."""
        if len(self.known) + len(words) > STORE:
            self.known.clear()
        self._learn([w for w in words if w not in self.known])
        out = [self.known[w] for w in words]
        for w in words:
            if len(w) > LONGEST:
                del self.known[w]
        return out

    def encode(self, texts: pa.Array, per_word: bool, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if per_word:
            parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            coded = parts.flatten().dictionary_encode()
            raw, at = self.by_words(coded.dictionary.to_pylist()), coded.indices.to_numpy(zero_copy_only=False)
            edge = np.concatenate(([0], np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False))))
        else:
            raw, at, edge = self.whole(texts.to_pylist()), np.arange(len(texts)), np.arange(len(texts) + 1)
        own = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        first, flat = np.cumsum(own) - own, np.frombuffer(b"".join(raw), "<u4")
        size = own[at]
        last = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.repeat(first[at] - last[:-1], size) + np.arange(last[-1])]
        edge = last[edge]
        if end_id is None:
            return ids, np.diff(edge)
        return np.insert(ids, edge[1:], end_id), np.diff(edge) + 1

    def _learn(self, new: list[str]) -> None:
        known, other = self.known, []
        for w in new:
            plain = _PLAIN.fullmatch(w) if len(w) <= LONGEST else None
            if not plain:
                other.append(w)
                continue
            stem, stop = plain[1].lower(), plain[2]
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = self._letters(stem)
            if stop:
                if stop not in known:
                    known[stop] = self.whole([stop])[0]
                ids += known[stop]
            known[w] = ids
        known.update(zip(other, self.whole(other), strict=True))

    def _letters(self, word: str) -> bytes:
        """The ids of one lowered word of plain letters: what the tokenizer's normalizer and its cuts leave as it is."""
        return array("I", [t.id for t in self.pieces.tokenize(word if word.isascii() else word.translate(self.bytes))]).tobytes()


def _encoder(file: str | None, by_words: bool | None) -> tuple[str, bool]:
    if file is None:
        import public_tokenizers

        return public_tokenizers.path(TOKENIZER), by_words is not False
    return file, bool(by_words)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + CHUNK_BYTES, "right")))
        yield i, j
        i = j


def tokenise(docs: DataFrame, file: str | None = None, end_id: int | None = END_ID, by_words: bool | None = None) -> DataFrame:
    """``doc_id, ids`` for every row: the ids of the whole text and ``end_id`` as little-endian unsigned 32-bit integers."""
    file, per_word = _encoder(file, by_words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _tokenised(batch, file, per_word, end_id)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(encoded, f"doc_id {kind}, ids binary")


def _tokenised(batch: pa.RecordBatch, file: str, per_word: bool, end_id: int | None) -> Iterator[pa.RecordBatch]:
    """(key, text) as (key, ids), some texts at a time."""
    encoder, texts = _Encoder.of(file, per_word), pc.fill_null(batch.column(1), "")
    for i, j in _chunks(texts):
        ids, count = encoder.encode(texts.slice(i, j - i), per_word, end_id)
        yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), _as_bytes(ids, count)], names=["doc_id", "ids"])


def _as_bytes(ids: np.ndarray, count: np.ndarray) -> pa.Array:
    edge = 4 * np.concatenate(([0], np.cumsum(count)))
    buffers = [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
    return pa.Array.from_buffers(pa.binary(), len(count), buffers)


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` sorted over ranges of doc_id; rows of one doc_id may fill many ranges."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    keys = {"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    return rows.select("*", *(c.alias(k) for k, c in keys.items())).repartitionByRange("doc_id", *keys).sortWithinPartitions("doc_id", *keys).select("doc_id", "text")


def _opened(path: str):
    """The file system of a folder's address, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    file: str
    docs: int
    ids: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: str, encoder: tuple[str, bool, int | None] | None):
        self.path, self.schema, self.encoder = path, schema, encoder

    def _coded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if self.encoder:
                yield from _tokenised(batch, *self.encoder)
            else:
                yield batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        files, folder = _opened(self.path)
        files.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid4().hex}.ids"
        table: list[np.ndarray] = []  # offset, values and words of each block
        keys, lengths, waiting, held = [], [], [], 0
        with files.open_output_stream(f"{folder}/{name}") as out:
            out.write(_MAGIC)

            def pack(values: np.ndarray) -> None:
                coded = simple8b.encode(values)
                size = np.full(len(coded.n_words), BLOCK)
                size[-1:] = len(values) - BLOCK * (len(size) - 1)
                spans = 8 * (coded.n_words + coded.n_escapes)
                table.append(np.stack([out.tell() + np.cumsum(spans) - spans, size, coded.n_words], 1))
                if len(coded.escapes):
                    w, e = np.cumsum(coded.n_words), np.cumsum(coded.n_escapes)
                    both = zip(np.split(coded.words, w[:-1]), np.split(coded.escapes, e[:-1]), strict=True)
                    out.write(np.concatenate([x for pair in both for x in pair]).astype("<u8").tobytes())
                else:
                    out.write(coded.words.astype("<u8").tobytes())

            for batch in self._coded(iterator):
                keys.append(batch.column(0))
                values, length = _values(batch.column(1))
                lengths.append(length)
                waiting.append(values)
                held += len(values)
                if held >= CHUNK_IDS:
                    values = np.concatenate(waiting)
                    whole = held - held % BLOCK
                    pack(values[:whole])
                    waiting, held = [values[whole:]], held - whole
            if held:
                pack(np.concatenate(waiting))
            blocks = np.concatenate(table) if table else np.empty((0, 3), np.int64)
            at = out.tell()
            out.write(blocks.astype("<i8").tobytes())
            length = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
            key = pa.chunked_array(keys) if keys else None
            docs = pa.table({"doc_id": key, "n": length}) if keys else pa.table({"n": length})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema) as stream:
                stream.write_table(docs, max_chunksize=1 << 16)
            out.write(sink.getvalue())
            out.write(_TRAILER.pack(at, len(blocks), sink.getvalue().size, _MAGIC))
        return _Written(TaskContext.get().partitionId(), name, len(length), int(length.sum()))

    def commit(self, messages: list[_Written | None]) -> None:
        done = sorted((m for m in messages if m), key=lambda m: m.partition)
        files, folder = _opened(self.path)
        files.create_dir(folder, recursive=True)
        listed = {"schema": self.schema, "files": [[m.file, m.docs, m.ids] for m in done if m.docs]}
        with files.open_output_stream(f"{folder}/{MANIFEST}.new") as out:
            out.write(json.dumps(listed).encode())
        files.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")

    def abort(self, messages: list[_Written | None]) -> None:
        files, folder = _opened(self.path)
        for m in messages:
            if m:
                files.delete_file(f"{folder}/{m.file}")


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in order, and how many each has; null rows have none. Ids are bytes of 32-bit integers or lists."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        size = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        if not column.null_count and pa.types.is_binary(column.type):
            edge = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            raw = memoryview(column.buffers()[2] or b"")[edge[0] : edge[-1]]
        else:
            raw = b"".join(x for x in column.to_pylist() if x)
        return np.frombuffer(raw, "<u4").astype(np.uint64), size
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and flat.min() < 0:
        raise ValueError("ids are not negative")
    return flat.astype(np.uint64), size


@dataclass
class _Part(InputPartition):
    file: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, wide: bool):
        self.path, self.wide = path, wide

    def partitions(self) -> list[_Part]:
        out, start = [], 0
        for name, _, ids in _listed(self.path)["files"]:
            out.append(_Part(name, start))
            start += ids
        return out or [_Part("", 0)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.file:
            return
        files, folder = _opened(self.path)
        with files.open_input_file(f"{folder}/{part.file}") as f:
            f.seek(f.size() - _TRAILER.size)
            at, blocks, doc_bytes, magic = _TRAILER.unpack(f.read(_TRAILER.size))
            if magic != _MAGIC:
                raise ValueError(f"{part.file} is not a file of token ids")
            f.seek(at)
            table = np.frombuffer(f.read(24 * blocks), "<i8").reshape(-1, 3)
            docs = pa.ipc.open_stream(f.read(doc_bytes)).read_all()
            length = docs["n"].to_numpy()
            last = np.cumsum(length)
            i = 0
            while i < len(length):
                first = int(last[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(last, first + CHUNK_IDS, "right")))
                values = self._decoded(f, table, at, first, int(last[j - 1]))
                count = length[i:j]
                edge = np.concatenate(([0], np.cumsum(count)))
                if self.wide:
                    ids = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(values.astype(np.int64)))
                else:
                    if len(values) and values.max() >= 2**32:
                        raise ValueError("an id takes more than 32 bits; read with wide=true")
                    ids = _as_bytes(values.astype("<u4"), count)
                yield pa.RecordBatch.from_arrays(
                    [docs["doc_id"].slice(i, j - i).combine_chunks(), pa.array(part.start + first + edge[:-1]), pa.array(count), ids],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )
                i = j

    @staticmethod
    def _decoded(f, table: np.ndarray, end: int, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` of the file; all blocks but its last one are full."""
        if first == last:
            return np.empty(0, np.uint64)
        b, c = first // BLOCK, (last - 1) // BLOCK + 1
        begin, stop = int(table[b, 0]), int(table[c, 0]) if c < len(table) else end
        f.seek(begin)
        raw = np.frombuffer(f.read(stop - begin), "<u8")
        n_values, n_words = table[b:c, 1], table[b:c, 2]
        size = np.diff(np.append(table[b:c, 0], stop)) // 8
        escapes = np.empty(0, np.uint64)
        if (size != n_words).any():
            at = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
            word = at < np.repeat(n_words, size)
            raw, escapes = raw[word], raw[~word]
        return simple8b.decode(raw, escapes, n_words, n_values)[first - b * BLOCK : last - b * BLOCK]


def _listed(path: str) -> dict:
    files, folder = _opened(path)
    with files.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


class TokenIdFiles(DataSource):
    """Format ``token_ids``: writes (key, ids), or (key, text) given a ``tokenizer``; reads ``doc_id, start, n_tokens, ids``, as ``array<long>`` if ``wide``."""

    @classmethod
    def name(cls) -> str:
        return "token_ids"

    @property
    def _wide(self) -> bool:
        return str(self.options.get("wide", "false")).lower() == "true"

    def schema(self) -> str:
        kind = _listed(self.options["path"])["schema"]
        return f"doc_id {kind}, start long, n_tokens long, ids {'array<long>' if self._wide else 'binary'}"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self._wide)

    def writer(self, schema, overwrite: bool) -> _Writer:
        file, by_words, end = (self.options.get(k) for k in ("tokenizer", "words", "end"))
        encoder = (file, by_words == "true", int(end) if end else None) if file else None
        return _Writer(self.options["path"], schema[0].dataType.simpleString(), encoder)


def write_ids(coded: DataFrame, path: str) -> None:
    """``doc_id, ids``, whose partitions follow each other in order, as files of the new folder ``path``."""
    coded.sparkSession.dataSource.register(TokenIdFiles)
    coded.select("doc_id", "ids").write.format("token_ids").mode("append").save(path)


def write_texts(docs: DataFrame, path: str, file: str | None = None, end_id: int | None = END_ID, by_words: bool | None = None) -> None:
    """``doc_id, text``, whose partitions follow each other in order: tokenised by the tasks that write the files."""
    file, per_word = _encoder(file, by_words)
    docs.sparkSession.dataSource.register(TokenIdFiles)
    options = {"tokenizer": file, "words": str(per_word).lower()} | ({} if end_id is None else {"end": str(end_id)})
    docs.select("doc_id", "text").write.format("token_ids").options(**options).mode("append").save(path)


def read_ids(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the files in ``path``; ``start`` counts the ids of all documents before."""
    spark.dataSource.register(TokenIdFiles)
    return spark.read.format("token_ids").option("wide", str(wide).lower()).load(path)


def through_files(docs: DataFrame, path: str | None = None, file: str | None = None) -> DataFrame:
    """``docs`` tokenised, written in ascending doc_id order (to ``path``, or a folder of its own) and read back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/token-ids-{uuid4().hex}"
    write_texts(in_order(docs), path, file)
    return read_ids(spark, path)
