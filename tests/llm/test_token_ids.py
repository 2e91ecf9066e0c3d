"""Operator 12: the codec, the files, and the library's own ids."""

import zlib
from uuid import uuid4

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eqscene.llm import simple8b, token_ids
from eqscene.llm.token_ids import read_ids, through_files, tokenise, write_ids

MODEL = Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))
WIDTHS = st.sampled_from([0, 1, 2, 3, 5, 8, 13, 16, 20, 33, 59, 60, 64])


def _coded(values):
    c = simple8b.encode(values)
    size = np.full(-(-len(values) // simple8b.BLOCK), simple8b.BLOCK)
    size[-1:] = len(values) - simple8b.BLOCK * (len(size) - 1)
    return c, simple8b.decode(c.words, c.escapes, c.n_words, size)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(WIDTHS, st.integers(0, 2**64 - 1), st.integers(1, 700)), max_size=12))
def test_codec_gives_the_values_back(runs):
    values = np.array([v >> (64 - w) if w else 0 for w, v, n in runs for _ in range(n)], np.uint64)
    c, back = _coded(values)
    assert (back == values).all() and len(c.n_words) == -(-len(values) // simple8b.BLOCK)


def test_codec_packs_and_escapes():
    c, _ = _coded(np.ones(simple8b.BLOCK * 60, np.uint64))
    assert len(c.words) == 60 * -(-simple8b.BLOCK // 60)
    values = np.array([1, 2**60 - 2, 2**60 - 1, 2**64 - 1, 3], np.uint64)
    c, back = _coded(values)
    assert c.escapes.tolist() == [2**60 - 1, 2**64 - 1] and (back == values).all()
    assert len(_coded(np.zeros(240, np.uint64))[0].words) == 1


ODD = [
    "", " ", "\n\n", "The END. the end", "don't can't I'll 'S it's.", "a.b...c!? (x);,", "<|endoftext|> <|ENDOFTEXT|>. x<|startoftext|>y",
    "Straße ÄÖÜ. naïve café é. İstanbul ΣΑΣ. ﬁn", "tab\tnbsp x y\x1cz\r\nw\x85v", "日本語。テスト 😀👍🏽 12,345.67", "x" * 30_000, "ab " * 20_000,
    "Á. b̧,", "́start", "Word.́ Word;", "ⅷ ²", "a‍b ﻿c",
]


def _ids(texts, end=(1,)):
    return [[*e.ids, *end] for e in MODEL.encode_batch(texts, add_special_tokens=False)]


def _check(rows, docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    start = 0
    assert [r.doc_id for r in rows] == [d[0] for d in order]
    for r, ids in zip(rows, _ids([t or "" for _, t in order]), strict=True):
        raw = np.array(ids, "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw)), r
        start += len(ids)


def test_files_hold_the_ids_of_the_library(spark, docs):
    rows = [(i * 7919 % 1000, t) for i, t in enumerate(ODD)] + [(5000, None), (None, "no id")]
    got = through_files(docs(rows).repartition(5)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    _check(sorted(got.collect(), key=lambda r: r.start), rows)


def test_all_documents_of_the_smallest_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = through_files(table.repartition(7)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    _check(sorted(got.collect(), key=lambda r: r.start), [tuple(r) for r in table.collect()])


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n.,;:!?'<|>ABab́ßİΣ1"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_parts_of_a_text_give_the_ids_of_the_text(text):
    encoder = token_ids._Encoder.of(public_tokenizers.path(token_ids.TOKENIZER), True)
    assert encoder.encode(pa.array([text, ""]), True, None)[0].tolist() == _ids([text], ())[0]


def test_a_full_store_is_emptied(monkeypatch):
    monkeypatch.setattr(token_ids, "STORE", 20)
    encoder = token_ids._Encoder(public_tokenizers.path(token_ids.TOKENIZER))
    texts = [f"word{i} other{i}. end" for i in range(50)]
    assert [encoder.encode(pa.array([t]), True, None)[0].tolist() for t in texts] == _ids(texts, ())


def test_repeated_rows_and_whole_texts(spark, docs):
    rows = [(1, "Same text."), (1, "Same text."), (2, "x"), (1, "Other")] * 3
    got = sorted(through_files(docs(rows)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1] * 9 + [2] * 3
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    whole = {r.doc_id: bytes(r.ids) for r in tokenise(docs([(1, "Don't stop. Now!")]), public_tokenizers.path("byte_bpe_50k.json"), end_id=None).collect()}
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(whole[1], "<u4").tolist() == other.encode("Don't stop. Now!", add_special_tokens=False).ids


def test_wide_ids_and_lost_files(spark, tmp_path):
    rows = [("b", [1, 2**40, 2**62]), ("c", []), ("d", None), ("e", list(range(5000)))]
    path = f"{tmp_path}/{uuid4().hex}"
    write_ids(spark.createDataFrame(rows, "doc_id string, ids array<long>").coalesce(1), path)
    (tmp_path / path.rsplit("/", 1)[1] / "part-000000-lost.ids").write_bytes(b"left by a lost task")
    got = read_ids(spark, path, wide=True).orderBy("start", "doc_id").collect()
    assert sorted((r.doc_id, r.start, r.ids) for r in got) == [("b", 0, [1, 2**40, 2**62]), ("c", 3, []), ("d", 3, []), ("e", 3, list(range(5000)))]


def test_no_documents(spark, none):
    assert through_files(none).count() == 0
