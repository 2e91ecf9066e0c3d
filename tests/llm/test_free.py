"""Operators 2, 3, 4, 6, 9 and 10."""

import hashlib
import random

import numpy as np
import pytest

from eqscene.llm import _labelled, fingerprints, order_minhash, quality, sentencepiece_lattice, suffix_dedup, toxicity
from eqscene.llm._components import components

from .conftest import ODD, PROSE


def prose(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_duplicates_against_brute_force(docs):
    rng = random.Random(1)
    rows = []
    for group in range(6):
        base = prose(rng, rng.choice([12, 80, 300]))
        for copy in range(8):
            new = list(base)
            for _ in range(copy // 2 * len(base) // 100):
                new[rng.randrange(len(new))] = "edit"
            rows.append((group * 10 + copy, " ".join(new)))
    rows += [(100, " ".join(prose(rng, 200))), (101, "one two"), (102, "one two"), (103, ""), (104, None), (None, "one two")]
    root = {i: i for i, _ in rows if i is not None}
    for i, a in rows:
        for j, b in rows:
            if None not in (i, j) and i < j and ((a or "") == (b or "") or (a and b and order_minhash.alike(a, b))):
                old, new = root[j], root[i]
                root = {k: min(old, new) if v in (old, new) else v for k, v in root.items()}
    got = order_minhash.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == root
    assert [r.class_id for r in got if r.doc_id is None] == [101]
    kept = order_minhash.drop_near_duplicates(docs(rows))
    assert {r.doc_id for r in kept.collect()} == set(root.values()) | {None} and kept.columns == docs(rows).columns


def test_leads_meet_no_text_of_their_own_class(docs, monkeypatch):
    """Copies that the first bands bring into one class give no rows for the other bands."""
    rng = random.Random(12)
    base = prose(rng, 300)
    rows = [(i, " ".join("edit" if k == i else w for k, w in enumerate(base))) for i in range(150)]
    written, write = {}, order_minhash.staged

    def counted(df, label):
        out = write(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(order_minhash, "staged", counted)
    got = order_minhash.near_duplicates(docs(rows)).collect()
    assert {r.class_id for r in got} == {0} and len(got) == len(rows)
    assert written["members"] > 20 * len(rows)
    assert written.get("meeting", 0) + written["pairs"] < 3 * len(rows)


def test_near_duplicates_of_odd_rows(odd, none):
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(odd).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, None: None, 5: 5, 6: 6, 7: 7}
    assert order_minhash.near_duplicates(none).collect() == []


def test_word_distance():
    rng = random.Random(2)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(300):
        a = [rng.randint(1, 4) for _ in range(rng.randint(0, 20))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randint(1, 4) for _ in range(rng.randint(0, 3))]
        d = plain(a, b)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        for limit in (3, 40):
            assert order_minhash.word_distance(x, y, limit) == (d if d <= limit else None)
        if a and b:
            assert order_minhash._rows(x, y, 40) == d


def test_alignments_at_once():
    rng = random.Random(12)
    a = [np.array([rng.randint(1, 6) for _ in range(rng.choice([1, 5, 40, 41, 90]))], np.uint32) for _ in range(300)]
    b = [np.array([w for w in x if rng.random() > rng.choice([0, 0.1, 0.2])] + [rng.randint(1, 6)] * rng.choice([0, 1, 9]), np.uint32) for x in a]
    want = [order_minhash.word_distance(x, y, int(0.2 * max(len(x), len(y)) + 1e-9)) is not None for x, y in zip(a, b, strict=True)]
    assert order_minhash.within(a, b).tolist() == want and 50 < sum(want) < 250
    assert order_minhash.within([], []).tolist() == []


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_fingerprints_of_ids_that_are_strings(docs):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 13}" for k in range(i % 40))) for i in range(1000, 1300)] + [(None, "no id"), (1001, "again")]
    by_number = fingerprints.fingerprint_with_next(docs(rows)).selectExpr("CAST(doc_id AS STRING) AS doc_id", "n_chars", "edited_sha256", "fingerprint", "near_next").collect()
    named = docs(rows).selectExpr("CAST(doc_id AS STRING) AS doc_id", "text")
    by_name = fingerprints.fingerprint_with_next(named).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_next").collect()
    assert sorted(map(repr, by_name)) == sorted(map(repr, by_number))
    assert fingerprints.fingerprint_with_next(named.limit(0)).collect() == []
    assert len(fingerprints.fingerprint_with_next(named.filter("doc_id IS NULL")).collect()) == 1


def test_fingerprints(docs, none):
    rng = random.Random(4)
    rows = [(i * 3, " ".join(prose(rng, rng.choice([1, 3, 5, 40, 400])))) for i in range(40)] + [(500, ""), (501, None), (502, PROSE), (503, PROSE), (504, "é" * 41)]
    order = sorted(rows)
    text = [t or "" for _, t in order]
    got = {r.doc_id: r for r in fingerprints.fingerprint_with_next(docs(rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(order):
        own, after = text[k], text[(k + 1) % len(text)]
        edited = own[: len(own) - len(own) // 4] + after[: len(own) // 4]
        assert got[i].n_chars == len(own)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(jaccard(own, edited), abs=0.12)
        assert got[i].near_next == pytest.approx(jaccard(own, after), abs=0.12)
    assert got[502].fingerprint == got[503].fingerprint and got[500].fingerprint == ""
    codes = fingerprints.unpacked(got[502].fingerprint)
    assert len(codes) == fingerprints.BINS and codes.max() < 2**fingerprints.BITS
    assert fingerprints.fingerprint_with_next(none).collect() == []
    assert len(fingerprints.fingerprint_with_next(docs(ODD)).collect()) == len(ODD)
    only = fingerprints.fingerprint_with_next(docs([(None, "x y")])).collect()
    assert len(only) == 1 and only[0].doc_id is None


def labelled(spark, rng):
    rows, marks = [], []
    for i in range(300):
        bad, toxic = i % 3 == 0, i % 4 == 0
        words = prose(rng, 60)
        if bad:
            words = [words[0]] * 30 + [words[1]] * 30
        if toxic:
            words[5] = rng.choice(["idiot", "zzorgon", "zzorgat", "moron,"])
            words[9] = rng.choice(["zzorgel", "zzorgon", "stupid"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad), int(toxic)))
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_a_tiny_share_still_samples(spark, docs):
    """A share of one in 10 ** 10 of a label table is not rounded to none."""
    rows = docs([(i, "x") for i in range(2000)])
    known = spark.range(2000).selectExpr("id AS doc_id", "1 AS label")
    assert 0 < _labelled._sampled(known, rows, 0.01).count() < 60
    assert int(1e-10 * _labelled._PARTS) > 0


def test_quality(spark, docs, odd, none):
    rows, labels = labelled(spark, random.Random(6))
    got = quality.score_quality(docs(rows), labels).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and all(r.predicted == int(r.doc_id % 3 != 0) for r in held)
    kept = quality.keep_good(docs(rows), labels)
    assert kept.count() == 200 and kept.columns == docs(rows).columns
    scores = {(r.doc_id, r.score) for r in quality.score_quality(odd, labels).collect()}
    assert len({x for i, x in scores if i in (1, 2)}) == 1 and all(0 <= x <= 1 for _, x in scores)
    assert {r.score for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(none, labels).collect() == []


def test_toxicity(spark, docs, odd, none):
    rows, labels = labelled(spark, random.Random(7))
    got = toxicity.score_toxicity(docs(rows), labels).collect()
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) / len(held)
    assert len(held) > 60 and right > 0.95
    assert all(r.predicted == 0 for r in held if r.doc_id % 4)
    scores = toxicity.score_toxicity(odd, labels.limit(0)).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score < 0.7 for r in scores)
    assert toxicity.score_toxicity(none, labels).collect() == []


def test_label_model_sees_accuracy_and_correlation():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = np.where(rng.random(4000) < 0.95, y, ~y)
    weak = np.where(rng.random(4000) < 0.7, y, ~y)
    v = np.stack([good, weak, weak, np.where(rng.random(4000) < 0.9, y, ~y)], 1).astype(np.int8) * 2 - 1
    model = toxicity.label_model(v, 0.2)
    assert model.correlations[1, 2] > 0.9 > abs(model.correlations[0, 3])
    assert ((model.posterior(v) > 0.5) == y).mean() > 0.9


def brute_repeats(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            if d is not None and (w not in first or d < first[w]):
                first[w] = d
    out = set()
    for d, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i : i + 50]] < d:
                cover[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if cover[i] and not (i and cover[i - 1]))
        out.add((d, len(b), sum(cover), spans, bytes(x for x, c in zip(b, cover, strict=True) if not c)))
    return out


def test_repeats_against_brute_force(docs, none):
    rng = random.Random(8)
    passage = ["".join(rng.choice("abé ") for _ in range(n)) for n in (49, 50, 51, 120, 700)]
    rows = list(ODD)
    for i in range(20, 40):
        rows.append((i, "".join(rng.choice([rng.choice(passage), "".join(rng.choice("xyz") for _ in range(rng.randint(1, 90)))]) for _ in range(5))))
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs(rows)).collect()}
    assert got == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(none).collect() == []
    p, q = ("".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(2))
    r = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, p), (2, q + p), (2, r), (3, "s" + p), (3, r[:400])]  # unlike texts of one doc_id
    for order in (rows, rows[::-1]):
        got = {(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.remove_repeats(docs(order)).collect()}
        assert got == brute_repeats(rows)


def test_marks_are_the_last_of_the_least_and_travel_packed(docs, monkeypatch):
    rng = random.Random(13)
    held = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (50, 51, 400)] + [b"a" * 90, rng.randbytes(3000)]
    row, value, place = suffix_dedup.marks(held)
    for k, piece in enumerate(held):
        at = place[row == k]
        assert len(at) == len(set(at.tolist())) and all(any(i <= p <= i + 26 for p in at) for i in range(len(piece) - 49))
    same = {}
    for k, v, p in zip(row, value, place, strict=True):
        assert same.setdefault(held[k][p : p + suffix_dedup.GRAM], v) == v
    monkeypatch.setattr(suffix_dedup, "BATCH", 500)
    assert all((x == y).all() for x, y in zip(suffix_dedup.marks(held), (row, value, place), strict=True))
    written, write = {}, suffix_dedup.staged

    def counted(df, label):
        out = write(df, label)
        written[label] = out.count()
        return out

    # small chunks and many buckets; texts that share nothing leave no row for a place
    for k, v in {"CHUNK": 2000, "BUCKET_BYTES": 500, "staged": counted}.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = [(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(900))) for i in range(40)]
    assert sum(r.n_removed for r in suffix_dedup.remove_repeats(docs(rows)).collect()) == 0
    assert max(written.values()) == written["pieces"]
    rows += [(i + 100, t[100:400] + t[700:] + rows[i // 2][1][:60]) for i, t in rows]
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs(rows)).collect()}
    assert got == brute_repeats(rows)


@pytest.mark.parametrize(("heavy", "part"), [(1 << 14, 4_000_000), (3, 4_000_000), (20, 100)])
def test_repeats_leave_no_row_for_a_place(docs, monkeypatch, heavy, part):
    """Texts that share nearly all they have: what is written stays within a row for each text."""
    rng = random.Random(17)
    base = ["".join(rng.choice("abcdé ") for _ in range(400)) for _ in range(8)]
    rows = [(i, "".join(rng.choice(base)[rng.randrange(90) :] + rng.choice(["", "-", "=="]) for _ in range(3))) for i in range(60)]
    rows += [(70, "a" * 3000), (71, "b" + "a" * 2000), (72, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]
    written, write = {}, suffix_dedup.staged

    def counted(df, label):
        out = write(df, label)
        written[label] = out.count()
        return out

    for k, v in {"CHUNK": 5000, "BUCKET_BYTES": 500, "HEAVY": heavy, "PART_BYTES": part, "staged": counted}.items():
        monkeypatch.setattr(suffix_dedup, k, v, raising=False)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs(rows)).collect())
    want = {(str(d), *rest) for d, *rest in brute_repeats(rows)}
    assert len(got) == len(rows) and set(got) == want
    assert max(written.values()) <= len(rows)


def test_marks_spread_over_buckets():
    rng = random.Random(19)
    value = suffix_dedup.marks([rng.randbytes(100_000)])[1]
    bucket = np.bincount((value >> np.uint64(60)).astype(int), minlength=16)
    assert bucket.max() < 2 * len(value) / 16


def test_difference_cover_against_a_dictionary():
    rng = random.Random(23)
    text = "".join(rng.choice(["ab" * 40, "a" * 60, "".join(rng.choice("ab") for _ in range(70))]) for _ in range(60)).encode()
    p = np.array(rng.sample(range(len(text) - 49), 2500))
    doc = np.array([rng.randrange(1000) for _ in p])
    least = {}
    for x, d in zip(p.tolist(), doc.tolist(), strict=True):
        least[text[x : x + 50]] = min(d, least.get(text[x : x + 50], d))
    got = suffix_dedup.least_of_strings(np.frombuffer(text, np.uint8), p, doc)
    assert got.tolist() == [least[text[x : x + 50]] for x in p.tolist()]


TEXTS = [(1, ""), (2, None), (3, "Hello  world\n  foo\tbar 123 ½ ﬁ 😀  "), (4, " "), (5, "a" * 500), (6, "the" * 200 + " 中文 русский"), (7, "x▁y"), (None, "null id"), (3, "again")]


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
@pytest.mark.parametrize("held", [sentencepiece_lattice.LOOKUP_BYTES, 80])
def test_sentencepiece_against_the_library(docs, none, kind, held):
    spm = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    with open(sentencepiece_lattice.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = {"unigram": 1, "bpe": 2}[kind]
    library = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())
    table = sentencepiece_lattice.load_pieces(kind=kind)
    coded = sentencepiece_lattice.encode(docs(TEXTS), table, held)
    got = sorted((str(r.doc_id), list(r.token_ids), r.text) for r in sentencepiece_lattice.decode(coded, table).collect())
    assert got == sorted((str(i), library.encode(t or ""), (t or "").replace("▁", " ")) for i, t in TEXTS)
    fused = sentencepiece_lattice.encode(docs(TEXTS), table, held, decoded=True)
    assert sorted((str(r.doc_id), list(r.token_ids), r.text) for r in fused.collect()) == got
    assert sentencepiece_lattice.encode(none, table).collect() == []


def test_no_candidate_of_a_divided_bucket_is_dropped(docs):
    """Chains a ~ b ~ c, a not like c, beside hundreds of copies of c's end of the chain."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(200)]

    def edited(spots, mark):
        return " ".join(f"{mark}{i}" if i in spots else w for i, w in enumerate(base))

    rows, chain = [], []
    for k in range(300):
        rows.append((1000 + k, edited({rng.randrange(200)}, f"m{k}x")))
    for k in range(40):
        spots = rng.sample(range(0, 200, 5), 6)
        chain.append((10 * k, edited(set(spots), f"c{k}x")))
        chain.append((10 * k + 1, edited(set(spots[:3]), f"c{k}x")))
    rows += chain
    root = {i: i for i, _ in rows}
    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if root[i] != root[j] and order_minhash.alike(a, b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if v == old else v for k, v in root.items()}
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs(rows)).collect()}
    assert got == root


def test_toxicity_is_fitted_on_all_rows(docs, spark):
    """Rare votes among more documents than a sample would hold: the classifier is that of all rows."""
    texts = ["plain words here", "you idiot", "such stupid filth and scum", "an idiot " + "w " * 300]
    rows = [(i, texts[3 if i % 5000 == 7 else 2 if i % 300 == 1 else 1 if i % 40 == 3 else 0]) for i in range(21_000)]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.train(docs(rows, clash=False), labels)
    counts = np.array([got.lexicon.counts(t) for _, t in rows], float)
    v, x = toxicity.votes(counts), toxicity.design(counts)
    p = toxicity.label_model(v, 0.05).posterior(v)
    a, w = np.concatenate([x, np.ones((len(x), 1))], 1), np.append(got.weight, got.bias)
    slope = a.T @ (1 / (1 + np.exp(-a @ w)) - p) + np.append(np.full(x.shape[1], 1e-3 * len(x)), 1e-6) * w
    assert np.abs(slope).max() < 1e-4  # the least loss over all rows
