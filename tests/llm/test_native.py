"""Operators 1, 5, 7 and 8."""


import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from eqscene.llm import decontaminate, line_dedup, order_minhash, pii, sharding

from .conftest import ODD, PROSE


def test_shards(odd, none, docs):
    rows = sharding.assign_shards(odd, 4).collect()
    assert len(rows) == len(ODD)
    text = {(i, t) for i, t in ODD}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in text}
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(none).collect() == []
    many = docs([(i, "") for i in range(4000)], clash=False)
    got = sharding.assign_shards(many, 16).collect()
    moved = [r for r in got if r.grown_shard != r.shard]
    assert all(r.grown_shard == 16 for r in moved) and 150 < len(moved) < 330
    weighted = sharding.assign_shards(many, 2, [3.0, 1.0]).groupBy("shard").count().collect()
    assert {r.shard: round(r["count"] / 4000, 1) for r in weighted} == {0: 0.8, 1: 0.2} or 0.7 < max(r["count"] for r in weighted) / 4000 < 0.8
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), 2, [1.0])


VALID = ["4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (632) 555-4827", "632-555-4827", "78.118.65.158", "2024-02-29", "29.02.2024", "123-45-6789", "DE89 3704 0044 0532 0130 00", "ab.37@mail4.example.com"]
INVALID = ["4111111111111112", "2023-02-29", "DE88370400440532013000", "999.1.1.1", "v1.2.3.4.5"]


def shape(text, i):
    """Digits and letters by class; the numbers of an address may differ in length."""
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in text)
    return re.sub("9+", "9", kinds) if i == VALID.index("78.118.65.158") else kinds


def test_pseudonyms_invert_link_and_keep_their_format(docs):
    rows = [(i, f"see {v}, and {v}.") for i, v in enumerate(VALID + INVALID)]
    out = pii.pseudonymise(docs(rows), "k")
    new = {r.doc_id: r for r in out.collect()}
    back = {r.doc_id: r.text for r in pii.pseudonymise(out.drop("n_values"), "k", invert=True).collect()}
    for i, text in rows:
        assert back[i] == text
        assert shape(new[i].text, i) == shape(text, i)
        assert (new[i].text != text) == (i < len(VALID))
        assert new[i].n_values == (2 if i < len(VALID) else 0)
    digits = lambda t: "".join(c for c in t if c.isdigit())
    assert digits(new[0].text) == digits(new[1].text)
    assert digits(new[2].text)[1:11] == digits(new[3].text)[:10]


def plain_feistel(symbols, radix, key, kind):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    middle = len(symbols) // 2
    halves, radices = [symbols[:middle], symbols[middle:]], [radix[:middle], radix[middle:]]
    for number in range(pii.ROUNDS):
        own, other = number % 2, 1 - number % 2
        seed = sha(f"{key}|{kind}|{number}|" + ",".join(map(str, halves[other])))
        by = [int(sha(seed + str(i // 10))[i % 10 * 6 :][:6], 16) for i in range(len(halves[own]))]
        halves[own] = [(x + y) % r for x, y, r in zip(halves[own], by, radices[own])]
    return halves[0] + halves[1]


def plain_ssn(text, key):
    def valid(d):
        area = d[0] * 100 + d[1] * 10 + d[2]
        return 0 < area < 900 and area != 666 and any(d[3:5]) and any(d[5:])

    d = [int(c) for c in text if c.isdigit()]
    if not valid(d):
        return text
    while True:
        d = plain_feistel(d, [10] * 9, key, "ssn")
        if valid(d):
            return "{}{}{}-{}{}-{}{}{}{}".format(*d)


def plain_card(text, key):
    def total(d):
        return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d)))

    d = [int(c) for c in text]
    if total(d) % 10:
        return text
    body = plain_feistel(d[:-1], [10] * (len(d) - 1), key, "card")
    return "".join(map(str, [*body, -total([*body, 0]) % 10]))


def test_pseudonyms_against_a_plain_network(docs):
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    numbers = [f"{digits(3)}-{digits(2)}-{digits(4)}" for _ in range(60)] + ["000-12-3456", "666-12-3456", "900-12-3456", "123-00-3456", "123-45-0000", "001-01-0001"]
    cards = [digits(rng.randint(13, 19)) for _ in range(60)]
    addresses = [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(20)]
    plain = {v: plain_ssn(v, "k") for v in numbers} | {v: plain_card(v, "k") for v in cards}
    plain |= {v: ".".join(map(str, plain_feistel([int(x) for x in v.split(".")], [256] * 4, "k", "ip"))) for v in addresses}
    values = list(plain)
    got = {r.doc_id: r for r in pii.pseudonymise(docs([(i, f"a {v} b") for i, v in enumerate(values)]), "k").collect()}
    for i, v in enumerate(values):
        assert got[i].text == f"a {plain[v]} b"
        assert got[i].n_values == (plain[v] != v)


def test_pseudonyms_beside_columns_of_any_name(docs):
    wide = docs([(1, "x 123-45-6789 y"), (2, None)]).selectExpr("*", "7 AS found", "8 AS found_", "9 AS n_values")
    assert sorted(wide.columns) == sorted((out := pii.pseudonymise(wide, "k")).columns)
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].found, rows[1].found_, rows[1].n_values) == (7, 8, 1) and (rows[2].n_values, rows[2].text) == (0, None)


def test_pseudonyms_of_odd_rows(odd, none):
    out = {(r.doc_id, r.text) for r in pii.pseudonymise(odd, "k").collect()}
    assert out == {(i, t) for i, t in ODD}
    assert pii.pseudonymise(none, "k").collect() == []


def brute_contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for k, t in items:
        w = words(t)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(str(k))
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= ids
        out[d, t] = (len(w), len(hit), sorted(found))
    return out


def test_contamination_against_brute_force(spark, docs, none):
    rng = random.Random(3)
    vocabulary = ["ab", "cd", "ef", "É", "9x", "The"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 3, 12, 13, 14, 30])] + [(2, "ab cd ef"), (9, None)]
    rows = [(i, text(rng.randint(0, 60))) for i in range(12)] + [(20, "X " + items[6][1] + "! y"), (21, None), (None, text(30)), (22, "q " * 3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs(rows + rows[:2]), bench).collect()
    want = brute_contamination(rows, items)
    got = sorted(((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in found))
    assert got == sorted((str(d), *want[d, t]) for d, t in rows + rows[:2])  # repeated rows stay rows
    assert decontaminate.find_contamination(none, bench).collect() == []
    clean = decontaminate.find_contamination(docs(rows), bench.limit(0)).collect()
    assert all(r.n_hit == 0 for r in clean)
    kept = decontaminate.drop_contaminated(docs(rows), bench)
    bad = {d for (d, _), (n, h, _) in want.items() if h and 20 * h >= n}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - bad and kept.columns == docs(rows).columns


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute_lines(rows):
    lines = [((d, i), x) for d, t in rows for i, x in enumerate(t.split("\n")) if x.strip()]
    gone = set()
    for at, x in lines:
        for other, y in lines:
            if other < at and (x == y or (min(len(x), len(y)) >= line_dedup.FUZZY_FROM and abs(len(x) - len(y)) <= 1 and edits(x, y) <= 1)):
                gone.add(at)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}


def test_lines_against_brute_force(docs):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (5, 15, 16, 17, 63, 64, 65, 127, 128, 200)]
    lines = list(base)
    for x in base * 3:
        k, c = rng.randint(0, len(x)), rng.choice("xyzé")
        lines.append(rng.choice([x[:k] + c + x[k:], x[:k] + x[k + 1 :], x[:k] + c + x[k + 1 :], x, c + x, x + c, x[:-1]]))
    lines += ["", "  ", "ab", "ac", "ab"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::7])) for i in range(7)]
    out = line_dedup.dedup_lines(docs(rows), counts=True)
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows)
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_columns_of_any_name_pass_through(spark, docs):
    rows = [(1, "a line that is long enough\nb"), (2, "a line that is long enough\nc")]
    names = ["a.b", "__gone", "__later", "row", "gone", "later", "whole", "id", "of", "bad_id", "n_lines"]
    full = docs(rows).withColumns({c: F.lit("x") for c in names})
    out = line_dedup.dedup_lines(full)
    assert out.columns == full.columns and {r["a.b"] for r in out.collect()} == {"x"}
    counted = line_dedup.dedup_lines(full, counts=True)
    assert counted.columns.count("n_lines") == 1 and {r.n_lines for r in counted.collect()} == {2}
    bench = spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string")
    assert decontaminate.drop_contaminated(full, bench).columns == full.columns
    kept = order_minhash.drop_near_duplicates(full)
    assert kept.columns == full.columns and [r.doc_id for r in kept.collect()] == [1]  # six of seven words are the same


def test_lines_of_odd_rows(odd, none):
    rows = line_dedup.dedup_lines(odd)
    assert rows.columns == odd.columns and rows.count() == len(ODD)
    got = [(r.doc_id, r.text) for r in rows.collect()]
    assert got.count((1, PROSE)) == 1 and got.count((2, "")) == 2  # both rows of document 2 repeat document 1
    assert (3, None) in got and (4, "") in got
    assert line_dedup.dedup_lines(none).collect() == []


