"""Operators 11 and 13 against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eqscene.llm import hard_negatives
from eqscene.llm.hard_negatives import mine
from eqscene.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASH = {c: "clash" for c in ("n", "block", "tile", "kind", "v", "i", "total", "anchor", "rank", "score", "slot", "component")}


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASH.items()}).repartition(3)


def _random(seed, n, d, labels=3, step=0.25):
    r = random.Random(seed)
    hot = [1] * 5
    return [(i, [r.randrange(-8, 9) * step for _ in range(d)], r.choice([*range(labels), *hot])) for i in range(n)]


def _usable(rows):
    return [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def _brute_negatives(rows, every, n_pos=5, n_neg=10):
    rows = [(i, [math.floor(256 * c) for c in v], x) for i, v, x in _usable(rows) if i is not None and x is not None]
    out = []
    for a, (aid, av, al) in enumerate(rows):
        if aid % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(av, v)), i, k, x) for k, (i, v, x) in enumerate(rows) if k != a)
        for s, pid, _, _ in [x for x in scored if x[3] == al][:n_pos]:
            fits = [x for x in scored if x[3] != al and 30 * -s <= 100 * -x[0] <= 90 * -s][:n_neg]
            out += [(aid, pid, r, x[1], -s, -x[0]) for r, x in enumerate(fits, 1)]
    return sorted(out)


ODD = [
    (None, [1.0, 2.0], 1), (500, None, 1), (501, [1.0, None], 1), (502, [float("nan"), 1.0], 1), (503, [float("inf"), 1.0], 2),
    (504, [1.0, 2.0], None), (505, [], 1), (510, [3.0], 2), (510, [3.0], 2), (520, [1.0] * 9, 1), (-10, [2.0, 1.0], 1),
]


@pytest.mark.parametrize("rows", [_random(1, 240, 4), _random(2, 200, 2, step=1.0), _random(3, 120, 3) + ODD], ids=["plain", "ties", "odd"])
def test_hard_negatives_are_those_of_brute_force(spark, rows):
    got = mine(_frame(spark, rows), F.col("vec_id") % 10 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    want = _brute_negatives(rows, 10)
    assert len(want) > 100
    assert sorted(map(tuple, got.collect())) == want


def test_hard_negatives_with_huge_entries_are_exact(spark):
    rows = [(i, [float(2**20 + i * 2**10), 1.0, float((-1) ** i)], i % 2) for i in range(40)]
    got = mine(_frame(spark, rows), F.col("vec_id") % 10 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(map(tuple, got.collect())) == _brute_negatives(rows, 10)


def test_hard_negatives_of_nothing(spark):
    assert mine(_frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert mine(_frame(spark, [(1, [1.0], 1)]), F.col("vec_id") % 10 == 0).count() == 0


def _brute_white(rows, k=8):
    rows = _usable(rows)
    d = max(len(v) for _, v, _ in rows)
    x = [[math.floor(1024 * (v[j] if j < len(v) else 0.0)) + 100_000 for j in range(d)] for _, v, _ in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    y = [[n * p - q for p, q in zip(r, s)] for r in x]
    v = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    first = np.argsort(-e)[:k]
    white = (np.array(y, float) / n) @ u[:, first] / np.sqrt(np.where(e[first] > 1e-9, e[first], np.nan))
    return {i: (sum(p * p for p in r), w) for (i, _, _), r, w in zip(rows, y, white)}, e[first] / e.sum()


@pytest.mark.parametrize("extra", [[], ODD], ids=["plain", "odd"])
def test_whitening_is_that_of_brute_force(spark, extra):
    r = np.random.default_rng(7)
    mixed = r.normal(size=(300, 6)) @ np.diag([5, 4, 3, 2, 1.5, 1]) @ np.linalg.qr(r.normal(size=(6, 6)))[0]
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(mixed)] + extra
    got = whiten(_frame(spark, rows)).toPandas()
    want, share = _brute_white(rows)
    assert len(got) == len(_usable(rows)) * min(8, len(share))
    sign = {}
    for g in got.dropna(subset=["vec_id"]).itertuples():
        if g.vec_id == 510:
            continue  # two rows
        deviation, white = want[g.vec_id]
        assert (g.n, g.deviation) == (len(_usable(rows)), deviation)
        w = white[g.component - 1]
        sign.setdefault(g.component, 1 if w * g.whitened > 0 else -1)
        assert g.whitened == pytest.approx(sign[g.component] * w, rel=1e-5, abs=1e-7, nan_ok=True)
        assert g.explained == pytest.approx(share[g.component - 1], rel=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_whitening_without_variance(spark):
    got = whiten(_frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in got] == [(1, None, None, None, 0), (2, None, None, None, 0)] * 2
    line = whiten(_frame(spark, [(i, [float(i), 2.0 * i], 0) for i in range(9)])).toPandas()
    assert line[line.component == 2].whitened.isna().all() and line[line.component == 1].whitened.notna().all()
    assert line.identity_error[0] < 1e-9
    assert whiten(_frame(spark, [])).count() == 0 == whiten(_frame(spark, [(1, None, 0), (2, [], 0)])).count()


def test_whitening_beyond_a_long(spark):
    got = whiten(_frame(spark, [(i, [float(2**38) * (i % 2), float(i)], 0) for i in range(40)])).toPandas()
    assert got.deviation.isna().all() and got.identity_error[0] < 1e-4


def test_hard_negatives_over_many_tiles(spark, monkeypatch):
    """Small blocks make shares of anchors and of rows, whose results a window puts together."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    rows = _random(5, 300, 3)
    made = []
    tiles = hard_negatives._tiles
    monkeypatch.setattr(hard_negatives, "_tiles", lambda *a: made.append(tiles(*a)) or made[-1])
    got = mine(_frame(spark, rows), F.col("vec_id") % 3 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, got)) == _brute_negatives(rows, 3)
    shape = made[-1].agg(F.count_distinct("share"), F.count_distinct("part")).first()
    assert shape[0] > 1 and shape[1] > 1
