"""How often operator 2 goes to the shared folder."""

from eqscene.llm import _components, order_minhash


def test_components_end_with_stars(spark, monkeypatch):
    """No round is written only to see that it changes nothing."""
    real, labels = _components.staged, []
    monkeypatch.setattr(_components, "staged", lambda df, label: labels.append(label) or real(df, label))
    star = spark.createDataFrame([(k, 0) for k in range(1, 40)] + [(0, 1)], "u long, v long")
    assert sorted(map(tuple, _components.components(star).collect())) == [(k, 0) for k in range(1, 40)]
    assert len(labels) == 1
    chain = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, 50)], "u long, v long")
    assert sorted(map(tuple, _components.components(chain).collect())) == [(k, 0) for k in range(1, 31)]
    assert _components.components(star.limit(0)).collect() == []


def test_what_still_waits_is_written_once(docs, monkeypatch):
    """After the last wave of leads nothing reads what waits."""
    real, labels = order_minhash.staged, []
    monkeypatch.setattr(order_minhash, "staged", lambda df, label: labels.append(label) or real(df, label))
    text = " ".join(f"w{k}" for k in range(60))
    got = order_minhash.near_duplicates(docs([(1, text), (2, text + " end"), (3, "other words")])).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 3} and labels.count("waiting") == 1
