"""Held-out accuracy, the optimiser against its dual bound, and the chain's parts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintner.llm import quality_svm as q
from vintner.llm import toxicity_chain as t
from vintner.llm.queries import held_out, op1_quality_svm, op7_toxicity_chain, training_labels

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_of_held_out_documents(spark, labels):
    rows = op1_quality_svm(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    known = [(r["predicted"], labels[r["doc_id"]]["quality"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(known) > 40 and np.mean([a == b for a, b in known]) >= 0.97


def test_toxicity_of_held_out_documents(spark, labels):
    rows = op7_toxicity_chain(spark, SF).collect()
    held = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter(held_out(F.col("doc_id"))).collect()}
    known = [(r["toxic"], labels[r["doc_id"]]["toxic"]) for r in rows if r["doc_id"] in held]
    assert np.mean([a == b for a, b in known]) >= 0.95
    assert not any(a for a, b in known if not b)
    assert {"p_insult", "p_contempt", "p_veiled", "p_toxic"} <= set(rows[0].asDict())


def test_no_label_of_a_held_out_document_is_learnt_from(spark):
    import zlib

    used = {r["doc_id"] for r in training_labels(spark, SF).collect()}
    assert used and all(zlib.crc32(str(i).encode()) % 5 for i in used)


def test_dual_coordinate_descent_closes_the_gap():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(50, size=8, replace=False)) for _ in range(200)]
    y = np.where(rng.random(200) < 0.3, -1.0, 1.0)
    rows = [np.unique(np.append(r, 49 if s > 0 else 48)) if rng.random() < 0.8 else r for r, s in zip(rows, y, strict=True)]
    values = [np.full(len(r), 1 / np.sqrt(len(r))) for r in rows]
    w, b = q.dual_coordinate_descent(rows, values, y, 50, cost=1.0, rounds=500)
    upper = np.where(y > 0, 200 / (2 * (y > 0).sum()), 200 / (2 * (y < 0).sum()))

    def loss(w, b):
        margins = np.array([w[r] @ v + b for r, v in zip(rows, values, strict=True)])
        return (w @ w + b * b) / 2 + (upper * np.maximum(0, 1 - y * margins)).sum()

    best = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(0, 0.02, 50), b + rng.normal(0, 0.02)) >= best - 1e-2


def test_log_count_ratios():
    rows, y = [np.array([0, 1]), np.array([0]), np.array([1, 2])], np.array([1, 1, 0])
    ratios = q.log_count_ratios(rows, y)
    width = 1 << q.BITS
    assert ratios[0] == pytest.approx(np.log((3 / (3 + width)) / (1 / (2 + width))))
    assert ratios[2] < 0 and ratios[5] == 0


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["One two, THREE!! three three.", "", "x", "a | b | c", "One two, THREE!! three three."]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(x.encode()) for x in texts)])
    text, gram = q.features(np.frombuffer(data, dtype=np.uint8), offsets)
    for k, x in enumerate(texts):
        alone = q.features(np.frombuffer(x.encode(), dtype=np.uint8), np.array([0, len(x.encode())]))[1]
        assert sorted(gram[text == k].tolist()) == sorted(alone.tolist())


@pytest.mark.parametrize("only", [0, 1, None])
def test_one_class_or_none_to_learn_from(spark, only):
    docs = spark.createDataFrame([(1, "good text"), (2, "other text")], "doc_id long, text string")
    known = spark.createDataFrame([] if only is None else [(1, only, only)], "doc_id long, quality int, toxic int")
    model = q.fit(docs, known)
    want = {0: 0.0, 1: 1.0, None: 0.5}[only]
    assert np.allclose(model.scores(pa.array(["good text", None, ""])), want, atol=1e-6)
    chain = t.fit(docs, known)
    p = chain.probabilities(pa.array(["good text", None]))
    assert p.shape == (2, 4) and (((p[:, -1] > 0.5) == (only == 1)).all())


def test_a_chain_passes_earlier_links_on(spark):
    rng = np.random.default_rng(2)
    filler = [f"word{i}" for i in range(300)]
    docs, known = [], []
    for i in range(600):
        words = list(rng.choice(filler, size=30))
        kind = i % 6
        if kind == 0:
            words[3] = "idiot"
        elif kind == 1:
            words[5] = "worthless"
        elif kind == 2:
            words[7] = "qzxveil" + str(rng.integers(50))
        docs.append((i, " ".join(words)))
        known.append((i, int(kind < 3)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    chain = t.fit(frame, spark.createDataFrame(known, "doc_id long, toxic int"))
    assert chain.names == ["insult", "contempt", "veiled", "toxic"]
    assert [len(w) - len(chain.lookup.known) for w in chain.links] == [1, 2, 3, 4]
    p = chain.probabilities(pa.array([x for _, x in docs]))
    kinds = np.arange(600) % 6
    for column, kind in ((0, 0), (1, 1), (2, 2)):
        assert p[kinds == kind, column].min() > 0.5 > p[kinds != kind, column].max()
    assert p[kinds < 3, 3].min() > 0.5 > p[kinds >= 3, 3].max()
    # Endings that were never seen are known by their beginnings.
    assert chain.probabilities(pa.array(["a qzxveil999 b"]))[0, 3] > 0.5
