import zlib

import numpy as np
from cases import ROWS, frame

from noticeworks.llm import factorisation as f
from noticeworks.llm import queries


def test_the_score_sums_all_pairs():
    rnd = np.random.RandomState(1)
    model = f.Model(0.3, rnd.normal(size=f.SLOTS), rnd.normal(size=(f.SLOTS, f.RANK)))
    slots, values = f.features("the ring of the tower ### and 12 things. Of them")
    plain = model.bias + sum(model.linear[s] * v for s, v in zip(slots, values))
    for a in range(len(slots)):
        for b in range(a):
            plain += model.factors[slots[a]] @ model.factors[slots[b]] * values[a] * values[b]
    assert abs(model.margin(slots, values) - plain) < 1e-8


def test_features_have_each_slot_once_and_no_statistic_fails():
    for text in (None, "", " ", "a", "A" * 5000, "é\n\n\n", "the the the\nthe the the"):
        slots, values = f.features(text)
        assert len(set(slots.tolist())) == len(slots) == len(values) and slots.max() < f.SLOTS
        assert np.isfinite(values).all()


def test_a_pair_of_words_can_be_learnt():
    rows = []
    for k in range(400):
        x, y = k % 2, k // 2 % 2
        text = f"{'up' if x else 'down'} {'left' if y else 'right'}"
        rows.append((*f.features(text), int(x == y)))
    model = f.fit(rows, epochs=30)
    assert sum((model.score(s, v) > 0.5) == y for s, v, y in rows) == 400


def test_held_out_rows_are_no_part_of_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels")
    ids = [r["doc_id"] for r in f.sample_of(docs, labels, 50).collect()]
    assert len(ids) == 50 and all(zlib.crc32(str(x).encode()) % 4 != 2 for x in ids)


def test_accuracy_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in queries.op2_factorisation_machine(spark, folder).collect()}
    assert len(out) == 1000
    held = [r for r in queries.table(spark, folder, "labels").collect() if out[r["doc_id"]]["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([out[r["doc_id"]]["predicted"] == r["quality"] for r in held]) >= 0.97
    assert np.mean([out[r["doc_id"]]["predicted"] for r in held if r["quality"] == 1]) >= 0.99


def test_odd_rows_labels_and_names(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0), (None, 1, 0), (6, None, 0), (99, 1, 0), (8, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    df = frame(spark, extra={"score": "x", "f": "y"})
    model = f.train(df, labels)
    rows = f.score(df, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    again = f.score(df, f.train(df, labels)).collect()
    assert sorted(r["score"] for r in rows) == sorted(r["score"] for r in again)


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = f.train(frame(spark), none)
    assert {r["score"] for r in f.score(frame(spark), model).collect()} == {0.5}
    assert f.score(frame(spark, []), model).count() == 0
