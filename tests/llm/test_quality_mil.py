import random

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import quality_mil as M
from tests.llm.util import docs, long_text, prose


def test_gradient_matches_differences(monkeypatch):
    """One plain step of Adam moves against the numerical gradient of the mean loss."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(k, M.N_FEATURES)) for k in (1, 4, 2, 7, 3, 5)]
    y = np.array([0, 1, 1, 0, 1, 0], dtype=float)
    start = M.fit(bags, y, epochs=0)

    def loss(w):
        model = M.Model(w, start.mean, start.scale, 0.5)
        p = np.array([model.score_passages(b) for b in bags])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    rate = 1e-6
    after = M.fit(bags, y, epochs=1, batch=10, rate=rate, decay=0.0)
    for k, v in start.weights.items():
        moved = (after.weights[k] - v) / rate  # Adam's first step: minus the sign
        for at in list(np.ndindex(v.shape))[::max(1, v.size // 9)]:
            up, down = ({**start.weights, k: v.copy()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-4:
                assert np.sign(moved[at]) == -np.sign(slope), (k, at)


def test_blocks_do_not_change_a_score(monkeypatch):
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(5, M.N_FEATURES)) for _ in range(8)]
    model = M.fit(bags, np.array([0, 1] * 4, dtype=float), epochs=3)
    long = rng.normal(size=(1000, M.N_FEATURES))
    whole = model.score_passages(long)
    monkeypatch.setattr(M, "BLOCK", 7)
    assert np.isclose(whole, model.score_passages(long))


def test_describe():
    assert M.describe("").shape == (1, M.N_FEATURES)
    x = M.describe("a" * 512 + "B" * 100)
    assert x.shape == (2, M.N_FEATURES) and x[0, 0] == 1 and x[1, 1] == 1
    assert M.BYTE_CLASS.max() == M.N_CLASSES - 1


def corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        good = i % 4 != 0
        text = ". ".join(prose(rng, 30) for _ in range(rng.randrange(1, 8)))
        if not good:
            text = text.replace(" ", rng.choice(["&&& ", "!! ", " | "])).upper()
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def test_learns_and_scores_every_row(spark):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, long_text(30_000)), (1002, long_text(30_000)), (None, "x y")]
    table = docs(spark, rows + extra)
    marks = spark.createDataFrame(labels + [(1000, None)], "doc_id long, quality int")
    model = M.train(table, marks, usable=M.trainable(F.col("id")))
    got = M.score(table, model, held_out=M.crc32_mod(F.col("id"), 4) == 2).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in got}
    held = [(i, y) for i, y in labels if by_id[i].held_out]
    assert len(held) > 30 and np.mean([by_id[i].predicted == y for i, y in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_one_label_no_label_empty_table(spark):
    rows, _ = corpus()
    table = docs(spark, rows[:20])
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert {r.score for r in M.score(table, M.train(table, ones)).collect()} == {1.0}
    none = M.train(table, ones.where("false"))
    assert {r.score for r in M.score(table, none).collect()} == {0.5}
    assert M.score(docs(spark, []), none).collect() == []


def test_training_rows_are_bounded_after_the_join(spark, monkeypatch):
    """One labelled id on many rows, repeated and different: what the driver fits stays bounded."""
    from marquee.llm import quality_mil
    seen = []
    plain = quality_mil.fit
    monkeypatch.setattr(quality_mil, "fit", lambda bags, y, **o: seen.append(len(bags)) or plain(bags, y, **o))
    rows = [(1, f"good text number {i} with words")for i in range(400)] + [(1, "same")] * 400 + [(2, "bad $$$ !!!")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality_mil.train(table, labels, max_train=20)
    assert not seen or seen[0] <= 60
    quality_mil.train(table, labels, max_train=4000)
    assert seen[-1] == 402  # repeated rows count once
