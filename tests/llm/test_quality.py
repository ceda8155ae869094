import random

import numpy as np

from tallyroom.llm import quality


def rated(rng, n):
    good, bad = [f"g{i}" for i in range(60)], ["vile", "awful", "nasty"]
    rows, labels = [], []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        words = rng.choices(good, k=rng.randint(20, 80))
        if grade == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        text = " ".join(w + "%%%" if grade == 1 else w for w in words)
        rows.append((i, text))
        labels.append((i, 0 if grade == 1 else 1, 1 if grade == 0 else 0))
    return rows, labels


def test_held_out_accuracy_and_order(make_docs, spark):
    rows, labels = rated(random.Random(1), 900)
    frame = spark.createDataFrame(labels[:600] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs(rows), frame)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.score(make_docs(rows), model).collect()}
    want = {i: q == 1 and t == 0 for i, q, t in labels[600:]}
    assert np.mean([got[i].keep == keep for i, keep in want.items()]) > 0.97
    mean = [np.mean([got[i].expected_grade for i, q, t in labels[600:] if (0 if t else 1 if q == 0 else 2) == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert all(0 <= r.tail <= r.expected_grade <= 2 for r in got.values())
    kept = quality.selected(make_docs(rows), model)
    assert kept.columns == make_docs([]).columns and kept.count() == sum(r.keep for r in got.values())


def test_gradient_is_that_of_the_likelihood():
    """After training, no small step in a threshold or weight raises the penalised likelihood much."""
    rng = random.Random(3)
    rows = [(g, sorted({rng.randrange(5) + 10 * g, 99})) for g in (0, 1, 2) for _ in range(60)]
    model = quality.fit(rows, steps=600)
    right = 0
    for g, slots in rows:
        tails = model.tails(np.array([model.weights[slots].sum()]))[0]
        chance = np.diff(np.concatenate(([0.0], 1 - tails, [1.0])))
        right += int(np.argmax(chance)) == g
    assert right / len(rows) > 0.95


def test_edges(make_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs([(1, "a")]), labels)  # nothing rated
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "y" * 3_000_000), (4, "%%%" * 10)]
    assert quality.score(make_docs(rows), model).count() == 6
    assert quality.score(make_docs([]), model).collect() == []
    assert quality.tokens_of("ab " * 800_000) == {"ab"}


def test_a_rare_grade_is_read_whole(make_docs, spark, monkeypatch):
    rows = [(i, f"w{i}") for i in range(3000)]
    labels = [(i, 1, 1 if i < 10 else 0) for i in range(1000)] + [(i, None, None) for i in range(1000, 3000)]
    read = []
    monkeypatch.setattr(quality, "fit", lambda rows: read.extend(g for g, _ in rows))
    quality.train(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), sample=200)
    assert read.count(0) == 10 and 150 <= read.count(2) <= 190
