import random

import numpy as np
import pytest

from cratedig.llm.toxicity import INSULTS, calibrated, label_model, linear_classifier, train_and_score

DOCS, LABELS = "doc_id long, text string, toxic int", "doc_id long, toxic int, text string"


def frame(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    docs, labels = [], []
    for i in range(1500):
        words = [word() for _ in range(rnd.randint(3, 80))]
        toxic = int(i % 7 == 0)
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["zorkling", "zorkish", "vexa", "qrut", rnd.choice(INSULTS)]))
        docs.append((i, " ".join(words), 1 - toxic))
        if i % 2 == 0:
            labels.append((i, toxic, "x"))
    docs += [(5000, None, 1), (5001, "", 1), (None, "some text", 0), (None, "some text", 0)]
    labels += [(5000, None, ""), (None, 1, ""), (0, 0, ""), (9999, 1, "")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_rows(spark):
    docs, labels = frame(spark)
    got = train_and_score(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    wrong = [r for r in held if r.predicted != (r.doc_id % 7 == 0)]
    assert len(held) > 200
    assert len(wrong) <= 0.02 * len(held)
    assert not any(r.predicted for r in got if r.doc_id is None or r.doc_id >= 5000)
    again = {(r.doc_id, round(r.score, 6)) for r in train_and_score(docs.repartition(5), labels).collect()}
    assert again == {(r.doc_id, round(r.score, 6)) for r in got}


def test_no_labels_and_no_rows(spark):
    docs, labels = frame(spark)
    got = {r.doc_id: r.predicted for r in train_and_score(docs, labels.limit(0)).collect()}
    assert len(got) > 1000
    assert train_and_score(docs.limit(0), labels).count() == 0


def distinct(votes):
    rows, inverse, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    return rows, inverse.ravel(), n.astype(float)


def test_label_model_beats_the_majority_where_a_voter_is_copied():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.3
    vote = lambda right: np.where(rng.random(20_000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    poor, good = vote(0.65), [vote(0.85) for _ in range(4)]
    noisy = [np.where(rng.random(20_000) < 0.1, 0, poor) for _ in range(4)]
    votes = np.stack([poor, *noisy, *good], axis=1).astype(np.int8)
    rows, inverse, n = distinct(votes)
    model = label_model(rows, n)
    right = ((model.posterior(rows)[inverse] > 0.5) == truth).mean()
    majority = ((votes.sum(axis=1) > 0) == truth).mean()
    assert right > 0.93 > majority + 0.1
    # what it says of the voters is what they were made to be
    assert model.toxic == pytest.approx(0.3, abs=0.05)
    assert model.accuracy[5:, 1, 2] == pytest.approx(0.85, abs=0.05)
    assert model.accuracy[0, 1, 2] == pytest.approx(0.65, abs=0.08)
    # the copies hang on each other, the good voters on nothing
    assert (model.parent[:5] >= 0).sum() == 4
    assert not any(model.parent[5:] >= 0)


def test_joint_is_the_plain_product():
    rng = np.random.default_rng(8)
    votes = rng.integers(-1, 2, (40, 3)).astype(np.int8)
    rows, _, n = distinct(votes)
    m = label_model(rows, n, rounds=5, least=0.0)
    for v, got in zip(rows, m.posterior(rows), strict=True):
        p = [1 - m.toxic, m.toxic]
        for y in (0, 1):
            for j in range(3):
                p[y] *= m.accuracy[j, y, v[j] + 1] if m.parent[j] < 0 else m.given[j, y, v[m.parent[j]] + 1, v[j] + 1]
        assert got == pytest.approx(p[1] / sum(p))


def test_calibration_meets_the_labels():
    post = np.array([0.01, 0.2, 0.9, 0.999])
    out = calibrated(post, np.array([1.0, 5, 60, 90]), np.array([99.0, 95, 40, 10]))
    assert (np.diff(out) > 0).all()
    assert out @ np.array([100, 100, 100, 100]) == pytest.approx(156, abs=5)


def test_linear_classifier():
    row, column = np.nonzero(np.random.default_rng(4).random((500, 6)) < 0.4)
    target = np.bincount(row, weights=column == 2, minlength=500)
    w = linear_classifier(row, column, 500, 6, target)
    z = np.bincount(row, weights=w[column], minlength=500) + w[-1]
    assert ((z > 0) == (target > 0)).all()
