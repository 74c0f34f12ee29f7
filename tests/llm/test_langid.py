import itertools
import random

import numpy as np

from cratedig.llm.langid import best_labels, drop_unknown, identify, train, train_and_identify

SCHEMA = "doc_id long, text string, lang string, score double"
WORDS = {
    "aa": "the and with from which there would their about could other people because through".split(),
    "bb": "der und nicht werden können zwischen während straße größe schließlich immer über".split(),
    "ru": "что это как его только если может быть время после который между".split(),
}


def brute(scores, penalty):
    best = (-1e99, None)
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        total = sum(scores[t, k] for t, k in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path))
        best = max(best, (total, path), key=lambda x: x[0])
    return best[0]


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 8, 60)
    scores = rng.normal(size=(counts.sum(), 3)) * 3
    for penalty, block in itertools.product((0.5, 2.0, 6.0), (1, 2, 3, 256)):
        labels = best_labels(scores, counts, penalty, block)
        first = np.cumsum(counts) - counts
        for a, n in zip(first, counts, strict=True):
            own, path = scores[a : a + n], labels[a : a + n]
            total = own[np.arange(n), path].sum() - penalty * (np.diff(path) != 0).sum()
            assert np.isclose(total, brute(own, penalty))


def test_long_rows_are_labelled_as_if_walked_whole():
    rng = np.random.default_rng(7)
    counts = np.array([5000, 3, 700, 256, 257, 1, 2048])
    scores = np.repeat(rng.normal(size=(counts.sum() // 40 + 1, 4)) * 2, 40, axis=0)[: counts.sum()] + rng.normal(size=(counts.sum(), 4))
    assert (best_labels(scores, counts, 6.0) == best_labels(scores, counts, 6.0, block=10_000)).all()


def frame(spark):
    rnd = random.Random(5)
    text = lambda k, n: " ".join(rnd.choice(WORDS[k]) for _ in range(n))
    rows = [(i, text(k, rnd.randint(3, 60)), k, 0.0) for i, k in enumerate(rnd.choice(list(WORDS)) for _ in range(300))]
    rows += [(400, None, "aa", 0.0), (401, "", None, 0.0), (402, "12 !?", "bb", 0.0), (None, text("ru", 5), None, 0.0), (403, text("aa", 30), None, 0.0)]
    rows += [(404, "ΑΒΓ δεζ", "aa", 0.0)] * 2
    return spark.createDataFrame(rows, SCHEMA), text


def test_languages_and_spans(spark):
    docs, text = frame(spark)
    got = train_and_identify(docs).collect()
    by = {r.doc_id: r for r in got}
    want = {r.doc_id: r.lang for r in docs.where("doc_id < 400").collect()}
    assert all(by[i].lang_pred == k for i, k in want.items())
    assert [by[i].lang_pred for i in (400, 401, 402, 403, None)] == ["und", "und", "und", "aa", "ru"]
    assert by[404].lang_pred in WORDS
    assert all(0 <= r.score <= 1 for r in got)
    assert any(r.held_out for r in got)
    assert not all(r.held_out for r in got)
    model = train(docs)
    a, b = text("aa", 20), text("bb", 25)
    mixed = spark.createDataFrame([(1, f"{a}. {b}", None, 0.0)], SCHEMA)
    spans = identify(mixed, model).first().spans
    assert [(s.start, s.end, s.lang) for s in spans] == [(0, len(a), "aa"), (len(a) + 2, len(a) + 2 + len(b), "bb")]
    kept = drop_unknown(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 3
    assert train_and_identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in train_and_identify(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("doc_id < 0")).collect()} == set()


def test_repeated_rows_do_not_fill_the_sample(spark):
    """A third of the rows under one id, another third of one text: the model is that of the different texts."""
    docs, text = frame(spark)
    hot = spark.createDataFrame([(9, text("aa", 12), "bb", 0.0)] + [(-1, text("ru", 9), "ru", 0.0) for _ in range(300)], SCHEMA)
    repeated = hot.where("doc_id = 9").crossJoin(spark.range(300)).drop("id")
    once, often = train(docs.union(hot)), train(docs.union(hot).union(repeated))
    assert (once.gram == often.gram).all()
    assert (once.uses == often.uses).all()
    # of 300 texts under one id about as many are drawn as of others
    small = train(hot.where("lang = 'ru'"), most=30)
    assert not (small.gram == train(hot.where("lang = 'ru'")).gram).all()
    assert small.gram.max() > small.gram.min()
