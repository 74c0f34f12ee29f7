import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, source string"


def shingles(text, n=5):
    words = text.encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def survivors(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    return [i for i in ids if root(i) == i]


def test_five_words(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(6):
        base = [f"w{rnd.randrange(5000)}" for _ in range(400)]
        rows.append(" ".join(base))
        # scattered edits: about 0.82 on two-word sets and 0.60 on five-word sets; a few: over 0.8 on both
        for edits in (20, 20, 3):
            words = list(base)
            for at in range(edits):
                words[10 + 19 * at] = f"x{rnd.randrange(10**9)}"
            rows.append(" ".join(words))
    rows = [(i, t, "s") for i, t in enumerate(rows)]
    want = survivors(rows)
    assert len(want) == 18
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r.doc_id for r in got.collect()) == want
