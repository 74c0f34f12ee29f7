import random

from cratedig.llm.minhash import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string, lang string, node string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 2]) for i in range(len(words) - 1)} if len(words) > 1 else {tuple(words)} - {()}


def brute(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "One\x0btwo", "one two three"]
    for n in (5, 12, 30, 30, 60, 200):
        base = text(n)
        for _ in range(25):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, n // 12))):
                words[rnd.randrange(n)] = rnd.choice(vocabulary)
            texts.append(rnd.choice([" ", "\n", "  "]).join(words))
    # a chain, each linked with the next alone
    base = text(60)
    for k in range(10):
        texts.append(" ".join(base[3 * k :] + text(3 * k)[:0] + [f"x{j}" for j in range(3 * k)]))
    rnd.shuffle(texts)
    return [(i * 3, t, "en", "n") for i, t in enumerate(texts)]


def test_matches_brute_force(spark):
    rows = corpus(1)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)
    kept = drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "node"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "a b c", None, None), (None, "a b c", None, None), (4, "A b  c", None, None), (4, "A b  c", None, None), (None, "z y", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id is None, r.component_id, r.kept) for r in near_duplicates(docs).where("n_shingles = 2").collect())
    assert got == [(False, 4, True), (False, 4, True), (True, 4, False), (True, 4, False)]
    assert sorted(r.text for r in drop_near_duplicates(docs).collect()) == ["A b  c", "z y"]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
