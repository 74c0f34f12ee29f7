import hashlib
import random
from collections import Counter

import numpy as np

from cratedig.llm.suffix_dedup import multikey_order, remaining_text, repeated_spans

SCHEMA = "doc_id long, text string, lang string, th string"


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        hit = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                hit[i : i + length] = True
        edges = np.diff(np.concatenate([[0], hit.astype(int)]))
        kept = bytes(b for b, h in zip(r, hit, strict=True) if not h)
        out.append((len(r), int(hit.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, letters, length):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    shared = [word(rnd.randint(length // 2, 3 * length)) for _ in range(6)]
    texts = [None, "", "ab", word(length), word(length) * 3, "a" * (4 * length)]
    for _ in range(60):
        text = word(rnd.randint(0, 2 * length))
        for _ in range(rnd.randint(0, 3)):
            text += rnd.choice(shared)[rnd.choice([0, 0, 3]) :] + word(rnd.randint(0, length))
        texts.append(text)
    texts += [texts[10], texts[10], texts[20][:-1] + "z"]
    return texts


def check(spark, texts, **parameters):
    rows = [(i, t, "en", "x") for i, t in enumerate(texts)]
    got = sorted(repeated_spans(spark.createDataFrame(rows, SCHEMA), **parameters).collect())
    want = brute(texts, parameters["length"])
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == [(i, *w) for i, w in enumerate(want)]


def test_matches_brute_force(spark):
    check(spark, corpus(1, "abcdefgh ", 60), length=60, gram=16)
    check(spark, corpus(2, "abé", 60), length=60, gram=16)


def test_buckets_that_end_within_copies(spark):
    check(spark, corpus(3, "abcdefgh ", 60), length=60, gram=16, bucket=7)
    check(spark, corpus(4, "ab", 40), length=40, gram=8, bucket=5)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(None, text, None, None), (None, text, None, None), (3, None, None, None)]
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(None, 500, 500), (3, 0, 0)}
    assert repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def test_remaining_text_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x" * 30 + "q" * 500, "en", "own"), (2, "y" * 500, "de", "b"), (3, None, None, None)], SCHEMA)
    got = remaining_text(docs).orderBy("doc_id")
    assert got.columns == docs.columns
    assert [r.text for r in got.collect()] == ["x" * 30, "", ""]
    assert [r.th for r in got.collect()] == ["own", "b", None]


def test_multikey_order():
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 4, (3000, 5)).astype(np.uint64)
    order = multikey_order(tokens)
    assert sorted(order) == list(range(3000))
    got = [tuple(x) for x in tokens[order]]
    assert got == sorted(got)
