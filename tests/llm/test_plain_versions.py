"""op3, op5, op7 and op10 on the given tables against plain versions of them, one document at a time."""

import functools
import math
import os
import unicodedata

import numpy as np
import pytest

from cratedig.llm import ann, langid, toxicity
from cratedig.llm._letters import SCRIPTS, Words
from cratedig.llm.queries import QUERIES
from tests.llm.test_ann import brute as nearest_brute
from tests.llm.test_secret_scan import brute as secrets_brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_words(text):
    out, word = [], ""
    for c in f"{text or ''} ":
        if c.isalpha() or (0x300 <= ord(c) < 0x20000 and unicodedata.category(c)[0] == "M"):
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def lower(word):
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in word)


def test_op3(spark):
    docs = documents(spark)
    model = langid.train(docs.where(langid.doc_fold(docs["doc_id"]) != 0))
    names = list(SCRIPTS)

    @functools.cache
    def scores(word):
        one = Words([word])
        _, buckets = one.grams(np.array([0]), langid.GRAMS, langid.BITS)
        total = [0.3 * math.fsum(float(model.gram[b, k]) for b in buckets) for k in range(len(model.languages))]
        script = next((1 + i for i, n in enumerate(names) for a, b in SCRIPTS[n] if a <= ord(lower(word)[0]) <= b), 0)
        if not any(model.uses[script]):
            return [0.0] * len(total)
        least = min(total)
        total = [t if model.uses[script, k] else least - 25 for k, t in enumerate(total)]
        return [t - max(total) for t in total]

    def plain(text):
        words = [lower(w) for w in plain_words(text)]
        if not words:
            return "und", 0.0
        value, back = list(scores(words[0])), []
        for w in words[1:]:
            top = max(range(len(value)), key=lambda k: value[k])
            back.append([k if value[k] >= value[top] - langid.SWITCH else top for k in range(len(value))])
            value = [max(v, value[top] - langid.SWITCH) + s for v, s in zip(value, scores(w), strict=True)]
        path = [max(range(len(value)), key=lambda k: value[k])]
        for row in reversed(back):
            path.append(row[path[-1]])
        path.reverse()
        mass = [sum(len(w) for w, k in zip(words, path, strict=True) if k == j) for j in range(len(value))]
        best = max(range(len(value)), key=lambda k: mass[k])
        sure = sum(len(w) / sum(math.exp(s) for s in scores(w)) * math.exp(scores(w)[best]) for w, k in zip(words, path, strict=True) if k == best)
        return model.languages[best], sure / sum(mass)

    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op3_language_id"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        lang, score = plain(text)
        assert got[i][0] == lang
        assert got[i][1] == pytest.approx(score, abs=2e-3)


def test_op5(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.vector)) for r in ann.valid_vectors(vectors).collect()]
    want = nearest_brute(rows, [x for x in rows if x[0] % 50 == 0], 5)
    got = {}
    for r in QUERIES["op5_nearest"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == set(want)
    assert sum(len({i for i, _ in want[q]} & set(got[q])) for q in want) >= 0.9 * sum(len(x) for x in want.values())
    scores = {(q, i): s for q, found in got.items() for i, s in found.items()}
    assert all(scores[q, i] == pytest.approx(s, abs=1e-12) for q, found in want.items() for i, s in found if (q, i) in scores)


def test_op7(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    outside = lambda df: df.where(toxicity.doc_fold(df["doc_id"]) != 0)
    model = toxicity.train(outside(docs), outside(labels))
    entries = {int(k): i for i, k in enumerate(model.lexicon.keys)}

    @functools.cache
    def keys(word):
        one = Words([word])
        out = {int(one.hash[0])}
        for n in (4, 5, 6):
            if len(word) > n:
                head = one.span(np.array([0]), np.array([n])) + np.uint64(n)
                out.add(int(toxicity.mix(head)[0]))
        return out

    def plain(text):
        words = plain_words(text)
        low = [lower(w) for w in words]
        present = {entries[k] for w in low for k in keys(w) if k in entries}
        votes = [int(any(model.lexicon.voter[e] == v for e in present)) for v in range(toxicity.VOTERS)]
        insults = sum(w in toxicity.INSULTS for w in low)
        letters, upper = sum(map(len, words)), sum(a != b for w, v in zip(words, low, strict=True) for a, b in zip(w, v, strict=True))
        marks = 0 if text is None else text.count("!") + text.count("?!")
        votes += [int(insults > 0), 1 if insults >= 3 else -1 if insults == 0 else 0, int(letters >= 20 and upper > 0.5 * letters)]
        votes += [1 if marks > 0.05 * max(1, len(words)) else -1 if marks == 0 else 0]
        z = model.weights[-1] + sum(model.weights[e] for e in present)
        z += sum(model.weights[len(entries) + 3 * j + v + 1] for j, v in enumerate(votes) if v)
        return 1 / (1 + math.exp(-z))

    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.score for r in QUERIES["op7_toxicity"](spark, SF).collect()}
    assert set(got) == set(texts)
    assert all(got[i] == pytest.approx(plain(t), abs=1e-6) for i, t in texts.items())


def test_op10(spark):
    larger = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op10_secret_scan"](spark, larger).collect()
    assert len(got) == len(texts)
    assert sum(r.n_assign for r in got) > 0
    for r in got:
        assert ((r.n_assign, r.n_access, r.n_hex), r.base_sha256) == secrets_brute(texts[r.doc_id])
