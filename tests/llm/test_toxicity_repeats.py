import random

import numpy as np

from cratedig.llm._letters import Words
from cratedig.llm.toxicity import _BEGINNINGS, _TIMES, _entries, train_and_score


def test_entries_are_words_beginnings_and_repeats():
    texts = ["abcdefgh abcdxyz Abcdq", "abc abc", None, "", "abcdefgh"]
    row, _ = _entries(Words(texts))
    plain = []
    for t in texts:
        words = (t or "").lower().split()
        held = words + [w[:n] for w in words for n in _BEGINNINGS if len(w) > n]
        # a word and the beginning of another that reads alike are different entries
        kinds = [("word", w) for w in words] + [("head", h) for h in held[len(words) :]]
        times = {k: kinds.count(k) for k in kinds}
        plain.append(len(times) + sum(times[k] >= n for k in times for n in _TIMES))
    assert np.bincount(row, minlength=len(texts)).tolist() == plain


def test_one_word_of_a_family_is_clean_and_several_are_not(spark):
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7)))
    docs, labels = [], []
    for i in range(3000):
        words = [word() for _ in range(rnd.randint(10, 40))]
        toxic = int(i % 9 == 0)
        # clean documents hold one word of the family in three cases of ten, so its presence alone tells little
        for _ in range(rnd.randint(3, 6) if toxic else rnd.random() < 0.3):
            words.insert(rnd.randrange(len(words)), "zorkl" + word())
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    got = train_and_score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    bad = [r for r in held if r.doc_id % 9 == 0]
    assert len(bad) > 40
    assert sum(r.predicted for r in bad) >= 0.9 * len(bad)
    assert sum(r.predicted for r in held if r.doc_id % 9) <= 0.01 * len(held)
