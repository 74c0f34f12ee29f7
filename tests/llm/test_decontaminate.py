import hashlib
import random
import re

import pytest

from cratedig.llm.decontaminate import contamination_report, drop_contaminated

DOCS, ITEMS = "doc_id long, text string, th string", "item_id long, text string, doc_id long"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = {}
    for i, text, _ in docs:
        own, hit, found = words(text), set(), set()
        for item, t, _ in items:
            w = words(t)
            n = min(10, len(w))
            for at in range(len(w) - n + 1) if n else ():
                for p in range(len(own) - n + 1):
                    if own[p : p + n] == w[at : at + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(own), len(hit), len(found), sha, bool(hit))
    return out


def corpus():
    rnd = random.Random(3)
    vocabulary = [*"abcdef", "été", "x9", "Ünd", "the"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 3, 9, 10, 11, 25])), 0) for i in range(25)] + [(90, None, 0), (91, "", 0), (92, " - ", 0)]
    items += [(93, "solo", 0), (94, items[4][1], 0)]
    docs = [(0, None, "a"), (1, "", "b"), (2, "..", "c"), (3, "Solo", "d")]
    for i in range(4, 60):
        t = text(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 2)):
            t += " " + (rnd.choice(items)[1] or "").upper() + "! " + text(rnd.randint(0, 8))
        docs.append((i, t, "x"))
    docs.append((60, text(900) + " " + items[3][1] + " " + text(600), "y"))
    return docs, items


@pytest.mark.parametrize("block_words", [2_000_000, 200])
def test_matches_brute_force(spark, block_words):
    docs, items = corpus()
    want = brute(docs, items)
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = contamination_report(frame, bench, block_words=block_words).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    kept = drop_contaminated(frame, bench)
    assert kept.columns == ["doc_id", "text", "th"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in want.items() if not w[4])


def test_repeated_rows_null_ids_and_no_rows(spark):
    bench = spark.createDataFrame([(None, "a b", 1), (5, "c d", 1), (5, "c d", 1)], ITEMS)
    docs = spark.createDataFrame([(None, "c D", None), (None, "c D", None), (1, "a b", None)], DOCS)
    got = contamination_report(docs, bench).collect()
    assert sorted((r.n_items, r.contaminated) for r in got) == [(0, False), (1, True), (1, True)]
    assert [r.doc_id for r in drop_contaminated(docs, bench).collect()] == [1]
    assert contamination_report(docs.limit(0), bench).count() == 0
    assert contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0
