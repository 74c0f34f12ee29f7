import random

from cratedig.llm.toxicity import train_and_score

RARE = ["qorvel", "zimpar", "dultok", "yebrin", "wufmas"]


def test_words_of_a_small_topic(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7)))
    docs, labels, rare = [], [], set()
    for i in range(10_500):
        words = [word() for _ in range(12)]
        toxic = int(i % 7 == 0)
        if toxic and i % 140 == 0:
            # 5 % of the toxic documents, each of their words in a fifth of those
            words.insert(rnd.randrange(12), RARE[i // 140 % 5])
            rare.add(i)
        elif toxic:
            words.insert(rnd.randrange(12), rnd.choice(["zorkling", "vexatik"]))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    got = train_and_score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    of_topic = [r for r in held if r.doc_id in rare]
    assert len(of_topic) >= 8
    assert sum(r.predicted for r in of_topic) >= 0.8 * len(of_topic)
    assert sum(r.predicted for r in held if r.doc_id % 7) <= 0.01 * len(held)
