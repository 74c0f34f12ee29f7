import random

from cratedig.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def tables(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(9)) for _ in range(n))
    items = [(i, text(rnd.choice([3, 12, 30]))) for i in range(12)] + [(50, text(700)), (51, "")]
    huge = items[12][1].split()
    docs = [(None, items[3][1]), (7, "none of it"), (None, None)] * 3
    docs += [(i, " ".join(huge[at : at + 40])) for i, at in enumerate(range(0, 660, 23))] * 2
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)


def test_every_row_whatever_the_passes(spark):
    docs, items = tables(spark)
    rows = lambda **p: sorted(map(repr, decontaminate.contamination_report(docs, items, **p).collect()))
    assert len(rows()) == docs.count()
    assert rows(block_words=300) == rows()


def test_passes_are_bounded(spark):
    items = tables(spark)[1].selectExpr("cast(item_id as string) item", "text")
    passes = list(decontaminate._passes(items, 10, 300))
    assert len(passes) > 2
    assert all(sum(len(r["text"].split()) for r in p) <= 300 for p in passes)
    windows = lambda rows: {(r["item"], *w[i : i + 10]) for r in rows for w in [r["text"].split()] for i in range(max(1, len(w) - 9)) if w}
    assert windows(r for p in passes for r in p) == windows(items.collect())
