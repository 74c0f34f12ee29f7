"""Stages and operators on nulls, no rows, repeated rows, very long texts and columns named like their own."""

import random

import pytest

from corpus_pipeline import STAGES
from cratedig.llm import decontaminate, langid, mixing, secret_scan, sharding, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __id string, __th string, __source string, __none string, __copies string, __size string, __hash string, __place string, __of string, __n string, __part string, _id string, th string, hash string, shard string"
CLASH = SCHEMA.count(",") - 4


def docs(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(30), "en" if i % 3 else None, rnd.choice(["a", "b", None]), 1) for i in range(12)]
    rows += [(None, text(25), None, None, None), (None, None, None, None, None), (20, "", "en", "a", 0), (21, "12 !?", "en", "a", 5)]
    rows += [rows[3], rows[3], (22, rows[3][1], "en", "b", 1), (23, text(60_000), "en", "b", 1), (None, rows[12][1], None, None, None)]
    return spark.createDataFrame([(*r, *(f"own {k} of {i}" for k in range(CLASH))) for i, r in enumerate(rows)], SCHEMA)


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame([(1, "never seen in any document at all"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("stage", range(len(STAGES)), ids=[name for name, _ in STAGES])
def test_rows_stay_as_they_are(spark, sf_dir, stage):
    frame, f = docs(spark), STAGES[stage][1]
    last = stage == len(STAGES) - 1
    own = [c for c in frame.columns if not last or c != "shard"]
    out = f(spark, frame, sf_dir)
    assert set(out.columns) == set(frame.columns)
    source = {tuple(r) for r in frame.select(own).collect()}
    got = [tuple(r) for r in out.select(own).collect()]
    assert set(got) <= source
    kept = {r[0] for r in got if r[0] is not None}
    gone = {0: {20, 21}, 1: {22}}.get(stage, set())
    assert gone.isdisjoint(kept) or stage == 3
    if stage != 3:
        assert kept == set(range(12)) | {20, 21, 22, 23} - gone
    if last:
        assert out.where("shard is null").count() == 0
        assert len(got) == frame.count()
    empty = f(spark, frame.limit(0), sf_dir)
    assert empty.count() == 0
    assert set(empty.columns) == set(frame.columns)


LONG = 1_300_000


def long_text(seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(LONG // 7))


def test_passage_over_the_end_of_a_piece(spark):
    passage = "".join(random.Random(1).choice("klmnop") for _ in range(900))
    at = (1 << 20) - 450
    long = long_text(1)
    text = long[:at] + passage + long[at:] + long_text(2)
    assert len(text) > 2 * (1 << 20)
    rows = [(1, text), (2, f"x {passage} y"), (3, "other")]
    got = {r.doc_id: r for r in suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[1].spans] == [(at, at + 900)]
    assert [tuple(s) for s in got[2].spans] == [(2, 902)]
    assert (got[1].n_bytes, got[1].n_removed, got[3].n_removed) == (len(text), 900, 0)


def test_very_long_texts(spark):
    item = "the last ten words of it are those of an item"
    text = f"{long_text(3)} {item} token = abcdef0123"
    frame = spark.createDataFrame([(1, text, "xx", "a"), (2, "der kurze Text", "de", "a"), (3, "ein anderer Text", "de", "b")], "doc_id long, text string, lang string, source string")
    hit = decontaminate.contamination_report(frame, spark.createDataFrame([(5, item)], "item_id long, text string")).where("doc_id = 1").first()
    assert (hit.n_hit, hit.n_items) == (11, 1)
    assert secret_scan.secret_report(frame).where("doc_id = 1").first().spans.startswith(f"assign:{len(text) - 18}:{len(text)}")
    model = langid.train(frame)
    assert {r.doc_id: r.lang_pred for r in langid.identify(frame, model).collect()} == {1: "xx", 2: "de", 3: "de"}
    assert toxicity.score_toxicity(frame, toxicity.Model(toxicity.Lexicon(toxicity.np.zeros(0, "uint64"), 8), toxicity.np.zeros(37))).count() == 3
    assert mixing.mix_sources(frame).where("doc_id = 1").first().size == len(text.split())
    shards = {r.doc_id: r for r in sharding.assign_shards(frame).collect()}
    assert not shards[1].fits
    assert shards[2].fits


def test_repeated_rows_beyond_a_shard(spark):
    frame = spark.createDataFrame([(None, "x" * 40)] * 25 + [(None, "y" * 150)] * 2 + [(7, "z")], "doc_id long, text string").repartition(3)
    got = sharding.assign_shards(frame, limit=100).collect()
    sums = {}
    for r in got:
        sums[r.shard] = sums.get(r.shard, 0) + r.n_bytes
    assert len(got) == 28
    assert all(sums[r.shard] == r.shard_bytes for r in got)
    assert all(r.fits == (r.n_bytes < 100) for r in got)
    assert len([s for s, n in sums.items() if n <= 80 and "." in s]) == 13
