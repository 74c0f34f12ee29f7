import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cratedig.llm.mixing import mix_sources, mixed_documents, source_targets
from cratedig.llm.sharding import assign_shards, sharded_documents

SCHEMA = "doc_id long, text string, source string, lang string, size long, shard string"


def docs(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{min(i % 9, 4)}", None, 1, "x") for i in range(400)]
    rows += [(500, None, None, None, 1, "x"), (501, "", "only blank", None, 1, "x"), (502, "a b", None, None, 1, "x")]
    rows += [(None, "same text here", "twice", None, 1, "x")] * 3
    return spark.createDataFrame(rows, SCHEMA)


def level(sizes, weights, most):
    capped, total = set(), sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(most * sizes[i] for i in capped)
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > most * sizes[i] * (1 + 1e-12)}
        if not over:
            return [most * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes", [[5, 100, 1000, 0, 40, 7], [10, 10, 10], [1], [0, 0], [1, 1, 1, 100000]])
def test_targets(spark, sizes):
    got = source_targets(spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")).orderBy("source").collect()
    want = level(sizes, [1 + i % 3 for i in range(len(sizes))], 3)
    assert [r.target for r in got] == pytest.approx(want)


def test_targets_of_many_sources_in_several_ranges(spark):
    sizes = [(i * 7919) % 5003 % (1 + i % 50) for i in range(3000)]
    frame = spark.createDataFrame([(f"s{i:04d}", n) for i, n in enumerate(sizes)], "source string, source_size long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = source_targets(frame).orderBy("source").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.target for r in got] == pytest.approx(level(sizes, [1 + i % 3 for i in range(len(sizes))], 3))
    assert source_targets(frame.limit(0)).count() == 0


def test_mix(spark):
    frame = docs(spark)
    got = mix_sources(frame).collect()
    assert len(got) == frame.count()
    assert sorted(map(tuple, mix_sources(frame.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for rows in by.values():
        off = abs(sum(r.taken for r in rows) - rows[0].target)
        assert off <= max(r.size * sum(x.doc_id == r.doc_id for x in rows) for r in rows)
    assert math.isclose(sum(rows[0].target for rows in by.values()), sum(r.size for r in got))
    out = mixed_documents(frame)
    assert out.columns == frame.columns
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in want.items() if v})
    assert mix_sources(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="most"):
        mix_sources(frame, most=0)


@pytest.mark.parametrize("limit", [40, 300, 10**6])
def test_shards(spark, limit):
    frame = docs(spark)
    got = assign_shards(frame, limit).collect()
    assert len(got) == frame.count()
    size = Counter()
    for r in got:
        size[r.shard] += r.n_bytes
        assert r.fits == (r.shard_bytes <= limit)
        assert r.fits or r.n_bytes > limit
    assert all(size[r.shard] == r.shard_bytes for r in got)
    plain = sorted({r.shard for r in got if "." not in r.shard})
    assert not any(b.startswith(a) for a, b in zip(plain, plain[1:], strict=False))
    # no two siblings would fit together
    for a in plain:
        pair = a[:-1] + ("1" if a[-1:] == "0" else "0")
        assert not a or pair not in plain or size[a] + size[pair] > limit
    out = sharded_documents(frame, limit)
    assert out.columns == frame.columns
    assert Counter((r.doc_id, r.shard) for r in out.collect()) == Counter((r.doc_id, r.shard) for r in got)
    assert assign_shards(frame.limit(0), limit).count() == 0


def test_repeated_rows_meet_the_target(spark):
    """1 500 copies of one document among 2 000: each copy is a step of its own."""
    rows = [(i, f"{i} " + "word " * 9, "a") for i in range(2000)] + [(7, "7 " + "word " * 9, "a")] * 1500 + [(3, "x " * 15_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mix_sources(docs)
    totals = {r["source"]: r for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    assert abs(totals["a"].taken - totals["a"].target) <= 10
    got = mixed_documents(docs).where("source = 'a'")
    assert got.count() * 10 == totals["a"].taken
    most = got.groupBy("doc_id").count().agg(F.max(F.when(F.col("doc_id") != 7, F.col("count"))).alias("most")).first()
    assert most["most"] <= 3
