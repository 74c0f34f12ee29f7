import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cratedig.llm.importance import importance_ranks, radix_rank, resampled, span_crc32

SCHEMA = "doc_id long, text string, rank string, _PLACE int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(runs[0], runs[1] + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, runs, buckets, least, percent):
    """(doc_id, n_features, weight, score, rank) by the definition, one text at a time."""
    bags = [features(x, runs) for _, x in rows]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, fs in bags for f in fs), Counter(bucket(f) for x in target for f in features(x, runs)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (ss + buckets)) / ((s[b] + 1) * (tt + buckets))))
    out = []
    for (i, _), (n_words, fs) in zip(rows, bags, strict=True):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((n_words, i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in out if x[0] >= least), key=lambda x: (-x[4], x[1] is None, x[1] or 0, x[2]))
    drawn = len(able) * percent // 100
    return sorted([(*x[1:], k + 1 if k < drawn else None) for k, x in enumerate(able)] + [(*x[1:], None) for x in out if x[0] < least], key=repr)


def fixture():
    rnd = random.Random(5)
    words = ["Über", "the", "a", "naïve", "x1", "été", "B" * 60, "Ωmega", "cat", "sat"]
    text = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", ",", "\n", "-"]) for _ in range(n))
    rows = [(i, text(rnd.randint(0, 60))) for i in range(60)]
    rows += [(None, text(30)), (None, text(40)), (None, None), (7, ""), (8, None), (-5, "--- !"), (2**62, text(25)), (-(2**62), text(22)), (11, text(6000))]
    return rows + [(3, rows[3][1])] * 40 + [(None, rows[4][1])] * 30, [text(20), None, "", "the cat sat", text(50)]


@pytest.mark.parametrize("runs,buckets,percent", [((1, 1), 10_000, 10), ((1, 3), 97, 50), ((2, 2), 1, 100), ((1, 1), 10, 0)])
def test_ranks_equal_the_definition(spark, runs, buckets, percent):
    rows, target = fixture()
    docs = spark.createDataFrame([(*r, "y", 1) for r in rows], SCHEMA)
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance_ranks(docs, wanted, runs, buckets, percent=percent).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, target, runs, buckets, 20, percent)


def test_resampled_rows_are_those_drawn(spark):
    rows, target = fixture()
    docs = spark.createDataFrame([(*r, str(k), 1) for k, r in enumerate(rows)], SCHEMA)
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    got = resampled(docs, wanted, percent=50).collect()
    drawn = Counter(x[0] for x in plain(rows, target, (1, 1), 10_000, 20, 50) if x[4])
    assert Counter(r.doc_id for r in got) == drawn
    assert len({r["rank"] for r in got}) == len(got)
    assert got[0].asDict().keys() == {"doc_id", "text", "rank", "_PLACE"}


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    rows, target = fixture()
    assert importance_ranks(none, none).count() == 0
    assert resampled(none, none).count() == 0
    docs = spark.createDataFrame([(*r, "y", 1) for r in rows], SCHEMA)
    got = importance_ranks(docs, none).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, [], (1, 1), 10_000, 20, 10)
    with pytest.raises(ValueError):
        importance_ranks(docs, none, runs=(2, 1))


@pytest.mark.parametrize("values", [[5] * 30, [-(2**63), 2**63 - 1, 0, -1, 1, None, None], [*range(-300, 300), None], [1 << 40, 3, (1 << 40) + 1]])
def test_radix_rank_sorts(spark, values):
    random.Random(1).shuffle(values)
    rows = [(v, -k % 7) for k, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = radix_rank(frame, [("a", True), ("b", False)]).orderBy("rank").collect()
    assert [tuple(r)[:2] for r in got] == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [r["rank"] for r in got] == list(range(1, len(rows) + 1))


def test_span_crc32():
    rnd = np.random.default_rng(3)
    buf = rnd.integers(0, 256, 5000).astype(np.uint8)
    starts = rnd.integers(0, 4000, 500)
    ends = starts + np.where(rnd.random(500) < 0.1, rnd.integers(0, 900, 500), rnd.integers(0, 50, 500))
    assert span_crc32(buf, starts, ends).tolist() == [zlib.crc32(buf[a:b]) for a, b in zip(starts, ends, strict=True)]
