import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_pipeline_near_duplicates import shingles

SF = "/root/testdata/sf0.001"


def classes(rows):
    sets = {r.doc_id: shingles(r.text) for r in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    shared = Counter((a, b) for ids in by.values() for n, a in enumerate(sorted(ids)) for b in sorted(ids)[n + 1 :])
    top = {i: i for i in sets}
    for (a, b), n in sorted(shared.items()):
        if 100 * n >= 80 * len(sets[a] | sets[b]):
            while top[a] != a:
                a = top[a]
            while top[b] != b:
                b = top[b]
            top[max(a, b)] = min(a, b)

    def root(i):
        return i if top[i] == i else root(top[i])

    return {i: root(i) for i in sets}


def test_stages_against_plain_versions(spark, tmp_path):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        kept.append((docs.collect(), spark.read.parquet(str(tmp_path / name)).collect()))
        if name != "sharding":
            assert out.columns == docs.columns
        docs = spark.read.parquet(str(tmp_path / name))
    before, after = kept[0]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or ""))
    before, after = kept[1]
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in classes(before).items() if i == c)
    before, after = kept[2]
    items = [(r.item_id, r.text, 0) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = leaks([(r.doc_id, r.text, None) for r in before], items)
    assert sorted(r.doc_id for r in after) == sorted(i for i, x in hit.items() if not x[4])
    before, after = kept[3]
    times = Counter(r.doc_id for r in after)
    assert max(times.values()) <= 3
    assert set(times) <= {r.doc_id for r in before}
    before, after = kept[4]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    size = Counter()
    for r in after:
        size[r.shard] += len(r.text.encode())
    assert all(n <= 1 << 20 for n in size.values())
