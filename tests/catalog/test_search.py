import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cratedig.operators import fulltext
from cratedig.operators.fulltext import bm25, bounds, build_index, index_exists, postings, prefix_hits, read_index, search_fast, sections, top_hits, top_scored, write_index
from cratedig.operators.search_docs import credit_strings
from cratedig.operators.tiered import like_tier, search, search_artists, search_tracks, tiered_topn
from cratedig.schemas import SEARCH_DOCS, TABLES

DOCS = [
    ("artist", "a1", "Nine Inch Nails", "Nails", "Group US", "NIN"),
    ("artist", "a2", "Ninja", "", "", ""),
    ("release", "e1", "Broken Nails", "Nine Inch Nails", "1992 US", "0001"),
    ("track", "t1", "Wish", "Broken", "Nine Inch Nails", "2"),
    ("track", "t2", "", "", "", ""),
]


def docs(spark):
    return spark.createDataFrame(DOCS, SEARCH_DOCS)


def plain_bm25(prefixes, weights=(2, 1, 1, 1)):
    import math
    import re

    words = [[re.findall(r"\w+", c.lower()) for c in d[2:]] for d in DOCS]
    length = [sum(map(len, w)) for w in words]
    average = sum(length) / len(length)
    score = dict.fromkeys(range(len(DOCS)), 0.0)
    for p in prefixes:
        f = [sum(wt * sum(x.startswith(p) for x in col) for wt, col in zip(weights, w, strict=True)) for w in words]
        n = sum(x > 0 for x in f)
        idf = math.log((len(DOCS) - n + 0.5) / (n + 0.5))
        idf = idf if idf > 0 else 1e-6
        for i, x in enumerate(f):
            if i in score and x:
                score[i] -= idf * x * 2.2 / (x + 1.2 * (0.25 + 0.75 * length[i] / average))
            elif not x:
                score.pop(i, None)
    return {DOCS[i][1]: s for i, s in score.items()}


@pytest.mark.parametrize("prefixes", [["nin"], ["nails"], ["ni", "us"], ["broken", "broken"], ["zz"]])
def test_bm25(spark, prefixes):
    got = {r.entity_mbid: r.score for r in bm25(build_index(docs(spark)), prefixes).collect()}
    assert got == pytest.approx(plain_bm25(prefixes))


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "index")
    assert not index_exists(spark, path)
    for _ in range(2):
        write_index(docs(spark), path)
    assert index_exists(spark, path)
    index, stored = read_index(spark, path)
    assert "StringStartsWith" in prefix_hits(index, ["nin", "us"])._jdf.queryExecution().executedPlan().toString()
    hits = search_fast(index, stored, "NIN*")
    assert {r.entity_mbid for r in hits.collect()} == {"a1", "a2", "e1", "t1"}
    assert [r.section for r in sections(hits).collect()] == [1, 1, 3, 5]
    assert search_fast(index, stored, " - ").count() == 0
    with pytest.raises(ValueError, match="blank"):
        search_fast(index, stored, " \t")


def test_fetch_limit_comes_before_the_cap(spark):
    rows = [("artist", f"a{i:03}", "x", "", "", "", -2.0) for i in range(60)] + [("track", "t", "x", "", "", "", -1.0)]
    got = top_hits(spark.createDataFrame(rows, SEARCH_DOCS + ", score double"), 3).collect()
    assert [(r.entity_mbid, r["rank"]) for r in got] == [("a000", 1), ("a001", 2), ("a002", 3)]


def test_credit_spacing(spark):
    rows = spark.createDataFrame([("e", "a", "A", "feat.", 1), ("e", "b", "B", "", 2)], TABLES["release_artists"].columns)
    assert credit_strings(rows, "release_mbid").first().credit == "Afeat.B"
    assert credit_strings(rows, "release_mbid", keep_spacing=True).first().credit == "A feat. B"


def tables(spark, artists, aliases):
    t = {name: spark.createDataFrame([], x.columns) for name, x in TABLES.items()}
    t["artists"] = spark.createDataFrame([(i, n, s, "", None, None, None, None, None, False, None, None) for i, n, s in artists], TABLES["artists"].columns)
    t["artist_aliases"] = spark.createDataFrame([(i, n, None, None, str(k), False) for k, (i, n) in enumerate(aliases)], TABLES["artist_aliases"].columns)
    return t


def three_stages(artists, aliases, query, limit):
    import re

    def like(x, pattern):
        rx = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
        return re.fullmatch(rx, x, re.IGNORECASE | re.ASCII | re.DOTALL) is not None

    out = []
    for stage, pattern in enumerate((query, query + "%", "%" + query + "%")):
        hits = [a for a in artists if (stage == 0 and a[0] == query) or like(a[1], pattern) or like(a[2], pattern) or any(i == a[0] and like(n, pattern) for i, n in aliases)]
        for a in sorted(hits, key=lambda a: (a[1], a[0]))[:limit]:
            if a[0] not in out and len(out) < limit:
                out.append(a[0])
    return out


def test_one_pass_equals_three_stages(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice(["a", "b", "A", "é", "É", "%", " "]) for _ in range(rnd.randint(1, 4)))
    for _ in range(6):
        artists = [(f"m{i}", word(), word()) for i in range(25)]
        aliases = [(f"m{rnd.randrange(25)}", word()) for _ in range(15)]
        t = tables(spark, artists, aliases)
        for query in ("a", "m3", "é", "a_", word()):
            got = [r.mbid for r in search_artists(t, query, 7).collect()]
            assert got == three_stages(artists, aliases, query, 7), query


def test_escaped_query_and_limits(spark):
    t = tables(spark, [("1", "100% x", ""), ("2", "100 x", ""), ("3", "x 100%", "")], [("2", "NIN")])
    assert [r.mbid for r in search_artists(t, "100%", escape=True).collect()] == ["1", "3"]
    assert [r.mbid for r in search_artists(t, "nin").collect()] == ["2"]
    assert {r.entity_type for r in search(t, "100").collect()} == {"artist"}
    with pytest.raises(ValueError, match="blank"):
        search(t, " ")
    rows = spark.range(20).select(F.lit(1).alias("tier"), "id")
    assert tiered_topn(rows, ["id"], 0).count() == 10
    assert spark.range(1).select(like_tier(F.lit("x"), "y")).first()[0] is None


def test_null_dates_come_last(spark):
    from cratedig.operators.tiered import search_release_groups

    t = {name: spark.createDataFrame([], x.columns) for name, x in TABLES.items()}
    t["release_groups"] = spark.createDataFrame([("1", "x", None, "", None), ("2", "x", None, "", "1990"), ("3", "x", None, "", "1990-05")], TABLES["release_groups"].columns)
    assert [r.mbid for r in search_release_groups(t, "x").collect()] == ["3", "2", "1"]


def test_search_reads_no_other_document_into_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "index")
    write_index(docs(spark), path)
    index, stored = read_index(spark, path)
    plan = search_fast(index, stored, "nails")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    # one exchange at most for the ranks of each type, besides the broadcast
    assert plan.count("Exchange hashpartitioning(entity_type") <= 1
    assert "Exchange hashpartitioning(entity_mbid" not in plan


def test_very_many_ties_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(fulltext, "BROADCAST_ROWS", 1)
    assert {r.entity_mbid for r in search_fast(build_index(docs(spark)), docs(spark), "ni").collect()} == {"a1", "a2", "e1", "t1"}


def test_track_search_joins_the_releases_of_hits_alone(spark):
    empty = {k: spark.createDataFrame([], TABLES[k].columns) for k in ("releases", "release_artists", "tracks")}
    # innermost the tracks meet their release's artists, then, filtered by tier, the releases, and last the credits
    assert tiered_joins(search_tracks(empty, "x"))[:3] == ["LeftOuter", "Inner", "LeftOuter"]


def tiered_joins(df):
    """The kinds of joins on tracks, outermost first."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    return [kind for line in lines for kind in ("LeftOuter", "Inner") if f"Join {kind}" in line and "release_mbid" in line and "artists" not in line]


def corpus(spark, n=4000):
    """Documents of one to a few hundred tokens; every second one has ``common``."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["ünit", "unite", "united", "units"]
    rows = []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(1, 10) ** 2) + ["common"] * (i % 2 * rnd.randint(1, 3))
        rnd.shuffle(text)
        rows.append((rnd.choice(["artist", "track"]), f"id{i}", " ".join(text[:3]), " ".join(rnd.choices(words, k=2)), "", " ".join(text[3:])))
    return spark.createDataFrame(rows, SEARCH_DOCS)


def test_postings_are_counted_in_the_row(spark):
    rows = corpus(spark, 300)
    got = postings(rows)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want, first = {}, {}
    for r in rows.collect():
        seen = sorted((w, c) for c in ("heading", "subtitle", "meta", "aux") for w in r[c].replace("ü", "u").split())
        before = None
        for w, c in sorted(set(seen), key=lambda x: (x[0], ["heading", "subtitle", "meta", "aux"].index(x[1]))):
            want[r.entity_mbid, c, w] = seen.count((w, c))
            if before != w:
                first[r.entity_mbid, c, w] = len(os.path.commonprefix([before or "", w]))
            before = w
    got = got.collect()
    assert {(r.entity_mbid, r.col, r.term): r.tf for r in got} == want
    assert {(r.entity_mbid, r.col, r.term): r.known for r in got if r.known is not None} == first
    assert len(got) == len(want)


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("large") / "index")
    before = fulltext.BUCKET_DOCS
    fulltext.BUCKET_DOCS = 200
    # so few rows become one file otherwise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    write_index(corpus(spark), path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    fulltext.BUCKET_DOCS = before
    return read_index(spark, path)


@pytest.mark.parametrize("prefixes", [["common"], ["unit"], ["common", "w1"], ["w", "uni", "com"], ["w7", "w7"], ["none"], ["common", "none"]])
@pytest.mark.parametrize("k,weights", [(1, (2.0, 1.0, 1.0, 1.0)), (50, (2.0, 1.0, 1.0, 1.0)), (7, (1.0, 9.0, 0.0, 1.0))])
def test_top_equals_scoring_all(spark, large, prefixes, k, weights):
    index, _ = large
    full = sorted((round(r.score, 9), r.entity_mbid) for r in bm25(index, prefixes, weights).collect())
    top = sorted((round(r.score, 9), r.entity_mbid) for r in top_scored(index, prefixes, k, weights).collect())
    want = [x for x in full if not full[k - 1 :] or x[0] <= full[k - 1][0]]
    assert [x for x in top if x in set(want)] == want
    assert set(top) <= set(full)


def test_top_reads_few_buckets(large):
    index, _ = large
    reach, weighed = bounds(index, ["common"])
    frequency = index.postings.where("term = 'common'").select("entity_mbid").distinct().count()
    assert reach.agg(F.sum("n")).first()[0] == frequency == 2000
    top = top_scored(index, ["common"], 10)
    assert top.count() < frequency / 3
    assert "GreaterThanOrEqual(bucket" in top._jdf.queryExecution().executedPlan().toString()


def test_a_common_term_is_in_several_files(spark, large, tmp_path):
    index, _ = large
    files = index.postings.where("term = 'common'").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) > 1
    most = index.postings.where("term = 'common'").groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert most <= 200


def test_documents_are_looked_up_by_key(spark, large):
    index, docs = large
    plan = search_fast(index, docs, "common w1")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|Or|In)\(.*entity_mbid", plan)
    assert [r.rank for r in search_fast(index, docs, "?!").collect()] == []


def test_as_many_keys_as_are_pushed(spark, large):
    """A search for 50 fetches 400 documents, all of which are looked up by key."""
    index, docs = large
    scored = bm25(index, ["common"]).orderBy("score", "entity_mbid").limit(fulltext.PUSHED_KEYS)
    assert fulltext.with_documents(scored, docs, fulltext.fetched(50)).count() == fulltext.PUSHED_KEYS
