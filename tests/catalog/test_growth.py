"""Steps whose work grew faster than their input, or was done several times."""

import io
import lzma
import os
import re
import tarfile
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cratedig.functions.text import BLANKS, tokens, unicode_trim
from cratedig.operators import search_docs, store, tiered
from cratedig.operators.fulltext import postings, write_index
from cratedig.operators.merge import array_first_wins
from cratedig.plans import binding, catalog_queries
from cratedig.plans.build import stage_documents
from cratedig.plans.landing import write_archive
from cratedig.schemas import INDEXED, SEARCH_DOCS, TABLES
from cratedig.sources.dump import read_archives, stage_dump

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_an_archive_of_several_streams_is_read_whole(spark, tmp_path):
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as tar:
        data = b"".join(b'{"id": "%d"}\n' % i for i in range(2000))
        info = tarfile.TarInfo("mbdump/artist")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    whole = plain.getvalue()
    (tmp_path / "artist.tar.xz").write_bytes(lzma.compress(whole[:700]) + lzma.compress(whole[700:9000]) + lzma.compress(whole[9000:]))
    assert read_archives(spark, [str(tmp_path / "artist.tar.xz")]).select("line_no").distinct().count() == 2000


def test_an_archive_is_packed_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/artist.tar.xz"
    lines = spark.range(0, 100_000, 1, 4).select(F.concat(F.lit("line é "), F.sha2(F.col("id").cast("string"), 512)).alias("line"), F.col("id").alias("line_no"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_archive(lines.orderBy(F.desc("line_no")), path, {"TIMESTAMP": "now\n", "REPLICATION_SEQUENCE": "7"})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    packed = open(path, "rb").read()
    # the head, the end and more than one range of lines
    assert packed.count(b"\xfd7zXZ\x00") > 3
    with tarfile.open(fileobj=io.BytesIO(lzma.decompress(packed))) as tar:
        assert [(m.name, m.isfile()) for m in tar] == [("TIMESTAMP", True), ("REPLICATION_SEQUENCE", True), ("mbdump/artist", True)]
        assert tar.extractfile("TIMESTAMP").read() == b"now\n"
        assert tar.extractfile("mbdump/artist").read().decode().splitlines() == [r.line for r in lines.orderBy("line_no").collect()]
    assert os.listdir(tmp_path) == ["artist.tar.xz"]


def test_an_archive_without_lines(spark, tmp_path):
    path = f"{tmp_path}/artist.tar.xz"
    write_archive(spark.createDataFrame([], "line string, line_no long"), path, {"TIMESTAMP": ""})
    assert read_archives(spark, [path]).where("member = 'mbdump/artist'").count() == 0
    assert read_archives(spark, [path]).where("member = 'TIMESTAMP'").count() == 1


@needs_tables
def test_archives_are_landed_when_they_are_asked_for(spark, tmp_path):
    for t in os.listdir(SF):
        os.symlink(f"{SF}/{t}", tmp_path / t)
    root = catalog_queries._landed(spark, str(tmp_path), ["recording"])
    assert os.listdir(f"{root}/20240201-000000") == ["recording.tar.xz"]


@needs_tables
@pytest.mark.parametrize("name", ["releases", "release_artists", "release_group_artists"])
def test_documents_are_made_of_the_fields_that_a_table_needs(spark, name):
    (entity, fields), = binding.WANTED[name].items()
    assert "lineitem" not in binding.LINES[entity](spark, SF, frozenset(fields))._jdf.queryExecution().optimizedPlan().toString()


@needs_tables
def test_fields_of_documents_stay_as_they_are(spark):
    whole = {r.line_no: r.line for r in binding.release_lines(spark, SF).collect()}
    wanted = frozenset(f for fields in binding.WANTED.values() for f in fields.get("release", ()))
    import json

    for r in binding.release_lines(spark, SF, wanted).collect():
        some, every = json.loads(r.line), json.loads(whole[r.line_no])
        assert {k: v for k, v in every.items() if k != "media"} == {k: v for k, v in some.items() if k != "media"}
        for a, b in zip(some.get("media", []), every.get("media", []), strict=True):
            assert len(a["tracks"]) == len(b["tracks"])
            for x, y in zip(a["tracks"], b["tracks"], strict=True):
                y["recording"].pop("tags")
                assert x == y


@needs_tables
def test_repeated_suppliers_are_one_alias_of_a_document(spark, tmp_path):
    for t in os.listdir(SF):
        if t != "supplier.parquet":
            os.symlink(f"{SF}/{t}", tmp_path / t)
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet")
    n = suppliers.agg(F.max("s_suppkey")).first()[0] // 10 * 10 + 10
    copies = suppliers.crossJoin(spark.range(20).withColumnRenamed("id", "i")).withColumn("s_suppkey", F.col("s_suppkey") + F.col("i") * n).drop("i")
    copies.write.parquet(f"{tmp_path}/supplier.parquet")
    size = lambda d: binding.artist_lines(spark, d, frozenset(["aliases"])).agg(F.sum(F.length("line"))).first()[0]
    assert size(str(tmp_path)) < 1.2 * size(SF)


def test_documents_are_made_once_for_an_index(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def heading(i):
        made.add(1)
        return f"common w{i}"

    rows = spark.range(0, 300, 1, 3).select(F.lit("artist").alias("entity_type"), F.concat(F.lit("a"), "id").alias("entity_mbid"), F.udf(heading)("id").alias("heading"), *(F.lit("").alias(c) for c in ("subtitle", "meta", "aux")))
    write_index(rows.select(*(x.split()[0] for x in SEARCH_DOCS.split(", "))), f"{tmp_path}/index")
    assert made.value == 300


def test_ascii_tokens_and_blanks(spark):
    texts = ["", "Ab-9 c_D", "A" * 50 + "\t1\n", "".join(map(chr, range(128))), "Ĳ é x ǆ Ⅷ", "K"]
    rows = spark.createDataFrame([(x,) for x in texts], "x string")
    # a blank that is no ASCII takes the other way
    other = tokens(F.concat(F.col("x"), F.lit("　")))
    assert rows.where(~tokens(F.col("x")).eqNullSafe(other)).count() == 0
    assert tokens(F.lit(None).cast("string")) is not None and spark.range(1).select(tokens(F.lit(None).cast("string")).alias("t")).first().t is None
    dirty = spark.createDataFrame([(f"{chr(i)}{chr(i)}a{chr(i)}b{chr(i)}",) for i in range(1, 0x3100)], "x string")
    plain = F.regexp_replace("x", r"(?U)^\s+|\s+$", "")
    assert dirty.where(unicode_trim(F.col("x")) != plain).count() == 0
    assert len(BLANKS) == len(re.findall(r"\s", BLANKS)) == 25


@needs_tables
@pytest.mark.parametrize("entity", ["release", "release-group"])
def test_documents_are_made_by_the_tasks_of_orders(spark, entity):
    # with orders or customers broadcast, the one task that reads nations makes all documents
    plan = binding.LINES[entity](spark, SF, frozenset())._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" not in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_tables_are_stored_at_the_same_time(spark, tmp_path):
    # each waits for the other
    barrier = threading.Barrier(2, timeout=60)

    class Waits:
        sparkSession = spark

        def __init__(self, rows):
            self.write = self
            self.rows = rows

        def parquet(self, path):
            barrier.wait()
            self.rows.write.parquet(path)

    store.write_catalog({t: Waits(spark.range(3).toDF("n")) for t in ("artist_aliases", "artist_genres")}, f"{tmp_path}/catalog")


def test_a_table_that_fails_leaves_nothing(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("mbid"))
    good = spark.range(3).select(F.col("id").cast("string").alias("artist_mbid"))
    with pytest.raises(Exception, match="no"):
        store.write_catalog({"artist_genres": good, "artists": bad, "artist_aliases": good}, f"{tmp_path}/catalog")
    assert not [x for x in os.listdir(tmp_path / "catalog") if x.startswith(("v-", "CURRENT"))]


@needs_tables
def test_lines_of_an_order_are_grouped_once(spark):
    # a window, groups of sides and groups of these sorted them several times, and orders were joined twice
    plan = binding.release_lines(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1
    assert plan.count("Relation [o_orderkey") == 1


@needs_tables
def test_counts_need_the_fields_of_keys_alone(spark, tmp_path):
    for t in os.listdir(SF):
        os.symlink(f"{SF}/{t}", tmp_path / t)
    counts = catalog_queries.QUERIES["catalog_counts"](spark, str(tmp_path))
    assert "Window" not in counts._jdf.queryExecution().optimizedPlan().toString()
    first = catalog_queries.documents(spark, str(tmp_path), "release", frozenset(binding.KEYED["tracks"]["release"])).where("size(doc.media) > 0").select("doc.media.tracks").first()[0][0][0]
    assert first["id"] and first["recording"]["id"] and first["length"] is None and first["recording"]["length"] is None
    tables = catalog_queries.Tables(spark, SF, store.NEEDED)
    assert {r.table_name: r.n for r in counts.collect()} == {t: tables[t].count() for t in store.NEEDED}


@needs_tables
@pytest.mark.parametrize("name", ["release_labels", "recording_isrcs", "artist_genres"])
def test_rows_that_can_not_differ_or_meet_are_not_ranked(spark, name):
    # every row was shuffled and sorted whole, though no two documents have one id, or a row is its key
    plan = catalog_queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


@needs_tables
def test_rows_of_documents_with_one_id_are_ranked(spark, tmp_path):
    for t in os.listdir(SF):
        if t != "orders.parquet":
            os.symlink(f"{SF}/{t}", tmp_path / t)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.unionByName(orders.where("o_orderkey % 3 = 0")).write.parquet(f"{tmp_path}/orders.parquet")
    got, want = (catalog_queries.QUERIES["release_labels"](spark, d) for d in (str(tmp_path), SF))
    assert "Window" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_items_with_repeated_keys_few_and_many(spark):
    lists = [[], ["a"], ["b", "a"], ["a", "a"], ["b", "a", "B", "c", "A"], [*map(str, range(40))], [*map(str, range(20)), *map(str, range(20))], None]
    df = spark.createDataFrame([(x,) for x in lists], "x array<string>")
    got = [r.x for r in df.select(array_first_wins(F.col("x"), lambda v: F.struct(F.lower(v))).alias("x")).collect()]
    assert got == [None if x is None else list({v.lower(): v for v in reversed(x)}[k] for k in dict.fromkeys(v.lower() for v in x)) for x in lists]


def _with_own_names(spark, tmp_path, times):
    """Suppliers ``times`` over with shifted keys and names of their own: aliases are customers times suppliers."""
    for t in os.listdir(SF):
        if t != "supplier.parquet":
            os.symlink(f"{SF}/{t}", tmp_path / t)
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet")
    n = suppliers.agg(F.max("s_suppkey")).first()[0] // 10 * 10 + 10
    copies = suppliers.crossJoin(spark.range(times).withColumnRenamed("id", "i")).withColumn("s_suppkey", F.col("s_suppkey") + F.col("i") * n)
    copies.withColumn("s_name", F.concat("s_name", F.lit("-"), "i")).drop("i").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


@needs_tables
def test_shared_aliases_are_decoded_once(spark, tmp_path):
    # each customer's document held all suppliers of its nation and slot, in JSON, Parquet and a row for each
    sf = _with_own_names(spark, tmp_path, 40)
    tables = catalog_queries.Stored(spark, sf, ("artists", "artist_aliases"))
    found = tables.shared("artist_aliases")
    customers, suppliers = (spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("customer", "supplier"))
    assert found.rows.count() <= suppliers and found.members.count() == customers
    assert catalog_queries.documents(spark, sf, "artist", frozenset(binding.WANTED["artist_aliases"]["artist"])).where("doc.aliases is not null").isEmpty()
    # the rows are those of documents that hold their lists
    whole = catalog_queries.FLATTEN["artist_aliases"]({"artist": catalog_queries.documents(spark, sf, "artist", frozenset(["aliases"]))}).select(*TABLES["artist_aliases"].names)
    rows = catalog_queries.QUERIES["artist_aliases"](spark, sf)
    assert rows.count() == whole.count() > customers
    assert rows.exceptAll(whole).isEmpty()
    plain = {"artists": tables["artists"], "artist_aliases": whole}
    assert search_docs.artist_docs(tables).exceptAll(search_docs.artist_docs(plain)).isEmpty()
    for query in ("supplier#00000000_-1", "Customer#000000001"):
        assert tiered.search_artists(tables, query, 25).collect() == tiered.search_artists(plain, query, 25).collect()


@needs_tables
def test_aliases_of_documents_with_one_id_are_ranked(spark, tmp_path):
    for t in os.listdir(SF):
        if t != "customer.parquet":
            os.symlink(f"{SF}/{t}", tmp_path / t)
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    customers.unionByName(customers).write.parquet(f"{tmp_path}/customer.parquet")
    got, want = (catalog_queries.QUERIES["artist_aliases"](spark, d) for d in (str(tmp_path), SF))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_postings_are_counted_in_batches(spark):
    # lambdas of Spark took some 24 us a posting, most of it for the shared characters of two terms
    rows = [("artist", "a", None, "", "x" * 5000 + " " + "x" * 5001 + " xx", "Ünï ünÏ Straße ſ"), ("x", None, "a a-a_A b", "A", "aB", "é éá ea"), ("y", "z", "日本語 日本", "𝔘𝔫 𝔘", "x 1²", "İi"), ("y", "none", "", " - ", None, "\0")]
    docs = spark.createDataFrame(rows, SEARCH_DOCS)
    listed = postings(docs)
    assert "MapInArrow" in listed._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(((r.entity_type, r.term, r.col, r.tf, r.len, r.known) for r in listed.collect()), key=lambda x: x[:2] + (INDEXED.index(x[2]),))
    want = []
    for kind, _, *texts in rows:
        split = spark.createDataFrame([(i, x or "") for i, x in enumerate(texts)], "i int, x string").select("i", F.explode(tokens(F.col("x"))).alias("t")).collect()
        before = None
        for t, i in sorted({(r.t, r.i) for r in split}):
            want.append((kind, t, INDEXED[i], [*split].count((i, t)), len(split), len(os.path.commonprefix([before or "", t])) if t != before else None))
            before = t
    assert got == want


@needs_tables
def test_archives_that_are_counted_hold_no_lists(spark, tmp_path):
    # lists of aliases are customers times suppliers, and neither heads nor counts of lines need them
    for t in os.listdir(SF):
        os.symlink(f"{SF}/{t}", tmp_path / t)
    counted = {(r.entity, r.n_lines) for r in catalog_queries.QUERIES["dump_choice"](spark, str(tmp_path)).collect()}
    assert counted == {(e, spark.read.parquet(f"{SF}/{t}.parquet").count()) for e, t in (("artist", "customer"), ("recording", "part"))}
    root = catalog_queries._landed(spark, str(tmp_path), ["artist", "recording"], frozenset())
    lines = read_archives(spark, [f"{root}/20240201-000000/artist.tar.xz"]).where("member = 'mbdump/artist'")
    assert lines.where("line like '%aliases%' or line like '%genres%'").isEmpty()
    assert sorted(map(tuple, catalog_queries.QUERIES["archive_heads"](spark, str(tmp_path)).select("entity").collect())) == [("artist",), ("recording",)]
    # whole archives stay whole
    whole = catalog_queries._landed(spark, str(tmp_path), ["recording"])
    assert whole != root and not read_archives(spark, [f"{whole}/20240201-000000/recording.tar.xz"]).where("line like '%isrcs%'").isEmpty()


def test_lines_of_sound_documents_are_not_stored_again(spark, tmp_path):
    lines = spark.createDataFrame([('{"id": "a", "title": "A"}', 3, 0), ('{"id": "b"}', 3, 1), ('{"id', 3, 2)], "line string, source_rank int, line_no long")
    docs, bad, counts = stage_documents(lines, "recording", f"{tmp_path}/staged", strict=False)
    assert [r.doc.title for r in docs.collect()] == ["A"] and counts == {"lines": 3, "quarantined": 2}
    assert {(r.problem, r.line) for r in bad.collect()} == {("missing title", '{"id": "b"}'), ("malformed", '{"id')}
    assert spark.read.parquet(f"{tmp_path}/staged").where("problem is null and line is not null").isEmpty()


def test_stored_lines_of_an_archive_are_read_by_several_tasks(spark, tmp_path):
    # one row group held all lines of an archive of some hundred MB, and one task decoded them all
    path = f"{tmp_path}/artist.tar.xz"
    long = F.concat(*(F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(8)))
    write_archive(spark.range(0, 50_000, 1, 4).select(long.alias("line"), F.col("id").alias("line_no")), path, {})
    stored = stage_dump(spark, [path], f"{tmp_path}/lines")
    (file,) = [x for x in os.listdir(tmp_path / "lines") if x.endswith(".parquet")]
    assert pq.ParquetFile(tmp_path / "lines" / file).num_row_groups >= 3
    assert stored.count() == 50_000
