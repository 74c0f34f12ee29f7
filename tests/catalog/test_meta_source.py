import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from cratedig.functions.text import fold, like_ascii_ci, tokens, unicode_trim
from cratedig.operators.meta import MetadataMismatch, merge_meta, parse_timestamp, read_meta, write_meta
from cratedig.plans import build
from cratedig.plans.build import build_from_dump, catalog_info, search
from cratedig.plans.landing import write_archive
from cratedig.sources.dump import UnknownEntity, entity_lines, latest_dump, metadata_members, read_archives, read_dump, select_entities
from tests.catalog.test_decode_flatten import ARTIST, GROUP, RECORDING, RELEASE

META = "place int, replication_sequence string, schema_sequence string, json_schema_number string, dump_timestamp string"


def test_select_entities():
    assert select_entities(" ") == ["artist", "release-group", "release", "recording"]
    assert select_entities("recording, artist,,recording") == ["artist", "recording"]
    for bad in ("label", ", ,"):
        with pytest.raises(UnknownEntity):
            select_entities(bad)


def test_merge_keeps_the_latest_timestamp(spark):
    rows = [(1, "5", "", "1", "2024-01-02 03:04:05.123456+00"), (2, "5", "30", "", "2024-01-02 04:04:05.123457+01"), (3, "", "", "", "")]
    got = merge_meta(spark.createDataFrame(rows, META), order="place").first()
    assert tuple(got) == ("5", "30", "1", "2024-01-02 04:04:05.123457+01")
    rows = [(1, "", "", "", "junk a"), (2, "", "", "", "junk b"), (3, "", "", "", "2024-01-01 00:00:00+00")]
    assert merge_meta(spark.createDataFrame(rows, META), order="place").first().dump_timestamp == "junk b"
    with pytest.raises(MetadataMismatch, match="replication_sequence"):
        merge_meta(spark.createDataFrame([(1, "5", "", "", ""), (2, "6", "", "", "")], META), order="place")


def test_timestamps(spark):
    texts = ["2024-01-02 03:04:05+00", "2024-01-02 03:04:05.5+00", "2024-01-02 03:04:05.123+05", "2024-01-02 03:04:05.123456789-07", "2024-01-02T03:04:05Z", ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_timestamp(F.col("t")).isNotNull()).collect()
    assert [r[0] for r in got][:1] + [r[0] for r in got][2:] == [True, True, True, False, False]


def test_meta_is_replaced(spark, tmp_path):
    path = str(tmp_path / "meta")
    meta = spark.createDataFrame([("5", "", "1", "t")], META.partition(", ")[2])
    for _ in range(2):
        write_meta(meta, path)
    got = {r.key: r.value for r in read_meta(spark, path).collect()}
    assert set(got) == {"replication_sequence", "json_schema_number", "dump_timestamp", "imported_at"}


def archive(path, entity, docs, **members):
    with tarfile.open(path, "w:xz") as tar:
        for name, text in {"TIMESTAMP": " 2024-01-01 00:00:00+00\n", **members, f"mbdump/{entity}": "".join(json.dumps(d) + "\n" for d in docs)}.items():
            data = text.encode()
            info = tarfile.TarInfo(f"./{name}")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def test_archives_to_search(spark, tmp_path):
    root = tmp_path / "dumps"
    (root / "2024").mkdir(parents=True)
    (root / "LATEST").write_text("2024\n")
    for entity, docs in {"artist": [ARTIST], "release-group": [GROUP], "release": [RELEASE], "recording": [RECORDING]}.items():
        archive(root / "2024" / f"{entity}.tar.xz", entity, docs, REPLICATION_SEQUENCE="7\n")
    paths = latest_dump(spark, str(root), ["artist"])
    dump = read_dump(spark, paths, 2)
    assert {(r.member, r.line_no) for r in dump.collect()} == {("TIMESTAMP", 0), ("REPLICATION_SEQUENCE", 0), ("mbdump/artist", 0)}
    catalog = build_from_dump(spark, str(root), str(tmp_path / "catalog"))
    info = {r.key: r.value for r in catalog_info(catalog).collect()}
    assert {k: info[k] for k in ("artists", "tracks", "search_index", "dump_dir", "replication_sequence")} == {"artists": "1", "tracks": "2", "search_index": "present", "dump_dir": "2024", "replication_sequence": "7"}
    assert "artist" in {r.entity_type for r in search(catalog, "nin").collect()}
    with pytest.raises(ValueError, match="blank"):
        search(catalog, "  ")
    (root / "LATEST").write_text(" \n")
    with pytest.raises(FileNotFoundError):
        latest_dump(spark, str(root), ["artist"])


def test_written_archives_are_read_back(spark, tmp_path):
    lines = ["{\"id\": 1}", "é", "", "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
    path = f"file:{tmp_path}/sub/artist.tar.xz"
    write_archive(df.repartition(3), path, {"TIMESTAMP": "2024-01-01 00:00:00+00\n"})
    got = read_dump(spark, [path], 2).where("member like 'mbdump/%'").orderBy("line_no").collect()
    assert [r.line for r in got] == lines


def test_a_broken_archive_fails_only_who_reads_it(spark, tmp_path):
    archive(tmp_path / "artist.tar.xz", "artist", [ARTIST, ARTIST], REPLICATION_SEQUENCE="7\n")
    whole = (tmp_path / "artist.tar.xz").read_bytes()
    (tmp_path / "release.tar.xz").write_bytes(whole[:100] + b"broken")
    paths = [f"{tmp_path}/artist.tar.xz", f"{tmp_path}/release.tar.xz"]
    artists = read_archives(spark, paths, ["artist"])
    assert entity_lines(artists, "artist", 0).count() == 2
    assert artists.where("member = 'TIMESTAMP'").unionByName(read_archives(spark, paths, ["artist", "label"], ["mbdump/artist"])).count() == 3
    assert read_archives(spark, paths, ["label"]).count() == read_archives(spark, paths, members=["other"]).count() == 0
    with pytest.raises(Exception, match="release"):
        read_archives(spark, paths).count()


def test_metadata_needs_no_more_than_the_head(spark, tmp_path):
    rnd = random.Random(1)
    lines = [{"id": "".join(rnd.choices("abcdef0123456789", k=200))} for _ in range(20_000)]
    archive(tmp_path / "artist.tar.xz", "artist", lines, REPLICATION_SEQUENCE="7\n")
    path = tmp_path / "artist.tar.xz"
    path.write_bytes(path.read_bytes()[: path.stat().st_size * 2 // 3])  # the documents are cut off
    heads = read_archives(spark, [str(path)], heads=True)
    assert {r.member for r in metadata_members(heads).collect()} == {"TIMESTAMP", "REPLICATION_SEQUENCE"}
    both = read_archives(spark, [str(path)], members=["TIMESTAMP", "REPLICATION_SEQUENCE"])
    assert both.count() == 2  # all that is asked for has been found before
    with pytest.raises(Exception):
        read_archives(spark, [str(path)], members=["mbdump/artist"]).count()


def test_a_build_opens_each_archive_once(spark, tmp_path, monkeypatch):
    root = tmp_path / "dumps"
    (root / "2024").mkdir(parents=True)
    (root / "LATEST").write_text("2024\n")
    for entity, docs in {"artist": [ARTIST], "release-group": [GROUP], "release": [RELEASE], "recording": [RECORDING]}.items():
        archive(root / "2024" / f"{entity}.tar.xz", entity, docs, REPLICATION_SEQUENCE="7\n")
    staged = build.stage_dump

    def once(*args):
        out = staged(*args)
        for path in (root / "2024").iterdir():
            path.unlink()
        return out

    monkeypatch.setattr(build, "stage_dump", once)
    catalog = build_from_dump(spark, str(root), str(tmp_path / "catalog"), search_index=False)
    assert catalog["tracks"].count() == 2
    assert catalog.parsed == {e: {"lines": 1, "quarantined": 0} for e in ("artist", "release-group", "release", "recording")}
    assert not list(tmp_path.glob("catalog.lines-*"))


def test_bytes_that_are_no_utf8(spark, tmp_path):
    data = b'{"a": "\xff"}\n'
    with tarfile.open(tmp_path / "artist.tar.xz", "w:xz") as tar:
        info = tarfile.TarInfo("mbdump/artist")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    assert read_dump(spark, [f"{tmp_path}/artist.tar.xz"], 1).first().line == '{"a": "\ufffd"}'


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(unicode_trim(F.lit("　  x y\u0085\t"))) == "x y"
    assert one(fold(F.lit("ÉñÅ ſςϐ øßæ Άκα"))) == "ena sσβ øßæ άκα"
    assert one(tokens(F.lit("Don't résumé 中文 x_1"))) == ["don", "t", "resume", "中文", "x", "1"]
    for text, pattern, want in (("ABC", "abc", True), ("É", "é", False), ("a%b", "A%B", True), ("axxb", "a_b", False), ("a\\b", "A\\b", True)):
        assert one(like_ascii_ci(F.lit(text), pattern)) is want
