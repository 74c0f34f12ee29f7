import os
import json
import time

import pytest
from pyspark.sql import functions as F

from cratedig.operators.decode import MalformedDocuments, decode
from cratedig.operators.flatten import FLATTEN, flatten_all
from cratedig.operators import store
from cratedig.operators.merge import RepeatedKey, array_first_wins, first_wins, strict_key
from cratedig.operators.store import Catalog, MissingTable, catalog_check, resolve, write_catalog
from cratedig.schemas import TABLES

URL = {"type": "stream", "target-type": "url", "url": {"resource": "https://a.example/1"}}
ARTIST = {"id": "a1", "name": " Nine\t", "sort-name": "Nine", "type": "Group", "country": " ", "life-span": {"ended": True}, "aliases": [{"name": "NIN", "locale": "en", "primary": True}, {"name": "NIN ", "locale": "en"}, {"name": "NIN", "locale": "de"}, {"name": " "}]}
ARTIST |= {"tags": [{"name": "rock", "count": 3}, {"name": " rock", "count": 9}, {"name": "", "count": 1}], "genres": [{"id": "g", "name": ""}, {"id": "g", "name": "Industrial"}, {"id": "g", "name": "Other"}]}
RECORDING = {"id": "r1", "title": "Song", "length": 100, "isrcs": ["X", "X ", ""], "tags": [{"name": "lost", "count": 1}], "relations": [URL, URL], "artist-credit": [{"name": "", "joinphrase": " & ", "artist": {"id": "a1", "name": "Nine"}}]}
RELEASE = {
    "id": "e1",
    "title": "Album",
    "date": "1994",
    "barcode": "",
    "release-group": {"id": "g1"},
    "artist-credit": [{"name": "N", "joinphrase": "", "artist": {"id": "a1"}}, {"name": "gap"}, {"name": "", "joinphrase": "", "artist": {"id": "a2", "name": "Two"}}],
    "label-info": [{"label": {"name": "only a name"}}, {"catalog-number": "1", "label": {"id": "l", "name": "L"}}, {"catalog-number": "1", "label": {"id": "l", "name": "M"}}],
    "media": [{"format": "CD", "position": 0, "tracks": [{"id": "t1", "recording": RECORDING}, {"id": "", "recording": RECORDING}, {"id": "t2", "position": 7, "title": "Own", "recording": {"id": "r2"}}]}],
    "relations": [URL | {"target-type": "work"}, URL, URL | {"type": " "}],
}
GROUP = {"id": "g1", "title": "Album", "secondary-types": ["Live", " Live", ""], "first-release-date": ""}


def lines(spark, *docs, rank=0):
    rows = [(d if isinstance(d, str) else json.dumps(d), rank, n) for n, d in enumerate(docs)]
    return spark.createDataFrame(rows, "line string, source_rank int, line_no long")


def docs(spark, artist=(ARTIST,), group=(GROUP,), release=(RELEASE,), recording=()):
    given = {"artist": artist, "release-group": group, "release": release, "recording": recording}
    return {e: decode(lines(spark, *d, rank=i), e)[0] for i, (e, d) in enumerate(given.items())}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_full_release(spark):
    t = resolve({k: v for k, v in flatten_all(docs(spark)).items()})
    assert set(t) == set(TABLES)
    assert rows(t["releases"]) == [("e1", "Album", None, "1994", None, None, None, None, None, "g1")]
    assert rows(t["release_artists"]) == [("e1", "a1", "N", "", 1), ("e1", "a2", "Two", "", 3)]
    assert rows(t["release_labels"]) == [("e1", "l", "L", "1")]
    assert rows(t["release_media"]) == [("e1", 1, "CD", 3)]
    assert rows(t["tracks"]) == [("t1", "e1", "r1", 1, 1, "1", "Song", None), ("t2", "e1", "r2", 1, 7, "7", "Own", None)]
    assert rows(t["recordings"]) == [("r1", "Song", 100, "", False, None)]
    assert rows(t["recording_artists"]) == [("r1", "a1", "Nine", "&", 1)]
    assert rows(t["recording_isrcs"]) == [("r1", "X")]
    assert rows(t["recording_tags"]) == []
    assert rows(t["external_links"]) == [("recording", "r1", "stream", "https://a.example/1"), ("release", "e1", "stream", "https://a.example/1")]
    assert rows(t["artists"]) == [("a1", "Nine", "Nine", "", "Group", None, None, None, None, True, None, None)]
    assert rows(t["artist_aliases"]) == [("a1", "NIN", None, None, "de", False), ("a1", "NIN", None, None, "en", True)]
    assert rows(t["artist_tags"]) == [("a1", "rock", 3)]
    assert rows(t["artist_genres"]) == [("a1", "g", "Industrial", 0)]
    assert rows(t["release_group_secondary_types"]) == [("g1", "Live")]
    assert rows(t["release_groups"]) == [("g1", "Album", None, "", None)]


def test_embedded_recording_wins_and_children_are_united(spark):
    own = RECORDING | {"title": "Later", "length": 5, "isrcs": ["Y"], "artist-credit": [{"name": "Z", "joinphrase": "", "artist": {"id": "z"}}, {"name": "Q", "joinphrase": "", "artist": {"id": "q"}}]}
    d = docs(spark, recording=(own,))
    t = resolve({k: FLATTEN[k](d) for k in ("recordings", "recording_artists", "recording_isrcs", "recording_tags")})
    assert rows(t["recordings"]) == [("r1", "Song", 100, "", False, None)]
    assert rows(t["recording_artists"]) == [("r1", "a1", "Nine", "&", 1), ("r1", "q", "Q", "", 2)]
    assert rows(t["recording_isrcs"]) == [("r1", "X"), ("r1", "Y")]
    assert rows(t["recording_tags"]) == [("r1", "lost", 1)]


def test_quarantine_and_strict(spark):
    bad = ["{", json.dumps([1]), "null", json.dumps({"id": "x", "name": " ", "sort-name": "y"}), "  ", "\t" + json.dumps(ARTIST) + " \r"]
    good, quarantine = decode(lines(spark, *bad), "artist", strict=False)
    assert good.count() == 1
    assert sorted(r.problem for r in quarantine.collect()) == ["malformed"] * 3 + ["missing name"] or sorted(r.problem for r in quarantine.collect())[-1].startswith("missing")
    with pytest.raises(MalformedDocuments):
        decode(lines(spark, *bad), "artist")


def test_repeated_strict_key_is_an_error(spark):
    d = docs(spark, release=(RELEASE, RELEASE))
    with pytest.raises(RepeatedKey, match="e1"):
        resolve({"releases": FLATTEN["releases"](d)})
    with pytest.raises(RepeatedKey):
        strict_key(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_first_wins_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS line_no", "0 AS source_rank", "array(1) AS at")
    kept = first_wins(df, ["k"])
    assert sorted((r.k, r.line_no) for r in kept.collect()) == [(k, k) for k in range(7)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_all_tables_or_none(spark, tmp_path):
    path = str(tmp_path / "catalog")
    t = resolve(flatten_all(docs(spark)))
    first = write_catalog(t, path)
    assert catalog_check(first)["artists"].count() == 1
    broken = dict(t) | {"tracks": t["tracks"].selectExpr("*", "raise_error('stop') AS x")}
    with pytest.raises(Exception, match="stop"):
        write_catalog(broken, path)
    assert Catalog(spark, path)["tracks"].count() == 2
    with pytest.raises(MissingTable, match="artists"):
        catalog_check(Catalog(spark, str(tmp_path / "none")))
    many = spark.range(3000).selectExpr("concat('a', id) AS mbid", "'n' AS name", "'s' AS sort_name")
    for f in TABLES["artists"].names[3:]:
        many = many.selectExpr("*", f"CAST(NULL AS {'boolean' if f == 'ended' else 'string'}) AS {f}")
    assert write_catalog({"artists": many}, str(tmp_path / "many"))["artists"].count() == 3000


def test_first_of_an_array_wins_in_linear_time(spark):
    rows = [(["b", "a ", "b", None, "a", "c", None],), ([],), (None,)]
    df = spark.createDataFrame(rows, "x array<string>").select(array_first_wins(F.col("x"), lambda v: F.trim(v)).alias("x"))
    assert [r.x for r in df.collect()] == [["b", "a ", None, "c"], [], None]
    many = spark.range(20, numPartitions=1).select(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda i: F.struct((i % 2500).alias("k"), i.alias("v"))).alias("x"))
    out = many.select(F.size(array_first_wins(F.col("x"), lambda v: F.struct(F.trim(v["k"].cast("string"))))).alias("n"))
    out.collect()
    began = time.perf_counter()
    assert {r.n for r in out.collect()} == {2500}
    assert time.perf_counter() - began < 5


def test_a_failed_publish_leaves_the_old_catalogue(spark, tmp_path, monkeypatch):
    path, t = str(tmp_path / "catalog"), resolve(flatten_all(docs(spark)))
    write_catalog(t, path)

    def fails(*_):
        raise OSError("no pointer today")

    plain = store.point
    monkeypatch.setattr(store, "point", fails)
    with pytest.raises(OSError, match="pointer"):
        write_catalog({"artists": t["artists"].limit(0)}, path)
    monkeypatch.setattr(store, "point", plain)
    assert Catalog(spark, path)["artists"].count() == 1
    assert len([x for x in (tmp_path / "catalog").iterdir() if x.name.startswith("v-")]) == 1


def test_readers_stay_with_their_version(spark, tmp_path):
    path, t = str(tmp_path / "catalog"), resolve(flatten_all(docs(spark)))
    first = write_catalog(t, path)
    second = write_catalog({"artists": t["artists"].limit(0)}, path)
    assert (first["artists"].count(), second["artists"].count(), Catalog(spark, path)["artists"].count()) == (1, 0, 0)
    (tmp_path / "catalog" / "CURRENT-000000000003").write_text("v-half")  # not whole yet
    assert Catalog(spark, path).path == second.path
    (tmp_path / "catalog" / "CURRENT-000000000003").unlink()
    third = write_catalog(t, path)
    assert second["artists"].count() == 0
    assert not os.path.exists(first.path)
    assert sorted(x.name for x in (tmp_path / "catalog").iterdir() if not x.name.startswith((".", "v-"))) == ["CURRENT-000000000002", "CURRENT-000000000003"]
    assert Catalog(spark, path).path == third.path


def test_two_that_publish_at_once(spark, tmp_path):
    path, t = str(tmp_path / "catalog"), resolve(flatten_all(docs(spark)))

    def write(folder):
        t["artists"].write.parquet(f"{folder}/artists")
        write_catalog(t, path)  # another one is done meanwhile

    with pytest.raises(Exception, match="exist"):
        store.publish(spark, path, write)
    assert Catalog(spark, path).has("tracks")

