"""Documents to the rows of the catalogue's tables.

Every function takes documents (``doc`` with ``source_rank`` and ``line_no``)
and returns the rows of one table with ORDER's columns, so that first wins can
be decided later. ``at`` holds the positions within the document.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratedig.functions.text import filled, null_if_empty, text
from cratedig.operators.merge import array_first_wins


def _at(docs: DataFrame) -> Column:
    return docs["at"] if "at" in docs.columns else F.array().cast("array<int>")


def _id(docs: DataFrame) -> Column:
    return text(docs["doc.id"])


def _flag(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _number(x: Column) -> Column:
    return F.coalesce(x, F.lit(0).cast("long"))


def _rows(docs: DataFrame, **columns: Column) -> DataFrame:
    return docs.select(*(c.alias(k) for k, c in columns.items()), "source_rank", "line_no", _at(docs).alias("at"))


def _exploded(docs: DataFrame, items: Column) -> DataFrame:
    """One row per item as ``x``, with its position added to ``at``."""
    out = docs.select("doc", "source_rank", "line_no", _at(docs).alias("_at"), F.posexplode(items).alias("_i", "x"))
    return out.withColumn("at", F.concat("_at", F.array("_i"))).drop("_at")


def _children(docs: DataFrame, items: Column, keep: Callable[[Column], Column], key: Callable[[Column], Column]) -> DataFrame:
    """Items that pass ``keep``, the first of each ``key`` within the document."""
    return _exploded(docs, array_first_wins(F.filter(items, keep), key))


# -- parts that several entities have ---------------------------------------------------------------------------------


def credits(docs: DataFrame, foreign: str) -> DataFrame:
    """Credited artists; positions count the credits that are skipped for lack of an artist too."""
    rows = _exploded(docs, F.col("doc.`artist-credit`")).where(text(F.col("x.artist.id")) != "")
    name = filled(text(F.col("x.name")), text(F.col("x.artist.name")))
    position = (F.col("_i") + 1).cast("long")
    return _rows(rows, **{foreign: _id(rows), "artist_mbid": text(F.col("x.artist.id")), "artist_name": name, "join_phrase": text(F.col("x.joinphrase")), "position": position})


def tags(docs: DataFrame, foreign: str) -> DataFrame:
    name = lambda x: text(x["name"])
    rows = _children(docs, F.col("doc.tags"), lambda x: name(x) != "", name)
    return _rows(rows, **{foreign: _id(rows), "tag": text(F.col("x.name")), "count": _number(F.col("x.count"))})


def links(docs: DataFrame, entity_type: str) -> DataFrame:
    kind, url = lambda x: text(x["type"]), lambda x: text(x["url"]["resource"])
    rows = _children(docs, F.col("doc.relations"), lambda x: (text(x["target-type"]) == "url") & (kind(x) != "") & (url(x) != ""), lambda x: F.struct(kind(x), url(x)))
    return _rows(rows, entity_type=F.lit(entity_type), entity_mbid=_id(rows), rel_type=text(F.col("x.type")), url=text(F.col("x.url.resource")))


def _strings(docs: DataFrame, items: Column, foreign: str, name: str) -> DataFrame:
    # of equal strings it keeps the first
    rows = _exploded(docs, F.array_distinct(F.filter(F.transform(items, text), lambda x: x != "")))
    return _rows(rows, **{foreign: _id(rows), name: F.col("x")})


# -- artists --------------------------------------------------------------------------------------------------------


def artists(docs: DataFrame) -> DataFrame:
    optional = lambda f: null_if_empty(text(F.col(f)))
    return _rows(
        docs,
        mbid=_id(docs),
        name=text(F.col("doc.name")),
        sort_name=text(F.col("doc.`sort-name`")),
        disambiguation=text(F.col("doc.disambiguation")),
        type=optional("doc.type"),
        country=optional("doc.country"),
        gender=optional("doc.gender"),
        begin_date=optional("doc.`life-span`.`begin`"),
        end_date=optional("doc.`life-span`.`end`"),
        ended=_flag(F.col("doc.`life-span`.ended")),
        area_mbid=optional("doc.area.id"),
        area_name=optional("doc.area.name"),
    )


def artist_aliases(docs: DataFrame) -> DataFrame:
    name, locale = lambda x: text(x["name"]), lambda x: text(x["locale"])
    rows = _children(docs, F.col("doc.aliases"), lambda x: name(x) != "", lambda x: F.struct(name(x), locale(x)))
    optional = lambda f: null_if_empty(text(F.col(f)))
    return _rows(rows, artist_mbid=_id(rows), name=text(F.col("x.name")), sort_name=optional("x.`sort-name`"), type=optional("x.type"), locale=text(F.col("x.locale")), is_primary=_flag(F.col("x.primary")))


def artist_genres(docs: DataFrame) -> DataFrame:
    rows = _children(docs, F.col("doc.genres"), lambda x: (text(x["id"]) != "") & (text(x["name"]) != ""), lambda x: text(x["id"]))
    return _rows(rows, artist_mbid=_id(rows), genre_mbid=text(F.col("x.id")), genre_name=text(F.col("x.name")), count=_number(F.col("x.count")))


# -- release groups -------------------------------------------------------------------------------------------------


def release_groups(docs: DataFrame) -> DataFrame:
    return _rows(
        docs,
        mbid=_id(docs),
        title=text(F.col("doc.title")),
        primary_type=null_if_empty(text(F.col("doc.`primary-type`"))),
        disambiguation=text(F.col("doc.disambiguation")),
        first_release_date=null_if_empty(text(F.col("doc.`first-release-date`"))),
    )


def secondary_types(docs: DataFrame) -> DataFrame:
    return _strings(docs, F.col("doc.`secondary-types`"), "release_group_mbid", "type")


# -- releases -------------------------------------------------------------------------------------------------------


def releases(docs: DataFrame) -> DataFrame:
    optional = {k: null_if_empty(text(F.col(f"doc.{k}"))) for k in ("status", "date", "country", "barcode", "packaging")}
    spoken = {k: null_if_empty(text(F.col(f"doc.`text-representation`.{k}"))) for k in ("language", "script")}
    return _rows(docs, mbid=_id(docs), title=text(F.col("doc.title")), **optional, **spoken, release_group_mbid=null_if_empty(text(F.col("doc.`release-group`.id"))))


def release_labels(docs: DataFrame) -> DataFrame:
    # trimmed once, in the array
    items = F.transform(F.col("doc.`label-info`"), lambda x: F.struct(text(x["label"]["id"]).alias("label"), text(x["label"]["name"]).alias("name"), text(x["catalog-number"]).alias("number")))
    rows = _children(docs, items, lambda x: (x["label"] != "") | (x["number"] != ""), lambda x: F.struct(x["label"], x["number"]))
    return _rows(rows, release_mbid=_id(rows), label_mbid=F.col("x.label"), label_name=F.col("x.name"), catalog_number=F.col("x.number"))


def _position(given: Column, index: Column) -> Column:
    return F.when(_number(given) > 0, given).otherwise((index + 1).cast("long"))


def release_media(docs: DataFrame) -> DataFrame:
    rows = _exploded(docs, F.col("doc.media"))
    tracks = F.coalesce(F.size("x.tracks"), F.lit(0))
    count = F.when(_number(F.col("x.`track-count`")) > 0, F.col("x.`track-count`")).otherwise(F.greatest(tracks, F.lit(0)).cast("long"))
    return _rows(rows, release_mbid=_id(rows), position=_position(F.col("x.position"), F.col("_i")), format=null_if_empty(text(F.col("x.format"))), track_count=count)


def _raw_tracks(docs: DataFrame) -> DataFrame:
    """Tracks ``t`` of all media that have an id and a recording with an id."""
    media = _exploded(docs, F.col("doc.media"))
    rows = media.select(_id(media).alias("release_mbid"), "source_rank", "line_no", F.col("at").alias("_at"), _position(F.col("x.position"), F.col("_i")).alias("media_position"), F.posexplode("x.tracks").alias("_j", "t"))
    return rows.withColumn("at", F.concat("_at", F.array("_j"))).where((text(F.col("t.id")) != "") & (text(F.col("t.recording.id")) != ""))


def tracks(docs: DataFrame) -> DataFrame:
    rows = _raw_tracks(docs)
    position = _position(F.col("t.position"), F.col("_j"))
    return _rows(
        rows,
        mbid=text(F.col("t.id")),
        release_mbid=F.col("release_mbid"),
        recording_mbid=text(F.col("t.recording.id")),
        media_position=F.col("media_position"),
        position=position,
        number=filled(text(F.col("t.number")), position.cast("string")),
        title=filled(text(F.col("t.title")), text(F.col("t.recording.title"))),
        length=F.col("t.length"),
    )


def embedded_recordings(docs: DataFrame) -> DataFrame:
    """The recordings within release documents, as documents; without a title they are left out, their tracks are not."""
    rows = _raw_tracks(docs).select(F.col("t.recording").alias("doc"), "source_rank", "line_no", "at")
    return rows.where(text(F.col("doc.title")) != "")


# -- recordings -----------------------------------------------------------------------------------------------------


def recordings(docs: DataFrame) -> DataFrame:
    return _rows(
        docs,
        mbid=_id(docs),
        title=text(F.col("doc.title")),
        length=F.col("doc.length"),
        disambiguation=text(F.col("doc.disambiguation")),
        video=_flag(F.col("doc.video")),
        first_release_date=null_if_empty(text(F.col("doc.`first-release-date`"))),
    )


def recording_isrcs(docs: DataFrame) -> DataFrame:
    return _strings(docs, F.col("doc.isrcs"), "recording_mbid", "isrc")


Docs = Mapping[str, DataFrame]


def _links_of_all(d: Docs) -> DataFrame:
    out = links(d["artist"], "artist").unionByName(links(d["release-group"], "release_group")).unionByName(links(d["release"], "release"))
    return out.unionByName(links(embedded_recordings(d["release"]), "recording")).unionByName(links(d["recording"], "recording"))


def _both(f: Callable[[DataFrame], DataFrame]) -> Callable[[Docs], DataFrame]:
    """Recordings within releases, then those of their own."""
    return lambda d: f(embedded_recordings(d["release"])).unionByName(f(d["recording"]))


#: By table, its rows from the documents of every entity. Recordings within releases give no tags.
FLATTEN: dict[str, Callable[[Docs], DataFrame]] = {
    "artists": lambda d: artists(d["artist"]),
    "artist_aliases": lambda d: artist_aliases(d["artist"]),
    "artist_tags": lambda d: tags(d["artist"], "artist_mbid"),
    "artist_genres": lambda d: artist_genres(d["artist"]),
    "release_groups": lambda d: release_groups(d["release-group"]),
    "release_group_secondary_types": lambda d: secondary_types(d["release-group"]),
    "release_group_artists": lambda d: credits(d["release-group"], "release_group_mbid"),
    "release_group_tags": lambda d: tags(d["release-group"], "release_group_mbid"),
    "releases": lambda d: releases(d["release"]),
    "release_artists": lambda d: credits(d["release"], "release_mbid"),
    "release_labels": lambda d: release_labels(d["release"]),
    "release_media": lambda d: release_media(d["release"]),
    "recordings": _both(recordings),
    "recording_artists": _both(lambda x: credits(x, "recording_mbid")),
    "recording_isrcs": _both(recording_isrcs),
    "recording_tags": lambda d: tags(d["recording"], "recording_mbid"),
    "tracks": lambda d: tracks(d["release"]),
    "external_links": _links_of_all,
}


def flatten_all(docs: Docs) -> dict[str, DataFrame]:
    return {name: f(docs) for name, f in FLATTEN.items()}
