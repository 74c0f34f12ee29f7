"""Schemas of the documents and of the catalogue's tables; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

TAG = "struct<name:string,count:bigint>"
RELATION = "struct<type:string,`target-type`:string,url:struct<resource:string>>"
ALIAS = "struct<name:string,`sort-name`:string,type:string,locale:string,primary:boolean>"
CREDIT = "struct<name:string,joinphrase:string,artist:struct<id:string,name:string,`sort-name`:string>>"
_RECORDING_FIELDS = {
    "id": "string",
    "title": "string",
    "disambiguation": "string",
    "`first-release-date`": "string",
    "length": "bigint",
    "video": "boolean",
    "`artist-credit`": f"array<{CREDIT}>",
    "isrcs": "array<string>",
    "tags": f"array<{TAG}>",
    "relations": f"array<{RELATION}>",
}
RECORDING = ", ".join(f"{k} {v}" for k, v in _RECORDING_FIELDS.items())
_EMBEDDED = ",".join(f"{k}:{v}" for k, v in _RECORDING_FIELDS.items())
TRACK = f"struct<id:string,number:string,title:string,length:bigint,position:bigint,recording:struct<{_EMBEDDED}>>"

#: One document is one JSON object on a line.
DOCUMENTS: dict[str, str] = {
    "artist": (
        "id string, name string, `sort-name` string, disambiguation string, type string, country string, gender string, "
        "area struct<id:string,name:string>, `life-span` struct<`begin`:string,`end`:string,ended:boolean>, "
        f"aliases array<{ALIAS}>, tags array<{TAG}>, genres array<struct<id:string,name:string,count:bigint>>, relations array<{RELATION}>"
    ),
    "release-group": (
        "id string, title string, `primary-type` string, disambiguation string, `first-release-date` string, "
        f"`secondary-types` array<string>, `artist-credit` array<{CREDIT}>, tags array<{TAG}>, relations array<{RELATION}>"
    ),
    "release": (
        "id string, title string, status string, date string, country string, barcode string, packaging string, "
        f"`release-group` struct<id:string,title:string>, `artist-credit` array<{CREDIT}>, "
        "`label-info` array<struct<`catalog-number`:string,label:struct<id:string,name:string>>>, "
        "`text-representation` struct<language:string,script:string>, "
        f"media array<struct<format:string,position:bigint,`track-count`:bigint,tracks:array<{TRACK}>>>, relations array<{RELATION}>"
    ),
    "recording": RECORDING,
}
ENTITIES = tuple(DOCUMENTS)

#: Fields that must not be blank.
REQUIRED = {"artist": ("id", "name", "sort-name"), "release-group": ("id", "title"), "release": ("id", "title"), "recording": ("id", "title")}


@dataclass(frozen=True)
class Table:
    columns: str
    key: tuple[str, ...]
    #: a repeated key is an error rather than ignored
    strict: bool = False
    #: the strict table of the same documents, where a document's rows have different keys that begin with its id
    parent: str | None = None

    @property
    def names(self) -> list[str]:
        return [x.split()[0] for x in self.columns.split(",")]


TABLES: dict[str, Table] = {
    "artists": Table(
        "mbid string, name string, sort_name string, disambiguation string, type string, country string, gender string, "
        "begin_date string, end_date string, ended boolean, area_mbid string, area_name string",
        ("mbid",),
        strict=True,
    ),
    "artist_aliases": Table("artist_mbid string, name string, sort_name string, type string, locale string, is_primary boolean", ("artist_mbid", "name", "locale"), parent="artists"),
    "artist_tags": Table("artist_mbid string, tag string, count bigint", ("artist_mbid", "tag"), parent="artists"),
    "artist_genres": Table("artist_mbid string, genre_mbid string, genre_name string, count bigint", ("artist_mbid", "genre_mbid"), parent="artists"),
    "release_groups": Table("mbid string, title string, primary_type string, disambiguation string, first_release_date string", ("mbid",), strict=True),
    "release_group_secondary_types": Table("release_group_mbid string, type string", ("release_group_mbid", "type"), parent="release_groups"),
    "release_group_artists": Table("release_group_mbid string, artist_mbid string, artist_name string, join_phrase string, position bigint", ("release_group_mbid", "position"), parent="release_groups"),
    "release_group_tags": Table("release_group_mbid string, tag string, count bigint", ("release_group_mbid", "tag"), parent="release_groups"),
    "releases": Table(
        "mbid string, title string, status string, date string, country string, barcode string, packaging string, language string, script string, release_group_mbid string",
        ("mbid",),
        strict=True,
    ),
    "release_artists": Table("release_mbid string, artist_mbid string, artist_name string, join_phrase string, position bigint", ("release_mbid", "position"), parent="releases"),
    "release_labels": Table("release_mbid string, label_mbid string, label_name string, catalog_number string", ("release_mbid", "label_mbid", "catalog_number"), parent="releases"),
    "release_media": Table("release_mbid string, position bigint, format string, track_count bigint", ("release_mbid", "position")),
    "recordings": Table("mbid string, title string, length bigint, disambiguation string, video boolean, first_release_date string", ("mbid",)),
    "recording_artists": Table("recording_mbid string, artist_mbid string, artist_name string, join_phrase string, position bigint", ("recording_mbid", "position")),
    "recording_isrcs": Table("recording_mbid string, isrc string", ("recording_mbid", "isrc")),
    "recording_tags": Table("recording_mbid string, tag string, count bigint", ("recording_mbid", "tag")),
    "tracks": Table("mbid string, release_mbid string, recording_mbid string, media_position bigint, position bigint, number string, title string, length bigint", ("mbid",)),
    "external_links": Table("entity_type string, entity_mbid string, rel_type string, url string", ("entity_mbid", "rel_type", "url")),
}

#: Search documents: two columns that are stored only, four that are indexed.
SEARCH_DOCS = "entity_type string, entity_mbid string, heading string, subtitle string, meta string, aux string"
INDEXED = ("heading", "subtitle", "meta", "aux")
#: The order of sections in a search report.
SECTIONS = ("artist", "release_group", "release", "recording", "track")
