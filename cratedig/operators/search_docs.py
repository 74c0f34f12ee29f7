"""Search documents of the five entity types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratedig.functions.text import spaced
from cratedig.operators.shared import with_children


def joined(rows: DataFrame, foreign: str, piece: str, separator: str, order: str, name: str) -> DataFrame:
    """(foreign, name): the pieces of each key joined in order; null pieces are left out."""
    return rows.groupBy(foreign).agg(F.expr(f"listagg({piece}, '{separator}') WITHIN GROUP (ORDER BY {order})").alias(name))


def credit_strings(credits: DataFrame, foreign: str, keep_spacing: bool = False) -> DataFrame:
    """(foreign, credit): names and join phrases as they follow each other.

    Join phrases were trimmed on load, so names and phrases touch;
    ``keep_spacing`` puts a space on each side of a phrase and between names.
    """
    piece = "concat(artist_name, CASE WHEN join_phrase <> '' THEN concat(' ', join_phrase, ' ') ELSE ' ' END)" if keep_spacing else "concat(artist_name, join_phrase)"
    out = joined(credits, foreign, piece, "", "position", "credit")
    return out.withColumn("credit", F.rtrim("credit")) if keep_spacing else out


def _with(parent: DataFrame, child: DataFrame, foreign: str, on: str = "mbid") -> DataFrame:
    return parent.join(child.withColumnRenamed(foreign, on), on, "left")


def _empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _docs(rows: DataFrame, kind: str, heading: Column, subtitle: Column, meta: Column, aux: Column) -> DataFrame:
    return rows.select(F.lit(kind).alias("entity_type"), F.col("mbid").alias("entity_mbid"), heading.alias("heading"), subtitle.alias("subtitle"), meta.alias("meta"), aux.alias("aux"))


def artist_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    rows = with_children(t["artists"], t, "artist_aliases", "artist_mbid", lambda rows: joined(rows, "artist_mbid", "name", " ", "is_primary DESC, name", "aliases"))
    return _docs(rows, "artist", F.col("name"), _empty("sort_name"), spaced(F.col("type"), F.col("country")), _empty("aliases"))


def release_group_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    rows = _with(t["release_groups"], credit_strings(t["release_group_artists"], "release_group_mbid"), "release_group_mbid")
    return _docs(rows, "release_group", F.col("title"), _empty("credit"), spaced(F.col("primary_type"), F.col("first_release_date")), _empty("disambiguation"))


def release_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    labels = joined(t["release_labels"].where("label_name <> ''"), "release_mbid", "label_name", " ", "label_name", "labels")
    rows = _with(_with(t["releases"], credit_strings(t["release_artists"], "release_mbid"), "release_mbid"), labels, "release_mbid")
    return _docs(rows, "release", F.col("title"), _empty("credit"), spaced(F.col("date"), F.col("country")), spaced(F.col("barcode"), F.col("labels")))


def recording_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    isrcs = joined(t["recording_isrcs"], "recording_mbid", "isrc", " ", "isrc", "isrcs")
    rows = _with(_with(t["recordings"], credit_strings(t["recording_artists"], "recording_mbid"), "recording_mbid"), isrcs, "recording_mbid")
    return _docs(rows, "recording", F.col("title"), _empty("credit"), _empty("first_release_date"), _empty("isrcs"))


def track_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    """Tracks whose release is there; orphans are left out."""
    releases = t["releases"].select(F.col("mbid").alias("release_mbid"), F.col("title").alias("release_title"))
    rows = t["tracks"].join(releases, "release_mbid").join(credit_strings(t["release_artists"], "release_mbid"), "release_mbid", "left")
    return _docs(rows, "track", F.col("title"), _empty("release_title"), _empty("credit"), _empty("number"))


def all_docs(t: Mapping[str, DataFrame]) -> DataFrame:
    out = artist_docs(t)
    for f in (release_group_docs, release_docs, recording_docs, track_docs):
        out = out.unionByName(f(t))
    return out


#: The tables that documents are made of.
USED = {
    "artists": ("artists", "artist_aliases"),
    "release_groups": ("release_groups", "release_group_artists"),
    "releases": ("releases", "release_artists", "release_labels"),
    "recordings": ("recordings", "recording_artists", "recording_isrcs"),
    "tracks": ("tracks", "releases", "release_artists"),
}
USED["all"] = tuple(dict.fromkeys(t for used in USED.values() for t in used))
