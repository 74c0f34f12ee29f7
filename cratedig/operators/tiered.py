"""Search without an index: exact, then prefix, then substring matches, in one ranked pass.

A row's tier is the lowest at which any of its own or its children's columns
matches; ordering by tier first gives what asking tier by tier would collect.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratedig.functions.text import ascii_lower, like_ascii_ci, null_if_empty
from cratedig.operators.search_docs import credit_strings
from cratedig.operators.shared import per_parent
from cratedig.schemas import SECTIONS

LIMIT = 10


def like_tier(x: Column, query: str, escape: bool = False) -> Column:
    """1, 2 or 3 if ``x`` is like the query, begins or contains it; else null. ``%`` and ``_`` are wildcards unless escaped."""
    like = lambda pattern: like_ascii_ci(x, pattern)
    if not escape:
        return F.when(like(query), 1).when(like(f"{query}%"), 2).when(like(f"%{query}%"), 3)
    low, plain = ascii_lower(x), ascii_lower(F.lit(query))
    return F.when(low == plain, 1).when(low.startswith(plain), 2).when(low.contains(plain), 3)


def equal_tier(x: Column, query: str) -> Column:
    return F.when(x == query, 1)


def child_tier(child: DataFrame, foreign: str, tier: Column, name: str) -> DataFrame:
    """(foreign, name): the lowest tier of each parent's children that match at all."""
    hits = child.select(foreign, tier.alias(name)).where(F.col(name).isNotNull())
    return hits.groupBy(foreign).agg(F.min(name).alias(name))


def tiered(parent: DataFrame, own: Sequence[Column], children: Sequence[tuple[DataFrame, str, Column]], key: str = "mbid") -> DataFrame:
    """``parent`` rows that match, with their ``tier``; children: (rows, foreign key, tier)."""
    out, tiers = parent.withColumn("_own", F.least(*own) if len(own) > 1 else own[0]), [F.col("_own")]
    for i, (child, foreign, tier) in enumerate(children):
        out = out.join(child_tier(child, foreign, tier, f"_t{i}").withColumnRenamed(foreign, key), key, "left")
        tiers.append(F.col(f"_t{i}"))
    out = out.withColumn("tier", F.least(*tiers) if len(tiers) > 1 else tiers[0])
    return out.where("tier is not null").drop("_own", *(f"_t{i}" for i in range(len(children))))


def tiered_topn(rows: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    return rows.orderBy("tier", *order).limit(limit if limit > 0 else LIMIT)


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")).alias(c)


def _credited(rows: DataFrame, credits: DataFrame, foreign: str, key: str = "mbid") -> DataFrame:
    """Adds ``artists`` to the few rows that are left."""
    strings = credits.join(F.broadcast(rows.select(F.col(key).alias(foreign)).distinct()), foreign, "left_semi")
    return rows.join(credit_strings(strings, foreign).select(F.col(foreign).alias(key), F.col("credit").alias("artists")), key, "left").withColumn("artists", F.coalesce("artists", F.lit("")))


def search_artists(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    like = lambda c: like_tier(F.col(c), query, escape)
    aliases = per_parent(t, "artist_aliases", "artist_mbid", lambda rows: child_tier(rows, "artist_mbid", like("name"), "tier"))
    rows = tiered(t["artists"], [equal_tier(F.col("mbid"), query), like("name"), like("sort_name")], [(aliases, "artist_mbid", F.col("tier"))])
    return tiered_topn(rows, ["name", "mbid"], limit).select("tier", "mbid", "name", _empty("sort_name"), _empty("type"), _empty("country"))


def search_release_groups(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    like = lambda c: like_tier(F.col(c), query, escape)
    rows = tiered(t["release_groups"], [equal_tier(F.col("mbid"), query), like("title")], [(t["release_group_artists"], "release_group_mbid", like("artist_name"))])
    order = [F.desc_nulls_last("first_release_date"), "title", "mbid"]
    top = _credited(tiered_topn(rows, order, limit), t["release_group_artists"], "release_group_mbid")
    return top.orderBy("tier", *order).select("tier", "mbid", "title", _empty("primary_type"), _empty("first_release_date"), "artists")


def search_releases(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    like = lambda c: like_tier(F.col(c), query, escape)
    own = [equal_tier(F.col("mbid"), query), like("title"), equal_tier(F.col("barcode"), query)]
    rows = tiered(t["releases"], own, [(t["release_artists"], "release_mbid", like("artist_name")), (t["release_labels"], "release_mbid", like("label_name"))])
    order = [F.desc_nulls_last("date"), "title", "mbid"]
    top = _credited(tiered_topn(rows, order, limit), t["release_artists"], "release_mbid")
    return top.orderBy("tier", *order).select("tier", "mbid", "title", _empty("date"), _empty("country"), "artists")


def search_recordings(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    like = lambda c: like_tier(F.col(c), query, escape)
    children = [(t["recording_artists"], "recording_mbid", like("artist_name")), (t["recording_isrcs"], "recording_mbid", equal_tier(F.col("isrc"), query)), (t["tracks"], "recording_mbid", like("title"))]
    rows = tiered(t["recordings"], [equal_tier(F.col("mbid"), query), like("title")], children)
    order = [F.desc_nulls_last("first_release_date"), "title", "mbid"]
    top = _credited(tiered_topn(rows, order, limit), t["recording_artists"], "recording_mbid")
    return top.orderBy("tier", *order).select("tier", "mbid", "title", _empty("first_release_date"), "artists")


def search_tracks(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    like = lambda c: like_tier(F.col(c), query, escape)
    releases = t["releases"].select(F.col("mbid").alias("release_mbid"), F.col("title").alias("release_title"), F.col("date").alias("release_date"))
    artist = child_tier(t["release_artists"], "release_mbid", like("artist_name"), "_artist")
    # tracks that match by themselves or by their release's artists, and only then the releases of these
    hits = tiered(t["tracks"].join(artist, "release_mbid", "left"), [equal_tier(F.col("mbid"), query), like("title"), F.col("_artist")], [])
    rows = hits.join(releases, "release_mbid")
    order = [F.desc_nulls_last("release_date"), "title", "mbid"]
    top = _credited(tiered_topn(rows, order, limit), t["release_artists"], "release_mbid", "release_mbid")
    return top.orderBy("tier", *order).select("tier", "mbid", "title", "number", _empty("release_title"), "artists")


SEARCHES = dict(zip(SECTIONS, (search_artists, search_release_groups, search_releases, search_recordings, search_tracks), strict=True))
#: The tables that a search reads.
USED = {
    "artist": ("artists", "artist_aliases"),
    "release_group": ("release_groups", "release_group_artists"),
    "release": ("releases", "release_artists", "release_labels"),
    "recording": ("recordings", "recording_artists", "recording_isrcs", "tracks"),
    "track": ("tracks", "releases", "release_artists"),
}
_TITLES = {"artist": "name"}


def search(t: Mapping[str, DataFrame], query: str, limit: int = LIMIT, escape: bool = False) -> DataFrame:
    """All five searches in one shape: entity_type, tier, mbid, title, artists."""
    if not query.strip():
        raise ValueError("the query is blank")
    parts = []
    for kind, f in SEARCHES.items():
        rows = f(t, query, limit, escape)
        artists = F.col("artists") if "artists" in rows.columns else null_if_empty(F.col("sort_name"))
        parts.append(rows.select(F.lit(kind).alias("entity_type"), "tier", "mbid", F.col(_TITLES.get(kind, "title")).alias("title"), F.coalesce(artists, F.lit("")).alias("artists")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
