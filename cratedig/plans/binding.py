"""The star-schema tables as a music catalogue's documents.

Documents are nested, then written as JSON lines with some dirt (padding,
blanks, gaps, repeats), so that decoding and flattening really run on them.
A table needs some fields of a document only; a document is made of the fields
that are ``wanted``, by their paths, and of those that it must have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A total order of lineitem's rows.
LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(x: Column, key: Column) -> Column:
    return F.when(key % 5 == 0, F.concat(F.lit("\t "), x, F.lit("\u00a0 "))).otherwise(x)


def _id(prefix: str, key: Column | str) -> Column:
    return F.concat(F.lit(prefix), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _list(order: list[str], item: Column) -> Column:
    """The group's items in order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*order, item.alias("item")))), lambda x: x["item"])


def _fields(**columns: Column) -> Column:
    return F.struct(*(c.alias(k.replace("__", "-")) for k, c in columns.items()))


#: Fields that every document of an entity has, wanted or not.
MUST = ("id", "name", "sort-name", "title", "media.tracks.id", "media.tracks.recording.id", "media.tracks.recording.title")


def _chosen(wanted: frozenset[str] | None, within: str, **columns: Column) -> Column:
    """``_fields`` of those columns whose path, a path above or a path below is wanted; None wants all."""

    def kept(name: str) -> bool:
        path = within + name.replace("__", "-")
        return wanted is None or path in MUST or any(w == path or w.startswith(f"{path}.") or path.startswith(f"{w}.") for w in wanted)

    return _fields(**{k: c for k, c in columns.items() if kept(k)})


def _wants(wanted: frozenset[str] | None, *names: str) -> bool:
    return wanted is None or any(w.split(".")[0] in names for w in wanted)


def _artist(id: Column, name: Column) -> Column:
    return _fields(id=id, name=name)


def _credit(name: Column, joinphrase: str, artist: Column) -> Column:
    return _fields(name=name, joinphrase=F.lit(joinphrase), artist=artist)


def _lines(docs: DataFrame, rank: int, key: Column, document: Column, *more: Column) -> DataFrame:
    return docs.select(F.to_json(document).alias("line"), F.lit(rank).alias("source_rank"), key.cast("long").alias("line_no"), *more)


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their regions, few whatever the scale.

    They are what is broadcast: left to choose, Spark broadcasts customers and orders of some MB, and the one task that
    reads nations makes all documents.
    """
    return F.broadcast(table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("c_custkey", "ck")


def _aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, slot, aliases): the list that all artists of a nation and slot share."""
    supplier = table(spark, sf_dir, "supplier").join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    alias = _fields(name=padded(F.col("s_name"), F.col("s_suppkey")), sort__name=F.lit(" "), type=F.lit("supplier"), locale=F.col("r_name"), primary=F.col("s_acctbal") > 0)
    # of suppliers of one name the first: a list goes into the documents of all customers of the nation and slot
    firsts = supplier.groupBy(F.col("s_nationkey").alias("nk"), (F.col("s_suppkey") % 10).alias("slot"), "s_name").agg(F.min(F.struct("s_suppkey", "s_acctbal", "r_name")).alias("s"))
    return firsts.select("nk", "slot", "s_name", "s.*").groupBy("nk", "slot").agg(_list(["s_suppkey"], alias).alias("aliases"))


def _list_id(nation: str, slot: str) -> Column:
    return F.concat_ws("-", F.lit("aliases"), F.col(nation).cast("string"), F.col(slot).cast("string"))


def alias_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared alias lists as documents of their own, so that each is written, decoded and flattened once.

    Within the documents of artists they are customers times suppliers. The column ``shared`` of ``artist_lines`` names
    an artist's list.
    """
    named = _list_id("nk", "slot")
    return _lines(_aliases(spark, sf_dir), 0, F.col("nk") * 10 + F.col("slot"), _fields(id=named, name=named, sort__name=named, aliases=F.col("aliases")))


def artist_lines(spark: SparkSession, sf_dir: str, wanted: frozenset[str] | None = None) -> DataFrame:
    ck = F.col("ck")
    customers = _customers(spark, sf_dir)
    tag = _fields(name=F.col("event_type"), count=F.get_json_object("props", "$.k").cast("long"))
    tags = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("ck")).agg(_list(["event_id"], tag).alias("tags"))
    genre = _fields(id=F.concat(F.lit("genre-"), F.substring("o_orderpriority", 1, 1)), name=F.col("o_orderpriority"), count=F.lit(1))
    genres = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ck")).agg(_list(["o_orderkey"], genre).alias("genres"))
    kind, target = F.when(F.col("page_id") % 2 == 0, " homepage").otherwise(" "), F.when(F.col("page_id") % 3 == 0, "artist").otherwise("url")
    relation = _fields(type=kind, target__type=target, url=_fields(resource=F.col("url")))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("ck"), F.array(relation, relation).alias("relations"))
    # dealt out, as few tasks read customers
    rows = customers.repartition("ck").withColumn("slot", ck % 10)
    if _wants(wanted, "aliases"):
        rows = rows.join(_aliases(spark, sf_dir).withColumnRenamed("nk", "c_nationkey"), ["c_nationkey", "slot"], "left")
    for name, more in {"tags": tags, "genres": genres, "relations": pages}.items():
        rows = rows.join(more, "ck", "left") if _wants(wanted, name) else rows
    here = lambda x: F.col(x) if x in rows.columns else F.lit(None)
    document = _chosen(
        wanted,
        "",
        id=_id("artist-", "ck"),
        name=padded(F.col("c_name"), ck),
        sort__name=F.concat_ws(", ", "c_name", "c_mktsegment"),
        disambiguation=F.col("n_name"),
        type=F.when(ck % 7 != 0, F.col("c_mktsegment")).otherwise(""),
        country=F.col("n_name"),
        area=F.when(ck % 13 != 0, _artist(_id("area-", "n_nationkey"), F.col("n_name"))),
        life__span=_fields(ended=F.col("c_acctbal") < 0),
        aliases=here("aliases"),
        tags=here("tags"),
        genres=here("genres"),
        relations=here("relations"),
    )
    return _lines(rows, 0, ck, document, _list_id("c_nationkey", "slot").alias("shared"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _customers(spark, sf_dir).select("ck", "c_name", "c_mktsegment", "n_name", "n_nationkey")
    orders = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "ok", "o_custkey": "ck"})
    # never the orders to the customers: a broadcast of either side grows with the input
    return orders.join(own.hint("shuffle_hash"), "ck").withColumns({"dt": F.date_format("o_orderdate", "yyyy-MM-dd"), "yr": F.year("o_orderdate")})


def release_group_lines(spark: SparkSession, sf_dir: str, wanted: frozenset[str] | None = None) -> DataFrame:
    ck = F.col("ck")
    listed = [_list(["ok"], F.col("o_orderpriority")).alias("prios")] if _wants(wanted, "secondary-types") else []
    groups = _orders(spark, sf_dir).groupBy("ck", "yr", "c_name", "c_mktsegment", "n_name", "n_nationkey").agg(F.min("o_orderstatus").alias("st"), F.min("dt").alias("dt"), *listed)
    credits = F.array(
        _credit(F.lit(""), " with ", _artist(_id("artist-", "ck"), padded(F.col("c_name"), ck))),
        _credit(F.lit("Guest"), "", F.lit(None).cast("struct<id:string,name:string>")),
        _credit(F.lit("The Nation "), "", _artist(_id("artist-n", "n_nationkey"), F.col("n_name"))),
    )
    tag = lambda name, n: _fields(name=name, count=F.lit(n))
    document = _chosen(
        wanted,
        "",
        id=F.concat_ws("-", F.lit("rg"), ck.cast("string"), F.col("yr").cast("string")),
        title=F.concat_ws(" ", "c_name", F.col("yr").cast("string")),
        primary__type=F.col("st"),
        first__release__date=F.when(ck % 7 != 0, F.col("dt")).otherwise(" "),
        secondary__types=F.col("prios") if listed else F.lit(None),
        artist__credit=credits,
        tags=F.array(tag(F.col("c_mktsegment"), 1), tag(F.lit(" "), 2), tag(F.concat(F.col("c_mktsegment"), F.lit(" ")), 5)),
    )
    return _lines(groups, 1, ck * 10000 + F.col("yr"), document)


def release_lines(spark: SparkSession, sf_dir: str, wanted: frozenset[str] | None = None) -> DataFrame:
    ok, ck = F.col("ok"), F.col("ck")
    rows = _orders(spark, sf_dir)
    parts = _wants(wanted, "media"), _wants(wanted, "label-info")
    if any(parts):
        rows = rows.join(_items(spark, sf_dir, wanted), "ok", "left")
    document = _chosen(
        wanted,
        "",
        id=_id("release-", "ok"),
        title=F.concat(F.lit("Order "), ok.cast("string"), F.lit(" "), F.col("c_name")),
        status=F.col("o_orderstatus"),
        date=F.col("dt"),
        country=F.col("n_name"),
        barcode=F.when(ok % 7 != 0, F.lpad(ok.cast("string"), 12, "0")).otherwise("\u3000"),
        packaging=F.col("o_orderpriority"),
        release__group=_fields(id=F.concat_ws("-", F.lit("rg"), ck.cast("string"), F.col("yr").cast("string"))),
        artist__credit=F.array(
            _credit(F.lit(""), " & ", _artist(_id("artist-", "ck"), F.col("c_name"))),
            _credit(F.col("n_name"), "", F.when(ck % 13 != 0, _artist(_id("artist-n", "n_nationkey"), F.col("n_name")))),
        ),
        label__info=F.transform("items", _label) if parts[1] else F.lit(None),
        text__representation=_fields(language=F.lower(F.substring("n_name", 1, 3)), script=F.lit("Latn")),
        media=_media(wanted) if parts[0] else F.lit(None),
        relations=F.array(_fields(type=F.lit("purchase"), target__type=F.lit("url"), url=_fields(resource=_id("https://shop.example/", ok % 1000)))),
    )
    return _lines(rows, 2, ok, document)


def _items(spark: SparkSession, sf_dir: str, wanted: frozenset[str] | None) -> DataFrame:
    """(ok, items): the lines of an order in order, with what is wanted of their parts and suppliers.

    Lines are grouped once; a window for their numbers and groups of groups would sort them several times.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    more = ["p_name"]
    if wanted is None or any(w.startswith(f"{_EMBEDDED}disambiguation") for w in wanted):
        more.append("p_brand")
    if _wants(wanted, "label-info") or any(w.startswith(f"{_EMBEDDED}artist-credit") for w in wanted):
        more.append("s_name")
    # grouped where they are joined to orders
    lines = lines.select(F.col("l_orderkey").alias("ok"), F.struct(*LINE, *more).alias("item")).repartition("ok")
    return lines.groupBy("ok").agg(F.sort_array(F.collect_list("item")).alias("items"))


def _label(x: Column) -> Column:
    return _fields(catalog__number=F.concat(x["l_returnflag"], x["l_linestatus"]), label=_artist(_id("label-", x["l_suppkey"]), x["s_name"]))


def _media(wanted: frozenset[str] | None) -> Column:
    """The media of an order's ``items``: a side for each status, its tracks numbered in order."""
    ok = F.col("ok")
    status = lambda x: x["l_linestatus"]

    def medium(x: Column) -> Column:
        tracks = F.transform(F.filter("items", lambda item: status(item).eqNullSafe(x["status"])), lambda item, i: _track(wanted, item, i + 1))
        return _chosen(wanted, "media.", format=F.concat(F.lit("Side "), x["status"]), position=F.when(ok % 11 == 0, 0).otherwise(x["side"]), track__count=F.lit(0), tracks=tracks)

    sides = F.transform(F.array_distinct(F.transform("items", status)), lambda x: F.struct(F.when(x == "O", 1).otherwise(2).alias("side"), x.alias("status")))
    return F.transform(F.sort_array(sides), medium)


def _track(wanted: frozenset[str] | None, item: Column, trk: Column) -> Column:
    ok, ck = F.col("ok"), F.col("ck")
    isrc = F.concat(F.lit("ISRC-"), item["l_partkey"].cast("string"), F.lit("-"), item["l_suppkey"].cast("string"))
    length = (item["l_quantity"] * 1000).cast("long")
    # a field that is not wanted may be made of a column that the items lack
    credits = F.array(
        _credit(F.lit(""), " feat. ", _artist(_id("artist-", "ck"), F.col("c_name"))),
        _credit(item["s_name"], "", F.when(item["l_suppkey"] % 13 != 0, _artist(_id("artist-s", item["l_suppkey"]), item["s_name"]))),
    )
    recording = _chosen(
        wanted,
        _EMBEDDED,
        id=_id("rec-", item["l_partkey"]),
        title=F.when(ok % 17 != 0, item["p_name"]).otherwise(""),
        disambiguation=item["p_brand"],
        first__release__date=F.col("dt"),
        length=length,
        video=item["l_linenumber"] == 1,
        artist__credit=credits,
        isrcs=F.array(isrc, F.concat(F.lit(" "), isrc, F.lit("\u00a0")), F.lit("")),
        tags=F.array(_fields(name=F.lit("embedded"), count=F.lit(1))),
        relations=F.array(_fields(type=F.lit("stream"), target__type=F.lit("url"), url=_fields(resource=_id("https://play.example/", item["l_partkey"])))),
    )
    return _chosen(
        wanted,
        "media.tracks.",
        id=F.concat(F.lit("track-"), ok.cast("string"), F.lit("-"), item["l_linenumber"].cast("string")),
        number=F.when(trk % 2 == 0, " ").otherwise(F.concat(F.lit("A"), trk.cast("string"))),
        title=F.when(trk % 3 == 0, F.concat(F.lit("Part "), item["p_name"])).otherwise(""),
        length=length,
        position=F.when(ok % 3 == 0, 0).otherwise(trk),
        recording=recording,
    )


def recording_lines(spark: SparkSession, sf_dir: str, wanted: frozenset[str] | None = None) -> DataFrame:
    pk = F.col("p_partkey")
    document = _chosen(
        wanted,
        "",
        id=_id("rec-", pk),
        title=F.col("p_name"),
        length=F.col("p_size").cast("long") * 1000,
        isrcs=F.array(_id("ISRC-", pk)),
        tags=F.array(_fields(name=F.col("p_brand"), count=F.col("p_size")), _fields(name=F.col("p_type"), count=F.lit(1)), _fields(name=F.lit(""), count=F.lit(9))),
        relations=F.array(_fields(type=F.lit("stream"), target__type=F.lit("url"), url=_fields(resource=_id("https://play.example/", pk)))),
    )
    return _lines(table(spark, sf_dir, "part"), 3, pk, document)


LINES = {"artist": artist_lines, "release-group": release_group_lines, "release": release_lines, "recording": recording_lines}


_EMBEDDED = "media.tracks.recording."
#: By table and entity, the fields that its rows are made of.
WANTED: dict[str, dict[str, tuple[str, ...]]] = {
    "artists": {"artist": ("disambiguation", "type", "country", "area", "life-span")},
    "artist_aliases": {"artist": ()},  # the lists are documents of their own
    "artist_tags": {"artist": ("tags",)},
    "artist_genres": {"artist": ("genres",)},
    "release_groups": {"release-group": ("primary-type", "disambiguation", "first-release-date")},
    "release_group_secondary_types": {"release-group": ("secondary-types",)},
    "release_group_artists": {"release-group": ("artist-credit",)},
    "release_group_tags": {"release-group": ("tags",)},
    "releases": {"release": ("status", "date", "country", "barcode", "packaging", "text-representation", "release-group")},
    "release_artists": {"release": ("artist-credit",)},
    "release_labels": {"release": ("label-info",)},
    "release_media": {"release": ("media.format", "media.position", "media.track-count", "media.tracks.id")},
    "recordings": {e: tuple(f"{w}{x}" for x in ("length", "disambiguation", "video", "first-release-date")) for e, w in (("release", _EMBEDDED), ("recording", ""))},
    "recording_artists": {"release": (f"{_EMBEDDED}artist-credit",), "recording": ("artist-credit",)},
    "recording_isrcs": {"release": (f"{_EMBEDDED}isrcs",), "recording": ("isrcs",)},
    "recording_tags": {"recording": ("tags",)},
    "tracks": {"release": ("media.position", *(f"media.tracks.{x}" for x in ("number", "title", "length", "position", "recording.title")))},
    "external_links": {"artist": ("relations",), "release-group": ("relations",), "release": ("relations", f"{_EMBEDDED}relations"), "recording": ("relations",)},
}
#: Of the tables that a catalogue needs, the fields of the keys of their rows beyond MUST.
KEYED: dict[str, dict[str, tuple[str, ...]]] = {t: {"release": ("media.tracks.recording.id",)} for t in ("recordings", "tracks")}


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text corpus as search documents."""
    docs = table(spark, sf_dir, "documents")
    heading = F.regexp_extract("text", "^[^ \n]*(?:[ \n]+[^ \n]+){0,7}", 0)
    return docs.select(
        F.lit("release").alias("entity_type"), _id("doc-", "doc_id").alias("entity_mbid"), heading.alias("heading"), F.col("source").alias("subtitle"), F.col("lang").alias("meta"), F.col("text").alias("aux")
    )
