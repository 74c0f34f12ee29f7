"""The registered catalogue queries in SQL over the flat tables."""

from __future__ import annotations

_LINE = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

#: The catalogue's tables straight from the flat ones; unused parts cost nothing.
TABLES = f"""
WITH c AS (
  SELECT c_custkey AS ck, c_name, c_mktsegment AS seg, c_acctbal, c_nationkey AS nk, n_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
o AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS st, o_orderpriority AS prio, strftime(o_orderdate, '%Y-%m-%d') AS dt, year(o_orderdate) AS yr, c_name, n_name, nk
  FROM orders JOIN c ON o_custkey = ck),
li AS (
  SELECT l.*, o.*, p_name, p_brand, s_name, CASE l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS side,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY {_LINE}) AS trk,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) AS lno,
    dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus = 'F') AS medium
  FROM lineitem l JOIN o ON l_orderkey = ok JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
artists AS (
  SELECT 'artist-' || ck AS mbid, c_name AS name, c_name || ', ' || seg AS sort_name, n_name AS disambiguation, CASE WHEN ck % 7 <> 0 THEN seg END AS type, n_name AS country,
    NULL::VARCHAR AS gender, NULL::VARCHAR AS begin_date, NULL::VARCHAR AS end_date, c_acctbal < 0 AS ended,
    CASE WHEN ck % 13 <> 0 THEN 'area-' || nk END AS area_mbid, CASE WHEN ck % 13 <> 0 THEN n_name END AS area_name
  FROM c),
artist_aliases AS (
  SELECT artist_mbid, name, NULL::VARCHAR AS sort_name, 'supplier' AS type, locale, is_primary FROM (
    SELECT 'artist-' || ck AS artist_mbid, s_name AS name, r_name AS locale, s_acctbal > 0 AS is_primary, row_number() OVER (PARTITION BY ck, s_name, r_name ORDER BY s_suppkey) AS turn
    FROM c JOIN supplier ON s_nationkey = nk AND s_suppkey % 10 = ck % 10 JOIN nation n ON n.n_nationkey = nk JOIN region ON n_regionkey = r_regionkey) WHERE turn = 1),
artist_tags AS (
  SELECT artist_mbid, tag, count FROM (
    SELECT 'artist-' || user_id AS artist_mbid, event_type AS tag, (props->>'$.k')::BIGINT AS count, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS turn
    FROM events JOIN c ON user_id = ck) WHERE turn = 1),
artist_genres AS (
  SELECT artist_mbid, genre_mbid, genre_name, 1::BIGINT AS count FROM (
    SELECT 'artist-' || ck AS artist_mbid, 'genre-' || substr(prio, 1, 1) AS genre_mbid, prio AS genre_name, row_number() OVER (PARTITION BY ck, substr(prio, 1, 1) ORDER BY ok) AS turn
    FROM o) WHERE turn = 1),
rg AS (SELECT ck, yr, c_name, n_name, nk, min(st) AS st, min(dt) AS dt FROM o GROUP BY ALL),
release_groups AS (
  SELECT 'rg-' || ck || '-' || yr AS mbid, c_name || ' ' || yr AS title, st AS primary_type, '' AS disambiguation, CASE WHEN ck % 7 <> 0 THEN dt END AS first_release_date FROM rg),
release_group_secondary_types AS (SELECT DISTINCT 'rg-' || ck || '-' || yr AS release_group_mbid, prio AS type FROM o),
release_group_artists AS (
  SELECT 'rg-' || ck || '-' || yr AS release_group_mbid, 'artist-' || ck AS artist_mbid, c_name AS artist_name, 'with' AS join_phrase, 1::BIGINT AS position FROM rg
  UNION ALL SELECT 'rg-' || ck || '-' || yr, 'artist-n' || nk, 'The Nation', '', 3 FROM rg),
release_group_tags AS (SELECT 'rg-' || ck || '-' || yr AS release_group_mbid, seg AS tag, 1::BIGINT AS count FROM rg JOIN c USING (ck)),
releases AS (
  SELECT 'release-' || ok AS mbid, 'Order ' || ok || ' ' || c_name AS title, st AS status, dt AS date, n_name AS country, CASE WHEN ok % 7 <> 0 THEN lpad(ok::VARCHAR, 12, '0') END AS barcode,
    prio AS packaging, lower(substr(n_name, 1, 3)) AS language, 'Latn' AS script, 'rg-' || ck || '-' || yr AS release_group_mbid
  FROM o),
release_artists AS (
  SELECT 'release-' || ok AS release_mbid, 'artist-' || ck AS artist_mbid, c_name AS artist_name, '&' AS join_phrase, 1::BIGINT AS position FROM o
  UNION ALL SELECT 'release-' || ok, 'artist-n' || nk, n_name, '', 2 FROM o WHERE ck % 13 <> 0),
release_labels AS (SELECT DISTINCT 'release-' || ok AS release_mbid, 'label-' || l_suppkey AS label_mbid, s_name AS label_name, l_returnflag || l_linestatus AS catalog_number FROM li),
release_media AS (
  SELECT 'release-' || ok AS release_mbid, (CASE WHEN ok % 11 = 0 THEN medium ELSE side END)::BIGINT AS position, 'Side ' || l_linestatus AS format, count(*) AS track_count
  FROM li GROUP BY ok, medium, side, l_linestatus),
raw_tracks AS (
  SELECT 'track-' || ok || '-' || l_linenumber AS mbid, 'release-' || ok AS release_mbid, 'rec-' || l_partkey AS recording_mbid, (CASE WHEN ok % 11 = 0 THEN medium ELSE side END)::BIGINT AS media_position,
    trk::BIGINT AS position, CASE WHEN trk % 2 = 0 THEN trk::VARCHAR ELSE 'A' || trk END AS number,
    CASE WHEN trk % 3 = 0 THEN 'Part ' || p_name WHEN ok % 17 <> 0 THEN p_name ELSE '' END AS title, (l_quantity * 1000)::BIGINT AS length, ok, medium, trk
  FROM li),
tracks AS (
  SELECT mbid, release_mbid, recording_mbid, media_position, position, number, title, length FROM (
    SELECT *, row_number() OVER (PARTITION BY mbid ORDER BY ok, medium, trk) AS turn FROM raw_tracks) WHERE turn = 1),
er AS (SELECT * FROM li WHERE ok % 17 <> 0 AND p_name <> ''),
first_er AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY ok, medium, trk) AS turn FROM er),
embedded_recordings AS (SELECT 'rec-' || l_partkey AS mbid, p_name AS title, (l_quantity * 1000)::BIGINT AS length, p_brand AS disambiguation, l_linenumber = 1 AS video, dt AS first_release_date FROM first_er WHERE turn = 1),
recordings AS (
  SELECT * FROM embedded_recordings
  UNION ALL SELECT 'rec-' || p_partkey, p_name, p_size::BIGINT * 1000, '', FALSE, NULL FROM part WHERE 'rec-' || p_partkey NOT IN (SELECT mbid FROM embedded_recordings)),
recording_artists AS (
  SELECT 'rec-' || l_partkey AS recording_mbid, 'artist-' || ck AS artist_mbid, c_name AS artist_name, 'feat.' AS join_phrase, 1::BIGINT AS position FROM first_er WHERE turn = 1
  UNION ALL SELECT 'rec-' || l_partkey, 'artist-s' || l_suppkey, s_name, '', 2 FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY ok, medium, trk) AS second FROM er WHERE l_suppkey % 13 <> 0) WHERE second = 1),
recording_isrcs AS (
  SELECT DISTINCT 'rec-' || l_partkey AS recording_mbid, 'ISRC-' || l_partkey || '-' || l_suppkey AS isrc FROM er
  UNION ALL SELECT 'rec-' || p_partkey, 'ISRC-' || p_partkey FROM part),
recording_tags AS (
  SELECT 'rec-' || p_partkey AS recording_mbid, p_brand AS tag, p_size::BIGINT AS count FROM part
  UNION ALL SELECT 'rec-' || p_partkey, p_type, 1 FROM part WHERE p_type <> p_brand),
external_links AS (
  SELECT 'artist' AS entity_type, 'artist-' || page_id AS entity_mbid, 'homepage' AS rel_type, url FROM pages JOIN c ON page_id = ck WHERE page_id % 2 = 0 AND page_id % 3 <> 0
  UNION ALL SELECT 'release', 'release-' || ok, 'purchase', 'https://shop.example/' || ok % 1000 FROM o
  UNION ALL SELECT 'recording', 'rec-' || p_partkey, 'stream', 'https://play.example/' || p_partkey FROM part),
docs_artists AS (
  SELECT 'artist' AS entity_type, mbid AS entity_mbid, name AS heading, sort_name AS subtitle, concat_ws(' ', type, country) AS meta,
    coalesce((SELECT string_agg(x.name, ' ' ORDER BY is_primary DESC, x.name) FROM artist_aliases x WHERE x.artist_mbid = mbid), '') AS aux
  FROM artists),
rg_credit AS (SELECT release_group_mbid, string_agg(artist_name || join_phrase, '' ORDER BY position) AS credit FROM release_group_artists GROUP BY 1),
release_credit AS (SELECT release_mbid, string_agg(artist_name || join_phrase, '' ORDER BY position) AS credit FROM release_artists GROUP BY 1),
recording_credit AS (SELECT recording_mbid, string_agg(artist_name || join_phrase, '' ORDER BY position) AS credit FROM recording_artists GROUP BY 1),
docs_release_groups AS (
  SELECT 'release_group' AS entity_type, mbid AS entity_mbid, title AS heading, coalesce(credit, '') AS subtitle, concat_ws(' ', primary_type, first_release_date) AS meta, '' AS aux
  FROM release_groups LEFT JOIN rg_credit ON release_group_mbid = mbid),
docs_releases AS (
  SELECT 'release' AS entity_type, mbid AS entity_mbid, title AS heading, coalesce(credit, '') AS subtitle, concat_ws(' ', date, country) AS meta,
    concat_ws(' ', barcode, (SELECT string_agg(label_name, ' ' ORDER BY label_name) FROM release_labels x WHERE x.release_mbid = mbid)) AS aux
  FROM releases LEFT JOIN release_credit ON release_mbid = mbid),
docs_recordings AS (
  SELECT 'recording' AS entity_type, mbid AS entity_mbid, title AS heading, coalesce(credit, '') AS subtitle, coalesce(first_release_date, '') AS meta,
    coalesce((SELECT string_agg(isrc, ' ' ORDER BY isrc) FROM recording_isrcs x WHERE x.recording_mbid = mbid), '') AS aux
  FROM recordings LEFT JOIN recording_credit ON recording_mbid = mbid),
docs_tracks AS (
  SELECT 'track' AS entity_type, t.mbid AS entity_mbid, t.title AS heading, r.title AS subtitle, coalesce(credit, '') AS meta, t.number AS aux
  FROM tracks t JOIN releases r ON r.mbid = t.release_mbid LEFT JOIN release_credit x ON x.release_mbid = t.release_mbid),
docs_all AS (
  SELECT * FROM docs_artists UNION ALL SELECT * FROM docs_release_groups UNION ALL SELECT * FROM docs_releases UNION ALL SELECT * FROM docs_recordings UNION ALL SELECT * FROM docs_tracks),
docs_text AS (
  SELECT 'release' AS entity_type, 'doc-' || doc_id AS entity_mbid, regexp_extract(text, '^[^ \n]*(?:[ \n]+[^ \n]+){{0,7}}') AS heading, source AS subtitle, lang AS meta, text AS aux FROM documents)
"""


def tokens(x: str) -> str:
    return f"regexp_extract_all(strip_accents(lower({x})), '[\\p{{L}}\\p{{N}}]+')"


def index(docs: str) -> str:
    """CTEs postings, doc_len and stats over the CTE ``docs``."""
    parts = " UNION ALL ".join(f"SELECT entity_type, entity_mbid, '{c}' AS col, unnest({tokens(c)}) AS term FROM {docs}" for c in ("heading", "subtitle", "meta", "aux"))
    size = " + ".join(f"coalesce(len({tokens(c)}), 0)" for c in ("heading", "subtitle", "meta", "aux"))
    return f""",
postings AS (SELECT entity_type, entity_mbid, col, term, count(*) AS tf FROM ({parts}) GROUP BY ALL),
doc_len AS (SELECT entity_type, entity_mbid, ({size})::BIGINT AS len FROM {docs}),
stats AS (SELECT count(*) AS n_docs, sum(len)::BIGINT AS n_tokens FROM doc_len)"""


def bm25(prefixes: list[str]) -> str:
    """CTE scored over those of ``index``."""
    values = ", ".join(f"({i}, '{p}')" for i, p in enumerate(prefixes))
    return f""",
q AS (SELECT * FROM (VALUES {values}) v(idx, prefix)),
hits AS (SELECT entity_type, entity_mbid, idx, sum(tf * CASE col WHEN 'heading' THEN 2.0 ELSE 1.0 END)::DOUBLE AS f FROM postings JOIN q ON starts_with(term, prefix) GROUP BY ALL),
df AS (SELECT idx, count(*) AS df FROM hits GROUP BY idx),
idf AS (SELECT idx, CASE WHEN ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) > 0 THEN ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) ELSE 1e-6 END AS idf, n_tokens::DOUBLE / n_docs AS avg_len FROM df, stats),
scored AS (
  SELECT entity_type, entity_mbid, -sum(idf * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len))) AS score
  FROM hits JOIN idf USING (idx) JOIN doc_len USING (entity_type, entity_mbid) GROUP BY ALL HAVING count(*) = {len(prefixes)})"""


def top(docs: str, limit: int) -> str:
    """CTE best over scored: the fetch limit, then the cap of each type."""
    return f""",
fetched AS (
  SELECT d.*, score FROM {docs} d JOIN scored USING (entity_type, entity_mbid)
  ORDER BY round(score, 9), entity_type, heading, entity_mbid LIMIT {max(50, 8 * limit)}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY round(score, 9), heading, entity_mbid)::INT AS rank FROM fetched) WHERE rank <= {limit})"""


def tier(x: str, query: str) -> str:
    low = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    q = query.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("'", "''")
    return f"CASE WHEN {low} LIKE '{q}' THEN 1 WHEN {low} LIKE '{q}%' THEN 2 WHEN {low} LIKE '%{q}%' THEN 3 END"


def _equal(x: str, query: str) -> str:
    return f"CASE WHEN {x} = '{query}' THEN 1 END"


def _child(table: str, foreign: str, expr: str) -> str:
    return f"(SELECT min({expr}) FROM {table} k WHERE k.{foreign} = p.mbid)"


def searches(query: str, limit: int) -> dict[str, str]:
    """The five tiered searches as SELECTs over TABLES."""

    def one(table: str, tiers: list[str], columns: str, order: str, more: str = "") -> str:
        least = f"least({', '.join(tiers)})"
        return f"(SELECT {columns} FROM (SELECT p.*, {least}::INT AS tier FROM {table} p) p {more} WHERE tier IS NOT NULL ORDER BY tier, {order} LIMIT {limit})"

    credit = lambda cte, key, on="p.mbid": f"LEFT JOIN {cte} ON {cte}.{key} = {on}"
    with_release = "(SELECT t.*, r.title AS release_title, r.date AS release_date FROM tracks t JOIN releases r ON r.mbid = t.release_mbid)"
    return {
        "artist": one("artists", [_equal("mbid", query), tier("name", query), tier("sort_name", query), _child("artist_aliases", "artist_mbid", tier("k.name", query))], "tier, mbid, name, sort_name, coalesce(type, '') AS type, coalesce(country, '') AS country", "name, mbid"),
        "release_group": one(
            "release_groups", [_equal("mbid", query), tier("title", query), _child("release_group_artists", "release_group_mbid", tier("k.artist_name", query))],
            "tier, mbid, title, primary_type, coalesce(first_release_date, '') AS first_release_date, coalesce(credit, '') AS artists", "p.first_release_date DESC NULLS LAST, title, mbid", credit("rg_credit", "release_group_mbid")),
        "release": one(
            "releases", [_equal("mbid", query), tier("title", query), _equal("barcode", query), _child("release_artists", "release_mbid", tier("k.artist_name", query)), _child("release_labels", "release_mbid", tier("k.label_name", query))],
            "tier, mbid, title, date, country, coalesce(credit, '') AS artists", "p.date DESC NULLS LAST, title, mbid", credit("release_credit", "release_mbid")),
        "recording": one(
            "recordings", [_equal("mbid", query), tier("title", query), _child("recording_artists", "recording_mbid", tier("k.artist_name", query)), _child("recording_isrcs", "recording_mbid", _equal("k.isrc", query)), _child("tracks", "recording_mbid", tier("k.title", query))],
            "tier, mbid, title, coalesce(first_release_date, '') AS first_release_date, coalesce(credit, '') AS artists", "p.first_release_date DESC NULLS LAST, title, mbid", credit("recording_credit", "recording_mbid")),
        "track": one(
            with_release, [_equal("p.mbid", query), tier("p.title", query), f"(SELECT min({tier('k.artist_name', query)}) FROM release_artists k WHERE k.release_mbid = p.release_mbid)"],
            "tier, mbid, title, number, release_title, coalesce(credit, '') AS artists", "p.release_date DESC NULLS LAST, title, mbid", credit("release_credit", "release_mbid", "p.release_mbid")),
    }


def federated(query: str, limit: int) -> str:
    parts = searches(query, limit)
    rows = [f"SELECT 'artist' AS entity_type, tier, mbid, name AS title, coalesce(sort_name, '') AS artists FROM {parts.pop('artist')}"]
    rows += [f"SELECT '{k}', tier, mbid, title, artists FROM {x}" for k, x in parts.items()]
    return TABLES + " UNION ALL ".join(rows)


def exact(value: str) -> str:
    """Entities whose id, barcode or ISRC is ``value``."""
    part = lambda kind, table, title, matched: f"SELECT '{kind}' AS entity_type, {matched} AS matched, mbid, {title} AS title FROM {table}"
    by_id = f"CASE WHEN mbid = '{value}' THEN 'mbid' END"
    isrc = f"CASE WHEN mbid = '{value}' THEN 'mbid' WHEN mbid IN (SELECT recording_mbid FROM recording_isrcs WHERE isrc = '{value}') THEN 'isrc' END"
    barcode = f"CASE WHEN mbid = '{value}' THEN 'mbid' WHEN barcode = '{value}' THEN 'barcode' END"
    parts = [part("artist", "artists", "name", by_id), part("release_group", "release_groups", "title", by_id), part("release", "releases", "title", barcode)]
    parts += [part("recording", "recordings", "title", isrc), part("track", "tracks", "title", by_id)]
    return f"{TABLES}SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE matched IS NOT NULL"


def table(name: str, columns: str = "*") -> str:
    return f"{TABLES}SELECT {columns} FROM {name}"
