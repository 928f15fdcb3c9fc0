"""The same results as DuckDB SQL over the driver tables."""

from __future__ import annotations

RELEASE_DATE = """CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y')
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m')
         WHEN o_orderpriority = '1-URGENT' THEN 'n/a'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END"""

# What RELEASE_DATE says, from the date itself: no parsing of text.
RELEASED = """CASE WHEN o_orderstatus = 'F' THEN date_trunc('year', o_orderdate)
         WHEN o_orderstatus = 'O' THEN date_trunc('month', o_orderdate)
         WHEN o_orderpriority <> '1-URGENT' THEN date_trunc('day', o_orderdate) END"""

ALBUM_PAGES = """
album_page AS (
  SELECT *, CASE WHEN day(o_orderdate) = 31 THEN 0
                 WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 2 END AS n
  FROM orders
), kept_album_page AS (
  SELECT * FROM (
    SELECT *, coalesce(max(CAST(n < 2 AS INT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
    FROM album_page) WHERE stopped = 0
)"""

TRACK_PAGES = """
track_page AS (
  SELECT *, CASE WHEN l_quantity = 50 THEN 0 WHEN l_quantity <= 5 THEN 1 ELSE 2 END AS n,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS track_id
  FROM lineitem
), kept_track_page AS (
  SELECT * FROM (
    SELECT *, coalesce(max(CAST(n < 2 AS INT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber
                       RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
    FROM track_page) WHERE stopped = 0
)"""


def albums(name: str, pages: str) -> str:
    """The album records on ``pages`` as the table ``name``."""
    return f"""
{name} AS (
  SELECT o_custkey AS custkey, o_orderkey AS page_offset, CAST(0 AS BIGINT) AS pos,
         CAST(o_orderkey AS VARCHAR) AS id, 'Album ' || o_orderkey AS name,
         CAST(floor(o_totalprice / 10000) AS BIGINT) AS total_tracks,
         {RELEASE_DATE} AS release_date, {RELEASED} AS released,
         CASE o_orderpriority WHEN '2-HIGH' THEN 'single' WHEN '4-NOT SPECIFIED' THEN 'compilation'
              WHEN '5-LOW' THEN 'appears_on' ELSE 'album' END AS album_group,
         CAST(o_custkey % 4 AS BIGINT) AS n_images, 'album/' || o_orderkey AS url
  FROM {pages} WHERE n >= 1
  UNION ALL
  SELECT o_custkey, o_orderkey, 1, 'collection-' || o_custkey, 'Collection ' || o_orderkey, 1,
         strftime(o_orderdate, '%Y'), date_trunc('year', o_orderdate),
         'single', 0, 'collection/' || o_orderkey
  FROM {pages} WHERE n >= 2
)"""


def tracks(name: str, pages: str) -> str:
    """The track records on ``pages`` as the table ``name``."""
    return f"""
{name} AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS page_offset, CAST(0 AS BIGINT) AS pos,
         track_id AS id,
         CASE WHEN l_returnflag = 'R' THEN 'Intro'
              WHEN l_quantity <> 7 THEN 'Track ' || l_partkey END AS name,
         CAST(l_linenumber AS BIGINT) AS track_number, l_linestatus = 'O' AS is_playable,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS duration_ms,
         l_discount > CAST(0.05 AS DOUBLE) AS explicit,
         'track/' || l_partkey AS url, CAST(l_orderkey AS VARCHAR) AS album_id
  FROM {pages} WHERE n >= 1
  UNION ALL
  SELECT l_orderkey, l_linenumber, 1, track_id || '-b', 'Interlude ' || l_suppkey,
         l_linenumber, l_linestatus = 'F', CAST(l_quantity * 1000 AS BIGINT), false, 'interlude/' || l_suppkey,
         CAST(l_orderkey AS VARCHAR)
  FROM {pages} WHERE n >= 2
  UNION ALL
  SELECT c_custkey, 0, 0, 'collected-' || c_custkey, 'Collected ' || c_custkey, 1, true,
         CAST(round(abs(c_acctbal) * 100) AS BIGINT), false, 'collected/' || c_custkey,
         'collection-' || c_custkey
  FROM customer
)"""


# The albums that are landed, the parents their tracks hang on, and those tracks.
BRONZE = f"""{ALBUM_PAGES}, {albums("every_album", "kept_album_page")}, bronze_album AS (
  SELECT * FROM every_album WHERE album_group IN ('album', 'single')
), {TRACK_PAGES}, {tracks("every_track", "kept_track_page")}, bronze_track AS (
  SELECT a.custkey, a.page_offset AS album_offset, a.pos AS album_pos, t.*
  FROM every_track t JOIN bronze_album a ON a.id = t.album_id
)"""


def silver_albums(source: str) -> str:
    covers = ", ".join(
        f"CASE WHEN n_images >= {i} THEN 'cover-' || id || '-{side}' END AS capa_album_{side}"
        for i, side in ((1, 640), (2, 300), (3, 64))
    )
    return f"""
SELECT id AS id_album, total_tracks AS qtd_faixas, name AS nome_album,
       strftime(released, '%Y-%m-%d %H:%M:%S') AS "data_lançamento", {covers}
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY custkey, page_offset, pos) AS arrival
      FROM {source})
WHERE arrival = 1"""


def mm_ss(ms: str) -> str:
    return (
        f"lpad(CAST(({ms} // 60000) % 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(({ms} // 1000) % 60 AS VARCHAR), 2, '0')"
    )


def silver_tracks(source: str, order: str) -> str:
    return f"""
SELECT id AS id_musica, name AS nome_musica, {mm_ss("duration_ms")} AS duracao_min_seg,
       track_number AS numero_no_album, is_playable AS "Reproduzivel",
       explicit AS conteudo_explicito, duration_ms AS duracao_ms, url AS url_da_musica,
       album_id AS id_album
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY {order}, page_offset, pos, id) AS arrival
      FROM {source})
WHERE arrival = 1"""


#: Pages with the offsets of a paging loop, cut at a parent's first short page.
LANDED = f"""
numbered_album AS (
  SELECT * EXCLUDE (o_orderkey), o_orderkey AS album_key,
         (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) * 2 AS o_orderkey
  FROM (SELECT *, CASE WHEN day(o_orderdate) = 31 THEN 0
                       WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 2 END AS n FROM orders)
), kept_album AS (
  SELECT * FROM numbered_album a
  WHERE NOT EXISTS (SELECT 1 FROM numbered_album b
                    WHERE b.o_custkey = a.o_custkey AND b.n < 2 AND b.o_orderkey < a.o_orderkey)
), landed_album AS (
  SELECT o_custkey AS custkey, o_orderkey AS page_offset, CAST(0 AS BIGINT) AS pos, CAST(album_key AS VARCHAR) AS id,
         'Album ' || album_key AS name, {RELEASE_DATE} AS release_date,
         CAST(floor(o_totalprice / 10000) AS BIGINT) AS total_tracks, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS rank,
         o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AS landed
  FROM kept_album WHERE n >= 1
  UNION ALL
  SELECT o_custkey, o_orderkey, 1, 'collection-' || o_custkey, 'Collection ' || album_key,
         strftime(o_orderdate, '%Y'), 1, CAST(substr(o_orderpriority, 1, 1) AS BIGINT), true
  FROM kept_album WHERE n >= 2
), numbered_track AS (
  SELECT *, (row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1) * 2 AS page_offset,
         CASE WHEN l_quantity = 50 THEN 0 WHEN l_quantity <= 5 THEN 1 ELSE 2 END AS n,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS track_id
  FROM lineitem
), stopped AS (
  SELECT l_orderkey, min(page_offset) AS stop FROM numbered_track WHERE n < 2 GROUP BY l_orderkey
), kept_track AS (
  SELECT t.* FROM numbered_track t LEFT JOIN stopped s USING (l_orderkey) WHERE s.stop IS NULL OR t.page_offset <= s.stop
), landed_track AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS album_id, page_offset, CAST(0 AS BIGINT) AS pos, track_id AS id,
         CASE WHEN l_returnflag = 'R' THEN 'Intro' WHEN l_quantity <> 7 THEN 'Track ' || l_partkey END AS name,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS duration_ms
  FROM kept_track WHERE n >= 1
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), page_offset, 1, track_id || '-b', 'Interlude ' || l_suppkey,
         CAST(l_quantity * 1000 AS BIGINT)
  FROM kept_track WHERE n >= 2
  UNION ALL
  SELECT 'collection-' || c_custkey, 0, 0, 'collected-' || c_custkey, 'Collected ' || c_custkey,
         CAST(round(abs(c_acctbal) * 100) AS BIGINT)
  FROM customer
)"""

ALBUM_ORDER = "custkey, album_offset, album_pos"

ORACLE: dict[str, str] = {
    "merge_pages": f"""
WITH {ALBUM_PAGES}, {albums("album", "kept_album_page")}
SELECT custkey, page_offset, pos, id, name, release_date FROM album""",
    "merge_child_pages": f"""
WITH {ALBUM_PAGES}, {albums("album", "album_page")}, {TRACK_PAGES}, {tracks("track", "kept_track_page")}
SELECT a.custkey, a.page_offset AS album_offset, a.pos AS album_pos,
       t.page_offset, t.pos, t.id, t.name, t.album_id
FROM track t JOIN album a ON a.id = t.album_id
WHERE a.album_group IN ('album', 'single')""",
    "attach_parent_key": f"""
WITH {TRACK_PAGES}, {tracks("track", "track_page")}
SELECT album_id, page_offset, pos, id FROM track""",
    "source_filter": """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'view')""",
    "unwrap_items": """
SELECT l_orderkey, l_linenumber, CAST(0 AS BIGINT) AS pos, CAST(l_partkey AS VARCHAR) AS id,
       CAST(l_quantity AS BIGINT) AS n
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 1, 's' || l_suppkey, l_linenumber
FROM lineitem WHERE l_returnflag IN ('A', 'N')""",
    "flatten_props": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id, event_type, value
FROM events""",
    "rename_select": """
SELECT c_mktsegment AS "segmento do cliente", c_name AS nome, c_custkey AS id FROM customer""",
    "pick_nth_field": """
SELECT doc_id, string_split(text, chr(10))[1] AS line_0, string_split(text, chr(10))[2] AS line_1,
       string_split(text, chr(10))[3] AS line_2
FROM documents""",
    "parse_mixed_date": f"""
SELECT o_orderkey, {RELEASE_DATE} AS release_date,
       strftime({RELEASED}, '%Y-%m-%d %H:%M:%S') AS released
FROM orders""",
    "format_mm_ss": f"""
SELECT l_orderkey, l_linenumber, ms, {mm_ss("ms")} AS mm_ss
FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS ms
      FROM lineitem)""",
    "keep_first_id": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_linenumber, l_partkey, l_suppkey) AS arrival
      FROM lineitem)
WHERE arrival = 1""",
    "keep_first_name": """
SELECT p_name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand,
       arg_min(p_retailprice, p_partkey) AS p_retailprice
FROM part GROUP BY p_name""",
    "keep_first_hot_key": """
SELECT event_type, event_id, user_id, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS arrival
      FROM events)
WHERE arrival = 1""",
    "row_count": """
SELECT 'orders' AS dataset, count(*) AS n FROM orders
UNION ALL
SELECT 'lineitem', count(*) FROM lineitem""",
    "snapshot_roundtrip": """
SELECT o_orderkey, o_custkey, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
FROM orders""",
    "raw_snapshot_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "leftover_attempts": """
SELECT * EXCLUDE (o_orderdate), CAST(count(*) OVER () AS BIGINT) AS n FROM orders""",
    "raw_every_field": """
SELECT user_id, (place // 2) * 2 AS page_offset, place % 2 AS pos, event_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id AS "by", event_type AS "as", value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events)""",
    "compact_documents": "SELECT event_id AS id, event_type AS kind, props FROM events",
    "landed_albums": f"""
WITH {LANDED}
SELECT custkey, page_offset, pos, id, name, release_date, total_tracks, rank FROM landed_album WHERE landed""",
    "landed_tracks": f"""
WITH {LANDED}
SELECT a.custkey, a.page_offset AS album_offset, a.pos AS album_pos, t.page_offset, t.pos, t.id, t.name, t.duration_ms, t.album_id
FROM landed_track t JOIN landed_album a ON a.id = t.album_id WHERE a.landed""",
    "latest_snapshot": "SELECT event_id, user_id, event_type, value, props FROM events",
    "latest_listed": """
SELECT concat_ws('/', event_type, user_id, event_id) AS path,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "modificationTime"
FROM events ORDER BY date_trunc('hour', ts) DESC, path LIMIT 1""",
    "list_files": """
SELECT 'deep' AS folder, strftime(ts, '%Y%m%d') AS day, CAST(1 AS BIGINT) AS n_files
FROM events GROUP BY ALL
UNION ALL
SELECT 'flat', strftime(ts, '%Y%m'), 1 FROM events GROUP BY ALL""",
    "silver_albums": f"WITH {ALBUM_PAGES}, {albums('album', 'album_page')} {silver_albums('album')}",
    "silver_tracks": f"""
WITH {TRACK_PAGES}, {tracks("track", "track_page")} {silver_tracks("track", "l_orderkey")}""",
    "bronze_albums": f"""
WITH {BRONZE}
SELECT custkey, page_offset, pos, id, name, total_tracks, release_date, album_group, n_images, url
FROM bronze_album""",
    "bronze_tracks": f"""
WITH {BRONZE}
SELECT custkey, album_offset, album_pos, page_offset, pos, id, name, track_number, is_playable,
       duration_ms, explicit, url, album_id
FROM bronze_track""",
    "run_albums": f"WITH {BRONZE} {silver_albums('bronze_album')}",
    "run_tracks": f"WITH {BRONZE} {silver_tracks('bronze_track', ALBUM_ORDER)}",
}
