"""SQL for the registered queries, run by DuckDB on the raw input tables (views ``lineitem``, ...).

segments are those for which a point exists, pieces come from the list of a segment's boundaries,
positions from counting what lies below, runs from list functions. Doubles are rounded to 6 places, as in
the Spark results. Stages are materialised, so that the plan does not depend on what reads them.
"""

from __future__ import annotations

# ---- fixture (same rules as sources/fixtures.py) ------------------------------------------
SEGMENTS = r"""
segments AS MATERIALIZED (
  WITH item AS (SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_quantity) * 10 AS len FROM lineitem GROUP BY ALL),
  laid AS (SELECT *, sum(len) OVER (PARTITION BY ok ORDER BY ln) AS um FROM item),
  line AS (
    SELECT o_orderkey AS ok, o_orderpriority AS priority, n_nationkey AS nk,
      CAST(100 + n_regionkey AS VARCHAR) || '.' || lpad(CAST(n_nationkey * 100 AS VARCHAR), 6, '0')
        || regexp_replace(CAST(c_custkey AS VARCHAR), '([0-9])', '.\1\1\1\1\1\1', 'g') AS wscode
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
  keyed AS (SELECT *, min(ok) OVER (PARTITION BY wscode) AS watershed_key FROM line)
  SELECT ok * 10 + ln AS linear_feature_id, ok AS blue_line_key, watershed_key,
    CAST(um - len AS DOUBLE) AS downstream_route_measure, CAST(um AS DOUBLE) AS upstream_route_measure,
    CAST(len AS DOUBLE) AS length_metre, wscode,
    CASE WHEN ok % 17 = 0 THEN NULL WHEN um = len THEN wscode
         ELSE wscode || '.' || lpad(CAST(CAST((um - len) * 200 AS INTEGER) AS VARCHAR), 6, '0') END AS localcode,
    replace(wscode, '.', '-') AS fwa_watershed_code,
    'W' || lpad(CAST(nk AS VARCHAR), 3, '0') AS watershed_group_code, priority
  FROM laid JOIN keyed USING (ok))""".replace("\\\\1", "\\1")

POINTS = """
points AS MATERIALIZED (
  SELECT 'NO' || CAST(l_partkey AS VARCHAR) AS notation_id, CAST(l_partkey AS INTEGER) AS wls_wn_sysid,
    CASE left(priority, 1) WHEN '1' THEN 'FR' WHEN '2' THEN 'FR-EXC' WHEN '3' THEN 'OR' WHEN '4' THEN 'PWS' ELSE 'AR' END AS notation_type,
    CAST(blue_line_key % 200 AS VARCHAR) || CASE blue_line_key % 3 WHEN 0 THEN ' - PWS - 2011/09/29'
         WHEN 1 THEN ' MILE CREEK - FR - 1986/06/23' ELSE ' -FR' END AS notation_description,
    linear_feature_id, blue_line_key,
    downstream_route_measure + (0.05::DOUBLE + 0.1::DOUBLE * (l_partkey % 10)) * length_metre AS downstream_route_measure,
    wscode, localcode, watershed_group_code,
    downstream_route_measure + (0.05::DOUBLE + 0.1::DOUBLE * (l_partkey % 10)) * length_metre AS x,
    CAST((blue_line_key % 7) * 10 + 2 AS DOUBLE) AS y
  FROM segments JOIN (
    SELECT l_partkey, arg_min(l_orderkey * 10 + l_linenumber, (l_orderkey % 1000003 * 7919 % 1000003, l_orderkey * 10 + l_linenumber)) AS linear_feature_id
    FROM lineitem GROUP BY 1)
    USING (linear_feature_id))"""

# The fixture with a second segment at the start of every fifth line (piece-key conflicts).
CONFLICTS = """
conflicts AS MATERIALIZED (
  SELECT * FROM segments
  UNION ALL
  SELECT * REPLACE (linear_feature_id + 8 AS linear_feature_id, upstream_route_measure / 2 AS upstream_route_measure,
                    length_metre / 2 AS length_metre)
  FROM segments WHERE blue_line_key % 5 = 0 AND downstream_route_measure = 0)"""

# Segments and points after the edits of ``incremental_run``.
EDITED = (SEGMENTS.replace("segments AS", "segments_before AS", 1), POINTS.replace("points AS", "points_before AS", 1).replace("FROM segments", "FROM segments_before"), """
segments AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN watershed_group_code = 'W007' AND blue_line_key % 5 = 0 THEN NULL ELSE localcode END AS localcode)
  FROM segments_before WHERE watershed_group_code <> 'W011' OR linear_feature_id % 10 < 4),
points AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN watershed_group_code = 'W007' AND blue_line_key % 5 = 0 THEN NULL ELSE localcode END AS localcode,
    CASE WHEN watershed_group_code = 'W003' AND wls_wn_sysid % 4 = 1 THEN 'PWS' ELSE notation_type END AS notation_type,
    CASE WHEN watershed_group_code = 'W003' AND wls_wn_sysid % 4 = 1 THEN downstream_route_measure + 1.5::DOUBLE ELSE downstream_route_measure END AS downstream_route_measure)
  FROM points_before
  WHERE (watershed_group_code <> 'W011' OR linear_feature_id % 10 < 4) AND NOT (watershed_group_code = 'W003' AND wls_wn_sysid % 4 = 0)
  UNION ALL
  SELECT * REPLACE ('NX' || CAST(wls_wn_sysid AS VARCHAR) AS notation_id, downstream_route_measure + 3 AS downstream_route_measure)
  FROM points_before WHERE watershed_group_code = 'W020' AND wls_wn_sysid % 6 = 0)""")

VERTICES = """
vertices AS MATERIALIZED (
  SELECT linear_feature_id, blue_line_key, seq, downstream_route_measure + seq * length_metre / 2 AS x,
    CAST((blue_line_key % 7) * 10 + CASE WHEN seq = 1 THEN linear_feature_id % 10 ELSE 0 END AS DOUBLE) AS y,
    downstream_route_measure + seq * length_metre / 2 AS m
  FROM (SELECT *, unnest([0, 1, 2]) AS seq FROM segments))"""


def d_up(a: str, b: str) -> str:
    """fwa_upstream(a point, b line) as a theta-join condition (definition D-UP)."""
    return f"""(({b}.blue_line_key = {a}.blue_line_key AND {b}.downstream_route_measure + 1 >= {a}.downstream_route_measure)
  OR ({b}.blue_line_key <> {a}.blue_line_key AND {a}.localcode IS NOT NULL AND {b}.localcode IS NOT NULL AND (
        ({b}.wscode = {a}.wscode AND {b}.localcode >= {a}.localcode)
     OR (starts_with({b}.wscode || '.', {a}.wscode || '.') AND {b}.wscode <> {a}.wscode
         AND ({a}.localcode = {a}.wscode
              OR ({b}.wscode > {a}.localcode AND NOT starts_with({b}.wscode || '.', {a}.localcode || '.')))))))"""


def ssid(blk: str, dm: str) -> str:
    return f"(CAST({blk} AS VARCHAR) || '.' || CAST(CAST(round_even({dm} * 1000, 0) AS BIGINT) AS VARCHAR))"


def work(source: str) -> str:
    """Segments for which a point exists that they lie above, that lies on them, or whose code an
    unplaceable channel has; one per piece key, the smallest id."""
    return f"""
work AS MATERIALIZED (
  SELECT {ssid('b.blue_line_key', 'b.downstream_route_measure')} AS segmented_stream_id, b.*
  FROM {source} b
  WHERE EXISTS (SELECT 1 FROM points a WHERE {d_up('a', 'b')}
    OR (a.blue_line_key = b.blue_line_key
        AND a.downstream_route_measure >= b.downstream_route_measure AND a.downstream_route_measure < b.upstream_route_measure)
    OR (b.localcode IS NULL AND b.blue_line_key <> b.watershed_key AND a.wscode = b.wscode))
  QUALIFY row_number() OVER (PARTITION BY segmented_stream_id ORDER BY b.linear_feature_id) = 1)"""


WORK = work("segments")

BREAK = f"""
bounds AS MATERIALIZED (
  SELECT w.*, list_concat([w.downstream_route_measure], list_sort(list_distinct(coalesce(c.inside, []))), [w.upstream_route_measure]) AS bound
  FROM work w LEFT JOIN (
    SELECT w.linear_feature_id, list(CAST(round(p.downstream_route_measure) AS DOUBLE)) AS inside
    FROM work w JOIN points p USING (blue_line_key)
    WHERE round(p.downstream_route_measure) BETWEEN w.downstream_route_measure AND w.upstream_route_measure
      AND round(p.downstream_route_measure) - w.downstream_route_measure > 1
      AND w.upstream_route_measure - round(p.downstream_route_measure) > 1
    GROUP BY 1) c USING (linear_feature_id)),
spans AS (SELECT *, unnest(range(1, len(bound))) AS nth FROM bounds),
pieces AS MATERIALIZED (
  SELECT {ssid('blue_line_key', 'bound[nth]')} AS segmented_stream_id, segmented_stream_id AS parent_stream_id, nth,
    linear_feature_id, blue_line_key, watershed_key, bound[nth] AS downstream_route_measure,
    bound[nth + 1] AS upstream_route_measure, watershed_group_code, wscode, localcode, fwa_watershed_code
  FROM spans
  QUALIFY row_number() OVER (PARTITION BY {ssid('blue_line_key', 'bound[nth]')} ORDER BY nth > 1, linear_feature_id, nth) = 1)"""

RANKED_POINTS = """
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY wscode DESC NULLS FIRST, localcode DESC NULLS FIRST, downstream_route_measure DESC NULLS FIRST,
    nullif(coalesce(list_position(['FR', 'FR-EXC', 'OR', 'PWS', 'AR'], notation_type), 0), 0) NULLS LAST, notation_id) AS place FROM points)"""


def lists_of(name: str, source: str, condition: str) -> str:
    """The pieces of ``source`` that have points below them, with the list columns."""
    return f"""
{name} AS MATERIALIZED (
  WITH below AS (
    SELECT s.segmented_stream_id, list(p.notation_id ORDER BY p.place) AS ids, list(p.notation_type ORDER BY p.place) AS types
    FROM {source} s JOIN ranked p ON {condition} GROUP BY 1),
  later AS (SELECT segmented_stream_id, ids, types[1] AS primary_notation_type, types[2:] AS t FROM below),
  told AS (
    SELECT *, array_to_string(list_transform(list_filter(list_zip(range(1, len(t) + 1), t),
      lambda e: e[1] = 1 OR e[2] <> t[e[1] - 1]), lambda e: e[2]), ';') AS label FROM later)
  SELECT s.segmented_stream_id, s.linear_feature_id, array_to_string(ids, ';') AS notation_id_list, primary_notation_type,
    CASE WHEN len(t) = 0 THEN NULL WHEN length(label) >= 30 THEN left(label, 28) || '..' ELSE label END AS secondary_notation_types,
    s.fwa_watershed_code, s.blue_line_key, s.downstream_route_measure, s.upstream_route_measure, s.watershed_group_code
  FROM told JOIN {source} s USING (segmented_stream_id))"""


MAIN = f"""
placed AS MATERIALIZED (SELECT * FROM pieces WHERE localcode IS NOT NULL),{lists_of('main_list', 'placed', d_up('p', 's'))}"""

SIDE = f"""
starts AS MATERIALIZED (
  SELECT p.notation_id, s.watershed_group_code, p.downstream_route_measure < 250 OR 3 >= 1
    + (SELECT count(*) FROM pieces q WHERE q.blue_line_key = p.blue_line_key AND q.watershed_group_code = s.watershed_group_code
         AND q.downstream_route_measure < s.downstream_route_measure)
    * (SELECT count(*) FROM points r WHERE r.blue_line_key = p.blue_line_key) AS near_start
  FROM points p JOIN pieces s ON s.linear_feature_id = p.linear_feature_id AND s.nth = 1),
multi_codes AS MATERIALIZED (
  SELECT DISTINCT wscode FROM points a
  WHERE NOT starts_with(wscode || '.', '999.')
    AND EXISTS (SELECT 1 FROM points b WHERE b.wscode = a.wscode AND b.downstream_route_measure - a.downstream_route_measure > 50)),
channels AS MATERIALIZED (
  SELECT * FROM pieces
  WHERE localcode IS NULL AND blue_line_key <> watershed_key AND wscode NOT IN (SELECT wscode FROM multi_codes)
    AND watershed_group_code IN (SELECT watershed_group_code FROM starts WHERE near_start)),{lists_of('side_list', 'channels', '(' + d_up('p', 's') + ') OR p.wscode = s.wscode')}"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


# ---- per-query SQL --------------------------------------------------------------------------
LIST_COLS = ("linear_feature_id, notation_id_list, primary_notation_type, secondary_notation_types, "
             "fwa_watershed_code, blue_line_key, round(downstream_route_measure, 6) AS downstream_route_measure, "
             "round(upstream_route_measure, 6) AS upstream_route_measure")

ON_POINTS = (RANKED_POINTS, WORK, BREAK, MAIN, SIDE)
LISTS = (SEGMENTS, POINTS, *ON_POINTS)
ALL_LIST = f"SELECT {LIST_COLS} FROM main_list UNION ALL SELECT {LIST_COLS} FROM side_list"

SRC_POINTS = """
points_src AS (SELECT notation_id, wls_wn_sysid, notation_type, notation_description, blue_line_key, x, y FROM points)"""

PAIRS = """
vpairs AS MATERIALIZED (
  SELECT v1.linear_feature_id, v1.seq AS i, v1.x AS ax, v1.y AS ay, v1.m AS am, v2.x AS bx, v2.y AS b_y, v2.m AS bm
  FROM vertices v1 JOIN vertices v2 ON v1.linear_feature_id = v2.linear_feature_id AND v2.seq = v1.seq + 1)"""

SNAP = """
cand AS (
  SELECT p.notation_id, s.linear_feature_id, s.blue_line_key, s.downstream_route_measure AS dm, s.length_metre,
    s.wscode, s.localcode, s.watershed_group_code, v.i, p.x AS px, p.y AS py, v.ax, v.ay, v.bx - v.ax AS dx, v.b_y - v.ay AS dy
  FROM points_src p JOIN segments s ON p.blue_line_key = s.blue_line_key
  JOIN vpairs v ON v.linear_feature_id = s.linear_feature_id),
cand_t AS (
  SELECT *, dx*dx + dy*dy AS l2,
    CASE WHEN dx*dx + dy*dy = 0 THEN 0.0
         ELSE least(greatest(((px - ax)*dx + (py - ay)*dy) / (dx*dx + dy*dy), 0.0), 1.0) END AS t
  FROM cand),
cand_d AS (
  SELECT *, sqrt(pow(px - (ax + t*dx), 2) + pow(py - (ay + t*dy), 2)) AS dist, sqrt(l2) AS len FROM cand_t),
per_line AS (
  SELECT notation_id, linear_feature_id, blue_line_key, dm, length_metre, wscode, localcode, watershed_group_code,
    arg_min(i, (dist, i)) AS bi, min(dist) AS dist, sum(len) AS total FROM cand_d GROUP BY ALL),
per_line2 AS (
  SELECT l.*, c.t AS bt, c.len AS blen,
    (SELECT coalesce(sum(c2.len), 0.0) FROM cand_d c2 WHERE c2.notation_id = l.notation_id
       AND c2.linear_feature_id = l.linear_feature_id AND c2.i < l.bi) AS before
  FROM per_line l JOIN cand_d c ON c.notation_id = l.notation_id AND c.linear_feature_id = l.linear_feature_id AND c.i = l.bi),
snapped AS MATERIALIZED (
  SELECT DISTINCT ON (notation_id) notation_id, linear_feature_id, blue_line_key,
    (CASE WHEN total > 0 THEN (before + bt*blen) / total ELSE 0.0 END) * length_metre + dm AS downstream_route_measure,
    wscode, localcode, watershed_group_code, dist AS distance_to_stream
  FROM per_line2 ORDER BY notation_id, dist, linear_feature_id)"""

LOCATE = """
loc AS (
  SELECT DISTINCT ON (p.notation_id) p.notation_id, p.downstream_route_measure AS pm, s.linear_feature_id
  FROM snapped p JOIN segments s ON p.blue_line_key = s.blue_line_key
   AND s.downstream_route_measure <= p.downstream_route_measure AND p.downstream_route_measure <= s.upstream_route_measure
  ORDER BY p.notation_id, s.downstream_route_measure, s.linear_feature_id),
loc_pair AS (
  SELECT DISTINCT ON (l.notation_id) l.notation_id, l.pm, v.*
  FROM loc l JOIN vpairs v ON v.linear_feature_id = l.linear_feature_id AND v.am <= l.pm AND l.pm <= v.bm
  ORDER BY l.notation_id, v.i)"""

CLIP = """
all_pieces AS MATERIALIZED (
  SELECT segmented_stream_id, linear_feature_id, downstream_route_measure AS m0, upstream_route_measure AS m1 FROM main_list
  UNION ALL
  SELECT segmented_stream_id, linear_feature_id, downstream_route_measure, upstream_route_measure FROM side_list),
ends AS (
  SELECT DISTINCT ON (p.segmented_stream_id, e.which) p.segmented_stream_id, e.which, e.m, v.*
  FROM all_pieces p CROSS JOIN LATERAL (VALUES (0, p.m0), (2, p.m1)) AS e(which, m)
  JOIN vpairs v ON v.linear_feature_id = p.linear_feature_id AND v.am <= e.m AND e.m <= v.bm
  ORDER BY p.segmented_stream_id, e.which, v.i),
clip_pts AS (
  SELECT segmented_stream_id, which, m,
    ax + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (m - am) / (bm - am) END) * (bx - ax) AS x,
    ay + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (m - am) / (bm - am) END) * (b_y - ay) AS y
  FROM ends
  UNION ALL
  SELECT p.segmented_stream_id, 1, v.m, v.x, v.y FROM all_pieces p
  JOIN vertices v ON v.linear_feature_id = p.linear_feature_id AND v.m > p.m0 AND v.m < p.m1)"""

# Lines in parts: measure shares of the vertices by id modulo 3, as in the fixture.
GAP_PARTS = """
shares AS (SELECT * FROM (VALUES (1, 0, 0, 0.0), (1, 0, 1, 0.2), (1, 0, 2, 0.45), (1, 1, 0, 0.55), (1, 1, 1, 1.0),
  (2, 0, 0, 0.3), (2, 0, 1, 0.5), (2, 1, 0, 0.5), (2, 1, 1, 0.7), (2, 2, 0, 0.8), (2, 2, 1, 0.9)) AS g(rest, part, seq, share)),
in_parts AS MATERIALIZED (
  SELECT linear_feature_id, part, seq, downstream_route_measure + CAST(share AS DOUBLE) * length_metre AS m,
    CAST((blue_line_key % 7) * 10 + part + seq AS DOUBLE) AS y
  FROM segments JOIN shares ON rest = linear_feature_id % 3
  UNION ALL SELECT linear_feature_id, 0, seq, m, y FROM vertices WHERE linear_feature_id % 3 = 0),
part_pairs AS MATERIALIZED (
  SELECT a.linear_feature_id, a.part, a.seq, a.m AS am, a.y AS ay, b.m AS bm, b.y AS b_y
  FROM in_parts a JOIN in_parts b ON b.linear_feature_id = a.linear_feature_id AND b.part = a.part AND b.seq = a.seq + 1)"""

CLIP_PARTS = """
all_pieces AS MATERIALIZED (
  SELECT segmented_stream_id, linear_feature_id, downstream_route_measure AS m0, upstream_route_measure AS m1 FROM main_list
  UNION ALL
  SELECT segmented_stream_id, linear_feature_id, downstream_route_measure, upstream_route_measure FROM side_list),
covered AS MATERIALIZED (
  SELECT segmented_stream_id, linear_feature_id, part, greatest(m0, low) AS low, least(m1, high) AS high,
    row_number() OVER (PARTITION BY segmented_stream_id ORDER BY part) - 1 AS nth
  FROM all_pieces JOIN (SELECT linear_feature_id, part, min(m) AS low, max(m) AS high FROM in_parts GROUP BY ALL) USING (linear_feature_id)
  WHERE greatest(m0, low) < least(m1, high) OR (greatest(m0, low) = least(m1, high) AND m0 = m1)),
drawn AS (
  SELECT * FROM (
    SELECT DISTINCT ON (c.segmented_stream_id, c.nth, e.place) c.segmented_stream_id, c.nth, e.place, e.m,
      ay + (CASE WHEN bm = am THEN 0.0 ELSE (e.m - am) / (bm - am) END) * (b_y - ay) AS y
    FROM covered c CROSS JOIN LATERAL (VALUES (0, c.low), (2, c.high)) AS e(place, m)
    JOIN part_pairs v ON v.linear_feature_id = c.linear_feature_id AND v.part = c.part AND v.am <= e.m AND e.m <= v.bm
    ORDER BY c.segmented_stream_id, c.nth, e.place, v.seq)
  UNION ALL
  SELECT c.segmented_stream_id, c.nth, 1, v.m, v.y FROM covered c
  JOIN in_parts v ON v.linear_feature_id = c.linear_feature_id AND v.part = c.part AND v.m > c.low AND v.m < c.high)"""

SNAPPED_POINTS = """
points AS (
  SELECT s.notation_id, f.notation_type, f.notation_description, s.linear_feature_id, s.blue_line_key,
    s.downstream_route_measure, s.wscode,
    replace(s.localcode, '300.432687.380566.184025', '300.432687.380566.173400') AS localcode,
    s.watershed_group_code
  FROM snapped s JOIN points_src f ON f.notation_id = s.notation_id)"""

AQUIFER_LINK = """
aquifer_link AS (
  SELECT CAST(a.p_partkey AS INTEGER) AS aquifer_id, n.notation_id, n.notation_description,
    1 AS n_polygons, round(CAST(a.p_partkey AS DOUBLE) + CAST(a.p_size AS DOUBLE), 6) AS x_max
  FROM points n JOIN part a ON CAST(a.p_partkey AS INTEGER) = TRY_CAST(split_part(n.notation_description, ' - ', 1) AS INTEGER)
  WHERE regexp_matches(n.notation_description, '^[0-9]+ -.*$'))"""


def _width(table: str, src: str, col: str, limit: int) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, {limit} AS width_limit, "
            f"CAST(coalesce(max(length({col})), 0) AS INTEGER) AS max_length, "
            f"CAST(count(*) FILTER (WHERE length({col}) > {limit}) AS BIGINT) AS n_over FROM {src}")


def _dup(name: str, src: str, key: str) -> str:
    return (f"SELECT '{name}' AS table_name, CAST(sum(c) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys, "
            f"CAST(count(*) FILTER (WHERE c > 1) AS BIGINT) AS n_duplicated_keys "
            f"FROM (SELECT {key}, count(*) AS c FROM {src} GROUP BY {key})")


# Columns of the input tables by kind, in table order.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:double c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal:double",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:double",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:double o_orderdate:timestamp o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:double l_extendedprice:double l_discount:double l_tax:double "
                "l_returnflag l_linestatus l_shipdate:timestamp",
    "events": "event_id ts:timestamp user_id event_type value:double props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding:doubles label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _canonical(c: str, kind: str) -> str:
    if kind == "double":
        return f"replace(format('{{:a}}', CAST({c} AS DOUBLE)), 'p+', 'p')"
    if kind == "timestamp":
        return f"CAST(epoch_us({c}) AS VARCHAR)"
    if kind == "doubles":
        return f"array_to_string(list_transform({c}, lambda x: {_sized('x', 'double')}), '')"
    return f"CAST({c} AS VARCHAR)"


def _sized(c: str, kind: str) -> str:
    text = _canonical(c, kind)
    return f"CASE WHEN {c} IS NULL THEN 'N' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"


def _row_hash(columns: str, alias: str = "") -> str:
    parts = [c.partition(":") for c in columns.split()]
    return "md5(" + " || ".join(_sized(alias + name, kind) for name, _, kind in parts) + ")"


def _fingerprint(src: str, columns: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    halves = ", ".join(f"CAST(coalesce(sum(CAST(('0x' || substr(h, {at}, 16))::UBIGINT AS DECIMAL(38,0))), 0) AS DECIMAL(38,0)) AS hash_{name}"
                       for at, name in ((1, "high"), (17, "low")))
    by = f" GROUP BY {group}" if group else ""
    return f"SELECT {g}CAST(count(*) AS BIGINT) AS n_rows, {halves} FROM (SELECT {g}{_row_hash(columns)} AS h FROM {src}){by}"


ETAG = "n_rows || ':' || CAST(hash_high AS VARCHAR) || ':' || CAST(hash_low AS VARCHAR) AS etag"
OBJECTS = """
objects AS (SELECT *, 'orders/' || o_orderpriority || '.parquet' AS path FROM orders),
previous AS (SELECT * FROM objects WHERE NOT (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))),"""
CHANGE = OBJECTS + f"""
cur AS MATERIALIZED (SELECT path, {ETAG} FROM ({_fingerprint('objects', TABLE_COLUMNS['orders'], 'path')})),
state AS MATERIALIZED (SELECT path, 'prod' AS env, {ETAG} FROM ({_fingerprint('previous', TABLE_COLUMNS['orders'], 'path')})),
envs AS (SELECT * FROM (VALUES ('prod'), ('test')) AS e(env)),
status AS (
  SELECT c.path, e.env, c.etag AS current_etag, s.etag AS cached_etag,
    (s.etag IS NULL OR s.etag <> c.etag) AS has_changed
  FROM cur c CROSS JOIN envs e LEFT JOIN state s ON s.path = c.path AND s.env = e.env)"""

URL_PATH = ("CASE WHEN starts_with(replace(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/en', ''), '/') "
            "THEN substring(replace(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/en', ''), 2) "
            "ELSE replace(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/en', '') END")

AFTER = """
bef AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
aft AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 0.01::DOUBLE ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
    CASE WHEN o_orderpriority = '1-URGENT' THEN '1-URGENT*' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT o_orderkey, o_custkey + 1, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM')"""

LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag"

OTHER_ORDER_COLUMNS = TABLE_COLUMNS["orders"].partition(" ")[2]


def _renamed(ctes: str) -> str:
    """The same stages over the conflicting segments, under other names."""
    for name in ("work", "bounds", "spans", "pieces"):
        ctes = ctes.replace(f"{name} AS ", f"more_{name} AS ").replace(f"FROM {name}", f"FROM more_{name}")
    return ctes


ORACLE = {
    "points_src": with_ctes(SEGMENTS, POINTS) +
        " SELECT notation_id, notation_type, notation_description, blue_line_key, wls_wn_sysid, round(x, 6) AS x, round(y, 6) AS y,"
        " round(49 + y / 1000, 6) AS latitude, round(-125 + x / 1000, 6) AS longitude FROM points",
    "segments_src": with_ctes(SEGMENTS) +
        " SELECT linear_feature_id, blue_line_key, watershed_key, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " round(upstream_route_measure, 6) AS upstream_route_measure, round(length_metre, 6) AS length_metre, wscode, localcode,"
        " fwa_watershed_code, watershed_group_code FROM segments",
    "group_list": with_ctes(SEGMENTS, POINTS) + " SELECT DISTINCT watershed_group_code FROM points ORDER BY 1",
    "output_contract": with_ctes(*LISTS, f"all_list AS ({ALL_LIST})", AQUIFER_LINK) + " " + " UNION ALL ".join(
        [_width("streams", "all_list", c, n) for c, n in
         [("notation_id_list", 200), ("primary_notation_type", 12), ("secondary_notation_types", 30),
          ("fwa_watershed_code", 150)]] +
        [_width("aquifers", "aquifer_link", c, n) for c, n in [("notation_id", 10), ("notation_description", 140)]]),
    "key_check": with_ctes(SEGMENTS, POINTS, WORK, BREAK, CONFLICTS, _renamed(work("conflicts") + "," + BREAK)) + " " + " UNION ALL ".join([
        _dup("segments", "segments", "linear_feature_id"), _dup("notations", "points", "notation_id"),
        _dup("pieces", "pieces", "segmented_stream_id"),
        "SELECT 'pieces of conflicting segments' AS table_name, count(*) AS n_rows, count(*) AS n_keys, CAST(0 AS BIGINT) AS n_duplicated_keys FROM more_pieces",
        _dup("lineitem", "lineitem", "l_orderkey, l_linenumber")]),
    "override_rules": with_ctes(SEGMENTS, POINTS) + """
SELECT notation_id, coalesce((SELECT min(r.wscode) FROM points r WHERE r.localcode = p.localcode
  AND right(r.notation_id, 1) IN ('0', '2', '4', '6', '8')), p.localcode) AS localcode FROM points p""",
    "key_conflicts": with_ctes(SEGMENTS, POINTS, CONFLICTS, work("conflicts"), BREAK) +
        " SELECT segmented_stream_id, linear_feature_id, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " round(upstream_route_measure, 6) AS upstream_route_measure FROM pieces",
    "input_report": with_ctes(SEGMENTS, POINTS) + """,
raw AS (
  SELECT p.notation_id, CASE WHEN o.o_orderstatus = 'P' THEN 'XX' ELSE p.notation_type END AS notation_type,
    CASE WHEN o.o_orderpriority = '5-LOW' THEN o.o_custkey * 1000 + 7 ELSE p.blue_line_key END AS blue_line_key
  FROM points p JOIN orders o ON o.o_orderkey = p.blue_line_key)
SELECT notation_id, 'no segment on line' AS problem FROM raw r
WHERE blue_line_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM segments s WHERE s.blue_line_key = r.blue_line_key)
UNION ALL SELECT notation_id, 'no line key' FROM raw WHERE blue_line_key IS NULL
UNION ALL SELECT notation_id, CASE WHEN notation_type IS NULL THEN 'null type' ELSE 'unknown type' END FROM raw
  WHERE notation_type IS NULL OR notation_type NOT IN ('FR', 'FR-EXC', 'OR', 'PWS', 'AR')
UNION ALL SELECT notation_id, 'duplicate id' FROM raw GROUP BY notation_id HAVING count(*) > 1""",
    "segment_key": with_ctes(SEGMENTS) +
        f" SELECT linear_feature_id, {ssid('blue_line_key', 'downstream_route_measure')} AS segmented_stream_id FROM segments",
    "code_descendant": with_ctes(SEGMENTS, POINTS) +
        " SELECT a.notation_id, CAST(count(*) AS BIGINT) AS n_segments FROM points a JOIN segments b"
        " ON starts_with(b.wscode || '.', a.wscode || '.') GROUP BY a.notation_id",
    "insert_ignore": f"""WITH
target AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
           FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1),
inc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
        FROM lineitem) WHERE rn = 1)
SELECT {LINE_COLS} FROM target
UNION ALL
SELECT {LINE_COLS} FROM inc i WHERE NOT EXISTS
  (SELECT 1 FROM target t WHERE t.l_orderkey = i.l_orderkey AND t.l_linenumber = i.l_linenumber)""",
    "first_per_key": "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice,"
                     " o_orderpriority FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
    "upstream_pairs": with_ctes(SEGMENTS, POINTS) +
        f" SELECT a.notation_id, b.linear_feature_id FROM points a JOIN segments b ON {d_up('a', 'b')}",
    "upstream_segments": with_ctes(SEGMENTS, POINTS) +
        f" SELECT DISTINCT b.linear_feature_id FROM points a JOIN segments b ON {d_up('a', 'b')}",
    "downstream_points": with_ctes(SEGMENTS, POINTS, RANKED_POINTS) +
        f" SELECT a.linear_feature_id, b.notation_id, rank() OVER (PARTITION BY a.linear_feature_id ORDER BY b.place)"
        f" AS position FROM segments a JOIN ranked b ON {d_up('b', 'a')}",
    "point_on_segment": with_ctes(SEGMENTS, POINTS) +
        " SELECT a.notation_id, b.linear_feature_id FROM points a JOIN segments b ON a.blue_line_key = b.blue_line_key"
        " AND a.downstream_route_measure >= b.downstream_route_measure AND a.downstream_route_measure < b.upstream_route_measure",
    "side_channel_candidates": with_ctes(SEGMENTS, POINTS) +
        " SELECT a.notation_id, b.linear_feature_id FROM points a JOIN segments b ON a.wscode = b.wscode"
        " AND b.localcode IS NULL AND b.blue_line_key <> b.watershed_key",
    "work_segments": with_ctes(SEGMENTS, POINTS, WORK) +
        " SELECT linear_feature_id, blue_line_key, watershed_key, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " round(upstream_route_measure, 6) AS upstream_route_measure, watershed_group_code, segmented_stream_id FROM work",
    "break_segments": with_ctes(SEGMENTS, POINTS, WORK, BREAK) +
        " SELECT segmented_stream_id, linear_feature_id, blue_line_key, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " round(upstream_route_measure, 6) AS upstream_route_measure FROM pieces",
    "next_break": with_ctes(SEGMENTS, POINTS, WORK, BREAK) +
        " SELECT parent_stream_id AS segmented_stream_id, linear_feature_id, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " round(upstream_route_measure, 6) AS upstream_route_measure FROM pieces WHERE nth > 1",
    "point_id_list": with_ctes(SEGMENTS, POINTS, RANKED_POINTS, WORK, BREAK, MAIN) +
        " SELECT segmented_stream_id, notation_id_list FROM main_list",
    "primary_type": with_ctes(SEGMENTS, POINTS, RANKED_POINTS, WORK, BREAK, MAIN) +
        " SELECT segmented_stream_id, primary_notation_type FROM main_list",
    "run_collapse": "SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type,"
                    " lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)"
                    " WHERE prev IS NULL OR prev <> event_type",
    "stream_list": with_ctes(SEGMENTS, POINTS, RANKED_POINTS, WORK, BREAK, MAIN) + f" SELECT {LIST_COLS} FROM main_list",
    "start_of_route": with_ctes(*LISTS) + " SELECT notation_id, watershed_group_code, near_start FROM starts",
    "multi_point_codes": with_ctes(*LISTS) + " SELECT wscode FROM multi_codes",
    "side_channels": with_ctes(*LISTS) + f" SELECT {LIST_COLS} FROM side_list",
    "stream_list_all": with_ctes(*LISTS) + " " + ALL_LIST,
    "nearest_segment": with_ctes(SEGMENTS, POINTS, SRC_POINTS, VERTICES, PAIRS, SNAP) +
        " SELECT notation_id, linear_feature_id, round(distance_to_stream, 6) AS distance_to_stream FROM snapped",
    "snap_measure": with_ctes(SEGMENTS, POINTS, SRC_POINTS, VERTICES, PAIRS, SNAP) +
        " SELECT notation_id, linear_feature_id, blue_line_key, round(downstream_route_measure, 6) AS downstream_route_measure,"
        " wscode, localcode, watershed_group_code FROM snapped",
    "locate_along": with_ctes(SEGMENTS, POINTS, SRC_POINTS, VERTICES, PAIRS, SNAP, LOCATE) +
        " SELECT notation_id,"
        " round(ax + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (pm - am) / (bm - am) END) * (bx - ax), 6) AS x,"
        " round(ay + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (pm - am) / (bm - am) END) * (b_y - ay), 6) AS y FROM loc_pair",
    "locate_sql": with_ctes(SEGMENTS, POINTS, SRC_POINTS, VERTICES, PAIRS, SNAP) + """
SELECT p.notation_id,
  round(ax + (CASE WHEN bm = am THEN 0.0 ELSE (p.downstream_route_measure - am) / (bm - am) END) * (bx - ax), 6) AS x,
  round(ay + (CASE WHEN bm = am THEN 0.0 ELSE (p.downstream_route_measure - am) / (bm - am) END) * (b_y - ay), 6) AS y
FROM snapped p JOIN segments s USING (blue_line_key) JOIN vpairs v ON v.linear_feature_id = s.linear_feature_id
WHERE p.downstream_route_measure BETWEEN am AND bm
QUALIFY row_number() OVER (PARTITION BY p.notation_id ORDER BY bm, s.linear_feature_id, i) = 1""",
    "clip_lines": with_ctes(*LISTS, VERTICES, PAIRS, CLIP) +
        " SELECT segmented_stream_id, CAST(row_number() OVER (PARTITION BY segmented_stream_id ORDER BY which, m) - 1 AS INTEGER)"
        " AS vertex_index, round(x, 6) AS x, round(y, 6) AS y FROM clip_pts",
    "clip_parts": with_ctes(*LISTS, VERTICES, GAP_PARTS, CLIP_PARTS) +
        " SELECT segmented_stream_id, CAST(nth AS INTEGER) AS part, CAST(row_number() OVER (PARTITION BY segmented_stream_id, nth"
        " ORDER BY place, m) - 1 AS INTEGER) AS vertex_index, round(m, 6) AS x, round(y, 6) AS y FROM drawn",
    "locate_parts": with_ctes(SEGMENTS, POINTS, VERTICES, GAP_PARTS) + """
SELECT DISTINCT ON (p.notation_id) p.notation_id, round(p.downstream_route_measure, 6) AS x,
  round(ay + (CASE WHEN bm = am THEN 0.0 ELSE (p.downstream_route_measure - am) / (bm - am) END) * (b_y - ay), 6) AS y
FROM points p JOIN segments s ON s.blue_line_key = p.blue_line_key
JOIN part_pairs v ON v.linear_feature_id = s.linear_feature_id AND v.am <= p.downstream_route_measure AND p.downstream_route_measure <= v.bm
ORDER BY p.notation_id, s.downstream_route_measure, s.linear_feature_id, v.part, v.seq""",
    "snapped_table": with_ctes(SEGMENTS, POINTS, SRC_POINTS, VERTICES, PAIRS, SNAP, LOCATE) + """
SELECT s.notation_id, f.notation_type, f.notation_description, s.linear_feature_id, s.blue_line_key, s.wscode, s.localcode,
  s.watershed_group_code, f.wls_wn_sysid, round(s.downstream_route_measure, 6) AS downstream_route_measure,
  round(s.distance_to_stream, 6) AS distance_to_stream,
  round(ax + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (pm - am) / (bm - am) END) * (bx - ax), 6) AS x,
  round(ay + (CASE WHEN bm - am = 0 THEN 0.0 ELSE (pm - am) / (bm - am) END) * (b_y - ay), 6) AS y
FROM snapped s JOIN points_src f USING (notation_id) LEFT JOIN loc_pair l USING (notation_id)""",
    "stream_export": with_ctes(*LISTS, VERTICES, PAIRS, CLIP, """
drawn AS (SELECT segmented_stream_id, list(x ORDER BY which, m) AS xs, list(y ORDER BY which, m) AS ys FROM clip_pts GROUP BY 1),
all_list AS (SELECT * FROM main_list UNION ALL SELECT * FROM side_list)""") + """
SELECT linear_feature_id, notation_id_list, primary_notation_type, secondary_notation_types, fwa_watershed_code,
  CAST(blue_line_key AS INTEGER) AS blue_line_key, CAST(len(xs) AS INTEGER) AS n_vertices, round(xs[1], 6) AS x_first,
  round(ys[1], 6) AS y_first, round(xs[-1], 6) AS x_last, round(ys[-1], 6) AS y_last
FROM all_list JOIN drawn USING (segmented_stream_id)""",
    "incremental_run": with_ctes(*EDITED, *ON_POINTS) + " " + ALL_LIST,
    "full_run": with_ctes(SEGMENTS, POINTS.replace("points AS", "fixture_points AS", 1),
                          SRC_POINTS.replace("FROM points)", "FROM fixture_points)"), VERTICES, PAIRS, SNAP, SNAPPED_POINTS,
                          *ON_POINTS) + " " + ALL_LIST,
    "attr_link": with_ctes(SEGMENTS, POINTS, AQUIFER_LINK) + " SELECT * FROM aquifer_link ORDER BY aquifer_id, notation_description",
    "table_fingerprint": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, n_rows, hash_high, hash_low FROM ({_fingerprint(t, cols)})" for t, cols in TABLE_COLUMNS.items()),
    "fingerprint_edits": """
SELECT edit, n, seen FROM (VALUES ('price', true), ('date', true), ('null swap', true), ('order of rows', false)) AS e(edit, seen),
  (SELECT count(*) AS n FROM orders)
UNION ALL SELECT 'embedding', (SELECT count(*) FROM embeddings), true""".replace("edit, n, seen", "edit, CAST(n AS BIGINT) AS n_rows, seen", 1),
    "points_json": with_ctes(SEGMENTS, POINTS) + """,
told AS (
  SELECT *, CASE WHEN wls_wn_sysid % 11 = 0 OR wls_wn_sysid % 19 = 0 THEN 'malformed' WHEN wls_wn_sysid % 13 = 0 THEN 'null notation_id' END AS why,
    unnest(CASE WHEN wls_wn_sysid % 17 = 0 THEN [1, 2] ELSE [1] END) AS nth FROM points)
SELECT coalesce(why, CASE WHEN nth = 2 THEN 'repeated key' END) AS reason, wls_wn_sysid,
  CASE WHEN why IS NULL THEN notation_id END AS notation_id,
  CASE WHEN why IS DISTINCT FROM 'malformed' THEN notation_type END AS notation_type,
  CASE WHEN why IS DISTINCT FROM 'malformed' THEN notation_description END AS notation_description,
  CASE WHEN why IS DISTINCT FROM 'malformed' THEN blue_line_key END AS blue_line_key,
  CASE WHEN why IS DISTINCT FROM 'malformed' THEN round(x, 6) END AS x FROM told""",
    "file_fingerprints": f"""
WITH files AS (
  SELECT *, 'orders/' || left(o_orderpriority, 1) AS folder FROM orders
  WHERE left(o_orderpriority, 1) IN ('1', '3', '4') OR (left(o_orderpriority, 1) = '2' AND o_orderstatus <> 'P'))
SELECT *, folder IN ('orders/2', 'orders/4') AS hashed FROM ({_fingerprint('files', TABLE_COLUMNS['orders'], 'folder')})""",
    "object_listing": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{t}.parquet' AS object_name, true AS exists, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in TABLE_COLUMNS)
        + " UNION ALL SELECT 'retired', 'retired.parquet', false, NULL",
    "change_status": "WITH " + CHANGE + " SELECT * FROM status",
    "change_sync": "WITH " + CHANGE + """,
test AS (SELECT path, 'test' AS env, etag FROM state WHERE path < 'orders/4'),
synced AS (
  SELECT path, env, etag FROM test
  UNION ALL SELECT path, 'prod' AS env, etag FROM cur)
SELECT * FROM synced WHERE NOT (path = 'orders/3-MEDIUM.parquet' AND env = 'test')""",
    "change_route": "WITH " + CHANGE + """
SELECT o.o_orderkey, o.path,
  CASE WHEN s.has_changed THEN 'CHANGES' ELSE 'NO_CHANGES' END AS port, 'orders.parquet' AS source_file
FROM objects o JOIN status s ON s.path = o.path AND s.env = 'prod'""",
    "url_to_path": f"""SELECT page_id, object_path,
  regexp_replace(object_path, '^(.*[^/.][^/]*)\\.[^./]*$', '\\1') || '.prod.filechange' AS cache_key
FROM (SELECT page_id, {URL_PATH} AS object_path FROM pages)""",
    "snapshot_diff": "WITH " + AFTER.strip("\n") + f"""
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM bef b FULL OUTER JOIN aft a ON b.o_orderkey = a.o_orderkey
WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL
   OR {_row_hash(OTHER_ORDER_COLUMNS, 'b.')} <> {_row_hash(OTHER_ORDER_COLUMNS, 'a.')}""",
    "sink_refresh": with_ctes(*LISTS) + " " + ALL_LIST,
    "sink_by_group": with_ctes(*LISTS, "all_list AS (SELECT * FROM main_list UNION ALL SELECT * FROM side_list)",
        "kept AS (SELECT * FROM all_list WHERE watershed_group_code <= 'W012' AND watershed_group_code <> 'W005'"
        " UNION ALL SELECT * REPLACE ('earlier;' || notation_id_list AS notation_id_list) FROM all_list WHERE watershed_group_code > 'W012')") +
        f" SELECT {LIST_COLS} FROM kept",
    "gated_run": with_ctes(*LISTS, "all_list AS (SELECT * FROM main_list UNION ALL SELECT * FROM side_list)") +
        f" SELECT {LIST_COLS}, 'prod' AS env FROM all_list"
        f" UNION ALL SELECT {LIST_COLS}, 'test' AS env FROM all_list WHERE watershed_group_code = 'W001'",
    "group_output": with_ctes(*LISTS) + f" SELECT {LIST_COLS} FROM main_list WHERE watershed_group_code = 'W001'"
                    f" UNION ALL SELECT {LIST_COLS} FROM side_list WHERE watershed_group_code = 'W001'",
    "ingest_available_now": "SELECT event_id, epoch_us(ts) AS ts_micros, user_id, event_type, round(value, 6) AS value, props FROM events",
}
