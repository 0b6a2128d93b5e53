"""Independent SQL for each registered query (DuckDB dialect, same Parquet tables).

The SQL recomputes the derived inputs from the base tables and the result with plain
SQL; it shares no code path with the Spark side except the fixed constants.
"""

from __future__ import annotations

from tessera.sources.files import MACHINE_COLUMNS
from tessera.functions.scalars import FLOAT_TEXT, INT_TEXT, NAN_TEXT, NEG_INF_TEXT, POS_INF_TEXT


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {q(r'^\s+|\s+$')}, '', 'g')"


def parse_float(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, {q(FLOAT_TEXT)}) THEN TRY_CAST(replace({strip_ws(x)}, '_', '') AS DOUBLE) "
        f"WHEN regexp_matches({x}, {q(POS_INF_TEXT)}) THEN CAST('inf' AS DOUBLE) "
        f"WHEN regexp_matches({x}, {q(NEG_INF_TEXT)}) THEN CAST('-inf' AS DOUBLE) "
        f"WHEN regexp_matches({x}, {q(NAN_TEXT)}) THEN CAST('nan' AS DOUBLE) END)"
    )


def parse_int(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, {q(INT_TEXT)}) THEN TRY_CAST(replace({strip_ws(x)}, '_', '') AS BIGINT) END)"


def hour_of(t: str) -> str:
    return f"(CASE WHEN length({t}) <= 2 THEN {t} ELSE substr({t}, 1, length({t}) - 2) END)"


def delay_flag(x: str) -> str:
    d = parse_float(x)
    return f"(CASE WHEN coalesce({d} > 15 AND NOT isnan({d}), false) THEN 'Yes' ELSE 'No' END)"


def pad_right(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) >= {n} THEN {x} ELSE rpad({x}, {n}, '0') END)"


def pad_left(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


HHMM = "CAST(hour(ts) * 100 + minute(ts) AS VARCHAR)"

WEATHER_CTE = f"""weather AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, 'AP' || CAST(event_id % 10 AS VARCHAR) AS airport,
         {HHMM} AS time, CASE WHEN event_id % 17 = 0 THEN 'nan' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS temperature
  FROM events)"""

WEATHER_DICT_CTE = f"""wdict AS (
  SELECT airport, date, {hour_of('time')} AS hour, max({parse_float('temperature')}) AS temperature
  FROM weather WHERE NOT isnan({parse_float('temperature')}) GROUP BY ALL)"""

_BASE = "CAST(CAST(floor(value) AS BIGINT) - 100 AS VARCHAR)"
FLIGHTS_CTE = f"""flights AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, 'AL' || CAST(user_id % 7 AS VARCHAR) AS airline,
         json_extract_string(props, '$.k') AS destination, 'AP' || CAST(user_id % 10 AS VARCHAR) AS origin,
         {HHMM} AS dep_time,
         CASE event_id % 6 WHEN 0 THEN {_BASE} WHEN 1 THEN '' WHEN 2 THEN {_BASE} || 'd'
              WHEN 3 THEN ' ' || {_BASE} || '.5 ' WHEN 4 THEN 'nan' ELSE 'inf' END AS dep_delay,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE ((event_id * 7919) % 36001 - 18000) / CAST(100 AS DOUBLE) END AS lon_d,
         ((event_id * 104729) % 18001 - 9000) / CAST(100 AS DOUBLE) AS lat_d,
         CASE WHEN event_id % 3 = 0 THEN 'C' || CAST(event_id * 1000003 AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS code
  FROM events)"""

#: Fixed value: the digits of a geohash.
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash_rows(source: str, key: str, length: int = 12) -> str:
    """Select of ``key`` and ``geohash`` by halving the ranges bit by bit, longitude first;
    ``source`` gives key, lat and lon. A value on the middle belongs to the lower half."""
    rows = f"(SELECT {key}, lat, lon, -180.0::DOUBLE AS x0, 180.0::DOUBLE AS x1, -90.0::DOUBLE AS y0, 90.0::DOUBLE AS y1, '' AS bits FROM {source})"
    for bit in range(5 * length):
        v, lo, hi = ("lon", "x0", "x1") if bit % 2 == 0 else ("lat", "y0", "y1")
        middle = f"({lo} + {hi}) / 2"
        rows = (
            f"(SELECT * REPLACE (CASE WHEN {v} > {middle} THEN {middle} ELSE {lo} END AS {lo}, CASE WHEN {v} > {middle} THEN {hi} ELSE {middle} END AS {hi}, "
            f"bits || CASE WHEN {v} > {middle} THEN '1' ELSE '0' END AS bits) FROM {rows})"
        )
    digits = " || ".join(f"substr('{GEOHASH_DIGITS}', 1 + CAST(('0b' || substr(bits, {5 * i + 1}, 5)) AS INTEGER), 1)" for i in range(length))
    return f"SELECT {key}, {digits} AS geohash FROM {rows}"


HASHED_CTE = f"""located AS (SELECT event_id, lat_d AS lat, lon_d AS lon FROM flights WHERE lat_d IS NOT NULL AND lon_d IS NOT NULL),
hashed AS ({geohash_rows('located', 'event_id')})"""

ENRICHED_CTE = f"""enriched AS (
  SELECT f.date, f.dep_time, f.airline, f.origin,
         coalesce(h.geohash, 'None') AS geohash,
         f.origin || '-->' || f.destination AS route,
         {delay_flag('f.dep_delay')} AS delay_flag,
         {pad_right('f.code', 10)} AS code,
         w.temperature AS temperature
  FROM flights f LEFT JOIN hashed h USING (event_id) LEFT JOIN wdict w
    ON w.airport = f.origin AND w.date = f.date AND w.hour = {hour_of('f.dep_time')})"""

FAMILY_A = "WITH " + ",\n".join([WEATHER_CTE, WEATHER_DICT_CTE, FLIGHTS_CTE, HASHED_CTE, ENRICHED_CTE]) + "\n"


SQL: dict[str, str] = {}

SQL["weather_max_by_key"] = f"""WITH {WEATHER_CTE}
SELECT airport, date, {hour_of('time')} AS hour, max({parse_float('temperature')}) AS max_temp,
       count(*) AS n_readings
FROM weather WHERE NOT isnan({parse_float('temperature')}) GROUP BY ALL"""

SQL["weather_max_text_legacy"] = f"""WITH {WEATHER_CTE}
SELECT airport, date, {hour_of('time')} AS hour, max(temperature) AS max_temp_text,
       {parse_float('max(temperature)')} AS max_temp
FROM weather GROUP BY ALL"""

SQL["enrich_with_default"] = FAMILY_A + """SELECT date, dep_time, airline, origin, geohash, route, delay_flag, code,
       coalesce(temperature, 9999.0) AS temperature FROM enriched"""

SQL["daily_max_converted"] = FAMILY_A + f"""SELECT airline, date, {r6('max((temperature - 32.0) * 5.0 / 9.0)')} AS max_temp_c
FROM enriched WHERE temperature IS NOT NULL GROUP BY ALL"""

SQL["delay_flag_counts"] = FAMILY_A + "SELECT airline, delay_flag, count(*) AS n_flights FROM enriched GROUP BY ALL"
SQL["count_by_key"] = FAMILY_A + "SELECT airline, count(*) AS n_flights FROM enriched GROUP BY ALL"
SQL["count_by_key_day"] = FAMILY_A + "SELECT airline, date, count(*) AS n_flights FROM enriched GROUP BY ALL"

SQL["distinct_raw_lines"] = """SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS date, l_returnflag AS flag,
       l_linestatus || ',' || l_returnflag AS status, CAST(l_orderkey AS VARCHAR) AS orderkey,
       CAST(l_partkey AS VARCHAR) AS partkey, CAST(l_suppkey AS VARCHAR) AS suppkey,
       CAST(l_linenumber AS VARCHAR) AS linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price
FROM lineitem"""

_LAT = "((c_custkey * 37) % 18001 - 9000) / CAST(100 AS DOUBLE)"
_LON = "((c_custkey * 53) % 36001 - 18000) / CAST(100 AS DOUBLE)"
SQL["geohash_points"] = f"""WITH p AS (SELECT c_custkey, {_LAT} AS lat, {_LON} AS lon FROM customer), h AS ({geohash_rows('p', 'c_custkey')})
SELECT p.*, h.geohash FROM p JOIN h USING (c_custkey)"""

SQL["route_and_pad"] = f"""SELECT c.c_custkey, n.n_name || '-->' || c.c_mktsegment AS route,
       {pad_right('CAST(c.c_custkey AS VARCHAR)', 10)} AS code_short, {pad_right('c.c_name', 10)} AS code_long
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

# ------------------------------------------------------------------ family B
MAIL_CTE = """mail AS (
  SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(l.l_shipdate AS DATE)) AS BIGINT) * 86400000
           + CAST(l.l_linenumber AS BIGINT) * 3600000 + (l.l_partkey % 60) * 60000
           + CASE WHEN l.l_orderkey % 4 = 0 THEN 0 ELSE (l.l_suppkey * 37 + l.l_linenumber) % 1000 END AS ms,
         '<' || CAST(l.l_orderkey AS VARCHAR) || '.' || CAST(l.l_linenumber AS VARCHAR) || '@mail>' AS message_id,
         cn.n_name AS sender_raw,
         CASE l.l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN sn.n_name WHEN 2 THEN sn.n_name || '|' || cn.n_name
              ELSE sn.n_name || '|' || sn.n_name || '|' || cn.n_name END AS recipients_raw
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey),
records AS (
  SELECT CASE WHEN ms % 1000 = 0 THEN strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp_iso,
         message_id AS "message identifier", lower(sender_raw) AS sender,
         string_split(lower(recipients_raw), '|') AS recipients, '' AS topic, 'mail' AS email
  FROM mail)"""

SQL["mail_parse"] = f"""WITH {MAIL_CTE}
SELECT timestamp_iso, "message identifier", sender, array_to_string(recipients, '|') AS recipients_text,
       CAST(len(recipients) AS BIGINT) AS n_recipients, recipients[1] AS first_recipient,
       recipients[len(recipients)] AS last_recipient, topic, email
FROM records"""

_SENT = "sent AS (SELECT sender AS usr, count(*) AS sent FROM records GROUP BY 1)"
_RECV = "recv AS (SELECT r AS usr, count(*) AS received FROM records, unnest(recipients) AS t(r) GROUP BY 1)"
SQL["mail_user_stats"] = f"""WITH {MAIL_CTE}, {_SENT}, {_RECV}
SELECT s.usr AS "user", coalesce(r.received, 0) AS received, s.sent AS sent
FROM sent s LEFT JOIN recv r ON s.usr = r.usr"""

SQL["mail_user_stats_all"] = f"""WITH {MAIL_CTE}, {_SENT}, {_RECV}
SELECT coalesce(s.usr, r.usr) AS "user", coalesce(r.received, 0) AS received, coalesce(s.sent, 0) AS sent
FROM sent s FULL OUTER JOIN recv r ON s.usr = r.usr"""

SQL["mail_edges_all"] = f"""WITH {MAIL_CTE}
SELECT sender AS src, r AS dst, count(*) AS weight FROM records, unnest(recipients) AS t(r) GROUP BY ALL"""

SQL["mail_edges_last"] = f"""WITH {MAIL_CTE}
SELECT sender AS src, recipients[len(recipients)] AS dst, count(*) AS weight FROM records GROUP BY ALL"""

# ------------------------------------------------------------------ family C
DOCS_CTE = """docs AS (
  SELECT CAST(event_id AS VARCHAR) AS _id,
         CASE WHEN event_id % 13 = 0 THEN upper('web-' || CAST(user_id % 4 AS VARCHAR))
              ELSE 'web-' || CAST(user_id % 4 AS VARCHAR) END AS host,
         ts, CAST(ts AS DATE) AS day, event_id, event_type, user_id,
         json_extract_string(props, '$.k') AS k
  FROM events)"""

SQL["log_json_search"] = f"""WITH {DOCS_CTE}
SELECT _id, ts AS timestamp, 'user' || CAST(user_id AS VARCHAR) AS "user", 'h' || CAST(user_id % 5 AS VARCHAR) AS device,
       '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || k AS client_address, 'dev-' || k AS device_address
FROM docs WHERE host = 'web-1' AND event_type = 'error'
ORDER BY ts, _id"""

SQL["log_search_analyzed"] = f"""WITH {DOCS_CTE}
SELECT _id, ts AS timestamp, 'user' || CAST(user_id AS VARCHAR) AS "user", 'h' || CAST(user_id % 5 AS VARCHAR) AS device,
       '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || k AS client_address, 'dev-' || k AS device_address
FROM docs WHERE list_has_any(regexp_split_to_array(lower(host), '[^\\p{{L}}\\p{{N}}]+'), ['web', '1']) AND event_type = 'click'"""

SQL["log_rejected_messages"] = f"""WITH {DOCS_CTE}
SELECT _id, host, event_type FROM docs WHERE event_type = 'signup'"""

SQL["create_only_copy"] = f"""WITH {DOCS_CTE}
SELECT _id, host, day, event_type FROM docs
WHERE host = 'web-2' AND _id NOT IN (SELECT _id FROM docs WHERE event_type = 'view')"""

SQL["two_source_copy"] = f"""WITH {DOCS_CTE},
keyed AS (SELECT 'u' || right(CAST(event_id AS VARCHAR), 1) || '-' || CAST(hour(ts) AS VARCHAR) AS _id, host, ts, day, event_id FROM docs),
offers AS (
  SELECT day AS target_day, _id, 0 AS priority, ts, event_id, day FROM keyed WHERE host = 'web-2'
  UNION ALL
  SELECT CAST(day + INTERVAL 1 DAY AS DATE) AS target_day, _id, 1 AS priority, ts, event_id, day FROM keyed WHERE host = 'web-2'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target_day, _id ORDER BY priority, ts, event_id) AS rn FROM offers)
SELECT target_day, _id, priority, event_id, day FROM ranked WHERE rn = 1"""

# ------------------------------------------------------------------ family D
VERSION_CTE = """vrows AS (
  SELECT p_partkey, p_size, p_type, p_brand, CAST(p_size AS VARCHAR) AS p0, CAST(p_partkey % 100 AS VARCHAR) AS p1,
         CAST((p_partkey * 7) % 10000 AS VARCHAR) AS p2,
         CASE WHEN p_partkey % 17 = 0 THEN 'x' ELSE '' END || CAST((p_partkey * 13) % 1000 AS VARCHAR) AS p3,
         CAST(p_size * 3 AS VARCHAR) AS p4, CAST(p_partkey % 5 + 1 AS INTEGER) AS n_parts
  FROM part),
vtext AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE array_to_string(list_slice([p0, p1, p2, p3, p4], 1, n_parts), '.') END AS version,
         array_to_string(list_slice([p0, CASE WHEN p_partkey % 7 = 0 THEN p1 || '*fre' ELSE p1 END, lower(p_type), lower(p_brand)], 1, least(n_parts, 4)), '.') AS build_lab
  FROM vrows),
vp AS (
  SELECT *, string_split(coalesce(version, 'nan'), '.') AS vs, string_split(coalesce(build_lab, 'nan'), '.') AS bs FROM vtext),
vraw AS (
  SELECT *, len(vs) AS vn, len(bs) AS bn,
         {eng} AS eng, {app} AS app, {sig} AS sig,
         {first} AS fst, {second} AS snd
  FROM vp),
vfeat AS (
  SELECT p_partkey, version, build_lab,
         CASE WHEN vn > 1 THEN eng ELSE 0.0 END AS engine_num, (vn <= 1 OR eng IS NOT NULL) AS ok_engine,
         CASE WHEN vn > 1 THEN app ELSE 0.0 END AS app_num, (vn <= 1 OR app IS NOT NULL) AS ok_app,
         CASE WHEN vn > 3 THEN sig ELSE 0.0 END AS sig_num, (vn <= 3 OR sig IS NOT NULL) AS ok_sig,
         CASE WHEN bn > 1 THEN fst ELSE 0 END AS "first", (bn <= 1 OR fst IS NOT NULL) AS ok_first,
         CASE WHEN bn > 3 THEN snd ELSE 0 END AS "second", (bn <= 3 OR snd IS NOT NULL) AS ok_second,
         CASE WHEN bn > 1 THEN bs[3] ELSE '___' END AS third, (bn <= 1 OR bs[3] IS NOT NULL) AS ok_third,
         CASE WHEN bn > 1 THEN bs[4] ELSE '___' END AS fourth, (bn <= 1 OR bs[4] IS NOT NULL) AS ok_fourth
  FROM vraw),
vfinal AS (
  SELECT *, {fifth} AS fifth FROM vfeat),
vreason AS (
  SELECT *, nullif(concat_ws(',', CASE WHEN NOT ok_engine THEN 'engine_num' END, CASE WHEN NOT ok_app THEN 'app_num' END,
            CASE WHEN NOT ok_sig THEN 'sig_num' END, CASE WHEN NOT ok_first THEN 'first' END,
            CASE WHEN NOT ok_second THEN 'second' END, CASE WHEN NOT ok_third THEN 'third' END,
            CASE WHEN NOT ok_fourth THEN 'fourth' END, CASE WHEN fifth IS NULL THEN 'fifth' END), '') AS reject_reason
  FROM vfinal)""".format(
    eng=parse_float("vs[3] || '.' || vs[4]"),
    app=parse_float(f"{pad_left('vs[2]', 2)} || {pad_left('vs[3]', 5)} || '.' || vs[4]"),
    sig=parse_float(f"{pad_left('vs[1]', 2)} || {pad_left('vs[2]', 3)} || {pad_left('vs[3]', 4)} || '.' || vs[4]"),
    first=parse_int("bs[1]"),
    second=parse_int("split_part(bs[2], '*', 1)"),
    fifth=parse_float('CAST("first" AS VARCHAR) || \'.\' || CAST("second" AS VARCHAR)'),
)

SQL["version_features"] = f"""WITH {VERSION_CTE}
SELECT p_partkey, version, build_lab, engine_num, app_num, sig_num, "first", "second", third, fourth, fifth
FROM vreason WHERE reject_reason IS NULL"""

SQL["reject_bad_versions"] = f"""WITH {VERSION_CTE}
SELECT p_partkey, version, build_lab, reject_reason FROM vreason WHERE reject_reason IS NOT NULL"""

CODING_CTE = """cdata AS (
  SELECT p_partkey, p_brand, p_type, CASE WHEN p_size = 1 THEN NULL ELSE p_name END AS p_name,
         CASE WHEN p_partkey % 5 = 0 OR p_brand = 'Brand#7' THEN 'test' ELSE 'train' END AS split
  FROM part)"""


def _dict_cte(col: str) -> str:
    return f"""d_{col} AS (
  SELECT v, row_number() OVER (ORDER BY fs, v) - 1 AS code FROM (
    SELECT {col} AS v, min(p_partkey) AS fs FROM cdata WHERE split = 'train' AND {col} IS NOT NULL GROUP BY 1))"""


SQL["factorize_train_test"] = f"""WITH {CODING_CTE}, {_dict_cte('p_brand')}, {_dict_cte('p_type')}, {_dict_cte('p_name')}
SELECT c.p_partkey, c.split, coalesce(b.code, -1) AS p_brand_code, coalesce(t.code, -1) AS p_type_code,
       coalesce(n.code, -1) AS p_name_code
FROM cdata c LEFT JOIN d_p_brand b ON c.p_brand = b.v LEFT JOIN d_p_type t ON c.p_type = t.v
     LEFT JOIN d_p_name n ON c.p_name = n.v"""

SQL["version_date_lookup"] = """WITH d AS (SELECT 'v' || CAST(o_orderkey AS VARCHAR) AS version, max(o_orderdate) AS date FROM orders GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, d.date
FROM lineitem l LEFT JOIN d ON 'v' || CAST(l.l_orderkey AS VARCHAR) = d.version
WHERE d.date > TIMESTAMP '1998-01-01 00:00:00'"""

SQL["column_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows FROM lineitem"
    for c in "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
)

SQL["kfold_contiguous"] = "SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders"


def hash_bits(id_expr: str, seed) -> str:
    return f"CAST(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"


SQL["kfold_hashed"] = f"SELECT o_orderkey, {hash_bits('o_orderkey', 15)} % 5 AS fold FROM orders"
SQL["sample_stable"] = f"SELECT o_orderkey, o_custkey FROM orders WHERE {hash_bits('o_orderkey', 7)} / 4294967296.0 < 0.2"

# ------------------------------------------------------------------ metrics and blending
SQL["auc_exact"] = """WITH j AS (SELECT d.n_chars AS s, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
per AS (SELECT s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg FROM j GROUP BY s),
cum AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM per)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM cum"""

SCORES_CTE = """a AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, max(l_discount) * CAST(10 AS DOUBLE) AS score_a FROM lineitem GROUP BY 1),
b AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, max(l_tax) * CAST(12.5 AS DOUBLE) AS score_b FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
c AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, max(CASE WHEN l_linestatus <> 'O' THEN l_quantity / CAST(50 AS DOUBLE) END) AS score_c FROM lineitem GROUP BY 1)"""


def snap_sql(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN {x} WHEN {x} > 0.8 THEN 1.0 WHEN {x} < 0.2 THEN 0.0 ELSE {x} END)"


SQL["blend_inner_mean"] = f"""WITH {SCORES_CTE}
SELECT id, score_a, score_b, score_c,
       round((coalesce(score_a, 0) + coalesce(score_b, 0) + coalesce(score_c, 0))
             / nullif((CASE WHEN score_a IS NULL THEN 0 ELSE 1 END) + (CASE WHEN score_b IS NULL THEN 0 ELSE 1 END) + (CASE WHEN score_c IS NULL THEN 0 ELSE 1 END), 0), 6) AS mean
FROM a JOIN b USING (id) JOIN c USING (id)"""

SQL["blend_weighted"] = f"""WITH {SCORES_CTE}, w AS (SELECT id, 0.7 * score_a + 0.3 * score_b AS blend FROM a JOIN b USING (id))
SELECT id, round(blend, 6) AS blend, round({snap_sql('blend')}, 6) AS snapped FROM w"""

SQL["snap_extremes"] = f"""WITH {SCORES_CTE}
SELECT id, score_a, CAST({snap_sql('score_a')} AS DOUBLE) AS snapped FROM a"""

_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SQL["corr_matrix"] = " UNION ALL ".join(
    f"SELECT '{x}' AS col_a, '{y}' AS col_b, round(corr({x}, {y}), 6) AS r FROM lineitem"
    for i, x in enumerate(_CORR_COLS)
    for y in _CORR_COLS[i + 1 :]
)

SQL["describe_scores"] = """SELECT count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max, round(0.5 - avg(value), 6) AS delta
FROM events"""

_HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_HIST_LONG = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in _HIST_COLS)
SQL["histogram_columns"] = f"""WITH v AS ({_HIST_LONG}),
rng AS (SELECT col, min(x) AS mn, max(x) AS mx FROM v GROUP BY col),
b AS (SELECT v.col, CAST(coalesce(least(floor((v.x - r.mn) / nullif((r.mx - r.mn) / CAST(10 AS DOUBLE), 0)), 9), 0) AS INTEGER) AS bin
      FROM v JOIN rng r USING (col) WHERE v.x IS NOT NULL),
cnt AS (SELECT col, bin, count(*) AS n FROM b GROUP BY ALL),
grid AS (SELECT r.col, CAST(g.i AS INTEGER) AS bin, r.mn, r.mx FROM rng r CROSS JOIN range(10) g(i))
SELECT grid.col AS "column", grid.bin, round(mn + grid.bin * ((mx - mn) / CAST(10 AS DOUBLE)), 6) AS lo,
       round(mn + (grid.bin + 1) * ((mx - mn) / CAST(10 AS DOUBLE)), 6) AS hi, coalesce(cnt.n, 0) AS count
FROM grid LEFT JOIN cnt ON grid.col = cnt.col AND grid.bin = cnt.bin"""

IMP_CTE = """imp AS (SELECT 'f_' || CAST(l_partkey AS VARCHAR) AS feature, l_quantity AS importance, l_linenumber AS fold FROM lineitem),
top AS (SELECT feature, avg(importance) AS mean_importance FROM imp GROUP BY feature ORDER BY mean_importance DESC, feature LIMIT 1000)"""

SQL["topk_groups"] = f"WITH {IMP_CTE} SELECT feature, round(mean_importance, 6) AS mean_importance FROM top"

SQL["importance_report"] = f"""WITH {IMP_CTE},
best AS (SELECT * FROM imp WHERE feature IN (SELECT feature FROM top)),
s AS (SELECT *, 100.0 * importance / (SELECT sum(importance) FROM best) AS share FROM best)
SELECT feature, fold, importance, round(share, 6) AS share FROM s WHERE share > 0.003"""

SQL["id_from_path"] = "SELECT page_id, split_part(regexp_extract(url, '[^/]*$'), '.', 1) AS url_id FROM pages"

SQL["align_to_template"] = "SELECT d.doc_id, l.quality AS label FROM documents d LEFT JOIN labels l USING (doc_id)"

SQL["ensemble_threshold"] = """SELECT l_orderkey AS id, round(avg(l_discount * CAST(10 AS DOUBLE)), 6) AS score,
       CAST(avg(l_discount * CAST(10 AS DOUBLE)) > 0.5 AS INTEGER) AS label FROM lineitem GROUP BY 1"""

SQL["ensemble_accuracy"] = """WITH p AS (SELECT l_orderkey AS id, CAST(avg(l_discount * CAST(10 AS DOUBLE)) > 0.5 AS INTEGER) AS label FROM lineitem GROUP BY 1)
SELECT round(avg(CASE WHEN p.label = CAST(o.o_orderstatus = 'F' AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM p JOIN orders o ON p.id = o.o_orderkey"""

SQL["normalise_dimensions"] = """WITH u AS (SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings)
SELECT CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM u GROUP BY pos"""

SQL["density_grid"] = """SELECT CAST(floor(l_quantity / 5.0) AS BIGINT) AS gx, CAST(floor(l_extendedprice / 10000.0) AS BIGINT) AS gy, count(*) AS n
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY ALL"""

SQL["density_smooth"] = """WITH g AS (SELECT CAST(floor(l_quantity / 5.0) AS BIGINT) AS gx, CAST(floor(l_extendedprice / 10000.0) AS BIGINT) AS gy, count(*) AS n
           FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY ALL),
k AS (SELECT a.d AS dx, b.d AS dy, exp(-(a.d * a.d + b.d * b.d) / 2.0) AS w FROM range(-2, 3) a(d) CROSS JOIN range(-2, 3) b(d)),
s AS (SELECT g.gx + k.dx AS gx, g.gy + k.dy AS gy, sum(g.n * k.w) AS m FROM g CROSS JOIN k GROUP BY ALL)
SELECT gx, gy, round(m / (SELECT sum(m) FROM s), 6) AS density FROM s"""

# ------------------------------------------------------------------ streaming: batch equivalents
SQL["stream_create_only"] = SQL["create_only_copy"]
SQL["stream_mail_stats"] = SQL["mail_user_stats"]
SQL["stream_mail_edges"] = SQL["mail_edges_all"]

SQL["tta_blend"] = """WITH p AS (SELECT l_orderkey AS id, avg(l_discount * CAST(10 AS DOUBLE)) AS a, max(l_discount * CAST(10 AS DOUBLE)) AS m FROM lineitem GROUP BY 1)
SELECT id, round(a, 6) AS tta_avg, round(m, 6) AS tta_max, round(0.5 * a + 0.5 * m, 6) AS blend FROM p"""

SQL["line_positions"] = """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_number FROM lineitem)
SELECT *, sha256('lineitem|' || CAST(row_number AS VARCHAR)) AS unique_id FROM p"""

SQL["holdout_split"] = f"""SELECT o_orderkey, CASE WHEN {hash_bits('o_orderkey', 15)} / 4294967296.0 < 0.2 THEN 'valid' ELSE 'train' END AS split FROM orders"""

SQL["sigmoid_scores"] = """WITH d AS (SELECT doc_id, 1.0 / (1.0 + exp(-(n_chars / CAST(1000 AS DOUBLE) - 3.0))) AS p FROM documents)
SELECT doc_id, round(p, 6) AS p, CAST(p > 0.5 AS INTEGER) AS label FROM d"""

# ------------------------------------------------------------------ model: labels, bars to beat, what must not depend on the learner
ORDER_FEATURES_CTE = f"""o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS DOUBLE) AS order_year,
  CAST((2 * CAST(substr(o_orderpriority, 1, 1) IN ('1', '4') AS INTEGER) + CAST(year(o_orderdate) >= 1998 AS INTEGER)
        + CAST((o_custkey % 100) % 7 = 0 AS INTEGER) >= 2) <> ({hash_bits('o_orderkey', 33)} / 4294967296.0 < 0.1) AS DOUBLE) AS label,
  {hash_bits('o_orderkey', 15)} AS h FROM orders)"""
HELD_CTE = f"""{ORDER_FEATURES_CTE}, held AS (SELECT * FROM o WHERE h / 4294967296.0 < 0.2)"""


def feature_auc(rows: str, group: str = "0") -> str:
    """CTE ``single (g, auc)``: the exact AUC of the order year, ties counted half."""
    return f"""per AS (SELECT {group} AS g, order_year AS s, sum(label) AS pos, sum(1 - label) AS neg FROM {rows} GROUP BY ALL),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY g ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM per),
single AS (SELECT g, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM cum GROUP BY g)"""


SQL["train_score_gbt"] = f"""WITH {HELD_CTE}, {feature_auc('held')}
SELECT o_orderkey, label, true AS score_in_range, round(auc, 6) AS feature_auc, auc + 0.1 < 1 AS beats_feature FROM held, single"""
SQL["train_patience"] = f"""WITH {HELD_CTE}, {feature_auc('held')}
SELECT o_orderkey, label, true AS score_in_range, true AS best_prefix, round(auc, 6) AS feature_auc, auc + 0.1 < 1 AS beats_feature FROM held, single"""
SQL["split_count_report"] = """SELECT f AS feature, CAST(2 AS BIGINT) AS n_runs, true AS counts_inner_nodes, true AS shares_complete, f = 'constant' AS is_unused
FROM unnest(['price', 'order_year', 'constant', 'priority_code']) AS t(f)"""
SQL["keep_list_refit"] = f"""WITH {ORDER_FEATURES_CTE}, fold AS (SELECT * FROM o WHERE h % 2 = 1), {feature_auc('fold')}
SELECT o_orderkey, 'order_year,price,priority_code' AS kept, true AS score_in_range, round(auc, 6) AS feature_auc, auc + 0.1 < 1 AS beats_feature FROM fold, single"""
SQL["oof_predictions"] = f"""WITH {ORDER_FEATURES_CTE}, s AS (SELECT greatest(avg(label), 1 - avg(label)) AS share FROM o)
SELECT o_orderkey, CAST(h % 5 AS INTEGER) AS fold, label, true AS score_in_range, round(share, 6) AS majority_share, share + 0.1 < 1 AS beats_majority FROM o, s"""
SQL["gbt_importance_report"] = """SELECT f AS feature, CAST(5 AS BIGINT) AS n_runs, true AS shares_complete, f = 'priority' AS leads, f = 'constant' AS is_unused
FROM unnest(['o_totalprice', 'priority', 'order_year', 'cust_bucket', 'constant']) AS t(f)"""
SQL["oof_auc_mean"] = f"""WITH {ORDER_FEATURES_CTE}, {feature_auc('o', 'h % 5')}
SELECT count(*) AS n_runs, true AS mean_auc_in_range, round(avg(auc), 6) AS mean_feature_auc, avg(auc) + 0.1 < 1 AS beats_feature FROM single"""

# ------------------------------------------------------------------ more inventory rows
SQL["normalise_vectors"] = """WITH u AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
s AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS d FROM u GROUP BY pos)
SELECT vec_id, CAST(u.pos AS INTEGER) AS pos, round((x - m) / nullif(d, 0), 4) + 0.0 AS z FROM u JOIN s ON u.pos = s.pos"""

SQL["daily_copy_run"] = f"""WITH {DOCS_CTE},
offers AS (SELECT _id, 0 AS priority, event_id, day FROM docs WHERE host = 'web-2' AND day = DATE '2024-01-02'
  UNION ALL SELECT _id, 1 AS priority, event_id, day FROM docs WHERE host = 'web-2' AND day = DATE '2024-01-01')
SELECT DATE '2024-01-02' AS target_day, _id, priority, event_id, day, 'copy-2024.01.02' AS target FROM offers"""

SQL["daily_copy_tables"] = f"""WITH {DOCS_CTE},
keyed AS (SELECT 'u' || right(CAST(event_id AS VARCHAR), 1) || '-' || CAST(hour(ts) AS VARCHAR) AS _id, ts, day, event_id, event_type FROM docs WHERE host = 'web-2'),
offers AS (SELECT day AS target_day, 0 AS priority, * FROM keyed
  UNION ALL SELECT CAST(day + INTERVAL 1 DAY AS DATE) AS target_day, 1 AS priority, * FROM keyed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target_day, _id ORDER BY priority, ts, event_id) AS rn FROM offers)
SELECT target_day, 0 AS run, _id, priority, event_id, day, event_type FROM ranked WHERE rn = 1 AND target_day IN (DATE '2024-01-02', DATE '2024-01-03')"""

SQL["importance_cuts"] = f"""WITH {IMP_CTE}
SELECT count(*) AS n_rows, count(*) FILTER (fold = 1) AS n_fold, count(*) FILTER (fold = 1 AND importance > 44) AS n_kept FROM imp"""

SQL["preview_rows"] = "SELECT p_partkey, p_brand, p_type FROM part ORDER BY p_partkey LIMIT 10"

SQL["text_lines_round_trip"] = f"WITH {WEATHER_CTE} SELECT airport, date, time, temperature FROM weather"
SQL["json_records_round_trip"] = f"""WITH {MAIL_CTE}
SELECT "message identifier", sender, array_to_string(recipients, '|') AS recipients_text, timestamp_iso FROM records"""
SQL["stats_csv_round_trip"] = SQL["mail_user_stats"]
SQL["prediction_csv_round_trip"] = f"""WITH {SCORES_CTE} SELECT id, CAST(score_a AS DOUBLE) AS label FROM a"""
_PART = {c: f'CAST(coalesce("{c}", 0) AS VARCHAR)' for c in ("first", "second")}
SQL["prepared_columns"] = f"""WITH {VERSION_CTE}
SELECT p_partkey, coalesce(engine_num, 0.0) AS engine_num, coalesce(app_num, 0.0) AS app_num, coalesce(sig_num, 0.0) AS sig_num,
       coalesce("first", 0) AS "first", coalesce("second", 0) AS "second", coalesce(third, '___') AS third, coalesce(fourth, '___') AS fourth,
       round(coalesce(fifth, {parse_float(f"({_PART['first']} || '.' || {_PART['second']})")}, 0.0), 6) AS fifth
FROM vreason"""
SQL["text_columns"] = "SELECT p_partkey, p_name, p_brand, p_type FROM part"
SQL["dropped_columns"] = "SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer"
SQL["mail_csv_scan"] = SQL["mail_parse"]
SQL["log_search_capped"] = SQL["log_json_search"] + " LIMIT 50"
SQL["one_decimal_text"] = "SELECT o_orderkey, printf('%.1f', o_custkey / CAST(7 AS DOUBLE)) AS text FROM orders"
SQL["binary_files_labelled"] = """SELECT page_id, quality AS label, octet_length(encode(coalesce(html, ''))) + 1 AS length, sha256(coalesce(html, '') || chr(10)) AS sha256
FROM pages JOIN labels ON labels.doc_id = page_id"""


def _machine_field(j: int, kind: str) -> str:
    if j == 0:
        return "'m' || c_custkey"
    plain = {"category": f"'c' || ((c_custkey + {j}) % 7)", "float32": f"((c_custkey + {j}) % 50) || '.5'"}.get(kind, f"CAST((c_custkey + {j}) % 100 AS VARCHAR)")
    broken = {5: (11, "x"), 7: (13, "300")}.get(j)
    return f"CASE WHEN c_custkey % {broken[0]} = 0 THEN '{broken[1]}' ELSE {plain} END" if broken else plain


_MACHINE = [_machine_field(j, kind) for j, (_, kind) in enumerate(MACHINE_COLUMNS)]
SQL["checked_csv_rejects"] = f"""WITH l AS (SELECT c_custkey, c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 AS bad,
  CASE WHEN c_custkey % 17 = 0 THEN concat_ws(',', {', '.join(_MACHINE[:40])}) ELSE concat_ws(',', {', '.join(_MACHINE)}) END AS line FROM customer)
SELECT 'm' || c_custkey AS MachineIdentifier, CASE WHEN NOT bad THEN CAST((c_custkey + 5) % 100 AS INTEGER) END AS is_beta,
       CASE WHEN NOT bad THEN (c_custkey + 6) % 50 + CAST(0.5 AS DOUBLE) END AS bits, CASE WHEN bad THEN line END AS line FROM l"""

SQL["typed_csv_round_trip"] = "SELECT c_custkey, c_name, c_acctbal FROM customer"
SQL["lookup_round_trip"] = "SELECT 'v' || CAST(o_orderkey AS VARCHAR) AS version, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts_text FROM orders"
SQL["template_round_trip"] = SQL["align_to_template"]
SQL["archive_round_trip"] = SQL["text_lines_round_trip"]
SQL["labelled_files"] = "SELECT 'train/' || d.doc_id || '.tif' AS path, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"
SQL["gbt_parameter_sets"] = f"""WITH {HELD_CTE}, {feature_auc('held')}
SELECT name, true AS auc_in_range, round(auc, 6) AS feature_auc, auc + 0.1 < 1 AS beats_feature
FROM unnest(['holdout', 'importance', 'validation', 'many leaves', 'previous', 'old best', 'best']) AS t(name), single"""
