"""ANSI SQL over the test tables with the same results as the catalog's queries.

Written from the rules, with window functions over all rows where the library pre-aggregates.
"""

from __future__ import annotations

EPOCH = 1704067200000

LOGS = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
              CAST(floor(value * 4) AS BIGINT) AS sku, (epoch_us(ts) // 1000) AS ms FROM events),
logs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, CASE WHEN k >= 50 THEN '1' ELSE '0' END AS is_new,
         'v' || CAST(k // 25 AS VARCHAR) AS vc, CASE WHEN value < 50 THEN 'app' ELSE 'web' END AS ch,
         CAST(k // 20 AS VARCHAR) AS ar, CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS sid,
         event_type, k, CAST(sku AS VARCHAR) AS sku, ms, CAST(ts AS DATE) AS d,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'trade' WHEN 'error' THEN 'search' END AS page_id,
         CASE WHEN event_type <> 'view' THEN 'home' END AS last_page_id,
         CASE WHEN event_type NOT IN ('purchase', 'error') THEN CAST(sku AS VARCHAR)
              WHEN k >= 10 THEN event_type || ' K' || k || ' ' || upper(event_type[1]) || event_type[2:]
              WHEN k >= 5 THEN '-- !' END AS item,
         CASE WHEN event_type IN ('purchase', 'error') THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CAST(round(value * 100) AS BIGINT) AS dur
  FROM ev),
pages AS (SELECT * FROM logs WHERE page_id IS NOT NULL)
"""

REPAIRED = LOGS + """,
visits AS (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE CAST(d - INTERVAL 1 DAY AS DATE) END)
            OVER (PARTITION BY mid ORDER BY ms, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fv FROM logs),
repaired AS (SELECT * EXCLUDE (is_new),
                    CASE WHEN is_new = '1' AND d <> fv THEN '0' ELSE is_new END AS is_new FROM visits)
"""

DETAIL_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'))")
PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"

ORDERS = f"""
order_rows AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_custkey // 100 AS province_id, {EPOCH} + o_orderkey * 60000 AS t,
         CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1002' END AS reached
  FROM orders)
"""

DETAILS = f"""
line AS (
  SELECT *, {DETAIL_ID} AS id, {EPOCH} + l_orderkey * 60000 AS t0,
         CAST({PRICE} * CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) AS VARCHAR) AS original,
         CAST({PRICE} * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR) AS total,
         CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS act,
         CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS cou
  FROM lineitem),
detail_changes AS (
  SELECT *, t0 + l_linenumber * 1000 AS ts, cou AS coupon_amount FROM line
  UNION ALL
  SELECT *, t0 + l_linenumber * 1000 + 500, '0' FROM line WHERE l_returnflag = 'R'),
details AS (
  SELECT id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         'sku ' || l_partkey AS sku_name, CAST({PRICE} AS VARCHAR) AS order_price,
         CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
         strftime(make_timestamp(t0 * 1000), '%Y-%m-%d %H:%M:%S') AS create_time,
         original AS split_original_amount, total AS split_total_amount, act AS split_activity_amount,
         coupon_amount AS split_coupon_amount, ts, l_orderkey, l_discount, l_tax, l_linenumber, l_suppkey
  FROM detail_changes),
latest_details AS (SELECT * FROM details QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC) = 1)
"""

FACT_COLUMNS = """
  d.id, order_id, CAST(o.user_id AS VARCHAR) AS user_id, CAST(province_id AS VARCHAR) AS province_id,
  CASE WHEN l_discount >= 0.05 THEN CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) END AS activity_id,
  CASE WHEN l_discount >= 0.05 THEN CAST(l_linenumber AS VARCHAR) END AS activity_rule_id,
  CASE WHEN l_tax < 0.03 THEN CAST(l_suppkey AS VARCHAR) END AS coupon_id,
  sku_id, sku_name, order_price, sku_num, create_time, split_original_amount, split_total_amount,
  split_activity_amount, split_coupon_amount, ts
"""
FACT = f"fact AS (SELECT {FACT_COLUMNS} FROM latest_details d JOIN order_rows o ON d.l_orderkey = o.id)"

PAYMENTS = f"""
payments AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
         substr(o_orderpriority, 1, 1) AS payment_type, paid AS ts,
         strftime(make_timestamp(paid * 1000), '%Y-%m-%d %H:%M:%S') AS callback_time
  FROM (SELECT *, {EPOCH} + o_orderkey * 60000 + CAST(floor(o_totalprice / 400) AS BIGINT) * 1000 AS paid FROM orders))
"""

DIC = "dic AS (SELECT CAST(r_regionkey AS VARCHAR) AS dic_code, r_name AS dic_name FROM region)"

CART = """
cart AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
         CASE event_type WHEN 'view' THEN 'r' WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' ELSE 'c' END AS op,
         CAST(CAST(floor(value * 4) AS INT) AS VARCHAR) AS sku_id, CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS cart_price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS now,
         CASE WHEN value >= 5 THEN CAST(floor(value / 2) AS BIGINT) END AS was,
         'sku ' || event_type AS sku_name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, (epoch_us(ts) // 1000) AS ts
  FROM events)
"""

USERS = f"""
user_changes AS (
  SELECT c_custkey AS k, {EPOCH} + c_custkey * 10 + n.dt AS ts, n.pos, n.op,
         CASE n.pos WHEN 4 THEN NULL WHEN 2 THEN NULL ELSE c_name END AS login_name,
         CASE n.pos WHEN 4 THEN 'back' WHEN 2 THEN upper(c_name) ELSE lower(c_name) END AS name,
         CASE n.pos WHEN 4 THEN NULL WHEN 2 THEN CAST(c_nationkey AS VARCHAR) ELSE '1' END AS user_level,
         CASE n.pos WHEN 4 THEN NULL WHEN 2 THEN NULL ELSE '1990-01-01' END AS birthday
  FROM customer JOIN (VALUES (1, 'c', 0), (2, 'u', 1), (3, 'd', 2), (4, 'c', 2)) n(pos, op, dt)
    ON n.pos <= 2 OR (n.pos = 3 AND c_acctbal < 0)
       OR (n.pos = 4 AND c_acctbal < 0 AND c_mktsegment = 'BUILDING')),
user_gone AS (SELECT *, coalesce(max(CASE WHEN op = 'd' THEN pos END) OVER (PARTITION BY k), 0) AS gone FROM user_changes),
user_alive AS (SELECT * FROM user_gone WHERE pos > gone)
"""
USER_ROW = """
  CAST(k AS VARCHAR) AS row_key, CAST(k AS VARCHAR) AS id,
  arg_max(login_name, pos) FILTER (WHERE login_name IS NOT NULL) AS login_name,
  arg_max(name, pos) FILTER (WHERE name IS NOT NULL) AS name,
  arg_max(user_level, pos) FILTER (WHERE user_level IS NOT NULL) AS user_level,
  arg_max(birthday, pos) FILTER (WHERE birthday IS NOT NULL) AS birthday
"""

VISITORS = """
daily AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY mid, d ORDER BY ms, event_id) = 1),
sessions AS (
  SELECT * FROM (SELECT *, lag(ms) OVER (PARTITION BY sid ORDER BY ms, event_id) AS prev FROM pages)
  WHERE prev IS NULL OR ms - prev >= 3600000)
"""

HOME = """
home AS (
  SELECT mid, page_id, strftime(d, '%Y-%m-%d') AS day, ms AS ts FROM pages WHERE page_id IN ('home', 'good_detail')
  QUALIFY row_number() OVER (PARTITION BY mid, page_id, d ORDER BY ms, event_id) = 1)
"""


def window_text(size_ms: int, ms: str = "ms") -> str:
    start = f"({ms} // {size_ms} * {size_ms})"
    return (f"strftime(make_timestamp({start} * 1000), '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime(make_timestamp(({start} + {size_ms}) * 1000), '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime(make_timestamp({start} * 1000), '%Y%m%d') AS cur_date")


WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


def keyword_sql(size_ms: int) -> str:
    return f"""
WITH {LOGS},
words AS (
  SELECT ms, {WORDS.format('item')} AS ws FROM pages
  WHERE item IS NOT NULL AND last_page_id IS NOT NULL AND item_type = 'keyword'),
exploded AS (SELECT ms, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS keyword FROM words)
SELECT {window_text(size_ms)}, keyword, count(*) AS keyword_count FROM exploded GROUP BY ALL"""


def traffic_sql(size_ms: int) -> str:
    return f"""
WITH {LOGS}, {VISITORS},
parts AS (
  SELECT ms, vc, ch, ar, is_new, 0 AS uv, 0 AS sv, 1 AS pv, dur FROM pages
  UNION ALL SELECT ms, vc, ch, ar, is_new, 1, 0, 0, 0 FROM daily
  UNION ALL SELECT ms, vc, ch, ar, is_new, 0, 1, 0, 0 FROM sessions)
SELECT {window_text(size_ms)}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
       CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
FROM parts GROUP BY ALL"""


def home_detail_sql(size_ms: int) -> str:
    return f"""
WITH {LOGS}, {HOME}
SELECT {window_text(size_ms, 'ts')}, count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct,
       count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct
FROM home GROUP BY ALL"""


def order_sql(where: str) -> str:
    return f"""
SELECT CAST(id AS VARCHAR) AS id, reached AS order_status, t + 60000 AS ts_ms FROM order_rows WHERE reached = '{where}'"""


def ms_text(expr: str) -> str:
    return f"strftime(make_timestamp({expr} * 1000), '%Y-%m-%d %H:%M:%S')"


COMMENT_ROW = """
  CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
  CAST(l_linenumber - 1 AS VARCHAR) AS appraise, 'shipped ' || strftime(l_shipdate, '%Y-%m-%d') AS comment_txt,
  (epoch_us(l_shipdate) // 1000) + l_linenumber AS ts
"""

REFUND_ROW = f"""
  {DETAIL_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_linenumber AS VARCHAR) AS refund_type,
  CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num, CAST({PRICE} AS VARCHAR) AS refund_amount,
  CASE WHEN l_linestatus = 'O' THEN '0' ELSE '9' END AS refund_reason_type,
  'line ' || l_linestatus AS refund_reason_txt, '0701' AS refund_status,
  {EPOCH} + l_orderkey * 60000 + 120000 AS ts
"""

ORACLES: dict[str, str] = {
    "ods_ingest": f"""
WITH {ORDERS}, {CART}
SELECT 'order_info' AS source_table, strftime(make_timestamp(t * 1000), '%Y-%m-%d') AS day, 'c' AS op,
       CAST(id AS VARCHAR) AS id, t AS ts_ms FROM order_rows
UNION ALL
SELECT 'order_info', strftime(make_timestamp((t + 60000) * 1000), '%Y-%m-%d'), 'u', CAST(id AS VARCHAR), t + 60000 FROM order_rows
UNION ALL
SELECT 'cart_info', strftime(make_timestamp(ts * 1000), '%Y-%m-%d'), op, CASE WHEN op <> 'd' THEN id END, ts FROM cart""",

    "dim_sync": f"""
WITH {USERS}
SELECT 'dim_user_info' AS sink_table, {USER_ROW}, CAST(NULL AS VARCHAR) AS phone_num,
       CAST(NULL AS VARCHAR) AS dic_code, CAST(NULL AS VARCHAR) AS dic_name FROM user_alive GROUP BY k
UNION ALL
SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), NULL, n_name, NULL, NULL, NULL, NULL, NULL FROM nation
UNION ALL
SELECT 'dim_base_dic', CAST(r_regionkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, CAST(r_regionkey AS VARCHAR), r_name FROM region""",

    "dwd_base_log": f"""
WITH {REPAIRED}
SELECT 'dwd_traffic_start' AS topic, mid, is_new, sid, NULL AS item, NULL AS pos_id, NULL AS action_id, NULL AS error_code, ms AS ts
FROM repaired WHERE event_type = 'signup'
UNION ALL
SELECT 'dwd_traffic_display', mid, is_new, sid, sku, pos, NULL, NULL, ms
FROM repaired CROSS JOIN (VALUES ('1'), ('2')) p(pos) WHERE event_type IN ('view', 'click')
UNION ALL
SELECT 'dwd_traffic_action', mid, is_new, sid, sku, NULL, event_type, NULL, NULL FROM repaired WHERE event_type IN ('click', 'purchase')
UNION ALL
SELECT 'dwd_traffic_err', mid, is_new, sid, item, NULL, NULL, CAST(k AS VARCHAR), ms FROM repaired WHERE event_type = 'error'
UNION ALL
SELECT 'dwd_traffic_page', mid, is_new, sid, item, NULL, NULL, NULL, ms FROM repaired WHERE page_id IS NOT NULL""",

    "dwd_base_db": f"""
WITH {USERS}, {CART}
SELECT 'dwd_user_register' AS sink_table, CASE WHEN login_name IS NULL THEN 1 ELSE 2 END AS n_fields,
       CAST(k AS VARCHAR) AS id, login_name, NULL AS sku_num FROM user_changes WHERE op = 'c'
UNION ALL
SELECT 'dwd_cart_update', 2, id, NULL, CAST(now AS VARCHAR) FROM cart WHERE op = 'u'""",

    "dwd_comment": f"""
WITH {DIC}, c AS (SELECT {DETAIL_ID} AS id, {COMMENT_ROW} FROM lineitem)
SELECT id, user_id, sku_id, appraise, dic_name AS appraise_name, comment_txt, ts FROM c JOIN dic ON appraise = dic_code""",

    "dwd_cart_add": f"""
WITH {CART}
SELECT id, user_id, sku_id, cart_price, CASE WHEN op = 'u' THEN now - was ELSE now END AS sku_num, sku_name,
       create_time, CAST(NULL AS VARCHAR) AS operate_time, ts
FROM cart WHERE op IN ('c', 'r') OR (op = 'u' AND now > was)""",

    "dwd_order_detail": f"WITH {ORDERS}, {DETAILS}, {FACT} SELECT * FROM fact",
    "dwd_order_cancel": f"""
WITH {ORDERS}, {DETAILS} SELECT {FACT_COLUMNS} FROM latest_details d JOIN order_rows o ON d.l_orderkey = o.id
WHERE reached = '1003'""",

    "dwd_pay_suc": f"""
WITH {ORDERS}, {DETAILS}, {FACT}, {PAYMENTS}, {DIC}
SELECT f.id AS order_detail_id, f.order_id, f.user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
       coupon_id, payment_type AS payment_type_code, dic_name AS payment_type_name, callback_time, sku_num,
       split_original_amount, split_activity_amount, split_coupon_amount,
       split_total_amount AS split_payment_amount, p.ts
FROM payments p JOIN fact f ON p.order_id = f.order_id AND f.ts BETWEEN p.ts - 900000 AND p.ts + 5000
LEFT JOIN dic ON payment_type = dic_code""",

    "dwd_refund": f"""
WITH {ORDERS}, {DIC}, refunds AS (SELECT {REFUND_ROW} FROM lineitem WHERE l_returnflag = 'R')
SELECT r.id, r.user_id, CAST(o.province_id AS VARCHAR) AS province_id, order_id, sku_id,
       refund_type AS refund_type_code, a.dic_name AS refund_type_name, refund_num, refund_amount,
       refund_reason_type AS refund_reason_type_code, b.dic_name AS refund_reason_type_name,
       refund_reason_txt, refund_status, r.ts
FROM refunds r JOIN order_rows o ON r.order_id = CAST(o.id AS VARCHAR) AND reached = '1005'
LEFT JOIN dic a ON refund_type = a.dic_code LEFT JOIN dic b ON refund_reason_type = b.dic_code""",

    "dws_keyword": keyword_sql(5000),
    "dws_keyword_day": keyword_sql(86400000),
    "dws_traffic": traffic_sql(5000),
    "dws_traffic_hour": traffic_sql(3600000),
    "dws_home_detail": home_detail_sql(10000),
    "dws_home_detail_day": home_detail_sql(86400000),

    "read_cdc": f"""
WITH {PAYMENTS}
SELECT 'payment_info' AS source_table, 'u' AS op, ts AS ts_ms, {ms_text('ts')} AS et, '1601' AS was, '1602' AS "is", order_id FROM payments
UNION ALL
SELECT 'payment_info', 'c', {EPOCH} + o_orderkey * 60000, {ms_text(f'({EPOCH} + o_orderkey * 60000)')}, NULL, '1601',
       CAST(o_orderkey AS VARCHAR) FROM orders""",

    "read_page_log": f"""
WITH {LOGS} SELECT ms AS ts, {ms_text('ms')} AS et, mid, page_id, item, dur AS during_time FROM pages""",

    "snapshot_changes": f"""
WITH {USERS}
SELECT op, ts AS ts_ms, CAST(k AS VARCHAR) AS id, CASE WHEN op <> 'd' THEN name END AS name FROM user_changes
UNION ALL SELECT 'r', {EPOCH}, CAST(c_custkey AS VARCHAR), c_name FROM customer""",

    "clean_json": f"""
WITH {LOGS}
SELECT mid, sid, page_id, CASE WHEN event_type IN ('view', 'click') THEN 2 WHEN event_type = 'error' THEN 0 END AS n_displays,
       CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) END AS error_code, ms AS ts FROM logs""",

    "clean_cdc": f"""
WITH {USERS}, {CART}
SELECT 'user_info' AS source_table, op, CAST(k AS VARCHAR) AS id, ts AS ts_ms FROM user_changes WHERE op <> 'd'
UNION ALL SELECT 'cart_info', op, id, ts FROM cart WHERE op <> 'd'""",

    "cdc_table": f"WITH {CART} SELECT op, id, ts AS ts_ms FROM cart WHERE op <> 'd'",
    "status_cancelled": f"WITH {ORDERS} {order_sql('1003')}",
    "status_refunded": f"WITH {ORDERS} {order_sql('1005')}",
    "status_paid": f"WITH {PAYMENTS} SELECT user_id, order_id, payment_type, callback_time, ts FROM payments",
    "effective_row": f"""
WITH {USERS} SELECT op, ts AS ts_ms, CAST(k AS VARCHAR) AS id, name, login_name FROM user_changes""",
    "prune_columns": """
SELECT 3 AS n, CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer""",

    "comment_src": f"""
SELECT {DETAIL_ID} AS id, 'nick' || l_suppkey AS nick_name, CAST(l_suppkey AS VARCHAR) AS spu_id,
       CAST(l_orderkey AS VARCHAR) AS order_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time, {COMMENT_ROW} FROM lineitem""",
    "order_detail_src": f"""
WITH {DETAILS} SELECT id, order_id, sku_id, sku_name, order_price, sku_num, create_time, split_original_amount,
       split_total_amount, split_activity_amount, split_coupon_amount, ts FROM details""",
    "order_info_src": f"""
WITH {ORDERS}, both_rows AS (SELECT *, t AS ts FROM order_rows UNION ALL SELECT *, t + 60000 FROM order_rows)
SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(province_id AS VARCHAR) AS province_id, ts FROM both_rows""",
    "order_activity_src": f"""
SELECT {DETAIL_ID} AS order_detail_id, CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) AS activity_id,
       CAST(l_linenumber AS VARCHAR) AS activity_rule_id, {EPOCH} + l_orderkey * 60000 AS ts
FROM lineitem WHERE l_discount >= 0.05""",
    "order_coupon_src": f"""
SELECT {DETAIL_ID} AS order_detail_id, CAST(l_suppkey AS VARCHAR) AS coupon_id, {EPOCH} + l_orderkey * 60000 AS ts
FROM lineitem WHERE l_tax < 0.03""",
    "refund_src": f"SELECT {REFUND_ROW} FROM lineitem WHERE l_returnflag = 'R'",
    "lookup_left": f"""
WITH {PAYMENTS}, {DIC} SELECT p.*, dic_name AS payment_type_name FROM payments p LEFT JOIN dic ON payment_type = dic_code""",
    "interval_join": """
SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id
FROM events p JOIN events v ON p.user_id = v.user_id AND p.event_type = 'purchase' AND v.event_type = 'view'
 AND (epoch_us(v.ts) // 1000) BETWEEN (epoch_us(p.ts) // 1000) - 900000 AND (epoch_us(p.ts) // 1000) + 5000""",
    "route_changes": f"""
WITH {USERS}
SELECT 'dim_user_info' AS sink_table, op, ts AS ts_ms, CAST(k AS VARCHAR) AS row_key FROM user_changes
UNION ALL SELECT 'dim_base_province', 'r', {EPOCH}, CAST(n_nationkey AS VARCHAR) FROM nation""",

    "upsert_latest": """
SELECT user_id, event_id, event_type, value, (epoch_us(ts) // 1000) AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000) DESC, event_id DESC) = 1""",
    "latest_config": f"""
WITH c AS (SELECT *, {EPOCH} + o_orderkey * 60000 AS t,
                  CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'P' THEN 'u' ELSE 'c' END AS op FROM orders),
ranked AS (SELECT *, max(CASE WHEN op <> 'c' THEN t END) OVER (PARTITION BY o_custkey) AS reset_ts,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY t DESC) AS rn FROM c)
SELECT CAST(o_custkey AS VARCHAR) AS source_table, CAST(o_orderkey AS VARCHAR) AS sink_table,
       o_orderpriority AS sink_columns, 'info' AS sink_family, 'id' AS sink_row_key, reset_ts
FROM ranked WHERE rn = 1 AND op <> 'd'""",
    "dim_merge": f"WITH {USERS} SELECT {USER_ROW} FROM user_alive GROUP BY k",
    "dim_config_reset": f"""
WITH {USERS}, r AS (SELECT max(c_custkey) * 5 + {EPOCH} AS reset_ts FROM customer),
kept AS (SELECT user_alive.* FROM user_alive, r WHERE ts > reset_ts),
rows_out AS (SELECT {USER_ROW} FROM kept GROUP BY k)
SELECT row_key, id, login_name, name FROM rows_out""",

    "new_visitor_repair": f"WITH {REPAIRED} SELECT event_id, mid, is_new, ms AS ts FROM repaired",
    "daily_visitors": f"""
WITH {LOGS}, {VISITORS} SELECT mid, strftime(d, '%Y-%m-%d') AS day, ms AS ts, event_id, vc, ch, ar, is_new FROM daily""",
    "session_starts": f"WITH {LOGS}, {VISITORS} SELECT sid, ms AS ts, event_id, vc, ch, ar, is_new FROM sessions",
    "home_detail_visitors": f"WITH {LOGS}, {HOME} SELECT * FROM home",
    "home_detail_pages": f"WITH {LOGS} SELECT event_id, page_id, ms AS ts FROM pages WHERE page_id IN ('home', 'good_detail')",
    "search_pages": f"""
WITH {LOGS} SELECT item AS keywords, ms AS ts FROM pages
WHERE item IS NOT NULL AND last_page_id IS NOT NULL AND item_type = 'keyword'""",
    "kw_split": f"""
WITH w AS (SELECT doc_id, unnest({WORDS.format('text')}) AS word FROM documents),
n AS (SELECT doc_id, count(*) AS n_words, min(word) AS first_word, max(word) AS last_word FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, first_word, last_word FROM documents d LEFT JOIN n USING (doc_id)""",
    "with_window_text": f"SELECT {window_text(10000, '(epoch_us(ts) // 1000)')}, count(*) AS n FROM events GROUP BY ALL",

    "log_start": f"WITH {LOGS} SELECT event_id, 'icon' AS entry, ms AS ts FROM logs WHERE event_type = 'signup'",
    "log_display": f"""
WITH {LOGS} SELECT mid, sku AS item, pos AS pos_id, is_new, ms AS ts
FROM logs CROSS JOIN (VALUES ('1'), ('2')) p(pos) WHERE event_type IN ('view', 'click')""",
    "log_action": f"""
WITH {LOGS} SELECT mid, sku AS item, event_type AS action_id, sid FROM logs WHERE event_type IN ('click', 'purchase')""",
    "log_err": f"""
WITH {LOGS} SELECT event_id, CAST(k AS VARCHAR) AS error_code, page_id, ms AS ts FROM logs WHERE event_type = 'error'""",
    "log_page": f"WITH {LOGS} SELECT event_id, page_id, ms AS ts, 6 AS n FROM pages",

    "snake_json": f"""
WITH rows_out AS ({home_detail_sql(10000)})
SELECT '{{"stt":"' || stt || '","edt":"' || edt || '","cur_date":"' || cur_date || '","home_uv_ct":' || home_uv_ct
       || ',"good_detail_uv_ct":' || good_detail_uv_ct || '}}' AS value FROM rows_out""",
    "time_texts": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y%m%d') AS part,
       (epoch_us(date_trunc('second', ts)) // 1000) - 28800000 AS back, (epoch_us(date_trunc('day', ts)) // 1000) - 28800000 AS day_back,
       strftime(ts, '%Y-%m-%d') AS date_text, CAST(CAST(ts AS TIME) AS VARCHAR) AS time_text,
       CAST(ts AS VARCHAR) AS datetime_text, CAST(ts + INTERVAL 8 HOUR AS VARCHAR) AS timestamp_text
FROM events""",
}

# Streams, and jobs one after the other, give what their static jobs do.
for _name in ("ods_ingest", "dim_sync", "dwd_base_db", "dwd_comment", "dwd_cart_add", "dwd_order_detail", "dwd_order_cancel", "dwd_pay_suc",
              "dwd_refund", "dws_traffic", "dws_home_detail"):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]
ORACLES["stream_restart_dws_keyword"] = ORACLES["dws_keyword"]
ORACLES["dwd_order_detail_landed"] = ORACLES["dwd_order_detail"]

# Lines carry no event number: of events at one time the earlier first visit counts, and the least dimensions.
BY_TIME = REPAIRED.replace("ORDER BY ms, event_id", "ORDER BY ms, CASE WHEN is_new = '1' THEN d ELSE CAST(d - INTERVAL 1 DAY AS DATE) END")
ORACLES["stream_dwd_base_log"] = ORACLES["dwd_base_log"].replace(REPAIRED, BY_TIME)
ORACLES["chain_log_to_traffic"] = traffic_sql(5000).replace(f"WITH {LOGS}, {VISITORS}", f"WITH {BY_TIME}, " + VISITORS.replace(
    "event_id", "vc, ch, ar, is_new").replace("FROM pages", "FROM views") + ", ").replace("dur FROM pages", "dur FROM views").replace(
    ", \ndaily AS", ", views AS (SELECT * FROM repaired WHERE page_id IS NOT NULL),\ndaily AS").replace(", ,", ",")

ORACLES["read_ods_days"] = f"""
WITH {CART}, first_day AS (SELECT CAST(min(ts) AS DATE) AS d FROM events)
SELECT 'cart_info' AS source_table, op, CASE WHEN op <> 'd' THEN id END AS id, ts AS ts_ms FROM cart, first_day
WHERE CAST(make_timestamp(ts * 1000) AS DATE) BETWEEN d AND d + 1"""
ORACLES["dwd_order_detail_band"] = f"""
WITH {ORDERS}, {DETAILS.replace("latest_details AS (SELECT * FROM details QUALIFY",
    "latest_details AS (SELECT * FROM details WHERE ts - (" + str(EPOCH) + " + l_orderkey * 60000) <= 5000 QUALIFY")}, {FACT} SELECT * FROM fact"""
ORACLES["order_detail_unmatched"] = f"""
WITH {ORDERS}, {DETAILS} SELECT d.id, order_id, split_coupon_amount, ts FROM details d WHERE ts - ({EPOCH} + l_orderkey * 60000) > 5000"""
ORACLES["change_order"] = f"""
WITH {ORDERS} SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, 'last' AS province_id, t AS ts FROM order_rows"""
