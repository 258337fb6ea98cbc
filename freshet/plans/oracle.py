"""The catalog's queries in plain SQL, for comparison with another engine.

Uniques are written here row by row with ``lag`` in event order, not as the
aggregations the jobs use, so that the two are independent.
"""

from __future__ import annotations

DATETIME = "%Y-%m-%d %H:%M:%S"
DATE = "%Y-%m-%d"


def _window(ts: str, seconds: int) -> str:
    micros = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {micros}) * {micros})"


def _labels(seconds: int, date: str = DATE) -> str:
    return (
        f"strftime(w, '{DATETIME}') AS stt, "
        f"strftime(w + INTERVAL {seconds} SECOND, '{DATETIME}') AS edt, "
        f"strftime(w, '{date}') AS cur_date"
    )


def _ones(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _daily(rows: str, keys: str, seconds: int, measures: str) -> str:
    """Windowed counts of rows whose day differs from the key's previous day.

    ``rows`` selects the keys, ``ts`` and the tie-break ``id``.
    """
    return f"""
    WITH r AS ({rows}),
    o AS (SELECT *, CAST(ts AS DATE) AS d,
                 lag(CAST(ts AS DATE)) OVER (PARTITION BY {keys} ORDER BY ts, id) AS pd
          FROM r),
    c AS (SELECT *, {_window('ts', seconds)} AS w FROM o WHERE pd IS NULL OR pd <> d)
    SELECT {_labels(seconds)}, {measures} FROM c GROUP BY w
    """


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# The behaviour log, one row per event.
LOG = f"""
    log0 AS (
        SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts,
               make_timestamp((epoch_us(ts) // 1000) * 1000) AS et,
               event_type AS ch, {K} AS k, user_id,
               'mid_' || user_id AS mid,
               CASE WHEN {K} % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
               'v' || ({K} % 3) AS vc, CAST({K} % 7 AS VARCHAR) AS ar,
               CAST({K} % 2 AS VARCHAR) AS is_new0,
               's_' || user_id || '_' || {K} AS sid,
               CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
                    ELSE 'payment' END AS page_id,
               CASE WHEN {K} % 5 = 0 THEN 'login' WHEN {K} % 2 = 1 THEN 'search'
                    ELSE 'home' END AS last_page_id,
               'Item ' || {K} || ' for ' || event_type AS item,
               CAST(floor(value) AS BIGINT) AS during_time,
               event_type IN ('view', 'click', 'purchase') AS is_page
        FROM events)
"""

FIXED_LOG = LOG + """,
    first_day AS (
        SELECT seq, first_value(CASE WHEN is_new0 = '1' THEN CAST(et AS DATE)
                                     ELSE CAST(et AS DATE) - 1 END)
                    OVER (PARTITION BY mid ORDER BY ts, seq) AS fd
        FROM log0),
    log AS (
        SELECT l.*, CASE WHEN is_new0 = '1' AND CAST(et AS DATE) <> fd THEN '0'
                         ELSE is_new0 END AS is_new
        FROM log0 l JOIN first_day USING (seq))
"""

LINE_ID = (
    "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' "
    "|| strftime(l_shipdate, '%Y%m%d')"
)


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(16,2)) AS VARCHAR)"


def _seconds(expression: str) -> str:
    return f"CAST(epoch_us({expression}) // 1000000 AS BIGINT)"


# Order lines as the fact table, with ``et_s`` in seconds.
DETAIL = f"""
    detail AS (
        SELECT {LINE_ID} AS id, {_text('l_orderkey')} AS order_id,
               {_text('o_custkey')} AS user_id, {_text('l_partkey')} AS sku_id,
               'sku#' || l_partkey AS sku_name, {_text('o_custkey % 34')} AS province_id,
               {_text('CAST(l_quantity AS INTEGER)')} AS sku_num,
               strftime(l_shipdate, '{DATE}') AS date_id,
               strftime(l_shipdate, '{DATETIME}') AS create_time,
               CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(16,2))
                    * CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
               {_money('l_discount')} AS split_activity_amount,
               {_money('l_tax')} AS split_coupon_amount,
               {_money('l_extendedprice')} AS split_total_amount,
               {_seconds('l_shipdate')} + l_linenumber * 60 AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    act AS (SELECT {LINE_ID} AS id, {_text('l_suppkey % 10')} AS activity_id,
                   {_text('l_suppkey')} AS activity_rule_id
            FROM lineitem WHERE l_discount >= 0.05),
    cou AS (SELECT {LINE_ID} AS id, {_text('l_partkey % 100')} AS coupon_id
            FROM lineitem WHERE l_tax >= 0.04),
    wide AS (
        SELECT detail.*, activity_id, activity_rule_id, coupon_id
        FROM detail LEFT JOIN act USING (id) LEFT JOIN cou USING (id)),
    dic AS (SELECT {_text('n_nationkey')} AS dic_code, n_name AS dic_name FROM nation)
"""

WIDE_COLUMNS = (
    "id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, "
    "coupon_id, date_id, create_time, sku_num, split_original_amount, split_activity_amount, "
    "split_coupon_amount, split_total_amount, ts"
)

CART = f"""
    SELECT event_id, user_id, ts, {K} AS k, CAST(floor(value) AS INTEGER) AS num,
           event_type = 'click' AS added
    FROM events
    WHERE event_type = 'click' OR (event_type = 'purchase' AND floor(value) > {K})
"""

# Rules that change: every version with the time it holds from and until, and the rows it routes.
RULED = f"""
    numbered AS (
        SELECT n_nationkey AS n, n_nationkey % 5 AS i, n_nationkey // 5 AS j,
               ['click', 'error', 'purchase', 'signup', 'view'][n_nationkey % 5 + 1] AS kind,
               ['c', 'u', 'd', 'c', 'u'][n_nationkey // 5 + 1] AS op,
               1704067200000 + CAST(n_nationkey + 1 AS BIGINT) * 86400000 AS since
        FROM nation),
    rules AS (
        SELECT n, kind, op, since,
               CASE WHEN j = 4 THEN 'dim_' || kind || '_again' ELSE 'dim_' || kind END AS before_sink,
               CASE WHEN j <= 2 THEN 'dim_' || kind WHEN j = 4 AND i < 2 THEN 'dim_shared'
                    ELSE 'dim_' || kind || '_again' END AS sink_table,
               [['id', 'k'], ['id', 'k', 'kind'], ['id'], ['id', 'kind'], ['id', 'k']][j + 1] AS listed
        FROM numbered
        UNION ALL
        SELECT -1, kind, 'r', CAST(-9000000000000 AS BIGINT), NULL, 'dim_' || kind, ['id']
        FROM (VALUES ('click'), ('error')) AS e(kind)),
    versions AS (
        SELECT *, coalesce(lead(since) OVER (PARTITION BY kind ORDER BY since, n), 9000000000000) AS till FROM rules),
    fact_steps AS (
        SELECT n, kind, op, since, i, j FROM numbered WHERE op <> 'd'
        UNION ALL
        SELECT n - 0.5, kind, 'd', since, i, j - 1 FROM numbered WHERE op <> 'c'),
    fact_rules AS (
        SELECT n, kind, op, since, CASE WHEN (5 * j + i) % 2 = 0 THEN 'insert' ELSE 'update' END AS type,
               'dwd_' || kind || '_' || j AS sink_table,
               CASE WHEN j % 2 = 0 THEN ['id', 'k'] ELSE ['id', 'kind'] END AS listed
        FROM fact_steps
        UNION ALL
        SELECT -1, 'view', 'r', CAST(-9000000000000 AS BIGINT), 'insert', 'dwd_view_early', ['id']),
    fact_versions AS (
        SELECT *, coalesce(lead(since) OVER (PARTITION BY kind, type ORDER BY since, n), 9000000000000) AS till
        FROM fact_rules),
    moved AS (
        SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS s, {K} AS k0,
               CASE WHEN {K} >= 10 THEN {K} END AS k,
               CASE WHEN {K} % 10 = 0 THEN 'delete' WHEN {K} % 3 = 0 THEN 'update' ELSE 'insert' END AS op
        FROM events),
    routed AS (
        SELECT m.*, v.sink_table, v.listed FROM moved m JOIN versions v
          ON v.kind = m.event_type AND v.op <> 'd' AND m.s * 1000 >= v.since AND m.s * 1000 < v.till),
    fact_routed AS (
        SELECT m.*, v.sink_table, v.listed FROM moved m JOIN fact_versions v
          ON v.kind = m.event_type AND v.type = m.op AND v.op <> 'd'
         AND m.s * 1000 >= v.since AND m.s * 1000 < v.till)
"""

# Which event's line is spoiled, and how.
SPOILED = "spoiled AS (SELECT *, event_id % 50 AS spoil FROM events)"


def _error(missing: str) -> str:
    return f"""CASE WHEN spoil IN (0, 1) THEN 'empty' WHEN spoil < 7 THEN 'malformed'
                    WHEN spoil = 7 THEN '{missing}' END AS error"""


def _if_good(value: str) -> str:
    return f"CASE WHEN spoil >= 8 THEN {value} END"


WORDS = "list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+|[一-鿿]'))"


def _followed(seconds: int) -> str:
    return f"""
    WITH n AS (
        SELECT user_id, ts, event_type,
               lead(ts) OVER u AS next_ts, lead(event_type) OVER u AS next_type
        FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, ts AS first_ts, next_ts AS second_ts,
           'Suspicious behavior detected' AS message
    FROM n
    WHERE event_type = 'click' AND next_type = 'purchase'
      AND next_ts - ts < INTERVAL {seconds} SECOND
    """


def _logins(days: int) -> str:
    return _daily(
        "SELECT user_id, ts, event_id AS id FROM events WHERE event_type = 'signup'",
        "user_id",
        10,
        f"{_ones(f'pd IS NOT NULL AND d - pd >= {days}')} AS back_ct, count(*) AS uu_ct",
    )


def _pages(log: str, source: str) -> str:
    """Page views with one session rule: a session's mark lasts an hour, and once per five seconds its earliest row
    decides; a recursion over these rows follows the marks."""
    return f"""
    WITH RECURSIVE {log},
    p AS (SELECT *, {_window('et', 5)} AS w,
                 row_number() OVER (PARTITION BY sid, {_window('et', 5)} ORDER BY et, seq) AS place
          FROM {source} AS l WHERE is_page),
    m AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY et, seq) AS rn FROM p WHERE place = 1),
    marks AS (
        SELECT sid, rn, seq, et AS created, true AS sv FROM m WHERE rn = 1
        UNION ALL
        SELECT m.sid, m.rn, m.seq,
               CASE WHEN m.et - k.created >= INTERVAL 1 HOUR THEN m.et ELSE k.created END,
               m.et - k.created >= INTERVAL 1 HOUR
        FROM marks k JOIN m ON m.sid = k.sid AND m.rn = k.rn + 1),
    flagged AS (
        SELECT vc, ch, ar, is_new, during_time, w, coalesce(sv, false) AS sv,
               CAST(et AS DATE) IS DISTINCT FROM
                   lag(CAST(et AS DATE)) OVER (PARTITION BY mid ORDER BY et, p.seq) AS uv
        FROM p LEFT JOIN marks USING (seq))
    SELECT {_labels(5, '%Y%m%d')}, vc, ch, ar, is_new,
           {_ones('uv')} AS uv_ct, {_ones('sv')} AS sv_ct, count(*) AS pv_ct,
           CAST(sum(during_time) AS BIGINT) AS dur_sum
    FROM flagged GROUP BY w, vc, ch, ar, is_new
    """


def _split(columns: str, where: str, source: str = "log") -> str:
    return f"WITH {FIXED_LOG} SELECT {columns} FROM {source} WHERE {where}"


ORACLE_SQL: dict[str, str] = {
    "order_users_10s": _daily(
        "SELECT user_id, ts, event_id AS id FROM events WHERE event_type = 'purchase'",
        "user_id",
        10,
        f"count(*) AS order_unique_user_count, {_ones('pd IS NULL')} AS order_new_user_count",
    ),
    "payment_users_10s": _daily(
        "SELECT o_custkey AS user_id, o_orderkey AS id, "
        "o_orderdate + to_seconds(o_orderkey % 3600) AS ts "
        "FROM orders WHERE o_orderpriority <> '5-LOW'",
        "user_id",
        10,
        "count(*) AS payment_suc_unique_user_count, "
        f"{_ones('pd IS NULL')} AS payment_suc_new_user_count",
    ),
    "cart_users_5s": _daily(
        f"SELECT user_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts, "
        f"event_id AS id FROM ({CART})",
        "user_id",
        5,
        "count(*) AS cart_add_uu_ct",
    ),
    "login_returning_10s": _logins(8),
    "login_returning_7d": _logins(7),
    "login_pages_10s": _daily(
        f"WITH {LOG} SELECT uid, et AS ts, seq AS id FROM log0 "
        "WHERE is_page AND uid IS NOT NULL AND last_page_id = 'login'",
        "uid",
        10,
        f"{_ones('pd IS NOT NULL AND d - pd >= 8')} AS back_ct, count(*) AS uu_ct",
    ),
    "home_detail_uv_5s": _daily(
        f"WITH {LOG} SELECT mid, page_id, et AS ts, seq AS id FROM log0 "
        "WHERE is_page AND page_id IN ('home', 'good_detail')",
        "mid, page_id",
        5,
        "count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct, "
        "count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct",
    ),
    "page_multi_dim_5s": _pages(LOG, "(SELECT *, is_new0 AS is_new FROM log0)"),
    "register_count_5s": f"""
        SELECT {_labels(5)}, count(*) AS register_ct
        FROM (SELECT {_window('ts', 5)} AS w FROM events WHERE event_type = 'signup')
        GROUP BY w
    """,
    "login_sliding_1h_5m": f"""
        WITH s AS (
            SELECT user_id,
                   make_timestamp((epoch_us(ts) // 300000000 - back) * 300000000) AS w
            FROM events CROSS JOIN range(12) AS b(back) WHERE event_type = 'signup')
        SELECT user_id, strftime(w, '{DATETIME}') AS stt,
               strftime(w + INTERVAL 1 HOUR, '{DATETIME}') AS edt, count(*) AS login_count
        FROM s GROUP BY user_id, w
    """,
    "keyword_counts": f"""
        WITH t AS (
            SELECT make_timestamp(((1704067200 + doc_id) // 5) * 5000000) AS w,
                   unnest({WORDS}) AS keyword
            FROM documents)
        SELECT {_labels(5)}, keyword, count(*) AS keyword_count FROM t GROUP BY w, keyword
    """,
    "keyword_lateral": f"""
        SELECT source, keyword, count(*) AS keyword_count
        FROM (SELECT source, unnest({WORDS}) AS keyword FROM documents)
        GROUP BY source, keyword
    """,
    "coupon_abuse": _followed(60),
    "coupon_abuse_1h": _followed(3600),
    "order_detail_wide": f"WITH {DETAIL} SELECT {WIDE_COLUMNS} FROM wide",
    "order_cancel": f"""
        WITH {DETAIL},
        gone AS (SELECT {_text('o_orderkey')} AS order_id, o_orderdate,
                        {_seconds('o_orderdate')} + 600 AS ts
                 FROM orders WHERE o_orderstatus = 'F')
        SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
               activity_rule_id, coupon_id, strftime(o_orderdate, '{DATE}') AS date_id,
               strftime(o_orderdate, '{DATETIME}') AS cancel_time, sku_num,
               split_original_amount, split_activity_amount, split_coupon_amount,
               split_total_amount, gone.ts
        FROM wide JOIN gone USING (order_id)
    """,
    "payment_interval": f"""
        WITH {DETAIL},
        paid AS (SELECT {_text('o_orderkey')} AS order_id, {_text('o_orderkey % 30')} AS code,
                        {_seconds('o_orderdate')} + o_orderkey % 3600 AS ts
                 FROM orders WHERE o_orderpriority <> '5-LOW')
        SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id,
               activity_id, activity_rule_id, coupon_id, code AS payment_type_code,
               dic_name AS payment_type_name,
               strftime(make_timestamp(paid.ts * 1000000), '{DATETIME}') AS callback_time, sku_num,
               split_original_amount, split_activity_amount, split_coupon_amount,
               split_total_amount AS split_payment_amount, paid.ts
        FROM paid JOIN wide USING (order_id) JOIN dic ON code = dic_code
        WHERE wide.ts >= paid.ts - 30 * 86400 AND wide.ts <= paid.ts + 5
    """,
    "payment_interval_minutes": """
        SELECT p.user_id, p.event_id AS payment_id, c.event_id AS detail_id
        FROM events p JOIN events c ON p.user_id = c.user_id
         AND c.ts >= p.ts - INTERVAL 30 MINUTE AND c.ts <= p.ts + INTERVAL 5 SECOND
        WHERE p.event_type = 'purchase' AND c.event_type = 'click'
    """,
    "order_refund": f"""
        WITH {DETAIL}
        SELECT {LINE_ID} AS id, {_text('l_suppkey')} AS user_id, {_text('l_orderkey')} AS order_id,
               {_text('l_partkey')} AS sku_id, {_text('o_custkey % 34')} AS province_id,
               strftime(l_shipdate, '{DATE}') AS date_id,
               strftime(l_shipdate, '{DATETIME}') AS create_time,
               a.dic_code AS refund_type_code, a.dic_name AS refund_type_name,
               b.dic_code AS refund_reason_type, b.dic_name AS refund_reason_type_name,
               'status ' || l_linestatus AS refund_reason_txt,
               {_text('CAST(l_quantity AS INTEGER)')} AS refund_num,
               {_money('l_extendedprice')} AS refund_amount,
               {_seconds('l_shipdate')} + l_linenumber * 60 AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'P'
        JOIN dic a ON a.dic_code = {_text('l_linenumber')}
        JOIN dic b ON b.dic_code = {_text('l_partkey % 30')}
        WHERE l_returnflag = 'R'
    """,
    "refund_payment": f"""
        WITH {DETAIL},
        r AS (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS INTEGER)) AS num,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS amount,
                     min(l_shipdate) AS back
              FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_partkey)
        SELECT l_orderkey || '-' || l_partkey AS id, {_text('o_custkey')} AS user_id,
               {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
               {_text('o_custkey % 34')} AS province_id, dic_code AS payment_type_code,
               dic_name AS payment_type_name, strftime(back, '{DATE}') AS date_id,
               strftime(back, '{DATETIME}') AS callback_time,
               {_text('num')} AS refund_num, {_text('amount')} AS refund_amount,
               {_seconds('back')} AS ts
        FROM r JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'O'
        JOIN dic ON dic_code = {_text('l_orderkey % 30')}
        WHERE l_orderkey % 10 <> 0
    """,
    "comment_lookup": f"""
        SELECT {_text('doc_id')} AS id, {_text('doc_id % 150')} AS user_id,
               {_text('n_chars % 2000')} AS sku_id, {_text('n_chars % 30')} AS appraise,
               n_name AS appraise_name, text AS comment_txt, doc_id + 1704067200 AS ts
        FROM documents JOIN nation ON n_nationkey = n_chars % 30
    """,
    "comment_lookup_at": f"""
        WITH n AS (
            SELECT *, 10 * (n_nationkey + 1) AS since,
                   CASE WHEN n_nationkey % 7 = 3 THEN 'd' WHEN n_nationkey % 2 = 0 THEN 'u' END AS op
            FROM nation)
        SELECT {_text('doc_id')} AS id, {_text('doc_id % 150')} AS user_id,
               {_text('n_chars % 2000')} AS sku_id, {_text('n_chars % 30')} AS appraise,
               CASE WHEN op = 'u' AND doc_id >= since THEN 'NEW ' || n_name ELSE n_name END AS appraise_name,
               doc_id + 1704067200 AS ts
        FROM documents JOIN n ON n_nationkey = n_chars % 30
        WHERE op IS DISTINCT FROM 'd' OR doc_id < since
    """,
    "cart_add": f"""
        SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id, {_text('k')} AS sku_id,
               CASE WHEN added THEN num ELSE CAST(k AS INTEGER) END AS sku_num,
               CASE WHEN added THEN num ELSE CAST(num - k AS INTEGER) END AS sku_num_added,
               {_seconds('ts')} AS ts
        FROM ({CART})
    """,
    "new_visitor_fix": f"WITH {FIXED_LOG} SELECT seq, mid, is_new FROM log",
    "log_split_start": _split(
        "seq, mid, uid, ch, is_new, CAST(k AS VARCHAR) AS loading_time, ts", "ch = 'signup'"
    ),
    "log_split_display": _split(
        "seq, CAST(k + place AS VARCHAR) AS item, CAST(place AS VARCHAR) AS pos_id, ch, mid, "
        "uid, is_new, CAST(ts AS VARCHAR) AS ts",
        "ch IN ('view', 'purchase')",
        "log CROSS JOIN (VALUES (1), (2)) AS p(place)",
    ),
    "log_split_action": _split(
        "seq, CAST(k AS VARCHAR) AS item, 'cart_add' AS action_id, ch, mid, is_new, "
        "CAST(seq AS VARCHAR) AS ts",
        "ch = 'click'",
    ),
    "log_split_err": _split(
        "seq, mid, uid, ch, is_new, CAST(k + 1000 AS VARCHAR) AS error_code, ts", "ch = 'error'"
    ),
    "log_split_page": _split(
        "seq, mid, uid, ch, is_new, page_id, last_page_id, item, "
        "CAST(during_time AS VARCHAR) AS during_time, sid, ts",
        "is_page",
    ),
    "log_fan_out": """
        WITH n AS (SELECT count(*) FILTER (WHERE event_type = 'signup') AS s,
                          count(*) FILTER (WHERE event_type = 'error') AS e,
                          count(*) FILTER (WHERE event_type = 'click') AS c,
                          count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS v
                   FROM events)
        SELECT 'dwd_traffic_start' AS topic, s AS records FROM n
        UNION ALL SELECT 'dwd_traffic_err', e FROM n
        UNION ALL SELECT 'dwd_traffic_action', c FROM n
        UNION ALL SELECT 'dwd_traffic_display', 2 * v FROM n
        UNION ALL SELECT 'dwd_traffic_page', c + v FROM n
    """,
    "dim_routing": f"""
        WITH r AS (
            SELECT 'dim_user_info' AS sink_table, {_text('c_custkey')} AS row_key,
                   'insert' AS op_type,
                   [('id', {_text('c_custkey')}), ('name', c_name),
                    ('segment', c_mktsegment)] AS cells
            FROM customer
            UNION ALL
            SELECT 'dim_sku_info', {_text('p_partkey')},
                   CASE WHEN p_size % 10 = 0 THEN 'delete' ELSE 'bootstrap-insert' END,
                   [('id', {_text('p_partkey')}), ('name', p_name), ('brand', p_brand)]
            FROM part
            UNION ALL
            SELECT 'dim_supplier_info', {_text('s_suppkey')}, 'update',
                   [('id', {_text('s_suppkey')}), ('name', s_name)]
            FROM supplier
            UNION ALL
            SELECT 'dim_base_province', {_text('n_nationkey')}, 'insert',
                   [('id', {_text('n_nationkey')}), ('name', n_name),
                    ('region_id', {_text('n_regionkey')})]
            FROM nation),
        e AS (SELECT sink_table, row_key, op_type, unnest(cells) AS c FROM r)
        SELECT sink_table, 'info' AS sink_family, row_key, op_type,
               c[1] AS col, c[2] AS value FROM e
    """,
    "dim_upsert": f"""
        WITH c AS (
            SELECT user_id, event_type AS kind, {K} AS k, epoch_us(ts) // 1000000 AS s, event_id,
                   max(CASE WHEN event_type = 'error'
                            THEN (epoch_us(ts) // 1000000) * 1000000000 + event_id END)
                       OVER (PARTITION BY user_id) AS gone
            FROM events),
        live AS (SELECT *, s * 1000000000 + event_id AS pos FROM c
                 WHERE gone IS NULL OR s * 1000000000 + event_id > gone),
        profile AS (
            SELECT {_text('user_id')} AS row_key,
                   [('id', {_text('user_id')}),
                    ('last_k', CAST(max_by(k, pos) FILTER (WHERE k >= 10) AS VARCHAR)),
                    ('last_type', max_by(kind, pos))] AS cells
            FROM live GROUP BY user_id),
        r AS (
            SELECT 'dim_user_profile' AS sink_table, row_key, cells FROM profile
            UNION ALL
            SELECT 'dim_user_info', {_text('c_custkey')},
                   [('id', {_text('c_custkey')}), ('name', c_name), ('segment', c_mktsegment)]
            FROM customer
            UNION ALL
            SELECT 'dim_sku_info', {_text('p_partkey')},
                   [('id', {_text('p_partkey')}), ('name', p_name), ('brand', p_brand)]
            FROM part WHERE p_size % 10 <> 0
            UNION ALL
            SELECT 'dim_supplier_info', {_text('s_suppkey')},
                   [('id', {_text('s_suppkey')}), ('name', s_name)]
            FROM supplier
            UNION ALL
            SELECT 'dim_base_province', {_text('n_nationkey')},
                   [('id', {_text('n_nationkey')}), ('name', n_name),
                    ('region_id', {_text('n_regionkey')})]
            FROM nation),
        e AS (SELECT sink_table, row_key, unnest(cells) AS c FROM r)
        SELECT sink_table, row_key, c[1] AS col, c[2] AS value FROM e WHERE c[2] IS NOT NULL
    """,
    "rules_change": f"""
        WITH {RULED}
        SELECT event_id AS seq, sink_table, op AS op_type, {_text('user_id')} AS id,
               CASE WHEN list_contains(listed, 'k') THEN {_text('k')} END AS k,
               CASE WHEN list_contains(listed, 'kind') THEN event_type END AS kind,
               CAST(NULL AS VARCHAR) AS unlisted
        FROM routed
        UNION ALL
        SELECT event_id, sink_table, NULL, {_text('user_id')},
               CASE WHEN list_contains(listed, 'k') THEN {_text('k')} END,
               CASE WHEN list_contains(listed, 'kind') THEN event_type END, NULL
        FROM fact_routed
    """,
    "dim_lifecycle": f"""
        WITH {RULED},
        steps AS (
            SELECT sink_table AS t, n, op, since FROM rules WHERE n >= 0
            UNION ALL
            SELECT before_sink, n - 0.5, 'd', since FROM rules WHERE op = 'u' AND before_sink <> sink_table),
        lives AS (
            SELECT t, count(*) FILTER (WHERE op IN ('d', 'u')) AS now, max_by(op, n) <> 'd' AS present
            FROM steps GROUP BY t),
        placed AS (
            SELECT r.*, (SELECT count(*) FROM steps
                         WHERE t = r.sink_table AND steps.op IN ('d', 'u') AND steps.since <= r.s * 1000) AS gen
            FROM routed r),
        alive AS (
            SELECT p.*, s * 1000000000 + event_id AS pos,
                   max(CASE WHEN op = 'delete' THEN s * 1000000000 + event_id END)
                       OVER (PARTITION BY sink_table, user_id) AS gone
            FROM placed p LEFT JOIN lives ON t = sink_table
            WHERE t IS NULL OR (present AND gen = now)),
        written AS (
            SELECT sink_table, user_id, pos, unnest([
                       ('id', {_text('user_id')}),
                       ('k', CASE WHEN list_contains(listed, 'k') THEN {_text('k')} END),
                       ('kind', CASE WHEN list_contains(listed, 'kind') THEN event_type END)]) AS c
            FROM alive WHERE op <> 'delete' AND (gone IS NULL OR pos > gone))
        SELECT sink_table, {_text('user_id')} AS row_key, c[1] AS col, max_by(c[2], pos) AS value
        FROM written WHERE c[2] IS NOT NULL GROUP BY sink_table, user_id, c[1]
    """,
    "fact_routing": f"""
        SELECT CASE event_type WHEN 'purchase' THEN 'dwd_tool_coupon_get'
                               WHEN 'click' THEN 'dwd_tool_coupon_use'
                               WHEN 'view' THEN 'dwd_interaction_favor_add'
                               ELSE 'dwd_user_register' END AS sink_table,
               {_text('event_id')} AS id,
               CASE WHEN event_type <> 'signup' THEN {_text('user_id')} END AS user_id,
               CASE WHEN event_type IN ('purchase', 'view') THEN {_text(K)} END AS k,
               CAST(NULL AS VARCHAR) AS extra, {_seconds('ts')} AS ts
        FROM events WHERE event_type <> 'error'
    """,
    "upsert_log_table": f"""
        SELECT {_text('user_id')} AS key, {_text('user_id')} AS user_id, {_text(K)} AS k, event_type AS kind
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000 DESC, event_id DESC) = 1
            AND event_type <> 'error'
    """,
    "change_log_json": f"""
        WITH {SPOILED}
        SELECT event_id AS seq, {_error('missing table')},
               {_if_good("CASE event_type WHEN 'purchase' THEN 'coupon_use' WHEN 'click' THEN 'coupon_use' "
                         "WHEN 'view' THEN 'favor_info' WHEN 'signup' THEN 'user_info' ELSE 'order_status_log' END")} AS "table",
               {_if_good("CASE WHEN event_type = 'click' THEN 'update' ELSE 'insert' END")} AS type,
               {_if_good(_text('event_id'))} AS id, {_if_good(_text('user_id'))} AS user_id, {_if_good(_text(K))} AS k,
               {_if_good(_seconds('ts'))} AS ts, {_if_good(_seconds('ts'))} AS et_s
        FROM spoiled
    """,
    "behavior_log_json": f"""
        WITH {LOG}, {SPOILED}
        SELECT seq, {_error('missing common')},
               {_if_good('mid')} AS mid, {_if_good('uid')} AS uid, {_if_good('is_new0')} AS is_new,
               {_if_good("CASE WHEN ch = 'signup' THEN CAST(k AS VARCHAR) END")} AS loading_time,
               {_if_good('CASE WHEN is_page THEN page_id END')} AS page_id,
               {_if_good('CASE WHEN is_page THEN CAST(during_time AS VARCHAR) END')} AS during_time,
               {_if_good("CASE WHEN ch IN ('view', 'purchase') THEN 2 ELSE 0 END")} AS displays,
               {_if_good("CASE WHEN ch = 'click' THEN 1 ELSE 0 END")} AS actions,
               {_if_good("CASE WHEN ch = 'error' THEN CAST(k + 1000 AS VARCHAR) END")} AS error_code,
               {_if_good('sid')} AS sid, {_if_good('log0.ts')} AS ts
        FROM log0 JOIN spoiled ON event_id = seq
    """,
    "shop_events_json": f"""
        WITH {SPOILED}
        SELECT event_id AS seq, {_error('missing userId')}, {_if_good(_text('user_id'))} AS user_id,
               {_if_good("CASE event_type WHEN 'signup' THEN 'login' WHEN 'click' THEN 'couponRedemption' "
                         "WHEN 'view' THEN 'quickBrowse' WHEN 'purchase' THEN 'quickPurchase' ELSE 'other' END")} AS event_type,
               {_if_good("CASE WHEN event_type <> 'error' THEN " + _seconds('ts') + " END")} AS et_s
        FROM spoiled
    """,
    "metric_events_json": f"""
        WITH {SPOILED}
        SELECT event_id AS seq, {_error('missing event_time')}, {_if_good('CAST(user_id AS INTEGER)')} AS user_id_int,
               {_if_good("CASE WHEN event_type = 'signup' THEN 'LOGIN_SUCCESS' ELSE upper(event_type) END")} AS event_name,
               {_if_good('event_type')} AS event_type, {_if_good("'p' || " + K)} AS province,
               {_if_good("'gold'")} AS grade, {_if_good('CAST(CAST(value AS DECIMAL(16,2)) AS DOUBLE)')} AS price,
               {_if_good(_seconds('ts'))} AS et_s
        FROM spoiled
    """,
    "arrival_day_changes": """
        WITH o AS (
            SELECT user_id, CAST(ts AS DATE) AS d,
                   lag(CAST(ts AS DATE)) OVER (
                       PARTITION BY user_id ORDER BY event_id // 1000, -event_id) AS pd
            FROM events)
        SELECT user_id, count(*) FILTER (WHERE pd IS NULL OR pd <> d) AS unique_days,
               count(*) FILTER (WHERE pd IS NULL) AS first_seen
        FROM o GROUP BY user_id
    """,
    "event_time_texts": f"""
        SELECT event_id, strftime(ts, '{DATE}') AS date_text,
               strftime(ts, '{DATETIME}') AS datetime_text, strftime(ts, '%Y%m%d') AS compact_text,
               CAST((epoch_us(ts) // 1000000) * 1000 - 28800000 AS BIGINT) AS writer_millis,
               CAST(epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) - 28800000 AS BIGINT)
                   AS writer_day_millis
        FROM events
    """,
}

ORACLE_SQL["olap_lines"] = ORACLE_SQL["order_users_10s"]

# Orders and refunds whose parts come apart; only those near enough meet.
MOMENTS = f"""
    e AS (SELECT event_id, user_id, event_type, {K} AS k, epoch_us(ts) // 1000000 AS s, value FROM events),
    line AS (
        SELECT {_text('event_id')} AS id, {_text('event_id')} AS order_id, {_text('user_id')} AS user_id,
               {_text('k')} AS sku_id, 'sku#' || k AS sku_name, {_text('k % 34')} AS province_id,
               CASE WHEN k % 2 = 0 AND k % 8 <= 5 THEN {_text('k % 10')} END AS activity_id,
               CASE WHEN k % 2 = 0 AND k % 8 <= 5 THEN {_text('k')} END AS activity_rule_id,
               CASE WHEN k % 3 = 0 AND k % 7 <= 5 THEN {_text('k % 100')} END AS coupon_id,
               strftime(make_timestamp(s * 1000000), '{DATE}') AS date_id,
               strftime(make_timestamp(s * 1000000), '{DATETIME}') AS create_time, '2' AS sku_num,
               CAST(CAST(2 AS DECIMAL(16,2)) * CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
               '0.00' AS split_activity_amount, '0.00' AS split_coupon_amount, {_money('value')} AS split_total_amount,
               s AS ts, k
        FROM e WHERE event_type = 'purchase' AND k % 11 <> 0 AND k % 9 - 1 <= 5)
"""
ORACLE_SQL["stream_order_detail_moments"] = f"WITH {MOMENTS} SELECT {WIDE_COLUMNS} FROM line"
ORACLE_SQL["stream_order_cancel_moments"] = f"""
    WITH {MOMENTS}
    SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
           date_id, create_time AS cancel_time, sku_num, split_original_amount, split_activity_amount,
           split_coupon_amount, split_total_amount, CAST(ts + k * 20 AS BIGINT) AS ts
    FROM line WHERE k % 4 = 0 AND k * 20 <= 905
"""
ORACLE_SQL["stream_refund_payment_moments"] = f"""
    WITH {MOMENTS}
    SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id, {_text('event_id')} AS order_id,
           {_text('k')} AS sku_id, {_text('k % 34')} AS province_id, {_text('k % 25')} AS payment_type_code,
           n_name AS payment_type_name, strftime(make_timestamp(s * 1000000), '{DATE}') AS date_id,
           strftime(make_timestamp(s * 1000000), '{DATETIME}') AS callback_time, '1' AS refund_num,
           {_money('value')} AS refund_amount, CAST(s AS BIGINT) AS ts
    FROM e JOIN nation ON n_nationkey = k % 25
    WHERE event_type = 'view' AND k % 8 <= 5 AND k % 7 <= 5
"""

# The streaming jobs must give what the batch jobs give.
for _name in (
    "order_users_10s",
    "login_returning_10s",
    "login_sliding_1h_5m",
    "payment_interval_minutes",
    "coupon_abuse_1h",
    "log_fan_out",
    "dim_upsert",
    "rules_change",
    "dim_lifecycle",
    "comment_lookup_at",
):
    ORACLE_SQL[f"stream_{_name}"] = ORACLE_SQL[_name]

# The streaming path repairs visitors first.
ORACLE_SQL["stream_page_multi_dim_5s"] = _pages(FIXED_LOG, "log")
