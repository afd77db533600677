"""The mapping of ``standins`` as SQL, in the dialect of the checking database.

``using("a", "b")`` gives a WITH clause holding the named relations and all they need.
"""

from __future__ import annotations

from tidemark.plans import standins as T


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def ms(column: str) -> str:
    return f"(epoch_us({column}) // 1000)"


def money(cents: str) -> str:
    return f"CAST(CAST(({cents}) / 100.0 AS DECIMAL(16,2)) AS VARCHAR)"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def tag_ms(key: str, factor: int) -> str:
    return f"({T.MONTH_START_MS} + ({key} * {factor}) % {T.MONTH_SECONDS} * 1000)"


def dt(ms_expr: str) -> str:
    """Epoch milliseconds as date-time text, UTC."""
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%d %H:%M:%S')"


def day(ms_expr: str) -> str:
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%d')"


def bounds(ms_expr: str, width: int) -> str:
    """stt, edt and cur_date of the tumbling window holding a time."""
    start = f"({ms_expr}) // {width} * {width}"
    return f"{dt(start)} AS stt, {dt(start + ' + ' + str(width))} AS edt, {day(start)} AS cur_date"


def latest(relation: str, keys: str, order: str, rest: str = "", first: bool = False) -> str:
    """The highest (or lowest) row per key by ``order`` then ``rest``; nulls are lowest."""
    way = "ASC NULLS FIRST" if first else "DESC NULLS LAST"
    by = ", ".join(f"{c.strip()} {way}" for c in (order + ("," + rest if rest else "")).split(","))
    return (f"(SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rn_ "
            f"FROM {relation}) WHERE rn_ = 1)")


def _order_info(ms_expr: str) -> str:
    total = money("CAST(round(o_totalprice * 100) AS BIGINT)")
    return f"""
      SELECT {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id, {text('c_nationkey')} AS province_id,
        CASE o_orderstatus WHEN 'F' THEN '1006' WHEN 'O' THEN '1001' WHEN 'P' THEN '1003' END AS order_status,
        {text(ms_expr)} AS operate_time, c_name AS consignee, {text(ms_expr)} AS create_time,
        {total} AS original_total_amount, {total} AS total_amount, {ms_expr} AS ts_ms
      FROM orders JOIN customer ON o_custkey = c_custkey"""


def _lines(ms_expr: str) -> str:
    return f"""
      SELECT l_orderkey || '-' || l_linenumber AS id, {text('l_orderkey')} AS order_id, {text('l_partkey')} AS sku_id,
        'sku ' || l_partkey AS sku_name, {text('ts_ms')} AS create_time, {text('l_suppkey')} AS source_id,
        l_returnflag || '-' || l_linestatus AS source_type, {text('qty')} AS sku_num,
        {money('(cents * 2 + qty) // (qty * 2)')} AS order_price, {money('cents')} AS split_total_amount,
        {money('(cents * disc + 50) // 100')} AS split_activity_amount,
        {money('(cents * tax + 50) // 100')} AS split_coupon_amount,
        ts_ms, disc, tax, l_returnflag, l_linestatus, l_linenumber
      FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty,
              CAST(round(l_discount * 100) AS BIGINT) AS disc, CAST(round(l_tax * 100) AS BIGINT) AS tax,
              {ms_expr} AS ts_ms FROM lineitem)"""


_DETAIL = ", ".join(T.DETAIL_FIELDS)

RELATIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_info": (_order_info(ms("o_orderdate")), ()),
    "tag_order_info": (_order_info(tag_ms("o_orderkey", 7919)), ()),
    "lines": (_lines(ms("l_shipdate")), ()),
    "tag_lines": (_lines(f"({tag_ms('l_orderkey', 7919)} + (l_linenumber * 45 - 150) * 1000)"), ()),
    "order_detail": (f"SELECT {_DETAIL} FROM lines", ("lines",)),
    "tag_order_detail": (f"SELECT {_DETAIL} FROM tag_lines", ("tag_lines",)),
    "order_detail_activity": (
        f"SELECT id AS order_detail_id, source_id AS activity_id, {text('disc')} AS activity_rule_id, ts_ms FROM lines "
        "WHERE disc > 5", ("lines",)),
    "order_detail_coupon": (
        f"SELECT id AS order_detail_id, {text('tax')} AS coupon_id, ts_ms FROM lines WHERE tax > 4", ("lines",)),
    "payment_info": (f"""
      SELECT {text('o_custkey')} AS user_id, {text('o_orderkey')} AS order_id, o_orderpriority AS payment_type,
        {text(ms('o_orderdate') + ' + 3600000')} AS callback_time,
        CASE WHEN o_orderstatus = 'F' THEN '1602' ELSE '1601' END AS payment_status,
        {ms('o_orderdate')} + 3600000 AS ts_ms FROM orders""", ()),
    "order_refund_info": (f"""
      SELECT 'R' || id AS id, source_id AS user_id, order_id, sku_id, '150' || (l_linenumber % 3) AS refund_type,
        sku_num AS refund_num, split_total_amount AS refund_amount, '13' || disc AS refund_reason_type,
        'reason ' || l_linenumber AS refund_reason_txt, create_time,
        CASE WHEN l_linestatus = 'O' THEN '0705' ELSE '0701' END AS refund_status, ts_ms
      FROM lines WHERE l_returnflag = 'R'""", ("lines",)),
    "refund_payment": (f"""
      SELECT 'P' || id AS id, order_id, sku_id, '110' || (l_linenumber % 3) AS payment_type,
        {text('ts_ms + 3600000')} AS callback_time, split_total_amount AS total_amount,
        CASE WHEN tax > 2 THEN '1602' ELSE '1601' END AS refund_status, ts_ms + 3600000 AS ts_ms
      FROM lines WHERE l_returnflag = 'R'""", ("lines",)),
    "comment_info": (f"""
      SELECT {text('event_id')} AS id, {text('user_id')} AS user_id, {text('event_id % 100')} AS sku_id,
        {text('event_id % 6')} AS appraise, 'comment ' || event_id AS comment_txt, {text(ms('ts'))} AS create_time,
        {ms('ts')} AS ts_ms FROM events WHERE event_type = 'click'""", ()),
    "cart_info": (f"""
      SELECT {text('event_id')} AS id, {text('user_id')} AS user_id, {text('event_id % 100')} AS sku_id,
        event_id % 5 + 1 AS sku_num, event_id % 4 + 1 AS old_num, ['r','c','u'][event_id % 3 + 1] AS op, {ms('ts')} AS ts_ms
      FROM events WHERE event_type = 'purchase'""", ()),
    "user_info": (f"""
      SELECT {text('c_custkey')} AS id, c_name AS name, 'nick ' || c_custkey AS nick_name, {text('c_custkey % 3')} AS user_level,
        lower(c_name) AS login_name, '1380000' || c_custkey AS phone_num, lower(c_name) || '@example.com' AS email,
        CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender, 3000 + c_custkey * 13 % 9000 AS birthday,
        {tag_ms('c_custkey', 104729)} AS ts_ms FROM customer""", ()),
    "user_info_sup_msg": (f"""
      SELECT {text('c_custkey')} AS uid, 'cm' AS unit_height, {text('c_custkey % 50 + 150')} AS height, 'kg' AS unit_weight,
        {text('c_custkey % 50 + 45')} AS weight, {tag_ms('c_custkey', 104729)} AS create_ts,
        {tag_ms('c_custkey', 104729)} + (c_custkey % 13 - 6) * 60000 AS ts_ms FROM customer""", ()),
    "log": (f"""
      SELECT event_id, 'm' || user_id AS mid, {text('user_id')} AS uid, 'v2.1.' || (user_id % 3) AS vc,
        {_list(T.CHANNELS)}[user_id % 4 + 1] AS ch, {text('user_id % 25')} AS ar,
        CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END AS is_new, {_list(T.OSES)}[(user_id + event_id) % 3 + 1] AS os,
        {_list(T.MODELS)}[(user_id + event_id) % 5 + 1] AS md, {_list(T.MAKERS)}[(user_id + event_id) % 3 + 1] AS ba,
        's' || (event_id // 10) AS sid,
        CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
          WHEN 'purchase' THEN 'payment' ELSE 'mine' END AS page_id,
        CASE event_id % 4 WHEN 1 THEN 'search' WHEN 2 THEN 'login' WHEN 3 THEN 'home' END AS last_page_id,
        CASE WHEN event_id % 4 = 1 THEN {_list(T.CATEGORY_WORDS)}[(event_id // 4) % 6 + 1] END AS item,
        CASE WHEN event_id % 4 = 1 THEN 'keyword' END AS item_type, CAST(round(value * 1000) AS BIGINT) AS during_time,
        event_type = 'signup' AND event_id % 5 = 0 AS has_start, event_type = 'error' AS has_err,
        event_id % 3 AS entries, {ms('ts')} AS ts
      FROM events""", ()),
    "province": (f"SELECT {text('n_nationkey')} AS id, n_name AS name FROM nation", ()),
    "base_dic": (f"SELECT {text('r_regionkey')} AS dic_code, r_name AS dic_name FROM region", ()),
    "sku_info": (f"""
      SELECT {text('p_partkey')} AS id, {text('p_size')} AS spu_id, 'spu ' || p_size AS spu_name, p_brand AS tm_id,
        p_type AS category3_id FROM part""", ()),
    "spu_info": (f"SELECT {text('p_size')} AS id, min(p_type) AS category3_id, min(p_brand) AS tm_id FROM part GROUP BY 1", ()),
    "trademark": (f"""
      SELECT DISTINCT p_brand AS id, CASE WHEN CAST(split_part(p_brand, '#', 2) AS INT) % 7 < 6
        THEN {_list(T.BRAND_NAMES)}[CAST(split_part(p_brand, '#', 2) AS INT) % 7 + 1] ELSE p_brand END AS tm_name FROM part""", ()),
    "category3": (f"SELECT * FROM (VALUES {_values(T.CATEGORY3)}) t(id, name, category2_id)", ()),
    "category2": (f"SELECT * FROM (VALUES {_values(T.CATEGORY2)}) t(id, name, category1_id)", ()),
    "category1": (f"SELECT * FROM (VALUES {_values(T.CATEGORY1)}) t(id, name)", ()),
    "compare": (f"SELECT * FROM (VALUES {_values(T.COMPARE)}) t(id, category_name, search_category)", ()),
    "tree": ("""
      SELECT c3.id, c3.name AS b3name, c2.name AS b2name, c1.name AS b1name FROM category3 c3
      JOIN category2 c2 ON c3.category2_id = c2.id JOIN category1 c1 ON c2.category1_id = c1.id""",
             ("category3", "category2", "category1")),
    "brands": ("""
      SELECT s.id AS skuid, p.id AS spuid, p.category3_id AS c3id, t.tm_name AS tname FROM sku_info s
      JOIN spu_info p ON s.spu_id = p.id JOIN trademark t ON p.tm_id = t.id""", ("sku_info", "spu_info", "trademark")),
    "config": (f"""
      SELECT {_list(T.DIM_TABLES)}[n_nationkey % 5 + 1] AS source_table,
        'dim_' || {_list(T.DIM_TABLES)}[n_nationkey % 5 + 1] AS sink_table,
        {_list(T.DIM_COLUMNS)}[n_nationkey % 5 + 1] AS sink_columns, 'info' AS sink_family, 'id' AS sink_row_key,
        CASE WHEN n_nationkey < 5 THEN 'r' WHEN n_nationkey = 24 THEN 'd' ELSE 'u' END AS op,
        CAST(n_nationkey AS BIGINT) AS ts_ms FROM nation""", ()),
    "active_config": ("""
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, max(CASE WHEN op IN ('u','d') THEN ts_ms END) OVER (PARTITION BY source_table) AS emptied_at,
          row_number() OVER (PARTITION BY source_table ORDER BY ts_ms DESC) AS rn FROM config)
      WHERE rn = 1 AND op <> 'd'""", ("config",)),
}


def _needed(names, seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(RELATIONS[name][1], seen)
            if name not in seen:
                seen.append(name)
    return seen


def using(*names: str, **extra: str) -> str:
    """A WITH clause of the named relations, then the extra ones in the order given."""
    parts = [f"{n} AS ({RELATIONS[n][0]})" for n in _needed(names, [])]
    parts += [f"{n} AS ({body})" for n, body in extra.items()]
    return "WITH " + ", ".join(parts) + " "
