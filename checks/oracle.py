"""The SQL each query is compared with.

Written on its own terms (ranking windows, epochs, plain joins), not as a rendering of
the Spark plans.  Column names and types match ``checks.queries``.
"""

from __future__ import annotations

from checks.feeds import FEED_STATES, FEED_WAIT_MS
from parcelflow.functions.masking import EMAIL_PATTERN, MOBILE_PATTERN
from parcelflow.sources.schemas import ORDER_FACT_TIMES

SHIFT = "INTERVAL 8 HOUR"
EIGHT_HOURS = 8 * 3_600_000
DAY_MS = 86_400_000
DATETIME = "'%Y-%m-%d %H:%M:%S'"


def local(ms: str, fmt: str = DATETIME) -> str:
    """Local text of an instant in ms."""
    return f"strftime(make_timestamp(({ms}) * 1000) + {SHIFT}, {fmt})"


def day(ms: str) -> str:
    return f"CAST((({ms}) + {EIGHT_HOURS}) // {DAY_MS} AS INTEGER)"


def date_of(ts: str) -> str:
    return f"CAST({ts} + {SHIFT} AS DATE)"


OP = """CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_id % 10 <= 3 THEN 'c'
        WHEN event_id % 10 = 4 THEN 'r' ELSE 'u' END"""

FEED = f"""base AS (
  SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(16,2)) AS val, epoch_us(ts) // 1000 AS at_ms,
         CASE WHEN event_type IN ('click', 'purchase') THEN epoch_us(ts) // 1000 END AS sort_ms,
         CASE WHEN event_type IN ('purchase', 'error') THEN epoch_us(ts) // 1000 END AS out_ms,
         {OP} AS op
  FROM events),
feed AS (
  SELECT *, op IN ('u', 'd') AND lag(event_id) OVER w IS NOT NULL AS has_before,
         CASE WHEN op IN ('u', 'd') THEN lag(event_id) OVER w END AS b_event_id,
         CASE WHEN op IN ('u', 'd') THEN lag(user_id) OVER w END AS b_user_id,
         CASE WHEN op IN ('u', 'd') THEN lag(sort_ms) OVER w END AS b_sort_ms,
         CASE WHEN op IN ('u', 'd') THEN lag(out_ms) OVER w END AS b_out_ms
  FROM base WINDOW w AS (PARTITION BY user_id ORDER BY at_ms, event_id))"""

STATES = "[" + ", ".join(f"'{s}'" for s in FEED_STATES) + "]"

SWITCH = """CASE WHEN old_status IS NOT DISTINCT FROM status THEN NULL
       WHEN old_status = '60010' AND status = '60020' THEN 'dwd_trade_pay_suc_detail'
       WHEN old_status = '60020' AND status = '60030' THEN 'dwd_trans_receive_detail'
       WHEN old_status = '60040' AND status = '60050' THEN 'dwd_trans_dispatch_detail'
       WHEN old_status = '60050' AND status = '60060' THEN 'dwd_trans_bound_finish_detail'
       WHEN old_status = '60060' AND status = '60070' THEN 'dwd_trans_deliver_detail'
       WHEN old_status = '60070' AND status = '60080' THEN 'dwd_trans_sign_detail'
       WHEN status = '60999' THEN 'dwd_trade_cancel_detail' END"""

ORDER_FEED = f"""raw AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS at_ms,
         epoch_us(date_trunc('second', ts)) // 1000 AS sec_ms, CAST(props->>'$.k' AS INTEGER) AS k
  FROM events),
stated AS (
  SELECT *, event_type = 'signup' AS is_cargo, event_type = 'view' AS is_new,
         CASE WHEN event_type = 'view' THEN '60010' WHEN event_type <> 'signup' THEN {STATES}[k % 9 + 1] END AS status
  FROM raw),
aged AS (
  SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY at_ms, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old_status
  FROM stated),
switched AS (
  SELECT *, CASE WHEN NOT is_cargo AND NOT is_new THEN {SWITCH} END AS change FROM aged)"""

LIFECYCLE = f"""{ORDER_FEED},
epochs AS (
  SELECT *, coalesce(sum(CASE WHEN change IN ('dwd_trans_sign_detail', 'dwd_trade_cancel_detail') THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY at_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
  FROM switched),
known AS (
  SELECT *, last_value(CASE WHEN is_cargo THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, epoch
            ORDER BY at_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cargo_event
  FROM epochs),
waiting AS (
  SELECT *, last_value(CASE WHEN is_new AND cargo_event IS NULL THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id
            ORDER BY at_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS waiting_event
  FROM known),
pairs AS (
  SELECT CASE WHEN is_cargo THEN 'dwd_trade_order_detail' WHEN is_new THEN 'dwd_trade_order_detail' ELSE change END AS fact_type,
         CASE WHEN is_cargo THEN event_id ELSE cargo_event END AS cargo_event,
         CASE WHEN is_cargo THEN waiting_event ELSE event_id END AS order_event
  FROM waiting x
  WHERE (is_cargo AND at_ms - (SELECT r.at_ms FROM raw r WHERE r.event_id = x.waiting_event) < {FEED_WAIT_MS})
     OR (NOT is_cargo AND cargo_event IS NOT NULL AND (is_new OR change IS NOT NULL))),
lifecycle AS (
  SELECT fact_type, 'g' || c.event_id AS id, CAST(c.user_id AS VARCHAR) AS order_id, CAST(c.k % 25 AS VARCHAR) AS cargo_type,
         c.k AS volume_length, c.k + 1 AS volume_width, c.k + 2 AS volume_height, CAST(c.value AS DECIMAL(16,2)) AS weight,
         CASE WHEN fact_type = 'dwd_trade_order_detail' THEN c.sec_ms ELSE o.sec_ms END AS ts,
         'no-' || o.user_id AS order_no, o.status AS status, CAST(NULL AS VARCHAR) AS collect_type,
         CAST(o.user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS receiver_complex_id,
         CAST(NULL AS VARCHAR) AS receiver_province_id, CAST(o.k % 25 AS VARCHAR) AS receiver_city_id,
         CAST(o.k % 25 AS VARCHAR) AS receiver_district_id, 'R' || repeat('*', 2 + length(CAST(o.k AS VARCHAR))) AS receiver_name,
         CAST(NULL AS VARCHAR) AS sender_complex_id, CAST(NULL AS VARCHAR) AS sender_province_id,
         CAST(24 - o.k % 25 AS VARCHAR) AS sender_city_id, CAST(24 - o.k % 25 AS VARCHAR) AS sender_district_id,
         'S' || repeat('*', 2 + length(CAST(o.k AS VARCHAR))) AS sender_name, CAST(NULL AS VARCHAR) AS payment_type,
         o.k AS cargo_num, CAST(o.value AS DECIMAL(16,2)) AS amount,
         {local(f"o.at_ms + {DAY_MS} - {EIGHT_HOURS}")} AS estimate_arrive_time, CAST(NULL AS DECIMAL(16,2)) AS distance
  FROM pairs JOIN stated c ON c.event_id = pairs.cargo_event JOIN stated o ON o.event_id = pairs.order_event)"""

LIFECYCLE_ROWS = f"""WITH {LIFECYCLE}
SELECT fact_type, id, order_id, status, cargo_type, weight, amount, {local("ts")} AS event_time, ts FROM lifecycle"""

BOUND = f"""{FEED},
bound AS (
  SELECT 'dwd_bound_inbound' AS fact_type, *, at_ms AS fact_ms, 'in' || user_id AS emp FROM feed WHERE op = 'c'
  UNION ALL
  SELECT 'dwd_bound_sort', *, sort_ms, 'so' || user_id FROM feed
  WHERE op = 'u' AND has_before AND b_sort_ms IS NULL AND sort_ms IS NOT NULL
  UNION ALL
  SELECT 'dwd_bound_outbound', *, out_ms, 'out' || user_id FROM feed
  WHERE op = 'u' AND has_before AND b_out_ms IS NULL AND out_ms IS NOT NULL)"""


def bound_fact(fact: str, time: str, employee: str) -> str:
    return f"""WITH {BOUND}
SELECT CAST(event_id AS VARCHAR) AS id, 'o' || user_id AS order_id, CAST(user_id AS VARCHAR) AS org_id,
       {local("fact_ms")} AS {time}, emp AS {employee}, fact_ms AS ts
FROM bound WHERE fact_type = '{fact}'"""


def latest(where: str, apply_deletes: str) -> str:
    return f"""WITH {FEED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms DESC, event_id DESC) AS rn FROM feed WHERE {where})
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS event_id, event_type, val AS value, at_ms AS ts_ms
FROM ranked WHERE rn = 1 AND {apply_deletes}"""


ORGANS = """organ AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS org_name,
         CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey % 10 AS VARCHAR) END AS org_parent_id,
         CAST(s_nationkey AS VARCHAR) AS region_id
  FROM supplier),
district_org AS (
  SELECT region_id, id AS org_id, org_name FROM (
    SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY id) AS rn FROM organ WHERE region_id IS NOT NULL) WHERE rn = 1),
city_of AS (
  SELECT o.id, o.org_name, coalesce(o.org_parent_id, o.id) AS join_org_id, p.region_id AS city_id
  FROM organ o LEFT JOIN organ p ON p.id = coalesce(o.org_parent_id, o.id)),
region_info AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'P' || n_regionkey AS parent_id FROM nation
  UNION ALL SELECT 'P' || r_regionkey, r_name, NULL FROM region)"""

DETAILS = """details AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey || '-' || l_linenumber AS id,
         CAST(l_partkey % 25 AS VARCHAR) AS cargo_type, CAST(l_quantity AS DECIMAL(16,2)) AS weight,
         o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(16,2)) AS amount, o_orderdate
  FROM orders JOIN (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
    FROM lineitem) ON l_orderkey = o_orderkey AND rn = 1)"""

PLACED = """placed AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
         CAST(c_nationkey AS VARCHAR) AS district, 'P' || n_regionkey AS province
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

# Of all rows of a day and key, the carried columns of the first one.
def first_of(columns: str, rows: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    return f"""firsts AS (
  SELECT cur_date, org_id, {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY cur_date, org_id ORDER BY at_ms, {order}) AS rn FROM {rows}) WHERE rn = 1)"""


CONTACTS = """contacts AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_custkey % 2 = 0 THEN '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE '0' || c_custkey END AS phone,
         CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) || '_' || c_custkey || '@example.com'
              ELSE lower(c_mktsegment) || '_' || c_custkey END AS email,
         CAST(c_custkey % 20000 AS INTEGER) AS birth_days
  FROM customer)"""

PHONE = f"CASE WHEN regexp_full_match(phone, '{MOBILE_PATTERN}') THEN md5(phone) END"
EMAIL = f"CASE WHEN regexp_full_match(email, '{EMAIL_PATTERN}') THEN md5(email) END"
BIRTHDAY = "strftime(DATE '1970-01-01' + birth_days, '%Y-%m-%d')"

EVENTS_AT = "at_events AS (SELECT event_id, event_type, user_id, CAST(value AS DECIMAL(16,2)) AS val, epoch_us(ts) // 1000 AS at_ms FROM events)"
TICK = f"least((at_ms // 10000 + 1) * 10000, ({day('at_ms')} + CAST(1 AS BIGINT)) * {DAY_MS} - {EIGHT_HOURS} - 1)"

SNAPSHOTS = f"""{EVENTS_AT},
ticks AS (
  SELECT {day('at_ms')} AS day, event_type, {TICK} AS tick_ms, count(*) AS n, sum(val) AS v FROM at_events GROUP BY ALL),
snapshots AS (
  SELECT day, event_type, tick_ms, CAST(sum(n) OVER w AS BIGINT) AS n_events, CAST(sum(v) OVER w AS DECIMAL(38,2)) AS total_value
  FROM ticks WINDOW w AS (PARTITION BY day, event_type ORDER BY tick_ms))"""

DELIVERED = f"""{PLACED},
delivered AS (
  SELECT district, province, {date_of('l_shipdate')} AS cur_date, l_shipdate AS at_ms
  FROM lineitem JOIN placed ON o_orderkey = l_orderkey WHERE l_linestatus = 'F')"""


def places_mart(rows: str, measure: str) -> str:
    """Receive and deliver marts: org of the district, first city and province of the day."""
    return f"""keyed AS (
  SELECT cur_date, org_id, district AS city_id, province AS province_id, at_ms
  FROM {rows} LEFT JOIN district_org ON region_id = district),
{first_of("city_id, province_id", "keyed")},
totals AS (SELECT cur_date, org_id, count(*) AS n FROM keyed GROUP BY ALL)
SELECT t.cur_date, t.org_id, organ.org_name, f.city_id, c.name AS city_name, f.province_id, p.name AS province_name, n AS {measure}
FROM totals t JOIN firsts f ON f.cur_date = t.cur_date AND f.org_id IS NOT DISTINCT FROM t.org_id
LEFT JOIN organ ON organ.id = t.org_id LEFT JOIN region_info c ON c.id = f.city_id LEFT JOIN region_info p ON p.id = f.province_id"""


ORACLE: dict[str, str] = {
    "cdc_decode_filter": f"""WITH {FEED}
SELECT event_id, event_type AS source_table, op, at_ms AS ts_ms, val AS value, b_event_id AS before_event_id FROM feed WHERE op <> 'd'""",
    "cdc_rename_route": f"""WITH {FEED}
SELECT event_id, event_type AS source_table, op, at_ms AS ts_ms FROM feed WHERE op <> 'd' AND event_type IN ('click', 'purchase')""",
    "cdc_project_config_columns": f"""WITH {FEED}
SELECT CASE event_type WHEN 'click' THEN 'dim_click' ELSE 'dim_purchase' END AS sink_table, 'event_id' AS sink_pk,
       CAST(event_id AS VARCHAR) AS pk, op, CAST(user_id AS VARCHAR) AS user_id,
       CASE event_type WHEN 'purchase' THEN val END AS value, CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS n_columns
FROM feed WHERE op <> 'd' AND event_type IN ('click', 'purchase')""",
    "cdc_json_roundtrip": """SELECT event_id,
       '{"eventId":' || event_id || ',"userId":' || user_id || ',"kValue":' || (props->>'$.k') || '}' AS wire,
       user_id, CAST(props->>'$.k' AS INTEGER) AS k_value FROM events""",
    "transition_null_to_value": f"""WITH {FEED}
SELECT event_id, sort_ms FROM feed WHERE op = 'u' AND has_before AND b_sort_ms IS NULL AND sort_ms IS NOT NULL""",
    "transition_two_outputs": f"WITH {BOUND} SELECT fact_type, CAST(event_id AS VARCHAR) AS id, fact_ms AS ts FROM bound",
    "transition_status_switch": f"WITH {ORDER_FEED} SELECT event_id, change AS fact_type FROM switched WHERE change IS NOT NULL",
    "split_fact_counts": f"WITH {LIFECYCLE} SELECT fact_type, count(*) AS n_facts FROM lifecycle GROUP BY 1",
    "latest_image": latest("op <> 'd'", "true"),
    "latest_image_with_deletes": latest("true", "op <> 'd'"),
    "changed_keys": f"""WITH {FEED}, updates AS (SELECT * FROM feed WHERE op = 'u' AND event_type IN ('click', 'purchase'))
SELECT 'dim_' || event_type AS sink_table, 'event_id' AS key_name, CAST(event_id AS VARCHAR) AS key_value FROM updates
UNION ALL
SELECT 'dim_' || event_type, 'user_id', CAST(coalesce(b_user_id, user_id) AS VARCHAR) FROM updates
UNION ALL
SELECT 'dim_purchase', 'sort_time', CAST(CASE WHEN has_before THEN b_sort_ms ELSE sort_ms END AS VARCHAR)
FROM updates WHERE event_type = 'purchase'""",
    "dimension_build": f"""WITH {FEED}
SELECT CAST(event_id AS VARCHAR) AS event_id, md5(CAST(user_id AS VARCHAR)) AS user_id, val AS value
FROM feed WHERE op <> 'd' AND event_type = 'purchase'""",
    "order_cargo_detail": f"""WITH {DETAILS}
SELECT order_id, id, cargo_type, weight, status, amount, epoch_us(o_orderdate) // 1000 AS ts FROM details""",
    "order_cargo_lifecycle": LIFECYCLE_ROWS,
    "order_cargo_lifecycle_hot_keys": LIFECYCLE_ROWS,
    "bound_inbound": bound_fact("dwd_bound_inbound", "inbound_time", "inbound_emp_id"),
    "bound_sort": bound_fact("dwd_bound_sort", "sort_time", "sorter_emp_id"),
    "bound_outbound": bound_fact("dwd_bound_outbound", "outbound_time", "outbound_emp_id"),
    "trans_finish": """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, CAST(l_linenumber AS VARCHAR) AS shift_id,
       CAST(l_suppkey AS VARCHAR) AS line_id, CAST(l_suppkey AS VARCHAR) AS start_org_id, 'org ' || l_suppkey AS start_org_name,
       CAST(l_partkey AS VARCHAR) AS end_org_id, 'org ' || l_partkey AS end_org_name, l_linenumber AS order_num,
       CAST(l_linenumber AS VARCHAR) AS driver1_emp_id, 'D' || repeat('*', 6 + length(CAST(l_linenumber AS VARCHAR))) AS driver1_name,
       CAST(NULL AS VARCHAR) AS driver2_emp_id,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag || repeat('*', length(CAST(l_linenumber AS VARCHAR))) END AS driver2_name,
       CAST(l_partkey AS VARCHAR) AS truck_id, md5('T' || l_partkey) AS truck_no,
       strftime(o_orderdate + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS actual_start_time,
       strftime(l_shipdate + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS actual_end_time,
       epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000 AS transport_time,
       CAST(l_quantity AS DECIMAL(16,2)) AS actual_distance, epoch_us(l_shipdate) // 1000 AS ts
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'F'""",
    "lookup_pk": f"""WITH {ORGANS}
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS VARCHAR) AS org_id, org_name, region_id
FROM lineitem LEFT JOIN organ ON id = CAST(l_suppkey AS VARCHAR)""",
    "lookup_fk_first": f"WITH {ORGANS} SELECT region_id, org_id AS id, org_name FROM district_org",
    "lookup_miss_keeps_row": f"""WITH {ORGANS}
SELECT event_id, CAST(user_id AS VARCHAR) AS org_id, org_name FROM events LEFT JOIN organ ON id = CAST(user_id AS VARCHAR)""",
    "org_parent_city": f"WITH {ORGANS} SELECT id, org_name, join_org_id, city_id FROM city_of",
    "region_names": f"""WITH {ORGANS}
SELECT c.id, c.name AS city_name, c.parent_id AS province_id, p.name AS province_name
FROM region_info c LEFT JOIN region_info p ON p.id = c.parent_id""",
    "truck_model_chain": """WITH model AS (SELECT p_brand, min(p_type) AS model_name FROM part GROUP BY 1)
SELECT CAST(l_partkey AS VARCHAR) AS truck_id, CAST(sum(CAST(l_quantity AS DECIMAL(16,2))) AS DECIMAL(38,2)) AS distance,
       any_value(part.p_brand) AS truck_model_id, any_value(model_name) AS truck_model_name
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN model ON model.p_brand = part.p_brand GROUP BY l_partkey""",
    "dict_name": f"""WITH {DETAILS}
SELECT cargo_type, count(*) AS n_orders, any_value(n_name) AS cargo_type_name
FROM details LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = cargo_type GROUP BY cargo_type""",
    "mart_cargo_type_day": f"""WITH {DETAILS}
SELECT {date_of('o_orderdate')} AS cur_date, cargo_type, any_value(n_name) AS cargo_type_name,
       CAST(sum(amount) AS DECIMAL(38,2)) AS order_amount_base, count(*) AS order_count_base
FROM details LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = cargo_type GROUP BY 1, 2""",
    "mart_org_order_day": f"""WITH {ORGANS}, {PLACED},
keyed AS (
  SELECT {date_of('o_orderdate')} AS cur_date, org_id, org_name, district AS city_id, amount, o_orderdate AS at_ms
  FROM placed LEFT JOIN district_org ON region_id = district),
{first_of("org_name, city_id", "keyed")},
totals AS (SELECT cur_date, org_id, CAST(sum(amount) AS DECIMAL(38,2)) AS amount, count(*) AS n FROM keyed GROUP BY 1, 2)
SELECT t.cur_date, t.org_id, f.org_name, f.city_id, c.name AS city_name, amount AS order_amount_base, n AS order_count_base
FROM totals t JOIN firsts f ON f.cur_date = t.cur_date AND f.org_id IS NOT DISTINCT FROM t.org_id
LEFT JOIN region_info c ON c.id = f.city_id""",
    "mart_org_sort_day": f"""WITH {BOUND}, {ORGANS},
totals AS (
  SELECT CAST(make_timestamp(fact_ms * 1000) + {SHIFT} AS DATE) AS cur_date, CAST(user_id AS VARCHAR) AS org_id, count(*) AS n
  FROM bound WHERE fact_type = 'dwd_bound_sort' GROUP BY 1, 2)
SELECT t.cur_date, t.org_id, o.org_name, o.city_id, c.name AS city_name, c.parent_id AS province_id, p.name AS province_name,
       n AS sort_count_base
FROM totals t LEFT JOIN city_of o ON o.id = t.org_id LEFT JOIN region_info c ON c.id = o.city_id
LEFT JOIN region_info p ON p.id = c.parent_id""",
    "mart_org_receive_day": f"""WITH {ORGANS}, {PLACED},
collected AS (
  SELECT district, province, {date_of('o_orderdate')} AS cur_date, o_orderdate AS at_ms FROM placed WHERE o_orderstatus <> 'O'),
{places_mart("collected", "receive_order_count_base")}""",
    "mart_org_deliver_day": f"WITH {ORGANS}, {DELIVERED}, {places_mart('delivered', 'deliver_suc_count_base')}",
    "mart_dispatch_day": f"""SELECT {date_of('l_shipdate')} AS cur_date, count(*) AS dispatch_order_count_base
FROM lineitem GROUP BY 1""",
    "mart_bound_finish_day": f"""SELECT {date_of('l_shipdate')} AS cur_date, count(*) AS bound_finish_order_count_base
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1""",
    "mart_truck_model_day": f"""WITH {ORGANS}, model AS (SELECT p_brand, min(p_type) AS model_name FROM part GROUP BY 1),
totals AS (
  SELECT {date_of('l_shipdate')} AS cur_date, CAST(l_suppkey AS VARCHAR) AS org_id, 'org ' || l_suppkey AS org_name, p_brand,
         count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(16,2))) AS DECIMAL(38,2)) AS distance,
         CAST(sum(epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000) AS BIGINT) AS dur
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4)
SELECT cur_date, org_id, t.org_name, t.p_brand AS truck_model_id, model_name AS truck_model_name, city_id, c.name AS city_name,
       n AS trans_finish_count_base, distance AS trans_finish_distance_base, dur AS trans_finish_dur_time_base
FROM totals t LEFT JOIN model ON model.p_brand = t.p_brand LEFT JOIN city_of o ON o.id = t.org_id
LEFT JOIN region_info c ON c.id = o.city_id""",
    "running_snapshots_10s": f"WITH {SNAPSHOTS} SELECT day, event_type, tick_ms, n_events, total_value FROM snapshots",
    "snapshot_final_equals_day": f"""WITH {EVENTS_AT}
SELECT {day('at_ms')} AS day, event_type, count(*) AS n_events, CAST(sum(val) AS DECIMAL(38,2)) AS total_value,
       count(*) AS last_n, CAST(sum(val) AS DECIMAL(38,2)) AS last_value FROM at_events GROUP BY 1, 2""",
    "running_snapshots_dense": f"""WITH {EVENTS_AT},
changes AS (SELECT {day('at_ms')} AS day, {TICK} AS tick_ms, count(*) AS n FROM at_events GROUP BY 1, 2),
days AS (SELECT day, min(tick_ms) AS first_tick, (day + CAST(1 AS BIGINT)) * {DAY_MS} - {EIGHT_HOURS} AS day_end FROM changes GROUP BY 1),
grid AS (
  SELECT day, unnest(range(first_tick, day_end, 10000)) AS tick_ms FROM days WHERE first_tick < day_end - 1
  UNION ALL SELECT day, day_end - 1 FROM days)
SELECT day, tick_ms, CAST(sum(n) OVER (PARTITION BY day ORDER BY tick_ms) AS BIGINT) AS n_events
FROM (SELECT g.day, g.tick_ms, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN changes c ON c.day = g.day AND c.tick_ms = g.tick_ms)""",
    "day_window_shifted": f"SELECT {date_of('ts')} AS cur_date, event_type, count(*) AS n_events FROM events GROUP BY 1, 2",
    "first_row_carried": f"""WITH ranked AS (
  SELECT {date_of('ts')} AS cur_date, event_type, user_id, epoch_us(ts) // 1000 AS at_ms FROM events),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY cur_date, event_type ORDER BY at_ms, CAST(user_id AS VARCHAR)) AS rn,
         count(*) OVER (PARTITION BY cur_date, event_type) AS n_events FROM ranked)
SELECT cur_date, event_type, CAST(user_id AS VARCHAR) AS first_user_id, n_events FROM numbered WHERE rn = 1""",
    "mask_md5": "SELECT c_custkey, md5(c_name) AS name_md5 FROM customer",
    "mask_star": "SELECT c_custkey, c_name[1] || regexp_replace(substr(c_name, 2), '.', '*', 'g') AS name_masked FROM customer",
    "mask_phone": f"WITH {CONTACTS} SELECT c_custkey, {PHONE} AS phone_md5 FROM contacts",
    "mask_email": f"WITH {CONTACTS} SELECT c_custkey, {EMAIL} AS email_md5 FROM contacts",
    "mask_policy_customer": f"""WITH {CONTACTS}
SELECT CAST(c_custkey AS VARCHAR) AS id, md5(c_name) AS passwd,
       CASE WHEN c_custkey % 3 = 0 THEN '' ELSE md5(c_name) END AS real_name,
       {PHONE} AS phone_num, {EMAIL} AS email, {BIRTHDAY} AS birthday FROM contacts""",
    "time_formats": f"""SELECT event_id, strftime(ts + {SHIFT}, '%Y-%m-%d') AS date_text, strftime(ts + {SHIFT}, '%Y%m%d') AS partition_date,
       strftime(ts + {SHIFT}, {DATETIME}) AS datetime_text, epoch_us(date_trunc('second', ts)) // 1000 AS datetime_ms,
       epoch_us(date_trunc('day', ts + {SHIFT})) // 1000 - {EIGHT_HOURS} AS date_ms, {date_of('ts')} AS cur_date FROM events""",
    "epoch_days_to_date": f"WITH {CONTACTS} SELECT c_custkey, {BIRTHDAY} AS birthday FROM contacts",
    "iso_to_local": f"""SELECT event_id, epoch_us(date_trunc('second', ts)) // 1000 AS instant_ms,
       strftime(ts + {SHIFT}, {DATETIME}) AS local_text FROM events""",
    "duration_ms": """SELECT CAST(l_partkey AS VARCHAR) AS truck_id,
       CAST(sum(epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000) AS BIGINT) AS total_ms,
       max(epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000) AS longest_ms
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_partkey""",
}

ORACLE["config_in_force"] = f"""WITH {FEED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms DESC, event_id DESC) AS rn FROM feed)
SELECT CAST(user_id AS VARCHAR) AS source_table, 'dim_' || event_type AS sink_table,
       CASE WHEN event_type = 'view' THEN 'info' ELSE event_type END AS sink_family,
       'id,' || event_type AS sink_columns, 'id' AS sink_pk, CAST(event_id AS VARCHAR) AS foreign_keys
FROM ranked WHERE rn = 1 AND op <> 'd'"""
ORACLE["fact_wire_roundtrip"] = f"SELECT *, order_id AS key FROM ({ORACLE['bound_sort']})"
ORACLE["mart_sort_snapshots"] = f"""WITH {BOUND},
sorts AS (SELECT CAST(user_id AS VARCHAR) AS org_id, fact_ms AS at_ms FROM (SELECT user_id, fact_ms FROM bound WHERE fact_type = 'dwd_bound_sort')),
ticks AS (SELECT {day('at_ms')} AS day, org_id, {TICK} AS tick_ms, count(*) AS n FROM sorts GROUP BY 1, 2, 3)
SELECT day, org_id, tick_ms, CAST(sum(n) OVER (PARTITION BY day, org_id ORDER BY tick_ms) AS BIGINT) AS sort_count_base FROM ticks"""
ORACLE["mart_order_snapshots"] = f"""WITH {ORGANS}, {PLACED},
keyed AS (SELECT org_id, amount, epoch_us(o_orderdate) // 1000 AS at_ms FROM placed LEFT JOIN district_org ON region_id = district),
ticks AS (
  SELECT {day('at_ms')} AS day, org_id, {TICK} AS tick_ms, count(*) AS n, sum(amount) AS v FROM keyed GROUP BY 1, 2, 3)
SELECT day, org_id, tick_ms, CAST(sum(v) OVER w AS DECIMAL(38,2)) AS order_amount_base,
       CAST(sum(n) OVER w AS BIGINT) AS order_count_base
FROM ticks WINDOW w AS (PARTITION BY day, org_id ORDER BY tick_ms)"""
ORACLE["stream_order_cargo"] = LIFECYCLE_ROWS
ORACLE["stream_order_cargo_steps"] = LIFECYCLE_ROWS
ORACLE["stream_mart_update_final"] = ORACLE["mart_org_sort_day"]
ORACLE["stream_mart_keyed_final"] = ORACLE["mart_org_order_day"]
ORACLE["stream_fanout"] = f"""WITH {BOUND}
SELECT fact_type, CAST(event_id AS VARCHAR) AS id, 'o' || user_id AS order_id, CAST(user_id AS VARCHAR) AS org_id,
       {local("fact_ms")} AS event_time, emp AS emp_id, fact_ms AS ts FROM bound"""
ORACLE["stream_dim_upsert"] = f"""WITH {FEED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms DESC, event_id DESC) AS rn
  FROM feed WHERE op <> 'd' AND event_type = 'purchase')
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS event_id, val AS value FROM ranked WHERE rn = 1"""
ORACLE["stream_snapshot_timer"] = f"""WITH {SNAPSHOTS}
SELECT day, event_type, tick_ms, n_events, total_value FROM snapshots
WHERE tick_ms <= (SELECT max(at_ms) FROM at_events) - 5000"""
ORACLE["stream_snapshot_steps"] = ORACLE["stream_snapshot_timer"]


def late_totals(delay_ms: int) -> str:
    """A row counts unless its day had ended by the watermark of the micro-batch before its own."""
    return f"""WITH {EVENTS_AT},
span AS (SELECT min(at_ms) AS low, greatest(max(at_ms) - min(at_ms), 1) AS wide FROM at_events),
stepped AS (
  SELECT {day('at_ms')} AS day, event_type, val, at_ms,
         least(least(floor((at_ms - low) * 8 / wide), 7) + CASE WHEN event_id % 13 = 0 THEN 3 ELSE 0 END, 7) AS step
  FROM at_events, span),
seen AS (SELECT step, max(max(at_ms)) OVER (ORDER BY step) - {delay_ms} AS passed FROM stepped GROUP BY step),
held AS (SELECT step, coalesce(lag(passed, 2) OVER (ORDER BY step), 0) AS passed FROM seen)
SELECT day, event_type, count(*) AS n_events, CAST(sum(val) AS DECIMAL(38,2)) AS total_value
FROM stepped JOIN held USING (step)
WHERE (day + CAST(1 AS BIGINT)) * {DAY_MS} - {EIGHT_HOURS} > passed
GROUP BY 1, 2"""


ORACLE["stream_mart_late"] = late_totals(5_000)
ORACLE["stream_mart_late_10s"] = late_totals(10_000)

for _fact, _time in ORDER_FACT_TIMES.items():
    ORACLE[_fact.replace("dwd_", "fact_")] = f"""WITH {LIFECYCLE}
SELECT * EXCLUDE (fact_type), {local("ts")} AS {_time} FROM lifecycle WHERE fact_type = '{_fact}'"""
