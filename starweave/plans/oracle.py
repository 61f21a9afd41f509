"""The same queries in SQL, for comparison on the same tables."""

from __future__ import annotations

_LATEST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"

_ORDER_VERSION = "v_ship DESC, line DESC, v_part DESC, v_supp DESC, v_price DESC"
_ORDER_VERSION_ASC = "v_ship, line, v_part, v_supp, v_price"

_VIEWS: dict[str, str] = {
    "order_log": """
        SELECT l_orderkey AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, l_shipdate AS ts, l_linenumber AS line,
               CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'upsert' END AS op,
               l_shipdate AS v_ship, l_partkey AS v_part, l_suppkey AS v_supp, l_extendedprice AS v_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "orders_now": f"SELECT * FROM order_log {_LATEST.format(key='order_id', order=_ORDER_VERSION)}",
    "orders_live": "SELECT * FROM orders_now WHERE op <> 'delete'",
    "customer_updates": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, value AS acctbal,
               c_mktsegment AS segment, ts - INTERVAL 25 YEARS AS ts,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, event_id AS seq
        FROM events JOIN customer ON user_id = c_custkey""",
    "customer_log": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_acctbal AS acctbal,
               c_mktsegment AS segment, TIMESTAMP '1990-01-01' AS ts, 'upsert' AS op, -1 AS seq
        FROM customer UNION ALL SELECT * FROM customer_updates""",
    "customers_now": f"SELECT * FROM customer_log {_LATEST.format(key='customer_id', order='ts DESC, seq DESC')}",
    "customer_dim": "SELECT * FROM customers_now WHERE segment <> 'FURNITURE'",
    "customer_dim_live": "SELECT * FROM customer_dim WHERE op <> 'delete'",
    "updates_now": f"SELECT * FROM customer_updates {_LATEST.format(key='customer_id', order='ts DESC, seq DESC')}",
    "products_now": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS brand, p_name AS name,
               p_retailprice AS sale_price, p_size AS rating FROM part""",
    "product_dim": "SELECT * FROM products_now WHERE rating > 10",
    "order_per_customer": f"""
        SELECT * FROM orders_now
        {_LATEST.format(key='customer_id', order=_ORDER_VERSION + ', order_id DESC')}""",
    "order_per_product": f"""
        SELECT * FROM orders_now
        {_LATEST.format(key='product_id', order=_ORDER_VERSION + ', order_id DESC')}""",
}


def _sql(body: str, extra: dict[str, str] | None = None) -> str:
    """The query with every view it may use as a CTE (unused ones cost nothing)."""
    views = {**_VIEWS, **(extra or {})}
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in views.items()) + "\n" + body


_C = """coalesce(c.customer_id, o.customer_id) AS customer_id, coalesce(c.name, '') AS customer_name,
        coalesce(c.segment, '') AS customer_segment"""
_P = """coalesce(p.product_id, o.product_id) AS product_id, coalesce(p.brand, '') AS product_brand,
        coalesce(p.name, '') AS product_name, coalesce(p.sale_price, 0.0) AS product_sale_price,
        coalesce(p.rating, 0) AS product_rating"""
_LEFT_C = "LEFT JOIN customer_dim c ON c.customer_id = o.customer_id"
_LEFT_P = "LEFT JOIN product_dim p ON p.product_id = o.product_id"
_ALL_C, _ALL_P = (j.replace("_dim", "s_now") for j in (_LEFT_C, _LEFT_P))

_FLAGSHIP = f"SELECT o.order_id, {_C}, {_P}, o.ts FROM orders_now o {_LEFT_C} {_LEFT_P}"

_CUSTOMER_LED = f"""
    SELECT o.order_id, c.customer_id, c.name AS customer_name, c.segment AS customer_segment, {_P}, o.ts
    FROM customers_now c JOIN order_per_customer o ON o.customer_id = c.customer_id {_ALL_P}"""


def _product_led(lookup_by: str) -> str:
    return f"""
    SELECT o.order_id, {_C}, p.product_id, p.brand AS product_brand, p.name AS product_name,
           p.sale_price AS product_sale_price, p.rating AS product_rating, o.ts
    FROM products_now p JOIN order_per_product o ON o.product_id = p.product_id
    LEFT JOIN customers_now c ON c.customer_id = o.{lookup_by}"""


_PARTIALS = {
    "partials": f"""
        SELECT order_id, ts, NULL AS customer_id, NULL AS customer_name, NULL AS customer_segment,
               NULL AS product_id, NULL AS product_brand, NULL AS product_name FROM orders_now
        UNION ALL
        SELECT o.order_id, NULL, c.customer_id, c.name, c.segment, NULL, NULL, NULL FROM orders_now o {_LEFT_C}
        UNION ALL
        SELECT o.order_id, NULL, NULL, NULL, NULL, p.product_id, p.brand, p.name FROM orders_now o {_LEFT_P}"""
}

_DOC = """'{"order_id":' || order_id
    || CASE WHEN customer_id IS NULL THEN '' ELSE ',"customer":{"customer_id":"' || customer_id
       || '","name":"' || customer_name || '","segment":"' || customer_segment || '"}' END
    || CASE WHEN product_id IS NULL THEN '' ELSE ',"product":{"product_id":"' || product_id
       || '","brand":"' || product_brand || '","name":"' || product_name || '"}' END
    || CASE WHEN ts IS NULL THEN '' ELSE ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '"' END
    || '}'"""

_MERGED = f"""
    SELECT o.order_id,
           arg_max(c.customer_id, {{v}}) FILTER (WHERE c.customer_id IS NOT NULL) AS customer_id,
           arg_max(c.name, {{v}}) FILTER (WHERE c.customer_id IS NOT NULL) AS customer_name,
           arg_max(c.segment, {{v}}) FILTER (WHERE c.customer_id IS NOT NULL) AS customer_segment,
           arg_max(p.product_id, {{v}}) FILTER (WHERE p.product_id IS NOT NULL) AS product_id,
           arg_max(p.brand, {{v}}) FILTER (WHERE p.product_id IS NOT NULL) AS product_brand,
           arg_max(p.name, {{v}}) FILTER (WHERE p.product_id IS NOT NULL) AS product_name,
           arg_max(o.ts, {{v}}) AS ts
    FROM order_log o {_LEFT_C} {_LEFT_P} GROUP BY o.order_id""".format(
    v="row(o.v_ship, o.line, o.v_part, o.v_supp, o.v_price)"
)

_FLAT = _MERGED.replace("FILTER (WHERE p.product_id IS NOT NULL) AS product_brand", "FILTER (WHERE p.rating > 30) AS product_brand")

_ROW = "row(o.v_ship, o.line, o.v_part, o.v_supp, o.v_price)"
_ALIVE = {
    "dead": f"SELECT o.order_id, max({_ROW}) AS gone FROM order_log o WHERE op = 'delete' GROUP BY o.order_id",
    "alive": f"""
        SELECT o.* FROM order_log o LEFT JOIN dead ON dead.order_id = o.order_id
        WHERE op <> 'delete' AND (gone IS NULL OR {_ROW} > gone)""",
}
_MERGED_ALIVE = _MERGED.replace("FROM order_log o", "FROM alive o").replace("customer_dim c", "customer_dim_live c")

_LAG = {
    "versions": f"""
        SELECT *, lag(op) OVER w AS old_op, lag(product_id) OVER w AS old_product
        FROM order_log WINDOW w AS (PARTITION BY order_id ORDER BY {_ORDER_VERSION_ASC})"""
}

_STATIC_LOOKUP = f"""
    SELECT o.order_id, o.ts, CAST(o.line AS BIGINT) AS line, o.customer_id, coalesce(c.name, '') AS customer_name
    FROM order_log o {_ALL_C}"""

SQL: dict[str, str] = {
    "orders_latest_by_key": _sql("SELECT order_id, product_id, customer_id, ts FROM orders_now"),
    "orders_latest_with_tombstones": _sql("SELECT order_id, product_id, customer_id, ts FROM orders_live"),
    "latest_order_per_customer": _sql("SELECT customer_id, order_id, product_id, ts FROM order_per_customer"),
    "latest_order_per_product": _sql("SELECT product_id, order_id, customer_id, ts FROM order_per_product"),
    "table_to_changelog": _sql(
        """SELECT order_id, ts,
                  CASE WHEN op = 'delete' THEN 'delete'
                       WHEN coalesce(old_op, 'delete') = 'delete' THEN 'insert' ELSE 'update' END AS op,
                  CASE WHEN old_op = 'upsert' THEN old_product END AS old_product_id,
                  CASE WHEN op = 'upsert' THEN product_id END AS new_product_id
           FROM versions WHERE op = 'upsert' OR old_op = 'upsert'""",
        _LAG,
    ),
    "fk_switch_orders": _sql(
        """SELECT order_id, old_product AS old_product_id, product_id AS new_product_id
           FROM versions WHERE old_op IS NOT NULL AND old_product <> product_id""",
        _LAG,
    ),
    "rekey_by_fk": _sql("SELECT customer_id AS key, order_id, product_id, ts FROM order_log"),
    "enrich_orders_customer": _sql(f"SELECT o.order_id, o.product_id, {_C}, o.ts FROM orders_now o {_LEFT_C}"),
    "enrich_orders_left": _sql(_FLAGSHIP),
    "enrich_orders_tombstones": _sql(
        f"""SELECT o.order_id, {_C}, {_P}, o.ts FROM orders_live o
            LEFT JOIN customer_dim_live c ON c.customer_id = o.customer_id {_LEFT_P}"""
    ),
    "default_fill_on_miss": _sql(
        f"""SELECT order_id, customer_id, customer_name, product_id, product_name, product_rating
            FROM ({_FLAGSHIP}) WHERE customer_name = '' OR product_name = ''"""
    ),
    "stream_table_left_asof": _sql(
        """SELECT o.order_id, o.customer_id, o.ts, o.product_id, c.acctbal AS acctbal_at_ts
           FROM order_log o ASOF LEFT JOIN customer_log c
             ON c.customer_id = o.customer_id AND o.ts >= c.ts"""
    ),
    "customer_led_enrichment": _sql(_CUSTOMER_LED),
    "product_led_enrichment": _sql(_product_led("customer_id")),
    "product_led_as_written": _sql(_product_led("product_id")),
    "three_leg_union": _sql(
        f"""SELECT 'orders' AS leg, o.order_id, {_C.split(' AS')[0]} AS customer_id, {_P.split(' AS')[0]} AS product_id
            FROM orders_now o {_ALL_C} {_ALL_P}
            UNION ALL SELECT 'customers', order_id, customer_id, product_id FROM ({_CUSTOMER_LED})
            UNION ALL SELECT 'products', order_id, customer_id, product_id
            FROM ({_product_led('customer_id')})"""
    ),
    "affected_orders": _sql(
        "SELECT order_id FROM orders_now WHERE customer_id IN (SELECT customer_id FROM customer_updates)"
    ),
    "sql_three_way_inner": _sql(
        """SELECT o.order_id, o.order_id AS id, m.map_name, m.key, m.value, o.ts
           FROM orders_now o
           JOIN customer_dim c ON c.customer_id = o.customer_id
           JOIN product_dim p ON p.product_id = o.product_id,
           LATERAL (VALUES
             ('product', 'id', o.product_id), ('product', 'brand', p.brand), ('product', 'name', p.name),
             ('product', 'sale_price', CAST(p.sale_price AS VARCHAR)),
             ('product', 'rating', CAST(p.rating AS VARCHAR)),
             ('customer', 'id', o.customer_id), ('customer', 'name', c.name),
             ('customer', 'segment', c.segment)) AS m(map_name, key, value)"""
    ),
    "pk_table_project": _sql("SELECT customer_id, name FROM customers_now"),
    "partial_orders_main": _sql("SELECT order_id, ts FROM orders_now"),
    "partial_orders_customer": _sql(
        f"SELECT o.order_id, c.customer_id, c.name AS customer_name FROM orders_now o {_LEFT_C}"
    ),
    "partial_orders_product": _sql(
        f"SELECT o.order_id, p.product_id, p.name AS product_name FROM orders_now o {_LEFT_P}"
    ),
    "partial_union": _sql("SELECT order_id, customer_id, product_id, ts FROM partials", _PARTIALS),
    "sink_ts_only": _sql("SELECT order_id, ts FROM partials WHERE ts IS NOT NULL", _PARTIALS),
    "sink_product_only": _sql(
        "SELECT order_id, product_id, product_name FROM partials WHERE product_id IS NOT NULL", _PARTIALS
    ),
    "sink_customer_only": _sql(
        "SELECT order_id, customer_id, customer_name FROM partials WHERE customer_id IS NOT NULL", _PARTIALS
    ),
    "partial_merge_converged": _sql(_MERGED),
    "partial_merge_flattened": _sql(_FLAT),
    "contract_violations": _sql(
        """SELECT order_id, 'customer' AS missing_field FROM partials WHERE customer_id IS NULL
           UNION ALL SELECT order_id, 'product' FROM partials WHERE product_id IS NULL
           UNION ALL SELECT order_id, 'ts' FROM partials WHERE ts IS NULL""",
        _PARTIALS,
    ),
    "replace_one_converged": _sql(
        f"""SELECT o.order_id, c.customer_id, c.name AS customer_name, p.product_id, p.name AS product_name, o.ts
            FROM orders_now o {_LEFT_C} {_LEFT_P}"""
    ),
    "sink_delete_on_null": _sql("SELECT order_id, product_id, customer_id, ts FROM orders_live"),
    "update_many_dimension": _sql(
        f"""SELECT o.order_id, o.customer_id,
                   coalesce(u.name, c.name, '') AS customer_name,
                   coalesce(u.acctbal, c.acctbal, 0.0) AS customer_acctbal, o.ts
            FROM orders_now o {_ALL_C}
            LEFT JOIN updates_now u ON u.customer_id = o.customer_id"""
    ),
    "remove_null_fields_struct": _sql(f"SELECT order_id, {_DOC} AS doc FROM partials", _PARTIALS),
    "remove_null_fields_map": _sql(
        """SELECT order_id, 'customer_id' AS key, customer_id AS value FROM partials WHERE customer_id IS NOT NULL
           UNION ALL SELECT order_id, 'product_id', product_id FROM partials WHERE product_id IS NOT NULL
           UNION ALL SELECT order_id, 'product_name', product_name FROM partials WHERE product_name IS NOT NULL""",
        _PARTIALS,
    ),
    "value_to_key_rename": _sql("SELECT order_id AS _id, order_id, product_id FROM orders_now"),
    "transform_chain": _sql(f"SELECT order_id AS _id, {_DOC} AS doc FROM partials", _PARTIALS),
    "document_projection": _sql(
        f"""SELECT o.order_id AS _id, o.order_id, coalesce(c.customer_id, o.customer_id) AS customer_id,
                   coalesce(split_part(c.name, '#', 1), '') AS "customer_firstName",
                   coalesce(split_part(c.name, '#', 2), '') AS "customer_lastName",
                   coalesce(c.segment, '') AS customer_segment, {_P}, o.ts
            FROM orders_now o {_ALL_C} {_ALL_P}"""
    ),
    "route_by_record_type": _sql(
        """SELECT event_id, CASE WHEN event_type IN ('signup', 'error') THEN 'customer' ELSE 'product' END AS route
           FROM events"""
    ),
    "decode_json_records": _sql(
        """SELECT event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
                  CASE WHEN event_type <> 'error' THEN CAST(props->>'k' AS BIGINT) END AS k
           FROM events"""
    ),
    "stream_static_lookup": _sql(_STATIC_LOOKUP),
    "stream_enrich_converged": _sql(_FLAGSHIP),
    "stream_tombstones_converged": _sql(
        f"""SELECT o.order_id, {_C}, {_P}, o.ts FROM orders_live o
            LEFT JOIN customer_dim_live c ON c.customer_id = o.customer_id {_LEFT_P}"""
    ),
    "stream_two_references": _sql(
        """SELECT o.order_id, c.name AS buyer_name, s.name AS seller_name
           FROM orders_now o LEFT JOIN customers_now c ON c.customer_id = o.customer_id
           LEFT JOIN customers_now s ON s.customer_id = CAST(o.v_supp AS VARCHAR)"""
    ),
    "stream_partial_converged": _sql(_MERGED_ALIVE, _ALIVE),
    "stream_fan_out_converged": _sql(
        f"""SELECT 'ts' AS leg, order_id, NULL AS customer_id, NULL AS product_id, ts FROM ({_MERGED_ALIVE})
            UNION ALL SELECT 'customer', order_id, customer_id, NULL, NULL FROM ({_MERGED_ALIVE})
            WHERE customer_id IS NOT NULL
            UNION ALL SELECT 'product', order_id, NULL, product_id, NULL FROM ({_MERGED_ALIVE})
            WHERE product_id IS NOT NULL""",
        _ALIVE,
    ),
    "stream_update_many_converged": _sql(
        """SELECT o.order_id, o.customer_id, coalesce(u.name, b.c_name) AS customer_name,
                  coalesce(u.acctbal, b.c_acctbal) AS customer_acctbal, o.ts
           FROM orders_now o JOIN customer b ON CAST(b.c_custkey AS VARCHAR) = o.customer_id
           LEFT JOIN (SELECT * FROM updates_now WHERE op <> 'delete') u ON u.customer_id = o.customer_id"""
    ),
}
SQL["stream_sql_insert_converged"] = SQL["sql_three_way_inner"]

_MOVED = {
    "moved": "SELECT * REPLACE (CAST(v_supp AS VARCHAR) AS customer_id) FROM orders_live",
    "heads": f"SELECT * FROM moved {_LATEST.format(key='customer_id', order=_ORDER_VERSION + ', order_id DESC')}",
}
_HOPS = {
    "nations_now": """
        SELECT n_nationkey AS nation_id, n_name || ', ' || r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "settled": """
        SELECT c.customer_id, c.name, n.name AS nation_name
        FROM customers_now c JOIN customer h ON CAST(h.c_custkey AS VARCHAR) = c.customer_id
        LEFT JOIN nations_now n ON n.nation_id = (h.c_nationkey + c.seq + 1) % 25
        WHERE c.op <> 'delete'""",
}
SQL["stream_changes_converged"] = SQL["table_to_changelog"]
SQL["stream_latest_per_customer"] = _sql("SELECT customer_id, order_id, product_id, ts FROM heads", _MOVED)
SQL["stream_asof_converged"] = SQL["stream_table_left_asof"]
SQL["enrich_two_hops"] = _sql(
    """SELECT o.order_id, s.name AS customer_name, s.nation_name, o.ts
       FROM orders_now o LEFT JOIN settled s ON s.customer_id = o.customer_id""",
    _HOPS,
)
SQL["stream_two_hops_converged"] = SQL["enrich_two_hops"]
SQL["stream_customer_led_converged"] = _sql(_CUSTOMER_LED.replace("order_per_customer", "heads"), _MOVED)
SQL["stream_contract_converged"] = _sql(
    f"""SELECT o.order_id, o.ts,
               CAST(c.name IS NULL AS BIGINT) + CAST(p.name IS NULL AS BIGINT) AS faults,
               concat_ws(',', CASE WHEN c.name IS NULL THEN 'customer.name' END,
                         CASE WHEN p.name IS NULL THEN 'product.name' END) AS broken
        FROM orders_live o LEFT JOIN customer_dim_live c ON c.customer_id = o.customer_id {_LEFT_P}"""
)
