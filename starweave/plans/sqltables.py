"""The SQL way in: primary-key tables as views, and continuous inserts.

A primary-key table is the latest-by-key view of a log. ``INSERT INTO t SELECT``
keeps a table up to date from others; in batch it is the view of the SELECT, in
a stream the same SELECT runs in every batch (``streaming.sinks.InsertSelect``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starweave.operators.changelog import table
from starweave.operators.sqlinsert import insert_select
from starweave.specs import TableSpec

__all__ = ["DOCUMENT_SQL", "ENRICH_SQL", "create_table", "insert_select"]


def create_table(log: DataFrame, spec: TableSpec, view: str | None = None) -> DataFrame:
    """Register the current contents of a log under a name."""
    current = table(log, spec)
    current.createOrReplaceTempView(view or spec.name)
    return current


# Output columns and map keys.
ENRICH_SQL = """
SELECT o.order_id AS id, o.order_id AS order_id,
       map('id', o.product_id, 'brand', p.brand, 'name', p.name,
           'sale_price', CAST(p.sale_price AS string),
           'rating', CAST(p.rating AS string)) AS product,
       map('id', o.customer_id, 'name', c.name, 'segment', c.segment) AS customer,
       o.ts AS ts
FROM {orders} o
JOIN {customers} c ON o.customer_id = c.customer_id
JOIN {products} p ON o.product_id = p.product_id
"""

DOCUMENT_SQL = """
SELECT order_id, order_id,
       map('id', product_id, 'brand', product.brand, 'name', product.name,
           'sale_price', CAST(product.sale_price AS string), 'rating', CAST(product.rating AS string)),
       map('id', customer_id, 'name', customer.name, 'segment', customer.segment),
       ts
FROM {rows}
"""
