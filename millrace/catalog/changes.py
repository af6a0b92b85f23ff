"""Set operations, upsert and batch change."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import query, star
from millrace.operators import merge as M
from millrace.operators.cleaning import latest_per_key
from millrace.operators.quality import Rules
from millrace.operators.relational import union_all
from millrace.session import scratch_dir, staged
from millrace.sources import snapshots, tables

CUT = "2000-01-01"
KEYS = ["order_id", "line_number"]
_TIES = ["product_id", "supplier_id", "quantity", "price"]


@query(
    "set_union_all",
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
        UNION ALL SELECT 'part', p_partkey, p_name FROM part""",
)
def set_union_all(spark, sf):
    def named(table, key, name):
        return tables.load(spark, sf, table).select(
            F.lit(table).alias("kind"), F.col(key).alias("id"), F.col(name).alias("name")
        )

    return union_all(
        [
            named("customer", "c_custkey", "c_name"),
            named("supplier", "s_suppkey", "s_name"),
            named("part", "p_partkey", "p_name"),
        ]
    )


# Master: the newest version of each line shipped before the cut.  Increment: the newest
# version shipped since.  Lines sent again are updates, lines first seen are inserts.
def _lines(spark, sf):
    return tables.items(spark, sf).select(
        *KEYS, "product_id", "supplier_id", "quantity", F.col("gross").alias("price"), "ship_date"
    )


def _master(spark, sf):
    old = _lines(spark, sf).where(F.col("ship_date") < F.lit(CUT).cast("date"))
    return latest_per_key(old, KEYS, "ship_date", _TIES)


def _increment(spark, sf):
    new = _lines(spark, sf).where(F.col("ship_date") >= F.lit(CUT).cast("date"))
    return latest_per_key(new, KEYS, "ship_date", _TIES)


_NEWEST = """QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY ship_date DESC,
    product_id DESC, supplier_id DESC, quantity DESC, price DESC) = 1"""
_SIDES = f""", l AS (SELECT order_id, line_number, product_id, supplier_id, quantity, gross AS price, ship_date FROM item),
    m AS (SELECT * FROM l WHERE ship_date < DATE '{CUT}' {_NEWEST}),
    s AS (SELECT * FROM l WHERE ship_date >= DATE '{CUT}' {_NEWEST})"""


@query(
    "merge_upsert",
    star(f"""{_SIDES} SELECT coalesce(s.order_id, m.order_id) AS order_id, coalesce(s.line_number, m.line_number) AS line_number,
        coalesce(s.product_id, m.product_id) AS product_id, coalesce(s.supplier_id, m.supplier_id) AS supplier_id,
        coalesce(s.quantity, m.quantity) AS quantity, CAST(coalesce(s.price, m.price) AS DOUBLE) AS price,
        coalesce(s.ship_date, m.ship_date) AS ship_date
        FROM m FULL JOIN s ON s.order_id = m.order_id AND s.line_number = m.line_number"""),
)
def merge_upsert(spark, sf):
    """Stored in ranges of orders; the merge rewrites the ranges that the increment has orders in."""
    root, master = scratch_dir(spark, "lines"), _master(spark, sf)
    snapshots.publish(master, root, "WRITE", by=snapshots.key_ranges(tables.orders(spark, sf), "order_id"))
    snapshots.merge(_increment(spark, sf), root, KEYS, "MERGE")
    return snapshots.read(spark, root).withColumn("price", F.col("price").cast("double"))


@query(
    "merge_tag",
    star(f"""{_SIDES} SELECT s.order_id, s.line_number, s.ship_date,
        CASE WHEN m.order_id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS operation
        FROM s LEFT JOIN m ON s.order_id = m.order_id AND s.line_number = m.line_number"""),
)
def merge_tag(spark, sf):
    return M.tag_changes(_master(spark, sf), _increment(spark, sf), KEYS).select(
        *KEYS, "ship_date", "operation"
    )


@query(
    "merge_validate",
    star(f"""{_SIDES}, k AS (SELECT s.order_id AS s, m.order_id AS m FROM s LEFT JOIN m
            ON s.order_id = m.order_id AND s.line_number = m.line_number)
        SELECT (SELECT count(*) FROM m) AS rows_before, (SELECT count(*) FROM k WHERE m IS NOT NULL) AS updated_rows,
        (SELECT count(*) FROM k WHERE m IS NULL) AS inserted_rows,
        (SELECT count(*) FROM m) + (SELECT count(*) FROM k WHERE m IS NULL) AS rows_after"""),
)
def merge_validate(spark, sf):
    return M.merge_counts(_master(spark, sf), _increment(spark, sf), KEYS)


_ITEM_KEY = ("order_id", "line_number", "product_id", "supplier_id")

# The pending orders arrive as one batch on top of the others.  It is applied if no product is sold out and no
# item comes twice.
_APPLIED = """, s AS (SELECT i.product_id, sum(i.quantity) AS q FROM item i JOIN ord o ON o.order_id = i.order_id
        WHERE o.status = 'P' GROUP BY 1),
    d AS (SELECT 1 FROM item i JOIN ord o ON o.order_id = i.order_id WHERE o.status = 'P'
        GROUP BY i.order_id, line_number, product_id, supplier_id HAVING count(*) > 1),
    ok AS (SELECT count(*) = 0 AND (SELECT count(*) FROM d) = 0 AND {} AS fits
        FROM prod p JOIN s ON s.product_id = p.product_id WHERE p.stock * 1000 < s.q)
    SELECT 'order' AS kind, order_id AS id, CAST(amount AS DOUBLE) AS value FROM ord, ok WHERE status <> 'P' OR fits {}
    UNION ALL SELECT 'item', order_id, CAST(sum(quantity) AS DOUBLE) FROM item, ok
        WHERE fits OR order_id NOT IN (SELECT order_id FROM ord WHERE status = 'P') GROUP BY order_id
    UNION ALL SELECT 'stock', p.product_id, CAST(p.stock * 1000 - CASE WHEN fits THEN coalesce(s.q, 0) ELSE 0 END AS DOUBLE)
        FROM ok, prod p LEFT JOIN s ON s.product_id = p.product_id"""


def _apply_batch(spark, sf, stored_again):
    """Orders, items and stock after the batch: one more folder of orders and of items and a new stock, under one commit.

    With `stored_again` one of the batch's orders is in the stored table already.
    """
    s = tables.star(spark, sf)
    pending = s.orders.where("status = 'P'")
    settled = s.orders.where("status <> 'P'")
    if stored_again:
        settled = settled.unionByName(pending.orderBy("order_id").limit(1))
    # One join says of every line whether it comes with the batch.  Amounts made of a line's columns are not stored.
    lines = s.items.drop("revenue", "gross_cents", "revenue_units")
    in_batch = pending.select("order_id").distinct().withColumn("in_batch", F.lit(True))
    lines = staged(lines.join(in_batch, "order_id", "left"), "lines")
    new_items = lines.where("in_batch").drop("in_batch")
    old_items = lines.where("in_batch IS NULL").drop("in_batch")
    stock = s.products.select("product_id", (F.col("stock") * 1000).cast("long").alias("stock"))
    order_rules = Rules(
        not_null=["order_id", "customer_id", "order_date"],
        checks={"amount": F.col("amount") >= 0},
        foreign={"customer_id": (s.customers, "customer_id")},
    )
    item_rules = Rules(
        not_null=["order_id", "product_id"],
        checks={
            "quantity": F.col("quantity") > 0,
            "price": F.col("gross") > 0,
            "discount": F.col("discount").between(0, 1),
        },
        foreign={"order_id": (pending, "order_id"), "product_id": (s.products, "product_id")},
    )
    root = scratch_dir(spark, "shop")
    snapshots.publish_all({"orders": settled, "items": old_items, "stock": stock}, root, "WRITE")
    orders, items, left = (snapshots.read_table(spark, root, n) for n in ("orders", "items", "stock"))
    done = M.order_batch(orders, items, left, pending, new_items, order_rules, item_rules, item_key=_ITEM_KEY)
    snapshots.append_all(spark, root, "BATCH", {"orders": done.orders, "items": done.items}, {"stock": done.stock})
    orders, items, left = (snapshots.read_table(spark, root, n) for n in ("orders", "items", "stock"))
    return union_all(
        [
            orders.select(
                F.lit("order").alias("kind"),
                F.col("order_id").alias("id"),
                F.col("amount").cast("double").alias("value"),
            ),
            items.groupBy("order_id")
            .agg(F.sum("quantity").cast("double").alias("value"))
            .select(F.lit("item").alias("kind"), F.col("order_id").alias("id"), "value"),
            left.select(
                F.lit("stock").alias("kind"),
                F.col("product_id").alias("id"),
                F.col("stock").cast("double").alias("value"),
            ),
        ]
    )


@query("batch_order_apply", star(_APPLIED.format("true", "")))
def batch_order_apply(spark, sf):
    return _apply_batch(spark, sf, stored_again=False)


@query(
    "batch_order_reject",
    star(_APPLIED.format("false", "OR order_id = (SELECT min(order_id) FROM ord WHERE status = 'P')")),
)
def batch_order_reject(spark, sf):
    """One order of the batch is stored already, so nothing of it is applied."""
    return _apply_batch(spark, sf, stored_again=True)
