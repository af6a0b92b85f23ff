"""Whole-table cleaning chains for text tables, every column a string on input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import clip, null_or, parse_currency, to_day, to_number
from millrace.operators.cleaning import (
    drop_duplicate_rows,
    drop_null,
    fill_const,
    fill_median,
    first_per_key,
    keep_known,
    not_after,
    repair_order,
)
from millrace.session import staged


CUSTOMER_DEFAULTS = {"loyalty_points": 0, "gender": "Unknown", "city": "Unknown", "country": "Unknown"}


def known_customers(raw: DataFrame) -> DataFrame:
    """Typed customers with key, name and e-mail."""
    typed = raw.withColumns(
        {
            "customer_id": to_number("customer_id").cast("long"),
            "age": to_number("age"),
            "loyalty_points": to_number("loyalty_points").cast("long"),
            "signup_date": to_day("signup_date"),
        }
    )
    return drop_null(typed, ["customer_id", "name", "email"])


def one_per_email(known: DataFrame) -> DataFrame:
    """The smallest key of an e-mail; where keys tie, the other columns decide, so nothing is left to arrival."""
    ties = [c for c in known.columns if c not in ("email", "customer_id")]
    return first_per_key(known, ["email"], [("customer_id", False), *[(c, False) for c in ties]])


def sane_age(customers: DataFrame) -> DataFrame:
    return customers.where(null_or("age", F.col("age").between(18, 100)))


def valid_customers(raw: DataFrame) -> DataFrame:
    """Customers that stay.  Whoever only asks which exist need not remove row duplicates first.

    The e-mail is made unique before the age test: a first row that then fails takes its copies with it.
    """
    return sane_age(one_per_email(known_customers(raw)))


def clean_customers(raw: DataFrame) -> DataFrame:
    """Row duplicates, types, required fields, one row per e-mail, age 18..100, defaults."""
    return fill_const(valid_customers(drop_duplicate_rows(raw)), CUSTOMER_DEFAULTS)


#: The customer chain step by step, for `quality.step_counts`.
CUSTOMER_STEPS = [
    ("unique_rows", drop_duplicate_rows),
    ("complete", known_customers),
    ("unique_email", one_per_email),
    ("age_in_range", sane_age),
]


def valid_products(raw: DataFrame) -> DataFrame:
    """Typed products that stay: with key and name, no price that is not positive.

    Enough for whoever only asks which products exist; row duplicates do not matter then.
    """
    typed = raw.withColumns(
        {
            "product_id": to_number("product_id").cast("long"),
            "price": to_number("price"),
            "stock_qty": to_number("stock_qty").cast("long"),
            "supplier_id": to_number("supplier_id").cast("long"),
            "created_at": to_day("created_at"),
        }
    )
    known = drop_null(typed, ["product_id", "name"])
    return known.where(null_or("price", F.col("price") > 0))


def clean_products(raw: DataFrame) -> DataFrame:
    """The median of the valid prices fills the missing ones, constants the rest."""
    priced = staged(valid_products(drop_duplicate_rows(raw)))
    return fill_const(fill_median(priced, "price"), {"stock_qty": 0, "category": "Uncategorised"})


def valid_orders(raw: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Typed orders of known customers, dated and not after `as_of`, with no negative amount.

    Enough for whoever only asks which orders exist; row duplicates do not matter then.
    """
    typed = raw.withColumns(
        {
            "order_id": to_number("order_id").cast("long"),
            "customer_id": to_number("customer_id").cast("long"),
            "total_amount": to_number("total_amount"),
            "order_date": to_day("order_date"),
            "ship_date": to_day("ship_date"),
        }
    )
    linked = keep_known(drop_null(typed, ["order_id", "customer_id"]), customers, "customer_id")
    dated = not_after(drop_null(linked, ["order_date"]), "order_date", as_of)
    return dated.where(null_or("total_amount", F.col("total_amount") >= 0))


def clean_orders(raw: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """valid_orders without row duplicates, the shipping date repaired, defaults.

    A missing shipping date stays NULL.
    """
    paid = valid_orders(drop_duplicate_rows(raw), customers, as_of)
    return fill_const(
        repair_order(paid, "order_date", "ship_date"),
        {
            "status": "unknown",
            "payment_method": "unknown",
            "shipping_city": "Unknown",
            "total_amount": 0.0,
        },
    )


def repaired_dates(orders: DataFrame) -> DataFrame:
    """How many valid orders were shipped before they were placed: (repaired_dates)."""
    return orders.agg(F.count_if(F.col("ship_date") < F.col("order_date")).alias("repaired_dates"))


def clean_order_items(raw: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Types, both foreign keys, positive quantity and price, discount in [0, 1], defaults."""
    typed = drop_duplicate_rows(raw).withColumns(
        {
            "item_id": to_number("item_id").cast("long"),
            "order_id": to_number("order_id").cast("long"),
            "product_id": to_number("product_id").cast("long"),
            "quantity": to_number("quantity").cast("long"),
            "unit_price": to_number("unit_price"),
            "discount": to_number("discount"),
        }
    )
    linked = keep_known(drop_null(typed, ["item_id", "order_id"]), orders, "order_id")
    linked = keep_known(drop_null(linked, ["product_id"]), products, "product_id")
    sane = linked.where(null_or("quantity", F.col("quantity") > 0)).where(
        null_or("unit_price", F.col("unit_price") > 0)
    )
    clipped = sane.withColumn("discount", clip("discount", 0.0, 1.0, 0.0))
    return fill_median(staged(fill_const(clipped, {"quantity": 1})), "unit_price")


def clean_catalogue(raw: DataFrame, quantity: Column) -> DataFrame:
    """Impute, one row per product, parse the price text, total amount.

    `quantity` is an expression on the row's key instead of a random draw.
    """
    filled = fill_const(
        fill_median(raw, "rating"),
        {
            "ratings_count": 0,
            "discount": 0,
            "seller_name": "Unknown Seller",
            "what_customers_said": "No reviews",
            "product_description": "No description available",
        },
    )
    unique = first_per_key(filled, ["product_id"], [("row_id", False)])
    priced = drop_null(unique.withColumn("price", parse_currency("final_price")), ["price"])
    return priced.withColumn("quantity", quantity).withColumn(
        "total_amount", F.col("price") * F.col("quantity")
    )
