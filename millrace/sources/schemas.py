"""Explicit schemas of the file and table contracts, as DDL text."""

from __future__ import annotations

# The 21-column header of the sales file and its types.
SALES_FILE_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID",
    "Customer Name", "Segment", "Country", "City", "State", "Postal Code", "Region",
    "Product ID", "Category", "Sub-Category", "Product Name", "Sales", "Quantity",
    "Discount", "Profit",
]
SALES_FILE_NUMERIC = ["Sales", "Profit", "Quantity", "Discount"]
SALES_FILE_MIN_ROWS = 9000

SALES_FILE_TYPES = {"Row ID": "int", "Quantity": "int", "Sales": "double", "Discount": "double", "Profit": "double"}
SALES_FILE = ", ".join(f"`{c}` {SALES_FILE_TYPES.get(c, 'string')}" for c in SALES_FILE_COLUMNS)
