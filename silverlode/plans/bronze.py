"""Bronze: the raw tables as they are, and the renamed order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names given to the columns of the order tables.
ORDERS = {
    "o_orderkey": "order_key",
    "o_custkey": "customer_key",
    "o_orderstatus": "status_code",
    "o_totalprice": "total_price",
    "o_orderdate": "order_date",
}
LINEITEM = {
    "l_orderkey": "order_key",
    "l_partkey": "part_key",
    "l_quantity": "quantity",
    "l_linenumber": "line_number",
    "l_extendedprice": "extended_price",
    "l_discount": "discount_percentage",
    "l_tax": "tax_rate",
}


def replica(raw: DataFrame) -> DataFrame:
    """All rows and columns, duplicates included."""
    return raw


def tpch_orders(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(old).alias(new) for old, new in ORDERS.items()])


def tpch_lineitem(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(old).alias(new) for old, new in LINEITEM.items()])
