"""The star schema as temporary views, for SQL users.

The reference keeps its dimensions and facts as views over the raw tables;
here they are lazy DataFrames registered with ``createOrReplaceTempView``, so
``spark.sql`` can query them and Catalyst expands them like any view.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillsight.operators import dims, facts
from tillsight.operators.calendar import calendar_dim
from tillsight.plans import bindings as B


def register_star_schema(spark: SparkSession, root: str) -> list[str]:
    """Register raw role tables and the dimensions/facts built on the
    driver's tables under ``root``; returns the view names."""
    raw = {
        "raw_orders": B.orders(spark, root),
        "raw_order_items": B.order_items(spark, root),
        "raw_returns": B.returns(spark, root),
        "raw_return_items": B.return_items(spark, root),
        "raw_customers": B.customers(spark, root),
        "raw_products": B.products(spark, root),
        "raw_product_variants": B.product_variants(spark, root),
    }
    views = dict(raw)
    views["dim_calendar"] = calendar_dim(raw["raw_orders"], "placed_at",
                                         others=[(raw["raw_returns"], "created_at")])
    views["dim_customer"] = dims.customer_dim(raw["raw_customers"], B.addresses(spark, root))
    views["dim_product"] = dims.product_dim(raw["raw_product_variants"], raw["raw_products"],
                                            B.categories(spark, root), B.brands(spark, root))
    views["dim_location"] = dims.location_dim(B.locations(spark, root))
    views["dim_employee"] = dims.employee_dim(B.employees(spark, root))
    views["fct_orders"] = facts.order_fact(raw["raw_orders"],
                                           realised_statuses=B.REALISED_STATUSES)
    views["fct_order_items"] = facts.order_item_fact(raw["raw_order_items"], raw["raw_orders"],
                                                     realised_statuses=B.REALISED_STATUSES)
    views["fct_returns"] = facts.return_fact(raw["raw_return_items"], raw["raw_returns"],
                                             raw["raw_orders"],
                                             empty_values=B.PRIORITY_EMPTY_VALUES,
                                             rules=B.PRIORITY_RULES,
                                             default=B.PRIORITY_DEFAULT)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
