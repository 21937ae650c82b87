"""The reference's analyses on tables shaped like its raw schema.

The operators' default column names are the reference's (``orders.channel``,
``order_items.product_variant_id``, ``return_items.order_item_id`` ...), so
its raw tables bind without renaming: load the CSV folder with
``sources.load.load_run`` and pass the published tables here. Every report is
a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tillsight.operators import dims, facts, forecast, profile, recommend, segment, stated
from tillsight.operators.calendar import calendar_dim
from tillsight.operators.weekday import weekday_mean

# --- fixed values: the reference's analysis parameters ----------------------
IN_STORE_CHANNEL = "pos"
MIN_CATEGORIES = 13
TOP_CUSTOMERS = 10
FORECAST_PRODUCT = "Bússola de Bordo 702"
TRAIN_END = "2025-12"
TEST_MONTHS = ("2026-01", "2026-02", "2026-03")
WINDOW = 3
RECOMMEND_PRODUCT = "Motor de Popa 1949"
TOP_SIMILAR = 5
TUKEY_K = 1.5
# --- end of fixed values ----------------------------------------------------

RAW_TABLES = ("orders", "order_items", "product_variants", "products", "categories", "brands",
              "customers", "addresses", "locations", "employees", "returns", "return_items")


def star_schema(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five dimensions and three facts over the raw tables."""
    o = raw["orders"]
    return {
        "dim_calendar": calendar_dim(o, "placed_at", others=[(raw["returns"], "created_at")]),
        "dim_customer": dims.customer_dim(raw["customers"], raw["addresses"]),
        "dim_product": dims.product_dim(raw["product_variants"], raw["products"],
                                        raw["categories"], raw["brands"]),
        "dim_location": dims.location_dim(raw["locations"]),
        "dim_employee": dims.employee_dim(raw["employees"]),
        "fct_orders": facts.order_fact(o),
        "fct_order_items": facts.order_item_fact(raw["order_items"], o),
        "fct_returns": facts.return_fact(raw["return_items"], raw["returns"], o,
                                         order_items=raw["order_items"]),
    }


def reports(raw: Mapping[str, DataFrame], forecast_product: str | None = FORECAST_PRODUCT,
            recommend_product: str | None = RECOMMEND_PRODUCT, train_end: str = TRAIN_END,
            test_months: Sequence[str] = TEST_MONTHS, window: int = WINDOW,
            as_of: str | None = None, top: int = TOP_SIMILAR) -> dict[str, DataFrame]:
    """Every analysis the reference runs, with its parameters as defaults.

    ``forecast_product`` / ``recommend_product`` set to None skip the two
    single-product reports (their name lookups run a small job each).
    """
    o, i = raw["orders"], raw["order_items"]
    v, p = raw["product_variants"], raw["products"]
    star = star_schema(raw)
    out: dict[str, DataFrame] = dict(star)
    # Profiling of the order table.
    out["orders_overview"] = profile.table_overview(o, "created_at")
    out["orders_total_distribution"] = profile.numeric_distribution(o, "total")
    out["orders_columns"] = profile.column_profile(o)
    out["orders_salesperson_nulls"] = profile.null_pattern(o, "channel", "salesperson_id")
    out["orders_status_share"] = profile.share_of_total(o, "status", "total")
    out["orders_by_year"] = profile.yearly_future(o, "created_at", as_of)
    out["orders_integrity"] = profile.integrity_panel(
        o, {"duplicate_ids": ["id"], "duplicate_numbers": ["order_number"]},
        profile.order_checks())
    out["orders_total_outliers"] = profile.iqr_outliers(o, "total", k=TUKEY_K)
    # Business analyses.
    out["weekday_sales"] = weekday_mean(o, star["dim_calendar"], channel=IN_STORE_CHANNEL)
    out["elite_customers"] = segment.elite_customers(o, i, v, p, MIN_CATEGORIES, TOP_CUSTOMERS)
    out["elite_category_mix"] = segment.elite_category_mix(o, i, v, p, raw["categories"],
                                                           MIN_CATEGORIES, TOP_CUSTOMERS)
    # Stated reports.
    out["revenue_summary"] = stated.revenue_summary(star["fct_orders"])
    out["category_mix"] = stated.category_mix(star["fct_order_items"], star["dim_product"])
    out["returns_by_reason"] = stated.returns_by_reason(star["fct_returns"])
    out["channel_location"] = stated.channel_location_crosstab(star["fct_orders"],
                                                               star["dim_location"])
    out["items_vs_subtotal"] = stated.item_order_reconcile(i, o)
    # Forecast and recommendation.
    if forecast_product is not None:
        out["demand_forecast"] = forecast.forecast_product(i, o, v, p, forecast_product,
                                                           train_end, test_months, window)
    pairs = recommend.purchase_pairs(i, o, v)
    out["matrix_summary"] = recommend.matrix_summary(pairs)
    if recommend_product is not None:
        out["similar_products"] = recommend.similar_items_by_name(pairs, p, recommend_product,
                                                                  top)
    return out
