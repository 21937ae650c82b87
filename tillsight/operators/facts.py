"""Order, order-item and return facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.labels import (ACTION_LABELS, CHANNEL_LABELS, REALISED_STATUSES,
                                        REASON_DEFAULT, REASON_EMPTY_VALUES, REASON_RULES,
                                        STATUS_LABELS, label_of)
from tillsight.functions.text import categorise, changed, matched_any_rule, normalise_key


def order_fact(orders: DataFrame,
               channel_labels: Mapping[str, str] = CHANNEL_LABELS,
               status_labels: Mapping[str, str] = STATUS_LABELS,
               realised_statuses: Iterable[str] = REALISED_STATUSES,
               unknown_employee: int = -1) -> DataFrame:
    """One row per order, nothing filtered; the realised-revenue flag makes
    the status decision explicit for whoever aggregates. Narrow projection:
    no shuffle."""
    return orders.select(
        F.col("id").alias("order_id"),
        F.col("order_number"),
        F.to_date("placed_at").alias("date"),
        F.col("customer_id"),
        F.col("location_id"),
        F.coalesce(F.col("salesperson_id"), F.lit(unknown_employee)).cast("long").alias("employee_id"),
        F.col("channel"),
        label_of(F.col("channel"), channel_labels).alias("channel_label"),
        F.col("status"),
        label_of(F.col("status"), status_labels).alias("status_label"),
        F.col("status").isin(list(realised_statuses)).alias("is_realised"),
        *[F.col(c) for c in ("subtotal", "discount_amount") if c in orders.columns],
        F.col("total"),
    )


def order_item_fact(items: DataFrame, orders: DataFrame,
                    realised_statuses: Iterable[str] = REALISED_STATUSES,
                    unknown_employee: int = -1) -> DataFrame:
    """One row per item with the order's date, customer, location, employee,
    channel and status copied on, so both facts share the dimensions.

    Items and orders are joined on the order key: both sides are large, so at
    scale store them bucketed (or partitioned) by that key to keep the join
    free of an exchange.
    """
    i = items.alias("i")
    o = orders.alias("o")
    opt = [F.col(f"i.{c}").alias(n) for c, n in
           (("id", "item_id"), ("line_number", "line_number"), ("unit_price", "unit_price"))
           if c in items.columns]
    return i.join(o, F.col("o.id") == F.col("i.order_id")).select(
        *opt,
        F.col("i.order_id").alias("order_id"),
        F.to_date(F.col("o.placed_at")).alias("date"),
        F.col("o.customer_id").alias("customer_id"),
        F.col("o.location_id").alias("location_id"),
        F.coalesce(F.col("o.salesperson_id"), F.lit(unknown_employee)).cast("long").alias("employee_id"),
        F.col("i.product_variant_id").alias("variant_id"),
        F.col("o.channel").alias("channel"),
        F.col("o.status").alias("status"),
        F.col("o.status").isin(list(realised_statuses)).alias("is_realised"),
        F.col("i.quantity").alias("quantity"),
        F.col("i.line_total").alias("line_total"),
    )


def return_fact(return_items: DataFrame, returns: DataFrame, orders: DataFrame,
                order_items: DataFrame | None = None,
                action_labels: Mapping[str, str] = ACTION_LABELS,
                empty_values: Iterable[str] = REASON_EMPTY_VALUES,
                rules: Sequence[tuple[Sequence[str], str]] = REASON_RULES,
                default: str = REASON_DEFAULT) -> DataFrame:
    """One row per returned item: refund value = quantity x unit refund;
    reason cleaned by the ordered rules (U15a-U15c) with the original kept.

    With ``order_items`` the items are reached through ``order_item_id``
    (the reference's schema); without it each returned item must carry its
    ``order_id`` and ``product_variant_id``. The cleaned label is built once
    and reused by the changed flag.
    """
    ri = return_items.alias("ri")
    r = returns.alias("r")
    o = orders.alias("o")
    j = ri.join(r, F.col("r.id") == F.col("ri.return_id"))
    if order_items is not None:
        oi = order_items.alias("oi")
        j = j.join(oi, F.col("oi.id") == F.col("ri.order_item_id"))
        variant, order_key = F.col("oi.product_variant_id"), F.col("oi.order_id")
    else:
        variant, order_key = F.col("ri.product_variant_id"), F.col("ri.order_id")
    j = j.join(o, F.col("o.id") == order_key)
    item_id = [F.col("ri.id").alias("return_item_id")] if "id" in return_items.columns else \
        [F.col("ri.line_number").alias("line_number")] if "line_number" in return_items.columns else []
    base = j.select(
        *item_id,
        F.col("r.id").alias("return_id"),
        F.col("r.return_number").alias("return_number"),
        F.to_date(F.col("r.created_at")).alias("date"),
        F.col("r.customer_id").alias("customer_id"),
        F.col("r.received_at_location_id").alias("location_id"),
        variant.alias("variant_id"),
        F.col("o.id").alias("order_id"),
        F.col("r.status").alias("status"),
        F.col("ri.action").alias("action"),
        F.col("ri.quantity").alias("quantity"),
        F.col("ri.unit_refund_amount").alias("unit_refund"),
        (F.col("ri.quantity") * F.col("ri.unit_refund_amount")).alias("refund_value"),
        F.col("r.reason").alias("reason_original"),
        normalise_key(F.col("r.reason")).alias("reason_key"),
    )
    key = F.col("reason_key")
    cleaned = categorise(key, empty_values, rules, default)
    return (base
            .withColumn("action_label", label_of(F.col("action"), action_labels))
            .withColumn("reason", cleaned)
            .withColumn("reason_changed", changed(F.col("reason_original"), F.col("reason")))
            .withColumn("reason_matched", matched_any_rule(key, empty_values, rules)))
