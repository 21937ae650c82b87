"""Item-to-item cosine recommendation on binary purchase pairs.

The customer x product matrix is never materialised densely: it is the sparse
set of distinct (customer, product) pairs. Cosine similarity of two products
is ``common buyers / sqrt(buyers a * buyers b)``. Co-counts are taken for stated
reference products only, one (``similar_items``) or a table of them
(``item_cosine``): the buyers of the references join back to the pairs and are
counted per product, so the work is linear in the pairs of those buyers and no
list of all product pairs ever exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.session import materialize

class ProductNameError(ValueError):
    pass


def purchase_pairs(items: DataFrame, orders: DataFrame, variants: DataFrame,
                   order_filter=None) -> DataFrame:
    """Distinct (customer, product) pairs; quantity and status ignored
    unless ``order_filter`` (a Column over the orders) is given."""
    if order_filter is not None:
        orders = orders.filter(order_filter)
    return (items.select("order_id", "product_variant_id")
            .join(orders.select(F.col("id").alias("order_id"), "customer_id"), "order_id")
            .join(variants.select(F.col("id").alias("product_variant_id"), "product_id"),
                  "product_variant_id")
            .select("customer_id", "product_id").distinct())


def product_buyers(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("buyers"))


def matrix_summary(pairs: DataFrame) -> DataFrame:
    """Customers, products, filled cells and density of the matrix."""
    s = pairs.agg(F.count_distinct("customer_id").alias("customers"),
                  F.count_distinct("product_id").alias("products"),
                  F.count(F.lit(1)).alias("cells"))
    return s.select("customers", "products", "cells",
                    (F.col("cells").cast("double") /
                     (F.col("customers") * F.col("products")).cast("double")).alias("density"))


def name_resolution(products: DataFrame) -> DataFrame:
    """U33 for all names at once: how many ids carry each name; the id when
    exactly one does."""
    g = products.groupBy("name").agg(F.count_distinct("id").alias("ids"),
                                     F.min("id").alias("_min_id"))
    return g.select("name", "ids",
                    F.when(F.col("ids") == 1, F.col("_min_id")).alias("product_id"),
                    F.when(F.col("ids") == 1, "unique").otherwise("ambiguous").alias("status"))


def resolve_product(products: DataFrame, name: str) -> int:
    """The single id carrying ``name``; error if none or several.

    The error tells how many ids there are and the first twenty."""
    named = products.filter(F.col("name") == F.lit(name)).select("id").distinct()
    ids = [r["id"] for r in named.orderBy("id").limit(20).collect()]
    if not ids:
        raise ProductNameError(f"product not found: {name!r}")
    if len(ids) > 1:
        raise ProductNameError(f"ambiguous name {name!r}: {named.count()} ids, from {ids}; give the id")
    return ids[0]


def similar_items(pairs: DataFrame, reference: int, n: int = 5,
                  products: DataFrame | None = None, checkpoint: bool = True) -> DataFrame:
    """U32: the ``n`` products most similar to ``reference`` (itself
    excluded), with similarity rounded to 4 places, common buyers and own
    buyers. Ties go to the lower id. Products sharing no buyer are
    candidates with similarity 0, so the list is filled when fewer than
    ``n`` overlap. A reference nobody bought yields an empty ranking.

    The co-count is the reference's buyer list joined back to the pairs and
    counted per product: linear in the data. The pairs feed three branches,
    so they are checkpointed once (``checkpoint=False`` keeps them lazy).
    """
    if checkpoint:
        pairs = materialize(pairs)
    ref_buyers = pairs.filter(F.col("product_id") == F.lit(reference)).select("customer_id")
    n_ref = ref_buyers.select(F.count(F.lit(1))).scalar()
    common = (pairs.join(ref_buyers, "customer_id")
              .filter(F.col("product_id") != F.lit(reference))
              .groupBy("product_id").agg(F.count(F.lit(1)).alias("common_buyers")))
    cand = (product_buyers(pairs).filter(F.col("product_id") != F.lit(reference))
            .join(common, "product_id", "left")
            .select("product_id", F.coalesce("common_buyers", F.lit(0)).alias("common_buyers"),
                    "buyers")
            .filter(n_ref > 0))
    sim = (F.col("common_buyers").cast("double") /
           F.sqrt((n_ref * F.col("buyers")).cast("double")))
    top = (cand.withColumn("similarity", sim)
           .orderBy(F.col("similarity").desc_nulls_last(), F.col("product_id").asc())
           .limit(n))
    if products is not None:
        top = top.join(products.select(F.col("id").alias("product_id"),
                                       F.col("name").alias("product")), "product_id", "left")
    else:
        top = top.withColumn("product", F.lit(None).cast("string"))
    return top.select("product_id", "product", F.round("similarity", 4).alias("similarity"),
                      "common_buyers", "buyers")


def similar_items_by_name(pairs: DataFrame, products: DataFrame, name: str,
                          n: int = 5) -> DataFrame:
    """U32 + U33 as the reference runs them: resolve ``name`` to its single
    product id (error if none or several), then rank its neighbours."""
    return similar_items(pairs, resolve_product(products, name), n, products)


def item_cosine(pairs: DataFrame, references: DataFrame, checkpoint: bool = True) -> DataFrame:
    """The cosine rows of a stated set of products: every other product
    that shares a buyer with a reference (``references`` has one column of
    product ids, of any type). Pairs without a common buyer have similarity 0
    and are not listed. The pairs feed four branches, so they are checkpointed
    once (``checkpoint=False`` keeps them lazy)."""
    if checkpoint:
        pairs = materialize(pairs)
    wanted = references.select(F.col(references.columns[0]).alias("product_a")).distinct()
    buyers = product_buyers(pairs)
    held = pairs.select(F.col("product_id").alias("product_a"), "customer_id").join(wanted, "product_a")
    co = (held.join(pairs.select("customer_id", F.col("product_id").alias("product_b")), "customer_id")
          .filter("product_a != product_b")
          .groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("common_buyers")))
    ba = buyers.select(F.col("product_id").alias("product_a"), F.col("buyers").alias("buyers_a"))
    bb = buyers.select(F.col("product_id").alias("product_b"), F.col("buyers").alias("buyers_b"))
    return co.join(ba, "product_a").join(bb, "product_b").select(
        "product_a", "product_b", "common_buyers", "buyers_a", "buyers_b",
        (F.col("common_buyers").cast("double") /
         F.sqrt((F.col("buyers_a") * F.col("buyers_b")).cast("double"))).alias("similarity"))
