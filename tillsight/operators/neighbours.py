"""U32 for every product at once: exact top-N lists by a pruned search.

The similarity of two products is ``common / sqrt(buyers a * buyers b)``. A customer
with at most ``list_limit`` products adds its pairs of products to the counts, a
bounded number for each purchase. The products of a longer list are never paired
with each other as a whole:

* what the short lists say is a lower bound of a pair's similarity, and with
  ``min`` of both products' buyers among the long lists an upper bound. A pair
  whose upper bound lies under the N-th lower bound of its product is dropped;
  the purchases in long lists are counted for the others only;
* pairs that meet in long lists alone are searched by size, products with few
  buyers first: with ``h`` buyers in long lists a product can't be more similar
  to one that has ``b`` buyers than ``h / sqrt(own buyers * b)``. The search of a
  product ends as soon as that is less than its N-th best.

The counts of short lists are never dealt as pairs. Every purchase takes its
customer's list to the task of its product, once; there the products of the lists
are counted, bounded and ranked in place (``counting``). Without long lists, a
product that met ``a`` once only matters if it is no more common than the N + 1
rarest products of each customer of ``a``: N others are at least as similar.

The lists that go to products are more than the purchases, by the length of a list.
They go in rounds, each for a part of the products (``_rounds``). A round deals a
bounded number of cells for each purchase and leaves its products' lists; what it
dealt is deleted before the next. So the disk in use grows as the purchases do,
however long the lists are.

Products that share no buyer have similarity 0 and fill short lists by id, as in
the list of one product (``recommend.similar_items``). Ties go to the lower id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.counting import met_counter
from tillsight.operators.recommend import product_buyers
from tillsight.session import discard, shuffles_dropped, stage

LIST_LIMIT = 256
FIRST_SLICE = 64
# Met products that one task counts, and buyers from which a product's are dealt out.
COUNTS_PER_TASK = 4_000_000
MANY_BUYERS = 10_000
# Products of lists dealt in one round: so many at least, or so many a purchase.
CELLS_PER_ROUND = 100_000_000
CELLS_PER_PURCHASE = 4
PURCHASES_PER_FILE = 200_000


def _similarity(common: str | Column, a: str, b: str) -> Column:
    common = F.col(common) if isinstance(common, str) else common
    return common.cast("double") / F.sqrt((F.col(a) * F.col(b)).cast("double"))


def _best(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` best rows of each product ``a``, with their ``rank``."""
    order = Window.partitionBy("a").orderBy(F.col("similarity").desc(), F.col("b"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _nth(best: DataFrame, n: int) -> DataFrame:
    """Similarity and id of each product's ``n``-th best; none if it has fewer."""
    return best.filter(F.col("rank") == n).select("a", F.col("similarity").alias("least"), F.col("b").alias("least_id"))


def _meetings(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many customers of ``left`` (a, customer_id) and ``right`` (b,
    customer_id) are common, for the pairs that have any."""
    return (left.join(right, "customer_id").filter("a != b")
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("met")))


def similar_items_all(pairs: DataFrame, n: int = 5, list_limit: int = LIST_LIMIT,
                      first_slice: int = FIRST_SLICE) -> DataFrame:
    """``n`` rows for every product that anyone bought (fewer only if there are
    not so many others): ``product_id, rank, similar_id, similarity`` (rounded to
    4 places, ranked unrounded), ``common_buyers, buyers`` (of the similar one)."""
    with shuffles_dropped(pairs.sparkSession):
        best, sizes = _lists(pairs, n, list_limit, first_slice)
        return _filled(best, sizes, n)


def _lists(pairs: DataFrame, n: int, list_limit: int, first_slice: int) -> tuple[DataFrame, DataFrame]:
    """The best among the products that meet each product, and the ``sizes``."""
    pairs = stage(pairs.select("customer_id", "product_id"), "similar-pairs")
    lists = pairs.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(F.count(F.lit(1)).alias("items"))
    items = F.when(F.col("items") <= list_limit, F.col("items"))
    known = lists.agg(F.sum(items * items).alias("work"), F.sum(items).alias("purchases"), F.max("items").alias("longest")).first()
    has_long = (known["longest"] or 0) > list_limit
    short, hot, left = pairs.filter("customer_id IS NOT NULL"), None, [pairs]
    sizes = product_buyers(pairs).withColumn("h", F.lit(0).cast("long"))
    if has_long:
        tagged = stage(pairs.join(lists.select("customer_id", (F.col("items") > list_limit).alias("long")), "customer_id"),
                       "similar-tagged")
        short, hot = tagged.filter("NOT long").drop("long"), tagged.filter("long").drop("long")
        met = hot.groupBy("product_id").agg(F.count(F.lit(1)).alias("h"))
        sizes = sizes.drop("h").join(met, "product_id", "left").select("product_id", "buyers", F.coalesce("h", F.lit(0)).alias("h"))
        left.append(tagged)
    sizes = stage(sizes, "similar-sizes")
    lists = _listed(short, sizes, n, has_long, known["purchases"] or 0)
    most = sizes.agg(F.max("buyers")).first()[0] or 0

    def side(c: str) -> DataFrame:
        return sizes.select(F.col("product_id").alias(c), F.col("buyers").alias(f"n{c}"), F.col("h").alias(f"h{c}"))

    def purchases(df: DataFrame, c: str) -> DataFrame:
        return df.select("customer_id", F.col("product_id").alias(c))

    if not has_long and most <= MANY_BUYERS:  # the lists say all that is read from here on
        discard(*left)
        left = []
    found = []
    rounds = _rounds(known["work"] or 0, known["purchases"] or 0)
    tasks = max(1, -(-(known["work"] or 0) // (COUNTS_PER_TASK * rounds)))
    for i in range(rounds):
        def part(c: str | Column) -> Column:
            return F.lit(True) if rounds == 1 else F.pmod(F.xxhash64(c), F.lit(rounds)) == i  # noqa: B023

        counted = _counted(lists, sizes, None if has_long else n, tasks, part)
        many = side("a").filter((F.col("na") > MANY_BUYERS) & part("a"))
        if most > MANY_BUYERS and many.limit(1).count():
            beyond = (_meetings(purchases(short, "a").join(many.select("a"), "a", "left_semi"), purchases(short, "b"))
                      .join(many, "a").join(side("b"), "b").withColumn("similarity", _similarity("met", "na", "nb")))
            counted = counted.unionByName(beyond if has_long else _best(beyond.drop("ha", "hb"), n))
        if has_long:
            counted = stage(counted, "similar-counted")
            best, used = _with_long_lists(counted, hot, sizes, side, purchases, part, n, first_slice)
            found.append(best)
            discard(counted, *used)
        else:
            found.append(stage(counted, "similar-best"))
    discard(lists, *left)
    return reduce(DataFrame.unionByName, found), sizes


def _rounds(work: int, purchases: int) -> int:
    """In how many parts ``work`` cells are dealt, of so many purchases."""
    return max(1, -(-work // max(CELLS_PER_ROUND, CELLS_PER_PURCHASE * purchases)))


def _listed(short: DataFrame, sizes: DataFrame, n: int, has_long: bool, purchases: int) -> DataFrame:
    """The ``list`` of each customer (products ``p``, their buyers ``n``, and with
    long lists ``h``) and ``edge``, the most buyers that any of the N + 1 rarest has."""
    kind = sizes.schema["product_id"].dataType.simpleString()
    far, most = sizes.agg(F.max(F.abs("product_id")) if kind == "bigint" else F.lit(0), F.max("buyers")).first()
    # Ids and counts that fit go as integers.
    narrow = "int" if kind == "bigint" and (far or 0) < 2 ** 31 else kind
    count = "int" if (most or 0) < 2 ** 31 else "bigint"
    cells = short.join(sizes, "product_id").select(
        "customer_id", F.col("product_id").cast(narrow).alias("p"), F.col("buyers").cast(count).alias("n"),
        *[F.col("h").cast(count).alias("h")] * has_long).repartition(max(1, -(-purchases // PURCHASES_PER_FILE)), "customer_id")
    lists = cells.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("n", "p", *["h"] * has_long))).alias("list"))
    rarest = F.array_distinct(F.slice("list", 1, n + 1))  # fewer say nothing, which only costs time
    edge = F.when(F.size(rarest) > n, F.element_at(rarest, -1)["n"].cast("long")).otherwise(F.lit(2 ** 63 - 1))
    return stage(lists.select("list", edge.alias("edge")), "similar-lists")


def _counted(lists: DataFrame, sizes: DataFrame, n: int | None, tasks: int, part: Callable[[str | Column], Column]) -> DataFrame:
    """``a, b, met, na, nb, similarity`` and ``ha, hb`` of the products that meet in
    ``lists``, dealt by ``a``, which is of the ``part`` and has at most
    ``MANY_BUYERS``. With ``n``, the ``n`` best with their ``rank`` instead of ``ha, hb``."""
    kind = sizes.schema["product_id"].dataType.simpleString()
    cell = lists.schema["list"].dataType.elementType
    columns = [c for c in ("p", "n", "h") if c in cell.names]
    dealt = lists.select("list", *(F.col("list")[c].alias(c) for c in columns), "edge") \
        .select(F.explode("list").alias("own"), *columns, "edge") \
        .filter((F.col("own.n") <= MANY_BUYERS) & part(F.col("own.p").cast(kind)))
    dealt = dealt.select(F.col("own.p").alias("a"), F.col("own.n").alias("na"), *[F.col("own.h").alias("ha")] * ("h" in columns),
                         *columns, "edge").repartition(tasks, "a").sortWithinPartitions("a")
    ids = f"a {cell['p'].dataType.simpleString()}, b {cell['p'].dataType.simpleString()}"
    rest = "ha long, hb long" if n is None else "similarity double, rank int"
    met = dealt.mapInArrow(met_counter(n), f"{ids}, met long, na long, nb long, {rest}") \
        .withColumn("a", F.col("a").cast(kind)).withColumn("b", F.col("b").cast(kind))
    return met if n is not None else met.withColumn("similarity", _similarity("met", "na", "nb"))


def _with_long_lists(counted, hot, sizes, side, purchases, part, n, first_slice) -> tuple[DataFrame, list[DataFrame]]:
    """The lists of the products of the ``part`` once the customers with long lists
    count as well, and staged tables that they don't read any more."""
    used = []

    def kept(df: DataFrame, purpose: str) -> DataFrame:
        used.append(stage(df, purpose))
        return used[-1]

    best = kept(_best(counted, n), "similar-short")
    hot_a, hot_b = purchases(hot, "a").filter(part("a")), purchases(hot, "b")
    both = F.least("ha", "hb")
    upper = _similarity(F.col("met") + both, "na", "nb")
    sure = counted.filter(both == 0)
    open_ = kept(counted.filter(both > 0).join(_nth(best, n), "a", "left")
                 .filter(F.col("least").isNull() | (upper >= F.col("least")))
                 .select("a", "b", "met", "na", "nb", "ha", "hb"), "similar-open")
    more = (open_.select("a", "b").join(hot_a, "a").join(hot_b, ["b", "customer_id"])
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("more")))
    open_ = open_.join(more, ["a", "b"], "left").withColumn("met", F.col("met") + F.coalesce("more", F.lit(0))) \
        .withColumn("similarity", _similarity("met", "na", "nb"))
    # What the short lists counted in full, or up to the bound; never counted twice below.
    columns = ["a", "b", "met", "na", "nb", "similarity"]
    best = kept(_best(sure.select(*columns).unionAll(open_.select(*columns)), n), "similar-best")
    searching = side("a").filter((F.col("ha") > 0) & part("a"))
    met_short = counted.select("a", "b")
    last, size = None, first_slice
    while True:
        rest = sizes if last is None else sizes.filter(F.struct("buyers", "product_id") > _key(sizes, last))
        edge = rest.select("buyers", "product_id").orderBy("buyers", "product_id").limit(size) \
            .agg(F.max(F.struct("buyers", "product_id")).alias("k")).first()["k"]
        if edge is None:
            break
        slice_ = rest.filter(F.struct("buyers", "product_id") <= _key(sizes, edge)).select(F.col("product_id").alias("b"))
        found = _meetings(hot_a.join(searching.select("a"), "a"), hot_b.join(slice_, "b"))
        # Pairs that the short lists know have been decided above.
        found = (found.join(met_short, ["a", "b"], "left_anti").join(side("a"), "a").join(side("b"), "b")
                 .withColumn("similarity", _similarity("met", "na", "nb")).select(*columns))
        best = kept(_best(best.select(*columns).unionAll(found), n), "similar-best")
        # Who can still find a better one among the products beyond the edge.
        bound = F.col("ha").cast("double") / F.sqrt((F.col("na") * F.lit(edge["buyers"])).cast("double"))
        behind = F.lit(edge["product_id"]) >= F.col("least_id")
        searching = kept(side("a").filter("ha > 0").join(searching.select("a"), "a").join(_nth(best, n), "a", "left")
                         .filter(F.col("least").isNull() | (bound > F.col("least"))
                                 | ((bound == F.col("least")) & ~behind))
                         .select("a", "na", "ha"), "similar-searching")
        if not searching.limit(1).count():
            break
        last, size = edge, size * 8
    return best, [x for x in used if x is not best]


def _key(sizes: DataFrame, edge) -> Column:
    return F.struct(F.lit(edge["buyers"]).cast("long").alias("buyers"),
                    F.lit(edge["product_id"]).cast(sizes.schema["product_id"].dataType).alias("product_id"))


def _filled(best: DataFrame, sizes: DataFrame, n: int) -> DataFrame:
    """Short lists filled with products that share no buyer, by id. A list of
    fewer than ``n`` names all products with a common buyer, so the 2 n + 1 lowest
    ids hold enough others."""
    best = best.select("a", "b", "met", "nb", "similarity", "rank")
    kind = sizes.schema["product_id"].dataType.simpleString()
    low = F.array(*[F.struct(F.lit(r["product_id"]).cast(kind).alias("b"), F.lit(r["buyers"]).cast("long").alias("nb"))
                    for r in sizes.select("product_id", "buyers").orderBy("product_id").limit(2 * n + 1).collect()]) \
        .cast(f"array<struct<b:{kind},nb:bigint>>")
    short = sizes.select(F.col("product_id").alias("a")).join(best.filter(F.col("rank") == n).select("a"), "a", "left_anti")
    had = best.join(short, "a", "left_semi").groupBy("a").agg(F.count(F.lit(1)).alias("had"), F.collect_list("b").alias("listed"))
    free = F.filter(low, lambda x: (x["b"] != F.col("a")) & ~F.coalesce(F.array_contains("listed", x["b"]), F.lit(False)))
    fill = short.join(had, "a", "left").select("a", F.coalesce("had", F.lit(0)).alias("had"), F.posexplode(free).alias("i", "low")) \
        .withColumn("rank", (F.col("had") + F.col("i") + 1).cast("int")).filter(F.col("rank") <= n) \
        .select("a", F.col("low.b").alias("b"), F.lit(0).cast("long").alias("met"), F.col("low.nb").alias("nb"),
                F.lit(0.0).alias("similarity"), "rank")
    return best.unionAll(fill).select(
        F.col("a").alias("product_id"), "rank", F.col("b").alias("similar_id"), F.round("similarity", 4).alias("similarity"),
        F.col("met").alias("common_buyers"), F.col("nb").alias("buyers"))
