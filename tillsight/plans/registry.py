"""Registered queries: one per operator, bound to the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types match the DuckDB twin in ``tillsight.plans.oracle``. On top of
the operators come final casts (DECIMAL(18,2) money, BIGINT counts, DOUBLE
ratios). Some operators start jobs while they are built: quantiles, the top-N
and cosine reports, the category mix, the forecast evaluation and everything
that reads CSV write an intermediate table first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import dims, facts, forecast, neighbours, profile, recommend, segment, stated
from tillsight.operators.calendar import calendar_dim
from tillsight.operators.weekday import weekday_mean
from tillsight.plans import bindings as B

Query = Callable[[SparkSession, str], DataFrame]

# Forecast setup for the TPC-H dates (1995-01 .. 2001-08).
TRAIN_END = "2000-12"
TEST_MONTHS = ("2001-01", "2001-02", "2001-03")
WINDOW = 3
# Segmentation: categories are the 25 brands.
MIN_CATEGORIES = 23
TOP_N = 10
# Recommendation: reference product id and list length; the cosine report has a
# stated set of references, every product whose id is divisible by this.
REFERENCE_PRODUCT = 7
REFERENCE_STEP = 100
SIMILAR_N = 5
# Reference date for the future-dated count (never current_date in a test).
AS_OF = "2001-06-30"


def _money(df: DataFrame, *cols: str, scale: int = 2) -> DataFrame:
    """Row-level money: DECIMAL(18, scale)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast(f"decimal(18,{scale})"))
    return df


def _sums(df: DataFrame, *cols: str, scale: int = 2) -> DataFrame:
    """Aggregated money: DECIMAL(38, scale), wide enough for totals of
    100 TB of orders (DECIMAL(18,2) stops near 10^16)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast(f"decimal(38,{scale})"))
    return df


def _long(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


def _calendar(spark, d):
    return calendar_dim(B.orders(spark, d), "placed_at",
                        others=[(B.returns(spark, d), "created_at")])


def _order_fact(spark, d):
    return facts.order_fact(B.orders(spark, d), channel_labels=B.PRIORITY_LABELS,
                            status_labels=B.STATUS_LABELS,
                            realised_statuses=B.REALISED_STATUSES)


def _item_fact(spark, d):
    return facts.order_item_fact(B.order_items(spark, d), B.orders(spark, d),
                                 realised_statuses=B.REALISED_STATUSES)


def _return_fact(spark, d):
    return facts.return_fact(B.return_items(spark, d), B.returns(spark, d), B.orders(spark, d),
                             action_labels=B.ACTION_LABELS,
                             empty_values=B.PRIORITY_EMPTY_VALUES, rules=B.PRIORITY_RULES,
                             default=B.PRIORITY_DEFAULT)


def _product_dim(spark, d):
    return dims.product_dim(B.product_variants(spark, d), B.products(spark, d),
                            B.categories(spark, d), B.brands(spark, d))


def _series(spark, d):
    return forecast.monthly_demand(B.order_items(spark, d), B.orders(spark, d),
                                   B.product_variants(spark, d), B.products(spark, d))


def _forecast(spark, d):
    return forecast.moving_average_forecast(_series(spark, d), TRAIN_END, TEST_MONTHS, WINDOW)


def _pairs(spark, d):
    return recommend.purchase_pairs(B.order_items(spark, d), B.orders(spark, d),
                                    B.product_variants(spark, d))


# --- calendar and dimensions ------------------------------------------------
def q_calendar_dim(spark, d):
    return _calendar(spark, d)


def q_customer_dim(spark, d):
    return dims.customer_dim(B.customers(spark, d), B.addresses(spark, d),
                             person_type_labels=B.SEGMENT_LABELS)


def q_product_dim(spark, d):
    return _money(_product_dim(spark, d), "sale_price", "cost_price", "gross_margin")


def q_location_dim(spark, d):
    return dims.location_dim(B.locations(spark, d), type_labels=B.NATION_TYPE_LABELS)


def q_unknown_member_dim(spark, d):
    return dims.employee_dim(B.employees(spark, d))


# --- facts ------------------------------------------------------------------
def q_order_fact(spark, d):
    return _order_fact(spark, d)


def q_order_item_fact(spark, d):
    return _item_fact(spark, d)


def q_return_fact(spark, d):
    out = _return_fact(spark, d)
    return _money(out, "refund_value", scale=5)


def q_clean_text_key(spark, d):
    from tillsight.functions.text import normalise_key
    r = B.returns(spark, d)
    return r.select(F.col("id").alias("return_id"), F.col("reason").alias("reason_original"),
                    normalise_key(F.col("reason")).alias("reason_key"))


def q_rule_categorise(spark, d):
    from tillsight.functions.text import categorise, matched_any_rule, normalise_key
    r = B.returns(spark, d)
    g = r.groupBy(F.col("reason").alias("reason_original")).agg(
        F.count(F.lit(1)).alias("returns"))
    k = normalise_key(F.col("reason_original"))
    return g.select("reason_original", k.alias("reason_key"),
                    categorise(k, B.PRIORITY_EMPTY_VALUES, B.PRIORITY_RULES, B.PRIORITY_DEFAULT)
                    .alias("reason"),
                    matched_any_rule(k, B.PRIORITY_EMPTY_VALUES, B.PRIORITY_RULES).alias("matched"),
                    F.col("returns").cast("long").alias("returns"))


def q_changed_flag(spark, d):
    f = _return_fact(spark, d)
    return (f.groupBy("reason", "reason_changed")
            .agg(F.count(F.lit(1)).cast("long").alias("items")))


def q_star_schema_views(spark, d):
    """Items by quarter and location type, read by SQL from the views of the
    catalog alone; the role tables are stored as a database's raw tables first."""
    import uuid

    from tillsight.plans import lasting_views
    from tillsight.session import new_run_dir
    where, mark = new_run_dir(spark, "star"), uuid.uuid4().hex[:8]
    raw, star = f"raw_{mark}", f"star_{mark}"
    spark.sql(f"CREATE DATABASE {raw} LOCATION '{where}/raw'")
    spark.sql(f"CREATE DATABASE {star} LOCATION '{where}/star'")
    for name in lasting_views.RAW:
        getattr(B, name)(spark, d).write.option("path", f"{where}/raw/{name}").saveAsTable(f"{raw}.{name}")
    lasting_views.create_views(spark, raw, star, lasting_views.Vocabulary(
        person_types=B.SEGMENT_LABELS, location_types=B.NATION_TYPE_LABELS, channels=B.PRIORITY_LABELS, statuses=B.STATUS_LABELS,
        realised=B.REALISED_STATUSES, actions=B.ACTION_LABELS, empty_reasons=B.PRIORITY_EMPTY_VALUES,
        reason_rules=B.PRIORITY_RULES, reason_default=B.PRIORITY_DEFAULT))
    return spark.sql(f"""
        SELECT cal.year, cal.quarter, l.type_label, COUNT(*) AS items, CAST(SUM(i.quantity) AS BIGINT) AS units,
               CAST(SUM(i.line_total) AS DECIMAL(38,2)) AS revenue, COUNT(DISTINCT p.brand) AS brands,
               COUNT(DISTINCT c.customer) AS customers, COUNT(DISTINCT e.employee) AS employees
        FROM {star}.fct_order_items i JOIN {star}.dim_calendar cal ON cal.date = i.date
        JOIN {star}.dim_location l ON l.location_id = i.location_id
        JOIN {star}.dim_product p ON p.variant_id = i.variant_id
        JOIN {star}.dim_customer c ON c.customer_id = i.customer_id
        JOIN {star}.dim_employee e ON e.employee_id = i.employee_id
        WHERE i.is_realised GROUP BY cal.year, cal.quarter, l.type_label""")


# --- profiling --------------------------------------------------------------
def q_table_overview(spark, d):
    from tillsight.sources.tables import read_table
    return profile.table_overview(read_table(spark, d, "orders"), "o_orderdate")


def q_numeric_distribution(spark, d):
    out = profile.numeric_distribution(B.orders(spark, d), "total")
    return _money(out, "min_value", "max_value")


def q_column_profile(spark, d):
    return profile.column_profile(B.orders(spark, d))


def q_null_pattern(spark, d):
    return profile.null_pattern(B.orders(spark, d), "channel", "salesperson_id")


def q_share_of_total(spark, d):
    return _sums(profile.share_of_total(B.orders(spark, d), "status", "total"), "value_sum")


def q_yearly_future(spark, d):
    return profile.yearly_future(B.orders(spark, d), "created_at", as_of=AS_OF)


def q_integrity_panel(spark, d):
    return profile.integrity_panel(
        B.orders_with_item_totals(spark, d),
        {"duplicate_ids": ["id"], "duplicate_numbers": ["order_number"]},
        profile.order_checks())


def q_iqr_outliers(spark, d):
    return profile.iqr_outliers(B.orders(spark, d), "total")


# --- business analyses ------------------------------------------------------
def q_weekday_mean(spark, d):
    out = weekday_mean(B.orders(spark, d), _calendar(spark, d), channel=B.IN_STORE_CHANNEL)
    return _sums(out, "total_sold")


def q_elite_customers(spark, d):
    out = segment.elite_customers(B.orders(spark, d), B.order_items(spark, d),
                                  B.product_variants(spark, d), B.products(spark, d),
                                  min_categories=MIN_CATEGORIES, n=TOP_N,
                                  category_col="brand_id")
    return _sums(out, "revenue")


def q_elite_category_mix(spark, d):
    out = segment.elite_category_mix(B.orders(spark, d), B.order_items(spark, d),
                                     B.product_variants(spark, d), B.products(spark, d),
                                     B.brands(spark, d), min_categories=MIN_CATEGORIES, n=TOP_N,
                                     category_col="brand_id")
    return _long(out, "items_bought", "orders_involved")


# --- time series ------------------------------------------------------------
def q_monthly_demand(spark, d):
    return _series(spark, d)


def q_moving_average_forecast(spark, d):
    return _forecast(spark, d).select("name", "month", "forecast", "window_units", "status")


def q_series_summary(spark, d):
    return forecast.series_summary(_series(spark, d))


def q_training_window(spark, d):
    return forecast.training_window(_series(spark, d), TRAIN_END, WINDOW)


def _evaluation(spark, d):
    from tillsight.session import materialize
    # The series feeds the forecast and the actuals: build it once.
    series = materialize(_series(spark, d))
    fc = forecast.moving_average_forecast(series, TRAIN_END, TEST_MONTHS, WINDOW)
    return forecast.forecast_evaluation(series, fc)


def q_forecast_evaluation(spark, d):
    return forecast.forecast_summary(_evaluation(spark, d))


def q_forecast_by_month(spark, d):
    return _evaluation(spark, d).select("name", "month", "forecast", "actual", "abs_error")


# --- recommendation ---------------------------------------------------------
def q_purchase_pairs(spark, d):
    return _pairs(spark, d)


def q_item_cosine(spark, d):
    references = B.products(spark, d).filter(F.col("id") % REFERENCE_STEP == 0).select("id")
    return recommend.item_cosine(_pairs(spark, d), references)


def q_similar_items_topn(spark, d):
    return recommend.similar_items(_pairs(spark, d), REFERENCE_PRODUCT, SIMILAR_N,
                                   B.products(spark, d))


def q_similar_items_all(spark, d):
    return neighbours.similar_items_all(_pairs(spark, d), SIMILAR_N)


def q_name_resolution(spark, d):
    return recommend.name_resolution(B.products(spark, d))


def q_matrix_density(spark, d):
    return recommend.matrix_summary(_pairs(spark, d))


# --- stated reports ---------------------------------------------------------
def q_revenue_summary(spark, d):
    f = facts.order_fact(B.orders_with_item_totals(spark, d),
                         realised_statuses=B.REALISED_STATUSES)
    return _sums(_sums(stated.revenue_summary(f), "total_all", "revenue_realised"),
                 "discount_realised", scale=4)


def q_category_mix(spark, d):
    out = stated.category_mix(_item_fact(spark, d), _product_dim(spark, d))
    return _sums(out, "revenue")


def q_returns_by_reason(spark, d):
    return _sums(stated.returns_by_reason(_return_fact(spark, d)), "refund_value", scale=5)


def q_channel_location_crosstab(spark, d):
    return stated.channel_location_crosstab(_order_fact(spark, d),
                                            dims.location_dim(B.locations(spark, d)))


def q_item_order_reconcile(spark, d):
    out = stated.item_order_reconcile(B.order_items(spark, d), B.orders(spark, d), "total")
    return _sums(out, "abs_difference")


# --- ingestion --------------------------------------------------------------
# Role tables rendered as text, as a CSV export of them would read.
INFER_TABLES = {
    "orders": B.orders,
    "order_items": B.order_items,
    "customers": B.customers,
    "product_variants": B.product_variants,
    "returns": B.returns,
}


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _text_tables(spark, d):
    return {name: _as_text(fn(spark, d)) for name, fn in INFER_TABLES.items()}


def q_infer_types(spark, d):
    from tillsight.sources.infer import infer_schema
    return infer_schema(_text_tables(spark, d))


def q_key_candidates(spark, d):
    from tillsight.sources.infer import infer_schema, key_candidates
    return key_candidates(infer_schema(_text_tables(spark, d)))


def _export_csv(spark, d, damaged: bool = False) -> dict[str, str]:
    """Write the role tables as CSV datasets under a fresh folder of the
    shared directory; returns table -> path. With ``damaged``: each 97th return
    (they are in the order of their ids) has a reason with an unquoted comma, each
    101st variant a line break in its SKU, and the last file of the customers
    holds a blank line."""
    from tillsight.session import new_run_dir, side_by_side
    from tillsight.sources.snapshots import create_if_absent
    from tillsight.sources.csv_files import write_csv
    root = new_run_dir(spark, "csv-export")

    def put(table) -> tuple[str, str]:
        name, fn = table
        path, df = f"{root}/{name}.csv", fn(spark, d)
        quote = True
        if damaged and name == "returns":
            quote = False
            df = df.withColumn("reason", F.when(F.col("id") % 97 == 0, F.concat(
                F.coalesce("reason", F.lit("")), F.lit(",x"))).otherwise(F.col("reason"))).orderBy("id")
        if damaged and name == "product_variants":
            df = df.withColumn("sku", F.when(F.col("id") % 101 == 0, F.concat("sku", F.lit("\n2nd")))
                               .otherwise(F.col("sku")))
        write_csv(df, path, quote)
        if damaged and name == "customers":
            create_if_absent(spark, f"{path}/z-last.csv", ",".join(df.columns) + "\n\n")
        return name, path

    return dict(side_by_side(put, INFER_TABLES.items()))


def q_csv_validation(spark, d):
    from tillsight.sources.csv_files import validate_csv
    return validate_csv(spark, list(_export_csv(spark, d, damaged=True).values())) \
        .drop("path", "content", "example", "first_bad_file", "first_bad_in_file")


def q_load_reconcile(spark, d):
    from tillsight.session import new_run_dir, stage
    from tillsight.sources.load import load_run, reconcile_run
    paths = _export_csv(spark, d, damaged=True)
    # The orders aren't declared, and a declared table has no file.
    expected = [t for t in paths if t != "orders"] + ["warehouses"]
    _, run = load_run(spark, list(paths.values()), new_run_dir(spark, "raw-load"), expected=expected)
    # One value of the stored items changes after the load; no row comes or goes.
    items = spark.read.parquet(f"{run}/order_items")
    first = items.agg(F.min(F.struct("order_id", "line_number")).alias("k")).first()["k"]
    hit = (F.col("order_id") == first[0]) & (F.col("line_number") == first[1])
    changed = stage(items.withColumn("quantity", F.when(hit, F.col("quantity") + 1).otherwise(F.col("quantity"))), "changed-items")
    changed.write.mode("overwrite").parquet(f"{run}/order_items")
    return reconcile_run(spark, run, expected)


# Files of the reload: customers by the remainder of their id.
RELOAD_FILES = 4


def q_reload_changed_files(spark, d):
    """U05 for a folder whose files change: customers in four files are loaded,
    one file is replaced (every fifth of its customers left out, the names of the
    others in capitals), one is new, and the folder is loaded again."""
    from tillsight.session import new_run_dir
    from tillsight.sources.csv_files import read_text_table
    from tillsight.sources.infer import infer_schema, struct_from_catalog
    from tillsight.sources.reload import current_rows, reload_changed
    landing, dest = new_run_dir(spark, "landing"), new_run_dir(spark, "reload")
    customers = _as_text(B.customers(spark, d))
    part = F.col("id").cast("long") % RELOAD_FILES

    def put(name: str, rows: DataFrame) -> None:
        _put_file(spark, rows, landing, name)

    for k in range(RELOAD_FILES - 1):
        put(f"part{k}.csv", customers.filter(part == k))
    schema = struct_from_catalog(infer_schema({"customers": read_text_table(spark, landing)}), "customers")
    reload_changed(spark, landing, "customers", schema, dest)
    put("part1.csv", customers.filter((part == 1) & (F.col("id").cast("long") % 5 != 0))
        .withColumn("legal_name", F.upper("legal_name")))
    put(f"part{RELOAD_FILES - 1}.csv", customers.filter(part == RELOAD_FILES - 1))
    report = reload_changed(spark, landing, "customers", schema, dest)
    now = current_rows(spark, "customers", schema, dest).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").cast("long").alias("id_sum"),
        F.count_if(F.col("legal_name") == F.upper("legal_name")).alias("capitals"))
    return report.agg(F.count_if(F.col("action") == "new").alias("files_new"),
                      F.count_if(F.col("action") == "replaced").alias("files_replaced"),
                      F.count_if(F.col("action") == "unchanged").alias("files_unchanged"),
                      F.sum("records").alias("records")).join(now)


def _put_file(spark, rows: DataFrame, folder: str, name: str) -> None:
    """Write ``rows`` as CSV beside ``folder`` and put it there as one file
    (a sub-folder of parts) called ``name``, in place of what was there."""
    from tillsight.session import new_run_dir
    from tillsight.sources.csv_files import write_csv
    made = f"{new_run_dir(spark, 'one-file')}/data"
    write_csv(rows.coalesce(1), made)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(made)
    files = source.getFileSystem(conf)
    file = next(s.getPath() for s in files.listStatus(source) if s.getPath().getName().endswith(".csv"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(files, file, files, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), False, True, conf)


def q_incremental_load(spark, d):
    """U05 in streaming form: CSV exports of the role tables land in one
    folder per table and are loaded by an available-now stream; returns the
    per-batch reconciliation."""
    from tillsight.session import new_run_dir, side_by_side, stage
    from tillsight.sources.csv_files import read_text_table
    from tillsight.sources.infer import infer_schema, struct_from_catalog
    from tillsight.streaming.landing import batch_report, stream_raw_load
    paths = _export_csv(spark, d)
    dest = new_run_dir(spark, "stream-load")
    # Inference reads each column by itself: from a columnar copy, so that the
    # text is parsed once and not once a column.
    texts = dict(zip(paths, side_by_side(lambda path: stage(read_text_table(spark, path), "stream-text"), paths.values())))
    catalog = infer_schema(texts)
    # The five streams are independent: start them all, then wait.
    running = [stream_raw_load(spark, path, name, struct_from_catalog(catalog, name), dest)
               for name, path in paths.items()]
    for q in running:
        q.awaitTermination()
    reports = None
    for name in paths:
        rep = batch_report(spark, dest, name)
        reports = rep if reports is None else reports.unionByName(rep)
    return reports.groupBy("table").agg(F.sum("source_rows").alias("source_rows"),
                                        F.sum("loaded_rows").alias("loaded_rows"),
                                        F.count(F.lit(1)).alias("batches"))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name, fn in list(globals().items()):
        if name.startswith("q_") and callable(fn):
            out[name[2:]] = fn
    return out
