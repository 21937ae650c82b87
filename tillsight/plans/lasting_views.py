"""The star schema as views of the catalog, which outlive the session.

``create_views`` writes ``CREATE OR REPLACE VIEW`` statements over a database of raw
tables, each view after those it reads; ``drop_views`` takes them away in the
opposite order. With a persistent metastore any later session queries them by SQL;
nothing is copied, and Catalyst expands and prunes them like any view. The SQL says
the same as the operators in ``operators.dims``, ``facts`` and ``calendar`` (a test
compares them column by column); labels and rules come from the same mappings.

``raw_tables`` puts the tables of a published load (``sources.snapshots``) into a
database as external tables, so that a database names one version.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tillsight.functions import labels as L
from tillsight.sources.snapshots import Snapshot


@dataclass(frozen=True)
class Vocabulary:
    """Labels and rules of the views; the defaults are the operators'."""

    person_types: Mapping[str, str] = field(default_factory=lambda: L.PERSON_TYPE_LABELS)
    location_types: Mapping[str, str] = field(default_factory=lambda: L.LOCATION_TYPE_LABELS)
    channels: Mapping[str, str] = field(default_factory=lambda: L.CHANNEL_LABELS)
    statuses: Mapping[str, str] = field(default_factory=lambda: L.STATUS_LABELS)
    realised: Iterable[str] = L.REALISED_STATUSES
    actions: Mapping[str, str] = field(default_factory=lambda: L.ACTION_LABELS)
    empty_reasons: Iterable[str] = L.REASON_EMPTY_VALUES
    reason_rules: Sequence[tuple[Sequence[str], str]] = L.REASON_RULES
    reason_default: str = L.REASON_DEFAULT
    unknown: Mapping[str, object] = field(default_factory=lambda: L.UNKNOWN_EMPLOYEE)


def _text(value: object) -> str:
    if isinstance(value, (bool, int)):
        return str(value).upper()
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _label(column: str, mapping: Mapping, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default or column} END"


def _within(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(map(_text, values))})"


def _reason(key: str, words: Vocabulary) -> tuple[str, str]:
    """The category of a key, and whether any rule explains it."""
    empty = _within(key, words.empty_reasons)
    rules = [(" OR ".join(f"contains({key}, {_text(s)})" for s in parts), label) for parts, label in words.reason_rules]
    whens = " ".join(f"WHEN {test} THEN {_text(label)}" for test, label in [(empty, words.reason_default), *rules])
    return f"CASE {whens} ELSE {_text(words.reason_default)} END", " OR ".join([empty, *(test for test, _ in rules)])


def view_statements(columns: Mapping[str, Sequence[str]], raw: str, target: str,
                    words: Vocabulary = Vocabulary()) -> dict[str, str]:
    """The SELECT of each view, a view after those that it reads. ``columns``
    has the columns of the raw tables (some are optional)."""
    def t(name: str) -> str:
        return f"{raw}.{name}"

    def some(table: str, alias: str, *pairs: tuple[str, str]) -> str:
        return "".join(f"{alias}.{c} AS {n}, " for c, n in pairs if c in columns[table])

    reason, explained = _reason("reason_key", words)
    key = r"lower(regexp_replace(trim(coalesce(r.reason, '')), '\\s+', ' '))"
    unknown = words.unknown
    by_item = "order_item_id" in columns["return_items"]
    item_join = f"JOIN {t('order_items')} oi ON oi.id = ri.order_item_id JOIN {t('orders')} o ON o.id = oi.order_id" if by_item \
        else f"JOIN {t('orders')} o ON o.id = ri.order_id"
    return {
        "dim_calendar": f"""
WITH facts AS (SELECT to_date(placed_at) AS d, TRUE AS sale FROM {t('orders')}
               UNION ALL SELECT to_date(created_at), FALSE FROM {t('returns')}),
bounds AS (SELECT min(d) AS lo, max(d) AS hi, min(CASE WHEN sale THEN d END) AS first_sale,
                  max(CASE WHEN sale THEN d END) AS last_sale FROM facts),
days AS (SELECT explode(sequence(lo, hi, INTERVAL 1 DAY)) AS date, first_sale, last_sale FROM bounds)
SELECT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month, day(date) AS day,
       dayofyear(date) AS day_of_year, weekofyear(date) AS week_of_year, weekday(date) + 1 AS iso_weekday,
       {_label('weekday(date) + 1', L.WEEKDAY_NAMES, 'NULL')} AS weekday_name,
       {_label('month(date)', L.MONTH_NAMES, 'NULL')} AS month_name, weekday(date) >= 5 AS is_weekend,
       date BETWEEN first_sale AND last_sale AS in_sales_period, trunc(date, 'month') AS first_day_of_month
FROM days""",
        "dim_customer": f"""
SELECT c.id AS customer_id, coalesce(c.trade_name, c.legal_name) AS customer, c.legal_name, c.person_type,
       {_label('c.person_type', words.person_types)} AS person_type_label, c.tax_id AS document, c.email, c.is_active,
       a.city, a.state, a.postal_code, to_date(c.created_at) AS signup_date
FROM {t('customers')} c LEFT JOIN {t('addresses')} a ON a.customer_id = c.id AND a.is_primary""",
        "dim_product": f"""
SELECT v.id AS variant_id, v.sku, v.barcode_ean AS barcode, v.sale_price, v.cost_price,
       v.sale_price - v.cost_price AS gross_margin, v.weight_kg, v.is_active AS variant_active, p.id AS product_id,
       p.name AS product, p.ncm_code AS ncm, p.unit_of_measure AS unit, p.is_active AS product_active, cat.id AS category_id,
       CASE WHEN cat.name = upper(cat.name) THEN initcap(cat.name) ELSE cat.name END AS category,
       cat.name AS category_original, par.name AS parent_category, b.id AS brand_id, b.name AS brand, b.country AS brand_country
FROM {t('product_variants')} v JOIN {t('products')} p ON p.id = v.product_id
LEFT JOIN {t('categories')} cat ON cat.id = p.category_id LEFT JOIN {t('categories')} par ON par.id = cat.parent_category_id
LEFT JOIN {t('brands')} b ON b.id = p.brand_id""",
        "dim_location": f"""
SELECT id AS location_id, name AS location, location_type AS type, {_label('location_type', words.location_types)} AS type_label,
       city, state, postal_code, is_active FROM {t('locations')}""",
        "dim_employee": f"""
SELECT CAST({unknown['employee_id']} AS BIGINT) AS employee_id, {_text(unknown['employee'])} AS employee, {_text(unknown['role'])} AS role,
       CAST(NULL AS INT) AS location_id, CAST(NULL AS DATE) AS hire_date, {_text(bool(unknown['is_active']))} AS is_active
UNION ALL
SELECT CAST(id AS BIGINT), full_name, role, CAST(primary_location_id AS INT), CAST(hire_date AS DATE), is_active FROM {t('employees')}""",
        "fct_orders": f"""
SELECT o.id AS order_id, o.order_number, to_date(o.placed_at) AS date, o.customer_id, o.location_id,
       CAST(coalesce(o.salesperson_id, {unknown['employee_id']}) AS BIGINT) AS employee_id, o.channel,
       {_label('o.channel', words.channels)} AS channel_label, o.status, {_label('o.status', words.statuses)} AS status_label,
       {_within('o.status', words.realised)} AS is_realised,
       {some('orders', 'o', ('subtotal', 'subtotal'), ('discount_amount', 'discount_amount'))}o.total
FROM {t('orders')} o""",
        # The order's side of an item is what the view of the orders says.
        "fct_order_items": f"""
SELECT {some('order_items', 'i', ('id', 'item_id'), ('line_number', 'line_number'), ('unit_price', 'unit_price'))}i.order_id, o.date,
       o.customer_id, o.location_id, o.employee_id, i.product_variant_id AS variant_id, o.channel, o.status, o.is_realised,
       i.quantity, i.line_total
FROM {t('order_items')} i JOIN {target}.fct_orders o ON o.order_id = i.order_id""",
        "fct_returns": f"""
WITH base AS (
  SELECT {some('return_items', 'ri', ('id', 'return_item_id')) or some('return_items', 'ri', ('line_number', 'line_number'))}
         r.id AS return_id, r.return_number, to_date(r.created_at) AS date, r.customer_id, r.received_at_location_id AS location_id,
         {'oi' if by_item else 'ri'}.product_variant_id AS variant_id, o.id AS order_id, r.status, ri.action, ri.quantity,
         ri.unit_refund_amount AS unit_refund, ri.quantity * ri.unit_refund_amount AS refund_value,
         r.reason AS reason_original, {key} AS reason_key
  FROM {t('return_items')} ri JOIN {t('returns')} r ON r.id = ri.return_id {item_join}),
said AS (SELECT *, {_label('action', words.actions)} AS action_label, {reason} AS reason FROM base)
SELECT *, NOT (reason_original <=> reason) AS reason_changed, {explained} AS reason_matched FROM said""",
    }


RAW = ("orders", "order_items", "product_variants", "products", "categories", "brands", "customers", "addresses",
       "locations", "employees", "returns", "return_items")


def raw_tables(spark: SparkSession, held: Snapshot, database: str) -> list[str]:
    """The tables of one published version as external tables of ``database``
    (made if it is absent), in place of those of an earlier version."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in held.tables:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=held.entries[name]["path"], source="parquet")
    return held.tables


def create_views(spark: SparkSession, raw: str, target: str, words: Vocabulary = Vocabulary()) -> list[str]:
    """Create or replace the eight views in database ``target`` over the raw
    tables of database ``raw``; their names in the order of creation."""
    columns = {t: spark.table(f"{raw}.{t}").columns for t in RAW}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    statements = view_statements(columns, raw, target, words)
    for name, select in statements.items():
        spark.sql(f"CREATE OR REPLACE VIEW {target}.{name} AS {select}")
    return list(statements)


def drop_views(spark: SparkSession, target: str) -> None:
    """Drop the views, those that read others first."""
    for name in reversed(list(view_statements({t: () for t in RAW}, "raw", target))):
        spark.sql(f"DROP VIEW IF EXISTS {target}.{name}")
