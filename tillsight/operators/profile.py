"""Table profiling and data-quality panels.

Every operator is one or two aggregates over the table: partial aggregation
runs per partition, so the shuffle carries one row per partition (per group
for grouped panels), never the rows themselves.

Quartiles are PostgreSQL's ``percentile_cont``. ``method="exact"`` (default)
uses the distributed exact algorithm of ``tillsight.operators.quantiles``;
``"single"`` is Spark's built-in ``percentile`` (exact, but every distinct
value meets in one task: fine for small domains); ``"approx"`` is
``percentile_approx`` (bounded sketch, relative rank error 1/accuracy).
Exact quantiles enter the result as literals, the others as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import mean_half_up, pct_half_up
from tillsight.operators.quantiles import exact_quantiles


def quantile_columns(df: DataFrame, col: str, probs: Sequence[float], method: str = "exact",
                     accuracy: int = 10000) -> list[Column]:
    """Columns holding the continuous quantiles of ``col`` (one value each)."""
    if method == "exact":
        # A handful of numbers, computed once; as literals they keep the plans
        # that use them small.
        row = exact_quantiles(df, col, probs).first()
        return [F.lit(row[f"q{i}"]).cast("double") for i in range(len(probs))]
    x = F.col(col).cast("double")
    if method == "approx":
        arr = df.select(F.percentile_approx(x, list(probs), accuracy).alias("a"))
    elif method == "single":
        arr = df.select(F.percentile(x, F.array(*[F.lit(p) for p in probs])).alias("a"))
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    one = arr.select("a").scalar()
    return [one[i] for i in range(len(probs))]


def table_overview(df: DataFrame, ts_col: str) -> DataFrame:
    """U16: rows, columns (from the schema) and the time range of one column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.min(ts_col).alias("min_ts"),
        F.max(ts_col).alias("max_ts"),
    )


def numeric_distribution(df: DataFrame, col: str, method: str = "exact",
                         accuracy: int = 10000) -> DataFrame:
    """Min, max, rounded mean, Q1, median, Q3, rounded sample stddev.

    ``col`` is exact money (DECIMAL); the mean is rounded half-up exactly.
    """
    c = F.col(col)
    q1, med, q3 = quantile_columns(df, col, (0.25, 0.5, 0.75), method, accuracy)
    agg = df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"),
                 F.sum(c).alias("_sum"), F.count(c).alias("_n"),
                 F.stddev_samp(c.cast("double")).alias("_sd"))
    return agg.select(
        "min_value", "max_value",
        mean_half_up(F.col("_sum"), F.col("_n")).alias("mean_value"),
        q1.alias("q1"), med.alias("median"), q3.alias("q3"),
        F.round(F.col("_sd"), 2).alias("stddev"),
    )


# SQL names of the Spark types whose names differ (fixed values).
SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct values of every column: ``ordinal, distinct_count``
    (nulls apart).

    Each column is a branch of its own, so a columnar source is read once in all,
    and one shuffle carries (column, 64-bit hash) combined in each task, however
    long the values are. A second hash tells apart values that share the first
    one; where any do, they are counted by value.
    """
    hashed = None
    for i, f in enumerate(df.schema.fields):
        v = F.col("`" + f.name.replace("`", "``") + "`")
        own = df.filter(v.isNotNull()).select(F.lit(i + 1).alias("ordinal"), F.xxhash64(v).alias("h"),
                                              F.xxhash64(F.lit(i), v, F.lit(1)).alias("g"))
        hashed = own if hashed is None else hashed.unionAll(own)
    cells = hashed.groupBy("ordinal", "h").agg(F.min("g").alias("g0"), F.max("g").alias("g1"))
    once = cells.groupBy("ordinal").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("g0") != F.col("g1")).alias("shared"))
    rows = once.collect()
    shared = [r["ordinal"] for r in rows if r["shared"]]
    counts = {r["ordinal"]: r["n"] for r in rows}
    if shared:
        columns = [df.schema.fields[i - 1].name for i in shared]
        by_value = df.agg(*[F.count_distinct(F.col("`" + c.replace("`", "``") + "`")) for c in columns]).first()
        counts |= dict(zip(shared, by_value))
    return df.sparkSession.createDataFrame([(i + 1, counts.get(i + 1, 0)) for i in range(len(df.columns))],
                                           "ordinal int, distinct_count long")


def column_profile(df: DataFrame, distinct: str | None = "exact", error: float = 0.02) -> DataFrame:
    """Ordinal, name, SQL type, row count, null count, observed nullability
    and distinct values of every column. ``distinct``: ``exact``
    (``distinct_counts``), ``approx`` (a mergeable sketch a column in the same
    aggregate as the other counts, relative standard error ``error``) or None."""
    if distinct not in ("exact", "approx", None):
        raise ValueError(f"unknown way {distinct!r} to count distinct values")
    fields = df.schema.fields
    col = lambda f: F.col("`" + f.name.replace("`", "``") + "`")
    sketches = [F.approx_count_distinct(col(f), error).alias(f"d{i}") for i, f in enumerate(fields)] if distinct == "approx" else []
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(col(f)).alias(f"n{i}") for i, f in enumerate(fields)], *sketches)
    rows = F.array(*[F.struct(
        F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column"),
        F.lit(SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())).alias("data_type"),
        F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
        (F.col("rows") > F.col(f"n{i}")).alias("nullable"),
        (F.col(f"d{i}") if sketches else F.lit(None).cast("long")).alias("distinct_count"))
        for i, f in enumerate(fields)])
    out = one.select(F.explode(rows).alias("c")).select("c.*")
    if distinct != "exact":
        return out
    return out.drop("distinct_count").join(distinct_counts(df), "ordinal").select(*out.columns)


def null_pattern(df: DataFrame, group_col: str, col: str) -> DataFrame:
    """Rows, non-null, null and % null of ``col`` per group."""
    g = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("rows"),
                                  F.count(col).alias("non_null"))
    return g.select(
        group_col, "rows", "non_null",
        (F.col("rows") - F.col("non_null")).alias("nulls"),
        pct_half_up(F.col("rows") - F.col("non_null"), F.col("rows")).alias("pct_null"),
    ).orderBy(F.col(group_col).asc_nulls_last())


def share_of_total(df: DataFrame, group_col: str, value_col: str,
                   value_scale: int = 2) -> DataFrame:
    """Count, sum, % of rows and % of value per group.

    The grand totals are scalar subqueries over the grouped rows (summed
    per partition, then once), not a window over them, so no step gathers
    all groups into one partition, nothing is joined and the source is not
    scanned again.
    """
    g = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(value_col).alias("value_sum"))
    all_rows = g.select(F.sum("rows")).scalar()
    all_value = g.select(F.sum("value_sum")).scalar()
    return g.select(
        group_col, "rows", "value_sum",
        pct_half_up(F.col("rows"), all_rows).alias("pct_rows"),
        pct_half_up(F.col("value_sum"), all_value, in_scale=value_scale).alias("pct_value"),
    ).orderBy(F.col("value_sum").desc_nulls_first())


def yearly_future(df: DataFrame, ts_col: str, as_of: date | str | None = None) -> DataFrame:
    """Rows per year and rows dated after ``as_of`` (midnight of that
    day, so later rows of the same day count as future). ``as_of`` defaults
    to the current date."""
    ref = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    ts = F.col(ts_col)
    return df.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ts > ref.cast("timestamp_ntz")).alias("future_rows"),
    ).orderBy(F.col("year").asc_nulls_last())


def order_checks() -> dict[str, Column]:
    """The reference's defect hypotheses on an order table."""
    c = F.col
    return {
        "total_non_positive": c("total") <= 0,
        "discount_gt_subtotal": c("discount_amount") > c("subtotal"),
        "arithmetic_broken": c("total") != c("subtotal") - c("discount_amount"),
        "updated_before_created": c("updated_at") < c("created_at"),
        "placed_equals_created": c("placed_at") == c("created_at"),
    }


def integrity_panel(df: DataFrame, unique_keys: Mapping[str, Sequence[str]],
                    checks: Mapping[str, Column]) -> DataFrame:
    """One row of defect counts. ``unique_keys`` maps an output name to
    the columns that should be unique (count minus exact distinct count);
    ``checks`` maps an output name to a predicate counted where it is true."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, cols in unique_keys.items():
        # Several columns are counted as one row value (a struct), as SQL's
        # COUNT(DISTINCT (a, b)) does: a row with a null field still counts.
        key = F.col(cols[0]) if len(cols) == 1 else F.struct(*[F.col(x) for x in cols])
        aggs.append((F.count(F.lit(1)) - F.count_distinct(key)).alias(name))
    for name, pred in checks.items():
        aggs.append(F.count_if(pred).alias(name))
    return df.agg(*aggs)


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, method: str = "exact",
                 accuracy: int = 10000) -> DataFrame:
    """Quartiles, IQR, Tukey fences and the number of rows outside.

    The quartiles are computed first; the outlier count is a second, purely
    map-side aggregate over the column.
    """
    q1, q3 = quantile_columns(df, col, (0.25, 0.75), method, accuracy)
    iqr = q3 - q1
    lower, upper = q1 - F.lit(k) * iqr, q3 + F.lit(k) * iqr
    x = F.col(col).cast("double")
    counted = df.agg(F.count_if((x > upper) | (x < lower)).alias("outliers"))
    return counted.select(q1.alias("q1"), q3.alias("q3"), iqr.alias("iqr"),
                          lower.alias("lower_fence"), upper.alias("upper_fence"), "outliers")
