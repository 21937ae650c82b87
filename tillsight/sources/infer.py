"""Full-scan type inference, key candidates and the schema catalog.

Every non-empty value of every column is tested (no sampling). The rules:

* a type survives when it accepts every non-empty value; empties never
  eliminate a type, they only make the column nullable;
* precedence BOOLEAN > INTEGER > NUMERIC > TIMESTAMP > DATE, else TEXT;
* INTEGER becomes BIGINT above 2,147,483,647 in magnitude and DECIMAL(p,0)
  beyond 64 bits (the latter is a deliberate fix: a 20-digit integer does not
  fit a BIGINT);
* NUMERIC(p, s) takes p = widest integer part + widest fraction, s = widest
  fraction; beyond 38 digits the column is TEXT and the catalog says why;
* a date or time stamp in year 0 is none;
* names matching the identifier pattern stay TEXT; a column with no value at
  all is TEXT;
* a column named ``id`` (any case) is a key candidate when it has no empty
  value, at least one value, and no duplicate (exact distinct count).

The scan is one job for all tables. Every value gets the bit of its class, and a
column's state is the union of those bits, the widest parts of its numbers and two
counts: an aggregate of a few plain buffers that shuffles one row a task. Each column
is a branch of its own with the same expressions (built, compiled and generated
once), so a columnar source is read once in all. Only the exact distinct count of
columns called ``id`` moves values, in a branch of its own. The rules are then applied
to the states on the driver (a handful of numbers a column).
Digits are ASCII only (Python's ``\\d`` would also take other Unicode digits).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.labels import IDENTIFIER_PATTERN

# --- fixed values: accepted spellings and formats ---------------------------
BOOLEAN_WORDS = ("TRUE", "FALSE", "T", "F")
INTEGER_LIMIT = 2_147_483_647
BIGINT_LIMIT = 9_223_372_036_854_775_807
# Parts accepted by Python's strptime for %Y-%m-%d and %H:%M:%S.
_Y = r"(?!0000)[0-9]{4}"
_M = r"(1[0-2]|0[1-9]|[1-9])"
_D = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_H = r"(2[0-3]|[01][0-9]|[0-9])"
_MI = r"([0-5][0-9]|[0-9])"
_S = r"([0-5][0-9]|[0-9])"
# --- end of fixed values ----------------------------------------------------

DATE_RE = f"^{_Y}-{_M}-{_D}$"
TIMESTAMP_RE = f"^{_Y}-{_M}-{_D}\\s+{_H}:{_MI}:{_S}$"
INT_RE = r"^[+-]?[0-9]+$"
DEC_RE = r"^[+-]?[0-9]+\.[0-9]+$"


def _no_leading_zero(digits: Column) -> Column:
    return ~((F.length(digits) > 1) & digits.startswith("0"))


_DIGITS = "0123456789"


def _unsigned(v: Column) -> Column:
    """The value without one leading sign."""
    return F.when(v.startswith("+") | v.startswith("-"), v.substr(F.lit(2), F.length(v))) \
        .otherwise(v)


def is_boolean(v: Column) -> Column:
    return (F.length(v) <= 5) & F.upper(v).isin(list(BOOLEAN_WORDS))


def is_integer(v: Column) -> Column:
    """``[+-]?[0-9]+`` without a leading zero (``0`` itself is fine).

    Written with ``translate`` (delete the ASCII digits, nothing may remain)
    instead of a regex: same language, several times cheaper per value."""
    u = _unsigned(v)
    return (F.length(u) > 0) & (F.translate(u, _DIGITS, "") == "") & _no_leading_zero(u)


def is_decimal(v: Column) -> Column:
    """``[+-]?[0-9]+\\.[0-9]+`` whose integer part has no leading zero."""
    u = _unsigned(v)
    int_part = F.substring_index(u, ".", 1)
    frac = F.substring_index(u, ".", -1)
    return ((F.translate(u, _DIGITS, "") == ".") & (F.length(int_part) > 0)
            & (F.length(frac) > 0) & _no_leading_zero(int_part))


def is_numeric(v: Column) -> Column:
    return is_integer(v) | is_decimal(v)


def _valid_date(text: Column) -> Column:
    return F.try_to_date(F.regexp_replace(text, " ", ""), "yyyy-M-d").isNotNull()


def is_date(v: Column) -> Column:
    """Shape of ``%Y-%m-%d`` (unpadded parts allowed) and a real calendar day.
    Cheap length and separator tests run first; the regex and the calendar
    check only see plausible values."""
    return ((F.length(v) >= 8) & (F.length(v) <= 10) & (v.substr(5, 1) == "-")
            & v.rlike(DATE_RE) & _valid_date(v))


def is_timestamp(v: Column) -> Column:
    """Shape of ``%Y-%m-%d %H:%M:%S`` (any whitespace run between date and
    time, seconds 0-59, no fraction) and a real calendar day."""
    date_part = F.regexp_extract(v, r"^([0-9]{4}-[0-9]{1,2}- ?[0-9]{1,2})", 1)
    return ((F.length(v) >= 12) & (v.substr(5, 1) == "-")
            & v.rlike(TIMESTAMP_RE) & _valid_date(date_part))


def value_class(v: Column) -> Column:
    """What a filled value looks like: integer ``i``, decimal ``d``, date ``t``,
    time stamp ``s``, boolean ``b``, else ``x``. The shapes exclude each other,
    so the tests stop at the first that fits."""
    return (F.when(is_integer(v), "i").when(is_decimal(v), "d").when(is_date(v), "t")
            .when(is_timestamp(v), "s").when(is_boolean(v), "b").otherwise("x"))


def _without_digits(body: Column) -> Column:
    """What an unsigned value holds besides digits; none if it doesn't begin with one."""
    return F.when((body >= "0") & (body < ":"), F.translate(body, _DIGITS, ""))


def _class_of(v: Column, body: Column, rest: Column) -> Column:
    """``value_class`` from the value, unsigned, and its ``_without_digits``."""
    whole, frac = F.substring_index(body, ".", 1), F.substring_index(body, ".", -1)
    decimal = (rest == ".") & (F.length(whole) > 0) & (F.length(frac) > 0) & _no_leading_zero(whole)
    return (F.when((rest == "") & _no_leading_zero(body), "i").when(decimal, "d").when(is_date(v), "t")
            .when(is_timestamp(v), "s").when(is_boolean(v), "b").otherwise("x"))


# A value's class as a bit; integers by the width they need.
_BITS = {"i": 1, "i64": 2, "wide": 4, "d": 8, "t": 16, "s": 32, "b": 64, "x": 128}
_INTEGER = _BITS["i"] | _BITS["i64"] | _BITS["wide"]


def _above(digits: Column, limit: int) -> Column:
    """Whether digits without leading zeros say more than ``limit``."""
    n = len(str(limit))
    return (F.length(digits) > n) | ((F.length(digits) == n) & (digits > F.lit(str(limit))))


def _state() -> tuple[list[list[Column]], list[Column]]:
    """For a column ``v``: each value's class and digits in three steps, so that
    each is worked out once, and the aggregates over them: rows, filled values, classes met, widest integer part and fraction."""
    v, body, k = F.col("v"), F.col("body"), F.col("k")
    bit = (F.when(k == "i", F.when(_above(body, BIGINT_LIMIT), _BITS["wide"]).when(_above(body, INTEGER_LIMIT), _BITS["i64"])
                  .otherwise(_BITS["i"]))
           .when(k == "d", _BITS["d"]).when(k == "t", _BITS["t"]).when(k == "s", _BITS["s"]).when(k == "b", _BITS["b"])
           .when(k.isNotNull(), _BITS["x"]))
    return ([[v, _unsigned(v).alias("body")], [v, body, _without_digits(body).alias("rest")],
             [F.when(v != "", _class_of(v, body, F.col("rest"))).alias("k"), body]],
            [F.count(F.lit(1)).alias("n_rows"), F.count("k").alias("filled"), F.bit_or(bit).alias("bits"),
             F.max(F.when(k.isin("i", "d"), F.length(F.substring_index(body, ".", 1)))).alias("int"),
             F.max(F.when(k == "d", F.length(F.substring_index(body, ".", -1)))).alias("frac")])


def _states(df: DataFrame, table: str, state: tuple[list[list[Column]], list[Column]]) -> DataFrame:
    """One row a column: ``table, ordinal, n_rows, filled, bits, int, frac``; and
    a row with ``ids`` for each column called id."""
    none = F.lit(None)
    out = None
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`").cast("string").alias("v")
        here = [F.lit(table).alias("table"), F.lit(i + 1).alias("ordinal")]
        part = df.select(v).select(*state[0][0]).select(*state[0][1]).select(*state[0][2]).agg(*state[1]).select(*here, "n_rows", "filled", "bits", "int", "frac",
                                                                   none.cast("long").alias("ids"))
        out = part if out is None else out.unionAll(part)
        if c.lower() == "id":
            ids = df.select(v).filter("v != ''").groupBy("v").count().agg(F.count(F.lit(1)).alias("ids"))
            out = out.unionAll(ids.select(*here, *(none.cast(t) for t in ("long", "long", "int", "int", "int")), "ids"))
    return out


def _types(bits: int, int_digits: int, frac_digits: int, named_identifier: bool) -> tuple[str, str, str | None]:
    """SQL type, Spark type and reason from what a column's values are."""
    whole = bits and not bits & ~_INTEGER
    number = bits and not bits & ~(_INTEGER | _BITS["d"])
    precision = int_digits + frac_digits
    if named_identifier or not bits:
        return "TEXT", "string", None
    if bits == _BITS["b"]:
        return "BOOLEAN", "boolean", None
    if number and precision > 38:  # no type of SQL or Spark holds more
        return "TEXT", "string", "numbers of more than 38 digits"
    if whole and (int_digits > 19 or bits & _BITS["wide"]):
        return f"DECIMAL({int_digits}, 0)", f"decimal({int_digits},0)", None
    if whole:
        return ("BIGINT", "bigint", None) if bits & _BITS["i64"] else ("INTEGER", "int", None)
    if number:
        return f"NUMERIC({precision}, {frac_digits})", f"decimal({precision},{frac_digits})", None
    if bits == _BITS["s"]:
        return "TIMESTAMP", "timestamp_ntz", None
    if bits == _BITS["t"]:
        return "DATE", "date", None
    return "TEXT", "string", None


CATALOG = ("table string, ordinal int, column string, sql_type string, spark_type string, nullable boolean, is_key boolean, "
           "n_rows long, reason string")


def infer_schema(tables: Mapping[str, DataFrame],
                 identifier_pattern: str = IDENTIFIER_PATTERN) -> DataFrame:
    """The catalog of several all-text tables (null and '' both mean empty),
    sorted by table name: ``table, ordinal, column, sql_type, spark_type, nullable,
    is_key, n_rows, reason``. ``reason`` says why values that fit a narrower type
    are TEXT. Computed here, in one job; a header-only table lists every column
    (TEXT, not null, no key)."""
    if not tables:
        raise ValueError("no tables to infer")
    names = sorted(tables, key=str.lower)
    state, states = _state(), None
    for i, name in enumerate(names):
        part = _states(tables[name], str(i), state)
        states = part if states is None else states.unionAll(part)
    found = states.collect()
    ids = {(r["table"], r["ordinal"]): r["ids"] for r in found if r["ids"] is not None}
    by_column = {(r["table"], r["ordinal"]): r for r in found if r["ids"] is None}
    rows = []
    for i, name in enumerate(names):
        for k, column in enumerate(tables[name].columns, start=1):
            s = by_column[str(i), k]
            identifier = re.search(identifier_pattern, column.lower()) is not None
            types = _types(s["bits"] or 0, s["int"] or 0, s["frac"] or 0, identifier)
            is_key = column.lower() == "id" and 0 < s["filled"] == s["n_rows"] == ids[str(i), k]
            rows.append((name.lower(), k, column, *types[:2], s["n_rows"] > s["filled"], is_key, s["n_rows"], types[2]))
    return tables[names[0]].sparkSession.createDataFrame(rows, CATALOG)


def infer_table(df: DataFrame, table: str, identifier_pattern: str = IDENTIFIER_PATTERN) -> DataFrame:
    """Catalog rows of one all-text table (``infer_schema``)."""
    return infer_schema({table: df}, identifier_pattern)


def key_candidates(catalog: DataFrame) -> DataFrame:
    """Columns called ``id`` and whether the data proves them a key."""
    return catalog.filter(F.lower(F.col("column")) == "id").select(
        "table", "column", "is_key", "nullable", "n_rows")


def struct_from_catalog(catalog: DataFrame, table: str) -> T.StructType:
    """The Spark schema of one table from its catalog rows (one row per
    column is brought to the driver). A header-only table has every column
    TEXT and not null, as in the reference."""
    rows = (catalog.filter(F.col("table") == table.lower())
            .select("ordinal", "column", "spark_type", "nullable").orderBy("ordinal").collect())
    return T.StructType([T.StructField(r["column"], spark_type_of(r["spark_type"]),
                                       bool(r["nullable"])) for r in rows])


_SIMPLE_TYPES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(),
                 "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(),
                 "string": T.StringType()}


def spark_type_of(name: str) -> T.DataType:
    """Type object for the names the catalog emits."""
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE_TYPES[name]
