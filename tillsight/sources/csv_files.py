"""U04 and the CSV dialect: RFC-4180 files with a header row.

Dialect choices (SURVEY §2.13): quotes are escaped by doubling (``escape='"'``,
Spark's default backslash would corrupt such values); a quoted empty field
``""`` stays an empty string while an unquoted empty field is NULL (Spark
reads both as NULL unless ``emptyValue`` is set to a sentinel, which is then
mapped back to ''); everything is read as text and typed later, because
Spark's own inference turns ``007`` into 7 and ``T`` into null.
Spark's splittable CSV reader cuts records at every line break, quoted or not.
``scan_records`` therefore reads a file as plain lines, block by block in many
tasks, and finds the records itself: whether the quotes before a line are balanced
says whether a record begins there. A prefix sum over the blocks (one row a block)
carries that parity and the record numbers across them. Lines that share a record
are joined again, and each record is parsed by ``from_csv``. A file of any size with
line breaks inside quotes is so read in parallel, and every record has the number
that a user counts in an editor (the header is record 1).

A blank line is an error for Python's csv reader (a record with zero fields);
Spark skips it, so it is counted from the text and makes a file invalid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.session import side_by_side, stage

# Marks a quoted empty field while reading; mapped back to ''.
EMPTY_SENTINEL = "\u0000\u0001"


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("encoding", "UTF-8")
            .option("emptyValue", EMPTY_SENTINEL))


def list_csv(spark: SparkSession, directory: str) -> list[str]:
    """Sorted paths of the ``*.csv`` files of a directory (file listing only,
    contents are not read)."""
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .load(directory).select("path").collect())
    return sorted(r["path"] for r in rows)


def table_name(path: str) -> str:
    """``.../Orders.csv`` -> ``orders`` (lower case for every step)."""
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return (base[:-4] if base.lower().endswith(".csv") else base).lower()


def header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the header row; error for a file with no header."""
    cols = _reader(spark, False).csv(path).columns
    if not cols:
        raise ValueError(f"{path}: empty file, no header")
    return cols


def _without_return(c: str) -> Column:
    """The line without carriage returns at its end; most have none."""
    return F.when(F.contains(F.col(c), F.lit("\r")), F.regexp_replace(c, "\r$", "")).otherwise(F.col(c))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, the block of it that a task reads, and a number
    that grows by one within a block."""
    text = _without_return("value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
        F.when(F.contains("value", F.lit('"')), quotes % 2).otherwise(0).alias("odd"),
        (F.trim(text) == "").cast("int").alias("blank"))


def _before(col: str, *order: str, within: str | None = None) -> Column:
    w = (Window.partitionBy(within) if within else Window).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(w), F.lit(0))


@dataclass
class CsvRecords:
    """The records of a CSV file or a folder of them."""

    frame: DataFrame  # file, number (header 1), ordinal (over all files, one header), blank, n_lines, record
    source_records: int  # without headers and blank lines
    blank_lines: int
    line_breaks: int  # inside quotes
    open_files: int  # files that end inside quotes


def scan_records(spark: SparkSession, path: str | list[str]) -> CsvRecords:
    """Find the records of the lines under ``path`` (or several).

    Only files with an unbalanced line need a running count of quotes, by a sort
    within their blocks; for the others the place in the block is the number. Only
    lines of records over several lines are gathered by record.
    """
    # Kept, so that every later step sees the same blocks, whatever executors come or go.
    lines = stage(_lines(spark, path), "csv-lines")
    whole = stage(lines.groupBy("file", "block").agg(
        F.count("*").alias("c0"), F.min("at").alias("first"), F.sum("odd").alias("odds"),
        F.max("odd").alias("any_odd"), F.sum("blank").alias("b0")), "csv-blocks")
    seen = whole.agg(F.sum("c0").alias("lines"), F.sum("b0").alias("blanks"), F.max("any_odd").alias("any_odd"),
                     F.count_distinct("file").alias("files")).first()
    zero = F.lit(0).cast("long")
    if not seen["any_odd"]:
        own = _numbered(whole.withColumn("c1", zero).withColumn("b1", zero))
        n, blanks = seen["lines"] or 0, seen["blanks"] or 0
        return CsvRecords(_in_place(lines, own), n - blanks - seen["files"], blanks, 0, 0)
    broken = stage(whole.groupBy("file").agg(F.max("any_odd").alias("odd")).filter("odd = 1").select("file"), "csv-broken")
    running = Window.partitionBy("file", "block").orderBy("at")
    odd = F.coalesce(F.sum("odd").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    so_far = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.join(broken, "file", "left_semi").withColumn("odd_before", odd)
    marked = stage(marked.withColumn("k0", F.sum(1 - F.col("odd_before")).over(so_far))
                   .withColumn("k1", F.sum("odd_before").over(so_far)), "csv-lines")
    columns = ["file", "block", "first", "odds", "c0", "c1", "b0", "b1"]
    even = whole.join(broken, "file", "left_anti").withColumn("c1", zero).withColumn("b1", zero).select(*columns)
    blocks = even.unionByName(marked.groupBy("file", "block").agg(
        F.min("at").alias("first"), F.sum("odd").alias("odds"), F.max("k0").alias("c0"), F.max("k1").alias("c1"),
        F.sum(F.col("blank") * (1 - F.col("odd_before"))).alias("b0"),
        F.sum(F.col("blank") * F.col("odd_before")).alias("b1")))
    own = stage(_numbered(blocks), "csv-blocks")
    sums = own.agg(F.sum("starts").alias("starts"), F.sum("blanks").alias("blanks"), F.count_distinct(
        F.when(F.col("odd_file") == 1, F.col("file"))).alias("open")).first()
    frame = _in_place(lines.join(broken, "file", "left_anti"), own)
    number = F.col("before") + F.when(F.col("inside") == 0, F.col("k0")).otherwise(F.col("k1"))
    part = marked.join(own, ["file", "block"]).withColumn("within", (F.col("inside") + F.col("odd_before")) % 2) \
        .select("file", number.alias("number"), (F.col("others") + number).alias("ordinal"), "block", "at", "value", "blank", "odd", "within")
    text = _without_return("value").alias("record")
    alone = (F.col("within") == 0) & (F.col("odd") == 0)
    frame = frame.unionAll(part.filter(alone).select(
        "file", "number", "ordinal", (F.col("blank") == 1).alias("blank"), F.lit(1).alias("n_lines"), text))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    frame = frame.unionAll(part.filter(~alone).groupBy("file", "number", "ordinal")
                           .agg(joined.alias("value"), F.count("*").cast("int").alias("n_lines"))
                           .select("file", "number", "ordinal", F.lit(False).alias("blank"), "n_lines", text))
    n, blanks = sums["starts"], sums["blanks"]
    return CsvRecords(frame, n - blanks - seen["files"], blanks, seen["lines"] - n, sums["open"])


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with what lies before them: quotes (``inside``), records in the
    file (``before``) and in the files before it (``others``, headers left out)."""
    inside = F.col("inside")
    return blocks.withColumn("inside", _before("odds", "block", within="file") % 2) \
        .withColumn("odd_file", F.sum("odds").over(Window.partitionBy("file")) % 2) \
        .withColumn("starts", F.when(inside == 0, F.col("c0")).otherwise(F.col("c1"))) \
        .withColumn("blanks", F.when(inside == 0, F.col("b0")).otherwise(F.col("b1"))) \
        .withColumn("before", _before("starts", "block", within="file")) \
        .withColumn("others", _before("starts", "file", "block") - F.col("before")
                    - (F.dense_rank().over(Window.orderBy("file")) - 1)) \
        .select("file", "block", "first", "inside", "odd_file", "starts", "blanks", "before", "others")


def _in_place(lines: DataFrame, own: DataFrame) -> DataFrame:
    """Records of files where every line is one: a line's place in its block."""
    number = F.col("before") + F.col("at") - F.col("first") + 1
    return lines.join(own, ["file", "block"]).select(
        "file", number.alias("number"), (F.col("others") + number).alias("ordinal"), (F.col("blank") == 1).alias("blank"),
        F.lit(1).alias("n_lines"), _without_return("value").alias("record"))


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``source_records`` (without headers and blank lines),
    ``blank_lines`` and ``line_breaks`` (inside quotes) under ``path``."""
    r = scan_records(spark, path)
    return spark.createDataFrame([(r.source_records, r.blank_lines, r.line_breaks)],
                                 "source_records long, blank_lines long, line_breaks long")


@dataclass
class StagedCsv:
    """One table's CSV, parsed once and kept as a table of the shared folder:
    ``file, number, ordinal, blank, n_lines, record`` (of bad ones), ``s`` (the
    fields c0, c1, ...) and ``bad``."""

    table: str
    path: str
    columns: list[str]
    frame: DataFrame
    records: CsvRecords

    def text(self, *more: str) -> DataFrame:
        """All-text frame of the good records; quoted empties are '', others
        NULL. ``more`` names columns of ``frame`` to come first."""
        good = self.frame.filter(~F.col("blank") & ~F.col("bad"))
        return good.select(*more, *[v.alias(c) for c, v in zip(self.columns, self.values())])

    def values(self) -> list[Column]:
        """The fields as text."""
        return [F.when(F.col(f"s.c{i}") == EMPTY_SENTINEL, F.lit("")).otherwise(F.col(f"s.c{i}")) for i in range(len(self.columns))]


def stage_csv(spark: SparkSession, path: str | list[str], table: str | None = None) -> StagedCsv:
    """Parse the records under ``path`` (or several) once. A record is bad when its field
    count differs from the header's, or when the parser doesn't find all its
    line breaks inside fields (a stray quote joined lines that are records).

    A record without a quote is cut at its commas, if that gives as many fields as
    the header has; the parser reads all others."""
    columns = header(spark, path)
    found = scan_records(spark, path)
    fields = [f"c{i}" for i in range(len(columns))]
    read = F.from_csv(
        "record", ", ".join(f"{c} string" for c in [*fields, "_corrupt"]),
        {"quote": '"', "escape": '"', "emptyValue": EMPTY_SENTINEL, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    special = [F.contains("record", F.lit(x)) for x in ('"', "\r", "\n", "\0")]
    plain = ~(F.col("blank") | special[0] | special[1] | special[2] | special[3])
    cut = [F.get("cut", F.lit(i)) for i in range(len(fields))]
    cut = [F.when(x != "", x).alias(c) for c, x in zip(fields, cut)] + [F.lit(None).cast("string").alias("_corrupt")]
    parsed = found.frame.withColumn("cut", F.when(plain, F.split("record", ",", -1))) \
        .withColumn("s", F.when(F.col("cut").isNotNull() & (F.size("cut") == len(fields)), F.struct(*cut)).otherwise(read)).drop("cut")
    breaks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))
    kept = sum((F.coalesce(breaks(F.col(f"s.{c}")), F.lit(0)) for c in fields), F.lit(0))
    bad = F.col("s._corrupt").isNotNull() | F.col("s").isNull() | ((F.col("n_lines") > 1) & (kept < F.col("n_lines") - 1))
    # Two steps, so that the parser sees every field whatever is read later.
    rows = stage(parsed.withColumn("bad", F.coalesce(bad, F.lit(True)))
                 .withColumn("record", F.when((F.col("number") == 1) | F.col("bad"), F.col("record"))), "csv-parsed")
    heads = [r["record"] for r in rows.filter("number = 1").select("record").distinct().limit(2).collect()]
    if len(heads) > 1:
        raise ValueError(f"{path}: files with different headers")
    return StagedCsv(table or table_name(path), path, columns, rows.filter("number > 1"), found)


def read_text_table(spark: SparkSession, path: str, columns: list[str] | None = None,
                    multi_line: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """All-text frame of one CSV file; columns are matched to the header by
    name (``enforceSchema=False``). Ragged records fail any action that
    parses every field (a load does); a bare ``count()`` parses none, so use
    ``validate_csv`` to count offenders. ``multi_line`` is needed for files with
    line breaks inside quotes (``scan_lines`` tells)."""
    cols = columns or header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    df = (_reader(spark, multi_line).schema(schema).option("enforceSchema", False)
          .option("mode", mode).csv(path))
    return df.select(*[F.when(F.col(f"`{c}`") == EMPTY_SENTINEL, F.lit(""))
                       .otherwise(F.col(f"`{c}`")).alias(c) for c in cols])


def fingerprint(df: DataFrame, where: Column | None = None) -> Column:
    """Aggregate: a digest of the rows (``where`` holds) as a multiset, whatever
    their order. Two sums of 64-bit record hashes (nulls have a place of their own)
    and the count; unlike an exclusive or, equal rows don't cancel each other."""
    return row_digest([F.col("`" + c.replace("`", "``") + "`") for c in df.columns], where)


def row_digest(columns: list[Column], where: Column | None = None) -> Column:
    cells = [x for c in columns for x in (c.isNull(), c)]
    where = F.lit(True) if where is None else where
    low = F.lit((1 << 21) - 1).cast("long")

    def total(seed: int) -> Column:
        # The hash in three parts, so that whole numbers add up without overflow.
        h = F.when(where, F.xxhash64(F.lit(seed), *cells))
        parts = [(42, F.shiftright(h, 42)), (21, F.shiftright(h, 21).bitwiseAND(low)), (0, h.bitwiseAND(low))]
        return sum((F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,0)") * F.lit(1 << k).cast("decimal(14,0)") for k, x in parts),
                   F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string")

    return F.concat_ws(":", F.count_if(where).cast("string"), total(1), total(2))


def validation_of(staged: StagedCsv) -> dict:
    """The line of ``validate_csv`` for one table: one job over its records, and
    one over the bad ones if there are any."""
    c, found = F.col, staged.records
    bad = c("bad") & ~c("blank")
    rep = staged.frame.agg(
        F.count_if(~c("blank")).alias("records"), F.count_if(bad).alias("ragged"),
        F.count_if(c("bad") | c("blank")).alias("odd"),
        row_digest(staged.values(), ~c("bad") & ~c("blank")).alias("content")).first()
    status = ("open_quote" if found.open_files else "ragged" if rep["ragged"] else "blank_lines" if found.blank_lines else
              "divergent" if rep["records"] != found.source_records else "ok")
    worst = None
    if rep["odd"]:
        worst = staged.frame.filter(c("bad") | c("blank")).agg(
            F.min(F.when(bad, c("record"))).alias("example"), F.min(F.struct("ordinal", "file", "number")).alias("first")).first()
    first = worst["first"] if worst else (None, None, None)
    return {"table": staged.table, "path": str(staged.path), "header_fields": len(staged.columns),
            "source_records": found.source_records, "records": rep["records"], "ragged": rep["ragged"], "example": worst["example"] if worst else None,
            "first_bad_record": first[0], "first_bad_file": first[1], "first_bad_in_file": first[2],
            "line_breaks": found.line_breaks, "blank_lines": found.blank_lines, "content": rep["content"], "status": status}


VALIDATION = ("table string, path string, header_fields int, source_records long, records long, ragged long, example string, "
              "first_bad_record long, first_bad_file string, first_bad_in_file long, line_breaks long, blank_lines long, "
              "content string, status string")


def validate_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per table, header width, records by the text and by the parser,
    records whose field count differs from the header (with one example), line
    breaks inside quotes, blank lines, a fingerprint of the good records and the
    first bad record: its number over all files of the table in name order
    (``first_bad_record``; the header is 1) and in its own file.

    The reference stops at the first bad record and names its number; here all
    are counted. Status: ``open_quote`` (a file ends inside quotes), ``ragged``,
    ``blank_lines``, ``divergent`` (text and parser disagree) or ``ok``.
    """
    if not paths:
        raise ValueError("no CSV files")
    found = side_by_side(lambda p: tuple(validation_of(stage_csv(spark, p)).values()), sorted(paths))
    return spark.createDataFrame(found, VALIDATION)


def write_csv(df: DataFrame, path: str, quote: bool = True) -> None:
    """Write a frame as a headed CSV dataset in the same dialect (quoted
    empties, doubled quotes). Without ``quote`` nothing is quoted, as careless
    exports are."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"' if quote else "\u0000")
     .option("escape", '"').option("emptyValue", '""' if quote else "").option("nullValue", "")
     .csv(path))
