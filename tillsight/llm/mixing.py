"""Operator 3, mixing sources to target weights by pivotal dependent rounding.

Native: DataFrame functions only.

A source's target over its size is the number of copies that each of its
documents should have: a whole part, the same for all, and a fraction. The
fractions are rounded together. Two documents meet and words move from one to
the other, in a direction drawn so that neither one's expected share changes,
until one of the two fractions is 0 or 1; that document is settled and the other
goes on. So the words of a source stay exactly at its target throughout.

The meetings form a tree: documents are dealt by a hash into groups of about
``GROUP``, each group is folded in one task and leaves at most one document
unsettled, and these are dealt again, until one a source is left. It takes the
remaining words as part of a copy. A hot source only has more groups.

Sources are ranked in one window over a table of one row a source; nothing
else meets in one task.

Defined cases: null and empty texts have size 0 and take 0; a source without
words has target 0; null is a source of its own, ranked last; repeated rows
(same id, source and size) are documents of their own; an empty table gives no
rows. A group's order and the draws of its meetings are two hashes of id, size
and ``seed``, independent of each other, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, staged

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
GROUP = 64
SEED = 11


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """For each source of ``rows`` (``source``, ``size``): ``source_size`` and
    ``target``.

    The shares are filled like vessels of height ``most`` * size / weight:
    in the order of height a source is full if what is left, shared by weight
    among it and the higher ones, would exceed it.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    high = sources.withColumn("weight", weight).withColumn("limit", F.lit(most) * F.col("source_size"))
    up = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = high.withColumn("level", left / F.sum("weight").over(after))
    full = F.col("limit") <= F.col("level") * F.col("weight")
    # The first source that isn't full has the level of all that aren't.
    rest = F.min(F.when(~full, F.struct((F.col("limit") / F.col("weight")).alias("height"), "level"))).over(whole)
    return level.withColumn("rest", rest).select(
        "source", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"),
        F.when(full, F.col("limit")).otherwise(F.least("limit", F.col("rest.level") * F.col("weight"))).alias("target"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _meet(state: Column, unit: Column) -> Column:
    """One step of the fold: the unsettled document meets the next one."""
    a, b = state["open"], unit
    # Words that can move from a to b, and from b to a.
    room = F.struct(F.least(a["part"] * a["size"], (1.0 - b["part"]) * b["size"]).alias("there"),
                    F.least(b["part"] * b["size"], (1.0 - a["part"]) * a["size"]).alias("back"))

    def settle(m: Column) -> Column:
        there = b["draw"] * (m["there"] + m["back"]) < m["back"]
        moved = F.when(there, m["there"]).otherwise(-m["back"])
        emptied = F.when(there, m["there"] >= a["part"] * a["size"]).otherwise(m["back"] >= (1.0 - a["part"]) * a["size"])
        # ``emptied``: a is settled (at 0 if words went to b, at 1 otherwise).
        settled = F.when(emptied, a.withField("part", F.when(there, 0.0).otherwise(1.0))) \
            .otherwise(b.withField("part", F.when(there, 1.0).otherwise(0.0)))
        going = F.when(emptied, b.withField("part", b["part"] + moved / b["size"])) \
            .otherwise(a.withField("part", a["part"] - moved / a["size"]))
        return F.struct(going.alias("open"), F.concat(state["done"], F.array(settled)).alias("done"))

    return F.when(a.isNull(), F.struct(b.alias("open"), state["done"].alias("done"))).otherwise(_let(room, settle))


def round_fractions(units: DataFrame, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """``units`` (``source``, ``id``, ``nth``, ``size``, ``part``) with every
    ``part`` rounded to 0 or 1, but for one unit a source at most. Sizes must
    be above 0."""
    settled = None
    level = 0
    open_units = units.filter((F.col("part") > 0) & (F.col("part") < 1))
    done = units.filter((F.col("part") <= 0) | (F.col("part") >= 1))
    while True:
        most = open_units.groupBy("source").agg(F.count("*").alias("units")).agg(F.max("units")).first()[0] or 0
        if most <= 1:
            return (done if settled is None else done.unionByName(settled)).unionByName(open_units)
        counts = open_units.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("units"))
        dealt = open_units.join(counts, F.col("source").eqNullSafe(F.col("_source"))).select(
            "source", F.pmod(F.xxhash64("id", "nth", "size", F.lit(seed), F.lit(3 * level)),
                                         F.ceil(F.col("units") / group)).alias("deal"),
            # Groups are sorted by the first field, so it must not be the draw.
            F.struct(F.xxhash64("id", "nth", "size", F.lit(seed), F.lit(3 * level + 1)).alias("place"),
                     (F.pmod(F.xxhash64("id", "nth", "size", F.lit(seed), F.lit(3 * level + 2)), F.lit(1 << 53))
                      / float(1 << 53)).alias("draw"), "id", "nth", "size", "part").alias("unit"))
        kind = dealt.schema["unit"].dataType.simpleString()
        folded = (dealt.groupBy("source", "deal").agg(F.array_sort(F.collect_list("unit")).alias("units"))
                  .select("source", F.aggregate(
                      "units", F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done")),
                      _meet).alias("end")))
        folded = staged(folded.select("source", F.explode(F.concat(
            F.transform("end.done", lambda u: F.struct(F.lit(False).alias("open"), u.alias("u"))),
            F.array(F.struct(F.lit(True).alias("open"), F.col("end.open").alias("u"))))).alias("e"))
            .select("source", "e.u.id", "e.u.nth", "e.u.size", "e.u.part", (
                F.col("e.open") & (F.col("e.u.part") > 0) & (F.col("e.u.part") < 1)).alias("open")), "mixing-level")
        now = folded.filter(~F.col("open")).drop("open")
        settled = now if settled is None else settled.unionByName(now)
        open_units = folded.filter("open").drop("open")
        level += 1


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        seed: int = SEED, **options) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``source``, ``size``,
    ``nth`` (1, 2, ... among rows with these three the same), ``source_size``,
    ``target`` and ``taken``, the words that the mix takes."""
    rows = staged(docs.select(quoted(source_col).alias("source"), quoted(id_col).alias("id"),
                              words(quoted(text_col)).alias("size")), "mixing-sizes")
    goal = staged(targets(rows, **options), "mixing-targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (rows.groupBy("source", "id", "size").agg(F.count("*").alias("rows"))
             .select("source", "id", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth")))
    share = goal.select(F.col("source").alias("_source"), F.floor(copies).alias("whole"),
                        (copies - F.floor(copies)).alias("part"))
    parted = units.join(share, F.col("source").eqNullSafe(F.col("_source"))) \
        .select("source", "id", "nth", "size", F.when(F.col("size") > 0, F.col("part")).otherwise(0.0).alias("part"))
    rounded = round_fractions(staged(parted, "mixing-units"), seed=seed)
    whole = goal.select(F.col("source").alias("_source"), "source_size", "target", F.floor(copies).alias("whole"))
    return rounded.join(whole, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias(id_col), "source", "size", "nth", "source_size", "target",
        (F.col("whole") * F.col("size") + F.round(F.col("part") * F.col("size")).cast("long")).alias("taken"))


def report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
