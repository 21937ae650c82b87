"""Exact continuous quantiles (``percentile_cont``) by selection, without a sort.

Spark's built-in exact ``percentile`` keeps every distinct value in one aggregation
buffer and merges them in one final task; at a billion distinct prices that task
does not survive. Here no step moves values by their number:

1. every wanted rank has an open interval of values that holds it, at first all;
2. a mergeable sketch of the interval's values (``percentile_approx``, a bounded
   buffer a task) proposes two values around the rank;
3. one exact pass counts the values below, at and between them, which says where
   the rank lies whatever the sketch's error: at one of the two values, and it is
   found, or in a part of the interval, about ``4 / accuracy`` of it;
4. that repeats until at most ``small`` values are left, which are fetched.

All ranks go through the same passes, each an aggregate that shuffles one row a
task; a value repeated on a third of the rows is found as an end of its interval.
The column is read two or three times more for each factor of ``accuracy / 4`` in
its rows, so ``df`` should be a table or a cheap projection of one.

NaN is greater than every number and equal to itself, as PostgreSQL orders it,
so it takes part like any value; an interpolation that touches it is NaN.
Interpolation is PostgreSQL's ``lo + (pos - floor(pos)) * (hi - lo)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 2_000
SMALL = 10_000


@dataclass
class _Open:
    """An open interval that holds a rank: ``below`` values before it,
    ``inside`` values in it. None is no bound."""

    low: float | None
    high: float | None
    below: int
    inside: int

    def holds(self) -> Column:
        x, out = F.col("x"), F.lit(True)
        if self.low is not None:
            out &= x > F.lit(self.low)
        if self.high is not None:
            out &= x < F.lit(self.high)
        return out


def select_ranks(x: DataFrame, ranks: Sequence[int], n: int, accuracy: int = ACCURACY, small: int = SMALL) -> dict[int, float]:
    """The values at ``ranks`` (from 0) of the ``n`` numbers of column ``x``
    (no nulls, no NaN)."""
    todo = {r: _Open(None, None, 0, n) for r in ranks}
    found: dict[int, float] = {}
    while any(o.inside > small for o in todo.values()):
        wide = {r: o for r, o in todo.items() if o.inside > small}
        sketches = []
        for r, o in wide.items():
            at = r - o.below
            around = [max(0.0, at / o.inside - 2 / accuracy), min(1.0, (at + 1) / o.inside + 2 / accuracy)]
            sketches.append(F.percentile_approx(F.when(o.holds(), F.col("x")), around, accuracy).alias(f"s{r}"))
        ends = {r: s for r, s in zip(wide, x.agg(*sketches).first())}
        counts = []
        for r, (low, high) in ends.items():
            v = F.col("x")
            counts += [F.count_if(v < F.lit(low)).alias(f"b{r}"), F.count_if(v == F.lit(low)).alias(f"l{r}"),
                       F.count_if((v > F.lit(low)) & (v < F.lit(high))).alias(f"i{r}"), F.count_if(v == F.lit(high)).alias(f"h{r}")]
        seen = x.agg(*counts).first()
        for r, (low, high) in ends.items():
            o, below, at_low, between = todo[r], seen[f"b{r}"], seen[f"l{r}"], seen[f"i{r}"]
            at_high = seen[f"h{r}"] if high > low else 0
            edges = [below, below + at_low, below + at_low + between, below + at_low + between + at_high]
            if r < edges[0]:
                todo[r] = _Open(o.low, low, o.below, edges[0] - o.below)
            elif r < edges[1]:
                found[r] = low
            elif r < edges[2]:
                todo[r] = _Open(low, high, edges[1], between)
            elif r < edges[3]:
                found[r] = high
            else:
                todo[r] = _Open(high, o.high, edges[3], o.below + o.inside - edges[3])
            if r in found:
                del todo[r]
    if todo:
        # At most ``small`` values for each rank.
        keep = F.lit(False)
        for o in todo.values():
            keep |= o.holds()
        values = x.filter(keep).groupBy("x").agg(F.count(F.lit(1)).alias("c")).orderBy("x").collect()
        for r, o in todo.items():
            left = r - o.below
            for v in values:
                if (o.low is None or v["x"] > o.low) and (o.high is None or v["x"] < o.high):
                    if left < v["c"]:
                        found[r] = v["x"]
                        break
                    left -= v["c"]
    return found


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """One row with one DOUBLE column ``q0, q1, ...`` per probability; NULL
    where there are no values."""
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    size = x.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.isnan("x")).alias("nan")).first()
    n, numbers = size["n"], size["n"] - size["nan"]
    positions = [p * (n - 1) for p in probs] if n else []
    ranks = {r for pos in positions for r in (math.floor(pos), math.ceil(pos))}
    values = select_ranks(x.where(~F.isnan("x")), sorted(r for r in ranks if r < numbers), numbers, accuracy, small)
    out = []
    for pos in positions:
        low, high = (values.get(r, math.nan) for r in (math.floor(pos), math.ceil(pos)))
        out.append(float(low + (pos - math.floor(pos)) * (high - low)))
    row = tuple(out) if n else (None,) * len(probs)
    return df.sparkSession.createDataFrame([row], ", ".join(f"q{i} double" for i in range(len(probs))))
