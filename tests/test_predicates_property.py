"""Differential test of the type predicates against Python's own parsing.

Python's ``re`` and ``datetime.strptime`` define the semantics the inference
rules follow; hypothesis generates batches of plain and near-miss values and
every batch is checked in one Spark job. ASCII only, no line breaks (the
documented differences).
"""

import re
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillsight.sources import infer as I

WORDS = ("TRUE", "FALSE", "T", "F")


def py_bool(v):
    return v.upper() in WORDS


def _no_lead0(d):
    return not (len(d) > 1 and d.startswith("0"))


def py_int(v):
    return re.fullmatch(r"[+-]?[0-9]+", v) is not None and _no_lead0(v.lstrip("+-"))


def py_dec(v):
    return (re.fullmatch(r"[+-]?[0-9]+\.[0-9]+", v) is not None
            and _no_lead0(v.lstrip("+-").split(".")[0]))


def _parses(v, fmt):
    try:
        datetime.strptime(v, fmt)
        return True
    except ValueError:
        return False


def py_date(v):
    return _parses(v, "%Y-%m-%d")


def py_ts(v):
    return _parses(v, "%Y-%m-%d %H:%M:%S")


num = st.integers(min_value=0, max_value=99).map(str)
pad = st.sampled_from(["", "0", "00", " "])
part = st.tuples(pad, num).map(lambda t: t[0] + t[1])
dates = st.tuples(st.sampled_from(["2023", "2024", "1999", "23", "02024"]), part, part).map(
    lambda t: f"{t[0]}-{t[1]}-{t[2]}")
times = st.tuples(part, part, part, st.sampled_from(["", ".5", "Z"])).map(
    lambda t: f"{t[0]}:{t[1]}:{t[2]}{t[3]}")
stamps = st.tuples(dates, st.sampled_from([" ", "  ", "T", "\t"]), times).map("".join)
numbers = st.tuples(st.sampled_from(["", "+", "-", "+-"]), st.sampled_from(["", "0", "00"]),
                    st.integers(min_value=0, max_value=10**12).map(str),
                    st.sampled_from(["", ".", ".5", ".05", ".00", "..1"])).map("".join)
noise = st.text(alphabet="0123456789+-.: TtFfRUEAaLS", max_size=12)
value = st.one_of(noise, numbers, dates, stamps, st.sampled_from(WORDS + ("yes", "1", "true ")))


@settings(max_examples=12, deadline=None)
@given(st.lists(value, min_size=20, max_size=150))
def test_predicates_agree_with_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    rows = df.select("v", I.is_boolean(v).alias("b"), I.is_integer(v).alias("i"),
                     I.is_decimal(v).alias("d"), I.is_date(v).alias("dt"),
                     I.is_timestamp(v).alias("ts")).collect()
    for r in rows:
        s = r["v"]
        assert bool(r["b"]) == py_bool(s), s
        assert bool(r["i"]) == py_int(s), s
        assert bool(r["d"]) == py_dec(s), s
        assert bool(r["dt"]) == py_date(s), s
        assert bool(r["ts"]) == py_ts(s), s
