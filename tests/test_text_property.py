"""Differential test of the reason cleaning against a plain-Python model of
its rules: trim spaces, collapse ASCII whitespace, lower-case, then the first
matching rule wins."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillsight.functions.labels import REASON_DEFAULT, REASON_EMPTY_VALUES, REASON_RULES
from tillsight.functions.text import categorise, changed, normalise_key


def py_key(s):
    s = "" if s is None else s
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", s.strip(" ")).lower()


def py_label(k):
    if k in REASON_EMPTY_VALUES:
        return REASON_DEFAULT
    for subs, label in REASON_RULES:
        if any(x in k for x in subs):
            return label
    return REASON_DEFAULT


pieces = st.sampled_from(["duplicad", "DESIST", "corresp", "Descri", "avariad", "transporte",
                          "TAMANHO", "defeito", "fábrica", "brica", "outros", "?", "-", "—",
                          "compra", "item", "x", " ", "  ", "\t", "ç", "É"])
reason = st.one_of(st.none(), st.lists(pieces, max_size=6).map("".join))


@settings(max_examples=10, deadline=None)
@given(st.lists(reason, min_size=20, max_size=120))
def test_cleaning_agrees_with_python_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "r string")
    k = normalise_key(F.col("r"))
    rows = df.select("r", k.alias("k"), categorise(k).alias("c"),
                     changed(F.col("r"), categorise(k)).alias("ch")).collect()
    for row in rows:
        key = py_key(row["r"])
        assert row["k"] == key, repr(row["r"])
        assert row["c"] == py_label(key), repr(row["r"])
        assert row["ch"] == (row["r"] != py_label(key)), repr(row["r"])
