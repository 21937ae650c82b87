import os

import pytest
from pyspark.sql import functions as F

from tillsight.sources import csv_files as C
from tillsight.sources import infer as I
from tillsight.sources import load as L


def _flags(spark, values, pred):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(pred(F.col("v"))).collect()]


def test_integer_and_decimal_predicates(spark):
    assert _flags(spark, ["0", "70", "+5", "-5", "007", "1.", ".5"], I.is_integer) == \
        [True, True, True, True, False, False, False]
    assert _flags(spark, ["1.50", "22.125", "00.5", "-0.5"], I.is_decimal) == \
        [True, True, False, True]


def test_boolean_date_timestamp_predicates(spark):
    assert _flags(spark, ["T", "f", "TRUE", "False", "yes", "1"], I.is_boolean) == \
        [True, True, True, True, False, False]
    assert _flags(spark, ["2023-02-28", "2023-2-3", "2023-02-30", "23-2-3", " 2023-02-03",
                          "2023-02-03T10:00:00"], I.is_date) == \
        [True, True, False, False, False, False]
    assert _flags(spark, ["2023-02-03 10:00:00", "2023-02-03 1:2:3", "2023-02-03 10:00:61",
                          "2023-02-03 10:00:00.5"], I.is_timestamp) == [True, True, False, False]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_inference_rules(spark, scratch):
    p = _write(os.path.join(scratch, "Things.csv"),
               "id,amount,big,huge,flag,postal_code,phone_numbers,empty\n"
               "1,1.50,2147483647,12345678901234567890,T,01234,5,\n"
               "2,22.125,2147483648,1,f,99999,6,\n"
               "3,,-2147483648,2,,11111,7,\n")
    cat = {r["column"]: r for r in
           I.infer_schema({C.table_name(p): C.read_text_table(spark, p)}).collect()}
    assert cat["id"]["sql_type"] == "INTEGER" and cat["id"]["is_key"]
    assert cat["amount"]["sql_type"] == "NUMERIC(5, 3)" and cat["amount"]["nullable"]
    assert cat["big"]["sql_type"] == "BIGINT"
    assert cat["huge"]["sql_type"] == "DECIMAL(20, 0)"        # beyond 64 bits
    assert cat["flag"]["sql_type"] == "BOOLEAN"
    assert cat["postal_code"]["sql_type"] == "TEXT"           # identifier override
    assert cat["phone_numbers"]["sql_type"] == "INTEGER"       # not an identifier name
    assert cat["empty"]["sql_type"] == "TEXT" and cat["empty"]["nullable"]
    assert {r["table"] for r in cat.values()} == {"things"}


def test_duplicate_id_is_not_a_key(spark, scratch):
    p = _write(os.path.join(scratch, "d.csv"), "ID,x\n1,a\n1,b\n")
    cat = I.infer_schema({"d": C.read_text_table(spark, p)})
    row = I.key_candidates(cat).first()
    assert row["column"] == "ID" and row["is_key"] is False


def test_header_only_file(spark, scratch):
    p = _write(os.path.join(scratch, "h.csv"), "a,b\n")
    rows = I.infer_schema({"h": C.read_text_table(spark, p)}).collect()
    assert [(r["sql_type"], r["nullable"], r["is_key"]) for r in rows] == [("TEXT", False, False)] * 2


def test_quoted_values_and_validation(spark, scratch):
    good = _write(os.path.join(scratch, "good.csv"), 'a,b\n"he said ""hi""",""\nx,\n')
    ragged = _write(os.path.join(scratch, "ragged.csv"), "a,b\n1\n1,2,3\n4,5\n")
    rows = C.read_text_table(spark, good).collect()
    assert rows[0]["a"] == 'he said "hi"' and rows[0]["b"] == "" and rows[1]["b"] is None
    rep = {r["table"]: r for r in C.validate_csv(spark, [good, ragged]).collect()}
    assert rep["good"]["status"] == "ok" and rep["ragged"]["ragged"] == 2
    with pytest.raises(Exception):
        C.read_text_table(spark, ragged).collect()   # parses every field: FAILFAST fires


def test_empty_file_has_no_header(spark, scratch):
    p = _write(os.path.join(scratch, "e.csv"), "")
    with pytest.raises(ValueError):
        C.header(spark, p)


def test_prerequisite_check_stops_before_loading(spark, scratch):
    a = _write(os.path.join(scratch, "a.csv"), "id\n1\n")
    z = _write(os.path.join(scratch, "Zeta.csv"), "id\n1\n")
    assert L.missing_tables([a, z], ["a"]) == ["zeta"]
    dest = os.path.join(scratch, "dest")
    with pytest.raises(L.MissingTablesError):
        L.load_run(spark, [a, z], dest, expected=["a"], require_declared=True)
    assert not os.path.exists(dest)


def test_load_round_trip_reconciles_and_publishes(spark, scratch):
    a = _write(os.path.join(scratch, "a.csv"), "id,flag,day\n1,T,2024-01-02\n2,f,2024-1-3\n")
    b = _write(os.path.join(scratch, "b.csv"), "id,v\n1,x\n")
    dest = os.path.join(scratch, "dest")
    rep, run = L.load_run(spark, [a, b], dest, expected=["a", "b", "c"])
    st = {r["table"]: r["status"] for r in rep.collect()}
    assert st == {"a": "ok", "b": "ok", "c": "not_loaded"}
    assert not os.path.exists(os.path.join(dest, "_published"))   # not published
    with pytest.raises(L.DivergentLoadError):
        L.load_run(spark, [a, b], dest, expected=["a", "b", "c"], raise_on_divergence=True)
    rep, run = L.load_run(spark, [a, b], dest)
    assert {r["status"] for r in rep.collect()} == {"ok"}
    t = L.published_table(spark, dest, "a")
    assert [r["flag"] for r in t.orderBy("id").collect()] == [True, False]
    assert str(t.schema["day"].dataType) == "DateType()"


def test_bucketed_load_joins_without_exchange(spark, scratch):
    a = _write(os.path.join(scratch, "orders.csv"),
               "id,customer_id\n" + "".join(f"{i},{i % 7}\n" for i in range(1, 201)))
    b = _write(os.path.join(scratch, "order_items.csv"),
               "id,order_id,qty\n" + "".join(f"{i},{i % 200 + 1},{i % 5}\n" for i in range(1, 801)))
    dest = os.path.join(scratch, "dest")
    rep, run = L.load_run(spark, [a, b], dest,
                          bucket_by={"orders": ("id", 4), "order_items": ("order_id", 4)})
    assert {r["status"] for r in rep.collect()} == {"ok"}
    o = L.published_table(spark, dest, "orders")
    i = L.published_table(spark, dest, "order_items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = i.join(o.withColumnRenamed("id", "order_id"), "order_id")
        plan = spark._jvm.PythonSQLUtils.explainString(j._jdf.queryExecution(), "simple")
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert j.count() == 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
