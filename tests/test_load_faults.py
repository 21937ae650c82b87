"""Faulty files: found by a count apart from the parser, refused or loaded right."""

import os
import subprocess
import sys

import pytest

from tillsight.sources import csv_files as C
from tillsight.sources import infer as I
from tillsight.sources import load as L
from tillsight.streaming import landing as S


def _file(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_quoted_line_breaks_are_counted_and_loaded_whole(spark, scratch):
    # One column, a line break inside quotes: a splitting parser sees three rows.
    path = _file(scratch, "notes.csv", 'note\n"a\nb"\nc\n"d ""x""\n\ne"\n')
    seen = C.scan_lines(spark, path).first()
    assert (seen["source_records"], seen["blank_lines"], seen["line_breaks"]) == (3, 0, 3)
    report, _ = L.load_run(spark, [path], scratch + "/dest")
    assert [(r["source_rows"], r["loaded_rows"], r["status"]) for r in report.collect()] == [(3, 3, "ok")]
    got = sorted(r["note"] for r in L.published_table(spark, scratch + "/dest", "notes").collect())
    assert got == ["a\nb", "c", 'd "x"\n\ne']


def test_blank_and_ragged_lines_are_refused(spark, scratch):
    blank = _file(scratch, "blank.csv", "a\n1\n\n2\n")
    ragged = _file(scratch, "ragged.csv", "a,b\n1,2\n3,4,5\n")
    good = _file(scratch, "good.csv", "a,b\n1,2\n")
    rep = {r["table"]: r for r in C.validate_csv(spark, [blank, ragged, good]).collect()}
    assert (rep["blank"]["status"], rep["blank"]["blank_lines"], rep["blank"]["source_records"]) == ("blank_lines", 1, 2)
    assert (rep["ragged"]["status"], rep["ragged"]["ragged"]) == ("ragged", 1)
    dest = scratch + "/dest"
    report, _ = L.load_run(spark, [blank, ragged, good], dest)
    assert {r["table"]: r["status"] for r in report.collect()} == {"blank": "invalid", "ragged": "invalid", "good": "ok"}
    assert not os.path.exists(dest + "/_published")


def test_a_stray_quote_is_divergent_not_ok(spark, scratch):
    # Python's reader and COPY differ on it as well; it must not pass as ok.
    path = _file(scratch, "stray.csv", 'a,b\n1,5" pipe\n2,x\n3,y\n')
    report, _ = L.load_run(spark, [path], scratch + "/dest")
    assert report.first()["status"] in ("invalid", "divergent")


def test_pointers_are_only_added(spark, scratch):
    dest = scratch + "/dest"
    for value in ("1", "2"):
        L.load_run(spark, [_file(scratch, "t.csv", f"a\n{value}\n")], dest)
        files = [f for f in os.listdir(dest + "/_published") if f.endswith(".json")]
        assert len(files) == int(value)
        assert L.published_table(spark, dest, "t").first()["a"] == int(value)


def test_stream_refuses_another_header(spark, scratch):
    os.makedirs(scratch + "/in")
    _file(scratch + "/in", "1.csv", "x,id\n20,2\n")
    schema = I.struct_from_catalog(I.infer_schema({"t": spark.createDataFrame([("1", "2")], "id string, x string")}), "t")
    q = S.stream_raw_load(spark, scratch + "/in", "t", schema, scratch + "/dest", scratch + "/state")
    with pytest.raises(Exception):
        q.awaitTermination()
    assert not os.path.exists(scratch + "/dest/_batches")


def test_a_repeated_batch_reports_once(spark, scratch):
    os.makedirs(scratch + "/in")
    _file(scratch + "/in", "1.csv", "id,x\n20,2\n21,3\n")
    schema = I.struct_from_catalog(I.infer_schema({"t": spark.createDataFrame([("1", "2")], "id string, x string")}), "t")
    for state in ("/state1", "/state2"):  # a second state folder repeats batch 0
        S.stream_raw_load(spark, scratch + "/in", "t", schema, scratch + "/dest", scratch + state).awaitTermination()
    assert [(r["source_rows"], r["loaded_rows"]) for r in S.batch_report(spark, scratch + "/dest", "t").collect()] == [(2, 2)]


def test_year_zero_is_no_date_and_wide_numbers_say_why(spark):
    df = spark.createDataFrame([("0000-01-01", "0000-01-01 10:00:00", "1" * 30 + ".5", "9" * 39),
                                ("0001-01-01", "0001-01-01 10:00:00", "1." + "5" * 20, "1")],
                               "d string, t string, wide string, long string")
    got = {r["column"]: r for r in I.infer_table(df, "x").collect()}
    assert got["d"]["sql_type"] == got["t"]["sql_type"] == "TEXT" and got["d"]["reason"] is None
    for c in ("wide", "long"):
        assert (got[c]["sql_type"], got[c]["spark_type"]) == ("TEXT", "string")
        assert got[c]["reason"] == "numbers of more than 38 digits"


def test_no_machine_local_folder_on_a_cluster_and_none_left_over():
    code = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from tillsight import session
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print("DIR", session.new_run_dir(spark, "x"))
class Elsewhere:
    conf = type("C", (), {"get": staticmethod(lambda k, d=None: "spark://host:7077" if k == "spark.master" else d)})
    sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})
try:
    session.shared_dir(Elsewhere)
except ValueError as e:
    print("REFUSED", e)
spark.stop()
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout
    assert "REFUSED spark.checkpoint.dir must name a folder" in said
    path = next(x for x in said.splitlines() if x.startswith("DIR")).split()[1]
    assert not os.path.exists(path.replace("file:", ""))
