"""Records of CSV files: numbers, blocks, quoted line breaks, fingerprints, versions, reload."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tillsight.sources import csv_files as C
from tillsight.sources import infer as I
from tillsight.sources import load as L
from tillsight.sources import reload as R
from tillsight.sources import snapshots as S


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.fixture()
def small_blocks(spark):
    """Files are read in blocks of a few hundred bytes, each a task."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_records_are_those_of_a_csv_reader(spark, scratch, small_blocks):
    rng = random.Random(1)
    cells = ["x", "", "two words", "a,b", 'say "hi"', "one\ntwo", "\n", "a\n\nb\n", "é\nü", "q" * 150 + "\n" + "r" * 150]
    for quoted in (True, False):
        rows = [[str(i), *rng.choices(cells if quoted else cells[:3], k=2)] for i in range(400)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n" if quoted else "\r\n").writerows([["id", "a", "b"], *rows])
        path = _file(scratch, f"t{quoted}.csv", out.getvalue())
        staged = C.stage_csv(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 10  # one file, many tasks
        got = {r["number"]: r for r in staged.frame.collect()}
        assert sorted(got) == list(range(2, 402)) and not any(r["bad"] or r["blank"] for r in got.values())
        text = {r["number"]: list(r)[1:] for r in staged.text("number").collect()}
        assert text == {i + 2: [x or None for x in row] for i, row in enumerate(rows)}
        assert staged.records.source_records == 400 and staged.records.open_files == 0


def test_number_of_the_first_bad_record(spark, scratch, small_blocks):
    good = [f"{i},v{i}" for i in range(2, 500)]
    for at in (2, 3, 250, 499):
        lines = list(good)
        lines[at - 2] = "1,2,3"
        if at > 10:
            lines[4] = '6,"broken\nline"'
        path = _file(scratch, f"bad{at}.csv", "a,b\n" + "\n".join(lines) + "\n")
        with open(path, newline="", encoding="utf-8") as f:  # what a csv reader counts
            reader = csv.reader(f)
            width = len(next(reader))
            want = next(n for n, row in enumerate(reader, start=2) if len(row) != width)
        row = C.validate_csv(spark, [path]).first()
        assert (row["first_bad_record"], row["first_bad_in_file"], row["status"]) == (want, want, "ragged")
    blank = _file(scratch, "blank.csv", "a,b\n1,2\n\n3,4\n1\n")
    row = C.validate_csv(spark, [blank]).first()
    assert (row["first_bad_record"], row["blank_lines"], row["ragged"]) == (3, 1, 1)


def test_numbers_go_on_over_the_files_of_a_table(spark, scratch):
    folder = os.path.join(scratch, "t.csv")
    _file(folder, "a.csv", "x,y\n1,2\n3,4\n")
    _file(folder, "b.csv", "x,y\n")
    _file(folder, "c.csv", 'x,y\n5,"6\n7"\n8\n9,9\n')
    row = C.validate_csv(spark, [folder]).first()
    assert (row["source_records"], row["records"], row["ragged"]) == (5, 5, 1)
    assert (row["first_bad_record"], row["first_bad_in_file"]) == (5, 3) and row["first_bad_file"].endswith("c.csv")
    _file(folder, "d.csv", "x,z\n1,1\n")
    with pytest.raises(ValueError):
        C.validate_csv(spark, [folder])


def test_stray_quotes_never_lose_records(spark, scratch):
    # Two stray quotes join two records by parity; the parser doesn't agree.
    pair = _file(scratch, "pair.csv", 'a,b\n1,5" x\n2,6" y\n3,z\n')
    single = _file(scratch, "single.csv", 'a,b\n1,5" x\n2,y\n')
    rep = {r["table"]: r["status"] for r in C.validate_csv(spark, [pair, single]).collect()}
    assert rep["pair"] == "ragged" and rep["single"] == "open_quote"


def test_fingerprints_count_every_row(spark):
    df = lambda rows: spark.createDataFrame(rows, "a int, b string")
    of = lambda rows: df(rows).agg(C.fingerprint(df(rows)).alias("f")).first()["f"]
    base = [(1, "x"), (2, None), (2, None)]
    assert of(base) == of(base[::-1])
    others = [base[:1], [*base, (3, "y"), (3, "y")], [(1, "x"), (2, None), (2, "")], [(1, None), (2, "x"), (2, None)],
              [(None, "x"), (2, None), (2, None)], [(1, "x"), (3, "y"), (3, "y")]]
    assert len({of(base), *map(of, others)}) == 1 + len(others)


def test_a_changed_value_is_divergent(spark, scratch):
    path = _file(scratch, "t.csv", "id,v\n1,10\n2,20\n3,30\n")
    dest = os.path.join(scratch, "dest")
    report, run = L.load_run(spark, [path], dest, publish=False)
    assert [r["status"] for r in report.collect()] == ["ok"]
    rows = spark.read.parquet(f"{run}/t").collect()
    swapped = spark.createDataFrame([(r["id"], {10: 20, 20: 10}.get(r["v"], r["v"])) for r in rows], "id int, v int")
    swapped.write.mode("overwrite").parquet(f"{run}/t")
    assert [tuple(r) for r in L.reconcile_run(spark, run, ["t"]).collect()] == [("t", 3, 3, "divergent")]


def test_readers_never_mix_two_loads(spark, scratch):
    dest = os.path.join(scratch, "dest")

    def load(v):
        files = [_file(scratch, f"{t}.csv", f"id,v\n1,{v}\n") for t in ("a", "b")]
        L.load_run(spark, files, dest)

    load(1)
    held = S.open_snapshot(spark, dest)
    first = held.table("a").first()["v"]
    load(2)
    late = S.open_snapshot(spark, dest)
    assert (first, held.table("b").first()["v"]) == (1, 1)  # opened before, read after
    assert [late.table(t).first()["v"] for t in late.tables] == [2, 2] and (held.version, late.version) == (1, 2)
    assert S.open_snapshot(spark, dest, 1).table("b").first()["v"] == 1
    with pytest.raises(LookupError):
        S.open_snapshot(spark, dest, 9)
    # A number is taken once; a writer that died half-way is passed over.
    assert not S.create_if_absent(spark, f"{dest}/_published/000000000002.json", "x")
    assert S.create_if_absent(spark, f"{dest}/_published/000000000003.json", '{"content": {')
    assert S.open_snapshot(spark, dest).version == 2
    load(4)
    assert S.open_snapshot(spark, dest).version == 4


def test_a_replaced_file_replaces_its_rows(spark, scratch):
    landing, dest = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    schema = I.struct_from_catalog(I.infer_schema({"t": spark.createDataFrame([("1", "x")], "id string, v string")}), "t")
    rows = lambda: sorted(tuple(r) for r in R.current_rows(spark, "t", schema, dest).collect())
    actions = lambda **k: {os.path.basename(r["file"]): r["action"] for r in
                           R.reload_changed(spark, landing, "t", schema, dest, **k).collect()}
    assert rows() == []
    _file(landing, "1.csv", "id,v\n1,a\n2,b\n")
    _file(landing, "2.csv", 'id,v\n3,"c\nd"\n')
    assert actions() == {"1.csv": "new", "2.csv": "new"} and rows() == [(1, "a"), (2, "b"), (3, "c\nd")]
    assert actions() == {"1.csv": "unchanged", "2.csv": "unchanged"} and len(S.versions(spark, dest + "/t")) == 1
    _file(landing, "1.csv", "id,v\n2,B\n")
    _file(landing, "3.csv", "id,v\n")
    assert actions() == {"1.csv": "replaced", "2.csv": "unchanged", "3.csv": "new"} and rows() == [(2, "B"), (3, "c\nd")]
    _file(landing, "3.csv", "id,v\n4\n")
    with pytest.raises(L.DivergentLoadError):
        actions()
    assert rows() == [(2, "B"), (3, "c\nd")]
    os.remove(os.path.join(landing, "2.csv"))
    _file(landing, "3.csv", "id,v\n5,e\n")
    assert actions() == {"1.csv": "unchanged", "2.csv": "missing", "3.csv": "replaced"} and len(rows()) == 3
    assert actions(drop_missing=True)["2.csv"] == "dropped" and rows() == [(2, "B"), (5, "e")]


def test_inference_plan_has_no_explode(spark):
    df = spark.createDataFrame([("1", "x")] * 3, "id string, v string")
    plan = spark._jvm.PythonSQLUtils.explainString(I._states(df, "t", I._state())._jdf.queryExecution(), "simple")
    assert "Generate" not in plan and "Expand" not in plan


def test_plain_records_and_others(spark, scratch):
    """Records without quotes are cut at commas, with the parser's results."""
    path = _file(scratch, "mixed.csv", 'a,b\n1,\n,2\n , x \n,\n"q","",\n"q",""\nx\n1,2,3\r\n4,5\r\n6,\\\n"7,8",9\n')
    staged = C.stage_csv(spark, path)
    assert sorted(map(tuple, staged.text().collect()), key=str) == sorted(
        [("1", None), (None, "2"), (" ", " x "), (None, None), ("q", ""), ("4", "5"), ("6", "\\"), ("7,8", "9")], key=str)
    found = C.validation_of(staged)
    assert (found["records"], found["ragged"], found["example"], found["first_bad_record"]) == (11, 3, '"q","",', 6)


def test_digest_adds_whole_numbers(spark):
    df = spark.range(1000).selectExpr("id", "IF(id % 5 = 0, NULL, cast(id % 7 AS string)) AS s")
    sums = [sum(r[0] for r in df.selectExpr(f"xxhash64({k}, id IS NULL, id, s IS NULL, s)").collect()) for k in (1, 2)]
    agg = df.agg(C.fingerprint(df).alias("f"))
    assert agg.first()["f"] == f"1000:{sums[0]}:{sums[1]}"
    assert "sum(shiftright(" in agg._jdf.queryExecution().executedPlan().toString()


def test_class_from_its_parts(spark):
    values = ["0", "007", "+5", "-5", "--5", "1.5", "01.5", ".5", "5.", "1.2.3", "-0.5", "+", "", "1998-02-06", "1998-2-31", "x", "T", "false",
              "1998-02-06 10:11:12", "12:30", "9223372036854775808", "1e5", " 1", "1 ", "/1", ":1", "٣"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    body = F.col("body")
    parts = df.withColumn("body", I._unsigned(F.col("v"))).withColumn("rest", I._without_digits(body))
    got = parts.select(I.value_class(F.col("v")), I._class_of(F.col("v"), body, F.col("rest")), "v").collect()
    assert [(r[2], r[0]) for r in got] == [(r[2], r[1]) for r in got]
