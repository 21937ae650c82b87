import os

from tillsight.sources import csv_files as C
from tillsight.sources import infer as I
from tillsight.streaming.landing import batch_report, loaded_table, stream_raw_load


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_incremental_load_appends_each_file_once(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "orders_1.csv"), "id,flag,amount\n1,T,1.50\n2,f,2.25\n")
    cat = I.infer_schema({"orders": C.read_text_table(spark, os.path.join(landing, "orders_1.csv"))})
    schema = I.struct_from_catalog(cat, "orders")
    dest = os.path.join(scratch, "dest")
    ckpt = os.path.join(scratch, "ckpt")
    q = stream_raw_load(spark, landing, "orders", schema, dest, checkpoint=ckpt)
    q.awaitTermination(120)
    _write(os.path.join(landing, "orders_2.csv"), 'id,flag,amount\n3,TRUE,"3.00"\n')
    q = stream_raw_load(spark, landing, "orders", schema, dest, checkpoint=ckpt)
    q.awaitTermination(120)
    # A third run without new files adds nothing.
    q = stream_raw_load(spark, landing, "orders", schema, dest, checkpoint=ckpt)
    q.awaitTermination(120)
    rows = loaded_table(spark, dest, "orders").orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2, 3]
    assert [r["flag"] for r in rows] == [True, False, True]
    rep = batch_report(spark, dest, "orders").collect()
    assert sum(r["source_rows"] for r in rep) == 3 and {r["status"] for r in rep} == {"ok"}


def test_one_file_per_trigger_gives_one_batch_each(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    for k in range(3):
        _write(os.path.join(landing, f"part_{k}.csv"),
               "id,amount\n" + "".join(f"{k * 10 + i},{i}.50\n" for i in range(4)))
    cat = I.infer_schema({"t": C.read_text_table(spark, landing)})
    schema = I.struct_from_catalog(cat, "t")
    dest = os.path.join(scratch, "dest")
    q = stream_raw_load(spark, landing, "t", schema, dest,
                        checkpoint=os.path.join(scratch, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(120)
    rep = batch_report(spark, dest, "t").collect()
    assert len(rep) == 3 and all(r["source_rows"] == 4 and r["status"] == "ok" for r in rep)
    assert loaded_table(spark, dest, "t").select("id").distinct().count() == 12


def test_inference_reads_a_columnar_copy(spark, monkeypatch):
    """The exported text is parsed once for inference, not once a column."""
    from tillsight.plans import registry
    from tillsight.sources import infer
    real, read = infer.infer_schema, []

    def spying(tables, *more):
        read.extend(f for t in tables.values() for f in t.inputFiles())
        return real(tables, *more)

    monkeypatch.setattr(infer, "infer_schema", spying)
    rows = registry.q_incremental_load(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 5 and all(r["source_rows"] == r["loaded_rows"] for r in rows)
    assert read and not [f for f in read if not f.endswith(".parquet")]
