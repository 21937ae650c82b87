"""Views of the catalog say what the operators say, and can be replaced and dropped."""

import uuid

import pytest
from pyspark.sql import functions as F

from tillsight.plans import lasting_views as V
from tillsight.plans import registry
from tillsight.plans import retail
from tillsight.sources import load as L
from tillsight.sources import snapshots as S

from tests.test_retail_cli import _write_sources


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    _write_sources(str(folder))
    files = sorted(map(str, folder.glob("*.csv")))
    dest = str(tmp_path_factory.mktemp("dest"))
    L.load_run(spark, files, dest, raise_on_divergence=True)
    return S.open_snapshot(spark, dest)


def names(df):
    return sorted(map(str, df.select(*[F.col(c).cast("string") for c in df.columns]).collect()))


def test_views_say_what_the_operators_say(spark, held):
    raw, target = (f"{x}_{uuid.uuid4().hex[:8]}" for x in ("raw", "star"))
    assert set(V.raw_tables(spark, held, raw)) >= set(V.RAW)
    made = V.create_views(spark, raw, target)
    assert made.index("fct_orders") < made.index("fct_order_items")
    star = retail.star_schema({t: held.table(t) for t in held.tables})
    assert set(made) == set(star)
    for name, df in star.items():
        view = spark.table(f"{target}.{name}")
        assert [(c, t) for c, t in view.dtypes] == [(c, t) for c, t in df.dtypes], name
        assert names(view) == names(df) and view.count() > 0, name
    # Replaced in place, with other labels; those that read a view follow.
    V.create_views(spark, raw, target, V.Vocabulary(realised=("draft",), channels={"pos": "Shop"}))
    assert "Shop" in {r[0] for r in spark.sql(f"SELECT DISTINCT channel_label FROM {target}.fct_orders").collect()}
    assert {r[0] for r in spark.sql(f"SELECT DISTINCT status FROM {target}.fct_order_items WHERE is_realised").collect()} <= {"draft"}
    V.drop_views(spark, target)
    assert [t.name for t in spark.catalog.listTables(target)] == []
    V.drop_views(spark, target)  # again is fine


def test_registered_query_reads_views_only(spark):
    out = registry.queries()["star_schema_views"](spark, "/root/testdata/sf0.001")
    assert out.count() > 0
