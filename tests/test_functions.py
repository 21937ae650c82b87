from decimal import Decimal

from pyspark.sql import functions as F

from tillsight.functions.labels import label_of
from tillsight.functions.numeric import half_up_div, mean_half_up, pct_half_up
from tillsight.functions.text import categorise, changed, matched_any_rule, normalise_key


def test_half_up_rounding_is_exact(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 2), (1, 3), (2, 3), (10**17 + 1, 2)],
                               "n long, d long")
    got = [r[0] for r in df.select(half_up_div(F.col("n"), F.col("d"))).collect()]
    assert got == [3, -3, 4, 0, 1, 5 * 10**16 + 1]


def test_percentages_of_huge_money_sums_do_not_overflow(spark):
    # 4e14 currency units: in minor units times the percentage factor this is
    # about 4e19, beyond a 64-bit integer.
    df = spark.createDataFrame([(Decimal("123456789012345.67"), Decimal("400000000000000.00"))],
                               "p decimal(28,2), w decimal(28,2)")
    assert df.select(pct_half_up(F.col("p"), F.col("w"), in_scale=2)).first()[0] == 30.9
    # A mean over 1.5e9 orders of that sum: the cents survive.
    assert df.select(mean_half_up(F.col("w"), F.lit(1_500_000_000))).first()[0] == 266666.67


def test_mean_half_up_matches_sql_round_not_bankers(spark):
    # 0.125 rounds to 0.13 (half away from zero); bround would give 0.12.
    df = spark.createDataFrame([(Decimal("0.25"), 2)], "t decimal(18,2), n long")
    assert df.select(mean_half_up(F.col("t"), F.col("n"))).first()[0] == 0.13
    assert df.select(F.bround(F.lit(0.125), 2)).first()[0] == 0.12


def test_pct_half_up_with_money(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00"))],
                               "p decimal(18,2), w decimal(18,2)")
    assert df.select(pct_half_up(F.col("p"), F.col("w"), in_scale=2)).first()[0] == 33.3


def test_normalise_key_trims_spaces_and_collapses_whitespace(spark):
    df = spark.createDataFrame([("  COMPRA   Duplicada ",), (None,), ("a\t\tb",)], "r string")
    got = [r[0] for r in df.select(normalise_key(F.col("r"))).collect()]
    assert got == ["compra duplicada", "", "a b"]


def test_rules_first_match_wins_and_default_label(spark):
    rows = [("  COMPRA   Duplicada ",), ("?",), ("—",), (None,), ("xyz",),
            ("nao corresponde ao tamanho",), ("Produto ccom defeito de fábrica",)]
    df = spark.createDataFrame(rows, "r string").withColumn("k", normalise_key(F.col("r")))
    out = df.select("r", categorise(F.col("k")).alias("c"),
                    matched_any_rule(F.col("k")).alias("m"),
                    changed(F.col("r"), categorise(F.col("k"))).alias("ch")).collect()
    labels = [r["c"] for r in out]
    assert labels[0] == "Compra duplicada"
    assert labels[1:5] == ["Não informado"] * 4          # T8: unknown shares the label
    assert labels[5] == "Item não corresponde à descrição"  # T7: corresp before tamanho
    assert labels[6] == "Produto com defeito de fábrica"
    assert [r["m"] for r in out][4] is False              # 'xyz' matched no rule
    assert out[3]["ch"] is True                           # T9: null original -> changed


def test_label_of_falls_back_to_value(spark):
    df = spark.createDataFrame([("PF",), ("XX",), (None,)], "t string")
    got = [r[0] for r in df.select(label_of(F.col("t"), {"PF": "Pessoa física"})).collect()]
    assert got == ["Pessoa física", "XX", None]


from decimal import ROUND_HALF_UP  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**6)),
                min_size=20, max_size=100))
def test_half_up_div_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(half_up_div(F.col("n"), F.col("d"))).collect()]
    # With d <= 10**6 a remainder is either exactly a half or at least 1/(2d)
    # away from it, so 28-digit Decimal division decides every case.
    exp = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
           for n, d in pairs]
    assert got == exp


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 5000)),
                min_size=20, max_size=100))
def test_mean_half_up_matches_decimal(spark, pairs):
    rows = [(Decimal(c) / 100, n) for c, n in pairs]
    df = spark.createDataFrame(rows, "t decimal(18,2), n long")
    got = [r[0] for r in df.select(mean_half_up(F.col("t"), F.col("n"))).collect()]
    exp = [float((t / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for t, n in rows]
    assert got == exp
