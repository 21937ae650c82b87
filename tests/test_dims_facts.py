import datetime as dt
from decimal import Decimal

from tillsight.operators import dims, facts, segment


def test_customer_dim_keeps_customers_without_primary_address(spark):
    cust = spark.createDataFrame(
        [(1, "PF", "Ana", None, "1", "a@x", True, dt.datetime(2024, 1, 1)),
         (2, "PJ", "Acme Ltda", "Acme", "2", None, True, dt.datetime(2024, 2, 1))],
        "id long, person_type string, legal_name string, trade_name string, tax_id string, "
        "email string, is_active boolean, created_at timestamp_ntz")
    addr = spark.createDataFrame(
        [(1, True, "Recife", "PE", "50000"), (1, False, "Olinda", "PE", "53000"),
         (2, False, "Natal", "RN", "59000")],
        "customer_id long, is_primary boolean, city string, state string, postal_code string")
    rows = {r["customer_id"]: r for r in dims.customer_dim(cust, addr).collect()}
    assert len(rows) == 2
    assert rows[1]["city"] == "Recife" and rows[1]["customer"] == "Ana"
    assert rows[2]["city"] is None and rows[2]["customer"] == "Acme"
    assert rows[2]["person_type_label"] == "Pessoa jurídica"
    assert rows[1]["signup_date"] == dt.date(2024, 1, 1)


def test_product_dim_repairs_only_all_caps(spark):
    v = spark.createDataFrame([(10, 1, "S", None, Decimal("9.00"), Decimal("4.00"),
                                Decimal("1.000"), True),
                               (11, 2, "T", "0123", Decimal("5.00"), Decimal("5.00"),
                                Decimal("1.000"), True)],
                              "id long, product_id long, sku string, barcode_ean string, "
                              "sale_price decimal(6,2), cost_price decimal(6,2), "
                              "weight_kg decimal(5,3), is_active boolean")
    p = spark.createDataFrame([(1, "Boia", 1, 7, "n", "UN", True), (2, "Remo", 1, 8, "n", "UN", True)],
                              "id long, name string, brand_id long, category_id long, "
                              "ncm_code string, unit_of_measure string, is_active boolean")
    c = spark.createDataFrame([(7, "SEGURANÇA", 9), (8, "Remos e Acessórios", 9), (9, "Náutica", None)],
                              "id long, name string, parent_category_id long")
    b = spark.createDataFrame([(1, "Mar", "BR")], "id long, name string, country string")
    rows = {r["variant_id"]: r for r in dims.product_dim(v, p, c, b).collect()}
    assert rows[10]["category"] == "Segurança" and rows[10]["category_original"] == "SEGURANÇA"
    assert rows[11]["category"] == "Remos e Acessórios"
    assert rows[10]["parent_category"] == "Náutica" and rows[10]["gross_margin"] == Decimal("5.00")


def test_employee_dim_adds_unknown_member(spark):
    e = spark.createDataFrame([(1, "Bia", "seller", 3, dt.date(2020, 1, 1), True)],
                              "id long, full_name string, role string, primary_location_id int, "
                              "hire_date date, is_active boolean")
    rows = {r["employee_id"]: r for r in dims.employee_dim(e).collect()}
    assert rows[-1]["employee"] == "Sem vendedor" and rows[-1]["location_id"] is None
    assert len(rows) == 2


def test_return_fact_through_item_key(spark):
    orders = spark.createDataFrame([(100, 5, "pos", "paid")],
                                   "id long, customer_id long, channel string, status string")
    items = spark.createDataFrame([(1000, 100, 77)], "id long, order_id long, product_variant_id long")
    rets = spark.createDataFrame(
        [(1, "R1", 5, 2, "done", "  COMPRA   Duplicada ", dt.datetime(2024, 3, 1, 10)),
         (2, "R2", 5, 2, "done", None, dt.datetime(2024, 3, 2, 10))],
        "id long, return_number string, customer_id long, received_at_location_id long, "
        "status string, reason string, created_at timestamp_ntz")
    ri = spark.createDataFrame([(1, 1, 1000, "refund", Decimal("2.000"), Decimal("3.50")),
                                (2, 2, 1000, "exchange", Decimal("1.000"), Decimal("1.00"))],
                               "id long, return_id long, order_item_id long, action string, "
                               "quantity decimal(5,3), unit_refund_amount decimal(6,2)")
    out = {r["return_item_id"]: r for r in
           facts.return_fact(ri, rets, orders, order_items=items).collect()}
    assert out[1]["refund_value"] == Decimal("7.00000") and out[1]["variant_id"] == 77
    assert out[1]["reason"] == "Compra duplicada" and out[1]["reason_changed"] is True
    assert out[2]["reason"] == "Não informado" and out[2]["action_label"] == "Troca"
    assert out[1]["date"] == dt.date(2024, 3, 1)


def _seg_frames(spark):
    orders = spark.createDataFrame(
        [(1, 10, Decimal("10.004")), (2, 11, Decimal("10.001")), (3, 12, Decimal("50.00")),
         (4, 12, Decimal("50.00"))],
        "id long, customer_id long, total decimal(8,3)")
    items = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 1), (1, 3, 1), (2, 1, 1), (2, 2, 1), (3, 1, 2), (3, 2, 2), (3, 3, 2),
         (4, 1, 1)],
        "order_id long, product_variant_id long, quantity int")
    variants = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id long, product_id long")
    products = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "id long, category_id long")
    cats = spark.createDataFrame([(100, "A"), (200, "B"), (300, "C")], "id long, name string")
    return orders, items, variants, products, cats


def test_segmentation_avoids_fan_out(spark):
    # Customer 12 has two orders with 3 and 1 items; revenue stays 100.
    o, i, v, p, _ = _seg_frames(spark)
    rows = {r["customer_id"]: r for r in
            segment.elite_customers(o, i, v, p, min_categories=1, n=10).collect()}
    assert rows[12]["revenue"] == Decimal("100.000") and rows[12]["frequency"] == 2
    assert rows[12]["category_diversity"] == 3
    naive = o.join(i, o.id == i.order_id).groupBy("customer_id").sum("total")
    assert {r[0]: r[1] for r in naive.collect()}[12] > Decimal("100")


def test_rounded_and_unrounded_rankings_differ_on_ties(spark):
    # Tickets 10.004 and 10.001 both round to 10.00; the rounded ranking
    # breaks the tie by id (10 first) while the unrounded one also has 10.004 first.
    o, i, v, p, c = _seg_frames(spark)
    top = segment.elite_customers(o, i, v, p, min_categories=2, n=2).collect()
    assert [r["customer_id"] for r in top] == [12, 10]
    o2 = o.filter("customer_id != 12")
    top_r = segment.elite_customers(o2, i, v, p, min_categories=2, n=1).collect()
    assert top_r[0]["customer_id"] == 10 and top_r[0]["ticket"] == 10.0
    o3 = o2.replace(10, 13, subset=["customer_id"])  # the 10.004 customer now has id 13
    rounded = segment.elite_customers(o3, i, v, p, min_categories=2, n=1).first()["customer_id"]
    mix_unrounded = segment.elite_category_mix(o3, i, v, p, c, min_categories=2, n=1)
    mix_rounded = segment.elite_category_mix(o3, i, v, p, c, min_categories=2, n=1,
                                             rank_by_rounded=True)
    assert rounded == 11
    assert {r["category"] for r in mix_rounded.collect()} == {"A", "B"}
    assert {r["category"] for r in mix_unrounded.collect()} == {"A", "B", "C"}


def test_location_dim_keeps_all_types(spark):
    loc = spark.createDataFrame(
        [(1, "Loja Centro", "store", "Recife", "PE", "50000", True),
         (2, "CD Norte", "warehouse", "Natal", "RN", "59000", True),
         (3, "Quiosque", "kiosk", "Olinda", "PE", "53000", False)],
        "id int, name string, location_type string, city string, state string, "
        "postal_code string, is_active boolean")
    rows = {r["location_id"]: r for r in dims.location_dim(loc).collect()}
    assert len(rows) == 3                      # nothing filtered
    assert rows[1]["type_label"] == "Loja" and rows[2]["type_label"] == "Armazém"
    assert rows[3]["type_label"] == "kiosk"    # unknown type passes through


def test_order_fact_labels_and_unknown_employee(spark):
    import datetime as dt
    from decimal import Decimal
    o = spark.createDataFrame(
        [(1, "A1", "pos", 5, 9, 2, "paid", Decimal("10.00"), dt.datetime(2024, 1, 1, 23, 59)),
         (2, "A2", "ecommerce", 6, None, 3, "draft", Decimal("5.00"), dt.datetime(2024, 1, 2, 0, 1))],
        "id long, order_number string, channel string, customer_id long, salesperson_id long, "
        "location_id int, status string, total decimal(8,2), placed_at timestamp_ntz")
    rows = {r["order_id"]: r for r in facts.order_fact(o).collect()}
    assert rows[1]["channel_label"] == "Loja física" and rows[1]["is_realised"] is True
    assert rows[2]["employee_id"] == -1 and rows[2]["status_label"] == "Rascunho"
    assert rows[2]["is_realised"] is False and rows[1]["date"] == dt.date(2024, 1, 1)


def test_null_ticket_ranks_first_as_in_postgresql(spark):
    # A customer whose totals are all null has a null ticket; PostgreSQL
    # puts it first in a descending order.
    o = spark.createDataFrame([(1, 10, Decimal("5.00")), (2, 11, None), (3, 12, Decimal("9.00"))],
                              "id long, customer_id long, total decimal(8,2)")
    i = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 1)],
                              "order_id long, product_variant_id long, quantity int")
    v = spark.createDataFrame([(1, 1)], "id long, product_id long")
    p = spark.createDataFrame([(1, 100)], "id long, category_id long")
    top = segment.elite_customers(o, i, v, p, min_categories=1, n=3).collect()
    assert [r["customer_id"] for r in top] == [11, 12, 10]
