from decimal import Decimal

from tillsight.operators import stated


def test_item_order_reconcile_statuses(spark):
    orders = spark.createDataFrame(
        [(1, Decimal("10.00")), (2, Decimal("5.00")), (3, Decimal("7.00"))],
        "id long, subtotal decimal(8,2)")
    items = spark.createDataFrame(
        [(1, Decimal("4.00")), (1, Decimal("6.00")), (2, Decimal("4.00")), (9, Decimal("1.00"))],
        "order_id long, line_total decimal(7,2)")
    rows = {r["status"]: r for r in stated.item_order_reconcile(items, orders).collect()}
    assert rows["match"]["orders"] == 1
    assert rows["mismatch"]["abs_difference"] == Decimal("1.00")
    assert rows["order_without_items"]["orders"] == 1
    assert rows["items_without_order"]["orders"] == 1


def test_revenue_summary_shares(spark):
    f = spark.createDataFrame(
        [(True, Decimal("80.00"), Decimal("1.00")), (True, Decimal("20.00"), Decimal("0.00")),
         (False, Decimal("25.00"), Decimal("0.00"))],
        "is_realised boolean, total decimal(8,2), discount_amount decimal(7,2)")
    r = stated.revenue_summary(f).first()
    assert (r["orders_all"], r["orders_realised"]) == (3, 2)
    assert r["revenue_realised"] == Decimal("100.00") and r["avg_ticket_realised"] == 50.0
    assert r["unrealised_share_pct"] == 20.0 and r["overstatement_pct"] == 25.0
