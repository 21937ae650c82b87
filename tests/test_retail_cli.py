"""End to end on CSV files shaped like the reference's source tables:
load (infer, validate, reconcile, publish), then every report."""

import os

from pyspark.sql import functions as F

from tillsight.__main__ import main


def _csv(folder, name, header, rows):
    with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(",".join("" if x is None else str(x) for x in r) + "\n")


def _write_sources(folder):
    ts = "2025-01-01 08:00:00"
    _csv(folder, "brands", "id,name,country,is_active,created_at,updated_at",
         [(1, "Mar Azul", "BR", "T", ts, ts), (2, "Vento", None, "F", ts, ts)])
    cats = [(i, f"Categoria {i}", f"cat-{i}", None, "T", ts, ts) for i in range(1, 15)]
    cats[0] = (1, "SEGURANÇA", "seguranca", None, "T", ts, ts)
    _csv(folder, "categories", "id,name,slug,parent_category_id,is_active,created_at,updated_at", cats)
    prods = [(i, f"Produto {i}", None, 1 + i % 2, 1 + (i - 1) % 14, f"0{8900000 + i}", "UN", "T", ts, ts)
             for i in range(1, 29)]
    prods[0] = (1, "Bússola de Bordo 702", None, 1, 1, "08901", "UN", "T", ts, ts)
    prods[1] = (2, "Bússola de Bordo 702", None, 2, 2, "08902", "UN", "T", ts, ts)
    prods[2] = (3, "Motor de Popa 1949", None, 1, 3, "08903", "UN", "T", ts, ts)
    _csv(folder, "products", "id,name,description,brand_id,category_id,ncm_code,unit_of_measure,"
         "is_active,created_at,updated_at", prods)
    _csv(folder, "product_variants", "id,product_id,sku,barcode_ean,sale_price,cost_price,weight_kg,"
         "icms_rate,ipi_rate,is_active,created_at,updated_at",
         [(100 + i, i, f"SKU{i}", f"0{7890000000000 + i}", f"{10 + i}.90", f"{5 + i}.10", "1.250",
           "18.00", "5.00", "T", ts, ts) for i in range(1, 29)])
    _csv(folder, "customers", "id,person_type,legal_name,trade_name,tax_id,state_registration,email,"
         "phone,is_active,created_at,updated_at",
         [(c, "PF" if c % 2 else "PJ", f"Cliente {c}", None if c % 2 else f"Loja {c}",
           f"0{c:010d}", None, f"c{c}@x.br", None, "T", ts, ts) for c in range(1, 7)])
    _csv(folder, "addresses", "id,customer_id,address_type,postal_code,street,number,complement,"
         "district,city,state,country,is_primary",
         [(a, 1 + (a - 1) // 2, "home", "01000-000", "Rua A", "10", None, "Centro",
           "Recife" if a % 2 else "Olinda", "PE", "BR", "T" if a % 2 else "F") for a in range(1, 13)])
    _csv(folder, "locations", "id,name,location_type,postal_code,street,number,complement,district,"
         "city,state,country,is_active,created_at,updated_at",
         [(1, "Loja", "store", "50000", "Rua", "1", None, "C", "Recife", "PE", "BR", "T", ts, ts),
          (2, "CD", "warehouse", "50001", "Rua", "2", None, "C", "Recife", "PE", "BR", "T", ts, ts)])
    _csv(folder, "employees", "id,full_name,cpf,email,role,primary_location_id,hire_date,"
         "termination_date,is_active,created_at,updated_at",
         [(1, "Bia", "01234567890", "b@x.br", "seller", 1, "2020-02-03", None, "T", ts, ts)])
    orders, items = [], []
    item_id = 0
    months = ["2025-09", "2025-10", "2025-11", "2025-12", "2026-01", "2026-02"]
    for o in range(1, 61):
        month = months[o % len(months)]
        day = 1 + o % 27
        placed = f"{month}-{day:02d} 1{o % 10}:00:00"
        channel = "pos" if o % 3 else "ecommerce"
        status = ["paid", "confirmed", "cancelled", "draft"][o % 4]
        lines = []
        for k in range(1 + o % 16):
            item_id += 1
            variant = 101 + (o * 7 + k) % 28
            qty = 1 + (o + k) % 3
            lines.append((item_id, o, variant, qty, "12.50", "18.00", "5.00", f"{qty * 12.5:.2f}"))
        subtotal = sum(float(x[7]) for x in lines)
        orders.append((o, f"PED{o:06d}", channel, 1 + o % 6, 1 if channel == "pos" else None,
                       1 + o % 2, status, f"{subtotal:.2f}", "0.00", f"{subtotal:.2f}",
                       placed, placed, placed))
        items.extend(lines)
    _csv(folder, "orders", "id,order_number,channel,customer_id,salesperson_id,location_id,status,"
         "subtotal,discount_amount,total,placed_at,created_at,updated_at", orders)
    _csv(folder, "order_items", "id,order_id,product_variant_id,quantity,unit_price,icms_rate,"
         "ipi_rate,line_total", items)
    _csv(folder, "returns", "id,return_number,order_id,customer_id,received_at_location_id,status,"
         "reason,total_refund_amount,created_at,updated_at",
         [(1, "DEV1", 1, 2, 1, "done", '"  COMPRA   Duplicada "', "12.50", "2026-03-05 10:00:00", ts),
          (2, "DEV2", 2, 3, 2, "done", None, "12.50", "2026-03-06 10:00:00", ts)])
    _csv(folder, "return_items", "id,return_id,order_item_id,quantity,action,exchange_variant_id,"
         "unit_refund_amount", [(1, 1, 1, "1.000", "refund", None, "12.50"),
                                (2, 2, 3, "2.000", "exchange", 105, "12.50")])


def test_load_then_reports(spark, scratch):
    src = os.path.join(scratch, "raw_csv")
    os.makedirs(src)
    _write_sources(src)
    dest, out = os.path.join(scratch, "raw"), os.path.join(scratch, "reports")
    assert main(["load", "--input", src, "--dest", dest]) == 0
    assert main(["report", "--dest", dest, "--out", out, "--as-of", "2026-01-01"]) == 0
    read = lambda n: spark.read.parquet(os.path.join(out, n))
    assert read("weekday_sales").count() == 7
    cal = read("dim_calendar")
    assert cal.agg(F.max("date")).first()[0].isoformat() == "2026-03-06"   # returns widen it
    prod = {r["variant_id"]: r for r in read("dim_product").collect()}
    assert prod[101]["category"] == "Segurança" and prod[101]["category_original"] == "SEGURANÇA"
    ret = {r["return_id"]: r for r in read("fct_returns").collect()}
    assert ret[1]["reason"] == "Compra duplicada" and ret[2]["reason"] == "Não informado"
    fc = read("demand_forecast").orderBy("month").collect()
    assert [str(r["month"]) for r in fc] == ["2026-01-01", "2026-02-01", "2026-03-01"]
    assert len({r["forecast"] for r in fc}) == 1
    sim = read("similar_products").collect()
    assert 0 < len(sim) <= 5 and all(r["product_id"] != 3 for r in sim)
    assert read("elite_customers").count() <= 10
    assert read("orders_integrity").first()["duplicate_ids"] == 0
    emp = {r["employee_id"] for r in read("dim_employee").collect()}
    assert emp == {-1, 1}
