"""Readers: original column spellings map to snake_case; text is typed
leniently (bad text -> NULL) in the declared schema."""

from __future__ import annotations

import datetime as dt

import pytest

from pos360.operators import quality as q
from pos360.sources.readers import audit_unparseable_dates, normalise_text, read_table
from pos360.sources.schema import ORDERS

CSV = """order_id,Customer_id,product_id,Channel,Delivered_StoreID,Bill_date_timestamp,Quantity,MRP,Cost Per Unit,Discount,Total Amount
o1,7,p1,Online,s1,2020-03-04 10:00:00,2,10.004,6.1,0,20.01
o2,8,p2,Phone,s2,not a date,1,5,3,0.5,4.5
o3,9,p3,Instore,s3,2019-12-31 23:59:59,x,5,3,0,5
"""


def test_csv_orders_reader(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text(CSV)
    df = read_table(spark, "orders", str(p), fmt="csv")
    assert [f.name for f in df.schema.fields] == [f.name for f in ORDERS.fields]
    assert df.schema == ORDERS or [f.dataType for f in df.schema.fields] == [f.dataType for f in ORDERS.fields]
    rows = {r.order_id: r for r in df.collect()}
    assert rows["o1"].bill_date_timestamp == dt.datetime(2020, 3, 4, 10, 0)
    assert rows["o2"].bill_date_timestamp is None  # TRY_CAST semantics
    assert rows["o3"].quantity is None
    assert rows["o1"].line_no is None  # absent column -> NULL
    # The year filter deletes 2020 and keeps the unparseable date.
    kept = {r.order_id for r in q.clean_drop_year(df, q.DEFAULT).collect()}
    assert kept == {"o2", "o3"}


def test_headers_in_any_case(spark, tmp_path):
    p = tmp_path / "orders.csv"
    head, _, body = CSV.partition("\n")
    p.write_text(head.lower().replace("total amount", "TOTAL_amount").replace("delivered_storeid", " Delivered StoreID") + "\n" + body)
    r = read_table(spark, "orders", str(p), fmt="csv").where("order_id = 'o1'").first()
    assert float(r.total_amount) == 20.01 and float(r.cost_per_unit) == 6.1 and r.delivered_store_id == "s1"


def test_missing_and_double_columns_raise(spark, tmp_path):
    p = tmp_path / "products.csv"
    p.write_text("product_id\np1\n")
    with pytest.raises(ValueError, match="category"):
        read_table(spark, "products", str(p), fmt="csv")
    p.write_text("product_id,Category,CATEGORY_\np1,a,b\n")
    with pytest.raises(ValueError, match="both mean"):
        read_table(spark, "products", str(p), fmt="csv")


def test_date_formats_and_their_audit(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text(CSV.replace("2020-03-04 10:00:00", "10/02/2020 14:21"))
    formats = ("dd/MM/yyyy HH:mm",)
    df = read_table(spark, "orders", str(p), fmt="csv", date_formats=formats)
    assert {r.order_id: r.bill_date_timestamp for r in df.collect()}["o1"] == dt.datetime(2020, 2, 10, 14, 21)
    raw = spark.read.csv(str(p), header=True)
    assert tuple(audit_unparseable_dates(raw, "Bill_date_timestamp", formats).first()) == (3, 0, 1)
    assert tuple(audit_unparseable_dates(raw, "Bill_date_timestamp").first()) == (3, 0, 2)


def test_normalise_text_is_opt_in(spark):
    df = spark.createDataFrame([("voucher ", 1), ("UPI", 2), ("other", 3), (None, 4)], "payment_type string, n int")
    out = normalise_text(df, {"payment_type": ["Voucher", "UPI"]})
    assert [r.payment_type for r in out.orderBy("n").collect()] == ["Voucher", "UPI", "other", None]


def test_parameters_cannot_lose_data():
    from pos360.params import DEFAULT, RunParams

    assert (DEFAULT.drop_year, DEFAULT.rfm_as_of, DEFAULT.inactive_as_of) == (2020, dt.date(2023, 12, 31), None)
    with pytest.raises(ValueError):
        RunParams(rfm_tiles=5)


BROKEN = """Customer_id,order_id,product_id,Channel,Delivered_StoreID,Bill_date_timestamp,Quantity,MRP,Cost Per Unit,Discount,Total Amount
1,o1,p1,Online,s1,2021-01-05 10:00:00,2,10.5,7,0,21
1,o2,p1,Online,s1,05/01/2021 11:30,x7,"1,200",7,,21
2,o3,p2,Phone
2,o4,p2,Phone,s2,31/02/2021 08:00,3,9,n/a,0,27
3,o5,p2,Phone,s2,,,,,,,surplus
"""


def test_bad_values_and_lines_are_kept_in_quarantine(spark, tmp_path):
    from pos360.sources.readers import audit_unparseable_values, read_table, read_table_quarantined

    path = str(tmp_path / "orders.csv")
    (tmp_path / "orders.csv").write_text(BROKEN)
    formats = ["dd/MM/yyyy HH:mm"]
    rows, bad = read_table_quarantined(spark, "orders", path, "csv", formats)
    assert sorted((r.order_id, r.quantity, r.mrp) for r in rows.collect()) == [("o1", 2, 10.5), ("o2", None, None), ("o4", 3, 9)]
    got = {r.order_id: (sorted(r.bad_columns), r.bad_line) for r in bad.collect()}
    assert got["o2"] == (["mrp", "quantity"], None) and got["o4"] == (["bill_date_timestamp", "cost_per_unit"], None)
    assert got["o3"] == ([], "2,o3,p2,Phone") and got["o5"][1].endswith("surplus") and len(got) == 4
    assert bad.where("order_id = 'o2'").first()["Quantity"] == "x7"  # as it came
    text = spark.read.options(header="true").csv(path)
    counts = {r.column_name: (r.n_rows, r.n_blank, r.n_unparseable) for r in audit_unparseable_values(text, "orders", formats).collect()}
    assert counts["quantity"] == (5, 2, 1) and counts["mrp"] == (5, 2, 1) and counts["bill_date_timestamp"] == (5, 2, 1)
    assert "order_id" not in counts and counts["discount"] == (5, 3, 0)
    # Typed input needs no cast: nothing to audit, nothing in quarantine.
    typed = str(tmp_path / "typed")
    rows.write.parquet(typed)
    again, none = read_table_quarantined(spark, "orders", typed)
    assert again.count() == 3 and none.count() == 0 and audit_unparseable_values(again, "orders").count() == 0
    assert read_table(spark, "orders", typed).count() == 3
