"""Cleaning rules on tiny literal frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from custvalue.operators import clean as C
from custvalue.schemas import FLAT_LINE


def lines(spark, rows):
    return spark.createDataFrame(rows, FLAT_LINE)


def test_iso_t_and_plain_dates_parse_bad_dates_dropped(spark):
    df = lines(spark, [
        ("1", "A", "a", 2, "2024-12-10 15:30:00", 1.5, "7", "X"),
        ("2", "A", "a", 2, "2024-12-10T15:30:00", 1.5, "7", "X"),
        ("3", "A", "a", 2, "n/a", 1.5, "7", "X"),
        ("4", "A", "a", 2, None, 1.5, "7", "X"),
    ])
    out = {r.InvoiceNo: r for r in C.clean_lines(df).collect()}
    assert set(out) == {"1", "2"}
    assert out["2"].invoice_ts == dt.datetime(2024, 12, 10, 15, 30)
    assert out["1"].invoice_epoch == 1733844600.0


def test_keep_unparsed_when_asked(spark):
    df = lines(spark, [("3", "A", "a", 2, "n/a", 1.5, "7", "X")])
    out = C.clean_lines(df, drop_unparsed=False).collect()
    assert len(out) == 1 and out[0].invoice_ts is None and out[0].hour is None


def test_quantity_text_truncates(spark):
    df = spark.createDataFrame([("1", "2.9", "2024-01-01 00:00:00", "1.25")],
                               "InvoiceNo string, Quantity string, InvoiceDate string, UnitPrice string")
    df = df.select("InvoiceNo", F.lit("s").alias("StockCode"), F.lit("d").alias("Description"),
                   "Quantity", "InvoiceDate", "UnitPrice", F.lit("c").alias("CustomerID"),
                   F.lit("x").alias("Country"))
    r = C.clean_lines(df).first()
    assert r.Quantity == 2 and r.UnitPrice == 1.25 and r.Revenue == 2.5


def test_weekend_is_friday_and_saturday_by_default(spark):
    # 2024-12-13 is a Friday, 14 Saturday, 15 Sunday
    df = lines(spark, [(str(d), "A", "a", 1, f"2024-12-{d} 10:00:00", 1.0, "7", "X")
                       for d in (12, 13, 14, 15)])
    got = {r.InvoiceNo: (r.dayofweek, r.weekend) for r in C.clean_lines(df).collect()}
    assert got == {"12": (5, 0), "13": (6, 1), "14": (7, 1), "15": (1, 0)}
    sat_sun = {r.InvoiceNo: r.weekend for r in C.clean_lines(df, weekend_days=(7, 1)).collect()}
    assert sat_sun == {"12": 0, "13": 0, "14": 1, "15": 1}


def test_revenue_is_exact(spark):
    df = lines(spark, [("1", "A", "a", 3, "2024-01-01 00:00:00", 0.1, "7", "X")])
    assert C.clean_lines(df).first().Revenue == 0.3   # 3 * 0.1 in double is 0.30000000000000004


def test_fill_then_required_keeps_filled_rows(spark):
    df = lines(spark, [("1", None, "a", None, "2024-01-01 00:00:00", None, None, "X")])
    filled = C.fill_defaults(df).first()
    assert (filled.StockCode, filled.Quantity, filled.UnitPrice, filled.CustomerID) == ("", 0, 0.0, "")
    assert C.required_rows(df).count() == 0
    assert C.required_rows(C.fill_defaults(df)).count() == 1


def test_required_columns_trimmed_and_checked(spark):
    df = spark.createDataFrame([(1, 2)], "` InvoiceNo ` int, `StockCode ` int")
    with pytest.raises(KeyError, match="InvoiceDate"):
        C.check_required_columns(df)
    assert C.check_required_columns(df, ("InvoiceNo", "StockCode")).columns == ["InvoiceNo", "StockCode"]


def test_dedup_is_partitioning_invariant(spark):
    rows = [(str(i), str(i % 5), "d", i, f"2024-01-0{1 + i % 9} 00:00:00", 1.0, str(i % 3), "X")
            for i in range(60)]
    df = C.clean_lines(lines(spark, rows))
    a = sorted(map(tuple, C.dedup_customer(df.repartition(7)).collect()))
    b = sorted(map(tuple, C.dedup_customer(df.repartition(2, "InvoiceNo")).collect()))
    assert a == b and len(a) == 3
    assert {r.CustomerID: r.InvoiceNo for r in C.dedup_customer(df).collect()} == \
        {"0": "0", "1": "1", "2": "11"}   # smallest InvoiceNo as text per customer


def test_notebook_clean(spark):
    df = lines(spark, [("1", "A", "a", 1, "d", 1.0, None, "X"), ("2", "A", "a", -1, "d", 1.0, "7", "X"),
                       ("3", "A", "a", 1, "d", 0.0, "7", "X"), ("4", "A", "a", 1, "d", 2.0, "7", "X")])
    assert [r.InvoiceNo for r in C.notebook_clean(df).collect()] == ["4"]


def test_to_date_or_null(spark):
    from custvalue.functions.columns import to_date_or_null
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("n/a",), (None,)], "s string")
    got = [r.d for r in df.select(to_date_or_null("s").alias("d")).collect()]
    assert [str(d) if d else None for d in got] == ["2024-02-29", None, None, None]


def test_prices_are_neither_cut_nor_fatal(spark):
    rows = [("1", "a", "d", 3, "2024-01-01 10:00:00", 0.00001, "c", "x"), ("2", "a", "d", 1, "2024-01-01 10:00:00", 1e18, "c", "x"),
            ("3", "a", "d", 1, "2024-01-01 10:00:00", float("inf"), "c", "x"), ("4", "a", "d", 2, "2024-01-01 10:00:00", 0.001, "c", "x")]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity int, "
                                     "InvoiceDate string, UnitPrice double, CustomerID string, Country string")
    got = {r.InvoiceNo: r.Revenue for r in C.clean_lines(df).collect()}
    assert got == {"1": 3 * 0.00001, "4": 0.002}
    assert {(r.InvoiceNo, r.reason) for r in C.unclean_lines(df).collect()} == {("2", "invalid price"), ("3", "invalid price")}
    from custvalue.operators import features as FE
    f = FE.customer_features(C.clean_lines(df)).first()
    assert abs(f.total_revenue - 0.00203) < 1e-12
    assert FE.clean_counts(df).first().rows_bad_price == 2
