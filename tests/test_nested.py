"""Nested JSON: explode / nest round trip, validated ingest."""
from custvalue.operators import nested as N
from custvalue.schemas import INVOICE


def test_explode_drops_null_and_empty_items(spark):
    rows = [("1", "d", "c", "x", [("A", "a", 1, 1.0), ("B", "b", 2, 2.0)]),
            ("2", "d", "c", "x", []), ("3", "d", "c", "x", None)]
    df = spark.createDataFrame(rows, INVOICE)
    out = N.explode_items(df).collect()
    assert [(r.InvoiceNo, r.StockCode) for r in out] == [("1", "A"), ("1", "B")]


def test_nest_then_explode_round_trip(spark):
    rows = [("1", "d", "c", "x", [("B", "b", 2, 2.0), ("A", "a", 1, 1.0)])]
    lines = N.explode_items(spark.createDataFrame(rows, INVOICE))
    back = N.nest_invoices(lines).first()
    assert [i.StockCode for i in back.Items] == ["A", "B"]   # sorted items


def test_ingest_splits_valid_and_quarantine(spark):
    good = '{"InvoiceNo":"1","InvoiceDate":"2024-01-01 00:00:00","CustomerID":"7","Country":"X",' \
           '"Items":[{"StockCode":"A","Description":"a","Quantity":1,"UnitPrice":1.0}]}'
    no_cust = good.replace('"CustomerID":"7",', "")
    bad_item = good.replace('"Quantity":1,', "")
    wrong_type = good.replace('"Quantity":1', '"Quantity":"many"')
    no_items = good.replace('[{"StockCode":"A","Description":"a","Quantity":1,"UnitPrice":1.0}]', "[]")
    garbage = "{not json"
    raw = spark.createDataFrame([(v,) for v in (good, no_cust, bad_item, wrong_type, no_items, garbage)],
                                "value string")
    valid, bad = N.split_ingest(raw)
    assert [r.InvoiceNo for r in valid.collect()] == ["1"]
    reasons = sorted(r.reason for r in bad.collect())
    # a wrongly typed field marks the record corrupt, like unparseable text
    assert reasons == sorted(["missing CustomerID", "invalid item", "no items", "unparseable",
                              "unparseable"])


def test_parse_json_field_type_mismatch_gives_null(spark):
    raw = spark.createDataFrame([('{"k": "x"}',), ('{"k": 3}',)], "value string")
    assert [r.k for r in N.parse_json(raw, "k int").collect()] == [None, 3]


def test_nest_bounds_a_hot_invoice(spark):
    """An invoice with 3,000 lines and a bound of 500 items per message is
    split into parts; small invoices stay whole; exploding gives back every line."""
    from pyspark.sql import functions as F
    from custvalue.schemas import FLAT_LINE
    hot = [("H", f"S{i}", "d", 1, "2024-01-01 00:00:00", 1.0, "c", "X") for i in range(3000)]
    small = [(f"N{i}", "S", "d", 1, "2024-01-01 00:00:00", 1.0, None if i == 0 else "c", "X")
             for i in range(20)]
    lines = spark.createDataFrame(hot + small, FLAT_LINE).select(
        *N.INVOICE_KEYS, "StockCode", "Description", "Quantity", "UnitPrice")
    nested = N.nest_invoices(lines, max_items=500)
    sizes = {(r.InvoiceNo, r.Part): r.n for r in
             nested.select("InvoiceNo", "Part", F.size("Items").alias("n")).collect()}
    assert sum(n for (k, _), n in sizes.items() if k == "H") == 3000
    assert len([1 for (k, _) in sizes if k == "H"]) == 6
    assert max(n for (k, _), n in sizes.items() if k == "H") < 800
    assert all(p == 0 and n == 1 for (k, p), n in sizes.items() if k != "H")
    assert N.explode_items(nested.drop("Part")).count() == 3020
    assert N.nest_invoices(lines).count() == 21   # default: one message per invoice


def test_large_invoice_is_one_message(spark):
    from pyspark.sql import functions as F
    lines = spark.range(12_000).select(F.lit("H").alias("InvoiceNo"), F.lit("2024-01-01 00:00:00").alias("InvoiceDate"),
                                       F.lit("c").alias("CustomerID"), F.lit("X").alias("Country"),
                                       F.col("id").cast("string").alias("StockCode"), F.lit("d").alias("Description"),
                                       F.lit(1).alias("Quantity"), F.lit(1.0).alias("UnitPrice"))
    nested = N.nest_invoices(lines)
    assert [r.n for r in nested.select(F.size("Items").alias("n")).collect()] == [12_000]
    placed = N.explode_items(nested, "item_pos")
    assert placed.agg(F.count_distinct("item_pos")).first()[0] == 12_000
    assert nested.columns == N.INVOICE_KEYS + ["Items"]


def test_nest_splits_one_repeated_item(spark):
    from custvalue.schemas import FLAT_LINE
    from pyspark.sql import functions as F
    same = spark.range(2500).select(F.lit("H").alias("InvoiceNo"), F.lit("S").alias("StockCode"), F.lit("d").alias("Description"),
                                    F.lit(1).alias("Quantity"), F.lit("2024-01-01 00:00:00").alias("InvoiceDate"),
                                    F.lit(1.0).alias("UnitPrice"), F.lit("c").alias("CustomerID"), F.lit("X").alias("Country"))
    assert same.columns == FLAT_LINE.fieldNames()
    nested = N.nest_invoices(same, max_items=100)
    assert N.explode_items(nested).count() == 2500
    assert nested.count() > 10 and nested.agg(F.max(F.size("Items"))).first()[0] <= 700


def test_json_documents_spread_equal_rows(spark, scratch):
    from custvalue.sources.readers import write_json_array_files
    path = scratch("json") + "/raw"
    write_json_array_files(spark.range(1000).selectExpr("1 as a"), path, rows_per_file=100)
    docs = spark.read.option("multiLine", True).json(path)
    assert docs.count() == 1000 and docs.groupBy("b").count().count() >= 6


def test_json_is_parsed_once_whatever_filters_it(spark):
    from pyspark.sql import functions as F
    raw = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": null}',), ("broken",), (None,)], "value string")
    df = N.parse_json(raw, "a int, b int")
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, 2), (None, None), (None, None), (None, None)], key=str)
    plan = df.filter(F.col("a").isNotNull() & (F.col("b") > 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_json_documents_evaluate_their_rows_once(spark, scratch):
    from pyspark.sql import functions as F
    from custvalue.sources.readers import write_json_array_files
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x
    df = spark.range(200).select(F.udf(look, "long")("id").alias("a"))
    path = scratch("json1") + "/raw"
    write_json_array_files(df, path, rows_per_file=50)
    assert seen.value == 200
    assert spark.read.option("multiLine", True).json(path).agg(F.sum("a"), F.count("a")).first()[:] == (19900, 200)
