"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

Each entry is a complete statement over the driver's pre-registered views
(``lineitem``, ``orders``, ``customer``, ``nation``, ``part``, ``events``).
The fixture views are rebuilt here in SQL, never derived from Spark.
"""

from __future__ import annotations

REF_DATE = "2001-12-31"          # reference date of feature t in the checks
SPLIT_DATE = "2000-01-01"        # label period start for features_target_split
LATE_CUTS, LATE_MODULUS = ("1996-01-01", SPLIT_DATE), 11   # batches of the window stream with late invoices
SNAPSHOT_CUTOFF = "2024-01-15 00:00:00"

INVOICE_LINES = """
invoice_lines AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         p.p_name AS Description,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER) AS Quantity,
         strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
         p.p_retailprice AS UnitPrice,
         CAST(o.o_custkey AS VARCHAR) AS CustomerID,
         n.n_name AS Country,
         l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

DIRTY_LINES = """
dirty_lines AS (
  SELECT InvoiceNo, StockCode, Description,
         CASE WHEN l_orderkey % 97 = 1 THEN NULL ELSE Quantity END AS Quantity,
         CASE WHEN l_orderkey % 97 = 2 THEN replace(InvoiceDate, ' ', 'T')
              WHEN l_orderkey % 97 = 3 THEN 'n/a' ELSE InvoiceDate END AS InvoiceDate,
         CASE WHEN l_orderkey % 97 = 4 THEN 0.0 ELSE UnitPrice END AS UnitPrice,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CustomerID END AS CustomerID,
         Country, l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM invoice_lines)"""


def clean_cte(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID, Country,
         invoice_ts,
         CAST(epoch(invoice_ts) AS DOUBLE) AS invoice_epoch,
         CAST(hour(invoice_ts) AS INTEGER) AS hour,
         CAST(dayofweek(invoice_ts) + 1 AS INTEGER) AS dayofweek,
         CASE WHEN dayofweek(invoice_ts) + 1 IN (6, 7) THEN 1 ELSE 0 END AS weekend,
         CAST(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4)) AS DOUBLE) AS Revenue,
         l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM (
    SELECT InvoiceNo, StockCode, Description,
           CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS INTEGER) AS Quantity,
           TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country,
           try_strptime(regexp_replace(replace(InvoiceDate, 'T', ' '), '[^0-9\\-: ]', '', 'g'),
                        '%Y-%m-%d %H:%M:%S') AS invoice_ts,
           l_orderkey, l_partkey, l_suppkey, l_linenumber
    FROM {src}
    WHERE InvoiceDate IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL)
  WHERE invoice_ts IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL)"""


BASE = "WITH" + INVOICE_LINES + "," + DIRTY_LINES + "," + clean_cte("lines", "invoice_lines") \
    + "," + clean_cte("dirty_clean", "dirty_lines")

CLEAN_COLS = ("InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID, Country, "
              "invoice_ts, invoice_epoch, hour, dayofweek, weekend, Revenue")


def features_cte(name: str, src: str, ref_date: str = REF_DATE) -> str:
    return f"""
{name}_parts AS (
  SELECT CustomerID,
         SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS rev,
         MIN(CAST(invoice_ts AS DATE)) AS first_d,
         MAX(CAST(invoice_ts AS DATE)) AS last_d,
         COUNT(InvoiceNo) AS frequency,
         SUM(Quantity) AS qty,
         COUNT(CASE WHEN Revenue < 0 THEN InvoiceNo END) AS num_returns,
         quantile_disc(hour, 0.5) AS purchase_hour_med,
         quantile_disc(dayofweek, 0.5) AS purchase_dow_med,
         SUM(weekend) AS wkd,
         COUNT(*) AS n
  FROM {src} WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
{name} AS (
  SELECT CustomerID,
         CAST(rev AS DOUBLE) AS total_revenue,
         CAST(date_diff('day', first_d, last_d) AS INTEGER) AS recency,
         frequency,
         CAST(date_diff('day', first_d, DATE '{ref_date}') AS INTEGER) AS t,
         CAST(date_diff('day', first_d, DATE '{ref_date}') AS DOUBLE) / CAST(frequency AS DOUBLE) AS time_between,
         CAST(rev AS DOUBLE) / CAST(frequency AS DOUBLE) AS avg_basket_value,
         CAST(qty AS DOUBLE) / CAST(frequency AS DOUBLE) AS avg_basket_size,
         num_returns,
         purchase_hour_med,
         purchase_dow_med,
         CAST(wkd AS DOUBLE) / CAST(n AS DOUBLE) AS purchase_weekend_prop
  FROM {name}_parts)"""


FEATURE_COLS = ("CustomerID, total_revenue, recency, frequency, t, time_between, "
                "avg_basket_value, avg_basket_size, num_returns, purchase_hour_med, "
                "purchase_dow_med, purchase_weekend_prop")

SQL: dict[str, str] = {}

SQL["clean_lines"] = BASE + f"\nSELECT {CLEAN_COLS} FROM dirty_clean"

SQL["cust_features"] = BASE + "," + features_cte("feats", "lines") + \
    f"\nSELECT {FEATURE_COLS} FROM feats"

LINE_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
FEATS = BASE + "," + features_cte("feats", "lines")


def _ts_from_epoch(e: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST({e} AS BIGINT)))"


def _parse(c: str) -> str:
    return (f"try_strptime(regexp_replace(replace({c}, 'T', ' '), '[^0-9\\-: ]', '', 'g'), "
            f"'%Y-%m-%d %H:%M:%S')")


SQL["time_parts"] = BASE + f"""
SELECT InvoiceNo, StockCode, InvoiceDate,
       CAST(hour(ts) AS INTEGER) AS hour,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek,
       CASE WHEN dayofweek(ts) + 1 IN (6, 7) THEN 1 ELSE 0 END AS weekend
FROM (SELECT *, {_parse('InvoiceDate')} AS ts FROM invoice_lines)"""

SQL["required_rows"] = BASE + f"""
SELECT {LINE_COLS} FROM dirty_lines
WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Description IS NOT NULL
  AND Quantity IS NOT NULL AND InvoiceDate IS NOT NULL AND UnitPrice IS NOT NULL
  AND CustomerID IS NOT NULL AND Country IS NOT NULL"""

SQL["fill_defaults"] = BASE + """
SELECT InvoiceNo, coalesce(StockCode, '') AS StockCode, coalesce(Description, '') AS Description,
       coalesce(Quantity, 0) AS Quantity, coalesce(InvoiceDate, '') AS InvoiceDate,
       coalesce(UnitPrice, 0.0) AS UnitPrice, coalesce(CustomerID, '') AS CustomerID,
       coalesce(Country, '') AS Country
FROM dirty_lines"""

SQL["epoch_roundtrip"] = BASE + f"""
SELECT InvoiceNo, StockCode, invoice_epoch, {_ts_from_epoch('invoice_epoch')} AS restored_ts,
       strftime({_ts_from_epoch('invoice_epoch')}, '%Y-%m-%dT%H:%M:%S') AS iso_text
FROM dirty_clean"""

SQL["dedup_customer"] = BASE + f"""
SELECT {CLEAN_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY
      InvoiceNo, StockCode, Description, Quantity, UnitPrice, Country, invoice_ts,
      invoice_epoch, hour, dayofweek, weekend, Revenue) AS rn
  FROM lines WHERE CustomerID IS NOT NULL) WHERE rn = 1"""

SQL["notebook_clean"] = BASE + f"""
SELECT {LINE_COLS} FROM dirty_lines
WHERE CustomerID IS NOT NULL AND UnitPrice > 0 AND Quantity > 0"""

SQL["normalise_lines"] = BASE + f"""
SELECT InvoiceNo, StockCode, Description,
       CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS INTEGER) AS Quantity,
       strftime({_parse('InvoiceDate')}, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
       TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country
FROM dirty_lines
WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Description IS NOT NULL
  AND Quantity IS NOT NULL AND InvoiceDate IS NOT NULL AND UnitPrice IS NOT NULL
  AND CustomerID IS NOT NULL AND Country IS NOT NULL"""

SQL["explode_items"] = BASE + """
SELECT InvoiceNo, InvoiceDate, CustomerID, Country, StockCode, Description, Quantity, UnitPrice
FROM invoice_lines"""

SQL["json_parse"] = """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""

SQL["nest_invoices"] = BASE + """
SELECT InvoiceNo, InvoiceDate, CustomerID, Country, CAST(COUNT(*) AS INTEGER) AS n_items,
       CAST(SUM(Quantity) AS BIGINT) AS total_qty,
       string_agg(StockCode, ',' ORDER BY StockCode, Description, Quantity, UnitPrice) AS stock_codes
FROM invoice_lines GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country"""

SQL["to_json_events"] = BASE + """
SELECT InvoiceNo AS key,
       to_json({'InvoiceNo': InvoiceNo, 'InvoiceDate': InvoiceDate, 'CustomerID': CustomerID,
                'Country': Country,
                'Items': list({'StockCode': StockCode, 'Description': Description,
                               'Quantity': Quantity, 'UnitPrice': UnitPrice}
                              ORDER BY StockCode, Description, Quantity, UnitPrice)})::VARCHAR AS value
FROM invoice_lines GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country"""

_INGEST = BASE + """,
inv AS (
  SELECT InvoiceNo, InvoiceDate, CustomerID, Country, COUNT(*) AS n,
         COUNT(Quantity) AS n_q, COUNT(StockCode) AS n_s, COUNT(Description) AS n_d,
         COUNT(UnitPrice) AS n_p
  FROM dirty_lines GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country),
marked AS (
  SELECT *, (InvoiceNo IS NOT NULL AND InvoiceDate IS NOT NULL AND CustomerID IS NOT NULL
             AND Country IS NOT NULL AND n_q = n AND n_s = n AND n_d = n AND n_p = n) AS ok
  FROM inv)"""

SQL["ingest_valid"] = _INGEST + """
SELECT InvoiceNo, InvoiceDate, CustomerID, Country, CAST(n AS INTEGER) AS n_items
FROM marked WHERE ok"""

SQL["ingest_quarantine"] = _INGEST + """
SELECT InvoiceNo,
       CASE WHEN CustomerID IS NULL THEN 'missing CustomerID'
            WHEN InvoiceDate IS NULL THEN 'missing InvoiceDate'
            ELSE 'invalid item' END AS reason
FROM marked WHERE NOT ok"""

SQL["cust_medians"] = BASE + """
SELECT CustomerID, quantile_disc(hour, 0.5) AS purchase_hour_med,
       quantile_disc(dayofweek, 0.5) AS purchase_dow_med
FROM lines WHERE CustomerID IS NOT NULL GROUP BY CustomerID"""

SQL["cust_invoice_frequency"] = BASE + """
SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS frequency_invoices,
       CAST(COUNT(*) AS BIGINT) AS frequency_lines
FROM lines WHERE CustomerID IS NOT NULL AND InvoiceNo IS NOT NULL GROUP BY CustomerID"""

SQL["returns"] = BASE + """
SELECT CustomerID, COUNT(InvoiceNo) AS num_returns
FROM lines WHERE Revenue < 0 AND CustomerID IS NOT NULL GROUP BY CustomerID"""

SQL["features_by_joins"] = FEATS + f"\nSELECT {FEATURE_COLS} FROM feats"

SQL["target_rev"] = FEATS + f"\nSELECT {FEATURE_COLS}, total_revenue AS target_rev FROM feats"

SQL["features_target_split"] = BASE + """,
early AS (SELECT * FROM lines WHERE invoice_ts < TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),
late AS (SELECT * FROM lines WHERE invoice_ts >= TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),""" \
    + features_cte("feats", "early") + """,
target AS (
  SELECT CustomerID,
         CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS target_rev
  FROM late WHERE CustomerID IS NOT NULL GROUP BY CustomerID)
SELECT f.CustomerID, total_revenue, recency, frequency, t, time_between, avg_basket_value,
       avg_basket_size, num_returns, purchase_hour_med, purchase_dow_med, purchase_weekend_prop,
       coalesce(target_rev, 0.0) AS target_rev
FROM feats f LEFT JOIN target g ON f.CustomerID = g.CustomerID"""

SQL["invoice_totals"] = BASE + """
SELECT InvoiceNo,
       CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS TotalValue
FROM lines GROUP BY InvoiceNo"""

SQL["null_profile"] = BASE + "\nSELECT " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in LINE_COLS.split(", ")) \
    + " FROM dirty_lines"


def _describe(c: str) -> str:
    quarters = ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q / 100}), 6) AS q{q}" for q in (25, 50, 75))
    return f"""
SELECT '{c}' AS "column", COUNT({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, {quarters},
       CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max
FROM lines"""


SQL["describe_lines"] = BASE + "\n" + "\nUNION ALL".join(
    _describe(c) for c in ("Quantity", "UnitPrice", "Revenue"))

SQL["clean_counts"] = BASE + f""",
flags AS (
  SELECT (InvoiceDate IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL) AS complete,
         {_parse('InvoiceDate')} IS NOT NULL AS parsed,
         CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS INTEGER) IS NOT NULL AS qty_ok,
         coalesce(abs(UnitPrice) < 1e9 AND abs(Quantity * UnitPrice) < 1e14, false) AS money,
         coalesce(CustomerID IS NOT NULL AND UnitPrice > 0 AND Quantity > 0, false) AS nb
  FROM dirty_lines)
SELECT COUNT(*) AS rows_in, count_if(complete) AS rows_complete,
       count_if(complete AND NOT parsed) AS rows_bad_date,
       count_if(complete AND parsed AND qty_ok AND NOT money) AS rows_bad_price,
       count_if(complete AND parsed AND qty_ok AND money) AS rows_clean,
       count_if(nb) AS rows_notebook
FROM flags"""

_BUCKET = "(('0x' || substr(md5({k}), 1, 4))::INTEGER % 100)"

SQL["train_test_split"] = FEATS + f"""
SELECT CustomerID, {_BUCKET.format(k='CustomerID')} AS bucket,
       CASE WHEN {_BUCKET.format(k='CustomerID')} < 80 THEN 'train' ELSE 'test' END AS split
FROM feats"""

SERIES = BASE + """,
series AS (
  SELECT InvoiceNo,
         CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS TotalValue
  FROM lines WHERE CustomerID IS NOT NULL AND UnitPrice > 0 AND Quantity > 0
  GROUP BY InvoiceNo),
ranked AS (
  SELECT InvoiceNo, TotalValue, row_number() OVER (ORDER BY InvoiceNo) - 1 AS pos,
         COUNT(*) OVER () AS n FROM series),
bounds AS (
  SELECT *, CAST(floor(n * 0.6) AS BIGINT) AS n_train, CAST(floor(n * 0.2) AS BIGINT) AS n_val
  FROM ranked),
split_series AS (
  SELECT InvoiceNo, TotalValue, pos,
         CASE WHEN pos < n_train THEN 'train' WHEN pos < n_train + n_val THEN 'val' ELSE 'test' END AS split,
         pos - CASE WHEN pos < n_train THEN 0 WHEN pos < n_train + n_val THEN n_train
                    ELSE n_train + n_val END AS split_pos
  FROM bounds)"""

SQL["hash_sample"] = SERIES + """
SELECT InvoiceNo, TotalValue FROM series ORDER BY md5(InvoiceNo), InvoiceNo LIMIT 10000"""

SQL["series_split"] = SERIES + "\nSELECT InvoiceNo, TotalValue, pos, split, split_pos FROM split_series"

SQL["series_windows"] = SERIES + """
SELECT a.split, a.split_pos AS t, a.TotalValue AS x0, b.TotalValue AS x1, c.TotalValue AS y
FROM split_series a
JOIN split_series b ON b.split = a.split AND b.split_pos = a.split_pos + 1
JOIN split_series c ON c.split = a.split AND c.split_pos = a.split_pos + 2"""

SQL["minmax_scale"] = SERIES + """,
mm AS (SELECT MIN(TotalValue) AS lo, MAX(TotalValue) AS hi FROM split_series WHERE split = 'train')
SELECT InvoiceNo, split, (TotalValue - lo) / (hi - lo) AS scaled FROM split_series, mm"""


def _score_sql() -> str:
    from ..operators.scoring import SCORE_WEIGHTS
    expr = None
    for name, w in SCORE_WEIGHTS:
        term = f"(CAST({w!r} AS DOUBLE) * CAST({name} AS DOUBLE))"
        expr = term if expr is None else f"({expr} + {term})"
    return expr


SCORE = _score_sql()

SPLIT_FEATURES = BASE + """,
early AS (SELECT * FROM lines WHERE invoice_ts < TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),
late AS (SELECT * FROM lines WHERE invoice_ts >= TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),""" \
    + features_cte("feats", "early") + """,
target AS (
  SELECT CustomerID,
         CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS target_rev
  FROM late WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
ft AS (SELECT f.*, coalesce(target_rev, 0.0) AS target_rev
       FROM feats f LEFT JOIN target g ON f.CustomerID = g.CustomerID)"""

SQL["regression_metrics"] = SPLIT_FEATURES + f"""
SELECT n, CAST(sae AS DOUBLE) / (CAST(n AS DOUBLE) * scale) AS mae,
       CAST(CAST(sse AS VARCHAR) AS DOUBLE) / (CAST(n AS DOUBLE) * (scale * scale)) AS mse,
       sqrt(CAST(CAST(sse AS VARCHAR) AS DOUBLE) / (CAST(n AS DOUBLE) * (scale * scale))) AS rmse
-- the exact 128-bit sum goes to double through its decimal text (correctly rounded)
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n, SUM(em) AS sae,
             SUM(CAST(em AS HUGEINT) * CAST(em AS HUGEINT)) AS sse, max(scale) AS scale
      FROM (SELECT CAST(round(e * scale) AS HUGEINT) AS em, scale
            FROM (SELECT e, power(2.0, 40 - ceil(log2(max(e) OVER ()))) AS scale
                  FROM (SELECT abs({SCORE} - target_rev) AS e FROM ft))))"""


def least_squares(name: str, src: str, cols: list[str], label: str) -> str:
    """CTEs ``{name}_w(i, w)`` and ``{name}_0(intercept)``: least squares of ``label`` on ``cols``
    over ``src``, by Gauss-Jordan elimination of the correlation matrix with the ridge on its diagonal."""
    from ..operators.moments import RIDGE
    k = len(cols)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in [*cols, label])
    return f"""
{name}_x AS (SELECT rid, unnest(range(1, {k + 2})) AS i, unnest([{values}]) AS v
             FROM (SELECT row_number() OVER () AS rid, * FROM {src})),
{name}_s AS (SELECT i, avg(v) AS m, stddev_pop(v) AS sd FROM {name}_x GROUP BY i),
{name}_r AS (SELECT a.i, b.i AS j, CASE WHEN min(a.v) = max(a.v) OR min(b.v) = max(b.v) THEN 0.0 ELSE corr(a.v, b.v) END
                    + CASE WHEN a.i = b.i THEN {RIDGE!r} ELSE 0.0 END AS r
             FROM {name}_x a JOIN {name}_x b USING (rid) WHERE a.i <= {k} GROUP BY a.i, b.i),
{name}_m AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(r ORDER BY j) AS r FROM {name}_r GROUP BY i)),
{name}_e AS (
  SELECT 0 AS k, m FROM {name}_m
  UNION ALL
  SELECT k + 1, list_transform(range(1, {k + 1}), lambda r: CASE WHEN r = k + 1
           THEN list_transform(m[r], lambda v: v / m[k + 1][k + 1])
           ELSE list_transform(range(1, {k + 2}), lambda c: m[r][c] - m[r][k + 1] / m[k + 1][k + 1] * m[k + 1][c]) END)
  FROM {name}_e WHERE k < {k}),
{name}_w AS (SELECT s.i, s.m, CASE WHEN s.sd = 0 THEN 0.0 ELSE e.m[s.i][{k + 1}] * y.sd / s.sd END AS w
             FROM {name}_e e, {name}_s s, {name}_s y WHERE e.k = {k} AND s.i <= {k} AND y.i = {k + 1}),
{name}_0 AS (SELECT any_value(y.m) - sum(b.w * b.m) AS intercept FROM {name}_w b, {name}_s y WHERE y.i = {k + 1})"""


def linear(name: str, cols: list[str]) -> str:
    """The model's value of a row, as a scalar expression."""
    terms = " + ".join(f"(SELECT w FROM {name}_w WHERE i = {i}) * CAST({c} AS DOUBLE)" for i, c in enumerate(cols, 1))
    return f"((SELECT intercept FROM {name}_0) + {terms})"


_FEATURES = FEATURE_COLS.replace("\n", " ").split(", ")[1:]
_TRAIN = SPLIT_FEATURES.replace("WITH", "WITH RECURSIVE", 1) + f""",
train AS (SELECT * FROM ft WHERE {_BUCKET.format(k='CustomerID')} < 80),""" + least_squares("ls", "train", _FEATURES, "target_rev")

SQL["fit_predict"] = _TRAIN + f"""
SELECT CustomerID, target_rev, round({linear("ls", _FEATURES)}, 2) AS CLV_Prediction
FROM ft WHERE {_BUCKET.format(k='CustomerID')} >= 80"""

SQL["fit_update"] = _TRAIN + f"""
SELECT [{", ".join(f"'{c}'" for c in _FEATURES)}][i] AS feature, round(w, 6) AS coefficient FROM ls_w
UNION ALL SELECT 'intercept', round(intercept, 6) FROM ls_0"""

SQL["series_forecast"] = SERIES.replace("WITH", "WITH RECURSIVE", 1) + """,
mm AS (SELECT MIN(TotalValue) AS lo, MAX(TotalValue) AS hi FROM split_series WHERE split = 'train'),
win AS (
  SELECT a.split, a.split_pos AS t, (a.TotalValue - lo) / (hi - lo) AS x0, (b.TotalValue - lo) / (hi - lo) AS x1,
         (c.TotalValue - lo) / (hi - lo) AS y
  FROM mm, split_series a
  JOIN split_series b ON b.split = a.split AND b.split_pos = a.split_pos + 1
  JOIN split_series c ON c.split = a.split AND c.split_pos = a.split_pos + 2),
wtrain AS (SELECT * FROM win WHERE split = 'train'),""" + least_squares("ls", "wtrain", ["x0", "x1"], "y") + f"""
SELECT split, t, round(y * (hi - lo) + lo, 2) AS actual_value,
       round({linear("ls", ["x0", "x1"])} * (hi - lo) + lo, 2) AS predicted_value
FROM win, mm WHERE split = 'test'"""

SCORED = FEATS + f""",
scores AS (SELECT CustomerID, {SCORE} AS CLV_Prediction FROM feats),
scored AS (SELECT l.*, s.CLV_Prediction FROM lines l LEFT JOIN scores s ON l.CustomerID = s.CustomerID)"""

SQL["score_foreign"] = SCORED + "\nSELECT CustomerID, CLV_Prediction FROM scores"
SQL["score_features"] = SCORED + "\nSELECT CustomerID, CLV_Prediction FROM scores"

SQL["scored_lines"] = SCORED + f"\nSELECT {CLEAN_COLS}, CLV_Prediction FROM scored"

SQL["scored_projection"] = SCORED + f"""
SELECT Country, CustomerID, Description, {_ts_from_epoch('invoice_epoch')} AS InvoiceDate,
       InvoiceNo, Quantity, StockCode, UnitPrice, Revenue, CLV_Prediction FROM scored"""

_KV = SCORED + f""",
kv AS (
  SELECT coalesce(InvoiceNo, '') || '-' || coalesce(CustomerID, '') AS rowkey,
         CAST(Quantity AS VARCHAR) AS cf_Quantity,
         CAST(UnitPrice AS VARCHAR) AS cf_UnitPrice,
         strftime({_ts_from_epoch('invoice_epoch')}, '%Y-%m-%dT%H:%M:%S') AS cf_InvoiceDate,
         CAST(hour AS VARCHAR) AS cf_hour, CAST(dayofweek AS VARCHAR) AS cf_dayofweek,
         CAST(weekend AS VARCHAR) AS cf_weekend,
         CAST(Revenue AS VARCHAR) AS cf_Revenue,
         CAST(CLV_Prediction AS VARCHAR) AS cf_CLV_Prediction,
         invoice_epoch,
         row_number() OVER (PARTITION BY InvoiceNo, invoice_ts, CustomerID, Country
                            ORDER BY StockCode, Description, Quantity, UnitPrice) AS item_pos
  FROM scored)"""

KV_COLS = ("rowkey, cf_Quantity, cf_UnitPrice, cf_InvoiceDate, cf_hour, cf_dayofweek, "
           "cf_weekend, cf_Revenue, cf_CLV_Prediction")

SQL["kv_rowkey"] = _KV + f"\nSELECT {KV_COLS} FROM kv"

SQL["kv_upsert_latest"] = _KV + f"""
SELECT {KV_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY invoice_epoch DESC, item_pos DESC) AS rn
  FROM kv) WHERE rn = 1"""

SQL["prediction_feed"] = SCORED + """
SELECT CustomerID AS key, CLV_Prediction AS clv,
       to_json({'key': CustomerID, 'clv': CLV_Prediction})::VARCHAR AS value
FROM scores"""

FEED = f"""WITH feed AS (
  SELECT CAST(user_id AS VARCHAR) AS key, value AS clv, ts, event_id FROM events),
cur AS (
  SELECT key, clv FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
  WHERE rn = 1),
prev AS (
  SELECT key, clv FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM feed
    WHERE ts < TIMESTAMP '{SNAPSHOT_CUTOFF}')
  WHERE rn = 1)"""

SQL["top10_clv"] = FEED + "\nSELECT key, clv FROM cur ORDER BY clv DESC, key LIMIT 10"

SQL["rank_change"] = FEED + """,
rc AS (SELECT key, clv, row_number() OVER (ORDER BY clv DESC, key) AS rank FROM cur),
rp AS (SELECT key, row_number() OVER (ORDER BY clv DESC, key) AS prev_rank FROM prev)
SELECT rc.key, clv, rank, prev_rank,
       CASE WHEN prev_rank IS NULL THEN 'new' WHEN prev_rank < rank THEN 'down'
            WHEN prev_rank > rank THEN 'up' ELSE 'none' END AS change
FROM rc LEFT JOIN rp ON rc.key = rp.key"""

SQL["clv_by_day"] = """
SELECT day, n_scores, CAST(s AS DOUBLE) AS clv_total, CAST(s AS DOUBLE) / CAST(n_scores AS DOUBLE) AS clv_avg,
       clv_max
FROM (SELECT CAST(ts AS DATE) AS day, COUNT(value) AS n_scores,
             SUM(CAST(value AS DECIMAL(28,10))) AS s, MAX(value) AS clv_max
      FROM events GROUP BY CAST(ts AS DATE))"""

SQL["serving_view"] = FEED + """
SELECT CAST(c.c_custkey AS VARCHAR) AS key, c.c_name AS name,
       coalesce(CAST(CAST(CAST(round(cur.clv * 100.0) AS BIGINT) AS DECIMAL(20,0))
                     * CAST(0.01 AS DECIMAL(3,2)) AS VARCHAR), 'N/A') AS clv_text
FROM customer c LEFT JOIN cur ON CAST(c.c_custkey AS VARCHAR) = cur.key"""

SQL["raw_union"] = BASE + f"""
SELECT {LINE_COLS}, CAST(NULL AS INTEGER) AS batch FROM invoice_lines WHERE InvoiceDate < '1998-01-01'
UNION ALL
SELECT {LINE_COLS}, 2 AS batch FROM invoice_lines WHERE NOT (InvoiceDate < '1998-01-01')"""

SQL["window_features"] = BASE + """
SELECT window_start, window_start + INTERVAL 30 DAY AS window_end, CustomerID,
       CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
       COUNT(InvoiceNo) AS frequency, COUNT(CASE WHEN Revenue < 0 THEN 1 END) AS num_returns,
       quantile_disc(hour, 0.5) AS purchase_hour_med, quantile_disc(dayofweek, 0.5) AS purchase_dow_med,
       MAX(invoice_ts) AS last_ts,
       CAST(date_diff('day', CAST(MAX(invoice_ts) AS DATE),
                      CAST(window_start + INTERVAL 30 DAY AS DATE)) AS INTEGER) AS recency
FROM (SELECT *, TIMESTAMP '1970-01-01 00:00:00'
                + to_seconds(CAST(floor(epoch(invoice_ts) / 2592000) AS BIGINT) * 2592000) AS window_start
      FROM lines WHERE CustomerID IS NOT NULL)
GROUP BY window_start, CustomerID"""

# ---- streaming queries: same results as their batch twins -----------------
# two micro-batches: scores of the first come from its lines, of the second from all lines
_TWO = BASE + """,
early AS (SELECT * FROM lines WHERE invoice_ts < TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),
late AS (SELECT * FROM lines WHERE invoice_ts >= TIMESTAMP '""" + SPLIT_DATE + """ 00:00:00'),""" \
    + features_cte("feats_a", "early") + "," + features_cte("feats", "lines") + "," \
    + features_cte("feats_b", "late") + f""",
scores AS (
  SELECT 1 AS batch, CustomerID, {SCORE} AS CLV_Prediction FROM feats_a
  UNION ALL
  SELECT 2, CustomerID, {SCORE} FROM feats WHERE CustomerID IN (SELECT CustomerID FROM late)),
scored AS (
  SELECT l.*, s.CLV_Prediction FROM early l LEFT JOIN scores s ON l.CustomerID = s.CustomerID AND s.batch = 1
  UNION ALL
  SELECT l.*, s.CLV_Prediction FROM late l LEFT JOIN scores s ON l.CustomerID = s.CustomerID AND s.batch = 2)"""
SQL["stream_score"] = _TWO + f"\nSELECT {CLEAN_COLS}, CLV_Prediction FROM scored"
SQL["stream_prediction_feed"] = SQL["prediction_feed"].replace(SCORED, _TWO)
SQL["stream_kv_upsert"] = SQL["kv_upsert_latest"].replace(SCORED, _TWO)
SQL["stream_features_batch"] = _TWO + f"\nSELECT {FEATURE_COLS} FROM feats_a UNION ALL SELECT {FEATURE_COLS} FROM feats_b"
SQL["stream_flat"] = BASE + "," + features_cte("feats", "dirty_clean") + f""",
scores AS (SELECT CustomerID, {SCORE} AS CLV_Prediction FROM feats)
SELECT l.* EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_linenumber), s.CLV_Prediction
FROM dirty_clean l LEFT JOIN scores s ON l.CustomerID = s.CustomerID"""
SQL["stream_flat_quarantine"] = BASE + f"""
SELECT InvoiceNo, StockCode, Quantity, UnitPrice, CustomerID, InvoiceDate, reason, InvoiceNo AS text_invoice FROM (
  SELECT *, CASE WHEN InvoiceDate IS NULL OR Quantity IS NULL OR UnitPrice IS NULL THEN 'incomplete'
                 WHEN {_parse('InvoiceDate')} IS NULL THEN 'invalid date'
                 WHEN abs(UnitPrice) >= 1e9 OR abs(Quantity * UnitPrice) >= 1e14 THEN 'invalid price' END AS reason
  FROM dirty_lines) WHERE reason IS NOT NULL"""
SQL["stream_landing_quarantine"] = "SELECT reason, count(*) AS messages, count(*) AS with_text FROM (" \
    + SQL["ingest_quarantine"] + """
UNION ALL
SELECT NULL AS InvoiceNo, 'unparseable' AS reason FROM inv WHERE CAST(InvoiceNo AS BIGINT) % 97 = 5) GROUP BY reason"""
SQL["stream_features_total"] = SQL["cust_features"]
SQL["stream_landing"] = SQL["explode_items"]
SQL["stream_leaderboard"] = SQL["rank_change"]
# windows closed by the final watermark (max event time - 1 day)
SQL["stream_window_features"] = "SELECT * FROM (" + SQL["window_features"] + """
) wf WHERE window_end <= (""" + BASE + """
SELECT MAX(invoice_ts) - INTERVAL 1 DAY FROM lines)"""
SQL["stream_invoice_frequency"] = SQL["cust_invoice_frequency"]
SQL["landing_compacted"] = SQL["explode_items"]
# three batches; a row is late if its window ended by the latest time of the batches before, less a day
_ARRIVED = BASE + f""",
arrived AS (
  SELECT *, window_start + INTERVAL 30 DAY AS window_end FROM (
    SELECT *, LEAST(2, CASE WHEN invoice_ts < TIMESTAMP '{LATE_CUTS[0]} 00:00:00' THEN 0
                            WHEN invoice_ts < TIMESTAMP '{LATE_CUTS[1]} 00:00:00' THEN 1 ELSE 2 END
                       + CASE WHEN CAST(InvoiceNo AS BIGINT) % {LATE_MODULUS} = 0 THEN 1 ELSE 0 END) AS batch_id,
           TIMESTAMP '1970-01-01 00:00:00'
           + to_seconds(CAST(floor(epoch(invoice_ts) / 2592000) AS BIGINT) * 2592000) AS window_start
    FROM lines)),
marks AS (
  SELECT b.n AS batch_id, MAX(a.invoice_ts) - INTERVAL 1 DAY AS watermark
  FROM (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) b
  LEFT JOIN (SELECT batch_id, MAX(invoice_ts) AS invoice_ts FROM arrived GROUP BY batch_id) a ON a.batch_id < b.n
  GROUP BY b.n),
tagged AS (
  SELECT a.*, m.watermark, coalesce(a.window_end <= m.watermark, false) AS late
  FROM arrived a JOIN marks m ON a.batch_id = m.batch_id WHERE a.CustomerID IS NOT NULL)"""
SQL["stream_window_late"] = _ARRIVED + """
SELECT InvoiceNo, StockCode, Quantity, CustomerID, invoice_ts, window_end, watermark, CAST(batch_id AS INTEGER) AS batch_id
FROM tagged WHERE late"""
SQL["stream_window_table"] = _ARRIVED + """
SELECT window_start, window_end, CustomerID,
       CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
       COUNT(InvoiceNo) AS frequency, COUNT(CASE WHEN Revenue < 0 THEN 1 END) AS num_returns,
       quantile_disc(hour, 0.5) AS purchase_hour_med, quantile_disc(dayofweek, 0.5) AS purchase_dow_med,
       MAX(invoice_ts) AS last_ts,
       CAST(date_diff('day', CAST(MAX(invoice_ts) AS DATE), CAST(window_end AS DATE)) AS INTEGER) AS recency,
       window_end <= (SELECT watermark FROM marks WHERE batch_id = 3) AS closed
FROM tagged WHERE NOT late GROUP BY window_start, window_end, CustomerID"""
SQL["scan_nested_json"] = SQL["explode_items"]
SQL["scan_csv"] = BASE + f"\nSELECT {LINE_COLS} FROM invoice_lines"
