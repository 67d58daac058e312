"""Column expressions shared by batch and streaming operators.

All built-in Spark expressions: they stay JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the invoice format (they must equal the source system's).
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"      # producer text format of InvoiceDate
DATE_KEEP_CHARS = r"[^0-9\-: ]"          # characters stripped before parsing
WEEKEND_DAYS = (6, 7)                    # dayofweek values counted as weekend (Fri, Sat)
PARITY_REF_DATE = "2011-06-11"           # reference date of feature t in the source data



def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


CANONICAL_SHAPE = "9999-99-99 99:99:99"   # digits mapped to 9, ISO 'T' to space


def parse_invoice_ts_exact(c: str | Column) -> Column:
    """The defining rule: turn ``T`` into a space, strip every character
    outside ``[0-9-: ]``, parse ``yyyy-MM-dd HH:mm:ss`` strictly; null when
    that fails (``try_to_timestamp`` does not raise under ANSI)."""
    text = F.regexp_replace(F.regexp_replace(col_(c), "T", " "), DATE_KEEP_CHARS, "")
    return F.try_to_timestamp(text, F.lit(DATE_FORMAT)).cast("timestamp_ntz")


def parse_invoice_ts(c: str | Column) -> Column:
    """Invoice text date -> timestamp_ntz; null when unparseable.

    Same result as ``parse_invoice_ts_exact`` but fast on the common input:
    a text whose shape is exactly ``dddd-dd-dd dd:dd:dd`` (or with ``T``) has
    nothing to strip, and for that shape Spark's built-in string -> timestamp
    cast agrees with the strict pattern (same fields, same range checks), at a
    fraction of the cost of two regex passes and a formatter.  Every other
    text takes the exact path.  The shape test is one ``translate`` pass.
    """
    s = col_(c)
    shape = F.translate(s, "0123456789T", "9999999999 ")
    return F.when(shape == F.lit(CANONICAL_SHAPE), s.try_cast("timestamp_ntz")) \
        .otherwise(parse_invoice_ts_exact(s))


def to_date_or_null(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date with ``fmt``; null (not an error, not the raw text)
    when it does not parse, so the column keeps one type."""
    return F.try_to_date(col_(c), fmt)


def epoch_seconds(ts: str | Column) -> Column:
    """timestamp_ntz -> seconds since 1970-01-01 00:00:00 as double (zone-free)."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col_(ts)).cast("double")


def datetime_text(ts: str | Column, sep: str = " ") -> Column:
    """timestamp -> ``yyyy-MM-dd{sep}HH:mm:ss`` from cheap built-ins (the same
    text as ``date_format`` for 4-digit years, without a formatter per row)."""
    t = col_(ts)

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.to_date(t).cast("string"), F.lit(sep), two(F.hour(t)), F.lit(":"),
                    two(F.minute(t)), F.lit(":"), two(F.second(t)))


def event_time(ts_ntz: str | Column) -> Column:
    """Wall-clock timestamp_ntz -> the instant with the same UTC wall clock
    (a TIMESTAMP, as watermarks require).  Zone-free, unlike a plain cast,
    which reads the wall clock in the session zone."""
    return F.timestamp_seconds(epoch_seconds(ts_ntz).cast("bigint"))


def wall_clock(ts: str | Column) -> Column:
    """Inverse of ``event_time``: TIMESTAMP -> timestamp_ntz, UTC wall clock."""
    return from_epoch_seconds(F.unix_seconds(col_(ts)).cast("double"))


def from_epoch_seconds(e: str | Column) -> Column:
    """Epoch seconds (double) -> timestamp_ntz (inverse of ``epoch_seconds``)."""
    return F.timestamp_add("SECOND", col_(e).cast("bigint"),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def weekend_flag(dow: str | Column, days=WEEKEND_DAYS) -> Column:
    return F.when(col_(dow).isin(*days), 1).otherwise(0)


def to_int_truncating(c: str | Column) -> Column:
    """Text or number -> int, truncating decimals ('2.9' -> 2); null if invalid."""
    return col_(c).try_cast("double").try_cast("int")


PRICE_SCALE = 10_000       # money is summed exactly in integer units of 1/10000 ...
FINE_SCALE = 1_000_000     # ... and what a price has beyond them in units of 1/10^10
PRICE_LIMIT, LINE_LIMIT = 1e9, 1e14   # beyond these a price or line is no money: quarantine

HIGH_SCALE = 1_000_000_000  # units of a line are split at 10^9, so that no sum of lines overflows

# rint stays on doubles; round() would make a decimal object per line
_UNITS = f"CAST(rint(UnitPrice * {PRICE_SCALE}.0) AS BIGINT)"
_FINE = f"CAST(rint((UnitPrice * {PRICE_SCALE}.0 - rint(UnitPrice * {PRICE_SCALE}.0)) * {FINE_SCALE}.0) AS BIGINT)"
_LINE_UNITS = f"(CAST(Quantity AS BIGINT) * {_UNITS})"
_LINE_FINE = f"(CAST(Quantity AS BIGINT) * {_FINE})"
# a line's revenue as three summable parts: 10^9 units, units, parts of a unit
REVENUE_PARTS_SQL = {
    "high": f"{_LINE_UNITS} div {HIGH_SCALE}",
    "units": f"{_LINE_UNITS} % {HIGH_SCALE} + {_LINE_FINE} div {FINE_SCALE}",
    "fine": f"{_LINE_FINE} % {FINE_SCALE}",
}


def money_ok(qty: str | Column, price: str | Column) -> Column:
    """Whether price and line value are numbers that money arithmetic can carry
    (false for null, NaN, infinity)."""
    p = col_(price)
    return F.coalesce((F.abs(p) < F.lit(PRICE_LIMIT))
                      & (F.abs(col_(qty).cast("double") * p) < F.lit(LINE_LIMIT)), F.lit(False))


def revenue_parts(name: str, when: str | None = None) -> list[Column]:
    """Sums of the three parts of revenue, as ``{name}_high``, ``{name}_units`` and
    ``{name}_fine``; with ``when`` (a SQL condition) of the lines that satisfy it."""
    return [F.expr(f"sum({x if when is None else f'CASE WHEN {when} THEN {x} END'}) AS {name}_{part}")
            for part, x in REVENUE_PARTS_SQL.items()]


def money_sql(high: str, units: str, fine: str) -> str:
    """The three sums -> double.  Without a fine part, below 2^53 units, the quotient is
    the correctly rounded value of the exact decimal amount."""
    return (f"((CAST({high} AS DOUBLE) * {HIGH_SCALE}.0 + CAST({units} AS DOUBLE)) / {PRICE_SCALE}.0 "
            f"+ CAST({fine} AS DOUBLE) / {PRICE_SCALE * FINE_SCALE}.0)")


def money_of(name: str) -> str:
    """``money_sql`` of the columns that ``revenue_parts`` made."""
    return money_sql(f"{name}_high", f"{name}_units", f"{name}_fine")


def revenue_sum() -> Column:
    """Exact, order-free revenue of a group of lines with Quantity and UnitPrice.

    Three bigint sums stay in primitive codegen'd aggregation (a wide decimal
    sum falls back to BigDecimal objects), keep ten decimals of a price and hold
    four billion lines of the largest value that ``money_ok`` admits.
    """
    return F.expr(money_sql(*(f"sum({x})" for x in REVENUE_PARTS_SQL.values())))


def line_revenue() -> Column:
    """Revenue of one line: the exact decimal product, or the plain product
    where the price has more than four decimals."""
    return F.expr(f"CASE WHEN {_FINE} = 0 THEN CAST({_LINE_UNITS} AS DOUBLE) / {PRICE_SCALE}.0 "
                  f"ELSE Quantity * UnitPrice END")


def normal_id(c: str | Column) -> Column:
    """A customer id as text; a numeric id loses its fraction of zeros
    (``17850.0`` and ``17850`` are one customer), other text stays."""
    return F.regexp_replace(col_(c).cast("string"), r"^(-?[0-9]+)\.0*$", "$1")


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from md5 of the key text.

    Depends on the key only, so a split or sample is the same under any
    partitioning or executor loss (``randomSplit``/``rand`` are not).
    """
    return (F.conv(F.substring(F.md5(col_(key).cast("string")), 1, 4), 16, 10)
            .cast("int") % buckets)


def md5_rank_key(key: str | Column) -> Column:
    """Pseudo-random but repeatable ordering key for samples."""
    return F.md5(col_(key).cast("string"))


def median_sql(prefix: str, values: list[int]) -> str:
    """SQL text of ``median_from_counts`` (``values`` consecutive integers).

    One pass over the count array with a running sum: linear in the domain
    size.  (A CASE ladder of cumulative sums is quadratic in size and its
    generated code grows too large to be compiled well.)
    """
    names = [f"{prefix}{v}" for v in values]
    lo = values[0]
    n = " + ".join(names)
    return (
        f"aggregate(array({', '.join(names)}), "
        f"named_struct('cum', CAST(0 AS BIGINT), 'r', CAST(ceil(({n}) / 2.0) AS BIGINT), "
        f"'i', 0, 'med', CAST(NULL AS INT)), "
        f"(acc, x) -> named_struct('cum', acc.cum + x, 'r', acc.r, 'i', acc.i + 1, "
        f"'med', CASE WHEN acc.med IS NULL AND acc.r > 0 AND acc.cum + x >= acc.r "
        f"THEN acc.i + {lo} ELSE acc.med END), "
        f"acc -> acc.med)")


def median_from_counts(prefix: str, values: list[int]) -> Column:
    """Exact lower median from per-value counts ``{prefix}{v}`` of a small
    integer domain.

    The median is the smallest value whose cumulative count reaches
    ``ceil(n / 2)`` -- the same element ``percentile_approx(x, 0.5)`` returns
    when it is exact and SQL ``quantile_disc(x, 0.5)`` returns always.  Null
    when there are no values.  Built as one SQL expression (one parse instead
    of hundreds of client round trips).
    """
    return F.expr(median_sql(prefix, values))


HOURS = list(range(24))
WEEKDAYS = list(range(1, 8))


def count_parts_sql(c: str, values: list[int], prefix: str) -> list[str]:
    return [f"sum(CASE WHEN `{c}` = {v} THEN 1 ELSE 0 END) AS {prefix}{v}" for v in values]


def count_parts(c: str, values: list[int], prefix: str) -> list[Column]:
    """One ``sum`` per domain value: plain, mergeable, codegen'd aggregates."""
    return [F.expr(e) for e in count_parts_sql(c, values, prefix)]
