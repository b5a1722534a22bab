"""Column-level helpers. All of them build JVM-side expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text accepted as a numeric customer id (integer text only; the
# scripts' ISNUMERIC also accepts '1e5', '$' or '.', whose cast then fails).
NUMERIC_ID_PATTERN = r"^[+-]?[0-9]+$"

MONEY = T.DecimalType(18, 4)


def numeric_id(c: Column | str) -> Column:
    """BIGINT of an integer-looking text id, NULL otherwise (and on overflow)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(NUMERIC_ID_PATTERN), c.try_cast("bigint"))


def is_numeric_id(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(NUMERIC_ID_PATTERN), F.lit(False))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; text is parsed leniently (bad text -> NULL)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    return c.cast("timestamp")


def _year_bounds(dtype: T.DataType, year: int) -> tuple[Column, Column]:
    # String literals cast to the column's own type: for TIMESTAMP_NTZ the
    # bounds are wall-clock values whatever the session or Python time zone;
    # the casts fold to constants, so the comparisons reach the scan.
    lo, hi = F.lit(f"{year:04d}-01-01 00:00:00"), F.lit(f"{year + 1:04d}-01-01 00:00:00")
    return lo.cast(dtype), hi.cast(dtype)


def year_range(df: DataFrame, name: str, year: int) -> Column:
    """``year(name) = year`` written as a half-open range so that the two
    bounds reach the Parquet scan as pushed filters."""
    dtype = df.schema[name].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.year(as_timestamp(df, name)) == F.lit(year)
    lo, hi = _year_bounds(dtype, year)
    c = F.col(name)
    return (c >= lo) & (c < hi)


def outside_year(df: DataFrame, name: str, year: int) -> Column:
    """Rows to keep when deleting ``year(name) = year``: before or after the
    year, or NULL. Spelled without ``coalesce`` so that the disjunction of
    plain comparisons still reaches the Parquet scan."""
    dtype = df.schema[name].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        y = F.year(as_timestamp(df, name))
        return y.isNull() | (y != F.lit(year))
    lo, hi = _year_bounds(dtype, year)
    c = F.col(name)
    return (c < lo) | (c >= hi) | c.isNull()


def int_avg(c: Column | str) -> Column:
    """AVG over an INT column as an integer engine computes it: the quotient
    truncated toward zero; NULL on no input."""
    c = F.col(c) if isinstance(c, str) else c
    return F.call_function("div", F.sum(c.cast("bigint")), F.count(c))


def exact_avg(c: Column | str) -> Column:
    """Mean as DOUBLE computed from an exact (decimal or integer) sum, so the
    value does not depend on summation order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def float_avg(c: Column | str, digits: int = 9) -> Column:
    """Mean of a DOUBLE column rounded to ``digits`` places: a floating sum
    depends on summation order, the rounded mean does not."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.avg(c), digits)


def ratio_pct(num: Column, den: Column) -> Column:
    """100 * num / den as DOUBLE, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double"))


def month_long_label(d: Column) -> Column:
    """'2001-January' style label."""
    return F.date_format(d, "yyyy-MMMM")


def month_short_label(year: Column, month: Column) -> Column:
    """'Jan 2001' style label."""
    return F.date_format(F.make_date(year, month, F.lit(1)), "MMM yyyy")


def month_abbr(year: Column, month: Column) -> Column:
    return F.date_format(F.make_date(year, month, F.lit(1)), "MMM")


def money_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (money is exact inside, DOUBLE at the
    output edge)."""
    cols = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def null_safe_concat(*parts: Column | str) -> Column:
    """CONCAT that treats NULL as the empty string."""
    return F.concat(*[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
