"""Readers for the six input tables: Parquet (default) or CSV, always with the
declared schema (no inference), original column names mapped to snake_case
whatever their case, blanks and underscores; a column that is not found raises.

Text columns that should be typed (a bill date stored as text, a quantity
stored as text) are converted leniently: unparseable values become NULL,
as ``TRY_CAST`` does, instead of failing the job. They are not lost unseen:
``read_table_quarantined`` also returns the rows that hold such values as they
came, and ``audit_unparseable_values`` counts them by column.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.sources.schema import NAME_MAP, SCHEMAS


#: Columns that an input may lack; all others must be there.
OPTIONAL = frozenset(["line_no"])


def _canonical(name: str) -> str:
    """Header spelling without case, blanks and underscores."""
    return re.sub(r"[\s_]+", "", name).lower()


def _sources(columns: list[str], schema: T.StructType) -> dict[str, str]:
    """Schema column -> input column, matched by spelling in any case."""
    spelled = {_canonical(f.name): f.name for f in schema.fields}
    spelled |= {_canonical(k): v for k, v in NAME_MAP.items() if v in schema.names}
    found: dict[str, str] = {}
    for c in columns:
        target = spelled.get(_canonical(c))
        if target is None:
            continue
        if target in found:
            raise ValueError(f"columns {found[target]!r} and {c!r} both mean {target!r}")
        found[target] = c
    missing = [f.name for f in schema.fields if f.name not in found and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"input columns {columns} lack {missing}")
    return found


def parse_timestamp(text: Column, date_formats: Sequence[str] = ()) -> Column:
    """Text as a timestamp: Spark's default spelling, then each format in
    order; NULL if none fits."""
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in date_formats])


def audit_unparseable_dates(df: DataFrame, column: str, date_formats: Sequence[str] = ()) -> DataFrame:
    """Rows, rows without a date text, and rows whose text is no date in
    any known spelling (these become NULL and stay when a year is dropped)."""
    text = F.trim(F.col(column))
    blank = F.coalesce(text == "", F.lit(True))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(~blank & parse_timestamp(text, date_formats).isNull()).alias("n_unparseable"),
    )


def normalise_text(df: DataFrame, spellings: Mapping[str, Sequence[str]]) -> DataFrame:
    """Opt-in: values that equal one of a column's ``spellings`` but for case
    and outer blanks become that spelling; all others stay as they are."""
    out = {}
    for column, known in spellings.items():
        key = F.lower(F.trim(F.col(column)))
        expr = F.col(column)
        for name in known:
            expr = F.when(key == name.strip().lower(), F.lit(name)).otherwise(expr)
        out[column] = expr
    return df.withColumns(out)


def _typed(c: Column, source: T.DataType, wanted: T.DataType, date_formats: Sequence[str]) -> Column:
    if source == wanted:
        return c
    if isinstance(source, T.StringType) and isinstance(wanted, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(c, date_formats).cast(wanted)
    return c.try_cast(wanted)


def _conform(df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = ()) -> DataFrame:
    found = _sources(df.columns, schema)
    cols = []
    for f in schema.fields:
        if f.name not in found:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        out = _typed(F.col(f"`{found[f.name]}`"), df.schema[found[f.name]].dataType, f.dataType, date_formats)
        cols.append(out.alias(f.name))
    return df.select(*cols)


def _failing(df: DataFrame, schema: T.StructType, date_formats: Sequence[str]) -> list[tuple[str, Column, Column]]:
    """(column, value is blank, value fails its cast) of the columns that need one."""
    found, out = _sources(df.columns, schema), []
    for f in schema.fields:
        source = df.schema[found[f.name]].dataType if f.name in found else f.dataType
        if source == f.dataType:
            continue
        c = F.col(f"`{found[f.name]}`")
        blank = F.coalesce(F.trim(c) == "", F.lit(True)) if isinstance(source, T.StringType) else c.isNull()
        text = F.trim(c) if isinstance(source, T.StringType) else c
        out.append((f.name, blank, ~blank & _typed(text, source, f.dataType, date_formats).isNull()))
    return out


def audit_unparseable_values(df: DataFrame, name: str, date_formats: Sequence[str] = ()) -> DataFrame:
    """For each column of table ``name`` whose input type is not the declared
    one: rows, rows without a value, and rows whose value fails its cast. One
    pass over the input, whatever the number of columns."""
    checks = _failing(df, SCHEMAS[name], date_formats)
    schema = "column_name string, n_rows long, n_blank long, n_unparseable long"
    if not checks:
        return df.sparkSession.createDataFrame([], schema)
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.struct(F.lit(c).alias("column_name"), F.count_if(blank).alias("n_blank"), F.count_if(bad).alias("n_unparseable")).alias(f"c{i}")
        for i, (c, blank, bad) in enumerate(checks)])
    rows = counted.select("n_rows", F.explode(F.array(*[f"c{i}" for i in range(len(checks))])).alias("c"))
    return rows.select("c.column_name", "n_rows", "c.n_blank", "c.n_unparseable")


#: Of a quarantined row: the columns whose values fail their casts, and the line of a CSV file that does not fit its header.
BAD_COLUMNS, BAD_LINE = "bad_columns", "bad_line"


def quarantined(df: DataFrame, name: str, date_formats: Sequence[str] = ()) -> DataFrame:
    """The input rows of table ``name``, as they came, that hold a value that
    fails its cast (named in ``bad_columns``) or are a broken line of a file."""
    names = [F.when(bad, F.lit(c)) for c, _, bad in _failing(df.drop(BAD_LINE), SCHEMAS[name], date_formats)]
    bad = F.filter(F.array(*names), lambda c: c.isNotNull()) if names else F.array().cast("array<string>")
    broken = F.col(BAD_LINE).isNotNull() if BAD_LINE in df.columns else F.lit(False)
    return df.withColumn(BAD_COLUMNS, bad).where((F.size(BAD_COLUMNS) > 0) | broken)


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", date_formats: Sequence[str] = (),
               **options) -> DataFrame:
    """Read one of ``orders customers products stores payments reviews``.

    ``date_formats``: spellings of text dates, tried in order after Spark's
    default. A missing required column raises."""
    return _conform(_raw(spark, path, fmt, options), SCHEMAS[name], date_formats)


def read_table_quarantined(spark: SparkSession, name: str, path: str, fmt: str = "parquet", date_formats: Sequence[str] = (),
                           **options) -> tuple[DataFrame, DataFrame]:
    """(table, quarantine). The table is ``read_table``'s but for CSV lines that
    do not fit the header, which are left out of it; the quarantine has those
    lines (``bad_line``) and all rows with values that fail their casts, as they
    came, so they can be written to a table of their own."""
    df = _raw(spark, path, fmt, options, lines=True)
    rows = df.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE) if BAD_LINE in df.columns else df
    return _conform(rows, SCHEMAS[name], date_formats), quarantined(df, name, date_formats)


def _raw(spark: SparkSession, path: str, fmt: str, options: Mapping[str, str], lines: bool = False) -> DataFrame:
    if fmt == "parquet":
        return spark.read.options(**options).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}")
    # Every column is read as text and typed by _conform.
    reader = spark.read.options(header="true", **options)
    df = reader.csv(path)
    if not lines:
        return df
    schema = T.StructType([*df.schema.fields, T.StructField(BAD_LINE, T.StringType())])
    return reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE).schema(schema).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a mart or cleaned table as Parquet (marts are rebuilt whole,
    never appended)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
