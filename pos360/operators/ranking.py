"""Ranking operators: top-1 per key, keep-one dedupe, and two exact NTILEs that
do not pull all rows into one task: by selecting the tiles' last keys
(``ntile_by_cut_keys``) and by range ranks (``exact_ntile``, any column types).

Ordering specs are lists of ``(column, ascending)``. NULLs sort first in an
ascending item and last in a descending one (SQL Server's and Spark's
default), so a spec means the same in Spark and in the DuckDB oracle when the
oracle spells ``NULLS FIRST`` / ``NULLS LAST`` out.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OrderSpec = Sequence[tuple[str, bool]]


def sort_columns(order: OrderSpec) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def top1_per_key(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """First row of every key group under ``order``.

    ``order`` should end in columns that make it total (D02): ties are then
    broken the same way in every run and partitioning. Catalyst plans
    ``row_number() = 1`` as a partial ``WindowGroupLimit`` before the shuffle,
    so a hot key sends at most one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def dedupe_keep_one(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep one row of each group of equal ``cols`` (NULLs compare equal).

    When ``cols`` covers every column the rows of a group are identical and a
    plain distinct (hash aggregate, map-side combine) suffices; otherwise the
    kept row is the first under the remaining columns, ascending.
    """
    rest = [c for c in df.columns if c not in set(cols)]
    if not rest:
        return df.dropDuplicates(list(cols))
    return top1_per_key(df, cols, [(c, True) for c in rest])


# --------------------------------------------------------------------------
# Exact NTILE
# --------------------------------------------------------------------------


def ntile_of_position(pos: Column, n: int, tiles: int) -> Column:
    """NTILE(tiles) of the row at 1-based position ``pos`` among ``n`` rows:
    the first ``n % tiles`` tiles hold one row more than the others."""
    q, r = divmod(n, tiles)
    big = r * (q + 1)
    first = F.call_function("div", pos - 1, F.lit(q + 1)) + 1
    if q == 0:
        return first.cast("int")
    rest = F.lit(r) + F.call_function("div", pos - F.lit(big) - 1, F.lit(q)) + 1
    return F.when(pos <= big, first).otherwise(rest).cast("int")


def exact_ntile(
    df: DataFrame,
    tiles: int,
    order: OrderSpec,
    out_col: str,
    *,
    rows_per_range: int = 1_000_000,
    n: int | None = None,
) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY order)`` without a window over the rows.

    1. ``repartitionByRange`` cuts the *whole* ordering key (tie-break
       columns included) into ranges of about ``rows_per_range`` rows, and
       into as many ranges as the session has shuffle partitions at least,
       from Spark's own bounded sample; a value shared by a third of all rows
       is split over many ranges by its tie-break columns.
    2. Inside each range the rows are sorted; ``spark_partition_id()`` is
       the range and ``monotonically_increasing_id()`` (partition id in the
       upper bits, record number in the lower 33, as documented) the row's
       rank inside it. Both are frozen by writing the rows once to the
       shared checkpoint folder, so a lost executor cannot shift them.
    3. Rows per range give each range's offset; offset + rank is the exact
       global position, from which the tile follows. The only window over all
       of something runs over one count per range.

    ``order`` should be a total order (end in a unique key); rows equal
    under ``order`` may swap positions, as with NTILE itself. Actions: a
    count (unless ``n`` gives it), the range sampling and one write.
    """
    from pos360.session import write_and_read

    if tiles < 1:
        raise ValueError("tiles must be >= 1")
    n = df.count() if n is None else n
    if n == 0:
        return df.withColumn(out_col, F.lit(None).cast("int"))
    n_ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / rows_per_range))
    by = sort_columns(order)
    marked = write_and_read(
        df.repartitionByRange(n_ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()),
        "ntile",
    )
    counts = marked.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per range, i.e. one per million rows of a large input.
    offsets = counts.select(
        "__pid",
        F.coalesce(
            F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__off"),
    )
    rank = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    pos = F.col("__off") + rank + 1
    return (
        marked.join(offsets, "__pid")
        .withColumn(out_col, ntile_of_position(pos, n, tiles))
        .drop("__pid", "__mid", "__off")
    )


# --------------------------------------------------------------------------
# Exact NTILE by selection
# --------------------------------------------------------------------------

#: Rows of a window that are few enough to be sorted as one array.
SELECT_ROWS = 10_000
_ACCURACY = 10_000
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def sort_value(df: DataFrame, name: str, asc: bool) -> Column:
    """A never-null value that ascends as the ordering item (``name``, ``asc``)
    does, NULLs first in an ascending and last in a descending item. Integers
    and dates become BIGINT (a BIGINT of the smallest or largest value sorts
    with the NULLs), decimals a decimal of one digit more, fractions a DOUBLE
    (an infinite one sorts with the NULLs or with NaN, the largest)."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DecimalType):
        wide = min(38, kind.precision + 1)
        end = decimal.Decimal(10) ** (wide - kind.scale) - decimal.Decimal(1).scaleb(-kind.scale)
        value = c.cast(T.DecimalType(wide, kind.scale))
        return F.coalesce(value if asc else -value, F.lit(-end if asc else end).cast(T.DecimalType(wide, kind.scale)))
    if isinstance(kind, T.FractionalType):
        c, end = c.cast("double"), float("inf")
        value = F.when(F.isnan(c), F.lit(end if asc else -end)).otherwise(c if asc else -c)
        return F.coalesce(F.when(c.isNotNull(), value), F.lit(-end if asc else end))
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"{name}: {kind.simpleString()} has no sort value; exact_ntile takes any type")
    c = c.cast("bigint")
    return F.coalesce(c if asc else F.bitwise_not(c), F.lit(_LEAST if asc else _MOST))


@dataclass(frozen=True)
class _Search:
    """The key at one position: the leading values found so far and, for the
    next column, the bounds between which it lies."""

    columns: tuple[str, ...]
    position: int  # among the rows inside, from 1
    inside: int
    found: tuple = ()
    low: object = None  # exclusive
    high: object = None  # exclusive
    key: tuple | None = field(default=None)

    @property
    def column(self) -> str:
        return self.columns[len(self.found)]

    def holds(self) -> Column:
        cond = F.lit(True)
        for c, v in zip(self.columns, self.found):
            cond &= F.col(c) == F.lit(v)
        if self.low is not None:
            cond &= F.col(self.column) > F.lit(self.low)
        if self.high is not None:
            cond &= F.col(self.column) < F.lit(self.high)
        return cond

    def fixed(self, value, position: int, inside: int) -> "_Search":
        s = replace(self, found=(*self.found, value), low=None, high=None, position=position, inside=inside)
        return replace(s, key=s.found) if len(s.found) == len(s.columns) else s


def _narrowed(df: DataFrame, searches: list[_Search]) -> list[_Search]:
    """One round: two pivots around each position from a sketch, then exact
    counts below, at, between and above them say where the position is."""
    probes = []
    for s in searches:
        at, near = (s.position - 0.5) / s.inside, 2.0 / _ACCURACY
        share = F.array(F.lit(max(0.0, at - near)), F.lit(min(1.0, at + near)))
        probes.append(F.percentile_approx(F.when(s.holds(), F.col(s.column)), share, _ACCURACY))
    pivots = df.agg(*[p.alias(f"p{i}") for i, p in enumerate(probes)]).head()
    counts = []
    for s, (a, b) in zip(searches, pivots):
        c, here = F.col(s.column), s.holds()
        for cond in (c < F.lit(a), c == F.lit(a), (c > F.lit(a)) & (c < F.lit(b)), (c == F.lit(b)) & F.lit(a != b)):
            counts.append(F.count_if(here & cond))
    n = list(df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).head())
    out = []
    for i, (s, (a, b)) in enumerate(zip(searches, pivots)):
        below, at_a, between, at_b = n[4 * i : 4 * i + 4]
        k = s.position
        if k <= below:
            out.append(replace(s, high=a, inside=below))
        elif k <= below + at_a:
            out.append(s.fixed(a, k - below, at_a))
        elif k <= below + at_a + between:
            out.append(replace(s, low=a, high=b, position=k - below - at_a, inside=between))
        elif k <= below + at_a + between + at_b:
            out.append(s.fixed(b, k - below - at_a - between, at_b))
        else:
            gone = below + at_a + between + at_b
            out.append(replace(s, low=b, position=k - gone, inside=s.inside - gone))
    return out


def keys_at(df: DataFrame, wanted: Sequence[tuple[Sequence[str], int]], n: int) -> list[tuple]:
    """For each (columns, position): the values of ``columns``, which must never
    be NULL, in the row at that 1-based position of the ascending order.

    A window of more than ``SELECT_ROWS`` rows shrinks some thousandfold a
    round (or loses a column, where one value fills it), so three or four
    rounds do for any table; all searches share a round's two aggregates,
    whose state per task is a sketch and a few counts. A window of fewer rows is sorted as one array. Nothing is
    shuffled but those states, sorted or written."""
    searches = [_Search(tuple(c), p, n) for c, p in wanted]
    while True:
        large = [i for i, s in enumerate(searches) if s.key is None and s.inside > SELECT_ROWS]
        if not large:
            break
        for i, s in zip(large, _narrowed(df, [searches[i] for i in large])):
            searches[i] = s
    small = [i for i, s in enumerate(searches) if s.key is None]
    if small:
        picks = []
        for i in small:
            s = searches[i]
            rest = F.struct(*s.columns[len(s.found) :])
            picks.append(F.get(F.sort_array(F.collect_list(F.when(s.holds(), rest))), F.lit(s.position - 1)).alias(f"k{i}"))
        for i, row in zip(small, df.agg(*picks).head()):
            searches[i] = replace(searches[i], key=(*searches[i].found, *row))
    return [s.key for s in searches]


def _after(columns: Sequence[str], key: Sequence) -> Column:
    """Whether a row sorts behind the key."""
    c, v = F.col(columns[0]), F.lit(key[0])
    return c > v if len(columns) == 1 else (c > v) | ((c == v) & _after(columns[1:], key[1:]))


def ntile_by_cut_keys(df: DataFrame, tiles: int, orders: Mapping[str, OrderSpec], *, n: int | None = None) -> DataFrame:
    """``df`` with a column of ``NTILE(tiles) OVER (ORDER BY order)`` for each of ``orders``.

    A tile ends at a known position, so only ``tiles - 1`` keys per ordering are
    looked up (``keys_at``); the tile of a row is then a comparison with these
    literals: no sort, no write, no join, no window. ``df`` is read once a
    round, so it should be a stored table. Each order should be a total one:
    rows equal under it get the same tile. Column types as in ``sort_value``."""
    if tiles < 1:
        raise ValueError("tiles must be >= 1")
    n = df.count() if n is None else n
    if n == 0:
        return df.withColumns({out: F.lit(None).cast("int") for out in orders})
    names = {out: [f"__{out}_{i}" for i in range(len(order))] for out, order in orders.items()}
    valued = df.withColumns({name: sort_value(df, c, asc) for out, order in orders.items() for name, (c, asc) in zip(names[out], order)})
    q, r = divmod(n, tiles)
    ends = sorted({q * t + min(t, r) for t in range(1, tiles)} - {0})
    wanted = [(out, t) for out in orders for t in range(1, tiles)]
    at = {(out, e): key for (out, e), key in zip(((o, e) for o in orders for e in ends), keys_at(valued, [(names[o], e) for o in orders for e in ends], n))}
    tile = {out: F.lit(1) for out in orders}
    for out, t in wanted:
        key = at[out, q * t + min(t, r)]
        tile[out] = tile[out] + F.when(_after(names[out], key), 1).otherwise(0)
    return valued.withColumns({out: c.cast("int") for out, c in tile.items()}).drop(*(x for v in names.values() for x in v))
