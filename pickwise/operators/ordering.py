"""Dense row positions and running totals without a single-task window.

Two exact ways, by the order wanted:

* hash order: rows are spread over 65,536 buckets by the leading digits of an md5 key, so a
  bucket is a small, even share of any table; a row's position is its rank in the bucket plus
  the size of all earlier buckets (a table of at most 65,536 rows).
* value order: rows are range partitioned, written once, and a row's running total is the
  total inside its range plus the totals of all earlier ranges (one row per range).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.workspace import materialize

_KEY, _BUCKET, _RANGE, _START, _COPY, _COPIES = (
    "__key", "__bucket", "__range", "__start", "__copy", "__copies"
)
_BUCKET_DIGITS = 4
# Copies of one row written by a single task before they are spread over more tasks.
COPY_CHUNK = 100_000
# Rows that one task may sort to look up a position.
SMALL_SORT = 100_000


def hash_key(columns: Sequence[Column], seed) -> Column:
    """md5 over the seed and the columns as text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def repeat_rows(df: DataFrame, copies: str, copy: str) -> DataFrame:
    """Emit each row ``copies`` times, numbered 0.. in ``copy``.

    Rows with many copies are cut into chunks first and the chunks spread over tasks, so one
    row that stands for a third of the table is not written by one task.
    """
    count = F.col(copies)
    few = df.filter(count <= COPY_CHUNK).withColumn(
        copy, F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, last = F.col("__first"), F.least(F.col("__first") + COPY_CHUNK, count) - 1
    many = (
        df.filter(count > COPY_CHUNK)
        .withColumn(
            "__first",
            F.explode(F.sequence(F.lit(0).cast("long"), count - 1, F.lit(COPY_CHUNK).cast("long"))),
        )
        .repartition(tasks, "__first")
        .withColumn(copy, F.explode(F.sequence(first, last)))
        .drop("__first")
    )
    return few.unionByName(many).drop(copies)


def number_copies(df: DataFrame, copy: str) -> DataFrame:
    """Number identical rows 0, 1, 2, ...; the number of copies is counted before the shuffle."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    return repeat_rows(counted, _COPIES, copy)


def hash_positions(
    df: DataFrame, seed, name: str = "position", unique: bool = False, group: str | None = None
) -> DataFrame:
    """Add the 0-based position of each row in seeded md5 order over all its columns.

    Identical rows get a copy number first, so they scatter like any other rows;
    ``unique=True`` promises there are none and saves that shuffle. With ``group`` (a column
    with few values) positions start anew per group.
    """
    columns = df.columns
    numbered = df if unique else number_copies(df, _COPY)
    keyed = numbered.withColumn(
        _KEY, hash_key([F.col(c) for c in numbered.columns], seed)
    ).withColumn(_BUCKET, F.substring(_KEY, 1, _BUCKET_DIGITS))
    bucket = [group, _BUCKET] if group else [_BUCKET]
    # At most 16**4 rows per group, so one window task and a broadcast are within a fixed bound.
    starts = _starts(
        keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("__size")), bucket, "__size"
    )
    in_bucket = Window.partitionBy(*bucket).orderBy(
        _KEY, *[F.asc_nulls_first(c) for c in columns]
    )
    return (
        keyed.withColumn("__rank", F.row_number().over(in_bucket))
        .join(F.broadcast(starts), bucket)
        .select(*columns, (F.col(_START) + F.col("__rank") - 1).alias(name))
    )


def _starts(sizes: DataFrame, place: Sequence[str], size: str) -> DataFrame:
    """Total size of all buckets or ranges before each one, per leading group column if any.

    ``sizes`` has one row per bucket or range; the last column of ``place`` numbers them.
    """
    before = (
        Window.partitionBy(*place[:-1])
        .orderBy(place[-1])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long")
    return sizes.select(*place, total.alias(_START))


def running_totals(
    df: DataFrame, order: Sequence[Column], weight: str, name: str = "before"
) -> DataFrame:
    """Add the sum of ``weight`` over all rows strictly before each row in ``order``.

    ``order`` must be a total order (no two rows equal in it); group equal rows first.
    The ranges are written once because range bounds come from a sample and could differ
    between two evaluations. There are at most as many as shuffle partitions; adaptive
    execution merges neighbours that are small, which keeps their order.
    """
    ranged = materialize(
        df.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id()), "ranges"
    )
    starts = _starts(
        ranged.groupBy(_RANGE).agg(F.sum(weight).alias("__size")), [_RANGE], "__size"
    )
    earlier = (
        Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    return (
        ranged.withColumn("__inside", inside)
        .join(F.broadcast(starts), _RANGE)
        .withColumn(name, (F.col(_START) + F.col("__inside")).cast("long"))
        .drop(_RANGE, _START, "__inside")
    )


def sorted_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in ascending order of ``order``, then of the rest.

    Identical rows are counted before the range shuffle and numbered afterwards.
    """
    columns = list(order) + [c for c in df.columns if c not in order]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(_COPIES))
    placed = running_totals(
        counted, [F.asc_nulls_first(c) for c in columns], _COPIES, "__before"
    )
    return repeat_rows(placed, _COPIES, _COPY).select(
        *df.columns, (F.col("__before") + F.col(_COPY)).alias(name)
    )


def row_at(df: DataFrame, order: Sequence[str], position: Callable[[int], int]):
    """The row at ``position(number of rows)`` (0-based) in ascending order, NULL first.

    Selects column by column: value counts of the first column find the value at the position,
    the search goes on among the rows with that value, and once few rows share it, over all
    other columns at once. Only counts are shuffled, never rows.

    Returns ``(values, copies_before, copies)``: the row, how many of its copies come before
    the position and how many there are; ``values`` is None at or beyond the end, and
    ``copies_before`` then the position itself.
    """
    values, remaining, copies = [], None, None
    rows = df.select(*order)
    while len(values) < len(order):
        left = list(order[len(values):])
        small = copies is not None and copies <= SMALL_SORT
        keys = left if small else left[:1]
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COPIES))
        sort = [F.asc_nulls_first(c) for c in keys]
        if small:
            before = Window.orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
            placed = counts.withColumn(
                "__before", F.coalesce(F.sum(_COPIES).over(before), F.lit(0)).cast("long")
            )
        else:
            placed = running_totals(counts, sort, _COPIES, "__before")
        if remaining is None:
            total = placed.agg(F.sum(_COPIES).alias("n")).head()["n"] or 0
            remaining = position(total)
            if not 0 <= remaining < total:
                return None, remaining, 0
        hit = placed.filter(
            (F.col("__before") <= remaining) & (F.col("__before") + F.col(_COPIES) > remaining)
        ).head()
        values += [hit[c] for c in keys]
        remaining -= hit["__before"]
        copies = hit[_COPIES]
        rows = rows.filter(
            equals_row(keys, values[-len(keys):], [df.schema[c].dataType for c in keys])
        )
    return values, remaining, copies


def rows_before(order: Sequence[str], values: Sequence, types: Sequence) -> Column:
    """Condition "this row sorts before ``values``" in ascending order, NULL first."""
    condition = F.lit(False)
    for column, value, kind in reversed(list(zip(order, values, types))):
        here = F.col(column)
        if value is None:
            smaller = F.lit(False)
        else:
            smaller = here.isNull() | (here < F.lit(value).cast(kind))
        condition = F.coalesce(smaller, F.lit(False)) | (
            here.eqNullSafe(F.lit(value).cast(kind)) & condition
        )
    return condition


def equals_row(order: Sequence[str], values: Sequence, types: Sequence) -> Column:
    condition = F.lit(True)
    for column, value, kind in zip(order, values, types):
        condition = condition & F.col(column).eqNullSafe(F.lit(value).cast(kind))
    return condition


def split_at(
    df: DataFrame, order: Sequence[str], position: Callable[[int], int], name: str = "in_head"
) -> DataFrame:
    """Add whether a row is among the first ``position(number of rows)`` in ascending order.

    ``order`` must list every column, so rows equal in it are identical. The rows are only
    filtered; copies of the row at the cut are shared out by count.
    """
    if set(order) != set(df.columns):
        raise ValueError("order must cover every column")
    values, head_copies, copies = row_at(df, order, position)
    if values is None:
        return df.withColumn(name, F.lit(head_copies > 0))
    types = [df.schema[c].dataType for c in order]
    others = df.filter(~equals_row(order, values, types)).withColumn(
        name, rows_before(order, values, types)
    )
    row = dict(zip(order, values))
    return others.unionByName(
        copies_of(df, row, copies).select(*df.columns, (F.col("__copy") < head_copies).alias(name))
    )


def copies_of(df: DataFrame, row: dict, copies: int) -> DataFrame:
    """``copies`` rows equal to ``row`` in the layout of ``df``, numbered in ``__copy``."""
    return df.sparkSession.range(copies).select(
        *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields],
        F.col("id").alias(_COPY),
    )


def temporal_split(df: DataFrame, time: str, head_fraction: float, name: str = "split") -> DataFrame:
    """Mark the first ``floor(head_fraction * n)`` rows by time as train, the others as validation."""
    order = [time] + [c for c in df.columns if c != time]
    flagged = split_at(df, order, lambda n: int(head_fraction * n), "__head")
    return flagged.withColumn(
        name, F.when(F.col("__head"), "train").otherwise("validation")
    ).drop("__head")


def tail_fraction(df: DataFrame, time: str, start_fraction: float) -> DataFrame:
    """Rows from position ``floor(start_fraction * n)`` on in time order."""
    order = [time] + [c for c in df.columns if c != time]
    flagged = split_at(df, order, lambda n: int(start_fraction * n), "__head")
    return flagged.filter(~F.col("__head")).drop("__head")


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def latest_row(df: DataFrame, time: str, *tie_break: str) -> DataFrame:
    """The row with the greatest ``time``; a one-row heap per task."""
    return df.orderBy(F.desc(time), *[F.desc(c) for c in tie_break]).limit(1)
