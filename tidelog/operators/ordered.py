"""Running sums and carried values over an integer order, without a global sort.

A window without a partition key puts every row into one task, and a window keyed by
client or bucket does so for a hot key. Here the order is cut into ranges of ids. Each range is a
window of its own; the ranges are summed up to one row each, in a table, and those rows are
scanned the same way to find what precedes every range. ``df`` is computed twice for each scan,
once for the sums and once for the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.session import written

# Bits of the order value dropped at each level. With a unique order a leaf window holds at
# most 2**16 rows, and a window over range summaries at most 2**20 rows; the last level
# has one row per 2**36 order values.
LEVEL_BITS = (16, 36)

# Up to this many range summaries are scanned in one window per key and broadcast.
TOP_ROWS = 100_000


def scan_before(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Adds, for each row, what came before it in ``order`` among rows with equal ``by``.

    ``sums`` maps a new column name to a numeric expression whose total over earlier rows is
    wanted (0 when there are none). ``lasts`` maps a new name to an expression whose newest
    non-NULL value over earlier rows is wanted (NULL when there is none). ``order`` is a
    bigint that is unique within ``by``; rows with NULLs in ``by`` belong together like other equals.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    prepared = df.select(
        "*",
        *[e.alias(f"_in_{n}") for n, e in {**sums, **lasts}.items()],
    )
    scanned = _scan(prepared, order, list(by), list(sums), list(lasts), LEVEL_BITS)
    return scanned.drop(*[f"_in_{n}" for n in {**sums, **lasts}])


def _scan(
    df: DataFrame, order: str, by: list[str], sums: list[str], lasts: list[str], bits: tuple[int, ...]
) -> DataFrame:
    if not bits:
        return _window_scan(df, order, by, sums, lasts)
    level = f"_range{len(bits)}"
    ranged = df.withColumn(level, F.shiftright(F.col(order), bits[0]))
    keys = [*by, level]
    inner = _window_scan(ranged, order, keys, sums, lasts)
    summary = ranged.groupBy(*keys).agg(
        *[F.sum(f"_in_{n}").alias(f"_in_{n}") for n in sums],
        *[
            F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), F.col(order))).alias(f"_in_{n}")
            for n in lasts
        ],
    )
    # Written out: the ranges are summed up once, and their number decides how to go on.
    summary = written(summary, "ranges")
    few = summary.count() <= TOP_ROWS
    deeper = () if few else tuple(b - bits[0] for b in bits[1:])
    outer = _scan(summary, level, by, sums, lasts, deeper).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(n).alias(f"_before_{n}") for n in sums + lasts],
    )
    # A NULL key is a key like any other; the range is never NULL.
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by] + [F.col(level) == F.col(f"_k_{level}")]
    match = reduce(lambda a, b: a & b, same)
    joined = inner.join(F.broadcast(outer) if few else outer, match, "left")
    merged = {
        **{n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in sums},
        **{n: F.coalesce(F.col(n), F.col(f"_before_{n}")) for n in lasts},
    }
    return joined.withColumns(merged).select(*df.columns, *sums, *lasts)


def _window_scan(
    df: DataFrame, order: str, keys: list[str], sums: list[str], lasts: list[str]
) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        *[F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(n) for n in sums],
        *[F.last(f"_in_{n}", ignorenulls=True).over(before).alias(n) for n in lasts],
    )
