"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from tidelog.session import written

# A lookup side is written out and measured; up to so many bytes of text, and rows, it is broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32_000_000

# A key is heavy when it holds more than 1/HEAVY_SHARE of the rows, so that there are
# fewer than HEAVY_SHARE heavy keys whatever the size of the data. This is the size bound
# that allows them to be broadcast.
HEAVY_SHARE = 1000


def heavy_keys(rows: DataFrame, on: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """The keys that hold more than ``1/share`` of ``rows``: at most ``share`` of them."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    return counts.where(F.col("_n") * share > total).select(*on)


def salt_count(rows: DataFrame) -> int:
    """Slices of one heavy key: the session's shuffle width spreads it over every task."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class Measured:
    """A written table, and whether it is small enough to be broadcast."""

    frame: DataFrame
    small: bool

    def part(self, where: Column | str, *columns: str) -> Measured:
        """Some rows and columns of it; of a small table they are small as well."""
        return Measured(self.frame.where(where).select(*columns), self.small)


def _row_bytes(df: DataFrame) -> Column:
    """The size of a row as text or as numbers of eight bytes."""
    sizes = [F.lit(0).cast("bigint")]
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint"))
        elif isinstance(field.dataType, NumericType):
            sizes.append(F.lit(8).cast("bigint"))
        else:
            sizes.append(F.length(F.to_json(F.struct(field.name))).cast("bigint"))
    return reduce(lambda a, b: a + b, sizes)


def measured(df: DataFrame, name: str = "lookup") -> Measured:
    """``df`` computed once, into a table; its rows and bytes are counted by the job that writes it."""
    seen = Observation()
    # The sizes are a column of their own below the count, since some expressions cannot be observed.
    sized = df.withColumn("_bytes", _row_bytes(df)).observe(seen, F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes"))
    frame = written(sized.drop("_bytes"), name)
    size = seen.get
    return Measured(frame, size["n"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame | Measured,
    on: Sequence[str],
    how: str = "left",
    spread: Column | None = None,
    key_sample: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined with ``lookup`` on ``on``, balanced whatever the keys of ``rows``.

    The lookup side is computed once, into a table, and measured (rows, and bytes), unless it comes ``Measured`` already. If it is small it is broadcast
    and ``rows`` are not shuffled at all. Otherwise rows of a heavy key are dealt out to as many
    slices as there are shuffle partitions and the matching lookup rows are repeated once
    per slice, so that only the few heavy keys are replicated. Rows with a NULL key match nothing
    and are dealt out the same way. ``spread`` is what the slice is computed from (by default
    the whole row), and ``key_sample`` may name a frame with the same key distribution that
    is cheaper to count.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps the rows of its left side; {how!r} does not")
    on = list(on)
    if not isinstance(lookup, Measured):
        lookup = measured(lookup)
    small, lookup = lookup.small, lookup.frame
    if small:
        return rows.join(F.broadcast(lookup), on, how)
    salts = salt_count(rows)
    heavy = heavy_keys((key_sample or rows).select(*on), on).withColumn("_heavy", F.lit(True))
    deal = F.pmod(spread if spread is not None else F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salted = (
        rows.join(F.broadcast(heavy), on, "left")
        .withColumn("_salt", F.when(F.col("_heavy") | no_key, deal).otherwise(F.lit(0)))
        .drop("_heavy")
    )
    slices = F.sequence(F.lit(0), F.when(F.col("_heavy"), F.lit(salts - 1)).otherwise(F.lit(0)))
    copies = (
        lookup.join(F.broadcast(heavy), on, "left").withColumn("_salt", F.explode(slices)).drop("_heavy")
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
