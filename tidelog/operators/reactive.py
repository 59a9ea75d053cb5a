"""Change notifications as batch replays: change sets, throttling, distinct results and edges."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import friendly_table_name
from tidelog.operators.ordered import scan_before
from tidelog.operators.skew import lookup_join
from tidelog.session import written


def on_change(
    changes: DataFrame, slot: Column, by: Sequence[str], watched: Sequence[str] | None = None
) -> DataFrame:
    """The set of changed tables per slot, under their declared names.

    A set holds table names only, so its size is bounded by the schema.
    """
    named = changes.withColumn("table_name", friendly_table_name(F.col("table_name")))
    if watched is not None:
        named = named.where(F.col("table_name").isin(list(watched)))
    return (
        named.withColumn("slot", slot)
        .groupBy(*by, "slot")
        .agg(F.array_sort(F.collect_set("table_name")).alias("tables"))
    )


def throttle(events: DataFrame, key: str, at: str, seq: str, pause: int) -> DataFrame:
    """Emissions ``(key, emitted_at, seq)`` of a throttled flow, per key.

    The first event passes. After an emission nothing passes for ``pause``; when it ends, the
    newest event that came meanwhile is emitted, and one that comes at that very instant counts.
    ``pause`` is the longer of window and consumer time. ``at`` is a bigint time and ``seq`` a
    unique bigint in the same order.

    While no gap between events exceeds the pause, emissions lie on a grid of pauses from
    the first one, and an event's emission follows from the grid's start alone. So only gaps are
    looked at in sequence: a gap above two pauses always starts a new grid, and those above one
    pause are walked from there to decide whether the grid goes on. Events are first reduced to
    one row per key and pause-long cell, in which there can be no such gap.
    """
    cell = F.floor(F.col(at) / F.lit(pause)).cast("bigint")
    placed = events.select(F.col(key), F.col(at).alias("at"), F.col(seq).alias("seq"), cell.alias("cell"))
    # Written out, since three scans below start from the cells.
    cells = written(
        placed.groupBy(key, "cell").agg(
            F.min("at").alias("first"),
            F.max("at").alias("last"),
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
        ),
        "throttle-cells",
    )
    followed = scan_before(
        cells, "cell", by=[key], lasts={"prev": F.col("last"), "prev_seq": F.col("last_seq")}
    )
    gap = F.col("first") - F.col("prev")
    starts = followed.where(F.col("prev").isNull() | (gap > pause)).withColumn(
        "hard", F.when(F.col("prev").isNull() | (gap > 2 * pause), F.col("cell"))
    )
    chained = scan_before(starts, "cell", by=[key], lasts={"earlier": F.col("hard")}).withColumn(
        "chain", F.coalesce("hard", "earlier")
    )
    fields = ["cell", "first", "first_seq", "prev", "prev_seq"]
    key_type = events.schema[key].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = grid_seq = None
        for batch in batches:
            out = []
            for c, first, first_seq, prev, prev_seq in batch[fields].itertuples(index=False):
                if grid is not None:
                    ended = grid if prev_seq == grid_seq else grid + max(1, -(-(int(prev) - grid) // pause)) * pause
                if grid is None or first > ended + pause:
                    grid, grid_seq = int(first), int(first_seq)
                out.append((grid, grid_seq))
            yield batch[[key, "cell"]].assign(
                grid=[g for g, _ in out], grid_seq=[s for _, s in out]
            )

    # Rows of a chain arrive in cell order and in batches, so a long chain needs no memory.
    ordered = chained.select(key, "chain", *fields).repartition(key, "chain").sortWithinPartitions(key, "chain", "cell")
    grids = written(
        ordered.groupBy(key, "chain").applyInPandas(
            walk, f"{key} {key_type}, cell bigint, grid bigint, grid_seq bigint"
        ),
        "throttle-grids",
    )
    gridded = cells.select(key, "cell").join(grids, [key, "cell"], "left")
    filled = scan_before(
        gridded, "cell", by=[key], lasts={"_grid": F.col("grid"), "_grid_seq": F.col("grid_seq")}
    ).select(
        key,
        "cell",
        F.coalesce("grid", "_grid").alias("grid"),
        F.coalesce("grid_seq", "_grid_seq").alias("grid_seq"),
    )
    steps = F.greatest(F.lit(1), F.ceil((F.col("at") - F.col("grid")) / F.lit(pause)))
    emitted = F.when(F.col("seq") == F.col("grid_seq"), F.col("grid")).otherwise(
        F.col("grid") + steps * F.lit(pause)
    )
    return (
        lookup_join(placed, filled, [key, "cell"], "inner", spread=F.xxhash64("seq"))
        .groupBy(key, emitted.cast("bigint").alias("emitted_at"))
        .agg(F.max("seq").alias("seq"), F.count(F.lit(1)).alias("n_events"))
    )


def changed_only(versions: DataFrame, by: Sequence[str], order: str, value: Column) -> DataFrame:
    """Result versions that differ from the one before; the first one always counts."""
    hashed = versions.withColumn("_hash", F.xxhash64(value))
    seen = scan_before(hashed, order, by=by, lasts={"_previous": F.col("_hash")})
    return seen.where(F.col("_previous").isNull() | (F.col("_previous") != F.col("_hash"))).drop(
        "_hash", "_previous"
    )


def reconnect_edges(statuses: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Status rows at which ``connected`` turns true; connected at the start counts too."""
    seen = scan_before(statuses, order, by=by, lasts={"_was": F.col("connected")})
    return seen.where(F.col("connected") & ~F.coalesce("_was", F.lit(False))).drop("_was")


def upload_trigger(
    changes: DataFrame, first_data: DataFrame, key: str, at: str, seq: str, pause: int, queue: str = "ps_crud"
) -> DataFrame:
    """When uploads are started: throttled changes of the queue, and the first data line per key."""
    queued = throttle(changes.where(F.col("table_name") == queue), key, at, seq, pause)
    starts = first_data.groupBy(key).agg(F.min(at).alias("emitted_at"), F.min(seq).alias("seq"))
    return queued.select(key, "emitted_at", "seq", F.lit("change").alias("cause")).unionByName(
        starts.withColumn("cause", F.lit("first_data"))
    )
