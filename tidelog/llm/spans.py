"""Digest columns of an array of spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the order of the array."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest_columns(spans: Column, base: Sequence[str]) -> list[Column]:
    """A count per base kind, the digest of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kept = F.filter(spans, lambda s: s["kind"].isin(list(base)))
    return [*map(count, base), F.sha2(joined(kept).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans")]
