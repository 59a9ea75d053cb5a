"""Rows whose columns may have any names, beside the names that an operator uses itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as a reference to it, also when it holds a point or a backtick."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns in one struct, in which none can clash; ``name.*`` gives them back."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many signs ``_`` behind it as make it differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
