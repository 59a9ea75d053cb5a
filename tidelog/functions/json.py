"""JSON columns: typed reads, payload objects, and the typed view of a payload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import INTEGER, REAL
from tidelog.schema import Column as DeclaredColumn


def typed_text(raw: Column, type_: str) -> Column:
    """The text of a JSON scalar as a declared type; text that does not fit gives NULL.

    JSON true and false count as 1 and 0 in numeric columns, and an INTEGER column keeps
    the whole part of a number with decimals.
    """
    if type_ not in (INTEGER, REAL):
        return raw
    flag = F.when(raw == "true", F.lit(1)).when(raw == "false", F.lit(0))
    if type_ == REAL:
        return F.coalesce(raw.try_cast("double"), flag.cast("double"))
    return F.coalesce(
        raw.try_cast("bigint"), raw.try_cast("double").try_cast("bigint"), flag.cast("bigint")
    )


def json_extract_cast(data: Column, column: DeclaredColumn) -> Column:
    """One declared column read out of a JSON text."""
    return typed_text(F.get_json_object(data, f"$['{column.name}']"), column.type)


def json_columns(data: Column, columns: Sequence[DeclaredColumn]) -> list[Column]:
    """Declared columns of a JSON text, parsed once per row when there are several."""
    if len(columns) == 1:
        return [json_extract_cast(data, columns[0]).alias(columns[0].name)]
    texts = T.StructType([T.StructField(c.name, T.StringType()) for c in columns])
    parsed = F.from_json(data, texts)
    return [typed_text(parsed.getField(c.name), c.type).alias(c.name) for c in columns]


def json_member(name: str, value: Column) -> Column:
    """``"name":value`` with a NULL value written as null."""
    one = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
    return F.substring(one, F.lit(2), F.length(one) - 2)


def json_object(members: Mapping[str, Column], keep: Mapping[str, Column] | None = None) -> Column:
    """A JSON object of the members whose ``keep`` condition holds, NULLs written as null.

    A struct would drop NULL members or keep all of them; which members a change entry has
    differs from row to row.
    """
    parts = [
        F.when(keep[n], json_member(n, v)) if keep is not None else json_member(n, v)
        for n, v in members.items()
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def json_object_without_nulls(members: Mapping[str, Column]) -> Column:
    return F.to_json(F.struct(*[v.alias(n) for n, v in members.items()]))


def json_rest(data: Column, named: Sequence[str]) -> Column:
    """The members of a JSON object that are not in ``named``, as a JSON object."""
    members = F.from_json(data, "map<string,variant>")
    return F.to_json(F.map_filter(members, lambda k, _: ~k.isin(list(named))))


def typed_value(value: Column) -> Column:
    """A JSON scalar (variant) as ``struct(kind, text, flag, real, whole)``.

    A string stays text even when it looks like a number; a number is real when it was
    written with a point or exponent, else whole (64 bits). JSON null gives kind 'null'.
    """
    type_name = F.schema_of_variant(value)
    kind = (
        F.when(value.isNull(), None)
        .when(type_name == "VOID", "null")
        .when(type_name == "STRING", "text")
        .when(type_name == "BOOLEAN", "flag")
        .when(type_name == "BIGINT", "whole")
        .when(type_name.startswith("ARRAY") | type_name.startswith("OBJECT"), "nested")
        .otherwise("real")
    )
    return F.struct(
        kind.alias("kind"),
        F.when(kind.isin("text", "nested"), F.try_variant_get(value, "$", "string")).alias("text"),
        F.when(kind == "flag", F.try_variant_get(value, "$", "boolean")).alias("flag"),
        F.when(kind == "real", F.try_variant_get(value, "$", "double")).alias("real"),
        F.when(kind == "whole", F.try_variant_get(value, "$", "bigint")).alias("whole"),
    )


def typed_payload(data: Column) -> Column:
    """A payload object as ``map<string, variant>``; NULL members stay as variant nulls."""
    return F.from_json(data, "map<string,variant>")


def params_to_json(params: Mapping[str, Column]) -> Column:
    """A parameter tree as JSON text with NULL values written as null.

    Values may be scalars, arrays, structs or variants.
    """
    return F.to_json(
        F.struct(*[v.alias(n) for n, v in params.items()]), {"ignoreNullFields": "false"}
    )
