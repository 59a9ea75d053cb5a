"""Declared tables: columns, modes, options and their checks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The three column types, and the limits and message texts users match on.
INTEGER = "INTEGER"
TEXT = "TEXT"
REAL = "REAL"
MAX_COLUMNS = 1999
FORBIDDEN_CHARACTERS = re.compile(r"""["'%,.#\s\[\]]""")

SPARK_TYPES = {INTEGER: T.LongType(), TEXT: T.StringType(), REAL: T.DoubleType()}


class SchemaError(ValueError):
    """A declaration that cannot be used."""


@dataclass(frozen=True)
class Column:
    name: str
    type: str = TEXT

    @classmethod
    def text(cls, name: str) -> Column:
        return cls(name, TEXT)

    @classmethod
    def integer(cls, name: str) -> Column:
        return cls(name, INTEGER)

    @classmethod
    def real(cls, name: str) -> Column:
        return cls(name, REAL)


@dataclass(frozen=True)
class Index:
    """A named column list. Parquet statistics stand in for the index itself."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class PreviousValues:
    """Which old values an update entry carries: all, a list, or only the changed ones."""

    columns: tuple[str, ...] | None = None
    only_when_changed: bool = False


@dataclass(frozen=True)
class Options:
    local_only: bool = False
    insert_only: bool = False
    track_metadata: bool = False
    previous_values: PreviousValues | None = None
    ignore_empty_updates: bool = False

    def check(self) -> None:
        if self.local_only and self.track_metadata:
            raise SchemaError("Can't track metadata for local-only tables.")
        if self.local_only and self.previous_values is not None:
            raise SchemaError("Can't track old values for local-only tables.")


def _duplicates(names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n in seen or seen.add(n)]


@dataclass(frozen=True)
class Table:
    name: str
    columns: Sequence[Column] = ()
    indexes: Sequence[Index] = ()
    options: Options = field(default_factory=Options)
    view_name_override: str | None = None

    @property
    def view_name(self) -> str:
        return self.view_name_override or self.name

    @property
    def storage_name(self) -> str:
        return ("ps_data_local__" if self.options.local_only else "ps_data__") + self.name

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def spark_schema(self) -> T.StructType:
        declared = [T.StructField(c.name, SPARK_TYPES[c.type]) for c in self.columns]
        return T.StructType([T.StructField("id", T.StringType(), False), *declared])

    def check(self) -> None:
        if len(self.columns) > MAX_COLUMNS:
            raise SchemaError(f"Table {self.name} has more than {MAX_COLUMNS} columns, which is not supported")
        for label, value in (("table", self.name), ("view", self.view_name_override)):
            if value is not None and FORBIDDEN_CHARACTERS.search(value):
                raise SchemaError(f"Invalid characters in {label} name: {value}")
        self.options.check()
        self._check_columns()
        self._check_indexes()

    def _check_columns(self) -> None:
        names = self.column_names
        if "id" in names:
            raise SchemaError(
                f"{self.name}: id column is automatically added, custom id columns are not supported"
            )
        for name in _duplicates(names):
            raise SchemaError(f"Duplicate column {self.name}.{name}")
        for name in names:
            if FORBIDDEN_CHARACTERS.search(name):
                raise SchemaError(f"Invalid characters in column name: {self.name}.{name}")

    def _check_indexes(self) -> None:
        for name in _duplicates(i.name for i in self.indexes):
            raise SchemaError(f"Duplicate index {self.name}.{name}")
        known = {"id", *self.column_names}
        for index in self.indexes:
            if FORBIDDEN_CHARACTERS.search(index.name):
                raise SchemaError(f"Invalid characters in index name: {self.name}.{index.name}")
            for column in index.columns:
                if column not in known:
                    raise SchemaError(f"Column {self.name}.{column} not found for index {index.name}")


@dataclass(frozen=True)
class RawSchema:
    """Inferred mapping of a raw table; without ``synced_columns`` every column is synced."""

    table_name: str | None = None
    synced_columns: tuple[str, ...] | None = None
    options: Options = field(default_factory=Options)


@dataclass(frozen=True)
class Parameter:
    """What one target column of a raw table's put is filled with: id, column or rest."""

    kind: str
    column: str | None = None


ID = Parameter("id")
REST = Parameter("rest")


def from_column(name: str) -> Parameter:
    return Parameter("column", name)


@dataclass(frozen=True)
class RawTable:
    """A user-made table. ``put`` maps its columns to parameters, or ``schema`` infers them; with both, ``put`` counts.

    ``delete`` maps the columns that find a removed row, ``id`` unless stated. ``clear`` is the
    condition of the rows that a disconnect-and-clear removes; without it the table is left alone.
    """

    name: str
    put: dict[str, Parameter] | None = None
    schema: RawSchema | None = None
    delete: dict[str, Parameter] | None = None
    clear: str | None = None

    def check(self) -> None:
        if self.put is None and self.schema is None:
            raise SchemaError(f"Raw table {self.name} needs a put mapping or a schema")
        if self.delete is not None and (not self.delete or REST in self.delete.values()):
            raise SchemaError(f"Raw table {self.name} deletes by id or columns")
        if self.schema is not None:
            self.schema.options.check()


@dataclass(frozen=True)
class Schema:
    tables: Sequence[Table] = ()
    raw_tables: Sequence[RawTable] = ()

    def __post_init__(self) -> None:
        every = [*self.tables, *self.raw_tables]
        for name in _duplicates(t.name for t in every):
            raise SchemaError(f"Duplicate table name: {name}")
        for table in every:
            table.check()

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)

    @property
    def declared_names(self) -> list[str]:
        return [t.name for t in [*self.tables, *self.raw_tables]]
