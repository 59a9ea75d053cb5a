"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidelog.plans.fixtures import Fixtures, with_fixtures


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    oracle: str | None

    def oracle_text(self) -> str | None:
        return with_fixtures(self.oracle) if self.oracle else None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Registers a builder under an operator's name."""

    def add(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return add
