"""Registry of named queries with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FAMILIES: tuple[str, ...] = ("episodes", "sequences", "relations", "scalars", "samples", "graphs", "storage", "reports", "candidates")

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
_mixtures: dict[str, tuple[str, ...]] = {}
_columns: dict[str, Callable[[DataFrame], Column]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name of its own, with its SQL if it has one."""

    def add(f: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = f
        if sql:
            _oracles[name] = sql
        return f

    return add


def _load() -> None:
    for family in FAMILIES:
        import_module(f"weft.plans.{family}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)


def mixture(name: str, parts: list[str]) -> dict[str, Query]:
    """Register a set of queries under a name of its own; every part must be a query."""
    if name in _mixtures:
        raise ValueError(f"mixture {name} is registered twice")
    known = queries()
    found = {part: known[part] for part in parts}
    _mixtures[name] = tuple(parts)
    return found


def mixtures() -> dict[str, tuple[str, ...]]:
    return dict(_mixtures)


class Runner:
    """Runs queries one after the other; a subclass overrides its hooks."""

    def select(self, names: list[str]) -> list[str]:
        """Which queries run, and in which order."""
        return names

    def before(self, name: str) -> None:
        """Before a query is built."""

    def after(self, name: str, df: DataFrame) -> DataFrame:
        """What becomes of a query's result."""
        return df

    def failed(self, name: str, error: Exception) -> None:
        """A query that cannot be built ends the run, unless this is overridden."""
        raise error

    def run(self, spark: SparkSession, sf_dir: str, wanted: dict[str, Query]) -> dict[str, DataFrame]:
        out = {}
        for name in self.select(list(wanted)):
            self.before(name)
            try:
                out[name] = self.after(name, wanted[name](spark, sf_dir))
            except Exception as error:  # noqa: BLE001
                self.failed(name, error)
        return out


def column(name: str) -> Callable:
    """Register a provider of a column: a function from a frame to an expression over it."""

    def add(f: Callable[[DataFrame], Column]) -> Callable[[DataFrame], Column]:
        if name in _columns:
            raise ValueError(f"column {name} is registered twice")
        _columns[name] = f
        return f

    return add


def with_columns(df: DataFrame, *names: str) -> DataFrame:
    """df with columns of registered providers."""
    return df.withColumns({name: _columns[name](df) for name in names})
