"""How queries are registered: a name, a function of a context, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starledger.session import scratch_path
from starledger.workload import roles
from starledger.workload.oracle import statement


@dataclass(frozen=True)
class Context:
    """What a query reads: the given tables, and layers that Spark derives from them."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return roles.table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        """Raw records in envelopes, stored once as they would arrive."""
        return self.star[f"raw_{name}"]

    def silver(self, name: str) -> DataFrame:
        """A stored silver table: scans of it are pruned and filtered by Spark."""
        return self.star[name]

    def narrow(self, name: str, entity: str, paths: list[str]) -> DataFrame:
        """Raw records under a schema of only the given paths."""
        return self.star.narrow(f"raw_{name}", entity, paths)

    @property
    def star(self) -> roles.Layers:
        """Stored tables of all layers."""
        return roles.layers(self.spark, self.sf_dir)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


Query = Callable[[Context], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Without ``sql`` it has no statement to agree with and is covered by unit tests."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = statement(sql)
        return run

    return register


def callable_for(run: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(Context(roles.prepare(spark), sf_dir.rstrip("/")))
