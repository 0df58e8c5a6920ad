"""Where queries are registered, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyworks.plans.tables import TABLE_SQL, Tables
from tallyworks.session import tune

Plan = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None

    def run(self, spark: SparkSession, data_dir: str) -> DataFrame:
        return self.plan(Tables(tune(spark, data_dir), data_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, *, uses: str = "") -> Callable[[Plan], Plan]:
    """Register a query. ``uses`` names the mapped tables that the SQL reads."""

    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(name, plan, with_tables(sql, uses) if sql else None)
        return plan

    return add


def with_tables(sql: str, uses: str) -> str:
    names = uses.split()
    if not names:
        return sql
    views = ",\n".join(f"{name} AS ({TABLE_SQL[name]})" for name in names)
    return f"WITH {views}\n{sql}"
