"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipcatalog.queries.fixtures import FIXTURES, duckdb_text, spark_text, used_tables
from clipcatalog.queries.views_sql import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES: dict[str, str] = {}


class Inputs:
    """The given tables of one folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table, in the partitions it is laid out in."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fx(self, name: str) -> DataFrame:
        text = spark_text(name)
        for table in used_tables(text):
            self.table(table).createOrReplaceTempView(table)
        return self.spark.sql(text)


def with_inputs(sql: str) -> str:
    """Prefix a statement with the derived inputs and views it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in [*FIXTURES, *VIEWS]:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS.get(name) or FIXTURES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    bodies = [f"{n} AS ({VIEWS.get(n) or duckdb_text(n)})" for n in needed]
    body = sql.strip()
    if re.match(r"with\b", body, re.I):
        bodies.append(re.sub(r"^with\b", "", body, flags=re.I).strip())
        return "WITH " + ",\n".join(bodies)
    return ("WITH " + ",\n".join(bodies) + "\n" if bodies else "") + body


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` under a name, with its checking SQL."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        MODULES[name] = build.__module__
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return build

    return register
