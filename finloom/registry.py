"""Names of all registered queries, each with its Spark plan and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finloom.operators import analysis, catalog, checks, incomes, layout, mentions, reports, statements, text, texts, twins
from finloom.plans.facts import TABLES

STATEMENTS: dict[str, Callable[[str], str]] = {**analysis.QUERIES, **checks.QUERIES, **reports.QUERIES, **text.QUERIES}


def _query(statement: Callable[[str], str]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql = statement("spark")
        for name in TABLES:
            if name in sql:
                spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
        return spark.sql(sql)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{name: _query(statement) for name, statement in STATEMENTS.items()}, **layout.FRAMES, **catalog.FRAMES, **texts.FRAMES, **statements.FRAMES, **mentions.FRAMES, **incomes.FRAMES}


def oracle_sql() -> dict[str, str]:
    return {**{name: statement("duckdb") for name, statement in STATEMENTS.items()}, **layout.FRAMES_SQL, **twins.SQL, **texts.SQL, **statements.SQL, **mentions.SQL, **incomes.SQL}
