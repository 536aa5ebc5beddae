"""Register of the queries that run over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTER: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def add(run: Run) -> Run:
        if run.__name__ in REGISTER:
            raise ValueError(f"query registered twice: {run.__name__}")
        REGISTER[run.__name__] = Query(run.__name__, run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_register() -> dict[str, Query]:
    """The register with all query modules imported."""
    from notewright.plans import (  # noqa: F401
        corpus_queries,
        quiz_queries,
        record_queries,
        search_queries,
        store_queries,
        vector_queries,
        workbook_queries,
    )

    return REGISTER
