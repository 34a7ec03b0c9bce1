"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stayline.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Check:
    build: Callable[[Warehouse], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register a query under a name; without SQL only its rows are looked at."""

    def add(build: Callable[[Warehouse], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"two queries are named {name}")
        CHECKS[name] = Check(build, sql)
        return build

    return add


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, other numbers as double, dates as text, for comparison."""

    def plain(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.IntegralType):
            return f"cast({name} as bigint) as {name}"
        if isinstance(field.dataType, T.NumericType):
            return f"cast({name} as double) as {name}"
        if isinstance(field.dataType, T.DateType):
            return f"cast({name} as string) as {name}"
        return name

    return df.selectExpr(*[plain(f) for f in df.schema])


def runner(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(build(Warehouse(spark, folder)))

    return run
