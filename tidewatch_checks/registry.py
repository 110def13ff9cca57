"""Registry of named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch_checks.tables import Tables, with_tables

DIGITS = 6


@dataclass(frozen=True)
class Check:
    run: Callable[[Tables], DataFrame]
    sql: str | None
    floats: tuple[str, ...]
    digits: int


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None, floats: str = "", digits: int = DIGITS):
    """Register ``fn(tables)`` under ``name``.

    ``floats`` lists the double columns of the result; both sides round them to the same digits, as
    summation order differs between engines.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(fn, sql, tuple(floats.split()), digits)
        return fn

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def spark_query(name: str) -> Callable:
    entry = CHECKS[name]
    return lambda spark, sf_dir: rounded(entry.run(Tables(spark, sf_dir)), entry.digits)


def sql_query(name: str) -> str | None:
    entry = CHECKS[name]
    if entry.sql is None:
        return None
    body = entry.sql.strip()
    if entry.floats:
        shown = ", ".join(f'CAST(round(CAST("{c}" AS DOUBLE), {entry.digits}) AS DOUBLE) + 0.0 AS "{c}"' for c in entry.floats)
        body = f"SELECT * REPLACE ({shown}) FROM ({body}) AS result"
    return with_tables(body)
