"""Inline relations: rows written into the plan."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


def _sql(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """The rows as a VALUES relation under a ``name type, ...`` schema.

    Spark knows the size of such a relation and broadcasts it by itself; rows
    handed over by ``createDataFrame`` have no known size and would make it
    shuffle the other side of a join.
    """
    fields = [field.strip().split(" ", 1) for field in re.split(r",\s+(?=\w+ )", schema)]
    if not rows:
        return spark.createDataFrame([], schema)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    values = ", ".join("(" + ", ".join(map(_sql, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
