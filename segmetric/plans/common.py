"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_floats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for reporting (both sides of a check do the same)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name) for f in df.schema.fields])


def sql_union_long(table: str, cols: list[str], value_expr: str, extra: str = "", where: str = "") -> str:
    """UNION ALL of one SELECT per column: 'col' AS feature/column, expression of the column."""
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS name, {value_expr.format(c=c)} AS v{extra} FROM {table}"
                     + (f" WHERE {where}" if where else ""))
    return "\nUNION ALL ".join(parts)
