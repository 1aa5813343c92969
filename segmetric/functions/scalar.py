"""Column expressions (F1-F8). All are built-in Spark expressions, so they stay
inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_name(c: Column | str) -> Column:
    """every non letter/digit becomes '_', outer '_' stripped, lower case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.btrim(F.regexp_replace(c, r"[^\p{L}\p{N}]", "_"), F.lit("_")))


def label_text(c: Column | str) -> Column:
    """cast to string, trim, upper."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(c.cast("string")))


def encode_label(c: Column | str, true_values=("TRUE",), false_values=("FALSE",)) -> Column:
    """F2/V2: strict 0/1 map of a label column; anything else maps to NULL."""
    t = label_text(c)
    return F.when(t.isin(*true_values), F.lit(1)).when(t.isin(*false_values), F.lit(0)).cast("int")


def try_double(c: Column | str) -> Column:
    """Numeric coercion, bad values become NULL (plain cast raises under ANSI)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def category_order(c: Column | str, known: list[str], big: int = 1_000_000) -> Column:
    """Position in a known list first (1-based), everything else after it."""
    c = F.col(c) if isinstance(c, str) else c
    pos = F.array_position(F.array(*[F.lit(v) for v in known]), c)
    return F.when(pos > 0, pos).otherwise(F.lit(big))


def linspace_grid(steps: int) -> Column:
    """array of ``steps`` equally spaced thresholds in [0, 1] (i / (steps-1))."""
    if steps < 2:
        return F.array(F.lit(0.0))
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: i.cast("double") / F.lit(steps - 1))


def comma_list(text: str) -> list[str]:
    """F8: parse an option list like 'logreg, knn,xgb'."""
    return [s.strip() for s in str(text).split(",") if s.strip()]
