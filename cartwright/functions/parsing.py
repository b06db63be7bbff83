"""Text-to-value parsing as SQL expressions.  Failure is always NULL, never an error.

Helpers take and return expression text, so a whole projection or rule list reaches
the JVM as a few strings instead of one call per operator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "DECIMAL(18,2)"
WHOLE_DECIMAL = "DECIMAL(20,6)"


def exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def named(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS `{name}`" for name, text in columns.items()]


def literal(value) -> str:
    """A string, number, boolean or NULL as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def listed(values: Iterable) -> str:
    return ", ".join(literal(v) for v in values)


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(f"({condition})" for condition in conditions) + ")"


def all_of(*conditions: str) -> str:
    return "(" + " AND ".join(f"({condition})" for condition in conditions) + ")"


def trimmed(column: str) -> str:
    return f"trim({column})"


def blank(column: str) -> str:
    """True for NULL, empty and all-space text; never NULL."""
    return f"(trim(coalesce({column}, '')) = '')"


def blank_to_null(column: str) -> str:
    return f"nullif(trim({column}), '')"


def parsed(column: str, dtype: str) -> str:
    return f"try_cast(trim({column}) AS {dtype})"


def parsed_if_present(column: str, dtype: str) -> str:
    """Parse an optional field: blank is a legitimate NULL."""
    return f"CASE WHEN NOT {blank(column)} THEN {parsed(column, dtype)} END"


def whole_number(decimal_column: str) -> str:
    """Integral decimals such as 6.0 as BIGINT; the fraction is checked by its own rule."""
    return f"CAST({decimal_column} AS BIGINT)"


def has_fraction(decimal_column: str) -> str:
    return f"({decimal_column} <> floor({decimal_column}))"


def differs(left: str, right: str, tolerance: str) -> str:
    """True where two exact amounts are further apart than the tolerance."""
    return f"(abs({left} - {right}) > CAST({tolerance} AS DECIMAL(18,2)))"


def safe_ratio(numerator: str, denominator: str, scale: int = 4) -> str:
    """Rounded DOUBLE ratio, NULL on a zero denominator."""
    return f"round(CAST({numerator} AS DOUBLE) / nullif({denominator}, 0), {scale})"


def iso_weekday(date_column: str) -> str:
    """Monday 1 to Sunday 7."""
    return f"(weekday({date_column}) + 1)"


def rows_of(structs: Iterable[dict[str, str]]) -> str:
    """A generator of one output row per dictionary of column expressions."""
    rows = [
        "named_struct(" + ", ".join(f"'{name}', {text}" for name, text in struct.items()) + ")" for struct in structs
    ]
    return f"inline(array({', '.join(rows)}))"
