"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from wattlake.functions.columns import (
    default_if_null,
    exact_avg,
    has_columns,
    missing_columns,
    require_columns,
    safe_date,
    safe_double,
    stamp,
    stamp_columns,
)

__all__ = [
    "default_if_null", "exact_avg", "has_columns",
    "missing_columns", "require_columns", "safe_date", "safe_double", "stamp",
    "stamp_columns",
]
