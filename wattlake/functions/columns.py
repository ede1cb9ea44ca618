"""Typing, defaulting, stamping and guard helpers.

Typing uses ``try_cast``: with ANSI mode on (the Spark 4 default) a plain
``cast('2023-05-20' as double)`` raises, while the layer contract is that an
unparsable value becomes NULL and the row is kept.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.schemas import STAMP_COLUMNS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- guards (C3) ----------------------------------------------------------
def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def has_columns(df: DataFrame, required: Iterable[str]) -> bool:
    """True when every required column exists (decides whether a dataset is
    produced at all)."""
    return not missing_columns(df, required)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what}: missing required columns {missing}")
    return df


# ---- typing (C5, C7) ------------------------------------------------------
def safe_double(c: str | Column) -> Column:
    """Text -> double; unparsable or empty -> NULL."""
    return _col(c).try_cast("double")


def safe_date(c: str | Column) -> Column:
    """Text -> date in the default ISO form; unparsable -> NULL."""
    return _col(c).try_cast("date")


# ---- defaults (C8, C9) ----------------------------------------------------
def default_if_null(c: str | Column, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


# ---- processing-date stamp (C10) ------------------------------------------
def stamp_columns(run_date: _dt.date | None = None) -> list[Column]:
    """``processed_date`` plus its unpadded ``year/month/day`` parts."""
    d = F.lit(run_date) if run_date is not None else F.current_date()
    return [
        d.alias("processed_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    ]


def stamp(df: DataFrame, run_date: _dt.date | None = None) -> DataFrame:
    """Replace any previous stamp with the one of ``run_date``."""
    keep = [c for c in df.columns if c not in STAMP_COLUMNS]
    return df.select(*keep, *stamp_columns(run_date))


# ---- exact mean (D20) -----------------------------------------------------
def exact_avg(c: str | Column, scale: int | None = None) -> Column:
    """Mean of ``c``.

    ``scale=None`` is the plain floating ``avg``.  With a scale the sum is
    taken in ``decimal(18, scale)`` so it is independent of row order (and of
    the engine), then divided by the non-null count.  Values with more
    fractional digits than ``scale`` are rounded first.  Supported magnitude:
    below ``10**(18 - scale)`` per value (the cast keeps a compact 64-bit
    decimal; under ANSI mode a larger value fails the query rather than
    being dropped silently).  The sum itself widens to 28 digits.
    """
    col = _col(c)
    if scale is None:
        return F.avg(col)
    summed = F.sum(col.cast(f"decimal(18,{scale})")).cast("double")
    return summed / F.count(col)
