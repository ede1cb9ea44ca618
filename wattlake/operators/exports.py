"""Bounded, ordered export selections (F1, F2).

A plain ordered limit sends the first ``n`` rows of every input partition to
one merging task, which grows with the input. Here a cut-off key is found first:
rows are counted by range of the first sort column (partial counts per mapper, a
bounded number of ranges), the range in which the n-th row lies is counted more
finely, then by the next column among equal values, until at most ``SLACK`` * n
rows lie in it. Only rows up to the cut-off, at most (1 + SLACK) * n, are sorted,
whatever the input, its partitions and its most frequent values; identical rows
are counted, not gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, NumericType, StringType

from wattlake.schemas import PROVEEDOR_COLUMNS, TRANSACCION_COLUMNS

# Warehouse ORDER BY defaults to NULLS LAST for ascending keys.
_asc = F.Column.asc_nulls_last

SLACK = 4
RANGES = 1024


class _Range:
    """What is known of the rows still in question: they agree in all earlier
    columns, and in this one they lie between ``low`` and ``high``."""

    def __init__(self, name: str, df: DataFrame):
        self.name, self.kind = name, df.schema[name].dataType
        self.low = self.high = None

    @property
    def is_text(self) -> bool:
        return isinstance(self.kind, StringType)

    @property
    def value(self) -> Column:
        """The column as text, a double or an exact number, which sort as it does."""
        c = F.col(self.name)
        if self.is_text:
            return c
        if isinstance(self.kind, (DoubleType, FloatType)):
            return c.cast("double")
        scale = self.kind.scale if isinstance(self.kind, DecimalType) else 0
        return (F.unix_date(c) if isinstance(self.kind, DateType) else c).cast(f"decimal(38,{scale})")

    def bucket(self) -> Column:
        """The range that a value lies in; never a larger one for a smaller value.
        Text: its beginning, one character longer than all values share. Numbers:
        by sign and power of two, then in equal steps."""
        if self.is_text:
            shared = 0
            while self.low and self.low[shared:shared + 1] == self.high[shared:shared + 1] != "":
                shared += 1
            return F.substring(self.value, 1, shared + 1)
        if self.low is not None:
            step = float(self.high - self.low) / RANGES
            if step > 0:
                return F.floor((self.value - F.lit(self.low)).cast("double") / F.lit(step)).cast("double")
            return (self.value > F.lit(self.low)).cast("double")
        v = self.value.cast("double")
        size = F.when(v == 0, 0.0).otherwise(F.signum(v) * (1200 + F.floor(F.log2(F.abs(v))).cast("double")))
        return F.when(F.isnan(v), 4000.0).when(F.abs(v) == float("inf"), F.signum(v) * 3000.0).when(v.isNotNull(), size)


def candidates(df: DataFrame, order: list[str], n: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows, repeated, wanted): the first ``n`` rows are those of ``rows`` that
    come first, or all of ``rows`` and ``wanted`` copies of the one row that all
    of ``repeated`` are."""
    sure: list[Column] = []          # rows below the cut-off
    tied = F.lit(True)               # rows in question
    wanted, left = n, list(order)
    at = _Range(left.pop(0), df)
    while True:
        bucket = at.bucket()
        counts = df.where(tied).groupBy(bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(at.value).alias("low"), F.max(at.value).alias("high"))
        counts = sorted(counts.collect(), key=lambda r: (r["b"] is None, r["b"]))     # one row a range
        total = sum(r["n"] for r in counts)
        if total <= wanted + (SLACK - 1) * n:
            break                    # all rows in question can be sorted
        so_far = 0
        for r in counts:
            if so_far + r["n"] >= wanted:
                break
            so_far += r["n"]
        below = counts[:counts.index(r)]
        if below:
            last = below[-1]["high"]
            sure.append(tied & (at.value <= F.lit(last)) if last == last else tied & at.value.isNotNull())
        wanted -= so_far
        if r["b"] is None:
            tied = tied & F.col(at.name).isNull()
            same = True
        else:
            tied = tied & (bucket == F.lit(r["b"]))
            same = r["low"] == r["high"] or r["low"] != r["low"]
            at.low, at.high = r["low"], r["high"]
        if r["n"] <= wanted + (SLACK - 1) * n:
            break
        if same:
            if not left:
                return _any(df, sure), df.where(tied), wanted
            at = _Range(left.pop(0), df)
    return _any(df, [*sure, tied]), None, 0


def _any(df: DataFrame, wanted: list[Column]) -> DataFrame:
    found = F.lit(False)
    for w in wanted:
        found = found | F.coalesce(w, F.lit(False))
    return df.where(found)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in ascending order of ``order``, nulls last, then of
    the other columns."""
    order = [*order, *(c for c in df.columns if c not in order)]
    unsupported = [c for c in order if not isinstance(df.schema[c].dataType, (StringType, DateType, NumericType))]
    if unsupported:
        raise ValueError(f"cannot sort by {unsupported}")
    keys = [_asc(F.col(c)) for c in order]
    if n < 1:
        return df.limit(0)
    rows, repeated, copies = candidates(df, order, n)
    if repeated is not None:
        one = repeated.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
        rows = rows.unionByName(one.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_k")).drop("_k"))
    return rows.orderBy(*keys).limit(n)


def top_transacciones(tx: DataFrame, n: int = 1000) -> DataFrame:
    """First ``n`` transactions by date then id; the remaining columns break
    ties so the selection is deterministic."""
    return first_rows(tx.select(*TRANSACCION_COLUMNS), ["fecha_transaccion", "id_transaccion"], n)


def top_proveedores(pv: DataFrame, n: int = 1000) -> DataFrame:
    """First ``n`` providers by name; the remaining columns break ties so the
    selection is deterministic."""
    return first_rows(pv.select(*PROVEEDOR_COLUMNS),
                      ["nombre_proveedor", "fecha_contrato", "ciudad", "tipo_energia", "capacidad_mw"], n)
