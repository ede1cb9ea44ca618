"""Zone quality rule (S8): curated data is validated before it is published;
rows that break the contract are split off to a quarantine set with a reason
instead of being silently repaired or dropped.

Checks run on the raw landing text next to the typed value, so "the value was
present but did not parse" is told apart from "the value was absent".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import safe_date, safe_double
from wattlake.schemas import CONTRATOS_COLUMNS, PROVEEDOR_COLUMNS, TRANSACCION_COLUMNS

# Fixed value: a provider name that is only a number means the row was
# shifted by one column at the source.
NUMERIC_TEXT = r"^\s*-?[0-9]+(\.[0-9]+)?\s*$"

REASON_SHIFTED = "shifted_row"
REASON_BAD_CAPACITY = "unparsable_capacidad_mw"
REASON_BAD_DATE = "unparsable_fecha_contrato"
REASON_BAD_KWH = "unparsable_cantidad_kwh"
REASON_BAD_PRICE = "unparsable_precio_kwh"
REASON_BAD_TX_DATE = "unparsable_fecha_transaccion"
REASON_DUPLICATE = "duplicate_id_transaccion"
REASON_ACCEPTED_BEFORE = "accepted_on_another_day"


def _unparsable(raw: str, typed: Column) -> Column:
    return F.col(raw).isNotNull() & (F.trim(F.col(raw)) != "") & typed.isNull()


def provider_reason(contratos: DataFrame) -> Column:
    """First failed rule of a landing provider row, NULL when it passes."""
    name = F.col("nombre_proveedor")
    return (F.when(name.rlike(NUMERIC_TEXT) & safe_double("capacidad_mw").isNull(), REASON_SHIFTED)
            .when(_unparsable("capacidad_mw", safe_double("capacidad_mw")), REASON_BAD_CAPACITY)
            .when(_unparsable("fecha_contrato", safe_date("fecha_contrato")), REASON_BAD_DATE))


def split_provider_quality(contratos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted typed providers, quarantined raw rows + ``reason``).

    One pass tags each row; both outputs filter the tagged frame, so callers
    writing both should persist ``contratos`` (or write via ``foreachBatch``).
    """
    tagged = (contratos.where(F.col("nombre_proveedor").isNotNull())
              .select(*PROVEEDOR_COLUMNS, provider_reason(contratos).alias("reason")))
    accepted = (tagged.where(F.col("reason").isNull()).drop("reason")
                .withColumns({"capacidad_mw": safe_double("capacidad_mw"),
                              "fecha_contrato": safe_date("fecha_contrato")}))
    quarantined = tagged.where(F.col("reason").isNotNull())
    return accepted, quarantined


def provider_quality_counts(contratos: DataFrame) -> DataFrame:
    """Rows per outcome (``accepted`` or the quarantine reason), one pass."""
    return (contratos.where(F.col("nombre_proveedor").isNotNull())
            .groupBy(F.coalesce(provider_reason(contratos), F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


# ---- transactions --------------------------------------------------------
def transaction_reason() -> Column:
    """First failed typing rule of a landing transaction row, NULL if none."""
    return (F.when(_unparsable("cantidad_kwh", safe_double("cantidad_kwh")), REASON_BAD_KWH)
            .when(_unparsable("precio_kwh", safe_double("precio_kwh")), REASON_BAD_PRICE)
            .when(_unparsable("fecha_transaccion", safe_date("fecha_transaccion")), REASON_BAD_TX_DATE))


def split_transaction_quality(contratos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted typed transactions, one row per id; quarantined raw rows +
    ``reason``).

    Rows with a value that is present but does not parse are quarantined.
    Among the remaining rows, an id seen more than once keeps one survivor
    (the greatest row, deterministic) and the duplicates are not published.
    The survivor is a grouped ``max(struct)``, reduced on every mapper, so an
    id repeated across a third of the data does not collect in one task.
    """
    tx = contratos.where(F.col("id_transaccion").isNotNull()).select(*TRANSACCION_COLUMNS)
    tagged = tx.withColumn("reason", transaction_reason())
    clean = tagged.where(F.col("reason").isNull()).drop("reason")
    rest = [c for c in TRANSACCION_COLUMNS if c != "id_transaccion"]
    survivors = (clean.groupBy("id_transaccion")
                 .agg(F.max(F.struct(*rest)).alias("_s"))
                 .select("id_transaccion", *[F.col(f"_s.{c}").alias(c) for c in rest]))
    accepted = survivors.withColumns({
        "cantidad_kwh": safe_double("cantidad_kwh"),
        "precio_kwh": safe_double("precio_kwh"),
        "fecha_transaccion": safe_date("fecha_transaccion")})
    return accepted, tagged.where(F.col("reason").isNotNull())


def transaction_quality_counts(contratos: DataFrame) -> DataFrame:
    """Rows per outcome: ``accepted`` (published ids), each typing reason,
    and ``duplicate_id_transaccion`` (valid rows dropped as repeats).

    One scan: rows are first counted per (id, reason) - pre-reduced on every
    mapper, so a repeated id never gathers in one task - then rolled up per
    reason."""
    per_id = (contratos.where(F.col("id_transaccion").isNotNull())
              .groupBy("id_transaccion", transaction_reason().alias("reason"))
              .agg(F.count(F.lit(1)).alias("c")))
    per_reason = per_id.groupBy("reason").agg(F.sum("c").alias("rows"),
                                              F.count(F.lit(1)).alias("ids"))
    outcomes = F.when(F.col("reason").isNull(), F.array(
        F.struct(F.lit("accepted").alias("reason"), F.col("ids").alias("n")),
        F.struct(F.lit(REASON_DUPLICATE).alias("reason"), (F.col("rows") - F.col("ids")).alias("n")),
    )).otherwise(F.array(F.struct(F.col("reason").alias("reason"), F.col("rows").alias("n"))))
    return per_reason.select(F.explode(outcomes).alias("o")).select("o.reason", "o.n")


# ---- whole landing lines, for the jobs ------------------------------------
def whole_lines(contratos: DataFrame) -> DataFrame:
    """All landing columns; those that the file lacks are NULL."""
    return contratos.select(*[F.col(c) if c in contratos.columns else F.lit(None).cast("string").alias(c)
                              for c in CONTRATOS_COLUMNS])


def rejected(lines: DataFrame, dataset: str, reason: Column | str) -> DataFrame:
    """Quarantine rows: the whole line, the dataset that it was kept from, why."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return lines.select(F.lit(dataset).alias("dataset"), reason.alias("reason"), *CONTRATOS_COLUMNS)


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one whole line per transaction id, quarantine rows). Of the valid lines
    of an id the greatest stays, each other one is quarantined. Lines are counted
    by content first, so repeats of a line meet as one row with a count."""
    tagged = lines.where(F.col("id_transaccion").isNotNull()).withColumn("reason", transaction_reason())
    clean = tagged.where(F.col("reason").isNull()).drop("reason")
    rest = [*TRANSACCION_COLUMNS[1:], *(c for c in CONTRATOS_COLUMNS if c not in TRANSACCION_COLUMNS)]
    best = clean.groupBy("id_transaccion").agg(F.max(F.struct(*rest)).alias("_best"))
    accepted = best.select("id_transaccion", *[F.col(f"_best.{c}").alias(c) for c in rest])
    counted = clean.groupBy(*CONTRATOS_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    spare = counted.join(best, "id_transaccion").withColumn(
        "_n", F.col("_n") - F.struct(*rest).eqNullSafe(F.col("_best")).cast("long")).where("_n > 0").select(
        *CONTRATOS_COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_k"))
    wrong = rejected(tagged.where(F.col("reason").isNotNull()), "transacciones", F.col("reason"))
    return accepted, wrong.unionByName(rejected(spare, "transacciones", REASON_DUPLICATE))


def typed_transactions(lines: DataFrame) -> DataFrame:
    return lines.select(*TRANSACCION_COLUMNS).withColumns({
        "cantidad_kwh": safe_double("cantidad_kwh"), "precio_kwh": safe_double("precio_kwh"),
        "fecha_transaccion": safe_date("fecha_transaccion")})


def split_provider_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed accepted providers, quarantine rows of the others)."""
    accepted, _ = split_provider_quality(lines)
    wrong = lines.where(F.col("nombre_proveedor").isNotNull()).withColumn("reason", provider_reason(lines)).where(
        F.col("reason").isNotNull())
    return accepted, rejected(wrong, "proveedores", F.col("reason"))
