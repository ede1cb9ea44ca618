"""Landing-zone text sources (A1 CSV scan, A2 first-existing path, A3 optional).

Landing files are read with a header and every column as text; typing happens
in the bronze operators.  No schema inference pass is made: with a header and
no schema, Spark reads only the first line to name the columns.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


def read_landing_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                     sep: str = ",") -> DataFrame:
    """Read delimited text with a header; all columns strings, empty -> NULL.

    With ``schema`` given, the header is still consumed but checked against
    the declared names (``enforceSchema=false``) rather than trusted by
    position.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def _is_missing_path(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def read_first_existing(spark: SparkSession, paths: Sequence[str],
                        schema: StructType | None = None) -> DataFrame | None:
    """Return the first of ``paths`` that exists, or ``None`` when none does.

    Only a missing path moves on to the next candidate; any other error
    (permissions, malformed options) propagates.
    """
    for p in paths:
        try:
            return read_landing_csv(spark, p, schema)
        except AnalysisException as exc:
            if not _is_missing_path(exc):
                raise
            log.info("landing input not found at %s", p)
    return None


# Landing file locations, relative to the landing root, in the
# order they are tried.
CONTRACT_FILES = ["contratos.csv", "contratos/contratos.csv"]
RISK_FILES = ["riesgos_precios.csv", "riesgos/riesgos_precios.csv"]


def contract_paths(landing_root: str) -> list[str]:
    return [f"{landing_root.rstrip('/')}/{f}" for f in CONTRACT_FILES]


def risk_paths(landing_root: str) -> list[str]:
    return [f"{landing_root.rstrip('/')}/{f}" for f in RISK_FILES]
