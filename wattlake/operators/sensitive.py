"""Sensitive-data detection over stored text.

Each pattern is counted over the whole text of every document with
``regexp_count`` (JVM regex, no Python), then rolled up per language.  No
repetition is capped.  A pattern that begins with an open run (e-mail) may only
start where the run does, and runs are possessive, so a long junk run is read
once instead of once from each of its places.  Numbers are told from longer
digit runs by what stands before and after them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Detector name -> pattern.
PATTERNS = {
    "emails": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}",
    "phones": r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])",
    "cards": r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9])",
    "ipv4s": r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "secrets": r'(?i)(?:token|secret|password|api_key)\s*+=\s*+"[^"]++"',
}


def flag_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: one match count per detector plus ``flagged``."""
    counts = {k: F.coalesce(F.regexp_count(F.col(text_col), F.lit(p)), F.lit(0)).cast("bigint")
              for k, p in PATTERNS.items()}
    out = docs.withColumns(counts)
    any_hit = None
    for k in PATTERNS:
        any_hit = (F.col(k) > 0) if any_hit is None else (any_hit | (F.col(k) > 0))
    return out.withColumn("flagged", any_hit)


def sensitive_counts(docs: DataFrame, by: str = "lang") -> DataFrame:
    """Documents, flagged documents and matches per detector, per ``by``."""
    flagged = flag_documents(docs.select(by, "text"))
    aggs = [F.count(F.lit(1)).alias("n_docs"),
            F.count(F.when(F.col("flagged"), 1)).alias("n_flagged")]
    aggs += [F.sum(k).alias(k) for k in PATTERNS]
    return flagged.groupBy(by).agg(*aggs)
