"""Detection of sensitive values in stored text (S9): spans, validation, masking.

``operators.sensitive`` counts what looks like a value; here each match is also
checked (check digit and first digit of card numbers, range of address parts), its
place can be returned, and valid ones are masked. All of it is built-in
expressions on the whole text: a text is cut at the matches, so matches and the
text between them come back in order, in time that follows the text's length.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wattlake.operators.sensitive import PATTERNS


def check_digit_holds(match: Column) -> Column:
    """Whether a card number's digits add up (every second one, from the right,
    doubled, its digits added) to a multiple of ten, and it begins with 2 to 6,
    as those of payment networks do."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, at: Column) -> Column:
        d = F.substring(digits, at, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when((F.length(digits) - at) % 2 == 1, twice).otherwise(d)

    return (F.aggregate(places, F.lit(0), add) % 10 == 0) & F.substring(digits, 1, 1).between("2", "6")


def address_holds(match: Column) -> Column:
    """Whether every part of an address is at most 255."""
    return F.forall(F.split(match, r"\."), lambda part: part.cast("int") <= 255)


VALIDATORS = {"cards": check_digit_holds, "ipv4s": address_holds}


def is_valid(kind: str, match: Column) -> Column:
    return VALIDATORS[kind](match) if kind in VALIDATORS else F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)


def count_valid(text: Column, kind: str) -> Column:
    """How many valid values of a kind a text holds; 0 for null."""
    found = F.filter(_matches(text, kind), lambda m: is_valid(kind, m))
    return F.coalesce(F.size(found), F.lit(0)).cast("bigint")


def _shown(kind: str, match: Column) -> Column:
    return F.when(is_valid(kind, match), F.lit(f"[{kind}]")).otherwise(match)


def masked(text: Column, kinds=tuple(PATTERNS)) -> Column:
    """The text with each valid value replaced by its kind in brackets."""
    for kind in kinds:
        gaps = F.split(text, PATTERNS[kind], -1)
        shown = F.transform(_matches(text, kind), partial(_shown, kind))
        # one more gap than matches: pair each match with the gap after it
        pairs = F.zip_with(shown, F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))),
                           lambda m, gap: F.concat(m, gap))
        text = F.when(F.size(gaps) > 1, F.concat(gaps[0], F.array_join(pairs, ""))).otherwise(text)
    return text


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, start, length, value): every valid value, with its place in the
    text in characters, from 0. Only matches are shuffled, by row."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    text = F.col("_text")
    per_kind = F.array(*[F.struct(
        F.lit(kind).alias("kind"), _matches(text, kind).alias("found"),
        F.transform(F.split(text, PATTERNS[kind], -1), lambda g: F.length(g)).alias("gaps")) for kind in PATTERNS])
    each = rows.select(id_col, "_row", F.explode(per_kind).alias("k")).where(F.size("k.found") > 0).select(
        id_col, "_row", "k.kind", F.posexplode(F.arrays_zip("k.found", "k.gaps")).alias("_nth", "m")).where(
        "m.found is not null").select(id_col, "_row", "kind", "_nth", F.col("m.found").alias("value"), F.col("m.gaps").alias("_gap"))
    so_far = Window.partitionBy("_row", "kind").orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("value")
    placed = each.withColumn("start", (F.sum(F.col("_gap") + length).over(so_far) - length).cast("bigint"))
    valid = reduce(lambda so, kind: so.when(F.col("kind") == kind, is_valid(kind, F.col("value"))),
                   VALIDATORS, F.when(F.lit(False), True)).otherwise(True)
    return placed.where(valid).select(id_col, "kind", "start", length.cast("bigint").alias("length"), "value")


def validated_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one count of valid values a kind)."""
    return docs.select(id_col, *[count_valid(F.col(text_col), k).alias(k) for k in PATTERNS])


def scan_columns(df: DataFrame) -> DataFrame:
    """(column, kind, rows, found): rows with valid values and their number, of
    every text column of a dataset; one pass, partial sums."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), count_valid(F.col(c), k).alias("n"))
                     for c in names for k in PATTERNS])
    return df.select(F.explode(each).alias("e")).where("e.n > 0").groupBy("e.column", "e.kind").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("e.n").alias("found"))
