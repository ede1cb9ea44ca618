"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import scratch_path

#: The white space that separates words, and a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bound of what ``join_groups`` broadcasts, in rows.
HEAVY_KEYS = 10_000

_SHIPPED: set[str] = set()
_CACHES: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and gives later joins the table's real size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Inner join of rows with a table of their groups: one row a key, column
    ``size`` tells how many rows have it, ``total`` how many rows there are.

    Keys that hold more than 1 / HEAVY_KEYS of all rows, so fewer than
    HEAVY_KEYS, are sent to the rows; only rows of the other keys are shuffled,
    and none of these keys makes a large task."""
    heavy = F.col(size) * HEAVY_KEYS > total
    sent = groups.where(heavy)
    hot = rows.join(F.broadcast(sent), on)
    rest = rows.join(F.broadcast(sent.select(*on)), on, "left_anti").join(groups.where(~heavy), on)
    return hot.unionByName(rest)


def worker_cache(name: str, make):
    """What a Python worker remembers for an operator; asking for another one's
    drops it, since workers outlive stages and memory is for one at a time."""
    if name not in _CACHES:
        _CACHES.clear()
        _CACHES[name] = make()
    return _CACHES[name]


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that Python
    workers can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    target = os.path.join(SparkFiles.getRootDirectory(), f"ship-{uuid.uuid4().hex[:8]}")
    os.makedirs(target, exist_ok=True)
    path = os.path.join(target, "wattlake_llm_code.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
