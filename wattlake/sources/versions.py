"""Committed versions of datasets that are replaced a day at a time.

Every attempt to write a day goes to a folder of its own, and counts once its
entry stands in the dataset's manifest: one small file per attempt whose name
says day, number, attempt and columns, moved into place whole. Of a day, the entry with
the greatest number is current. So a rerun replaces a day in one step, also by
nothing, readers never see half a write, and a listing of the manifest is all
that is needed to know what to read. An entry's content says which versions of
other datasets it was made from, and the columns that were written.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wattlake.schemas import PARTITION_COLUMNS
from wattlake.session import remove_path

MANIFEST = "_manifest"
VERSION = "version"
PARTITIONS = [StructField(c, IntegerType()) for c in PARTITION_COLUMNS]


@dataclass(frozen=True, order=True)
class Version:
    day: _dt.date
    number: int
    attempt: str
    columns: str        # the same for versions written with the same columns

    @property
    def name(self) -> str:
        return f"{self.number:08d}-{self.attempt}"

    def folder(self, root: str) -> str:
        d = self.day
        return f"{root.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}/{VERSION}={self.name}"

    def entry(self, root: str) -> str:
        return f"{root.rstrip('/')}/{MANIFEST}/{self.day.isoformat()}.{self.name}.{self.columns}.json"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, seen whole or not at all; one that is there is replaced."""
    fs, target = _fs(spark, path)
    parent, name = path.rsplit("/", 1)
    _, part = _fs(spark, f"{parent}/_{name}.{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def history(spark: SparkSession, root: str) -> list[Version]:
    """Every committed version, in order."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{MANIFEST}")
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.endswith(".json") and not name.startswith("_"):
            day, version, columns, _ = name.split(".")
            number, attempt = version.split("-")
            out.append(Version(_dt.date.fromisoformat(day), int(number), attempt, columns))
    return sorted(out)


def current(spark: SparkSession, root: str) -> dict[_dt.date, Version]:
    """Day -> the version that counts."""
    return {v.day: v for v in history(spark, root)}


def details(spark: SparkSession, root: str, version: Version) -> dict:
    """What a committed version says of itself: ``schema`` and ``inputs``."""
    text = read_text(spark, version.entry(root))
    return json.loads(text) if text else {}


def new_version(spark: SparkSession, root: str, day: _dt.date, written: StructType) -> Version:
    return following(current(spark, root).get(day), day, written)


def following(now: Version | None, day: _dt.date, written: StructType) -> Version:
    """The version of ``day`` after ``now``, not committed yet."""
    columns = hashlib.sha256(written.json().encode()).hexdigest()[:12]
    return Version(day, now.number + 1 if now else 1, uuid.uuid4().hex[:8], columns)


def commit(spark: SparkSession, root: str, version: Version, written: StructType, inputs: dict | None = None) -> None:
    """From now on, readers find this version of its day."""
    write_text(spark, version.entry(root), json.dumps({"schema": json.loads(written.json()), "inputs": inputs or {}}))


def names(versions: dict[_dt.date, Version]) -> dict[str, str]:
    """Versions as an entry's ``inputs`` state them."""
    return {d.isoformat(): v.name for d, v in sorted(versions.items())}


def expire(spark: SparkSession, root: str, keep: int = 1, day: _dt.date | None = None) -> int:
    """Remove all but the last ``keep`` versions of each day, or of ``day``: first
    the entry, then the data. Returns how many went."""
    if keep < 1:
        raise ValueError("a day keeps its current version")
    by_day: dict[_dt.date, list[Version]] = {}
    for v in history(spark, root):
        if day is not None and v.day != day:
            continue
        by_day.setdefault(v.day, []).append(v)
    gone = [v for versions in by_day.values() for v in versions[:-keep]]
    for v in gone:
        remove_path(spark, v.entry(root))
        remove_path(spark, v.folder(root))
    return len(gone)


# ---- reading --------------------------------------------------------------------
def _conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns, whatever types a day's files have: a value that does
    not convert is NULL, a column that they lack too."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.col(f.name) if have.get(f.name) == f.dataType
        else (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def read(spark: SparkSession, root: str, chosen: list[Version], schema: StructType | None = None) -> DataFrame:
    """The rows of these versions. Days whose files were written with other types
    than declared are read with their own, and converted: one scan for each
    different set of columns, of which one entry is opened."""
    kinds: dict[str, tuple[StructType, list[str]]] = {}
    for v in chosen:
        if v.columns not in kinds:
            kinds[v.columns] = (StructType.fromJson(details(spark, root, v)["schema"]), [])
        kinds[v.columns][1].append(v.folder(root))
    if schema is None:
        merged: dict[str, object] = {}
        for written, _ in kinds.values():
            for f in written.fields:
                merged.setdefault(f.name, f)
        schema = StructType([*merged.values(), *PARTITIONS])
    out = None
    for written, folders in kinds.values():
        own = StructType([f for f in written.fields if f.name not in PARTITION_COLUMNS] + PARTITIONS)
        df = _conformed(spark.read.schema(own).option("basePath", root).parquet(*folders), schema)
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out
