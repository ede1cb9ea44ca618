"""WARC archives: writing pages, and reading archives back in parallel.

Writing: pages with equal payloads become one response, that of the smallest
id, and revisit records that refer to it. Spark's text writer lays the records
end to end, with its commit protocol on whatever file system holds the folder.

Reading splits files at any byte. A task finds the magic in its split, parses
each candidate's header, and emits the offset of the candidate and of its
successor (where its length says the next record begins), so magic inside a
payload yields candidates too. Boundary-chain verification keeps what a reader
from the start of the file would see: tasks first follow chains within their
split to where they leave it; pointer jumping from offset 0 then finds, in a
number of rounds logarithmic in the splits of a file, where each split is
entered; and each split retains what its entry reaches.

Defined results: null html is an empty payload; null or unprintable urls are
written as such characters removed; a null id is written as an empty one, and
such a page is always a response; of rows that repeat the smallest id of a
payload each is a response; a header may be of any length; one that cannot be parsed, or a record that
does not end in two line ends within the file, is no candidate; an empty table
gives an archive without records; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common
from wattlake.session import scratch_path

SPLIT_BYTES = 16 << 20
HEADER_BYTES = 1 << 16
MAX_READERS = 10_000
#: Fixed values of the format.
MAGIC, END, PROFILE = b"WARC/1.", "\r\n\r\n", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = ("path string, split bigint, offset bigint, next bigint, leaves bigint, type string, record_id string, "
          "refers_to string, uri string, stated_digest string, payload_at bigint, payload_bytes bigint, digest string")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 40 bits, eight digits, at a time."""
    sha = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_payload: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         common.whole_text(payload_col).alias("html"))
    payload = F.col("html").cast("binary")
    known = common.materialise(pages.select(
        "id", F.octet_length(payload).alias("size"),
        F.unhex(F.sha2(payload, 256)).alias("sha")).where(F.col("size") >= min_payload), "warc-payloads")
    copied = common.materialise(known.groupBy("sha").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "warc-copied")
    revisits = common.materialise(common.join_groups(known, copied, ["sha"], "n", known.count()).where("id > first").select(
        F.col("id").alias("_id"), "first").distinct(), "warc-revisits")
    again = F.col("first").isNotNull()
    body = F.concat(F.lit(HTTP_HEAD), F.when(again, F.lit("")).otherwise(F.col("html")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    head = [("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Target-URI", uri),
            ("WARC-Date", F.lit(date)), ("WARC-Record-ID", urn(F.col("id"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload)))]
    extra = F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first")),
                                   F.lit("\r\n"))).otherwise(F.lit(""))
    fields = [F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in head]
    value = F.concat(F.lit("WARC/1.1\r\n"), *fields, extra, F.lit("Content-Length: "),
                     F.octet_length("body").cast("string"), F.lit(END), F.col("body"))
    pages.join(revisits, F.col("id") == F.col("_id"), "left").withColumn("body", body).select(
        value.alias("value")).write.option("lineSep", END).text(path)


def _open(path: str):
    """Any file that both Spark and Arrow can name; ranges of it are read."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path))
    system, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(name)


def parse(head: bytes) -> dict[str, str] | None:
    """Header fields, lower-case names, of a record; None if malformed."""
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[0-9]", lines[0]):
        return None
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields if re.fullmatch("[0-9]+", fields.get("content-length", "")) else None


def header(file, start: bytes, offset: int, size: int) -> bytes | None:
    """The header of the candidate at ``offset``, whose first bytes are given,
    up to its blank line, read on as far as that is; None if the file ends
    before, or at the first line that ``parse`` would refuse."""
    head, line, seen = start, 0, 0
    if not re.match(rb"WARC/1\.[0-9]\r\n", head if len(head) >= 10 else file.read_at(min(10, size - offset), offset)):
        return None
    while (stop := head.find(END.encode(), max(0, seen - 3))) < 0:
        until = head.rfind(b"\r\n", max(0, seen - 1))
        if until >= 0:
            if any(x.find(b":") < 1 for x in head[line:until].split(b"\r\n")[0 if line else 1:]):
                return None
            line = until + 2
        seen, at = len(head), offset + len(head)
        if at >= size:
            return None
        head += file.read_at(min(max(seen, HEADER_BYTES), size - at), at)
    return head[:stop]


def candidates(path: str, split: int, begin: int, end: int, size: int) -> list[tuple]:
    """Rows as of RECORD, of the magic that starts in [begin, end)."""
    found = []
    with _open(path) as file:
        data = file.read_at(min(size, end + len(MAGIC)) - begin, begin)
        at = data.find(MAGIC)
        while 0 <= at < end - begin:
            offset = begin + at
            head = header(file, data[at:at + HEADER_BYTES], offset, size)
            fields = parse(head) if head is not None else None
            if fields is not None:
                block, n = offset + len(head) + 4, int(fields["content-length"])
                if block + n + 4 <= size:
                    inside = block + n + 4 <= begin + len(data)
                    body = data[block - begin:block - begin + n + 4] if inside else file.read_at(n + 4, block)
                    if body[n:] == b"\r\n\r\n":
                        skip = 0
                        if fields.get("content-type", "").startswith("application/http"):
                            skip = body.find(b"\r\n\r\n", 0, n) + 4 if body.find(b"\r\n\r\n", 0, n) >= 0 else n
                        digest = base64.b32encode(hashlib.sha1(body[skip:n]).digest()).decode()
                        found.append([path, split, offset, block + n + 4, 0, fields.get("warc-type"),
                                      fields.get("warc-record-id"), fields.get("warc-refers-to"),
                                      fields.get("warc-target-uri"), fields.get("warc-payload-digest"),
                                      block + skip, n - skip, digest])
            at = data.find(MAGIC, at + 1)
    leaves: dict[int, int] = {}
    for row in reversed(found):  # where the chain from here leaves the split
        row[4] = leaves[row[2]] = row[3] if row[3] >= end else leaves.get(row[3], -1)
    return [tuple(row) for row in found]


def reachable(records: DataFrame) -> DataFrame:
    """(path, offset): where the chain from the start of each file enters its
    splits, by pointer jumping: each round follows pointers of twice the
    length from all offsets reached so far."""
    jump = records.where("leaves >= 0").select("path", "offset", F.col("leaves").alias("to"))
    reached = common.materialise(records.where("offset = 0").select("path", "offset"), "warc-reached")
    n = reached.count()
    while True:
        jump = common.materialise(jump, "warc-jump")
        ahead = reached.join(jump, ["path", "offset"]).select("path", F.col("to").alias("offset"))
        valid = records.select("path", "offset")
        reached = common.materialise(reached.unionByName(ahead.join(valid, ["path", "offset"], "left_semi")).distinct(),
                                     "warc-reached")
        if (now := reached.count()) == n:
            return reached
        n = now
        then = jump.select("path", F.col("offset").alias("to"), F.col("to").alias("next"))
        jump = jump.join(then, ["path", "to"]).select("path", "offset", F.col("next").alias("to"))


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the archives in a folder: columns of RECORD."""
    common.ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    splits = files.select("path", "length", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("length") - 1) / split_bytes))).alias("split"))
    n = max(1, min(MAX_READERS, splits.count()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, split in zip(*(c.to_pylist() for c in batch.columns)):
                rows = candidates(name, split, split * split_bytes, min(size, (split + 1) * split_bytes), size)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string() if isinstance(c[0], str) or k in (5, 6, 7, 8, 9, 12) else pa.int64())
                         for k, c in enumerate(zip(*rows))], names)

    names = [c.split()[0] for c in RECORD.split(", ")]
    found = common.materialise(splits.repartition(n).mapInArrow(scan, RECORD), "warc-candidates")
    entries = reachable(found).withColumn("split", F.floor(F.col("offset") / split_bytes))

    def follow(_, left: pa.Table, right: pa.Table) -> pa.Table:
        follows = dict(zip(left.column("offset").to_pylist(), left.column("next").to_pylist()))
        seen = set()
        for at in right.column("offset").to_pylist():
            while at in follows and at not in seen:
                seen.add(at)
                at = follows[at]
        return left.filter(pa.array([o in seen for o in left.column("offset").to_pylist()], pa.bool_()))

    return found.groupBy("path", "split").cogroup(entries.groupBy("path", "split")).applyInArrow(follow, RECORD)


def read_payloads(records: DataFrame) -> DataFrame:
    """``records`` with the payload bytes, read where they lie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for path, at, n in zip(*(batch.column(c).to_pylist() for c in ("path", "payload_at", "payload_bytes"))):
                with _open(path) as file:
                    data.append(file.read_at(n, at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())],
                                             [*batch.schema.names, "payload"])

    return records.mapInArrow(run, f"{RECORD}, payload binary")


def resolved(records: DataFrame) -> DataFrame:
    """Every record with the length and digest of its full payload, which a
    revisit record takes from the response that it refers to."""
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    rows = records.select(page(F.col("record_id")).alias("page_id"), F.col("type").alias("record_type"),
                          page(F.col("refers_to")).alias("refers_to"), "payload_bytes", "digest",
                          F.regexp_replace("stated_digest", "^sha1:", "").alias("stated"))
    rows = common.materialise(rows, "warc-records")
    responses = rows.where("record_type = 'response'")
    plain = responses.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
                             F.lit(None).cast("long").alias("refers_to"))
    full = responses.where("page_id is not null").select(
        F.col("page_id").alias("refers_to"), "payload_bytes", "digest").dropDuplicates(["refers_to", "digest"])
    # the response that has the stated payload
    revisits = rows.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "stated").join(
        full, (F.col("stated") == full["digest"]) & (rows["refers_to"] == full["refers_to"]), "left").select(
        "page_id", "payload_bytes", F.col("stated").alias("payload_digest"), "record_type", rows["refers_to"])
    return plain.unionByName(revisits)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc-archive")
    write_warc(common.table(spark, sf_dir, "pages"), path)
    return resolved(read_warc(spark, path))


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, sha1(body) AS sha, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, strlen(body) AS payload_bytes,
       translate(concat(to_base(CAST('0x' || sha[1:10] AS BIGINT), 32, 8), to_base(CAST('0x' || sha[11:20] AS BIGINT), 32, 8),
                        to_base(CAST('0x' || sha[21:30] AS BIGINT), 32, 8), to_base(CAST('0x' || sha[31:40] AS BIGINT), 32, 8)),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
