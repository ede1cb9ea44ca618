import base64
import hashlib

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare
from wattlake.llm import warc
from wattlake.session import scratch_path

SCHEMA = "page_id long, url string, html string, first long, body string, path string"


def inner(n):
    body = f"HTTP/1.1 200 OK\r\n\r\nfake {n}"
    return ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
            f"Content-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n")


def pages(spark, rows=None):
    if rows is None:
        rows = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "u\r\nX: y", ""),
                (5, "http://a/5", "long " * 20000), (6, "http://a/6", inner(1)), (7, "http://a/7", "x" + inner(2) * 40),
                (8, "http://ä/8", "é漢\x00\r\n\r\nWARC/1.1\r\n"), (9, "http://a/9", "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
                (10, "http://a/10", "<p>one</p>"), (11, "http://a/11", inner(1)), (12, "http://a", "WARC/1.1\r\n\r\nWARC/1.")]
    return spark.createDataFrame([(*r, 3, "b", "p") for r in rows], SCHEMA).repartition(3)


def by_hand(rows):
    first, out = {}, {}
    for i, _, html, *_ in sorted(rows):
        first.setdefault(html or "", i)
    for i, _, html, *_ in rows:
        data, f = (html or "").encode(), first[html or ""]
        out[i] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "response" if f == i else "revisit", None if f == i else f)
    return out


def digest(rows):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}


@pytest.mark.parametrize("split_bytes", [64, 1000, 16 << 20])
def test_round_trip(spark, split_bytes):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark), path)
    records = warc.read_warc(spark, path, split_bytes)
    rows = warc.resolved(records).collect()
    assert len(rows) == 12 and digest(rows) == by_hand(pages(spark).collect())


def test_payloads_come_back(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark), path)
    read = warc.read_payloads(warc.read_warc(spark, path, 500)).where("type = 'response'").collect()
    want = {r.page_id: (r.html or "").encode() for r in pages(spark).collect()}
    for r in read:
        assert bytes(r.payload) == want[int(r.record_id[10:-1])]
        assert r.stated_digest == "sha1:" + r.digest


def test_archives_written_elsewhere(spark, tmp_root):
    """Other header order and case, no http block, an unrelated tail; and a
    chain that breaks: what follows the break is not read."""
    def record(n, body, kind="resource"):
        return (f"WARC/1.0\r\ncontent-length: {len(body)}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{n}>\r\n\r\n"
                ).encode() + body + b"\r\n\r\n"
    good = record(1, b"\xff\xfe" * 30) + record(2, record(77, b"in")) + record(3, b"")
    with open(f"{tmp_root}/good.warc", "wb") as f:
        f.write(good)
    with open(f"{tmp_root}/broken.warc", "wb") as f:
        f.write(record(4, b"four") + b"garbage" + record(5, b"five"))
    with open(f"{tmp_root}/late.warc", "wb") as f:
        f.write(b"\n" + record(6, b"six"))
    for split in (16, 150, 1 << 20):
        found = warc.read_payloads(warc.read_warc(spark, tmp_root, split)).collect()
        assert sorted((r.record_id, bytes(r.payload)) for r in found) == [
            ("<urn:page:1>", b"\xff\xfe" * 30), ("<urn:page:2>", record(77, b"in")), ("<urn:page:3>", b""),
            ("<urn:page:4>", b"four")]


def test_long_header(spark, tmp_root):
    head = "WARC/1.1\r\nWARC-Type: resource\r\nX-Long: " + "v" * 200_000 + "\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    with open(f"{tmp_root}/a.warc", "wb") as f:
        f.write(head.encode() * 3)
    assert warc.read_warc(spark, tmp_root, 50_000).count() == 3


@pytest.mark.parametrize("split_bytes", [100_000, 16 << 20])
def test_url_of_any_length(spark, split_bytes):
    """Records after one with a header of several MiB are read too."""
    rows = [(1, "http://a/1", "one"), (2, "data:" + "u" * (5 << 20), "two"), (3, "http://a/3", "three"), (4, "u", "two")]
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark, rows).coalesce(1), path)
    found = warc.read_warc(spark, path, split_bytes).collect()
    assert sorted((r.uri, r.type) for r in found) == sorted((u, "revisit" if i == 4 else "response") for i, u, _ in rows)


def test_headers_by_the_piece(tmp_path, monkeypatch):
    """As if the whole file were searched and parsed, wherever reads end."""
    data = (b"WARC/1.1\r\nA: b\r\nContent-Length: 2\r\n\r\nok\r\n\r\nWARC/1.1\r\nno colon\r\nA: b\r\n\r\n"
            b"WARC/1.1x\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.1\r\n: x\r\n\r\nWARC/1.1\r\nA: b\r\n")
    path = str(tmp_path / "a")
    with open(path, "wb") as f:
        f.write(data)
    for step in range(1, 40):
        monkeypatch.setattr(warc, "HEADER_BYTES", step)
        with warc._open(path) as file:
            for at in (i for i in range(len(data)) if data.startswith(warc.MAGIC, i)):
                stop = data.find(b"\r\n\r\n", at)
                want = warc.parse(data[at:stop]) if stop >= 0 else None
                found = warc.header(file, data[at:at + step], at, len(data))
                assert (warc.parse(found) if found is not None else None) == want


def test_base32(spark):
    from pyspark.sql import functions as F

    for text in ("", "abc", "é" * 99):
        found = spark.range(1).select(warc.base32_sha1(F.lit(text).cast("binary"))).first()[0]
        assert found == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_smallest_payload_that_is_collapsed(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark), path, min_payload=20)
    rows = digest(warc.resolved(warc.read_warc(spark, path)).collect())
    assert all(rows[i][2] == "response" for i in (1, 2, 3, 4, 10)) and rows[11][2:] == ("revisit", 6)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "u", "same"), (3, "u", "same"), (3, "u", "same"), (5, "u", "same"), (None, None, None)]
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark, rows), path)
    found = warc.resolved(warc.read_warc(spark, path)).collect()
    assert len(found) == 5 and [r.refers_to for r in found if r.page_id == 5] == [3]
    assert [r.record_type for r in found if r.page_id == 3] == ["response"] * 2
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages(spark, []), path)
    assert warc.resolved(warc.read_warc(spark, path)).count() == 0


def test_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert digest(warc.op4_warc(spark, SF_SMALL).collect()) == by_hand([(r.page_id, r.url, r.html) for r in rows])


def test_oracle(spark):
    assert compare(spark, SF_SMALL, ["op4_warc"], verbose=False)["op4_warc"][0] == "ok"
