"""Substring deduplication over fixed-length token windows.

Every window of ``window`` words gets a Rabin-Karp hash (a polynomial over
64-bit word codes; where 64 bits are too few, a second one over second codes
joins it), and Spark counts the windows: tasks deal them into buckets
by hash, a bucket sorts its windows, and all but the earliest of each repeated
one are given back to their documents, where they merge into maximal removal
intervals.  A task that meets a window twice sends the earlier one only and
marks the other as repeated at once, so a window that a third of all documents
hold reaches its bucket once a task.

Windows travel packed: the part of the hash that the bucket does not tell, and
byte planes of document and place differences, which compress.  The hash is as
long as it takes to keep the expected number of wrong matches below a
thousandth, whatever the size of the corpus, at six bytes a word or more (three
times the windows a byte, as one-letter words have, give nine times that).

Defined results: null text has no words; windows never cross documents; ids are
whole numbers, earlier means a smaller id or an earlier start; a null id counts
as larger than any, by a hash of the text; rows that repeat an id and its text
stand for the same places and are cut alike; different texts of one id count as
parts of one document, in order of a hash, with no windows across them, and each
is cut for itself (together they must have less than 2 GB, else an error tells
so); an empty table gives an empty result; columns other than id and text are
not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import common

WINDOW = 20
FLUSH_WORDS = 1_000_000
BUCKET_WINDOWS = 1 << 18
CHUNK_BYTES = 4 << 20
#: Bytes of a word beyond which it is hashed apart, and masks of a word's last bytes.
LONG_WORD = 512
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Multipliers of the two hash streams (odd), and the bits of the first.
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ONE_STREAM = 64


def place_key(id_col: str, text_col: str) -> Column:
    """The id, or for a null one a number above all ids, from the text."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(1 << 62) + F.pmod(
        F.xxhash64(common.whole_text(text_col)), F.lit((1 << 62) - 1)))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, base, text, no_id) of each row, and the bytes of all texts. Places
    in a text count from its base, which is zero unless the id has several
    texts: these are laid end to end, so that a place tells them apart."""
    rows = docs.select(place_key(id_col, text_col).alias("id"), common.whole_text(text_col).cast("binary").alias("text"),
                       F.col(id_col).isNull().alias("no_id"))
    size, kind = F.octet_length("text").cast("long").alias("size"), F.xxhash64("text").alias("kind")
    ids = common.materialise(rows.select("id", size, kind).groupBy("id").agg(
        F.sum("size").alias("size"), (F.min("kind") < F.max("kind")).alias("several")), "text-ids")
    total, several = ids.agg(F.sum("size"), F.max("several")).first()
    if not several:
        return rows.select("id", F.lit(0).cast("long").alias("base"), "text", "no_id"), total or 0
    texts = rows.select("id", kind, size).join(ids.where("several").select("id"), "id", "left_semi").distinct()
    before = Window.partitionBy("id").orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)
    bases = common.materialise(texts.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))), "text-bases")
    if bases.agg(F.max(F.col("base") + F.col("size"))).first()[0] >= 1 << 31:
        raise ValueError("the different texts of one id have 2 GB or more")
    rows = rows.withColumn("kind", kind).join(bases.where("base > 0").drop("size"), ["id", "kind"], "left")
    return rows.select("id", F.coalesce("base", F.lit(0)).alias("base"), "text", "no_id"), total


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and one past the last of each word of texts laid end to end:
    text k is data[bounds[k]:bounds[k + 1]]."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = (data != 32) & (data - np.uint8(9) > 4)
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2] | edge[1:-1]
    last = inside[:-1] & (~inside[1:] | edge[1:])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def word_codes(data: np.ndarray, first: np.ndarray, end: np.ndarray, two: bool = False) -> np.ndarray:
    """A code for each word data[first:end], or a row of two with unlike seeds.
    The length and then eight bytes at a time are mixed in, for all words side
    by side; very long words are hashed one by one."""
    import xxhash

    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    size = end - first
    out = np.empty((len(first), 1 + two), np.uint64)
    for seed in range(1 + two):
        h = mix(size.astype(np.uint64) + (np.uint64(seed + 1) << np.uint64(56)))
        live = np.flatnonzero(size <= LONG_WORD)
        at, left = first[live], size[live]
        while len(live):
            h[live] = mix(h[live] ^ eight[at] & LOW_BYTES[np.minimum(left, 8)])
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        for k in np.flatnonzero(size > LONG_WORD).tolist():
            h[k] = xxhash.xxh64_intdigest(data[first[k]:end[k]].tobytes(), seed + 1)
        out[:, seed] = h
    return out if two else out[:, 0]


def codes(words: list[bytes], two: bool = False) -> np.ndarray:
    """As ``word_codes``, of words given one by one."""
    end = np.cumsum([len(w) for w in words], dtype=np.int64)
    return word_codes(np.frombuffer(b"".join(words), np.uint8), np.r_[0, end[:-1]].astype(np.int64)[:len(words)], end, two)


def text_codes(column: pa.Array, two: bool = False) -> Iterator[np.ndarray]:
    """Word codes of each text of a binary column, some MB of texts at a time."""
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    everything = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        bounds = offsets[a:b + 1] - offsets[a]
        data = everything[offsets[a]:offsets[b]]
        first, end = word_places(data, bounds)
        yield from np.split(word_codes(data, first, end, two), np.searchsorted(first, bounds[1:-1]))
        a = b


def rolling(values: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hashes, modulo 2**64, of all runs of ``n`` values: runs of 1,
    2, 4, ... are joined to the wanted length."""
    size, done, run = 1, None, values
    done_size = 0
    while True:
        if n & size:
            if done is None:
                done, done_size = run, size
            else:
                total = done_size + size
                lift = np.uint64(pow(base, done_size, 1 << 64))
                done = run[: len(values) - total + 1] * lift + done[size: size + len(values) - total + 1]
                done_size = total
        if 2 * size > n:
            return done
        lift = np.uint64(pow(base, size, 1 << 64))
        run = run[:-size] * lift + run[size:]
        size *= 2


def planes(a: np.ndarray) -> bytes:
    """The bytes of whole numbers, all first bytes first."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplaned(data: memoryview, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).view(kind).reshape(n)


def pack_places(docs: np.ndarray, starts: np.ndarray) -> bytes:
    """Of places in order of document and start."""
    return planes(np.diff(docs, prepend=0)) + planes(starts.astype(np.int32))


def unpack_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    view = memoryview(data)
    return np.cumsum(unplaned(view[:8 * n], n, np.int64)), unplaned(view[8 * n:], n, np.int32).astype(np.int64)


def hash_bits(windows: int) -> float:
    """Bits of hash to compare: twice those of the number of windows and ten more."""
    return 2 * math.log2(max(windows, 2)) + 10


def hash_bytes(windows: int, buckets: int) -> int:
    """Bytes of hash to send: without the bits that the bucket tells."""
    return min(16, max(1, math.ceil((hash_bits(windows) - math.log2(buckets)) / 8)))


def two_streams(windows: int, width: int) -> bool:
    """Whether the first stream is shorter than the hash."""
    return hash_bits(windows) > ONE_STREAM or width > 8


def _sent(h: np.ndarray, h2: np.ndarray | None, bits: int, width: int) -> np.ndarray:
    """A row of ``width`` bytes for each hash. With a second stream its top bits
    take the place of those that the bucket tells, so that bucket and bytes hold
    ``bits + 8 * width`` bits; without one the bytes are the low ones of the
    first stream, whose 64 bits may reach into the bucket's."""
    low = h
    if h2 is not None and bits:
        low = h << np.uint64(bits) | h2 >> np.uint64(64 - bits)
    both = low.view(np.uint8).reshape(-1, 8)
    if width > 8:
        both = np.hstack([both, h2.view(np.uint8).reshape(-1, 8)])
    return both[:, :width]


def _flush(ids: list[int], texts: list[np.ndarray], window: int, bits: int, width: int,
           two: bool, bases: list[int] | None = None) -> pa.RecordBatch | None:
    """Packed windows of some documents, given as word codes."""
    bases = bases or [0] * len(ids)
    order = sorted(range(len(ids)), key=lambda k: (ids[k], bases[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    if sizes.sum() < window:
        return None
    value = np.concatenate([texts[k] for k in order])
    doc = np.repeat(np.arange(len(order)), sizes)
    start = np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(start <= sizes[doc] - window)
    if not len(at):
        return None
    h = rolling(value[:, 0] if two else value, window, BASE[0])[at]
    h2 = None
    start = start[at] + np.array([bases[k] for k in order], np.int64)[doc[at]]
    doc = np.array([ids[k] for k in order], np.int64)[doc[at]]
    by_hash = np.argsort(h, kind="stable")
    same = np.zeros(len(h), bool)  # as an earlier one here
    same[by_hash[1:]] = h[by_hash[1:]] == h[by_hash[:-1]]
    if two:
        h2 = rolling(value[:, 1], window, BASE[1])[at]
        by_hash = np.lexsort((h2, h))
        same[:] = False
        same[by_hash[1:]] = (h[by_hash[1:]] == h[by_hash[:-1]]) & (h2[by_hash[1:]] == h2[by_hash[:-1]])
    # repeated rows hold the very same places: those are not repeats
    first = by_hash[np.maximum.accumulate(np.where(same[by_hash], 0, np.arange(len(h))))]
    gone = by_hash[same[by_hash] & ((doc[by_hash] != doc[first]) | (start[by_hash] != start[first]))]
    gone = np.sort(gone)
    send = np.flatnonzero(~same)
    bucket = (h[send] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(send), np.int64)
    dealt = np.argsort(bucket, kind="stable")
    send, bucket = send[dealt], bucket[dealt]
    spread = (doc[gone] * 0x9E3779B1 >> 7) & ((1 << bits) - 1)  # by document: these need no counting
    dealt = np.argsort(spread, kind="stable")
    gone, spread = gone[dealt], spread[dealt]
    rows = np.unique(np.r_[bucket, spread])
    a, b = np.searchsorted(bucket, rows), np.searchsorted(bucket, rows, "right")
    c, d = np.searchsorted(spread, rows), np.searchsorted(spread, rows, "right")
    hashes, places, lost = [], [], []
    for i in range(len(rows)):
        mine, its = send[a[i]:b[i]], gone[c[i]:d[i]]
        hashes.append(np.ascontiguousarray(_sent(h[mine], h2[mine] if two else None, bits, width).T).tobytes())
        places.append(pack_places(doc[mine], start[mine]))
        lost.append(pack_places(doc[its], start[its]))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.astype(np.int32)), pa.array(hashes, pa.binary()), pa.array(places, pa.binary()),
         pa.array(lost, pa.binary())], ["bucket", "hashes", "places", "lost"])


def windows(rows: DataFrame, window: int, bits: int, width: int, two: bool,
            flush_words: int = FLUSH_WORDS) -> DataFrame:
    """Packed windows of (id, base, text): bucket, hashes, places, and lost: places
    already known to repeat an earlier window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("windows", dict)  # nothing, and nothing of other operators
        ids, bases, texts, n = [], [], [], 0
        for batch in batches:
            for i, base, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      text_codes(batch.column(2), two)):
                ids.append(i)
                bases.append(base)
                texts.append(words)
                n += len(words)
                if n >= flush_words:
                    if (out := _flush(ids, texts, window, bits, width, two, bases)) is not None:
                        yield out
                    ids, bases, texts, n = [], [], [], 0
        if (out := _flush(ids, texts, window, bits, width, two, bases)) is not None:
            yield out

    return rows.mapInArrow(run, "bucket int, hashes binary, places binary, lost binary")


def repeated(packed: DataFrame, width: int, chunks: int) -> DataFrame:
    """(chunk, places): where windows start that repeat an earlier one, packed
    by chunk of documents."""
    def count(table: pa.Table) -> pa.Table:
        keys, doc, start, lost_doc, lost_start = [], [], [], [], []
        for h, p, lost in zip(*(table.column(c).to_pylist() for c in ("hashes", "places", "lost"))):
            n = len(h) // width
            keys.append(np.frombuffer(h, np.uint8).reshape(width, n).T)
            for data, docs, starts in ((p, doc, start), (lost, lost_doc, lost_start)):
                d, s = unpack_places(data)
                docs.append(d)
                starts.append(s)
        wide = np.zeros((sum(map(len, keys)), 16), np.uint8)
        wide[:, :width] = np.concatenate(keys)
        wide = wide.view(np.uint64)
        doc, start = np.concatenate(doc), np.concatenate(start)
        order = np.lexsort((start, doc, wide[:, 0]) if width <= 8 else (start, doc, wide[:, 0], wide[:, 1]))
        wide, doc, start = wide[order], doc[order], start[order]
        same = np.zeros(len(doc), bool)
        same[1:] = (wide[1:] == wide[:-1]).all(axis=1)
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))
        later = same & ((doc != doc[first]) | (start != start[first]))
        return places_by_chunk(np.concatenate([doc[later], *lost_doc]), np.concatenate([start[later], *lost_start]), chunks)

    return packed.groupBy("bucket").applyInArrow(count, "chunk int, places binary")


def chunk_of(doc: np.ndarray, chunks: int) -> np.ndarray:
    """As the SQL expression of ``chunk_column``."""
    return (doc ^ (doc >> 16)) % chunks


def chunk_column(key: str, chunks: int) -> Column:
    return F.pmod(F.col(key).bitwiseXOR(F.shiftright(key, 16)), F.lit(chunks)).cast("int")


def places_by_chunk(doc: np.ndarray, start: np.ndarray, chunks: int) -> pa.Table:
    chunk = chunk_of(doc, chunks)
    order = np.lexsort((start, doc, chunk))
    chunk, doc, start = chunk[order], doc[order], start[order]
    cuts = np.r_[np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk)]
    return pa.table({
        "chunk": pa.array(chunk[cuts[:-1]].astype(np.int32)),
        "places": pa.array([pack_places(doc[a:b], start[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _cut(words: list[bytes], starts: np.ndarray, window: int) -> tuple[list[bytes], int, int]:
    """Kept words, and the number of words and of maximal intervals removed."""
    if not len(starts):
        return words, 0, 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum()), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = False, flush_words: int = FLUSH_WORDS) -> DataFrame:
    """One row per row: id, n_words, n_removed, n_spans, kept_sha256 (of the
    kept words joined by one space) and, if asked for, these as ``kept_text``."""
    common.ship(docs.sparkSession)
    rows, size = keyed_texts(docs, id_col, text_col)
    n = max(1, size // 6)
    bits = max(4, math.ceil(math.log2(n / BUCKET_WINDOWS))) if n > BUCKET_WINDOWS else 4
    width = hash_bytes(n, 1 << bits)
    two = two_streams(n, width)
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    gone = repeated(windows(rows.select("id", "base", "text"), window, bits, width, two, flush_words), width, chunks)

    def cut(_, left: pa.Table, right: pa.Table) -> pa.Table:
        starts = {}
        if right.num_rows:
            found = [unpack_places(p) for p in right.column("places").to_pylist()]
            doc, at = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(doc, kind="stable")
            doc, at = doc[order], at[order]
            edges = np.r_[np.flatnonzero(np.diff(doc, prepend=-(1 << 62))), len(doc)]
            starts = {int(doc[a]): at[a:b] for a, b in zip(edges[:-1], edges[1:])}
        out = []
        for i, base, t in zip(left.column("id").to_pylist(), left.column("base").to_pylist(), left.column("text")):
            words = t.as_py().split()
            at = starts.get(i, np.zeros(0, np.int64)) - base
            kept, removed, spans = _cut(words, at[(at >= 0) & (at <= len(words) - window)], window)
            text = b" ".join(kept)
            out.append((len(words), removed, spans, hashlib.sha256(text).hexdigest(),
                        text.decode() if with_text else None))
        ids = pc.if_else(left.column("no_id"), pa.scalar(None, pa.int64()), left.column("id"))
        return pa.table([ids, *(pa.array([r[k] for r in out], kind) for k, kind in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())))],
            ["id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    chunked = rows.withColumn("chunk", chunk_column("id", chunks))
    result = chunked.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(
        cut, "id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    names = ["n_words", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    return result.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *names)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS said
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY said ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (
  SELECT doc_id, i AS place, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM later)),
per AS (
  SELECT doc_id, list(place) AS places, count(*) AS n_removed,
         count(*) FILTER (WHERE before IS NULL OR before < place - 1) AS n_spans
  FROM gone GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.place) AS text
  FROM words w ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN per ON per.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
