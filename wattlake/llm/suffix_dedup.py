"""Suffix-array deduplication: removes every byte that lies in a string of
``length`` bytes which also starts anywhere else.

1. Winnowing finds what has to be compared. Each window of ``length`` bytes has
   an anchor: its leftmost 128-byte string of least hash. Equal windows have
   equal anchors, so windows whose anchor occurs once in the corpus are single,
   exactly. Neighbouring windows with one anchor form a segment; segments are
   known by anchor and digest, in narrow rows.
2. All windows of a segment that occurs twice are repeated. Anchors with two or
   more different segments have one copy of each fetched and dealt to shards,
   all segments of an anchor to one shard.
3. A shard builds its suffix array by Larsson-Sadakane refinement (sort by
   seven bytes, then re-sort only groups that are still tied, by the rank at
   twice the distance), and common prefixes by Kasai's method, for all segments
   side by side. Windows that share ``length`` bytes with a neighbour in the
   array are repeated.
4. Segments of a crowded anchor are split over several shards. Windows that are
   single there are merged across shards: each shard sends the digests of its
   distinct ones in sorted order, cut into as many ranges as the anchor's bytes
   ask for, and a range searches each run in the others by bisection.
5. Repeated windows return to their documents, which are cut.

Defined results: null text is empty; strings never cross documents; ids are
whole numbers, a null id counts as a number made from the text; rows that
repeat an id and its text stand for the same places and are cut alike, and do
not repeat each other; different texts of one id are compared and cut each for
itself (together they must have less than 2 GB, else an error tells so); an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common
from wattlake.llm.substring_dedup import BASE, CHUNK_BYTES, chunk_column, keyed_texts, pack_places, rolling, unpack_places

LENGTH = 400
GRAM = 128
BLOCK = 1 << 19
SHARD_BYTES = 1 << 21
CROWDED_BYTES = 1 << 20
#: Bytes of window digests that one merging group is to hold.
RANGE_BYTES = 1 << 22
FLUSH_SEGMENTS = 200_000
#: Places that the first sort looks at.
FIRST = 7


def digest(data: bytes) -> int:
    """64 bits; only compared among strings with one 64-bit anchor."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def anchors(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of one text (bytes): (hash of the anchor, first window, number
    of windows)."""
    found = []
    last = len(text) - length  # the last window
    for at in range(0, last + 1, BLOCK):
        part = text[at:min(len(text), at + BLOCK + length - 1)].astype(np.uint64) + np.uint64(1)
        h = rolling(part, gram, BASE[0])
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # the leftmost of least hash: 44 bits of hash, then the place
        key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        least, span = key, 1
        wanted = length - gram + 1
        while 2 * span <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < wanted:
            n = len(key) - wanted + 1
            least = np.minimum(least[:n], least[wanted - span:wanted - span + n])
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        found.append((h[place[first]].view(np.int64), at + first, np.diff(np.r_[first, len(place)])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def collapse(out: list[tuple]) -> pa.RecordBatch:
    """One row for each different segment of some documents: its first place,
    and the others packed. Rows that repeat a place add none."""
    h, sig, ids, at, n = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((at, ids, sig, h))
    h, sig, ids, at, n = h[order], sig[order], ids[order], at[order], n[order]
    kind = np.ones(len(h), bool)
    kind[1:] = (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])
    kept = kind.copy()
    kept[1:] |= (ids[1:] != ids[:-1]) | (at[1:] != at[:-1])
    h, sig, ids, at, n, kind = h[kept], sig[kept], ids[kept], at[kept], n[kept], kind[kept]
    first = np.flatnonzero(kind)
    more = [pack_places(ids[a + 1:b], at[a + 1:b]) if b > a + 1 else None
            for a, b in zip(first.tolist(), np.r_[first[1:], len(h)].tolist())]
    return pa.RecordBatch.from_arrays([*(pa.array(x[first]) for x in (h, sig, ids, at, n)), pa.array(more, pa.binary())],
                                      ["anchor", "sig", "id", "at", "n", "more"])


def segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, sig, id, at, n, more) of the segments of (id, base, text): the windows
    that start at [at, at + n), counted from the base, have this anchor; sig is a digest of their bytes;
    more are further places that the task has met. So a segment that a third of
    the corpus repeats reaches the shuffle about once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("suffix", dict)  # nothing, and nothing of other operators
        out, held = [], 0
        for batch in batches:
            for i, base, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = t.as_py()
                if len(data) < length:
                    continue
                h, at, n = anchors(np.frombuffer(data, np.uint8), length, gram)
                sig = np.array([digest(data[a:b]) for a, b in zip(at.tolist(), (at + n + length - 1).tolist())], np.int64)
                out.append((h, sig, np.full(len(h), i), base + at, n))
                held += len(h)
                if held > FLUSH_SEGMENTS:
                    yield collapse(out)
                    out, held = [], 0
        if out:
            yield collapse(out)

    return rows.mapInArrow(run, "anchor bigint, sig bigint, id bigint, at bigint, n bigint, more binary")


def all_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, at, n, ranges) for each place of (id, at, n, more, ranges)."""
    for batch in batches:
        row, ids, at = [np.arange(batch.num_rows)], [batch.column(0).to_numpy()], [batch.column(1).to_numpy()]
        for k, data in enumerate(batch.column(3).to_pylist()):
            if data is not None:
                doc, start = unpack_places(data)
                row.append(np.full(len(doc), k))
                ids.append(doc)
                at.append(start)
        row = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(ids)), pa.array(np.concatenate(at)), batch.column(2).take(row),
             batch.column(4).take(row)], ["id", "at", "n", "ranges"])


def suffix_array(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of strings laid end to end: ``text`` holds a zero
    at each of ``ends`` (ascending, the last place included), where a string
    ends; an end sorts before all bytes (use values from 1), and ends by place."""
    size = len(text)
    end_of = np.repeat(ends, np.diff(ends, prepend=-1))
    rest = end_of - np.arange(size)  # bytes before the string's end
    key = text.astype(np.uint64)
    for i in range(1, FIRST):  # values up to 256: nine bits each
        key <<= np.uint64(9)
        key[:size - i] |= np.where(rest[:size - i] >= i, text[i:], 0).astype(np.uint64)
    inside = np.flatnonzero(rest)
    order = np.concatenate([ends, inside[np.argsort(key[inside])]])
    new = np.ones(size, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    new[:len(ends)] = True
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    where, fresh, h = np.arange(size), new, FIRST
    while True:
        # places in the order whose suffix is still tied with a neighbour
        where = where[~(fresh & np.r_[fresh[1:], True])]
        if not len(where):
            return order, rank
        who = order[where]
        both = rank[who] * size + rank[np.minimum(who + h, end_of[who])]
        dealt = np.argsort(both)
        who, both = who[dealt], both[dealt]
        order[where] = who
        fresh = np.ones(len(who), bool)
        fresh[1:] = both[1:] != both[:-1]
        rank[who] = np.maximum.accumulate(np.where(fresh, where, 0))
        h *= 2


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """By place in the text: how many bytes a suffix shares with the one before
    it in the suffix array. Kasai's method: going through a string, the shared
    length falls by one at most a step; all strings advance side by side, and
    eight bytes are compared at a time."""
    size = len(text)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    starts = np.r_[0, ends[:-1] + 1]
    rest = np.repeat(ends, ends - starts + 1) - np.arange(size)
    eight = np.zeros(size, np.uint64)  # the next bytes, the first one lowest
    for i in range(min(8, size)):
        eight[:size - i] |= ((text[i:].astype(np.uint64) - np.uint64(1)) & np.uint64(255)) << np.uint64(8 * i)
    shared = np.zeros(size, np.int64)
    at, have = starts[starts < ends], np.zeros((starts < ends).sum(), np.int64)
    while len(at):
        other = before[at]
        have[other < 0] = 0
        most = np.minimum(rest[at], rest[other])
        live = np.flatnonzero((other >= 0) & (have < most))
        while len(live):
            k = have[live]
            differ = eight[at[live] + k] ^ eight[other[live] + k]
            lowest = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3)
            have[live] = np.minimum(k + same, most[live])
            live = live[(differ == 0) & (have[live] < most[live])]
        shared[at] = have
        at, have = at + 1, np.maximum(have - 1, 0)
        go = rest[at] > 0
        at, have = at[go], have[go]
    return shared


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Of each string, which windows of ``length`` bytes another place of these
    strings also has."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, np.uint16)
    for s, end in zip(strings, ends.tolist()):
        text[end - len(s):end] = np.frombuffer(s, np.uint8)
        text[end - len(s):end] += 1
    order, rank = suffix_array(text, ends)
    shared = common_prefixes(text, ends, order, rank)[order]
    again = np.zeros(len(text), bool)
    near = np.flatnonzero(shared >= length)
    again[order[near]] = True
    again[order[near - 1]] = True
    return [again[end - n:max(end - n, end - length + 1)] for n, end in zip(sizes.tolist(), ends.tolist())]


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of each run of true."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shard_windows(length: int):
    """Of the segments of a shard: one row each with its repeated windows, as
    packed ranges. Where the anchor is split over shards, also the digests of
    windows, for the other shards: those single here with their places, and one
    of each that is not, without."""
    def run(table: pa.Table) -> pa.Table:
        strings = table.column("bytes").to_pylist()
        out, told = [], set()
        for anchor, part, sig, cuts, s, flag in zip(
                *(table.column(c).to_pylist() for c in ("anchor", "part", "sig", "cuts")),
                strings, repeated_windows(strings, length)):
            windows = []
            if cuts:
                for a, again in enumerate(flag.tolist()):
                    window = digest(s[a:a + length])
                    if not again or window not in told:
                        windows.append((window, -1 if again else a))
                        told.add(window)
            out.append((anchor, part, sig, cuts, np.stack(_ranges(flag), 1).astype("<i4").tobytes(),
                        np.array(windows, "<i8").tobytes() if windows else None))
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            ["anchor", "part", "sig", "cuts", "ranges", "windows"])

    return run


def deal_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (anchor, part, sig, cuts, windows): a sorted run for each of ``cuts``
    even ranges of window digests, packed: (anchor, range, part, sig, windows)."""
    for batch in batches:
        out = []
        for anchor, part, sig, cuts, data in zip(
                *(batch.column(c).to_pylist() for c in ("anchor", "part", "sig", "cuts", "windows"))):
            windows = np.frombuffer(data, "<i8").reshape(-1, 2)
            windows = windows[np.argsort(windows[:, 0])]
            group = ((windows[:, 0] >> 32) + (1 << 31)) * cuts >> 32  # by the top 32 bits
            for g in np.unique(group).tolist():
                out.append((anchor, g, part, sig, windows[group == g].tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["anchor", "range", "part", "sig", "windows"])


def merge(table: pa.Table) -> pa.Table:
    """Of one range of an anchor's window digests, in runs: the windows that
    another shard also has, found by bisection; packed by segment."""
    runs = [np.frombuffer(w, "<i8").reshape(-1, 2) for w in table.column("windows").to_pylist()]
    part = np.repeat(table.column("part").to_numpy(), [len(r) for r in runs])
    row = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
    window, place = np.concatenate(runs).T
    everything, hit = np.sort(window), np.zeros(len(window), bool)
    for p in np.unique(part):
        mine = np.flatnonzero(part == p)
        run = np.sort(window[mine])
        here = np.searchsorted(run, window[mine], "right") - np.searchsorted(run, window[mine])
        total = np.searchsorted(everything, window[mine], "right") - np.searchsorted(everything, window[mine])
        hit[mine] = total > here
    hit &= place >= 0
    found, first = np.unique(row[hit], return_index=True)
    places = np.split(place[hit], first[1:]) if len(found) else []
    ranges = [np.stack([p, p + 1], 1).astype("<i4").tobytes() for p in places]
    chosen = table.take(pa.array(found))
    return pa.table([chosen.column("anchor"), chosen.column("sig"), pa.array(ranges, pa.binary())],
                    ["anchor", "sig", "ranges"])


def repeated(chunked: DataFrame, chunks: int, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
             crowded_bytes: int = CROWDED_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, at, n, ranges): the segments of (chunk, id, base, text), at [at, at + n),
    of whose windows some ranges, or all, also start elsewhere."""
    rows = chunked.select("id", "base", "text")
    found = common.materialise(segments(rows, length, min(gram, length)), "suffix-segments")
    total = found.count()
    several = F.max(F.col("more").isNotNull())
    shared = common.materialise(found.groupBy("anchor").agg(F.count("*").alias("rows"), several.alias("many")).where(
        "rows > 1 or many").select("anchor", "rows"), "suffix-anchors")
    found = common.materialise(common.join_groups(found, shared, ["anchor"], "rows", total).drop("rows"), "suffix-shared")
    twice = several | (F.min("id") < F.max("id")) | (F.min("at") < F.max("at"))
    kinds = common.materialise(found.groupBy("anchor", "sig").agg(
        F.min("id").alias("id"), F.min_by("at", "id").alias("at"), F.first("n").alias("n"), twice.alias("twice"),
        F.count("*").alias("rows")), "suffix-kinds")
    counted = common.materialise(kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.sum(F.col("n") + (length - 1)).alias("bytes")).where("kinds > 1"), "suffix-crowds")

    # the bytes of one copy of each segment that has to be compared
    compared = common.join_groups(kinds, counted, ["anchor"], "kinds", kinds.count())
    size = counted.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    parts = F.ceil(F.col("bytes") / crowded_bytes)
    part = F.pmod(F.xxhash64("sig"), parts)
    wanted = compared.select(
        "anchor", "sig", "id", "at", "n", part.alias("part"),
        F.when(parts > 1, F.ceil(F.col("bytes") * 16 / range_bytes)).otherwise(0).cast("long").alias("cuts"),
        F.when(parts > 1, F.xxhash64("anchor", part)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).alias("shard"),
        chunk_column("id", chunks).alias("chunk"))

    def fetch(_, left: pa.Table, right: pa.Table) -> pa.Table:
        texts = {}
        for i, base, t in zip(left.column("id").to_pylist(), left.column("base").to_pylist(), left.column("text")):
            texts.setdefault(i, {})[base] = t
        data = []
        for i, a, n in zip(*(right.column(c).to_pylist() for c in ("id", "at", "n"))):
            base = max(b for b in texts[i] if b <= a)
            data.append(texts[i][base].as_py()[a - base:a - base + n + length - 1])
        return right.select(["anchor", "sig", "part", "cuts", "shard"]).append_column(
            "bytes", pa.array(data, pa.binary()))

    fetched = chunked.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(
        fetch, "anchor bigint, sig bigint, part bigint, cuts bigint, shard bigint, bytes binary")
    judged = common.materialise(fetched.groupBy((F.col("cuts") > 0).alias("crowded"), "shard").applyInArrow(
        shard_windows(length), "anchor bigint, part bigint, sig bigint, cuts bigint, ranges binary, windows binary"),
        "suffix-windows")
    merged = judged.where("windows is not null").select("anchor", "part", "sig", "cuts", "windows").mapInArrow(
        deal_windows, "anchor bigint, range bigint, part bigint, sig bigint, windows binary").groupBy(
        "anchor", "range").applyInArrow(merge, "anchor bigint, sig bigint, ranges binary")

    # back to every document that holds the segment
    whole = kinds.where("twice").select("anchor", "sig", F.lit(None).cast("binary").alias("ranges"), "rows")
    once = kinds.where("not twice").select("anchor", "sig")
    some = judged.select("anchor", "sig", "ranges").unionByName(merged).where(
        F.octet_length("ranges") > 0).join(once, ["anchor", "sig"], "left_semi").withColumn("rows", F.lit(1).cast("long"))
    back = common.materialise(whole.unionByName(some), "suffix-repeats")
    return common.join_groups(found, back, ["anchor", "sig"], "rows", total).select("id", "at", "n", "more", "ranges").mapInArrow(
        all_places, "id bigint, at bigint, n bigint, ranges binary")


def starts(at: np.ndarray, n: np.ndarray, ranges: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last window of each repeated range, in the
    document; no ranges mean all of a segment's."""
    lo, hi = [], []
    for a, k, data in zip(at.tolist(), n.tolist(), ranges):
        if data is None:
            lo.append([a])
            hi.append([a + k])
        else:
            both = np.frombuffer(data, "<i4").reshape(-1, 2)
            lo.append(a + both[:, 0])
            hi.append(a + both[:, 1])
    if not lo:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lo).astype(np.int64), np.concatenate(hi).astype(np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   with_text: bool = False, **options) -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256 (of the
    remaining bytes) and, if asked for, these as ``kept_bytes``."""
    common.ship(docs.sparkSession)
    rows, size = keyed_texts(docs, id_col, text_col)
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    chunked = rows.withColumn("chunk", chunk_column("id", chunks))
    gone = repeated(chunked, chunks, length, **options).withColumn("chunk", chunk_column("id", chunks))

    def cut(_, left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("id").to_numpy(), kind="stable")
        right = right.take(pa.array(order))
        doc = right.column("id").to_numpy()
        out = []
        for i, base, t in zip(left.column("id").to_pylist(), left.column("base").to_pylist(), left.column("text")):
            data = t.as_py()
            a, b = int(np.searchsorted(doc, i)), int(np.searchsorted(doc, i, "right"))
            mine = right.slice(a, b - a)
            lo, hi = starts(mine.column("at").to_numpy(), mine.column("n").to_numpy(), mine.column("ranges").to_pylist())
            fits = (lo >= base) & (hi + length - 1 <= base + len(data))
            lo, hi = lo[fits] - base, hi[fits] - base
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi + length - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            n = int(gone.sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if n else data
            out.append((len(data), n, len(_ranges(gone)[0]) if n else 0, hashlib.sha256(kept).hexdigest(),
                        kept if with_text else None))
        ids = pc.if_else(left.column("no_id"), pa.scalar(None, pa.int64()), left.column("id"))
        return pa.table([ids, *(pa.array([r[k] for r in out], kind) for k, kind in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    result = chunked.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(
        cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_bytes"] * with_text
    return result.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *names)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents"))
