"""Best-fit packing of tokenised documents into sequences.

Documents are tokenised in place (no text is moved) and cut into pieces of at
most ``capacity`` tokens.  Piece lengths and gaps are whole numbers up to
``capacity``, so pieces and gaps fall into at most ``capacity`` classes whose
members are interchangeable, and matching needs their counts only.  It is one
serial loop on the driver (``plan``), not distributed sweeps: the pieces of one
length at a time, longest first, go to the smallest gap that holds them, filling
each gap as often as the length fits; the k-th piece of a length takes the k-th
place; gaps shrink; what finds no gap opens new sequences.  The result is that of
best-fit decreasing.

Only class counts reach the driver (at most ``capacity`` numbers); the step
table that goes back holds rank intervals, whose number depends on the
capacity and not on the data.  Pieces find their rank in parallel: a hash
deals each length over as many buckets as its count asks for, pieces are
numbered within their bucket only, and counts of buckets and of blocks of
buckets give each bucket's first rank.

Defined results: null text is empty, so one end token; ids may be null or
repeat, each row is packed for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import math
import os
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import common

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Pieces of a bucket, buckets of a block: one task numbers so many at a time.
BUCKET_ROWS = BLOCK_BUCKETS = 1000
#: Words and word bodies whose ids a worker remembers, and the longest in bytes.
CACHED_WORDS, CACHED_BODIES, CACHED_BYTES = 500_000, 600_000, 64
#: Fixed value: how the tokenizer's tokens end a word. Words encoded in one string.
WORD_END, JOINED, STOPS = "</w>", 128, b".,"


def _tokenizer(path: str) -> tuple:
    """The tokenizer, the ids of remembered words and word bodies, and which
    ids end a word: one per worker."""
    def load() -> tuple:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        closing = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            closing[i] = token.endswith(WORD_END)
        return tokenizer, {}, {}, closing

    return common.worker_cache(f"packing {path}", load)


def _normal(text: str) -> str:
    """As the tokenizer reads a word: NFC, which splits some letters into letter
    and mark, then lower case."""
    return unicodedata.normalize("NFC", text).lower()


def _encode(parts: list[bytes], tokenizer, closing: np.ndarray, known: dict[bytes, bytes]) -> None:
    """Put the ids of words in ``known``. Words of letters only are one unit to
    the tokenizer, and its last id says that it ends: many are encoded in one
    string. Where the ends are not as many as the words, as where the tokenizer
    knows fewer letters, each word is encoded for itself."""
    plain, others = [], []
    for part in parts:
        if part.isalpha():  # ASCII letters
            plain.append(part)
        else:
            text = part.decode()
            (plain if text.isalpha() and _normal(text).isalpha() else others).append(part)
    for i in range(0, len(plain), 8192):
        lots = [plain[k:k + JOINED] for k in range(i, min(i + 8192, len(plain)), JOINED)]
        for lot, found in zip(lots, tokenizer.encode_batch_fast([b" ".join(x).decode() for x in lots],
                                                                add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = (4 * (np.flatnonzero(closing[ids]) + 1)).tolist()
            if len(ends) != len(lot):
                others += lot
                continue
            data = ids.tobytes()
            known.update(zip(lot, [data[a:b] for a, b in zip([0, *ends], ends)]))
    for i in range(0, len(others), 4096):
        some = others[i:i + 4096]
        for part, found in zip(some, tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)):
            known[part] = array("I", found.ids).tobytes()


def _body(word: bytes) -> tuple[bytes, bytes]:
    """A word's body and closing stops, where the tokenizer certainly cuts
    between them (after a letter or digit), the body in lower case if ASCII."""
    body = word
    if word[-1] in STOPS:
        body = word.rstrip(STOPS)
        if not body or not _normal(body.decode())[-1].isalnum():
            body = word
    return (body.lower() if body.isascii() and b"<|" not in body else body), word[len(body):]


@contextmanager
def _no_collector():
    """Without the cyclic garbage collector: nothing here makes cycles, and it
    would walk the remembered words again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


@_no_collector()
def token_ids(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space, never joins what it separates and lowers
    case, so the ids of a text are those of its words; each word body is
    encoded once and remembered, up to a bound. ``path`` must name a tokenizer
    of that kind, which marks the ends of words."""
    tokenizer, known, bodies, closing = _tokenizer(path)
    split = [t.split() for t in texts]
    words = set().union(*split)
    fresh = words.difference(known)
    if len(known) + len(fresh) > CACHED_WORDS:
        known.clear()
        fresh = words
    cut = {w: _body(w) for w in fresh}
    wanted = list({part for pair in cut.values() for part in pair if part}.difference(bodies))
    if len(bodies) + len(wanted) > CACHED_BODIES:
        bodies.clear()
        wanted = list({part for pair in cut.values() for part in pair if part})
    _encode(wanted, tokenizer, closing, bodies)
    for word, (body, stops) in cut.items():
        known[word] = bodies[body] + bodies[stops] if stops else bodies[body]
    ids = [b"".join(map(known.__getitem__, words)) for words in split]
    for word in [w for w in fresh if len(w) > CACHED_BYTES]:
        del known[word]
        bodies.pop(cut[word][0], None)
    return ids


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY,
           tokenizer_path: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's ids and the end
    id, cut only where they are longer than ``capacity``."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), common.whole_text(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        else:
            path = tokenizer_path
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                at, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(token_ids(part.column(1).to_pylist(), path)):
                    ids += end
                    for n, a in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[a:a + 4 * capacity]
                        at.append(k)
                        piece.append(n)
                        start.append(a // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, first sequence, pieces per sequence, first
    offset), by length and first rank: rank r of them goes to sequence
    ``first sequence + (r - first rank) // pieces per sequence``."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> intervals (first sequence, count)
    steps, opened = [], 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank, gap = counts[length], 0, length
        while left:
            while gap < capacity and not gaps[gap]:
                gap += 1
            if gap >= capacity:
                gap, first = capacity, opened
                each = capacity // length
                n = math.ceil(left / each)
                opened += n
            else:
                first, n = gaps[gap].pop()
                each = gap // length
                if (wanted := math.ceil(left / each)) < n:
                    gaps[gap].append((first + wanted, n - wanted))
                    n = wanted
            steps.append((length, rank, first, each, capacity - gap))
            full, rest = divmod(min(left, n * each), each)
            rank, left = rank + full * each + rest, left - full * each - rest
            if full:
                gaps[gap - each * length].append((first, full))
            if rest:
                gaps[gap - rest * length].append((first + full, 1))
            gap = max(length, min(gap, gap - each * length if full else gap))
    return sorted(steps)


def first_ranks(counts: DataFrame, block_buckets: int = BLOCK_BUCKETS) -> DataFrame:
    """``counts`` (length, bucket, count) -> (length, bucket, first): how many
    pieces of the length lie in buckets before. Summed within blocks of buckets,
    and over the blocks of a length, which are its rows / 1,000,000."""
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / block_buckets))
    before = lambda n, *by: F.sum(n).over(Window.partitionBy("length", *by[:-1]).orderBy(by[-1])) - F.col(n)
    totals = blocks.groupBy("length", "block").agg(F.sum("count").alias("total"))
    return blocks.withColumn("within", before("count", "block", "bucket")).join(
        totals.select("length", "block", before("total", "block").alias("passed")), ["length", "block"]).select(
        "length", "bucket", (F.col("passed") + F.col("within")).alias("first"))


def pack(cut: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``cut`` (as of ``pieces``) with sequence_id and offset."""
    spark = cut.sparkSession
    cut = common.materialise(cut, "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # at most ``capacity`` rows
    buckets = spark.createDataFrame([(n, math.ceil(c / bucket_rows)) for n, c in counts.items()],
                                    "length bigint, buckets bigint")
    dealt = cut.join(F.broadcast(buckets), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.col("buckets")))
    first = first_ranks(dealt.groupBy("length", "bucket").count())
    ranked = dealt.withColumn("nth", F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("id", "piece")) - 1).join(
        first, ["length", "bucket"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))
    table = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    sent = spark.sparkContext.broadcast(table)  # bounded by the capacity

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = sent.value
        begin = {int(n): (a, b) for n, a, b in zip(*_spans(steps[:, 0]))}
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            row = np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                mine = length == n
                a, b = begin[int(n)]
                row[mine] = a + np.searchsorted(steps[a:b, 1], rank[mine], side="right") - 1
            step = steps[row]
            past = rank - step[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(step[:, 2] + past // step[:, 3]),
                 pa.array(step[:, 4] + past % step[:, 3] * length)],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cut.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, begin, end) of each run of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    begin = np.r_[0, cuts][: len(values)].astype(np.int64)
    return values[begin], begin, np.r_[cuts, len(values)][: len(begin)].astype(np.int64)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer_path: str | None = None) -> DataFrame:
    return pack(pieces(docs, id_col, text_col, capacity, tokenizer_path), capacity).withColumnRenamed("id", id_col)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.table(spark, sf_dir, "documents"))
