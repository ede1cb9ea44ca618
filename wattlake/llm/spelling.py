"""Spelling variant grouping by Bloom-guided neighbourhoods.

Vocabulary words are near when they differ by one inserted, deleted or replaced
letter. Every deletion of a word and every replacement of one of its letters by
a later letter of the alphabet is generated (so each near pair comes up once)
and probed against blocked Bloom filters of the vocabulary, sharded by word
length. Only edits that a filter does not rule out are written as strings and
shuffled to an exact join with the vocabulary, which removes false positives.

Edits are probed by number, not by string: a word's hash is a sum over its
letters, so that of an edit follows from it in one step. The filters are sent in
rounds of at most ``ROUND_BYTES``, whatever the vocabulary; a round only probes
words whose edits have one of its lengths. Each word has at most some 180 near
words per letter, so no key of the join is hot; what a word gathers is counted
and reduced before the shuffle.

Defined results: null text has no words; a null id counts as empty text where
words are altered by id; equal rows count each; an empty table gives an empty
result; columns other than id and text are never looked at. A text or word of
any length is handled whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
#: One in so many (document, run) pairs loses a letter: misspellings to find.
ALTERED = 97
#: Words and letters that a task counts before it passes them on.
HELD_WORDS, HELD_LETTERS = 300_000, 16_000_000

WORDS_PER_BLOCK, BLOCK_WORDS, BITS = 32, 8, 7     # blocks of 512 bits, 16 a word
PART_BLOCKS = 256
ROUND_BYTES = 32 << 20
CELLS = 1 << 20
PROBES_PER_TASK = 10_000_000
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)


# ---- vocabulary -------------------------------------------------------------
def altered(doc_id: str, counts: dict[str, int], one_in: int) -> Iterator[tuple[str, int]]:
    """(word, count) of a document's runs; some lose a letter."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in counts.items():
        h = zlib.crc32(run.encode(), start)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                one_in: int = ALTERED) -> DataFrame:
    """(word, n) of all words with at least ``min_letters`` letters."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       common.whole_text(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.worker_cache("spelling", dict)  # nothing, and nothing of other operators
        runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_letters).findall
        held: Counter[str] = Counter()
        letters = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                               ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # of bytes, lower() changes A-Z only
                found = Counter(runs(text.as_py().lower().decode("utf-8", "replace")))
                for word, n in altered(doc_id, found, one_in):
                    if len(word) >= min_letters:
                        held[word] += n
                        letters += len(word)
                if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                    yield out()
                    letters = 0
        if held:
            yield out()

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# ---- filters ----------------------------------------------------------------
def mix(h: np.ndarray) -> np.ndarray:
    """All bits of a number spread over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: A number for each letter.
LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def weights(n: int) -> np.ndarray:
    """The weight of each position."""
    w = np.full(n, _ODD, np.uint64)
    w[:1] = 1
    return np.multiply.accumulate(w)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, letters) of the words of each length: one row of letters a word."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes):
        which = np.flatnonzero(sizes == size)
        for k in range(0, len(which), step := max(1, int(CELLS // size))):
            part = which[k:k + step]
            joined = "".join([words[i] for i in part]).encode("latin-1")
            yield part, np.frombuffer(joined, np.uint8).reshape(len(part), size)


def place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a hash, and the number that its bits are taken from."""
    h = mix(h)
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), mix(h ^ np.uint64(_ODD))


def blocks_for(words: int) -> int:
    return -(-words // WORDS_PER_BLOCK)


def filter_parts(vocabulary: DataFrame, lengths: dict[int, int]) -> DataFrame:
    """(len, part, bits): the filter of each word length in parts of at most
    PART_BLOCKS blocks. ``lengths``: number of words of each length."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in by_length(batch.column(0).to_pylist()):
                size = letters.shape[1]
                h = (LETTER[letters] * weights(size)).sum(axis=1, dtype=np.uint64)
                block, bits = place(h, blocks_for(lengths[size]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(h), size, np.int64)), pa.array((block // PART_BLOCKS).astype(np.int64)),
                    pa.array((block % PART_BLOCKS).astype(np.int64)), pa.array(bits.view(np.int64))],
                    ["len", "part", "block", "bits"])

    def build(group: pa.Table) -> pa.Table:
        filled = np.zeros(PART_BLOCKS * BLOCK_WORDS, np.uint64)
        block = group.column("block").to_numpy()
        bits = group.column("bits").to_numpy().view(np.uint64)
        for k in range(BITS):
            at = (bits >> np.uint64(9 * k)) & np.uint64(511)
            np.bitwise_or.at(filled, block * BLOCK_WORDS + (at >> np.uint64(6)).astype(np.int64),
                             np.uint64(1) << (at & np.uint64(63)))
        return pa.table({"len": group.column("len")[:1], "part": group.column("part")[:1],
                         "bits": pa.array([filled.tobytes()], pa.binary())})

    rows = vocabulary.select("word").mapInArrow(hashed, "len bigint, part bigint, block bigint, bits bigint")
    return rows.groupBy("len", "part").applyInArrow(build, "len bigint, part bigint, bits binary")


def rounds(lengths: dict[int, int], round_bytes: int = ROUND_BYTES) -> list[list[tuple[int, int, int]]]:
    """Parts (len, first, end) of each round; none is over ``round_bytes``."""
    room = max(1, round_bytes // (PART_BLOCKS * BLOCK_WORDS * 8))
    done: list[list[tuple[int, int, int]]] = [[]]
    left = room
    for size in sorted(lengths):
        at, parts = 0, -(-blocks_for(lengths[size]) // PART_BLOCKS)
        while at < parts:
            if not left:
                done.append([])
                left = room
            end = min(parts, at + left)
            done[-1].append((size, at, end))
            left -= end - at
            at = end
    return [r for r in done if r]


class Filters:
    """The filters of one round."""

    def __init__(self, lengths: dict[int, int], parts: list[tuple[int, int, int]], bits: dict[tuple[int, int], bytes]):
        self.of = {}
        empty = bytes(PART_BLOCKS * BLOCK_WORDS * 8)
        for size, first, end in parts:
            filled = np.frombuffer(b"".join(bits.get((size, p), empty) for p in range(first, end)), np.uint64)
            self.of[size] = (blocks_for(lengths[size]), first * PART_BLOCKS, filled)

    def may_hold(self, h: np.ndarray, size: int) -> np.ndarray:
        """Indices of the hashes of strings of this length that may be words."""
        blocks, first, filled = self.of[size]
        block, bits = place(h, blocks)
        block = block.astype(np.int64) - first
        live = np.flatnonzero((block >= 0) & (block * BLOCK_WORDS < len(filled)))
        block, bits = block[live], bits[live]
        for k in range(BITS):
            at = (bits >> np.uint64(9 * k)) & np.uint64(511)
            hit = (filled[block * BLOCK_WORDS + (at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
            hit = np.flatnonzero(hit)
            live, block, bits = live[hit], block[hit], bits[hit]
        return live


def probe(letters: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, edit): edits that may be words, as rows of letters."""
    size = letters.shape[1]
    w = weights(size)
    terms = LETTER[letters] * w
    whole = terms.sum(axis=1, dtype=np.uint64)
    if size in filters.of:
        for letter in alphabet:
            row, at = np.nonzero(letters < letter)
            h = whole[row] - terms[row, at] + LETTER[letter] * w[at]
            live = filters.may_hold(h, size)
            if len(live):
                edit = letters[row[live]]
                edit[np.arange(len(live)), at[live]] = letter
                yield row[live], edit
    if size - 1 in filters.of:
        # of equal letters in a row, only the last is taken out
        row, at = np.nonzero(np.c_[letters[:, 1:] != letters[:, :-1], np.ones(len(letters), bool)])
        before = np.add.accumulate(terms, axis=1, dtype=np.uint64)
        after = whole[row] - before[row, at]
        h = before[row, at] - terms[row, at] + after * np.uint64(_BACK)
        live = filters.may_hold(h, size - 1)
        for k in range(0, len(live), step := max(1, CELLS // size)):
            r, a = row[live[k:k + step]], at[live[k:k + step]]
            keep = np.arange(size)[None, :] != a[:, None]
            yield r, letters[r][keep].reshape(len(r), size - 1)


# ---- near words -------------------------------------------------------------
def near_candidates(vocabulary: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame | None:
    """(word, n, other): edits of vocabulary words that may be words too.
    ``vocabulary``: (word, n), words of letters up to U+00FF."""
    spark = vocabulary.sparkSession
    common.ship(spark)
    sizes = vocabulary.groupBy(F.length("word").alias("len")).agg(F.count("*").alias("words")).collect()
    lengths = {r["len"]: r["words"] for r in sizes}          # one row a word length
    if not lengths:
        return None
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), np.uint8)   # 90 at most
    probes = sum(size * n for size, n in lengths.items()) * (len(alphabet) + 1)
    tasks = max(2 * spark.sparkContext.defaultParallelism, probes // PROBES_PER_TASK)
    parts = common.materialise(filter_parts(vocabulary, lengths), "spelling-filters")
    found = []
    for shards in rounds(lengths, round_bytes):
        wanted = F.lit(False)
        for size, first, end in shards:
            wanted = wanted | ((F.col("len") == size) & (F.col("part") >= first) & (F.col("part") < end))
        # at most round_bytes of filters
        bits = {(r["len"], r["part"]): bytes(r["bits"]) for r in parts.where(wanted).collect()}
        sent = spark.sparkContext.broadcast(Filters(lengths, shards, bits))
        reach = sorted({s for size, _, _ in shards for s in (size, size + 1)} & set(lengths))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.worker_cache("spelling", dict)
            for batch in batches:
                words, ns = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for which, rows in by_length(words):
                    for row, edit in probe(rows, alphabet, sent.value):
                        size = edit.shape[1]
                        joined = edit.tobytes().decode("latin-1")
                        yield pa.RecordBatch.from_arrays([
                            pa.array([words[i] for i in which[row]], pa.string()), pa.array(ns[which[row]]),
                            pa.array([joined[k:k + size] for k in range(0, len(joined), size)], pa.string())],
                            ["word", "n", "other"])

        # dealt out by work, not by bytes: short rows, many probes each
        probed = vocabulary.where(F.length("word").isin(reach)).select("word", "n").repartition(tasks, "word").mapInArrow(
            run, "word string, n bigint, other string")
        found.append(common.materialise(probed, "spelling-candidates"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_words(vocabulary: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame | None:
    """(word, n_near, best, best_n): number of near words of each word that has
    any, and the one with the largest n (ties: the first in code-point order)."""
    candidates = near_candidates(vocabulary, round_bytes)
    if candidates is None:
        return None
    known = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # the exact join; each pair came up once and counts for both of its words
    pair = F.explode(F.array(F.struct(F.col("word"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
                             F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    pairs = candidates.join(known, "other").select(pair.alias("p")).select("p.*")
    return pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("first")).select(
        "word", "n_near", F.col("first.near").alias("best"), (-F.col("first.order")).alias("best_n"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, form) of words that have a form -> (word, root): the last word
    that following forms leads to. Pointers double, so that a chain of n forms
    takes about log2(n) rounds; each round is written."""
    state = common.materialise(forms.select("word", F.col("form").alias("to"), F.lit(False).alias("done")), "spelling-roots")
    while state.where("not done").limit(1).count():
        at = state.select(F.col("word").alias("at"), F.col("to").alias("next"), F.col("done").alias("last"))
        moved = state.where("not done").join(at, F.col("to") == F.col("at"), "left").select(
            "word", F.coalesce("next", "to").alias("to"), F.coalesce("last", F.lit(True)).alias("done"))
        state = common.materialise(state.where("done").unionByName(moved), "spelling-roots")
    return state.select("word", F.col("to").alias("root"))


def variants(vocabulary: DataFrame, ratio: int = RATIO, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """One row per word of ``vocabulary`` (word, n): word, n, n_near, form,
    form_n, root."""
    near = near_words(vocabulary, round_bytes)
    if near is None:
        nothing = F.lit(None).cast("string")
        return vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), nothing.alias("form"),
                                 F.lit(None).cast("long").alias("form_n"), F.col("word").alias("root"))
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = common.materialise(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-near")
    roots = follow(found.where("form is not null"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    counts = word_counts(docs).where(F.col("n") >= MIN_COUNT)
    found = variants(common.materialise(counts, "spelling-vocabulary"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
