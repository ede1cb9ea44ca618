"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader and elastic-net
penalties, then calibrated by a temperature.

A text is lower-cased, each run of characters that are no letters becomes one
space, and its n-grams of one to ``MAX_GRAM`` characters are hashed. The weight
of an n-gram is its share of the text's n-grams times its inverse document
frequency, which is counted over all documents that may be learned from, whole
texts. Because weights are shares, a text's scores are a plain sum over its
n-grams: texts are scored where they are read, by table look-ups on arrays of
many texts at once, and none is moved.

The model is fitted on the driver, on a sample bounded in documents
(``max_fit_rows``, spread evenly over languages, those with the smallest hashes of
their ids and texts) and in features (``max_fit_features``); one document in
``HOLD`` of it sets the temperature. The penalties leave most weights at zero;
the table of the others (2**HASH_BITS rows, one column a language) is sent.

Defined results: a text that is null or has no letter is ``und`` with score 0,
also where nothing could be learned; with one language learned its score is 1;
a null id is not held out; equal rows count each; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import common

HASH_BITS, MAX_GRAM = 18, 3
SIZE = 1 << HASH_BITS
MAX_FIT_ROWS, MAX_FIT_FEATURES = 4_000, 12_000_000
#: Follow the regularised leader: step, smoothing, both penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.1, 1.0, 0.5, 0.5, 3
SCALE = 100.0
HOLD = 5
CHUNK = 1 << 19
UNKNOWN = "und"
#: One document in three is held out, that with this remainder.
FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str) -> Column:
    """Whether a document is kept for measuring; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


# ---- n-grams ----------------------------------------------------------------
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _spaced(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Each run of other characters as one zero, and one at either end."""
    kept = np.where(letters[codes], codes, 0).astype(np.uint32)
    kept = np.concatenate([[0], kept, [0]]).astype(np.uint32)
    return kept[np.r_[True, (kept[1:] != 0) | (kept[:-1] != 0)]]


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams of each length; those of one character leave out
    spaces."""
    c = codes.astype(np.uint32) * np.uint32(0x9E3779B1)
    h, out = np.zeros(len(c), np.uint32), []
    for n in range(1, MAX_GRAM + 1):
        if len(c) < n:
            break
        h = (h[:len(c) - n + 1] ^ c[n - 1:]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        kept = h[codes != 0] if n == 1 else h
        out.append(((kept + np.uint32(n)) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - HASH_BITS))
    return out


def chunks(text: str, letters: np.ndarray) -> Iterator[np.ndarray]:
    """The spaced characters of a text, in pieces that share MAX_GRAM - 1
    characters, so that each n-gram of the last length is in one piece."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    spaced = _spaced(codes, letters)
    if len(spaced) < 2:
        return
    for at in range(0, max(1, len(spaced) - MAX_GRAM + 1), CHUNK):
        yield spaced[at:at + CHUNK + MAX_GRAM - 1]


def text_grams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of the distinct n-grams of a text of any length."""
    counts = np.zeros(SIZE, np.int64)
    for piece in chunks(text, letters):
        for h in gram_hashes(piece):
            counts += np.bincount(h, minlength=SIZE)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found]


def _worker_letters() -> np.ndarray:
    return common.worker_cache("language letters", _letters)


# ---- statistics and sample ----------------------------------------------------
def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each n-gram hash) over whole texts. Tasks send
    what they counted; the SIZE sums come to the driver."""
    common.ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, df, rows = _worker_letters(), np.zeros(SIZE, np.int64), 0
        seen = np.zeros(SIZE, bool)
        for batch in batches:
            for t in batch.column(0):
                for piece in chunks(t.as_py(), letters):
                    for h in gram_hashes(piece):
                        seen[h] = True
                found = np.flatnonzero(seen)
                df[found] += 1
                seen[found] = False
                rows += 1
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[found, -1]), pa.array(np.r_[df[found], rows])], ["gram", "n"])

    counted = texts.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(SIZE, np.int64)
    gram, n = counted.column("gram").to_numpy(), counted.column("n").to_numpy()
    df[gram[gram >= 0]] = n[gram >= 0]
    return int(n[gram < 0].sum()), df


def sample(known: DataFrame, max_rows: int = MAX_FIT_ROWS, max_features: int = MAX_FIT_FEATURES) -> DataFrame:
    """(lang, order, grams, counts) of at most ``max_rows`` documents of
    ``known`` (lang, order, text), as many of each language where it has them, and
    of at most ``max_features`` distinct n-grams in all (one document at least).
    ``order``: the smallest are taken, a number from 0 to 2**40."""
    per_lang = common.materialise(known.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    langs, total = per_lang.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    quota = max(1, max_rows // max(1, langs))
    # about 1.2 times the quota of each language passes, so no window gathers more
    near = F.lit(1.2 * quota + 50) / F.col("n") * F.lit(float(1 << 40))
    chosen = common.join_groups(known, per_lang, ["lang"], "n", total).where(F.col("order") <= near)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _worker_letters()
        for batch in batches:
            found = [text_grams(t.as_py(), letters) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([g.tobytes() for g, _ in found], pa.binary()),
                pa.array([c.astype(np.float32).tobytes() for _, c in found], pa.binary())],
                ["lang", "order", "grams", "counts"])

    rows = chosen.select("lang", "order", "text", nth.alias("nth")).where(F.col("nth") <= quota)
    grams = common.materialise(rows.select("lang", "order", "text").mapInArrow(
        run, "lang string, order bigint, grams binary, counts binary"), "language-sample")
    so_far = F.sum(F.length("grams") / 4).over(Window.orderBy("order", "lang", "grams").rowsBetween(
        Window.unboundedPreceding, 0))
    # at most max_rows rows of two numbers are in this window
    lengths = grams.select("lang", "order", "grams").withColumn("total", so_far)
    return grams.join(lengths.where(F.col("total") <= max_features).select("lang", "order", "grams").distinct(),
                      ["lang", "order", "grams"]) if max_features else grams


# ---- model --------------------------------------------------------------------
@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    table: np.ndarray          # SIZE rows: weight times inverse document frequency
    bias: np.ndarray
    temperature: float

    def predict(self, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, probability) of the likeliest language of texts, by their
        summed table rows and numbers of n-grams."""
        z = (sums * (SCALE / np.maximum(counts, 1))[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, size: int = SIZE,
                      alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, epochs: int = EPOCHS,
                      seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of a multinomial logistic regression on sparse rows
    (index, value): each weight is the minimum of the linearised losses so far
    plus l1 and l2 penalties, with step sizes of its own."""
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def leader(index: np.ndarray) -> np.ndarray:
        zi = z[index]
        penalty = np.where(index == size, 0.0, l1)[:, None]
        w = -(zi - np.sign(zi) * penalty) / ((beta + np.sqrt(n[index])) / alpha + l2)
        return np.where(np.abs(zi) <= penalty, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, value = np.r_[rows[i][0], size], np.r_[rows[i][1], 1.0]
            w = leader(index)
            p = softmax(value @ w)
            p[y[i]] -= 1
            g = value[:, None] * p
            n_i = n[index]
            sigma = (np.sqrt(n_i + g * g) - np.sqrt(n_i)) / alpha
            z[index] += g - sigma * w
            n[index] = n_i + g * g
    w = leader(np.arange(size + 1))
    return w[:size], w[size]


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """What scores are divided by so that their probabilities are likeliest:
    the slope of the loss by 1 / temperature only rises, and is bisected."""
    if not len(y):
        return 1.0
    right = scores[np.arange(len(y)), y]

    def slope(b: float) -> float:
        return float(((softmax(scores * b) * scores).sum(axis=1) - right).mean())

    low, high = 0.05, 20.0
    for _ in range(60):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if slope(middle) < 0 else (low, middle)
    return 1 / (low * high) ** 0.5


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_rows: int = MAX_FIT_ROWS, max_features: int = MAX_FIT_FEATURES) -> LanguageModel | None:
    """Learns from text and language of the documents that are not held out;
    None if none of them has a language and a letter."""
    spark = docs.sparkSession
    common.ship(spark)
    spread = F.pmod(F.xxhash64(F.col(id_col), F.lit(23), F.xxhash64(text_col)), F.lit(1 << 40))
    known = docs.where(~held_out(id_col)).where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), spread.alias("order"), F.col(text_col).alias("text"))
    picked = sample(known, max_rows, max_features).toArrow().sort_by(
        [("order", "ascending"), ("lang", "ascending"), ("grams", "ascending")])
    if not picked.num_rows:
        return None
    total, df = document_frequencies(known)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    names = picked.column("lang").to_pylist()
    langs = sorted(set(names))
    y = np.array([langs.index(x) for x in names])
    if len(langs) == 1:
        return LanguageModel(langs, np.zeros((SIZE, 1), np.float32), np.zeros(1), 1.0)
    rows = []
    for g, c in zip(picked.column("grams"), picked.column("counts")):
        index = np.frombuffer(g.as_buffer(), np.int32)
        count = np.frombuffer(c.as_buffer(), np.float32)
        rows.append((index, SCALE * count / count.sum() * idf[index]))
    # those held back for the temperature, by their place in a hashed order
    back = np.arange(len(rows)) % HOLD == HOLD - 1
    weights, bias = follow_the_leader([r for r, b in zip(rows, back) if not b], y[~back], len(langs))
    scores = np.array([v @ weights[i] + bias for (i, v), b in zip(rows, back) if b]).reshape(-1, len(langs))
    return LanguageModel(langs, (weights * idf[:, None]).astype(np.float32), bias, temperature(scores, y[back]))


def score_texts(texts: list[str], table: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed table rows and numbers of n-grams of each text. Texts are joined up
    to CHUNK characters, so that arrays are long and bounded."""
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), np.int64)
    held, owners, size = [], [], 0

    def flush() -> None:
        if not held:
            return
        codes, owner = np.concatenate(held), np.repeat(owners, [len(h) for h in held])
        for n, h in enumerate(gram_hashes(codes), 1):
            # an n-gram belongs to the text that it starts and ends in
            start, end = (owner[codes != 0],) * 2 if n == 1 else (owner[:len(owner) - n + 1], owner[n - 1:])
            inside = start == end
            who, h = start[inside], h[inside]
            if len(who):
                cuts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                np.add.at(sums, who[cuts], np.add.reduceat(table[h], cuts, axis=0, dtype=np.float64))
                np.add.at(counts, who[cuts], np.diff(np.r_[cuts, len(who)]))
        held.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for piece in chunks(text, letters):
            if size + len(piece) > CHUNK and held:
                flush()
                size = 0
            if owners and owners[-1] == i:      # pieces of one text share characters
                flush()
                size = 0
            held.append(piece)
            owners.append(i)
            size += len(piece)
    flush()
    return sums, counts


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, held_out, lang_pred, score."""
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), common.whole_text(text_col).alias("_text"))
    if model is None:
        return rows.select(id_col, "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    spark = docs.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast((model.langs, model.table, model.bias, model.temperature))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, model = _worker_letters(), LanguageModel(*sent.value)
        for batch in batches:
            sums, counts = score_texts(batch.column(2).to_pylist(), model.table, letters)
            best, p = model.predict(sums, counts)
            names = [model.langs[k] if n else UNKNOWN for k, n in zip(best, counts)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.where(counts > 0, p, 0.0))],
                [id_col, "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
