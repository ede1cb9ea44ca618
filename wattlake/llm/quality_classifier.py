"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade >= j) = sigmoid(score - threshold_j): one weight vector over hashed
text features, shared by all grades, and ordered thresholds.  The score gives
the expected grade and, for selection, the tail probability of a grade.

The model is fitted on a bounded sample of the labelled rows (``max_fit_rows``,
by a hash of the id) whose hashed features are computed by Spark; weights
(2**hash_bits numbers) go to the executors, which score every whole text where
it is read, so no text is moved.

Defined results: null text is empty; labels with a null id or rating are
ignored, of several labels of one document the lowest grade counts; with fewer
than two different grades there is no model: grade and probability are null and
every document is kept; ids may be null or repeat, each row is scored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common

HASH_BITS = 18
MAX_FIT_ROWS = 12_000
#: Passes go on until this many rows have been seen.
SEEN_ROWS = 200_000
BATCH, STEP, L1, LEAST_GAP = 64, 0.2, 1e-3, 0.1
KEEP_GRADE, KEEP_PROBABILITY = 2, 0.5
CACHED_WORDS = 400_000
MARKS = b"#*$%&|<>!?.,;:"


def rating(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grade of a labelled document: 0 toxic, 1 poor, 2 good."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)


def _hash(kind: bytes, value: bytes, bits: int) -> int:
    return zlib.crc32(kind + value) & ((1 << bits) - 1)


def word_features(word: bytes, bits: int) -> tuple[int, ...]:
    """A lower-cased word, its first four and five characters, and the marks
    at its end."""
    text = word.decode("utf-8", "replace")
    marks = word[len(word.rstrip(MARKS)):]
    return (_hash(b"w", word, bits), _hash(b"4", text[:4].encode(), bits), _hash(b"5", text[:5].encode(), bits),
            _hash(b"m", marks, bits))


def shape_features(text: bytes, words: list[bytes], bits: int) -> list[int]:
    """Tenths of what the text repeats, shouts or marks, as hashed tokens."""
    n = len(words)
    if not n:
        return [_hash(b"s", b"empty", bits)]
    lines = [line for line in text.split(b"\n") if line.strip()]
    shares = {
        b"distinct": len(set(words)) / n,
        b"again": 2 * sum(a == b for a, b in zip(words, words[1:])) / n,
        b"symbols": sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) / n / 2,
        b"calls": text.count(b"!") / n / 2,
        b"upper": sum(map(bytes.isupper, words)) / n,
        b"lines": 1 - len(set(lines)) / len(lines),
        b"triples": 1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
    }
    found = [_hash(b"s", b"%s:%d" % (k, min(10, math.ceil(10 * v))), bits) for k, v in shares.items()]
    # each counts as much as the words of a long text can add up to
    return found * max(1, math.isqrt(n) // 10)


def features(text: bytes, bits: int = HASH_BITS) -> list[int]:
    words = text.split()
    found = [i for w in set(text.lower().split()) for i in word_features(w, bits)]
    return found + shape_features(text, words, bits)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = HASH_BITS

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... by row."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, bits: int = HASH_BITS, seed: int = 7) -> OrdinalModel:
    """Maximum likelihood by mini-batches with per-weight step sizes and an L1
    shrinkage; thresholds are kept in order. The model is the mean over the later
    half of the passes."""
    top = int(grades.max())
    weights, square = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    cuts, cut_square = np.linspace(-2, 0, top), np.full(top, 1e-8)
    mean, mean_cuts, passes = np.zeros(1 << bits), np.zeros(top), math.ceil(SEEN_ROWS / len(rows))
    rng = np.random.default_rng(seed)
    for done in range(passes):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            y = grades[part]
            index = np.concatenate([rows[k] for k in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[k]) for k in part])
            score = np.bincount(owner, weights[index], len(part))
            edges = np.r_[-np.inf, cuts, np.inf]
            with np.errstate(over="ignore"):
                above = 1 / (1 + np.exp(-np.clip(score - edges[y], -40, 40)))
                beyond = 1 / (1 + np.exp(-np.clip(score - edges[y + 1], -40, 40)))
            above[y == 0], beyond[y == top] = 1, 0
            chance = np.maximum(above - beyond, 1e-9)
            slope = above + beyond - 1  # of the loss, by the score
            touched, where = np.unique(index, return_inverse=True)
            gradient = np.bincount(where, slope[owner]) / len(part)
            square[touched] += gradient ** 2
            step = STEP / np.sqrt(square[touched])
            moved = weights[touched] - step * gradient
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
            pull = np.array([(above * (1 - above) / chance)[y == j + 1].sum()
                             - (beyond * (1 - beyond) / chance)[y == j].sum() for j in range(top)]) / len(part)
            cut_square += pull ** 2
            cuts -= STEP * pull / np.sqrt(cut_square)
            for j in range(1, top):
                cuts[j] = max(cuts[j], cuts[j - 1] + LEAST_GAP)
        if done >= passes // 2:
            mean, mean_cuts = mean + weights, mean_cuts + cuts
    later = passes - passes // 2
    return OrdinalModel((mean / later).astype(np.float32), mean_cuts / later, bits)


def labelled_sample(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str,
                    max_rows: int = MAX_FIT_ROWS, bits: int = HASH_BITS) -> DataFrame:
    """(id, grade, features) of at most ``max_rows`` rated documents, those
    with the smallest hashes of their ids."""
    common.ship(docs.sparkSession)
    rated = ratings.where("grade is not null and id is not null").groupBy("id").agg(F.min("grade").alias("grade"))
    spread = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 40))
    share = min(1.0, 1.2 * max_rows / max(1, rated.count()))
    chosen = rated.where(spread <= int(share * (1 << 40))).orderBy(spread, "id").limit(max_rows)
    # at most max_rows rows of two numbers: small enough to send to every text
    texts = docs.select(F.col(id_col).alias("id"), common.whole_text(text_col).cast("binary").alias("text")).join(
        F.broadcast(chosen), "id").select("id", "grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(features(t.as_py(), bits), np.int32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f.tobytes() for f in found], pa.binary())],
                ["id", "grade", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, grade int, features binary")


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = MAX_FIT_ROWS) -> OrdinalModel | None:
    """``ratings``: id, grade (0, 1, ...). None without two different grades."""
    rows = labelled_sample(docs, ratings, id_col, text_col, max_rows).toArrow().sort_by(
        [("id", "ascending"), ("features", "ascending")])
    grades = rows.column("grade").to_numpy().astype(np.int64)
    if len(np.unique(grades)) < 2:
        return None
    return fit([np.frombuffer(f.as_buffer(), np.int32) for f in rows.column("features")], grades)


def score_text(text: bytes, weights: np.ndarray, bits: int, known: dict[bytes, float]) -> float:
    words, low = text.split(), set(text.lower().split())
    total = float(weights[shape_features(text, words, bits)].sum())
    for w in low:
        v = known.get(w)
        if v is None:
            v = float(weights[list(word_features(w, bits))].sum())
            if len(known) >= CACHED_WORDS:
                known.clear()
            known[w] = v
        total += v
    return total


def _scorer(spark: SparkSession, model: OrdinalModel):
    sent = spark.sparkContext.broadcast((model.weights, model.thresholds, model.bits))
    key = id(sent) ^ zlib.crc32(model.weights.tobytes())

    def tails(texts: pa.Array) -> np.ndarray:
        weights, thresholds, bits = sent.value
        known = common.worker_cache(f"classifier {key}", dict)
        scores = np.array([score_text(t.as_py(), weights, bits, known) for t in texts], float).reshape(-1)
        return OrdinalModel(weights, thresholds, bits).tails(scores)

    return tails


def classify(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text",
             grade: int = KEEP_GRADE, probability: float = KEEP_PROBABILITY) -> DataFrame:
    """One row per row: id, expected_grade, tail_probability (of ``grade`` or
    better), kept (that it is at least ``probability``)."""
    rows = docs.select(F.col(id_col), common.whole_text(text_col).cast("binary").alias("_text"))
    kind = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}"
    schema = f"{kind}, expected_grade double, tail_probability double, kept boolean"
    if model is None:
        nothing = F.lit(None).cast("double")
        return rows.select(id_col, nothing.alias("expected_grade"), nothing.alias("tail_probability"),
                           F.lit(True).alias("kept"))
    common.ship(docs.sparkSession)
    tails = _scorer(docs.sparkSession, model)
    j = min(grade, len(model.thresholds)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = tails(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, j]), pa.array(p[:, j] >= probability)],
                [id_col, "expected_grade", "tail_probability", "kept"])

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text",
              grade: int = KEEP_GRADE, probability: float = KEEP_PROBABILITY) -> DataFrame:
    """The rows whose text is probably of ``grade`` or better, all columns,
    filtered where they are read."""
    if model is None:
        return docs
    common.ship(docs.sparkSession)
    tails = _scorer(docs.sparkSession, model)
    j = min(grade, len(model.thresholds)) - 1
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).fill_null("").cast(pa.binary())
            yield batch.filter(pa.array(tails(texts)[:, j] >= probability))

    return docs.mapInArrow(run, docs.schema)


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> OrdinalModel | None:
    labels = common.table(spark, sf_dir, "labels")
    return train(docs, labels.select(F.col("doc_id").alias("id"), rating().alias("grade")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return classify(docs, trained(spark, docs, sf_dir))
