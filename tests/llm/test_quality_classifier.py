import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import fixtures
from wattlake.llm import quality_classifier as qc

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def halves(spark):
    """Labelled documents of the larger test table, dealt by a hash of the id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    graded = spark.read.parquet(f"{SF}/labels.parquet").select(F.col("doc_id").alias("id"), qc.rating().alias("grade"))
    part = F.pmod(F.xxhash64("id", F.lit(99)), F.lit(4))
    return docs, graded.where(part > 0), graded.where(part == 0)


def test_held_out_accuracy(spark, halves):
    docs, train, test = halves
    model = qc.train(docs, train)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    held = qc.classify(docs, model).join(test, F.col("doc_id") == F.col("id")).select("grade", "expected_grade", "kept").collect()
    good = [r for r in held if r.grade == 2]
    bad = [r for r in held if r.grade < 2]
    assert len(good) > 300 and len(bad) > 80
    assert sum(r.kept for r in good) / len(good) >= 0.98
    assert sum(not r.kept for r in bad) / len(bad) >= 0.85
    mean = lambda grade: np.mean([r.expected_grade for r in held if r.grade == grade])
    assert mean(0) < mean(1) < mean(2)


def test_slopes_are_those_of_the_likelihood():
    """The gradient by the score, against a difference quotient."""
    cuts, y, s, e = np.array([-1.0, 0.5]), 1, 0.3, 1e-6
    edges = np.r_[-np.inf, cuts, np.inf]
    p = lambda x: 1 / (1 + np.exp(-(x - edges[y]))) - 1 / (1 + np.exp(-(x - edges[y + 1])))
    above, beyond = (1 / (1 + np.exp(-(s - edges[k]))) for k in (y, y + 1))
    assert abs((-np.log(p(s + e)) + np.log(p(s - e))) / (2 * e) - (above + beyond - 1)) < 1e-6


def plain_fit(rows, grades, bits, passes, seed=7):
    """The same training with loops over rows and features."""
    top = max(grades)
    size = 1 << bits
    w, w_square = [0.0] * size, [1e-8] * size
    cuts, cut_square = [-2 + 2 * k / max(1, top - 1) for k in range(top)], [1e-8] * top
    mean, mean_cuts, later = [0.0] * size, [0.0] * top, passes - passes // 2
    rng = np.random.default_rng(seed)
    tail = lambda x: 1 / (1 + math.exp(-min(40.0, max(-40.0, x))))
    for done in range(passes):
        order = rng.permutation(len(rows)).tolist()
        for at in range(0, len(order), qc.BATCH):
            part = order[at:at + qc.BATCH]
            gradient, pull = {}, [0.0] * top
            for k in part:
                score, y = sum(w[i] for i in rows[k]), grades[k]
                p, q = (tail(score - cuts[y - 1]) if y else 1.0), (tail(score - cuts[y]) if y < top else 0.0)
                chance = max(p - q, 1e-9)
                slope = p + q - 1  # see the test above; the quotient fails where both tails are 1
                for i in rows[k]:
                    gradient[i] = gradient.get(i, 0.0) + slope / len(part)
                if y:
                    pull[y - 1] += p * (1 - p) / chance / len(part)
                if y < top:
                    pull[y] -= q * (1 - q) / chance / len(part)
            for i, g in gradient.items():
                w_square[i] += g * g
                step = qc.STEP / math.sqrt(w_square[i])
                moved = w[i] - step * g
                w[i] = math.copysign(max(abs(moved) - step * qc.L1, 0.0), moved)
            for j in range(top):
                cut_square[j] += pull[j] ** 2
                cuts[j] -= qc.STEP * pull[j] / math.sqrt(cut_square[j])
            for j in range(1, top):
                cuts[j] = max(cuts[j], cuts[j - 1] + qc.LEAST_GAP)
        if done >= passes // 2:
            mean, mean_cuts = [a + b for a, b in zip(mean, w)], [a + b for a, b in zip(mean_cuts, cuts)]
    return [a / later for a in mean], [a / later for a in mean_cuts]


def test_fit_equals_a_plain_one(spark, monkeypatch):
    """Weights, thresholds and what follows for every text, from the Spark training
    and from loops over the same rated documents."""
    monkeypatch.setattr(qc, "SEEN_ROWS", 1500)
    docs = fixtures.documents(spark)
    rated = [(i, k % 3) for k, (i, text) in enumerate(fixtures.texts()) if i not in (7, 9)]
    model = qc.train(docs, spark.createDataFrame(rated, "id long, grade int"))
    texts = {i: (t or "").encode() for i, t in fixtures.texts()}
    stored = sorted((i, np.array(qc.features(texts[i]), np.int32).tobytes(), g) for i, g in rated)
    rows, grades = [np.frombuffer(f, np.int32).tolist() for _, f, _ in stored], [g for *_, g in stored]
    weights, cuts = plain_fit(rows, grades, qc.HASH_BITS, math.ceil(1500 / len(rows)))
    assert np.allclose(model.weights, weights, atol=1e-4) and np.allclose(model.thresholds, cuts, atol=1e-6)
    want = {i: sum(1 / (1 + math.exp(-(sum(weights[k] for k in qc.features(t)) - c))) for c in cuts)
            for i, t in texts.items()}
    for r in qc.classify(docs, model).collect():
        assert abs(r.expected_grade - want[r.doc_id]) < 1e-2


def test_tails_are_ordered_and_score_matches_features(spark):
    model = qc.OrdinalModel(np.random.default_rng(1).normal(size=1 << 10).astype(np.float32), np.array([-1.0, 2.0]), 10)
    for _, text in fixtures.texts():
        text = (text or "").encode()
        want = float(model.weights[qc.features(text, 10)].sum())
        assert abs(qc.score_text(text, model.weights, 10, {}) - want) < 1e-3 * (1 + abs(want))
    rows = {r.doc_id: r for r in qc.classify(fixtures.documents(spark), model, grade=1).collect()}
    assert len(rows) == len(fixtures.texts())
    assert all(0 <= r.expected_grade <= 2 and r.kept == (r.tail_probability >= 0.5) for r in rows.values())
    kept = qc.keep_good(fixtures.documents(spark), model, grade=1)
    assert kept.columns == fixtures.documents(spark).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_bounded_sample_of_distinct_documents(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    ratings = spark.range(500).selectExpr("id", "cast(id % 3 as int) grade")
    ratings = ratings.unionByName(ratings).unionByName(spark.sql("select cast(null as long) id, 1 grade"))
    found = qc.labelled_sample(docs, ratings, "doc_id", "text", max_rows=100).collect()
    assert len(found) == len({r.id for r in found}) == 100


def test_without_labels_everything_stays(spark):
    docs = fixtures.documents(spark)
    none = spark.createDataFrame([], "id long, grade int")
    one = spark.createDataFrame([(0, 2), (1, 2), (None, 0), (2, None)], "id long, grade int")
    for ratings in (none, one):
        model = qc.train(docs, ratings)
        assert model is None
        rows = qc.classify(docs, model).collect()
        assert len(rows) == docs.count() and all(r.kept and r.tail_probability is None for r in rows)
        assert qc.keep_good(docs, model).count() == docs.count()


def test_null_ids_repeated_rows_and_empty_table(spark):
    model = qc.OrdinalModel(np.zeros(1 << 10, np.float32), np.array([-1.0, 1.0]), 10)
    rows = [fixtures.row(None, None), fixtures.row(None, "a"), fixtures.row(3, "b"), fixtures.row(3, "b")]
    assert qc.classify(fixtures.documents(spark, rows), model).count() == 4
    assert qc.classify(fixtures.documents(spark, []), model).count() == 0
