import re
from collections import Counter

import pytest

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from wattlake.llm import quality_rules as qr


def by_hand(text):
    text = text or ""
    w = fixtures.split_words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(fixtures.WORD, x)]
    n, repeated = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated,
            n < 10 or 100 * repeated > 20 * n)


def digest(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_statistics(spark):
    found = {r.doc_id: digest(r) for r in qr.statistics(fixtures.documents(spark)).collect()}
    assert found == {i: by_hand(t) for i, t in fixtures.texts()}


def test_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = qr.op9_quality_rules(spark, SF_SMALL).collect()
    assert {r.doc_id: digest(r) for r in rows} == {i: by_hand(t) for i, t in docs.items()}
    assert not any(r.kept and r.base_failed for r in rows)


@pytest.fixture(scope="module")
def labelled(spark):
    """Poor: many symbols, or short words that are also long texts."""
    rows = []
    for i in range(900):
        poor = i % 4 == 0
        n = 50 + i % 37
        symbols = n if poor and i % 8 else i % 3
        chars = 2 * n if poor and not i % 8 else 6 * n
        rows.append((i, n, chars, symbols, 0, 0, 3, n - i % 5, 4, 0, False, poor))
    return spark.createDataFrame(rows, "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                 "n_repeat_words long, n_lines long, n_distinct_words long, n_upper long, n_calls long, "
                                 "base_failed boolean, poor boolean")


def test_learns_rules_that_separate(labelled):
    rules = qr.learn(labelled)
    assert 2 <= len(rules.rules) <= 4
    wrong = labelled.where(rules.rejects() != labelled["poor"]).count()
    assert wrong <= 20, str(rules)


def test_list_is_applied_in_order_by_hand(labelled):
    rules = qr.learn(labelled)
    names = {m: labelled.select(c.alias("v"), "id") for m, c in qr.measures().items()}
    values = {m: {r.id: r.v for r in f.collect()} for m, f in names.items()}
    got = {r.id: r.x for r in labelled.select("id", rules.rejects().alias("x")).collect()}
    for i, x in got.items():
        assert x == any(all((values[c.measure][i] >= c.threshold) == c.at_least for c in rule) for rule in rules.rules)


def test_held_out_documents(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0
    judged = qr.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels.where(~part))
    counts = {(r.quality, r.kept): r["count"] for r in judged.join(labels.where(part), "doc_id").where("n_words >= 10")
              .groupBy("quality", "kept").count().collect()}
    assert counts.get((1, True), 0) / (counts.get((1, True), 0) + counts.get((1, False), 0)) >= 0.95
    assert counts.get((0, False), 0) / (counts.get((0, True), 0) + counts.get((0, False), 0)) >= 0.85


def test_without_labels_only_the_base_rule(spark):
    docs = fixtures.documents(spark)
    none = spark.createDataFrame([(None, 0), (5, None)], "doc_id long, quality int")
    rows = qr.judge(docs, none).collect()
    assert len(rows) == docs.count() and all(r.kept != r.base_failed for r in rows)


def test_null_ids_repeated_rows_empty_table_and_plan(spark):
    labels = spark.createDataFrame([(3, 1), (3, 0)], "doc_id long, quality int")
    rows = [fixtures.row(None, None), fixtures.row(3, "b " * 12), fixtures.row(3, "b " * 12)]
    assert qr.judge(fixtures.documents(spark, rows), labels).count() == 3
    assert qr.judge(fixtures.documents(spark, []), labels).count() == 0
    plan = qr.statistics(fixtures.documents(spark))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
