import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from tests.oracle_check import compare
from wattlake.llm import exact_dedup


def expected(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    groups = defaultdict(list)
    for i, t in norm.items():
        groups[t].append(i)
    return {i: (min(groups[t]), len(groups[t]), min(groups[t]) == i, hashlib.sha256(t.encode()).hexdigest())
            for i, t in norm.items()}


@pytest.mark.parametrize("digest_all", [True, False])
def test_against_brute_force(spark, digest_all):
    found = exact_dedup.exact_dedup(fixtures.documents(spark), digest_all=digest_all).collect()
    want = expected(fixtures.texts())
    assert len(found) == len(want)
    for r in found:
        keep, size, kept, sha = want[r.doc_id]
        assert (r.keep_id, r.group_size, r.kept) == (keep, size, kept)
        assert r.text_sha256 == sha if digest_all or size > 1 else r.text_sha256 in (None, sha)


def test_same_length_and_prefix_but_other_text(spark):
    head = "h" * 200
    rows = [fixtures.row(1, head + "a"), fixtures.row(2, head + "b"), fixtures.row(3, head + "a")]
    found = {r.doc_id: r for r in exact_dedup.exact_dedup(fixtures.documents(spark, rows)).collect()}
    assert [found[i].keep_id for i in (1, 2, 3)] == [1, 2, 1]


def test_repeated_rows_and_null_ids(spark):
    rows = [fixtures.row(5, "t t"), fixtures.row(5, "t t"), fixtures.row(None, "t  t"), fixtures.row(None, "u"),
            fixtures.row(6, None), fixtures.row(7, "")]
    found = exact_dedup.exact_dedup(fixtures.documents(spark, rows)).collect()
    assert len(found) == 6
    assert sum(r.kept for r in found if r.keep_id == 5) == 1 and {r.group_size for r in found if r.keep_id == 5} == {3}
    kept = exact_dedup.drop_copies(fixtures.documents(spark, rows))
    assert kept.columns == fixtures.documents(spark, rows).columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "t  t"), (-1, "u"), (5, "t t"), (6, None)]


def test_drop_copies_keeps_one_of_each(spark):
    want = {i for i, (_, _, kept, _) in expected(fixtures.texts()).items() if kept}
    assert {r.doc_id for r in exact_dedup.drop_copies(fixtures.documents(spark)).collect()} == want


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(fixtures.documents(spark, [])).count() == 0
    assert exact_dedup.drop_copies(fixtures.documents(spark, [])).count() == 0


def test_one_group_holds_most_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "copy").otherwise(
        F.concat(F.lit("own "), F.col("id"))).alias("text"))
    found = exact_dedup.exact_dedup(docs)
    assert found.where("group_size = 2000 and keep_id = 1").count() == 2000 and found.where("kept").count() == 1001


def test_oracle(spark):
    assert compare(spark, SF_SMALL, ["op1_exact_dedup"], verbose=False)["op1_exact_dedup"][0] == "ok"
