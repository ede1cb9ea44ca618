import math
from collections import defaultdict

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import fixtures
from wattlake.llm import common


def test_stages_and_run(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    columns, counts, kept = docs.columns, [docs.count()], docs
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.materialise(stage(spark, kept, SF_SMALL), "test-stage")
        assert kept.columns == columns, name
        counts.append(kept.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] >= counts[3]
    assert kept.select("doc_id").distinct().count() == counts[3]  # mixing loses no document
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    pieces, at = defaultdict(int), defaultdict(list)
    for r in rows:
        pieces[r.doc_id] += r.piece == 0
        at[r.sequence_id].append((r.offset, r.length))
    times = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert dict(pieces) == times
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(at) <= 1.02 * math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_awkward_rows_and_empty_table(spark):
    for docs in (fixtures.documents(spark), fixtures.documents(spark, [fixtures.row(None, None), fixtures.row(2, "a")]),
                 fixtures.documents(spark, [])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = common.materialise(stage(spark, docs, SF_SMALL), "test-stage")
            assert name == "best-fit packing" or docs.columns == columns
