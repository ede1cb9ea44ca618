import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from wattlake.llm import simhash
from wattlake.llm.components import connected_components


def brute_components(fps, bits):
    ids = sorted(fps)
    values = np.array([fps[i] for i in ids], np.uint64)
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return {ids[i]: ids[root(i)] for i in range(len(ids))}


def test_fingerprint_by_definition(spark):
    for text in ["", "one", "Two words", "three word text", " ".join(fixtures.words(1, 500)), "É é Ä " * 9]:
        w = text.encode().lower().split()
        shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        if shingles:
            h = [r[0] & (2 ** 64 - 1) for r in spark.createDataFrame([(s.decode(),) for s in shingles], "s string").select(
                F.xxhash64("s")).collect()]
            want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        else:
            want = 0
        assert simhash.fingerprint(text.encode()) == want


@pytest.mark.parametrize("n", [10, 1000, 10 ** 6, 10 ** 9])
def test_every_linked_pair_meets_at_an_anchor(n):
    rng = np.random.default_rng(n)
    lengths = simhash.covering_code(n)
    assert sum(lengths) == 64 and all(k % 2 for k in lengths)
    for _ in range(40):
        x = rng.integers(0, 2 ** 63, dtype=np.uint64)
        y = x
        for b in rng.integers(0, 64, 2):
            y ^= np.uint64(1 << int(b))
        index, anchor, home = simhash.replicas(np.array([x, y], np.uint64), lengths, 2)
        for me, other in ((0, 1), (1, 0)):
            stored = anchor[(index == other) & home]
            assert len(stored) == 1 and stored[0] in anchor[(index == me) & ~home]


def test_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "STORED_PER_PART", 16)  # crowded anchors are split
    rng = np.random.default_rng(3)
    values = {int(rng.integers(0, 2 ** 63)) for _ in range(150)}
    centre = int(rng.integers(0, 2 ** 63))
    for _ in range(250):  # a crowd around one point
        x = centre
        for b in rng.integers(0, 63, rng.integers(0, 4)):
            x ^= 1 << int(b)
        values.add(x)
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {(min(r), max(r)) for r in simhash.links(frame).collect()}
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 2}
    assert found == want and len(want) > 100


def test_components_of_a_path_a_star_and_a_cycle(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(100, 200)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    found = {r.u: r.v for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {k: 100 for k in range(101, 201)} | {301: 300, 302: 300}
    assert found == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents_against_brute_force(spark):
    rows = fixtures.texts()
    fps = {i: simhash.fingerprint((t or "").encode()) for i, t in rows}
    want = brute_components(fps, 2)
    found = simhash.near_duplicates(fixtures.documents(spark)).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {i: (fps[i], want[i]) for i in fps}
    assert {want[i] for i in (0, 1, 2)} == {0} and all(len(r.fingerprint) == 16 for r in found)
    kept = simhash.keep_representatives(fixtures.documents(spark))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == fixtures.documents(spark).columns


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    fps = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in docs.collect()}
    found = {r.doc_id: r.component_id for r in simhash.op6_simhash(spark, SF_SMALL).collect()}
    assert found == brute_components(fps, 2)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [fixtures.row(None, "q r s t"), fixtures.row(4, "q r s t"), fixtures.row(4, "q r s t"), fixtures.row(None, "alone here now ok")]
    found = simhash.near_duplicates(fixtures.documents(spark, rows)).collect()
    assert len(found) == 4 and sorted(r.component_id or -1 for r in found) == [-1, 4, 4, 4]
    assert simhash.keep_representatives(fixtures.documents(spark, rows)).count() == 4
    assert simhash.near_duplicates(fixtures.documents(spark, [])).count() == 0
