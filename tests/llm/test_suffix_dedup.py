import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from wattlake.llm import suffix_dedup as sd


def by_hand(rows, length):
    count = Counter()
    data = {i: (t or "").encode() for i, t in rows}
    for t in data.values():
        count.update(t[s:s + length] for s in range(len(t) - length + 1))
    out = {}
    for i, t in data.items():
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(bool(g) and not b for g, b in zip(gone, [0, *gone]))
        out[i] = (len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone) if not g))
    return out


def run(docs, **options):
    rows = sd.remove_repeats(docs, with_text=True, **options).collect()
    assert all(r.kept_sha256 == hashlib.sha256(r.kept_bytes).hexdigest() for r in rows)
    return rows


def digest(rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in rows}


@pytest.mark.parametrize("length, options", [
    (100, {}), (50, {"gram": 16}), (60, {"gram": 8, "crowded_bytes": 300, "shard_bytes": 2000}),
    (60, {"gram": 8, "crowded_bytes": 300, "shard_bytes": 2000, "range_bytes": 500}),
    (400, {"crowded_bytes": 1000})])
def test_against_brute_force(spark, length, options):
    rows = run(fixtures.documents(spark), length=length, **options)
    assert digest(rows) == by_hand(fixtures.texts(), length) and len(rows) == len(fixtures.texts())


def test_common_passage_in_many_contexts(spark):
    """One anchor is split over several shards."""
    passage = " ".join(fixtures.words("p", 30))
    texts = [(i, " ".join(fixtures.words(i, 12)) + passage[i % 5:] + " ".join(fixtures.words(1000 + i, 12))) for i in range(60)]
    rows = run(fixtures.documents(spark, [fixtures.row(*t) for t in texts]), length=60, gram=8, crowded_bytes=1500)
    assert digest(rows) == by_hand(texts, 60)


def test_merge_ranges_follow_the_bytes():
    """However many windows one anchor has, a merging group gets its share; equal windows meet."""
    rng = np.random.default_rng(3)
    windows = rng.integers(-2 ** 63, 2 ** 63, 20_000)
    sent = {p: np.stack([windows[p::2] if p < 2 else windows[:500], np.arange(10_000 if p < 2 else 500)], 1) for p in range(3)}
    columns = {"anchor": [9] * 3, "part": [*sent], "sig": [*sent], "cuts": [64] * 3, "windows": [s.astype("<i8").tobytes() for s in sent.values()]}
    table = pa.concat_tables([pa.Table.from_batches([b]) for b in sd.deal_windows(iter(pa.table(columns).to_batches()))])
    sizes, hits = {}, 0
    for r in set(table.column("range").to_pylist()):
        group = table.filter(pc.equal(table.column("range"), r))
        sizes[r] = sum(map(len, group.column("windows").to_pylist())) // 16
        hits += sum(len(x) // 8 for x in sd.merge(group).column("ranges").to_pylist())
    assert set(sizes) == set(range(64)) and max(sizes.values()) < 2 * 20_500 / 64 and hits == 1000


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(1, 12))]
    strings += strings[:2] + [b"a" * 50, b"a" * 40]
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    text = np.zeros(ends[-1] + 1, np.uint16)
    for s, e in zip(strings, ends):
        text[e - len(s):e] = np.frombuffer(s, np.uint8).astype(np.uint16) + 1
    order, rank = sd.suffix_array(text, ends)
    owner = np.searchsorted(ends, np.arange(len(text)))
    suffix = {i: [*text[i:ends[owner[i]]].tolist()] for i in range(len(text))}
    assert sorted(order.tolist()) == list(range(len(text))) and rank[order].tolist() == list(range(len(text)))
    for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
        assert suffix[a] <= suffix[b]
    shared = sd.common_prefixes(text, ends, order, rank)
    for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
        n = next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b])) if x != y), min(len(suffix[a]), len(suffix[b])))
        assert shared[b] == n


@pytest.mark.parametrize("length, gram", [(20, 5), (33, 8), (40, 40)])
def test_equal_windows_have_equal_anchors(length, gram, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 97)
    rng = random.Random(length)
    passage = bytes(rng.choice(b"abcd") for _ in range(80))
    for text in (b"xyz" * 5 + passage + b"q" * 90 + passage, b"a" * 300, passage * 4):
        h, at, n = sd.anchors(np.frombuffer(text, np.uint8), length, gram)
        of = {}
        for a, first, k in zip(h.tolist(), at.tolist(), n.tolist()):
            for p in range(first, first + k):
                of.setdefault(text[p:p + length], set()).add(a)
        assert int(n.sum()) == len(text) - length + 1 and all(len(x) == 1 for x in of.values())


def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = sd.op3_suffix_dedup(spark, SF_SMALL).collect()
    want = {i: (n, r, s, hashlib.sha256(b).hexdigest()) for i, (n, r, s, b) in by_hand(docs, 400).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    text, other = " ".join(fixtures.words(1, 40)), " ".join(fixtures.words(2, 40))
    rows = [fixtures.row(4, text), fixtures.row(4, text), fixtures.row(None, other), fixtures.row(5, "x" + other), fixtures.row(None, None)]
    found = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in run(fixtures.documents(spark, rows), length=50))
    n, m = len(text), len(other)
    assert found == [(-1, 0, 0), (-1, m, m), (4, n, 0), (4, n, 0), (5, m + 1, m)]
    assert run(fixtures.documents(spark, [])) == []
    assert run(fixtures.documents(spark, [fixtures.row(1, None)]))[0].n_bytes == 0
    shorter = [fixtures.row(4, text), fixtures.row(4, "short"), fixtures.row(6, text + "y"), fixtures.row(6, other)]
    assert len(run(fixtures.documents(spark, shorter), length=50)) == 4


def test_passage_of_over_50_words_in_under_400_bytes(spark):
    """Bytes decide, not words: 399 shared bytes stay, 400 go, and a smaller length takes the 399 too."""
    passage = " ".join(f"{k:06}" for k in range(57))
    assert len(passage) == 398 and len(passage.split()) > 50
    shares_399 = [(1, "1 " + passage + "x"), (2, "2 " + passage + "y")]
    shares_400 = [*shares_399, (3, "3 " + passage + "y")]
    docs = fixtures.documents(spark, [fixtures.row(*t) for t in shares_399])
    assert {r.doc_id: r.n_removed for r in run(docs)} == {1: 0, 2: 0}
    assert {r.doc_id: r.n_removed for r in run(docs, length=399)} == {1: 399, 2: 399}
    rows = run(fixtures.documents(spark, [fixtures.row(*t) for t in shares_400]))
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 400, 3: 400} and digest(rows) == by_hand(shares_400, 400)
