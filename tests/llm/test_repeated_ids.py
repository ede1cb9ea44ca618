"""An id with two texts: no text that stands nowhere else is lost."""

from collections import Counter

from tests.llm import fixtures as X
from wattlake.llm import common, exact_dedup, simhash, substring_dedup, suffix_dedup

T = " ".join(X.words("first", 200))
U = " ".join(X.words("second", 200))
NEAR = T.upper()


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def docs(spark, *rows):
    return X.documents(spark, [X.row(i, t) for i, t in rows])


def test_exact_dedup_keeps_the_other_text(spark):
    got = exact_dedup.drop_copies(docs(spark, (0, T), (1, T), (1, U), (2, U + " x"), (2, U + " x"), (2, U + "  x"), (None, T)))
    assert got.columns == X.documents(spark, []).columns
    assert [(i, " ".join(t.split())) for i, t in kept(got)] == sorted([(0, T), (1, U), (2, U + " x"), (None, T)], key=str)


def test_simhash_keeps_the_other_text(spark):
    got = kept(simhash.keep_representatives(docs(spark, (0, T), (1, NEAR), (1, U), (2, T), (3, None), (3, U), (None, T))))
    assert got == sorted([(0, T), (1, U), (3, None), (None, T)], key=str)


def test_through_both_stages_of_the_pipeline(spark):
    import corpus_pipeline as P

    stages = dict(P.STAGES)
    df = docs(spark, (0, T), (1, T), (1, U), (2, NEAR), (2, U), (4, "alone " + U[::-1]), (4, NEAR))
    out = stages["SimHash near-dedup"](spark, stages["exact dedup"](spark, df, ""), "")
    assert {t for _, t in kept(out)} == {T, U, "alone " + U[::-1]}


def test_texts_of_one_id_are_cut_each_for_itself(spark):
    """Of U, which stands nowhere else, nothing goes; T goes as its copies ask."""
    df = docs(spark, (7, T), (7, U), (7, U), (8, T), (9, None), (9, U[:40]), (None, "x"))
    bytes_gone = {(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(df, length=100).collect()}
    assert bytes_gone == {(7, len(T), len(T)), (7, len(U), 0), (8, len(T), len(T)), (9, 0, 0), (9, 40, 0), (None, 1, 0)}
    for flush in (1, 10 ** 6):
        got = substring_dedup.remove_repeats(df, window=20, with_text=True, flush_words=flush).collect()
        assert sorted((r.doc_id, r.n_removed) for r in got if r.doc_id is not None) == [(7, 0), (7, 0), (7, 0), (8, 200), (9, 0), (9, 0)]
        assert sorted(r.kept_text for r in got if r.doc_id == 7) == sorted([T, U, U])


def test_a_passage_that_texts_of_one_id_share(spark, monkeypatch):
    """Other texts of the id are other places; hot anchors and the others are joined apart."""
    monkeypatch.setattr(common, "HEAVY_KEYS", 3)
    passage = " ".join(X.words("shared", 60))
    rows = [(7, T + " " + passage), (7, passage + " " + U), *((k, f"{k} {passage}") for k in range(20, 40)), (50, U), (51, T)]
    df, n = docs(spark, *rows), len(passage)
    count = Counter(t[s:s + n] for _, t in rows for s in range(len(t) - n + 1))
    want = []
    for i, t in rows:
        gone = {p for s in range(len(t) - n + 1) if count[t[s:s + n]] > 1 for p in range(s, s + n)}
        want.append((i, len(t), len(gone)))
    found = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(df, length=n).collect()]
    assert sorted(found) == sorted(want)
    got = substring_dedup.remove_repeats(df, window=60).collect()
    assert sorted(r.n_removed for r in got if r.doc_id == 7) == [0, 60]
    assert [r.n_removed for r in got if 20 <= r.doc_id < 40] == [60] * 20
    assert sorted(r.n_removed for r in got if r.doc_id >= 50) == [200, 200]
