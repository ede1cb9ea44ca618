"""Language identification: held-out accuracy, arrays against plain Python, and awkward inputs."""

import random
import zlib

import numpy as np

from tests.llm import fixtures as X
from wattlake.llm import language_id as L

WORDS = {
    "aa": "the energy market price of power is set each hour by the last unit that runs and who pays",
    "bb": "el precio de la energía se fija cada hora según la última unidad que entra y quién paga año",
    "cc": "der preis für die kilowattstunde wird jede stunde durch das letzte kraftwerk gesetzt und wer zahlt",
}


def documents(spark, n=240, seed=3, extra=()):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        text = " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(6, 60)))
        rows.append((i, text, None if i % 11 == 0 else lang))
    rows += extra
    return rows, spark.createDataFrame([(*r, "src", 9, "clash", 0.5) for r in rows],
                                       "doc_id long, text string, lang string, source string, n long, held_out string, score double"
                                       ).repartition(4)


def in_fold(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_awkward_rows(spark, tmp_path):
    extra = [(900, None, "aa"), (901, "", "bb"), (902, " 12 -- ?\n", None), (None, "the price of power", "aa"),
             (903, "energía " * 200_000, "bb"), (5, "the hour the hour", "aa"), (5, "the hour the hour", "aa"), (904, "ß", None)]
    rows, df = documents(spark, extra=extra)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op12_language_id(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    got = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    truth = {i: lang for i, _, lang in rows}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and in_fold(r["doc_id"])) and 0 <= r["score"] <= 1
        if r["doc_id"] in (900, 901, 902):
            assert r["lang_pred"] == "und" and r["score"] == 0
        else:
            assert r["lang_pred"] in WORDS
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]] and r["doc_id"] < 900]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert {r["lang_pred"] for r in got if r["doc_id"] == 903} == {"bb"}


def test_held_out_rows_teach_nothing(spark):
    rows, _ = documents(spark)
    swapped = [(i, t, "zz" if in_fold(i) else lang) for i, t, lang in rows]
    _, df = documents(spark, 0, extra=swapped)
    model = L.train(df)
    assert model.langs == sorted(WORDS)
    _, same = documents(spark, 0, extra=rows)
    assert np.array_equal(model.table, L.train(same).table)


def test_nothing_or_one_language_to_learn(spark):
    _, df = documents(spark, 0, extra=[(0, None, "aa"), (1, "abc", None), (2, "1 2", "aa")])
    assert {(r["lang_pred"], r["score"]) for r in L.identify(df, L.train(df)).collect()} == {("und", 0.0)}
    _, one = documents(spark, 0, extra=[(i, "some words", "aa") for i in range(9)] + [(50, "12", None)])
    assert {(r["lang_pred"], r["score"]) for r in L.identify(one, L.train(one)).collect()} == {("aa", 1.0), ("und", 0.0)}
    _, empty = documents(spark, 0)
    assert L.identify(empty, L.train(empty)).collect() == []


def plain_grams(text):
    """Distinct n-grams as strings, counted."""
    spaced = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    found = {}
    for n in (1, 2, 3):
        for k in range(len(spaced) - n + 1):
            g = spaced[k:k + n]
            if g != " ":
                found[g] = found.get(g, 0) + 1
    return found


def test_grams_against_plain_python(monkeypatch):
    letters = L._letters()
    for text in ("a", "The cat, the CAT!", "  x1y  ", "año ß漢字 é", " ".join(t or "" for _, t in X.texts()[3:9])):
        want = plain_grams(text)
        for chunk in (L.CHUNK, 7):
            monkeypatch.setattr(L, "CHUNK", chunk)
            if chunk == 7 and len(text) > 200:
                continue
            hashes, counts = L.text_grams(text, letters)
            if chunk == L.CHUNK and chunk != 7:
                assert counts.sum() == sum(want.values())
                assert len(hashes) <= len(want) <= len(hashes) + len(want) ** 2 // L.SIZE + 2
        monkeypatch.setattr(L, "CHUNK", 1 << 19)
    assert list(L.chunks("12 !", letters)) == []


def test_scores_of_many_texts_equal_one_by_one(monkeypatch):
    letters, rng = L._letters(), np.random.default_rng(1)
    table = rng.normal(size=(L.SIZE, 3)).astype(np.float32)
    texts = [t or "" for _, t in X.texts()]
    sums, counts = L.score_texts(texts, table, letters)
    for i, t in enumerate(texts):
        index, count = L.text_grams(t, letters)
        assert counts[i] == count.sum()
        assert np.allclose(sums[i], count @ table[index].astype(float), atol=1e-2)
    monkeypatch.setattr(L, "CHUNK", 50)
    for i, t in enumerate(texts[:12]):
        s, c = L.score_texts([t], table, letters)
        index, count = L.text_grams(t, letters)
        assert c[0] == count.sum() and np.allclose(s[0], count @ table[index].astype(float), atol=1e-2)


def plain_ftrl(rows, y, k, size, alpha, beta, l1, l2):
    z = [[0.0] * k for _ in range(size + 1)]
    n = [[0.0] * k for _ in range(size + 1)]

    def weight(i, c):
        penalty = 0.0 if i == size else l1
        if abs(z[i][c]) <= penalty:
            return 0.0
        sign = 1 if z[i][c] > 0 else -1
        return -(z[i][c] - sign * penalty) / ((beta + n[i][c] ** 0.5) / alpha + l2)

    for i in np.random.default_rng(11).permutation(len(rows)):
        x = [*zip(rows[i][0].tolist(), rows[i][1].tolist()), (size, 1.0)]
        w = {j: [weight(j, c) for c in range(k)] for j, _ in x}
        score = np.array([sum(v * w[j][c] for j, v in x) for c in range(k)])
        p = np.exp(score) / np.exp(score).sum()
        for j, v in x:
            for c in range(k):
                g = v * (p[c] - (c == y[i]))
                sigma = ((n[j][c] + g * g) ** 0.5 - n[j][c] ** 0.5) / alpha
                z[j][c] += g - sigma * w[j][c]
                n[j][c] += g * g
    return np.array([[weight(j, c) for c in range(k)] for j in range(size + 1)])


def test_follow_the_leader_against_plain_python():
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4) * 3) for _ in range(40)]
    y = np.array([int(r[0][0] % 3) for r in rows])
    w, b = L.follow_the_leader(rows, y, 3, size=12, epochs=1)
    want = plain_ftrl(rows, y, 3, 12, L.ALPHA, L.BETA, L.L1, L.L2)
    assert np.allclose(np.vstack([w, b]), want)
    assert 0 < (w == 0).sum()      # the l1 penalty leaves some at zero


def test_temperature_is_likeliest():
    rng = np.random.default_rng(4)
    scores = rng.normal(size=(400, 3)) * 4
    y = np.array([rng.choice(3, p=L.softmax(s / 2.5)) for s in scores])
    t = L.temperature(scores, y)
    loss = lambda t: -np.log(L.softmax(scores / t)[np.arange(len(y)), y]).mean()
    assert 1.9 < t < 3.3 and all(loss(t) <= loss(u) + 1e-9 for u in (t * 0.9, t * 1.1, 1.0))


def test_bounds_of_the_sample(spark):
    rows, df = documents(spark, 400)
    known = df.where("lang is not null").selectExpr("lang", "pmod(xxhash64(doc_id), 1099511627776) order", "text")
    picked = L.sample(known, max_rows=30).collect()
    assert len(picked) == 30 and {sum(r["lang"] == x for r in picked) for x in WORDS} == {10}
    few = L.sample(known, max_rows=30, max_features=600).collect()
    assert 0 < len(few) < 30 and sum(len(r["grams"]) // 4 for r in few) <= 600
