"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import fixtures as X
from wattlake.llm import spelling


def is_letter(c):
    return "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ"


def brute_counts(docs, min_count=3):
    total = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if is_letter(c):
                run += c.lower() if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 97 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                total[run] += 1
            run = ""
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(vocabulary):
    near = {w: [v for v in vocabulary if one_edit(w, v)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 2 * n else None
    out = set()
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), vocabulary.get(form[w])))
    return out


def docs_with_misspellings():
    rng = random.Random(5)
    stems = ["energy", "enérgy", "energie", "market", "markets", "aabbcc", "abbcc", "ÀÉîõü", "letters", "lettter",
             "x" * 40, "x" * 41, "y" * 300, "straße", "x×÷ý" * 3]
    out = [(None, "energy market " * 5), (0, None), (1, ""), (2, "12 ?! \t"), (3, "abcd efg h")]
    for i in range(4, 120):
        words = []
        for _ in range(rng.randrange(60)):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aeiouzé") + w[k:], w[:k] + rng.choice("aez") + w[k + 1:]])
            words.append(w.upper() if rng.random() < 0.2 else w)
        out.append((i, rng.choice([" ", "\n", "-", "1"]).join(words)))
    return out + [out[10], out[11], out[11]] + X.texts()


def rows(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def test_against_brute_force(spark, tmp_path):
    docs = docs_with_misspellings()
    X.documents(spark, [X.row(i, t) for i, t in docs]).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(spelling.op11_spelling_variants(spark, str(tmp_path)))
    want = brute(brute_counts(docs))
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] for r in want) and any(r[1] is None for r in want)


def test_rounds_change_nothing(spark):
    rng = random.Random(1)
    vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 400) for _ in range(1500)}
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    want = brute(vocabulary)
    assert set(rows(spelling.variants(df))) == want
    small = spelling.PART_BLOCKS * spelling.BLOCK_WORDS * 8
    assert len(spelling.rounds({5: 10, 6: 9000, 7: 3}, small)) == 4
    assert set(rows(spelling.variants(df, round_bytes=small))) == want


def test_long_chain_of_forms(spark):
    chain = [("a" * (40 - i), 3 * 2 ** i) for i in range(30)]
    got = {r[0]: r for r in rows(spelling.variants(spark.createDataFrame(chain, "word string, n long")))}
    last = chain[-1][0]
    assert all(r[2] == last for r in got.values()) and got[last][1] is None


def test_empty(spark):
    assert rows(spelling.variants(spark.createDataFrame([], "word string, n long"))) == []
    assert spelling.word_counts(X.documents(spark, [])).count() == 0


def test_hashes_of_edits_and_filters_miss_nothing():
    words = ["energy", "market", "àéîõü", "aabbcc"]
    for w in words:
        letters = np.frombuffer(w.encode("latin-1"), np.uint8).reshape(1, -1)
        size = len(w)
        deleted = {w[:i] + w[i + 1:] for i in range(size)}
        lengths = {size: 0, size - 1: len(deleted)}

        def hashed(v):
            a = np.frombuffer(v.encode("latin-1"), np.uint8)
            return (spelling.LETTER[a] * spelling.weights(len(a))).sum(dtype=np.uint64)

        filled = np.zeros(spelling.PART_BLOCKS * spelling.BLOCK_WORDS, np.uint64)
        for v in deleted:
            block, bits = spelling.place(np.array([hashed(v)]), spelling.blocks_for(len(deleted)))
            for k in range(spelling.BITS):
                at = int(bits[0]) >> (9 * k) & 511
                filled[int(block[0]) * 8 + at // 64] |= np.uint64(1 << (at % 64))
        filters = spelling.Filters(lengths, [(size - 1, 0, 1)], {(size - 1, 0): filled.tobytes()})
        found = [bytes(e).decode("latin-1") for _, edit in spelling.probe(letters, np.array([], np.uint8), filters) for e in edit]
        assert sorted(found) == sorted(deleted)


@pytest.mark.parametrize("one_in", [1, 97])
def test_altered_by_id(one_in):
    got = dict(spelling.altered("12", {"market": 4}, one_in))
    h = zlib.crc32(b"12:market")
    want = "market" if h % one_in else "market"[:h % 6] + "market"[h % 6 + 1:]
    assert got == {want: 4}
