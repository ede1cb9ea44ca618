import math
from collections import defaultdict

import pytest

from tests.llm import fixtures
from wattlake.llm import mixing

SIZES = {"big": 6000, "mid": 1500, "small": 300, "tiny": 40}


@pytest.fixture(scope="module")
def docs(spark):
    rows, i = [], 0
    for source, tokens in SIZES.items():
        n = 0
        while n < tokens:
            k = min(tokens - n, 1 + i % 17)
            rows.append(fixtures.row(i, " ".join(["w"] * k), source))
            n, i = n + k, i + 1
    return fixtures.documents(spark, rows)


def weights(a):
    z = sum((t / sum(SIZES.values())) ** a for t in SIZES.values())
    return {s: (t / sum(SIZES.values())) ** a / z for s, t in SIZES.items()}


def bisect(measure, target, low, high):
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if measure(mid) <= target else (mid, high)
    return high


def by_source(rows):
    seen, tokens, weight, repeats = defaultdict(set), defaultdict(int), {}, {}
    for r in rows:
        assert (r.doc_id, r.epoch) not in seen[r.source]
        seen[r.source].add((r.doc_id, r.epoch))
        tokens[r.source] += r.n_tokens
        weight[r.source], repeats[r.source] = r.weight, r.repeats
    return seen, tokens, weight, repeats


def check_budgets(rows, want, budget):
    seen, tokens, weight, _ = by_source(rows)
    for s, total in SIZES.items():
        assert weight[s] == pytest.approx(want[s], rel=1e-5)
        assert tokens[s] <= want[s] * budget * (1 + 1e-6) + 1e-6 and tokens[s] > want[s] * budget - 18
        epochs = defaultdict(int)
        for r in rows:
            if r.source == s:
                epochs[r.epoch] += r.n_tokens
        assert all(epochs[e] == total for e in range(1, int(want[s] * budget / total - 1e-6) + 1))


def test_repetition_limit_without_a_budget_reads_everything(docs):
    repeat = lambda a: max(w / SIZES[s] for s, w in weights(a).items()) / min(w / SIZES[s] for s, w in weights(a).items())
    a = bisect(repeat, 3.0, 0, 1)
    want = weights(a)
    budget = max(SIZES[s] / w for s, w in want.items())
    rows = mixing.mix(docs, max_repetition=3.0).collect()
    check_budgets(rows, want, budget)
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert max(by_source(rows)[3].values()) == pytest.approx(3.0, rel=1e-4)


def test_target_entropy_within_a_budget(docs):
    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    want = weights(bisect(entropy, 1.0, 0, 16))
    check_budgets(mixing.mix(docs, target_entropy=1.0, budget=2000.0).collect(), want, 2000)


def test_repetition_limit_within_a_budget(docs):
    budget = 8000.0
    repeat = lambda a: max(budget * w / SIZES[s] for s, w in weights(a).items())
    want = weights(bisect(repeat, 2.0, 0, 1))
    check_budgets(mixing.mix(docs, max_repetition=2.0, budget=budget).collect(), want, budget)


def test_epochs_are_block_permutations(docs):
    rows = [r for r in mixing.mix(docs, max_repetition=4.0, blocks=16).collect() if r.source == "mid"]
    order = {e: [r.doc_id for r in sorted((r for r in rows if r.epoch == e), key=lambda r: (r.block, r.place))]
             for e in (1, 2)}
    assert set(order[2]) <= set(order[1]) and order[1][:len(order[2])] != order[2]


def test_repeated_documents_have_the_columns(docs):
    times = defaultdict(int)
    for r in mixing.mix(docs).collect():
        times[r.doc_id] += 1
    found = mixing.repeat_documents(docs)
    assert found.columns == docs.columns
    count = defaultdict(int)
    for r in found.collect():
        count[r.doc_id] += 1
    assert count == times


def test_awkward_rows(spark):
    docs = fixtures.documents(spark)
    assert {r.doc_id for r in mixing.mix(docs).collect()} == {i for i, _ in fixtures.texts()}
    rows = [fixtures.row(None, "a b", None), fixtures.row(None, None, None), fixtures.row(4, "c", "s"),
            fixtures.row(4, "c", "s"), fixtures.row(5, None, "empty")]
    docs = fixtures.documents(spark, rows)
    assert {(r.doc_id, r.source) for r in mixing.mix(docs).collect()} == {(None, ""), (4, "s"), (5, "empty")}
    assert mixing.repeat_documents(docs).count() >= 5
    assert mixing.mix(fixtures.documents(spark, [])).count() == 0
    assert mixing.repeat_documents(fixtures.documents(spark, [])).count() == 0


def test_plan_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
