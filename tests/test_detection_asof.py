"""Validated detection (S9) and profiles as of the event (S2), against plain Python."""

import datetime as dt
import random
import re

from wattlake.operators import detection
from wattlake.operators.sensitive import PATTERNS
from wattlake.streaming.asof import asof_join

# Python's re has possessive runs since 3.11, so the same patterns work there.
FINDERS = {k: re.compile(p) for k, p in PATTERNS.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0 and digits[0] in "23456"


def valid(kind, value):
    if kind == "cards":
        return luhn(re.sub("[^0-9]", "", value))
    if kind == "ipv4s":
        return all(int(p) <= 255 for p in value.split("."))
    return True


def texts():
    rng = random.Random(8)
    parts = ["4111 1111 1111 1111", "4111 1111 1111 1112", "0000000000000000", "5500-0000-0000-0004", "999.999.999.999",
             "10.0.0.255", "256.1.1.1", "a.b@c.example", "+1 (555) 123-4567", 'password = "x y"', "é漢", "word", "\n", "12"]
    out = [None, "", "nothing here", "4111111111111111", "x4111111111111111x 1.2.3.4,5.6.7.8"]
    return out + [" ".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(40)] + [
        "10.0.0.1 " * 20_000 + "4111 1111 1111 1111"]


def test_spans_counts_and_masks(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted((i, k, m.start(), m.end() - m.start(), m.group()) for i, t in rows for k, f in FINDERS.items()
                  for m in f.finditer(t or "") if valid(k, m.group()))
    assert sorted(tuple(r) for r in detection.find_spans(df).collect()) == want
    got = {r["doc_id"]: r for r in detection.validated_counts(df).collect()}
    assert all(got[i][k] == sum(w[0] == i and w[1] == k for w in want) for i, _ in rows for k in PATTERNS)
    hidden = dict(df.select("doc_id", detection.masked(df.text)).collect())
    for i, t in rows:
        for k, f in FINDERS.items():
            t = t and f.sub(lambda m, k=k: f"[{k}]" if valid(k, m.group()) else m.group(), t)
        assert hidden[i] == t


def test_every_text_column_is_scanned(spark):
    df = spark.createDataFrame([("10.0.0.1 10.0.0.2", "4111111111111111", 3), ("x", None, 4), ("300.0.0.1", "1.1.1.1", 5)],
                               "a string, b string, n int")
    assert {tuple(r) for r in detection.scan_columns(df).collect()} == {
        ("a", "ipv4s", 1, 2), ("b", "cards", 1, 1), ("b", "ipv4s", 1, 1)}


def test_asof_join(spark):
    rng = random.Random(9)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(400))
    events = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([at(), at(), None]), "e") for i in range(400)]
    history = [(rng.choice([1, 2, 4]), at(), rng.randrange(5)) for _ in range(60)] + [(1, None, 9), (None, at(), 9)]
    e = spark.createDataFrame(events, "id int, user_id int, ts timestamp_ntz, n string").repartition(3)
    h = spark.createDataFrame(history, "user_id int, valid_from timestamp_ntz, plan int")
    want = set()
    for i, user, ts, n in events:
        known = [(f, p) for u, f, p in history if u is not None and u == user and f and ts and f <= ts]
        want.add((i, user, ts, n, *(max(known) if known else (None, None))))
    for days in (1, 7):
        got = [tuple(r) for r in asof_join(e, h, range_days=days).collect()]
        assert len(got) == len(events) and set(got) == want
    assert asof_join(e, h.limit(0)).where("plan is null").count() == len(events)
    assert asof_join(e.limit(0), h).count() == 0
