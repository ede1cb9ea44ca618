"""The conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from wattlake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, rep long, n long, depth string"


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    full = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(said.get(c - c % 100, [])[:h] + said[c][h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        saved[node] = own + sum(saved[k] for k in children[node])
    out = []
    for node, who in members.items():
        ended = ",".join(str(c) for c in sorted(who) if len(full[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return out


def random_rows(seed, n_convs, spread=900, turns=12, kinds=3):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(spread), n_convs):
        at = 0
        for _ in range(rng.randrange(turns)):
            at += rng.randrange(3)
            text = rng.choice([f"text {rng.randrange(kinds)}", "é漢" * rng.randrange(4), None, ""])
            out.append((c, rng.choice([at, at, at, None]), rng.choice(["user", "user", "assistant", None]), text))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, None, "x") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in trie.prefix_trie(df, **options).collect()]
    want = brute(rows)
    assert len(got) == len(want) and sorted(got, key=str) == sorted(want, key=str)
    return want


def test_random(spark):
    rows = random_rows(1, 200)
    check(spark, rows + rows[:40] + [(None, 1, "user", "nobody's"), (7000, 0, "user", "no leader")] * 2)


def test_small_blocks_and_many_rounds(spark):
    want = check(spark, random_rows(2, 150, kinds=1), block=3, shard=2, fan=2)
    assert max(r[3] for r in want) > 64


def test_one_conversation_with_a_third_of_the_turns_and_copies(spark):
    long = [(5, i, "user", f"t{i % 7}") for i in range(700)]
    copies = [(c, t, "user", f"c{t}") for c in range(1000, 1240) for t in range(3)]
    snapshots = [(2000, t, "user", f"s{t}") for t in range(40)]
    snapshots += [(2000 + k, t, "user", f"s{t}") for k in range(1, 40) for t in range(k)]
    check(spark, long + copies + snapshots, block=64, shard=4, fan=4)


def test_empty_and_turnless(spark):
    assert check_empty(spark) == []
    # no leader: a conversation with at most h turns of its own has none left
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    want = check(spark, [(short, 0, "user", "gone")])
    assert len(want) == 1 and want[0][:2] == (short, 0)


def check_empty(spark):
    return trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect()


def test_queue_spills_and_adds_up():
    rng = random.Random(3)
    messages = [((rng.randrange(60), 1, 1), 1, rng.randrange(9)) for _ in range(3000)]
    queue = trie.MessageQueue(room=50)
    for m in messages:
        queue.push(*m)
    assert queue.made > 10
    for k in range(60):
        mine = [m for m in messages if m[0][0] == k]
        assert queue.take((k, 1, 1)) == (len(mine), sum(m[2] for m in mine))


def test_long_id_lists(spark):
    ends = spark.createDataFrame([(r, 1, c) for r in (1, 2) for c in range(r, 400, r)], "rep long, depth long, conv long")
    got = {r["rep"]: r["ends_sha256"] for r in trie.ends_digests(ends.repartition(7), id_chars=20).collect()}
    assert got == {r: hashlib.sha256(",".join(map(str, range(r, 400, r))).encode()).hexdigest() for r in (1, 2)}
