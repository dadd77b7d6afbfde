"""The conversation trie against plain Python."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from playlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, kx string, shard int"


def brute(rows):
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        head, rest = zlib.crc32(str(c).encode()) % 9, abs(c) % 5
        base = c - (rest if c >= 0 else -rest)
        whole = own.get(base, [])[:head] + turns[head:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    name = lambda p: min(c for c, _ in members[p])
    out = []
    for p, held in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = {q for q in below if len(q) == len(p) + 1}
        leaves = sum(not any(r[: len(q)] == q and len(r) > len(q) for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        tips = ",".join(str(c) for c, last in sorted(held) if last)
        out.append((name(p), len(p), name(p[:-1]) if p else None, len(held), len(kids), leaves, saved, hashlib.sha256(tips.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, **how):
    df = spark.createDataFrame([(*r, 9, "k", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in trie.prefix_trie(df, **how).collect()), key=repr)


def odd_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 1_000_003]:
        for t in range(rng.choice([1, 2, 3, 9, 14])):
            rows.append((c, t, rng.choice(["user", "user", None, ""]), rng.choice(["a", "a", "a", "é", None, "b" * 2_000])))
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 0, "x", "a tie"), (None, 1, "user", "nobody's"), rows[5]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"light": 2, "top_nodes": 3, "queue": 2}])
def test_against_brute_force(spark, monkeypatch, how):
    if how:
        monkeypatch.setattr(trie, "BAND", 3)
        monkeypatch.setattr(trie, "BLOCK_BYTES", 4)
    rows = odd_rows(len(how))
    assert result(spark, rows, **how) == brute(rows)


def test_one_conversation_and_none(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "a", "b")]) == []
    for c in (0, 3):  # of 3, the first turns are those of conversation 0, which is absent
        rows = [(c, t, "user", "x" * t) for t in range(12)]
        assert result(spark, rows) == brute(rows)


def test_long_conversation_in_bands(spark, monkeypatch):
    monkeypatch.setattr(trie, "BAND", 16)
    rows = [(c, t, "user", str(t)) for c in (1, 2, 6) for t in range(100)] + [(11, t, "user", str(t)) for t in range(60)]
    assert result(spark, rows, light=1, top_nodes=10, queue=3) == brute(rows)


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, plain, got, want = trie.SpillingQueue(5), [], [], []
    for _ in range(2_000):
        if rng.random() < 0.6 or not plain:
            row = (rng.randint(-9, 9), rng.randint(0, 5), rng.randint(0, 1 << 62))
            queue.push(row)
            heapq.heappush(plain, row)
        else:
            got.append(queue.pop())
            want.append(heapq.heappop(plain))
    while plain:
        got.append(queue.pop())
        want.append(heapq.heappop(plain))
    assert got == want and queue.head() is None
