"""Kneser-Ney scores against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from playlens.llm import lm
from tests.llm.common import odd_docs, passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*WORD.findall(lower), "</s>"]


def off(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = {0: 0.0}
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else i / 2
        out[i] = min(max(d, 0.01 * i), 0.99 * i)
    return out


def model(train):
    """p(w | v) as a function, from counts of pairs kept in dictionaries."""
    pairs = Counter((a, b) for t in train for a, b in zip(["<s>", *t], t))
    words = Counter(w for t in train for w in t)
    follow, left = defaultdict(list), Counter(w for _, w in pairs)
    for (v, _), c in pairs.items():
        follow[v].append(c)
    d2, d1 = off(list(pairs.values())), off(list(left.values()))
    distinct, size = len(pairs), len(words)
    rest = sum(d1[min(c, 3)] for c in left.values()) / distinct if distinct else 1.0

    def chance(v, w):
        below = rest / (size + 1) + (max(left[w] - d1[min(left[w], 3)], 0) / distinct if distinct else 0)
        if v not in follow:
            return below
        total = sum(follow[v])
        c = pairs[v, w]
        return (c - d2[min(c, 3)]) / total + sum(d2[min(c, 3)] for c in follow[v]) / total * below

    return chance, words


def brute(docs):
    toks = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, tokens(t)) for i, t in docs]
    chance, words = model([t for _, held, t in toks if not held])
    total, size = sum(words.values()), len(words)
    out = []
    for i, held, t in toks:
        base = sum(math.log10((words[w] + 1) / (total + size + 1)) for w in t)
        out.append((i, held, len(t), sum(words[w] > 0 for w in t), total, base, sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *t], t))))
    return out


def same(spark, texts, null_id):
    got = lm.scored(odd_docs(spark, texts, null_id)).collect()
    want = brute([*enumerate(texts), *([(None, null_id)] if null_id is not None else [])])
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got, want = sorted((tuple(r)[:7] for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-10, atol=1e-9)
    return got


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, parts of long texts, shards, and frequent words spread over them
        monkeypatch.setattr(lm, "BLOCK_TOKENS", 700)
        monkeypatch.setattr(lm, "SLICE_BYTES", 900)
        monkeypatch.setattr(lm, "SHARD_PAIRS", 2_000)
    texts = [*passages(3), "The THE the thE ÄÖ äö İ x", " " * 3_000 + "late", "a\x0bb\x0cc\r\nd\te", *(["a hot line"] * 60)]
    rows = same(spark, texts, "alpha Beta nobody")
    assert any(r[1] for r in rows) and not all(r[1] for r in rows)


def test_small_tables(spark):
    for texts, null_id in (([], None), ([None], None), (["", None, " \n"], ""), (["one"], None)):
        same(spark, texts, null_id)
    held = next(i for i in range(99) if lm.held_out(i))  # nothing to learn from: every chance is one
    row = lm.scored(odd_docs(spark, ["x y"] * (held + 1)).filter(f"doc_id = {held}")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score, row.perplexity) == (3, 0, 0, 0.0, 0.0, 1.0)


def test_chances_sum_to_one():
    rng = random.Random(1)
    chance, words = model([tokens(" ".join(rng.choices("abcdefg", [9, 5, 3, 2, 1, 1, 1], k=12))) for _ in range(30)])
    for v in ["<s>", *words, "unseen"]:
        assert abs(sum(chance(v, w) for w in [*words, "unknown"]) - 1) < 1e-9


def test_packed_numbers_and_colliding_pairs(monkeypatch):
    for a in ([], [0], [1, 70_000, 3], [1 << 40, 0], [-5, 1 << 62]):
        assert lm.unpack(lm.pack(np.array(a, np.int64), np.arange(3)))[0].tolist() == a
    plain = lm.pair_hash
    monkeypatch.setattr(lm, "pair_hash", lambda v, w, seed: plain(v, w, seed) % lm.U64(50 if seed < 3 else 1 << 60))
    v, w = np.array([1, 1, 2, 2, 3, 1] * 5), np.array([1, 2, 1, 2, 9, 1] * 5)
    counts = lm.PairCounts(v, w, np.array([1, 0, 2, 1, 0, 1] * 5))
    assert counts.of(np.array([1, 1, 2, 2, 3]), np.array([1, 2, 1, 2, 9])).tolist() == [10, 0, 10, 5, 0]
    counts.close()
