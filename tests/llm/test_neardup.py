"""Near-dedup against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm.neardup import near_duplicates, one_of_each
from tests.llm.common import WORDS, odd_docs, words


def brute(texts, size, percent):
    sets = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    top = list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_copies(seed):
    rng = random.Random(seed)
    texts = ["", None, " ", "One", "one", "two words", "Two Words"]
    for _ in range(8):
        base = [rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(120)]
        for _ in range(rng.randint(1, 30)):
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(len(copy))] = words(rng, 1)
            texts.append(" ".join(copy))
    return texts + texts[20:25]


def test_near_duplicates(spark):
    texts = near_copies(5)
    for size in (2, 5):
        got = sorted(near_duplicates(odd_docs(spark, texts), size=size).collect())
        want = brute(texts, size, 80)
        assert [(r.n_shingles, r.component_id) for r in got] == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_of_each_and_null_ids(spark):
    text = "a b c d e f g h"
    docs = odd_docs(spark, [text, text, "p q r s t", None, None], text).unionByName(odd_docs(spark, [text]))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]


def test_empty(spark):
    assert near_duplicates(odd_docs(spark, [])).count() == 0
    assert {r.component_id for r in near_duplicates(odd_docs(spark, [None, ""])).collect()} == {0, 1}


def test_patterned_words_are_told_apart(spark):
    from tests.llm.test_repeats import thue_morse

    assert [r.component_id for r in sorted(near_duplicates(odd_docs(spark, list(thue_morse(1_024, "a", "b")))).collect())] == [0, 1]


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    from playlens.llm import neardup

    texts = near_copies(9)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "SHARE", 2)
    got = sorted(near_duplicates(odd_docs(spark, texts), size=2).collect())
    assert [(r.n_shingles, r.component_id) for r in got] == brute(texts, 2, 80)


@pytest.mark.parametrize("block", [3, 1_024])
def test_who_asks_whom_against_all_pairs(spark, monkeypatch, block):
    """Classes ask the larger components of which a member in one of their bands looks alike, for hot bands too."""
    from playlens.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 62), 1 << 62, (6, neardup.LONGS))
    fields = neardup.BINS // neardup.FIELDS
    nodes = []
    for i in range(60):
        bits = base[rng.integers(6)].copy()
        for at in rng.integers(0, fields, rng.integers(0, 20)):
            bits[at] = rng.integers(-(1 << 62), 1 << 62)
        bits[fields:] = -1
        label = int(rng.integers(60)) if i % 2 else 7  # component 7 holds half of all
        nodes.append((label, rng.choice(5, 2, replace=False).tolist() + [9], bits.tolist()))
    sizes = Counter(label for label, _, _ in nodes)
    rows = [(int(band), (i, 0), (label, 0), sizes[label], bits) for i, (label, bands, bits) in enumerate(nodes) for band in bands]
    node = "struct<doc_key:bigint,rid:bigint>"
    still = spark.createDataFrame(rows, f"band long, node {node}, label {node}, size long, bits array<long>")
    want = set()
    for i, (x, bands_x, bits_x) in enumerate(nodes):
        for y, bands_y, bits_y in nodes:
            a, b = (np.array([v], np.int64).view(np.uint64) for v in (bits_x, bits_y))
            if (sizes[x], x) < (sizes[y], y) and set(bands_x) & set(bands_y) and neardup.alike(a, b)[0] >= 0.72:
                want.add((i, y))
    got = [(r.node.doc_key, r.pivot.doc_key) for r in neardup.asking(still, 0.72).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_both_estimates_are_one(spark):
    from playlens.llm import neardup

    rows = neardup.keyed(odd_docs(spark, near_copies(3)))
    bits = neardup.signatures(rows, 2).filter("n > 0").select("doc_key", "bits").orderBy("doc_key").limit(40)
    x, y = (neardup.bit_columns(bits, side, F.col("doc_key").alias(f"key_{side}")) for side in "xy")
    pairs = x.join(y, F.col("key_x") < F.col("key_y")).select("key_x", "key_y", neardup.estimate("x", "y").alias("about")).collect()
    of = {r.doc_key: np.array([r.bits], np.int64).view(np.uint64) for r in bits.collect()}
    assert len(pairs) > 100
    assert all(abs(neardup.alike(of[r.key_x], of[r.key_y])[0] - r.about) < 1e-9 for r in pairs)
