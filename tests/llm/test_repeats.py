"""Substring, suffix and line dedup against brute force."""

import hashlib
from collections import Counter

import pytest

from playlens.llm import lines, quality, repeats, rolling, substrings, suffixes
from tests.llm.common import odd_docs, passages


def first_occurrence_kept(sequences, width):
    """Per sequence the marks of what earlier windows cover."""
    seen, out = set(), []
    for s in sequences:
        mark = [False] * len(s)
        for i in range(len(s) - width + 1):
            key = tuple(s[i: i + width])
            if key in seen:
                mark[i: i + width] = [True] * width
            seen.add(key)
        out.append(mark)
    return out


def earlier_lines(sequences):
    """Marks of lines that earlier runs of three cover, or that have twenty words and stand earlier."""
    seen, out = set(), first_occurrence_kept(sequences, 3)
    for s, mark in zip(sequences, out):
        for i, line in enumerate(s):
            if len(line.split()) >= 20:
                mark[i] |= line in seen
                seen.add(line)
    return out


@pytest.mark.parametrize(("width", "hot"), [(20, 20_000), (7, 2)])
def test_substrings(spark, monkeypatch, width, hot):
    monkeypatch.setattr(repeats, "HOT_KEY", hot)
    texts = passages(width)
    cut = [(t or "").split() for t in texts]
    got = sorted(substrings.strip_substrings(odd_docs(spark, texts), width=width).collect())
    for row, s, gone in zip(got, cut, first_occurrence_kept(cut, width)):
        kept = " ".join(w for w, g in zip(s, gone) if not g)
        assert (row.n_words, row.n_removed, row.kept, row.kept_sha256) == (len(s), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest())
    assert sum(r.n_removed for r in got)


@pytest.mark.parametrize(("width", "hot"), [(40, 20_000), (23, 2)])
def test_suffixes(spark, monkeypatch, width, hot):
    monkeypatch.setattr(repeats, "HOT_KEY", hot)
    texts = [t[:3_000] if t else t for t in passages(width + 1)]
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i: i + width] for d in data for i in range(len(d) - width + 1))
    got = sorted(suffixes.strip_repeats(odd_docs(spark, texts), width=width).collect())
    for row, d in zip(got, data):
        mark = [False] * len(d)
        for i in range(len(d) - width + 1):
            if times[d[i: i + width]] > 1:
                mark[i: i + width] = [True] * width
        spans = sum(m and (not i or not mark[i - 1]) for i, m in enumerate(mark))
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == (len(d), sum(mark), spans, bytes(b for b, m in zip(d, mark) if not m))


def test_lines(spark):
    texts = passages(3)
    cut = [[x.strip() for x in (t or "").split("\n") if x.strip()] for t in texts]
    got = sorted(lines.strip_lines(odd_docs(spark, texts)).collect())
    for row, s, gone in zip(got, cut, earlier_lines(cut)):
        assert (row.n_lines, row.n_removed) == (len(s), sum(gone))
        left = [x.strip() for x in (row.kept or "").split("\n") if x.strip()]
        assert left == [x for x, g in zip(s, gone) if not g]
    assert got[texts.index(None)].kept is None


def test_ids_null_and_repeated(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (1, "other"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed) for r in substrings.strip_substrings(docs).collect())
    # the null id comes first and keeps its words; the two equal rows are one document
    assert got == [(False, 0, 40, 0), (True, 1, 1, 0), (True, 1, 40, 40), (True, 1, 40, 40), (True, 2, 0, 0)]
    assert {r.n_removed for r in suffixes.strip_repeats(docs, width=20).collect() if r.n_bytes > 50} == {len(text)}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeated_rows_keep_what_shares_an_anchor(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_KEY", hot)
    common = [f"c{i}" for i in range(12)]
    words = [" ".join([f"{x}{i}" for i in range(12)] + common + [f"{x}z{i}" for i in range(12)]) for x in "ab"]
    docs = spark.createDataFrame([(1, words[0]), (1, words[0]), (2, words[1])], "doc_id long, text string")
    assert {r.n_removed for r in substrings.strip_substrings(docs).collect()} == {0}
    texts = ["\n".join([f"{x}1", "c1", "c2", f"{x}2"]) for x in "ab"]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[0]), (2, texts[1])], "doc_id long, text string")
    assert {(r.n_removed, r.kept) for r in lines.strip_lines(docs).collect()} == {(0, t) for t in texts}


def test_empty_tables(spark):
    none = odd_docs(spark, [])
    assert not substrings.strip_substrings(none).count() + suffixes.strip_repeats(none).count() + lines.strip_lines(none).count()


def test_without_runs_keeps_columns_and_drops_emptied(spark):
    docs = odd_docs(spark, ["a b\nc d\ne f", "x\na b\nc d\ne f", "a b\nc d\ne f", "", None], "y")
    got = {r.doc_id: r for r in lines.without_runs(docs).collect()}
    assert set(got) == {None, 0, 1, 3, 4} and lines.without_runs(docs).columns == docs.columns
    assert (got[1].text, got[1].n_chars, got[1].rid, got[1].source) == ("x", 1, 7, None)


def test_automaton():
    known = substrings.SuffixAutomaton()
    known.add("abcab")
    known.add("cabx")
    assert list(known.matching("xcabxzab")) == [1, 1, 2, 3, 4, 0, 1, 2]


def test_suffix_order_sorts_and_verifies():
    import numpy as np

    data = np.frombuffer(b"bananabananaba", np.uint8)
    order = suffixes.SuffixOrder(data, 4)
    starts = np.arange(11)
    got = order.sort(starts, np.zeros(11, int))
    assert [bytes(data[i: i + 4]) for i in starts[got]] == sorted(bytes(data[i: i + 4]) for i in range(11))
    assert order.verified(np.array([0, 1]), np.array([6, 2])).tolist() == [True, False]


def thue_morse(n, a, b):
    """Two words on which every polynomial hash modulo 2**64 collides once n >= 1024."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def test_patterned_words_are_told_apart(spark):
    x, y = thue_morse(1_024, "a", "b")
    near = [f"w{i}" for i in range(20)]
    texts = [" ".join([*near[:10], w, *near[10:]]) for w in (x, y)]
    assert {r.n_removed for r in substrings.strip_substrings(odd_docs(spark, texts)).collect()} == {0}
    texts = [f"{x} c d {y} c d", f"{x} c d {x} c d"]
    assert [r.n_repeat_words for r in sorted(quality.judged(odd_docs(spark, texts)).collect())] == [0, 6]


def test_suffixes_at_the_real_width_and_over_chunk_edges(spark):
    import random

    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, copy = noise(300), noise(3 * rolling.CHUNK // 2)  # a copy longer than what is worked on at once
    texts = [noise(rolling.CHUNK - 150) + shared + noise(500), shared[:200] + "x", shared[:199] + "y", "q" + shared[40:], copy, noise(50) + copy + noise(50), thue_morse(2_048, "a", "b")[0]]
    data = [t.encode() for t in texts]
    times = Counter(hash(d[i: i + 200]) for d in data for i in range(len(d) - 199))
    got = sorted(suffixes.strip_repeats(odd_docs(spark, texts)).collect())
    for row, d in zip(got, data):
        mark, until = bytearray(len(d)), 0
        for i in range(len(d) - 199):
            if times[hash(d[i: i + 200])] > 1:
                mark[max(i, until): i + 200] = b"\1" * (i + 200 - max(i, until))
                until = i + 200
        kept = bytes(b for b, m in zip(d, mark) if not m)
        assert (row.n_bytes, row.n_removed, bytes(row.kept)) == (len(d), sum(mark), kept)


def test_substrings_over_chunk_edges(spark):
    import random

    rng = random.Random(9)
    words = [f"{rng.randrange(50_000)}" for _ in range(rolling.CHUNK + 400)]
    middle = words[rolling.CHUNK - 30: rolling.CHUNK + 30]  # around the edge
    texts = [" ".join(words), " ".join(["p", *middle, "q"])]
    cut = [t.split() for t in texts]
    got = sorted(substrings.strip_substrings(odd_docs(spark, texts)).collect())
    assert [r.n_removed for r in got] == [sum(g) for g in first_occurrence_kept(cut, 20)] == [0, 60]


def test_a_long_line_is_a_run_by_itself(spark):
    long_line, short = " ".join(f"w{i}" for i in range(60)), "eight words are not enough for this rule"
    texts = [f"a\n{long_line}", f"  {long_line}\t\nb", long_line, short, short, f"{long_line}\n{long_line}\nc"]
    got = sorted(lines.strip_lines(odd_docs(spark, texts)).collect())
    assert [(r.n_lines, r.n_removed, r.kept) for r in got] == [(2, 0, texts[0]), (2, 1, "b"), (1, 1, ""), (1, 0, short), (1, 0, short), (3, 2, "c")]
    docs = odd_docs(spark, [long_line]).unionByName(odd_docs(spark, [long_line]))  # one document twice
    assert {r.n_removed for r in lines.strip_lines(docs).collect()} == {0}
