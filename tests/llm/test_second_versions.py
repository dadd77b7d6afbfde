"""Whole results of operators 4, 5 and 8 against plain versions that share no code with them but the folding of characters and words."""

import math
import random
from collections import Counter, defaultdict
from itertools import product

import pyarrow as pa
import pytest

from playlens.llm import decontaminate, html, quality
from tests.llm.common import words

# operator 4 ------------------------------------------------------------------------------------------------------------


def plain_model(symbol_lists):
    """p(symbol | up to three before it), interpolated modified Kneser-Ney by dictionaries."""
    level = {4: Counter(tuple(s[i: i + 4]) for s in symbol_lists for i in range(len(s) - 3))}
    for k in (3, 2, 1):
        level[k] = Counter(g[1:] for g in level[k + 1])
    discounts, totals, kinds = {}, {}, {}
    for k, grams in level.items():
        n1, n2, n3, n4 = (sum(c == i for c in grams.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        steps = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        cut = {g: min(max(steps[min(c, 3) - 1], 0.01), c * 0.95) for g, c in grams.items()}
        total, kind = Counter(), Counter()
        for g, c in grams.items():
            total[g[:-1]] += c
            kind[g[:-1]] += cut[g]
        discounts[k], totals[k], kinds[k] = cut, total, kind

    def chance(gram):
        if not gram:
            return 1 / 32
        k, context = len(gram), gram[:-1]
        if not totals[k][context]:
            return chance(gram[1:])
        own = level[k][gram] - discounts[k][gram] if gram in level[k] else 0
        return (own + kinds[k][context] * chance(gram[1:])) / totals[k][context]

    return chance


def lower_median(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


def test_quality_verdicts(spark):
    rng = random.Random(8)
    texts = [(words(rng, rng.randint(40, 120)), rng.choice(["en", "fr"])) for _ in range(60)]
    texts += [("".join(rng.choice("qwzxkv ") for _ in range(600)), "en"), (texts[0][0], "en"), (texts[0][0], "en")]
    texts += [(None, "en"), ("", "fr"), ("abc", "en"), (words(rng, 60), None), (words(rng, 5) + " r s t" * 60, "fr"), (words(rng, 8_000), "en")]
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    folded = [quality.symbols_of(pa.array([t], pa.string()))[0].tolist() for t, _ in texts]
    about, failed = {}, {}
    for lang in {lang for _, lang in texts}:
        mine = [i for i, (_, other) in enumerate(texts) if other == lang]
        chance = plain_model([folded[i] for i in mine])
        memo = {}
        for i in mine:
            grams = [tuple(folded[i][j: j + 4]) for j in range(len(folded[i]) - 3)]
            logs = [memo[g] if g in memo else memo.setdefault(g, math.log(chance(g))) for g in grams]
            about[i] = -math.fsum(logs) / len(logs) if logs else None
    for i, (t, _) in enumerate(texts):
        w = (t or "").split()
        held = defaultdict(list)
        for j in range(len(w) - 2):
            held[tuple(w[j: j + 3])].append(j)
        again = {j + k for places in held.values() if len(places) > 1 for j in places for k in range(3)}
        failed[i] = len(w) < 50 or 100 * len(again) > 50 * len(w)
        assert got[i].n_repeat_words == len(again) and got[i].base_failed == failed[i]
        assert (got[i].log_perplexity is None) == (about[i] is None)
        if about[i] is not None:
            assert got[i].log_perplexity == pytest.approx(about[i], abs=1e-5)
    outside = 0
    for lang in {lang for _, lang in texts}:
        mine = [i for i, (_, other) in enumerate(texts) if other == lang]
        sound = [round(about[i] * 10_000) for i in mine if not failed[i] and about[i] is not None]
        middle = lower_median(sound)
        width = 5 * max(lower_median([abs(v - middle) for v in sound]) / 10_000, 0.005)
        for i in mine:
            inside = about[i] is None or abs(about[i] - middle / 10_000) <= width
            outside += not inside and not failed[i]
            if about[i] is None or abs(abs(about[i] - middle / 10_000) - width) > 3e-4:
                assert got[i].kept == (inside and not failed[i]), i
    assert outside == sum(not r.kept and not r.base_failed for r in got.values())


def test_bands_do_not_depend_on_order_or_number(spark):
    values = [((i * 7919) % 10_007) / 5_000 for i in range(10_007)]
    docs = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 2.0)], "lang string, log_perplexity double")
    for parts in (1, 7):
        got = {r.lang: (r.low, r.high) for r in quality.bands(docs.repartition(parts), 1.0, 2.0).collect()}
        steps = [round(v * 10_000) for v in values]
        middle = lower_median(steps)
        spread = lower_median([abs(v - middle) for v in steps])
        assert got["a"] == pytest.approx(((middle - spread) / 10_000, (middle + 2 * spread) / 10_000))
        assert got["b"] == pytest.approx((1 - 0.005, 1 + 2 * 0.005))  # the lower of two, at a distance of none


# operator 5 ------------------------------------------------------------------------------------------------------------


def plain_views(text):
    """Tokens and, of each view, a (symbol, kind) list; kinds: 0 literal, 1 name, 2 number, 3 unit, 4 own value only."""
    tokens, found, before = decontaminate.TOKEN.findall(text or ""), [], "."
    for t in tokens:
        if t not in ".!?\n":
            low = t.lower()
            number, unit = t[0].isdigit(), low in decontaminate.UNITS
            title = not number and not unit and len(t) > 1 and t.istitle()
            found.append((low, number, unit and before[0].isdigit(), title, before in ".!?\n"))
        before = t
    names = {low for low, _, _, title, first in found if title and not first}
    views = [[], [], []]
    for low, number, unit, title, first in found:
        kind = 2 if number else 3 if unit else 1 if title and not first else 0
        views[0].append((f"<{kind}>" if kind else low, kind))
        too = (1 if low in names else 4) if title and first else kind
        views[1].append(("<1>" if too in (1, 4) else views[0][-1][0], too))
        views[2].append((low, 0))
    return [f[0] for f in found], views


def fits(pairs):
    """Whether the slots map one to one: (kind, document's value, benchmark's value)."""
    there, back = {}, {}
    for kind, d, b in pairs:
        if kind == 4 and d != b:
            return False
        kind = 1 if kind == 4 else kind
        if there.setdefault((kind, b), d) != d or back.setdefault((kind, d), b) != b:
            return False
    return True


def plain_leak(doc, item, window=8, run=13, literals=6):
    (d_values, d_views), (i_values, i_views) = plain_views(doc), plain_views(item)
    length = len(i_values)
    n = min(window, length)
    if not n:
        return 0
    shifts, cut = defaultdict(set), lambda values, view, at: [(s, k, values[at + j] if k else None) for j, (s, k) in enumerate(view[at: at + n])]
    for a, b, dv, iv in product(range(len(d_values) - n + 1), range(length - n + 1), d_views, i_views):
        d, i = cut(d_values, dv, a), cut(i_values, iv, b)
        if [x[0] for x in d] == [x[0] for x in i] and not all(x[1] for x in d) and not all(x[1] for x in i):
            shifts[a - b].add((b, tuple((j, k, v) for j, (_, k, v) in enumerate(d) if k), tuple((j, k, v) for j, (_, k, v) in enumerate(i) if k)))
    best = 0
    for hits in shifts.values():
        covered = {at + j for at, _, _ in hits for j in range(n)}
        # slots stand at the same places on both sides, and the kind of one depends on its place alone
        pairs = {at + j: (k2, v1, v2) for at, d, i in sorted(hits) for (j, k1, v1), (_, k2, v2) in zip(d, i)}
        for low in covered:
            high, slots, changed = low, [], 0
            while high in covered:
                if high in pairs:
                    slots.append(pairs[high])
                    changed += pairs[high][1] != pairs[high][2]
                    if not fits(slots):
                        break
                high += 1
                if high - low >= min(run, length) and high - low - changed >= min(literals, length):
                    best = max(best, high - low)
    return best


def test_leaks_are_those_of_all_windows(spark):
    rng = random.Random(21)
    names = ["Anna", "Boris", "Clara", "Dmitri"]
    say = lambda: " ".join(rng.choice(names) if x < 0.12 else str(rng.randint(2, 40)) if x < 0.24 else f"{rng.randint(2, 9)} km" if x < 0.3 else words(rng, 1) for x in (rng.random() for _ in range(rng.randint(4, 26))))
    items = ["so " + say() + " ." for _ in range(12)] + ["", None, "tau", "pi 4 km"]
    docs = []
    for i in range(60):
        text = rng.choice(items) or say()
        for old in rng.sample(names, 2) if i % 3 else []:
            text = text.replace(old, rng.choice(names))
        if i % 4 == 0:
            text = " ".join(str(rng.randint(2, 40)) if t.isdigit() and rng.random() < 0.7 else t for t in text.split(" "))
        if i % 5 == 0:
            some = text.split(" ")
            some[rng.randrange(len(some))] = "sigma"
            text = " ".join(some)
        docs.append(words(rng, rng.randint(0, 9)) + " . " + text + words(rng, rng.randint(0, 9)) if i % 2 else text)
    docs += ["", None, docs[0], words(rng, 300)]
    left = spark.createDataFrame([(i, t, 3) for i, t in enumerate(docs)], "doc_id long, text string, hits int")
    right = spark.createDataFrame([(i, t, "z") for i, t in enumerate(items)], "item_id long, text string, hash string")
    got = {r.doc_id: (r.n_items, r.item_id, r.n_tokens, r.kept) for r in decontaminate.judged(left, right).collect()}
    held = 0
    for i, doc in enumerate(docs):
        sizes = sorted((-n, j) for j, item in enumerate(items) if (n := plain_leak(doc, item)) and item not in items[:j])
        want = (len(sizes), sizes[0][1], -sizes[0][0], False) if sizes else (0, None, 0, True)
        assert got[i] == want, (i, doc, got[i], want)
        held += bool(sizes)
    assert 20 < held < len(docs)


# operator 8 ------------------------------------------------------------------------------------------------------------


def test_pages_put_together_of_known_parts(spark):
    """Articles among random parts of other kinds: what comes back is what was put in."""
    rng = random.Random(5)
    other = [
        "<nav><ul><li><a href='/x'>{}</a></li></ul></nav>", "<header><p>{}</p></header>", "<footer>{}</footer>", "<aside><div>{}</div></aside>",
        "<div class='ad'>{}</div>", "<div class=\"cookie-notice\"><p>{}</p></div>", "<form><label>{}</label><input></form>", "<script>var a='</p>{}';</script>",
        "<style>p {{ }} {}</style>", "<!-- {} -->", "<section id=comments><p>{}</p></section>", "<noscript>{}</noscript>", "<div class='sidebar'><ul><li>{}</li></ul></div>"]
    some = lambda: "".join(rng.choice(other).format(words(rng, rng.randint(1, 12))) for _ in range(rng.randint(0, 4)))
    marks = [("a &amp; b", "a & b"), ("x&nbsp;y", "x y"), ("&#233;t&eacute;", "été"), ("<b>bold</b> <i>i</i>", "bold i"), ("one<br>two", "one two"), ("&lt;p&gt;", "<p>")]
    rows, want = [], {}
    for i in range(60):
        body, texts = "", []
        for _ in range(rng.randint(1, 6)):
            mark, plain = rng.choice(marks)
            a, b = words(rng, rng.randint(1, 10)), words(rng, rng.randint(1, 10))
            tag = rng.choice(["p", "h2", "li", "blockquote", "pre", "div"])
            body += f"<{tag}>\n {a}  {mark}\t{b} </{tag}>" + (some() if rng.random() < 0.3 else "")
            texts.append(f"{a} {plain} {b}")
        rows.append((i, f"http://h{i % 3}.org/{i}", f"<html><head><title>t</title></head><body>{some()}<article>{body}</article>{some()}</body></html>"))
        want[i] = "\n".join(texts)
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


@pytest.mark.parametrize("window", [3, 8])
def test_runs_of_a_host_are_those_of_all_pairs_of_pages(spark, window):
    rng = random.Random(window)
    shared = [words(rng, rng.randint(2, 20)).split() for _ in range(8)]
    pages = []
    for i in range(40):
        blocks = [(list(rng.choice(shared)) if rng.random() < 0.5 else [f"{i}x{rng.randint(0, 99)}" for _ in range(rng.randint(1, 12))]) for _ in range(rng.randint(0, 5))]
        pages.append((i, f"h{rng.randint(0, 2)}", blocks))
    pages.append((40, "h0", pages[0][2]))
    rows = [(i, f"http://{h}.org/{i}", "".join(f"<div>{' '.join(b)}</div>" for b in blocks)) for i, h, blocks in pages]
    rows += [rows[3], (41, None, None), (42, "http://h1.org", "")]
    got = [(r.page_id, r.text) for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), window=window).collect()]
    cut = {i: [tuple(t[j: j + window]) for j in range(len(t) - window + 1)] for i, _, blocks in pages for t in [[x for b in blocks for x in b]]}
    want = {41: "", 42: ""}
    for i, h, blocks in pages:
        others = {g for k, other, _ in pages if other == h and k != i for g in cut[k]}
        gone = {j + k for j, g in enumerate(cut[i]) if g in others for k in range(window)}
        at, lines = 0, []
        for b in blocks:
            left = [t for k, t in enumerate(b, at) if k not in gone]
            at += len(b)
            if left:
                lines.append(" ".join(left))
        want[i] = "\n".join(lines)
    assert sorted(got) == sorted([*want.items(), (3, want[3])])
    assert any(want[i] != "\n".join(" ".join(b) for b in blocks) for i, _, blocks in pages)
