"""Tokens, URLs, pages, quality, languages and benchmark texts."""

import base64
import hashlib
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from playlens.llm import bpe, decontaminate, html, langid, quality, rolling, stages, urls
from tests.llm.common import odd_docs, passages

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_as_the_library(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 5_000)
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = passages(4) + ["it's 12 x  \n\n y <|endoftext|> 漢字 🙂\u00a0z", "q" * 3_000, "   "]
    docs = odd_docs(spark, texts, "one")
    rows = bpe.encoded(docs, PATH, PATTERN, columns=("doc_id", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    got = {r.doc_id: r for r in rows}
    for i, t in [*enumerate(texts), (None, "one")]:
        ids = library.encode_ordinary(t or "")
        data = (t or "").encode()
        assert (got[i].n_tokens, got[i].ids, bytes(got[i].decoded)) == (len(ids), ids, data)
        assert (got[i].ids_sha256, got[i].decoded_sha256) == (hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest())
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN).collect()}
    assert back[0] == (texts[0] or "").encode()
    assert bpe.encoded(odd_docs(spark, []), PATH, PATTERN).count() == 0


def test_bpe_holds_a_block_in_few_bytes_per_word(monkeypatch):
    """Positions take four bytes a word and are worked on in place; ids of distinct words are no lists."""
    monkeypatch.setattr(bpe.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    with open(PATH, "rb") as f:
        shared = SimpleNamespace(value=(f.read(), PATTERN))
    bpe._vocabulary(shared)
    columns = ["doc_id", "n_tokens", "ids", "decoded_sha256"]

    def peak(rows):
        tracemalloc.reset_peak()
        before, out = tracemalloc.get_traced_memory()[0], list(rows)
        return (tracemalloc.get_traced_memory()[1] - before) / 1e6, out

    def blocks(texts):
        batches = (pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]}) for i, t in enumerate(texts))
        tracemalloc.start()
        try:
            cut, rows = peak(bpe._cut(batches, PATTERN, {}))
            rows = sorted(bpe._encode_lists(iter(rows), shared), key=lambda r: (r.column("block")[0].as_py(), r.column("bucket")[0].as_py()))
            assembled, out = peak(bpe._assemble(iter(rows), shared, columns))
        finally:
            tracemalloc.stop()
        assert [hashlib.sha256(t.encode()).hexdigest() for t in texts] == [x for b in out for x in b.column("decoded_sha256").to_pylist()]
        return cut, assembled

    cut, _ = blocks([" a b c d" * 5_000] * 75)  # 1.5 million words, four of them distinct
    assert cut < 15  # megabytes
    _, assembled = blocks([" ".join(f"{chr(0x4e00 + i)}{chr(0x5e00 + j)}" for i in range(k, k + 10) for j in range(1_000)) for k in range(0, 100, 10)])
    assert assembled < 28  # 100,000 words, all distinct


def test_workers_forget_words_after_a_task():
    rolling.word_symbols(*rolling.text_bytes(pa.array(["some words"])))
    decontaminate.templates(["some words"])
    assert rolling._word_hashes and decontaminate._codes
    stages.release_memory()
    assert not rolling._word_hashes and not decontaminate._codes


def test_bpe_words_of_all_characters_are_those_of_the_library():
    """Every code point alone, between letters, digits, blanks and others: the pieces are the library's."""
    import regex

    single = {bytes([i]): i for i in range(256)}
    unlike = bpe.unlike_characters()
    compiled, characters = regex.compile(PATTERN), frozenset(map(chr, unlike))
    marks = [("a", "1"), (" ", "a"), (".", "\n")]
    for a, b in marks:
        for low in range(0, 0x110000, 0x8000):
            chars = [chr(c) for c in range(low, low + 0x8000) if not 0xD800 <= c < 0xE000]
            text = "\x00\x00".join(a + c + b + "'s" for c in chars)
            found = bpe.pieces(text, compiled, unlike, characters)
            assert "".join(found) == text
    # where pieces end shows in tokens that only form inside a piece: two-byte ranks of the last letter and the quote
    own = dict(single)
    for c in sorted(characters):
        t = (c + "'").encode()
        for n in range(2, len(t) + 1):
            own.setdefault(t[:n], len(own))
    whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
    alone = tiktoken.Encoding("all", pat_str=r"[\s\S]+", mergeable_ranks=own, special_tokens={})
    for c in sorted(characters):
        for text in (c + "'s", "a" + c + "'s", "1" + c + "a", " " + c + c + "1 '", c + " " + c + "\n" + c, "." + c + "'"):
            assert whole.encode_ordinary(text) == [i for piece in bpe.pieces(text, compiled, unlike, characters) for i in alone.encode_ordinary(piece)], (hex(ord(c)), text)


def test_url_rules(spark):
    cases = [
        ("http://A.Example.com/en/1?x=/fr/", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("x://notexample.com/EN/", "notexample.com", "/EN/", "com/", "allow"),
        ("x://b.net/es/1#t", "b.net", "/es/1", "net/es/", "block"),
        ("x://b.net/de/casino", "b.net", "/de/casino", None, "block"),
        ("x://a.org?/en/", "a.org", "", None, "allow"),
        ("x://com", "com", "", None, "allow"),
        ("x://a.spam-site.org/p", "a.spam-site.org", "/p", None, "block"),
        ("nothing", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://a.org/" + "b/" * 5_000, "a.org", "/" + "b/" * 5_000, None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(cases)] + [(None, "x://a.org/", "h")], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    for i, (_, *want) in enumerate(cases):
        assert [got[i].host, got[i].path, got[i].rule, got[i].verdict] == want
    assert got[None].verdict == "allow" and urls.judged(pages.limit(0)).count() == 0


def test_automaton_against_regular_expressions():
    rng = np.random.default_rng(1)
    globs = ["".join(rng.choice(list("ab/") + ["*", "**"], 5)) for _ in range(60)]
    texts = ["".join(rng.choice(list("ab/"), rng.integers(0, 9))) for _ in range(300)]
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    got = urls.Automaton.of(globs).matches(flat, np.cumsum([0, *map(len, texts)]))
    for j, g in enumerate(globs):
        parts = re.split(r"(\*\*|\*)", g)
        pattern = re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else p for p in parts))
        assert got[:, j].tolist() == [bool(pattern.fullmatch(t)) for t in texts]


PAGES = [
    ("<nav>m</nav><article><h1>T</h1><p>a&amp;b  c<!-- x --><div class='comments'>no</div><p>two<script>if(a<b)'</article>'</script></article><footer>f</footer>", "T\na&b c\ntwo"),
    ("<main><form>q</form><p class=ad>buy<p>text</main>", "text"),
    ("", ""),
    (None, ""),
    ("<article><p>cut off", "cut off"),
    ("<article>" + "<p>word</p>" * 3_000 + "</article>", "\n".join(["word"] * 3_000)),
]


def test_pages_with_structure(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", p, 1) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<article>x</article>", 1)], "page_id long, url string, html string, text long")
    got = {r.page_id: r for r in html.extracted(pages).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert got[None].text == "x" and html.extracted(pages.limit(0)).count() == 0


def test_pages_by_host(spark):
    common = "this line stands on every page of the whole site"
    rows = [(i, f"http://h.org/{i}", f"<div>{common}</div><div>{' '.join(f"{i}{c}" for c in "abcdefgh")}</div>") for i in range(6)]
    rows += [(9, "http://other.org/", f"<div>{common}</div>"), (None, None, "<p>alone</p>")]
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == " ".join(f"{i}{c}" for c in "abcdefgh") for i in range(6))
    assert got[9] == common and got[None] == "alone"


def test_quality_counts_and_verdicts(spark):
    texts = passages(6) + ["# $ x", "a\na\n \n \na", "r s t " * 40]
    rows = {r.doc_id: r for r in quality.judged(odd_docs(spark, texts, "lone words")).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        grams = [tuple(w[j: j + 3]) for j in range(len(w) - 2)]
        again = {k for j, g in enumerate(grams) if grams.count(g) > 1 for k in (j, j + 1, j + 2)} if len(w) < 2_000 else None
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup)
        if again is not None:
            assert r.n_repeat_words == len(again)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert rows[None].n_words == 2 and quality.judged(odd_docs(spark, [])).count() == 0


def test_model_is_a_distribution():
    rng = np.random.default_rng(0)
    grams, counts = np.unique(rng.integers(0, 12, 4_000) + 32 * rng.integers(0, 5, 4_000) + 32**2 * rng.integers(0, 5, 4_000) + 32**3 * rng.integers(0, 4, 4_000), return_counts=True)
    sums = np.exp(quality.Model.of(grams, counts).table().reshape(-1, 32)).sum(axis=1)
    assert np.allclose(sums, 1, atol=2e-3)


def test_network_learns_and_counts_gradients():
    net = langid.Network.fresh(["a", "b"])
    rng = np.random.default_rng(0)
    spans = rng.integers(0, 256, (langid.SPAN, 6))
    inside = (np.arange(langid.SPAN)[:, None] < np.array([48, 5, 48, 30, 1, 48])).astype(np.float32)
    exact = langid.Network(net.langs, *(p.astype(np.float64) for p in net.parameters()))
    grads, _ = exact.gradients(spans, inside.astype(float), np.array([0, 1, 0, 1, 0, 1]))
    for p, g in zip(exact.parameters(), grads):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        losses = []
        for step in (1e-4, -2e-4):
            p[i] += step
            losses.append(exact.gradients(spans, inside.astype(float), np.array([0, 1, 0, 1, 0, 1]))[1])
        p[i] += 1e-4
        assert abs((losses[0] - losses[1]) / 2e-4 - g[i]) < 1e-5
    assert np.allclose(net.sums(spans, inside).T, np.einsum("tnl,tn->nl", net.probabilities(net.states(spans, inside)), inside), atol=1e-4)


def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    joined = langid.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in joined) >= 0.9 * len(joined) > 0 and all(0 <= r.score <= 1 for r in joined)
    odd = odd_docs(spark, [None, "", "12 34", "a"], "b")
    assert [r.lang_pred for r in sorted(langid.predicted(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id))][:3] == ["und"] * 3
    assert langid.predicted(odd.limit(0)).count() == 0
    assert langid.recognised(odd).columns == odd.columns and {r.text for r in langid.recognised(odd).collect()} == {"a", "b"}


ITEM = "in 1999 the old baker Anna sold 12 kg of bread to her friend Otto for 30 euros on a cold market day"


@pytest.mark.parametrize(("text", "kept"), [
    ("before words. " + ITEM + " after", False),
    (ITEM.lower(), False),
    (ITEM.upper(), False),
    (ITEM.replace("1999", "2004").replace("Anna", "Berta").replace("12", "7"), False),
    (ITEM.replace("12 kg", "7 g"), False),
    ("in 1999 the old baker Anna sold 12 kg", True),
    ("nothing of the kind is said here about any of these things at all today", True),
])
def test_leaks(spark, text, kept):
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (None, "short one here"), (3, ""), (4, None)], "item_id long, text string")
    got = decontaminate.judged(odd_docs(spark, [text, "", None], "x"), items).collect()
    assert {r.doc_id: r.kept for r in got} == {0: kept, 1: True, 2: True, None: True}
    assert [r.item_id for r in got if not r.kept] == ([] if kept else [1])


def test_slots_must_be_consistent(spark):
    item = "take 5 apples and 5 pears then add 5 plums and 8 figs to the large round basket"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [item.replace("5", "9"), item.replace("5 pears", "6 pears").replace("8", "9"), item.replace("8", "5")]
    got = {r.doc_id: r.kept for r in decontaminate.judged(odd_docs(spark, texts), items, run=16, literals=6).collect()}
    assert got == {0: False, 1: True, 2: True}
    assert decontaminate.clean(odd_docs(spark, texts), items.limit(0)).count() == 3


def test_exact_copies_with_few_literals(spark):
    items = spark.createDataFrame([(1, "What is 12 plus 7"), (2, "3 4 5 6 7 8 9 10 11 12 13 14 15 16")], "item_id long, text string")
    texts = ["so. What is 12 plus 7", "of 3 4 5 6 7 8 9 10 11 12 13 14 15 16 they", "What is 15 plus 8", " ".join(map(str, range(101, 115)))]
    got = {r.doc_id: (r.item_id, r.kept) for r in decontaminate.judged(odd_docs(spark, texts), items).collect()}
    assert got == {0: (1, False), 1: (2, False), 2: (None, True), 3: (None, True)}


TOM = "Tom has 5 red apples. Then Tom buys 3 more. Later his sister asks Tom for 2 of them. Tom agrees. How many are left?"


def test_consistent_part_of_a_run_and_names_at_sentence_starts(spark):
    item = "take 5 apples and 5 pears then add 5 plums and 8 figs to the large round basket that stands near the old door"
    items = spark.createDataFrame([(1, item), (2, TOM)], "item_id long, text string")
    texts = [item.replace("5 pears", "6 pears"), TOM.replace("Tom", "Anna"), "so: " + TOM, TOM.replace("Tom has", "Ina has").replace("Tom agrees", "Eva agrees")]
    got = {r.doc_id: (r.item_id, r.n_tokens) for r in decontaminate.judged(odd_docs(spark, texts), items).collect()}
    n = len(decontaminate.template(TOM)[1])
    assert got == {0: (1, 19), 1: (2, n), 2: (2, n), 3: (2, 18)}


def test_longest_consistent_ranges():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pairs = {int(p): (str(rng.integers(1, 5)), *(str(x) for x in rng.integers(0, 3, 2))) for p in rng.choice(12, 6, replace=False)}

        def fits(low, high):
            held = {("1" if k == "4" else k, d, b) for p, (k, d, b) in pairs.items() if low <= p < high}
            own = all(d == b for p, (k, d, b) in pairs.items() if low <= p < high and k == "4")
            return own and len(held) == len({(k, d) for k, d, _ in held}) == len({(k, b) for k, _, b in held})

        got = list(decontaminate.consistent(pairs, 0, 12))
        assert all(fits(*r) for r in got)
        assert max(b - a for a, b in got) == max(b - a for a in range(13) for b in range(a, 13) if fits(a, b))


def test_number_tables_and_empty_documents(spark):
    """Windows of placeholders alone meet by their values, so tables of other numbers do not."""
    items = spark.createDataFrame([(1, "in all 3 4 5 6 7 8 9 10 11 12 13 14 15 16 were counted that day by them"), (2, " ".join(map(str, range(50, 70))))], "item_id long, text string")
    numbers = " ".join(map(str, range(1_000, 3_000)))
    texts = [numbers, "x " + " ".join(map(str, range(50, 70))) + " y", "in all 3 4 5 6 7 8 9 10 11 12 13 14 15 16 were counted that day by them", "in all 3 4 5 6 were counted"]
    docs = odd_docs(spark, texts)
    got = {r.doc_id: (r.item_id, r.kept) for r in decontaminate.judged(docs, items).collect()}
    assert got == {0: (None, True), 1: (2, False), 2: (1, False), 3: (None, True)}
    rows = decontaminate._window_rows(decontaminate.keyed(docs.filter("doc_id = 0")), ["doc_key"], "text", decontaminate.WINDOW)
    assert rows.select("hash").distinct().count() == 2_000 - decontaminate.WINDOW + 1
    assert decontaminate.judged(odd_docs(spark, []), items).count() == 0 and decontaminate.clean(odd_docs(spark, []), items).count() == 0


def test_texts_worked_on_together_are_as_alone():
    """No window, sentence or name reaches from one text into the next."""
    texts = ["", TOM, "Tom", "apples. Tom has 5", "kg are many. Anna 12", "kg", ITEM, "", "so Anna. 7 mm\n", ""]
    views, tokens, owner = decontaminate.templates(texts)
    alone = [decontaminate.template(t) for t in texts]
    assert tokens == [x for _, some in alone for x in some] and owner.tolist() == [i for i, (_, some) in enumerate(alone) for _ in some]
    for v, (symbols, slots) in enumerate(views):
        assert symbols.tolist() == [x for some, _ in alone for x in some[v][0].tolist()]
        assert slots.tolist() == [x for some, _ in alone for x in some[v][1].tolist()]


LONG = " ".join(f"word{i}" for i in range(120))


@pytest.mark.parametrize(("page", "want"), [
    ("<article><section id='related-work'><h2>a</h2></section><div class='section-header'>b</div><div class='search-engines'>c</div><div id='navigation-by-stars'>d</div></article>", "a\nb\nc\nd"),
    ("<article><div class='entry-header'><h1>t</h1></div>x<div class='site-footer'>no</div><div id='cookie-notice'>no</div><div class='related-posts'>no</div><div class='post-comments'>no</div></article>", "t\nx"),
    ("<main><article>body</article><article class='comment'>nice post</article></main>", "body"),
    ("<article class='post'>body</article><article class='teaser related'>other</article>", "body"),
    ("<article>one<br>two<br/>three</article>", "one two three"),
    ("<article>body</article><p>short</p>", "body"),
    (f"<article class='card'>look here</article><div><p>{LONG}</p><p>{LONG}</p></div>", None),
    (f"<article>body</article><div><a href='/'>{LONG}</a><a href='/x'>{LONG}</a></div>", "body"),
])
def test_names_of_parts_and_mass_of_text(page, want):
    assert html._main_text(page) == want


def test_page_whose_text_is_outside_its_article(spark):
    page = f"<article class='card'>look here</article><div><p>{LONG}</p></div>"
    rows = html.extracted(spark.createDataFrame([(1, "http://a.org/", page), (1, "http://a.org/", page)], "page_id long, url string, html string")).collect()
    assert [r.text for r in rows] == [f"look here\n{LONG}"] * 2


@pytest.mark.parametrize(("page", "want"), [
    ("<article class='post has-sidebar'><p>text</article>", "text"),
    ("<main class='site-main no-sidebar'><p>text</main>", "text"),
    ("<article class='post comments-open category-ads tag-social'><p>text</article>", "text"),
    ("<article id=related><p>text<div class='comments'>no</div></article>", "text"),
    ("<div class='with-sidebar nav-open'><article><div class='elementor-widget elementor-widget-container'>text</div></article></div>", "text"),
    ("<section class='comments-closed'><article>text<div class='modal modal-open'>no</div><div class='widget-area'>no</div></article></section>", "text"),
    ("<div class='page sidebar'><article>no</article></div><article class=post>text<ul class='share-links'><li>no</ul></article>", "text"),
])
def test_layout_words_are_no_chrome(page, want):
    assert html._main_text(page) == want


def test_texts_of_other_letter_order_leave_the_band(spark):
    rng = np.random.default_rng(3)
    texts = []
    for script in ("abcdefghijklmnop", "абвгдежзийклмноп", "漢字仮名交文日本語学校生先大小中"):
        known = ["".join(rng.choice(list(script), 6)) for _ in range(40)]
        texts += [(script[0], " ".join(rng.choice(known, 150))) for _ in range(60)]
        shuffled = ["".join(rng.permutation(list(w))) for w in rng.choice(known, 150)]
        texts.append((script[0], " ".join(shuffled)))
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    gone = {r.doc_id for r in quality.judged(docs).collect() if not r.kept}
    assert {60, 121, 182} <= gone and len(gone) <= 8


def test_symbols_are_those_of_single_characters():
    import pyarrow as pa

    texts = ["aÉ é—z", None, "", "漢字 🙂х", "plain", "日"]
    symbols, offsets = quality.symbols_of(pa.array(texts))
    assert np.diff(offsets).tolist() == [len(t or "") for t in texts] and symbols.max() < 32
    alone = [quality.symbols_of(pa.array([c]))[0].tolist() for t in texts for c in t or ""]
    assert symbols.tolist() == sum(alone, []) and symbols[1] == symbols[3]


def test_notices_that_most_pages_of_a_host_hold_in_their_articles(spark):
    """Nothing marks them; a stretch that few pages share, a whole shared article and small hosts stay."""
    notice, quote = "sign up now to read all of our stories first", "these nine words stand in two articles and stay"
    own = lambda i: " ".join(f"{i}{c}" for c in "abcdefghij")
    article = lambda *parts: "<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"
    rows = [(i, f"http://h.org/{i}", article(own(i), notice, quote if i < 2 else "x", own(i + 100))) for i in range(9)]
    rows += [rows[0], (20, "http://h.org/20", article(notice)), (None, "http://h.org/21", article(notice, own(21)))]
    rows += [(i, f"http://small.org/{i}", article(own(i), notice)) for i in range(30, 34)]
    rows += [(i, f"http://one.org/{i % 2}", article(notice, own(40))) for i in (40, 40, 40, 40, 40, 40)]
    rows += [(i, f"http://half.org/{i}", article(own(i), notice if i < 55 else "y")) for i in range(50, 60)]
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()))
    want = [(i, "\n".join([own(i), quote if i < 2 else "x", own(i + 100)])) for i in [0, *range(9)]] + [(0, own(21)), (20, notice)]
    want += [(i, f"{own(i)}\n{notice}") for i in range(30, 34)] + [(40, f"{notice}\n{own(40)}")] * 6
    want += [(i, f"{own(i)}\n{notice if i < 55 else 'y'}") for i in range(50, 60)]
    assert got == sorted((i, t, len(t)) for i, t in want)
