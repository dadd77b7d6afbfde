"""HTML extraction (operator 8): the main text of pages.

Where a page says what its parts are, its structure comes first: blocks of an ``article`` (or ``main``) are text, and navigation,
headers, footers, forms, adverts, notices and comments inside or outside are not. Then the page's host decides over the blocks of
the article: one that is covered by a stretch which most pages of the host hold is a notice that nothing marks as such, and goes.
These stretches are found among the suffixes of the host's token streams that start where a block starts. Pages without such a part are decided by
their host: the token streams of all of a host's pages are taken together, and stretches of ``WINDOW`` or more tokens that
stand on distinct pages are boilerplate. That is the part of the host's suffix array where neighbours share that many
tokens; suffixes are therefore grouped by the hash of their first ``WINDOW`` tokens, added up before the shuffle, and no
task ever holds a host. What these stretches cover is removed, unique runs stay.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import repeats
from playlens.llm.rolling import U64, PrefixHash
from playlens.llm.stages import array_column, hash_bitmap, in_bitmap, key_columns, map_arrow, original_id, small_batches, table, write_stage
from playlens.llm.urls import host_and_path

WINDOW = 8
LEAST_PAGES = 5  # of a host, that hold a stretch of their articles which is no text

PIECES = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|([^<]+|<)""", re.S)
ATTRIBUTES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I | re.S)
#: Elements whose content is never text; the first four hold raw characters up to their end tag.
RAW = frozenset("script style textarea title".split())
CHROME = RAW | frozenset("nav header footer aside form noscript template svg math button select option iframe object canvas audio video head menu dialog".split())
MAIN = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that may hold chrome by class, id or role.
HINTED = frozenset("div section ul ol dl p span table article main figure details center".split())
_PART = (
    r"ads?|advert(?:s|ising|isements?)?|banners?|sponsor(?:s|ed)?|promos?|promotions?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|newsletters?|subscribe|subscriptions?|"
    r"share|sharing|social|sidebars?|widget[-_]?area|related|recommended|recommendations?|menus?|nav|navbar|navigation|breadcrumbs?|headers?|footers?|comments?|respond|reply|replies|"
    r"disqus|masthead|toolbars?|pagination|pager|skip[-_]?links?|contentinfo|complementary|search|dialog")
_BEFORE = r"site|page|main|global|top|bottom|left|right|primary|secondary|mobile|desktop|sticky|fixed|google|user|reader|widget"
_AFTER = (
    r"box|area|bar|container|wrapper|wrap|inner|list|block|section|widget|form|links?|buttons?|icons?|content|top|bottom|left|right|main|posts?|articles?|stories|items?|media|overlay|"
    r"body|text|thread|author|meta|\d+")
#: Whole names of parts: what a name only mentions (related-work, search-engines) or a state (has-sidebar, nav-open) says nothing.
HINT = re.compile(
    rf"(?:(?:{_BEFORE})[-_]+)*(?:{_PART})(?:[-_]+(?:{_AFTER}|{_PART}))*|(?:post|entry|article)[-_]+(?:comments?|footer|nav|navigation|share|sharing|related|tags)", re.I)
#: Classes of articles that are not the page's own.
FOREIGN = re.compile(r"comments?|reply|replies|respond|teasers?|ads?|advert(?:s|isements?)?|sponsored|promos?|related(?:[-_]+(?:posts?|articles?|stories|links?|items?))?", re.I)
MASS, TIMES = 500, 4  # an article counts for nothing beside so much text outside it, in characters that are no link, and so many times its own


def _is_chrome(name: str, attributes: str) -> bool:
    if name in CHROME:
        return True
    if name not in HINTED or not attributes:
        return False
    main = name in MAIN
    hint = FOREIGN if main else HINT
    return any(hint.fullmatch(w) for m in ATTRIBUTES.finditer(attributes) if not main or m[1].lower() == "class" for w in (m[2] or m[3] or m[4] or "").split())


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """(blocks of the article, all blocks, whether an article decides); chrome is in neither."""
    inside: list[str] = []
    every: list[str] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # container, whether chrome, whether article
    chrome = article = links = own = other = 0
    has_article = False

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                every.append(text)
                if article:
                    inside.append(text)

    at, size = 0, len(page)
    while at < size:
        m = PIECES.match(page, at)
        at = m.end()
        if m[4] is not None:
            if not chrome:
                held.append(m[4])
                if article:
                    own += len(m[4])
                elif not links:
                    other += len(m[4])
            continue
        if m[2] is None:
            continue
        name = m[2].lower()
        if name == "br":
            held.append(" ")
            continue
        if name not in INLINE:
            close()
        elif name not in HINTED:
            if name == "a":
                links = max(0, links - 1) if m[1] else links + 1
            continue
        if m[1]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    if not INLINE.issuperset((name,)) or open_[i][1]:
                        close()
                    for _, c, a in open_[i:]:
                        chrome -= c
                        article -= a
                    del open_[i:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = end.start() if end else size
            continue
        if name in VOID or m[3].rstrip().endswith("/") and name not in HINTED and name not in MAIN:
            continue
        if name not in INLINE and open_ and open_[-1][0] == "p":  # a block ends an open paragraph
            _, c, a = open_.pop()
            chrome -= c
        if name in CHROME or name in HINTED or name in MAIN:
            bad = _is_chrome(name, m[3])
            main = name in MAIN and not bad
            if bad and not chrome:
                close()
            if name in ("p", "span") and not bad and not chrome:
                continue
            open_.append((name, bad, main))
            chrome += bad
            article += main
            has_article |= main and not chrome
    close()
    return inside, every, has_article and not (other >= MASS and other > TIMES * own)


def _decided(page: str | None) -> tuple[str | None, str | None]:
    """The text of a page whose structure decides, or else its blocks, one a line, for the host to decide."""
    inside, every, by_article = blocks(page) if page else ([], [], False)
    return ("\n".join(inside), None) if by_article or not every else (None, "\n".join(every))


def _main_text(page: str | None) -> str | None:
    """Text of a page that has an article; None where the host has to decide."""
    return _decided(page)[0]


def extracted(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", window: int = WINDOW) -> DataFrame:
    """One row per page: the id, url, text, n_chars (code points).

    Character references are decoded, white space and line breaks inside a block become one space, blocks are joined by a line break.
    A null or empty page has an empty text. Rows are pages of their own, also where ids repeat or are null; a page repeated
    under one id is one page for the question whether a stretch stands on distinct pages. An article beside which
    far more text stands outside than in it is a teaser: then the host decides over all blocks. A block of an article goes where
    more than half of the host's pages (``LEAST_PAGES`` at least) hold it, unless that is all of the article.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, open_ = zip(*(_decided(x.as_py()) for x in batch.column("html"))) if batch.num_rows else ((), ())
            yield table(page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(texts, pa.string()), blocks=pa.array(open_, pa.string()))

    # every page is parsed once
    parsed = write_stage(map_arrow(rows, parse, "page_id long, url string, text string, blocks string"), "html-parsed")
    by_structure = _without_notices(parsed.filter("blocks IS NULL").select("page_id", "url", "text"), window).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    rest = parsed.filter("blocks IS NOT NULL").select("page_id", "url", "blocks")
    out = by_structure.unionByName(_by_host(rest, window, "page_id long, url string, text string, n_chars long"))
    return out.select(F.col("page_id").alias(id_column), F.col("url").alias(url), "text", "n_chars")


def _tokens(page: str) -> list[list[str]]:
    return [b.split(" ") for b in page.split("\n")]


def _block_grams(text: str, window: int, host: int) -> list[int | None]:
    """Of each block the hash of the stretch that starts with it: the whole block, and ``window`` tokens at least (else None)."""
    blocks = _tokens(text)
    tokens, at, out = [t for b in blocks for t in b], 0, []
    for block in blocks:
        stretch = tokens[at: at + max(window, len(block))]
        out.append(xxhash.xxh3_64_intdigest(" ".join(stretch), seed=host) if len(stretch) >= window else None)
        at += len(block)
    return out


def _without_notices(pages: DataFrame, window: int) -> DataFrame:
    """(page_id, url, text) of pages with an article, without the blocks that most pages of their host hold."""
    host, _ = host_and_path("url")
    key, rid = key_columns(pages, "page_id", "text")
    rows = pages.select(key.alias("doc_key"), rid.alias("rid"), "url", "text", F.xxhash64(F.coalesce(host, F.lit(""))).alias("host"))
    page = ["doc_key", "rid"]

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, rid, hosts = (array_column(batch, c) for c in ("doc_key", "rid", "host"))
            at, grams, places = [], [], []
            for i, text in enumerate(batch.column("text")):
                for place, gram in enumerate(_block_grams(text.as_py() or "", window, int(hosts[i]) % (1 << 64))):
                    if gram is not None:
                        at.append(i)
                        grams.append(gram)
                        places.append(place)
            yield table(host=hosts[at], gram=np.array(grams, U64).view(np.int64), doc_key=doc[at], rid=rid[at], place=np.array(places, np.int32))

    shape = "host long, gram long, doc_key long, rid long, place int"
    held = map_arrow(rows.select(*page, "host", "text"), starts, shape).groupBy("host", "gram").agg(F.countDistinct(*page).alias("n")).filter(F.col("n") >= LEAST_PAGES)
    sizes = rows.groupBy("host").agg(F.countDistinct(*page).alias("pages"))
    common = write_stage(held.join(sizes, "host").filter(2 * F.col("n") > F.col("pages")).select("host", "gram"), "html-notices")
    if not common.limit(1).count():
        return pages
    bitmap = hash_bitmap(common, "gram")  # keeps pages without such blocks out of the join

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [[g for g in _block_grams(text.as_py() or "", window, h % (1 << 64)) if g is not None] for text, h in zip(batch.column("text"), batch.column("host").to_pylist())]
            likely = [bool(len(g)) and bool(in_bitmap(np.array(g, U64), bitmap.value).any()) for g in grams]
            yield table(**{c: batch.column(c) for c in (*page, "url", "text", "host")}, likely=pa.array(likely, pa.bool_()))

    every = map_arrow(rows.select(*page, "url", "text", "host"), marked, "doc_key long, rid long, url string, text string, host long, likely boolean")
    likely = every.filter("likely")
    gone = map_arrow(likely.select(*page, "host", "text"), starts, shape).join(common, ["host", "gram"]).groupBy(*page).agg(F.collect_set("place").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                left = [b for i, b in enumerate(text.split("\n")) if i not in set(places or ())]
                texts.append("\n".join(left) or text)
            yield table(doc_key=batch.column("doc_key"), url=batch.column("url"), text=pa.array(texts, pa.string()))

    some = map_arrow(likely.join(gone, page, "left").select("doc_key", "url", "text", "gone"), cut, "doc_key long, url string, text string")
    out = some.unionByName(every.filter("not likely").select("doc_key", "url", "text"))
    return out.select(original_id("doc_key").alias("page_id"), "url", "text")


def _by_host(pages: DataFrame, window: int, shape: str) -> DataFrame:
    """Pages without an article: tokens outside stretches that other pages of their host hold too."""
    host, _ = host_and_path("url")
    key, rid = key_columns(pages, "page_id", "blocks")
    rows = pages.select(key.alias("doc_key"), rid.alias("rid"), "url", "blocks")
    hosted = rows.withColumn("host", F.xxhash64(F.coalesce(host, F.lit(""))))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, rid, hosts = (array_column(batch, c) for c in ("doc_key", "rid", "host"))
            for i, page in enumerate(batch.column("blocks")):
                tokens = [t for b in _tokens(page.as_py() or "") for t in b]
                n = len(tokens) - window + 1
                if n > 0:
                    grams = PrefixHash(np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), U64, len(tokens))).grams(window)
                    yield table(host=np.full(n, hosts[i]), gram=grams.view(np.int64), doc_key=np.full(n, doc[i]), rid=np.full(n, rid[i]), start=np.arange(n, dtype=np.int32))

    found = map_arrow(hosted, suffixes, "host long, gram long, doc_key long, rid long, start int")
    page = F.struct("doc_key", "rid")
    shared = found.groupBy("host", "gram").agg(F.min(page).alias("a"), F.max(page).alias("b")).filter(F.col("a") != F.col("b")).select("host", "gram")
    covered = repeats.per_document(found.join(shared, ["host", "gram"]).withColumn("end", (F.col("start") + window).cast("int")), ["start", "end"], "ranges")

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, ranges in zip(batch.column("blocks"), batch.column("ranges").to_pylist()):
                lines = _tokens(page.as_py() or "")
                gone = repeats.covered(ranges, sum(map(len, lines))).tolist()
                kept, at = [], 0
                for line in lines:
                    left = [t for t, g in zip(line, gone[at: at + len(line)]) if not g]
                    at += len(line)
                    if left:
                        kept.append(" ".join(left))
                texts.append("\n".join(kept))
            yield table(page_id=batch.column("doc_key"), url=batch.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array(list(map(len, texts)), pa.int64()))

    out = map_arrow(rows.join(covered, ["doc_key", "rid"], "left"), unique, shape)
    return out.withColumn("page_id", original_id("page_id"))
