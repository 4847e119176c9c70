"""HTML main text by equivalence-class template deduction.

Pages of one host and one layout (the outermost containers they hold) share a template.
Each page gives tokens: its elements and its pieces of text, told apart by the path of
tags that holds them; containers of one kind in one parent are numbered, so that each is
a token of its own. A token's occurrence vector has, for each page of the layout, how
often it occurs there. Tokens with one vector are an equivalence class. A class is valid
if it is large and frequent enough, its tokens keep one order on all pages, and it nests:
on all pages it lies in one gap between two tokens of the class that occurs once on every
page, the frame. Frame and valid classes make the template; the text among its tokens is
the template's, not a page's, and its containers hold the slots.

A vector is never built: sums over pages of the count times two 31-bit hashes of the page
stand for it, so a host with a third of all pages costs partial sums only.

The main slot is chosen by the template: of the containers that every page of the layout
has once, the innermost one that holds at least two thirds of the layout's text (outside
links, summed over pages, so a page with a short article goes by its fellows; a layout of
one or two pages proves nothing and keeps the whole body). Names are a tie-break and take
things away: an ``article`` or main part needs a third of the text and one page only; menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments, by the
tag, role, class or id of what holds them, are no text at all. What the main slot holds is
the page's text, in page order, but for the template's text (if nothing else is in the
slot, the pages are copies of one another and it stays). Where the main slot is the whole
body, blocks that are mostly links go too.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import pieces, stored, texts_of, with_few

#: A class makes a template if it has so many tokens, in a layout of so many pages.
LEAST_TOKENS, LEAST_PAGES = 2, 3
#: Containers up to this depth tell a host's layouts apart (html, body and what body holds).
LAYOUT_DEPTH = 3
#: A template of at most this many bytes in all is broadcast.
SMALL_BYTES = 8 << 20
#: The token of a whole page, and kinds of tokens; a container's kind is the largest ones.
WHOLE = 0
OTHER, TEXT, CONTAINER, MAIN, OUTER = range(5)

# quotes count after an equals sign only, and an unpaired one is a letter: no rescans
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+)>|<[!?/][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[a-z]+|[0-9]+")

# Kinds of elements in HTML, and usual names of what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt
ruby s samp small span strike strong sub sup time tt u var wbr""".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
DROPPED = frozenset("""script style xmp iframe noembed noframes textarea title head nav header footer aside form noscript
template button select option datalist svg object embed canvas dialog menu audio video map""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside ad ads
advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
popup modal newsletter subscribe subscription signup login share sharing social related recommended comment comments respond
disqus reply replies pagination pager widget toolbar""".split())
FRAMES = frozenset("html body main article".split())
TEXT_LEVEL = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figure figcaption address math".split())
#: Names that inside an article or main part are the article's own.
OWN_NAMES = frozenset(["header", "masthead", "banner"])


@dataclass
class Page:
    """What parsing gives."""

    #: text, its token, and whether it is mostly links, in page order
    blocks: list[tuple[str, int, bool]] = field(default_factory=list)
    #: (token, kind) of all elements and blocks, in page order
    tokens: list[tuple[int, int]] = field(default_factory=list)
    #: containers: token to [kind, depth, first block, block behind the last]
    spans: dict[int, list[int]] = field(default_factory=dict)
    #: characters outside links of the first blocks: none, one, two and so on
    chars: list[int] = field(default_factory=lambda: [0])

    def layout(self, host: str) -> int | None:
        """The number of the host's layout that the page has (null if it has no token)."""
        outermost = sorted(t for t, (_, depth, _, _) in self.spans.items() if 0 < depth <= LAYOUT_DEPTH)
        return _hash(f"{host}\n{outermost}") if self.tokens else None


def _hash(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) - (1 << 63)


def _drops(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element and all in it is none of the article."""
    if name == "header" and inside:
        return False
    if name in DROPPED:
        return True
    if not attributes or name in FRAMES:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "role" and value in ROLES or key == "aria-hidden" and value == "true":
            return True
        if key in ("class", "id") and not (NAMES - OWN_NAMES if inside else NAMES).isdisjoint(NAME_PART.findall(value)):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def parse(source: str) -> Page:
    """Blocks, tokens and containers of a page, in one pass: each tag is opened and closed once."""
    page = Page()
    stack: list[tuple[str, int, Counter]] = []  # name, token and numbered children of open elements
    opened: Counter = Counter()
    drop_at: list[int] = []
    block: list[str] = []
    linked = 0
    tops: Counter = Counter()

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(block).split())
        if text:
            token = _hash(f"{stack[-1][1] if stack else WHOLE}\n{text}")
            page.blocks.append((text, token, linked * 2 > len(text)))
            page.tokens.append((token, TEXT))
            page.chars.append(page.chars[-1] + max(0, len(text) - linked))
        block.clear()
        linked = 0

    def close(to: int) -> None:
        while len(stack) > to:
            name, token, _ = stack.pop()
            opened[name] -= 1
            if token in page.spans:
                page.spans[token][3] = len(page.blocks)
            if drop_at and drop_at[-1] == len(stack):
                drop_at.pop()

    at, end, last = 0, len(source), source.rfind(">")
    while at < end:
        m = TAG.search(source, at) if at <= last else None  # no tag ends beyond the last >
        text = source[at:m.start() if m else end]
        if text and not drop_at:
            text = html.unescape(text)
            block.append(text)
            if opened["a"] > 0:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE and not drop_at:
            if name == "br":
                block.append(" ")
            else:
                end_block()
        if m[1]:
            if opened[name] > 0:
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                close(i)
            continue
        attributes = m[3] or ""
        if name in VOID or attributes.endswith("/") and name in ("svg", "path", "use"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            close(len(stack) - 1)
        if name in RAW:
            at = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(source, at).end()
            continue
        inside = opened["article"] > 0 or opened["main"] > 0
        if not drop_at and _drops(name, attributes, inside):
            drop_at.append(len(stack))
        kind = name
        if attributes and not drop_at:
            own = dict((k.lower(), "".join(v)) for k, *v in ATTRIBUTE.findall(attributes))
            kind = ".".join([name, *own.get("class", "").split()])
            if own.get("role", "").lower() == "main":
                name = "main"
        if name not in TEXT_LEVEL:
            siblings = stack[-1][2] if stack else tops
            siblings[kind] += 1
            kind = f"{kind}[{siblings[kind]}]"
        token = _hash(f"{stack[-1][1] if stack else WHOLE}/{kind}")  # short, however deep
        stack.append((name, token, Counter()))
        opened[name] += 1
        if name in INLINE:
            continue
        what = OTHER if name in TEXT_LEVEL else MAIN if name in ("article", "main") else OUTER if name in ("html", "body") else CONTAINER
        page.tokens.append((token, what))
        if what != OTHER and token not in page.spans:
            page.spans[token] = [what, len(stack), len(page.blocks), len(page.blocks)]
    end_block()
    close(0)
    if page.tokens:
        page.tokens.insert(0, (WHOLE, OUTER))
        page.spans[WHOLE] = [OUTER, 0, 0, len(page.blocks)]
    return page


TOKENS = "layout bigint, page bigint, token bigint, what int, depth int, n int, first int, last int, chars bigint"


def _tokens(pages: DataFrame) -> DataFrame:
    """A row for each token of each page: its kind, count, first and last place, and the
    characters that a container holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in TOKENS.split(", ")]
        kinds = [pa.int64() if "bigint" in c else pa.int32() for c in TOKENS.split(", ")]
        for batch in pieces(batches, "html"):
            rows: list[tuple] = []
            for host, number, source in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), texts_of(batch, "html")):
                page = parse(source)
                layout, seen = page.layout(host), {}
                for place, (token, what) in enumerate(page.tokens):
                    held = seen.setdefault(token, [what, 0, place, place])
                    held[1] += 1
                    held[3] = place
                for token, (what, n, first, last) in seen.items():
                    _, depth, lo, hi = page.spans.get(token, (0, 0, 0, 0))
                    rows.append((layout, number, token, what, depth, n, first, last, page.chars[hi] - page.chars[lo]))
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pages.select("host", "page", "html").mapInArrow(run, TOKENS)


def templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """A row for each ``layout``: its main ``region``'s token, whether that is ``outer`` (the whole
    body), and ``texts``, the tokens of its template's texts.

    ``pages`` has ``host``, a 64-bit name ``page``, and ``html``; pages without a token
    belong to no layout, and repeated rows of a page count alike in all its tokens."""
    tokens = stored(spark, _tokens(pages), "html-tokens")
    hash_of = lambda seed: F.pmod(F.xxhash64("page", F.lit(seed)), F.lit((1 << 31) - 1))
    layouts = stored(spark, tokens.where(F.col("token") == WHOLE).groupBy("layout")
                     .agg(F.count("*").alias("pages"), F.sum("chars").alias("all_chars")), "html-layouts")
    vectors = tokens.groupBy("layout", "token").agg(
        F.max("what").alias("what"), F.max("depth").alias("depth"), F.count("*").alias("support"), F.sum("n").alias("total"),
        F.sum("chars").alias("chars"), F.sum(F.col("n") * hash_of(1)).alias("v1"), F.sum(F.col("n") * hash_of(2)).alias("v2"))
    common = with_few(vectors, layouts, "layout").where(
        (F.col("support") == F.col("pages")) & ((F.col("what") >= CONTAINER) | (F.col("pages") >= LEAST_PAGES)))
    common = stored(spark, common.withColumn("frame", F.col("total") == F.col("pages")), "html-common")

    main, share = F.col("what") == MAIN, F.when(F.col("what") == MAIN, 1).otherwise(2)
    known = (F.col("what") != CONTAINER) | (F.col("pages") >= LEAST_PAGES)
    regions = common.where(F.col("frame") & (F.col("what") >= CONTAINER) & known & (3 * F.col("chars") >= share * F.col("all_chars"))) \
        .groupBy("layout").agg(F.min_by(F.struct("token", (F.col("what") == OUTER).alias("outer")), F.struct(
            ~main, F.when(main, -F.col("chars")).otherwise(0), F.when(main, F.col("depth")).otherwise(-F.col("depth")), "token")).alias("r"))

    common = common.where(F.col("pages") >= LEAST_PAGES)
    large = common.groupBy("layout", "v1", "v2").agg(F.count("*").alias("k")).where(F.col("k") >= LEAST_TOKENS)
    classes = stored(spark, common.join(large, ["layout", "v1", "v2"]).select("layout", "token", "what", "v1", "v2", "frame"), "html-classes")
    # on each page: each class's extent and the order of its tokens
    placed = with_few(tokens.select("layout", "page", "token", "first", "last"), classes, ["layout", "token"])
    on_page = stored(spark, placed.groupBy("layout", "page", "v1", "v2", "frame").agg(
        F.min("first").alias("lo"), F.max("last").alias("hi"), F.sort_array(F.collect_set(F.struct("first", "token"))).alias("held")), "html-placed")
    frames = on_page.where("frame").select("layout", "page", F.col("held.first").alias("marks"))
    before = lambda at: F.size(F.filter("marks", lambda m: m < at))
    gaps = on_page.join(frames, ["layout", "page"], "left").select(
        "layout", "v1", "v2", "frame", F.xxhash64("held.token").alias("order"), before(F.col("lo")).alias("gap"), before(F.col("hi")).alias("gap_hi"))
    steady = lambda c: F.min(c) == F.max(c)
    valid = gaps.groupBy("layout", "v1", "v2", "frame").agg(steady("order").alias("ordered"), (F.max("gap_hi") == F.min("gap")).alias("nested")) \
        .where(F.col("ordered") & (F.col("frame") | F.col("nested"))).select("layout", "v1", "v2")
    texts = classes.join(valid, ["layout", "v1", "v2"]).where(F.col("what") == TEXT).groupBy("layout").agg(F.collect_set("token").alias("texts"))
    return regions.join(texts, "layout", "left").select(
        "layout", F.col("r.token").alias("region"), F.col("r.outer").alias("outer"), F.coalesce("texts", F.array().cast("array<bigint>")).alias("texts"))


PARSED = """page_id bigint, url string, layout bigint, blocks array<struct<text: string, token: bigint, links: boolean>>,
spans array<struct<token: bigint, lo: int, hi: int>>"""
BLOCK = pa.list_(pa.struct([("text", pa.string()), ("token", pa.int64()), ("links", pa.bool_())]))
SPAN = pa.list_(pa.struct([("token", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        layouts, blocks, spans = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), texts_of(batch, "html")):
            page = parse(source)
            layouts.append(page.layout(host))
            blocks.append([{"text": text, "token": token, "links": links} for text, token, links in page.blocks])
            spans.append([{"token": token, "lo": lo, "hi": hi} for token, (_, _, lo, hi) in page.spans.items()])
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(layouts, pa.int64()),
                                          pa.array(blocks, BLOCK), pa.array(spans, SPAN)], ["page_id", "url", "layout", "blocks", "spans"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row.

    Character references are decoded, white space inside a block is one space, blocks are
    joined in page order by one space. A null html is empty, and takes no part in its host's
    template; a null or hostless url belongs to the host of no name; repeated rows give a row
    each and change no template; other columns are ignored.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"(?i)^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    found = stored(spark, templates(spark, rows.withColumn("page", F.xxhash64("page_id", "url", "html"))), "html-templates")
    size = found.agg(F.sum(24 + 8 * F.size("texts"))).first()[0] or 0
    both = rows.mapInArrow(_parsed, PARSED).join(F.broadcast(found) if size <= SMALL_BYTES else found, "layout", "left")
    span = F.get(F.filter("spans", lambda s: s.token == F.col("region")), 0)
    held = F.filter(F.slice("blocks", span.lo + 1, span.hi - span.lo), lambda b: ~(F.col("outer") & b.links))
    own = F.filter(held, lambda b: ~F.array_contains("texts", b.token))
    kept = F.when(F.size(own) > 0, own).otherwise(held)
    return both.select("page_id", "url", F.coalesce(F.array_join(kept.text, " "), F.lit("")).alias("text"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
