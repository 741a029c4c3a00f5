"""Main text of web pages by equivalence-class template deduction.

Tokens are the start tags of a page, told apart by their path of tags and class names, and its text
nodes, told apart by the block element that holds them and their words. Over the distinct pages of one
host every token has an occurrence vector, its count on each page; tokens with equal vectors form an
equivalence class. A class is valid if it is large (LARGE tokens) and frequent (FREQUENT pages). The
valid classes nest into the host's template: a class lies in a slot of the class that holds the nearest
enclosing tag of a valid class; the tags that occur once on nearly every page are the template's root.

A slot holds data if its text varies. A block element of a valid class whose texts are all template
text themselves (each belongs to a valid class) is fixed: labels, adverts and notices, be they repeated
on a page or found on some pages only. The main slot is the smallest root element that holds most of the
host's text that is not links, one of the semantic ones (article, main) before others. Extraction reads the main slot and leaves out fixed blocks, headings
apart, and furniture (menus, sidebars, adverts, notices, forms, scripts, reader comments and the like).

Vectors are compared by sums of hashes, so hosts of any size are deduced by aggregates over (host,
token); no task holds the pages of a host.

Defined results: a null or empty page has the empty text; a page whose host is null, that lacks the
host's main element, or that is the only distinct page of its host is judged by itself, by its article
or main elements if it has any; the template never empties a page's main slot: if nothing else is left,
fixed blocks stay; of equally good main elements the deepest, then the one of most text, then the one of
the largest hash is taken; identical pages count once in a vector and have equal texts, repeated rows each get a
row; a line break element is white space; table cells are parted by a space, rows are blocks; a very long
page is one value, read in one pass; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import HOT, join_hot, materialize

ROOT = 0.9  # share of a host's pages on which a tag of the root occurs
LARGE = 2  # tokens that a valid class has at least
FREQUENT = 3  # pages that a valid class is found on at least; all of them on a host of fewer
MOST = 0.6  # share of the unlinked text that the main element holds at least
SALTS = 64  # parts that the pages of a hot host are dealt into

# Element names by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noframes".split())
DROPPED = RAW | frozenset("head nav aside footer form button select svg template dialog menu object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - {"html", "body", "tbody", "tfoot", "thead", "tr", "dialog"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ()}
SCOPE = frozenset("ul ol dl table select article section main aside nav body".split())
CONTAINERS = frozenset("html body div section center table tbody tr td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header menu modal nav navbar "
    "navigation newsletter notice notices overlay pagination popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_NAME = re.compile(r"[A-Za-z]+")


@dataclass(slots=True)
class Node:
    """An open element: its name, path token, and how its text is read."""

    name: str
    token: int
    parent: int
    dropped: bool
    header: bool
    semantic: bool


@dataclass
class Page:
    """What one pass over a page finds: start tags and text nodes in order."""

    tags: list[tuple[int, int, bool, str]] = field(default_factory=list)  # token, parent, semantic, name
    texts: list[tuple[str, tuple[int, ...], bool, bool, int]] = field(default_factory=list)  # text, open tokens, dropped, linked, its block's token (0 in a heading)
    breaks: list[int] = field(default_factory=list)  # text index at which a block starts


def _hash(*parts) -> int:
    return int.from_bytes(xxhash.xxh64_digest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")), "big", signed=True)


def _looks(attrs: str) -> tuple[str, bool]:
    """(class name words for the path, whether they name furniture)."""
    words, bad = [], "hidden" in attrs and bool(_HIDDEN.search(_QUOTED.sub("", attrs)))
    for m in _ATTR.finditer(attrs):
        names = [w.lower() for w in _NAME.findall(m[2] or m[3] or m[4] or "")]
        if m[1].lower() == "role":
            bad |= bool(ROLES & set(names))
        else:
            bad |= bool(FURNITURE & set(names))
            words += sorted(names)
    return " ".join(words), bad


def read(page: str) -> Page:
    """Tags and text nodes of a page, with unclosed and misnested elements closed as browsers do."""
    out = Page()
    stack: list[Node] = []
    tokens: tuple[int, ...] = ()
    cache: dict[tuple, tuple] = {}

    def text(lo: int, hi: int) -> None:
        if lo < hi:
            raw = page[lo:hi]
            top = stack[-1] if stack else None
            dropped = top is not None and top.dropped or (top is not None and any(n.header for n in stack) and not any(n.name in HEADINGS for n in stack))
            block = next((n for n in reversed(stack) if n.name in BLOCKS), None)
            out.texts.append((raw, tokens, dropped, any(n.name == "a" for n in stack), 0 if block is None or block.name in HEADINGS else block.token))

    def close(index: int) -> None:
        nonlocal tokens
        if any(n.name in BLOCKS for n in stack[index:]):
            out.breaks.append(len(out.texts))
        del stack[index:]
        tokens = tokens[:index]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(at, end)
            break
        text(at, m.start())
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    close(i)
                    break
            else:
                if name in BLOCKS:
                    out.breaks.append(len(out.texts))
            continue
        if name == "br" or name in ("td", "th"):
            out.texts.append((" ", tokens, False, False, 0))
        if name in BLOCKS:
            out.breaks.append(len(out.texts))
        if name in CLOSES_P or name in SAME:
            same = SAME.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == "p" and name in CLOSES_P or stack[i].name in same:
                    close(i)
                    break
                if stack[i].name in SCOPE:
                    break
        attrs = m[3] or m[6] or ""
        parent = stack[-1].token if stack else 0
        key = (parent, name, attrs)
        known = cache.get(key)
        if known is None:
            words, bad = _looks(attrs)
            known = cache[key] = (_hash(parent, name, words), bad)
        token, bad = known
        up = stack[-1] if stack else None
        semantic = name in ("article", "main") and not bad
        head = name == "header" or (bad and re.search(r"\bheader\b", attrs, re.I) is not None)
        inside = up is not None and any(n.semantic for n in stack)
        dropped = (up is not None and up.dropped) or name in DROPPED or (bad and not (head and inside)) or (head and not inside)
        out.tags.append((token, parent, semantic and not dropped, name))
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}", re.I).search(page, at)
            at = stop.start() if stop else end
        stack.append(Node(name, token, parent, dropped, head and inside, semantic and not dropped))
        tokens = (*tokens, token)
    return out


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def main_text(page: str | None, main: int | None = None, fixed: frozenset[int] = frozenset()) -> str:
    """The article of a page: the text of its main slot without furniture and the template's fixed blocks."""
    if not page:
        return ""
    p = read(page)
    wanted = main
    if wanted is None or all(t != wanted for t, _, _, _ in p.tags):
        wanted, fixed = None, frozenset()
        semantic = [t for t, _, s, _ in p.tags if s]
        if semantic:
            held = {t: sum(len(x[0]) for x in p.texts if t in x[1] and not x[2]) for t in semantic}
            wanted = max(semantic, key=lambda t: held[t])
    return _text(p, wanted, fixed) or _text(p, wanted, frozenset())


def _text(p: Page, wanted: int | None, fixed: frozenset[int]) -> str:
    blocks: list[str] = []
    cuts, part = set(p.breaks), []

    def flush():
        text = _clean("".join(part))
        if text:
            blocks.append(text)
        part.clear()

    for i, (raw, tokens, dropped, _, block) in enumerate(p.texts):
        if i in cuts:
            flush()
        if not dropped and block not in fixed and (wanted is None or wanted in tokens):
            part.append(raw)
    flush()
    return "\n".join(blocks)


def profile(page: str | None) -> dict[int, list[int]]:
    """token -> [count, parent, kind, chars, linked chars, depth]; kind 0 tag, 1 semantic tag, 2 text, whose parent is its block, 3 other container."""
    out: dict[int, list[int]] = {}
    if not page:
        return out
    p = read(page)
    depth: dict[int, int] = {0: 0}
    for token, parent, semantic, name in p.tags:
        depth[token] = depth.get(parent, 0) + 1
        if token in out:
            out[token][0] += 1
        else:
            out[token] = [1, parent, 1 if semantic else 3 if name in CONTAINERS else 0, 0, 0, depth[token]]
    for raw, tokens, dropped, linked, block in p.texts:
        size = len(raw.strip())
        if not size or dropped:
            continue
        for t in tokens:
            out[t][3] += size
            out[t][4] += size * linked
        if block:
            token = _hash("text", block, _clean(raw))
            if token in out:
                out[token][0] += 1
            else:
                out[token] = [1, block, 2, 0, 0, 0]
    return out


def host_of(url: str = "url"):
    """Host of a URL in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def template(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, token, parent, kind, class_id, up_class, valid, root, pages, chars, linked, depth) of hosts of several distinct pages.

    up_class is the class in whose slot the token's class lies: that of the nearest enclosing tag of a valid
    class, or 0 for the page itself.
    """
    html_text = F.col(html_col).cast("string")
    src = pages.select(host_of(url_col).alias("host"), F.xxhash64(html_text).alias("page"), html_text.alias("html")).filter("host IS NOT NULL")

    def run(batches):
        for b in batches:
            toks = [[[k, *v] for k, v in profile(x.as_py()).items()] for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(toks, pa.list_(pa.list_(pa.int64())))], names=["host", "page", "toks"])

    each = src.mapInArrow(run, "host string, page bigint, toks array<array<bigint>>").dropDuplicates(["host", "page"])
    # Token 0 stands for the page itself, so its count is the host's number of distinct pages.
    rows = each.select("host", "page", F.explode(F.concat("toks", F.array(F.array(*[F.lit(x).cast("bigint") for x in (0, 1, 0, 3, 0, 0, 0)])))).alias("t"))
    t, mark = F.col("t"), F.xxhash64("page", F.col("t")[1])
    tokens = rows.groupBy("host", t[0].alias("token")).agg(
        F.count("*").alias("pages"), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("v1"), F.sum(F.shiftrightunsigned(mark, 32)).alias("v2"), F.max(t[1]).alias("most"),
        F.min(t[2]).alias("parent"), F.max(t[3]).alias("kind"), F.sum(t[4]).alias("chars"), F.sum(t[5]).alias("linked"), F.min(t[6]).alias("depth"),
    )
    tokens = materialize(tokens, "html-tokens")
    hosts = tokens.groupBy("host").agg(F.max(F.when(F.col("token") == 0, F.col("pages"))).alias("host_pages"), F.count("*").alias("n"))
    # A host may hold a great share of all tokens; its rows are not dealt to one task.
    known = join_hot(tokens.filter("token <> 0"), materialize(hosts, "html-sizes"), ["host"], "n").filter("host_pages > 1")
    vector = ["host", "pages", "v1", "v2"]
    classes = known.groupBy(*vector).agg(F.count("*").alias("class_size"), F.min("token").alias("class_id"))
    valid = (F.col("class_size") >= LARGE) & (F.col("pages") >= F.least(F.lit(FREQUENT), F.col("host_pages")))
    root = valid & (F.col("most") == 1) & (F.col("pages") >= ROOT * F.col("host_pages")) & (F.col("kind") != 2)
    out = known.join(classes, vector).select("host", "token", "parent", "kind", "class_id", valid.alias("valid"), root.alias("root"), "pages", "chars", "linked", "depth")
    out = materialize(out, "html-classes")
    return out.join(_nested(out), ["host", "token"], "left").withColumn("up_class", F.coalesce("up_class", F.lit(0).cast("bigint")))


def _nested(tokens: DataFrame) -> DataFrame:
    """(host, token, up_class) for tokens inside a valid class; pointers over tags of no valid class are doubled until none is left."""
    tags = tokens.filter("kind <> 2")
    up = tokens.select("host", "token", F.col("parent").alias("up"))
    skip = tags.filter("NOT valid").select("host", F.col("token").alias("up"), F.col("parent").alias("next"))
    while not (stuck := up.join(skip, ["host", "up"])).isEmpty():
        up = materialize(stuck.select("host", "token", F.col("next").alias("up")).unionByName(up.join(skip, ["host", "up"], "left_anti")), "html-nested")
        beyond = skip.select("host", F.col("up").alias("next"), F.col("next").alias("beyond"))
        skip = materialize(skip.join(beyond, ["host", "next"], "left").select("host", "up", F.coalesce("beyond", "next").alias("next")), "html-skipped")
    named = tags.filter("valid").select("host", F.col("token").alias("up"), F.col("class_id").alias("up_class"))
    return up.join(named, ["host", "up"]).select("host", "token", "up_class")


def main_slots(known: DataFrame) -> DataFrame:
    """(host, main, fixed): the tag of each host's main slot, and its block elements whose text never varies."""
    tags = known.filter("root AND kind IN (1, 3)")
    plain = F.col("chars") - 2 * F.col("linked")
    top = tags.groupBy("host").agg(F.max(plain).alias("top"))
    good = tags.join(top, "host").filter(plain >= MOST * F.col("top"))
    main = good.groupBy("host").agg(F.max(F.struct((F.col("kind") == 1).alias("a"), "depth", plain.alias("b"), "token")).alias("m")).select("host", F.col("m.token").alias("main"))
    texts = known.filter("kind = 2").groupBy("host", F.col("parent").alias("token")).agg(F.bool_and("valid").alias("same"))
    fixed = known.filter("valid AND kind <> 2").join(texts.filter("same"), ["host", "token"])
    fixed = fixed.groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("fixed"))
    return main.join(fixed, "host", "left").select("host", "main", "fixed")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row."""
    slots = materialize(main_slots(template(pages, url_col, html_col)), "html-slots")
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("host"))
    # A host of at least 1/HOT of the pages is hot: HOT names at most, whose pages are dealt by their content.
    sizes = materialize(src.filter("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n")), "html-hosts")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.filter(F.col("n") * HOT >= F.lit(total)).select("host", F.lit(SALTS).alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = src.join(F.broadcast(hot), "host", "left").withColumn("salt", F.pmod(F.xxhash64("html"), parts).cast("int"))
    known = slots.join(F.broadcast(hot), "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    joined = dealt.drop("parts").filter("host IS NOT NULL").join(known, ["host", "salt"], "left").select("page_id", "url", "html", "main", "fixed")
    alone = src.filter("host IS NULL").select("page_id", "url", "html", F.lit(None).cast("bigint").alias("main"), F.lit(None).cast("array<bigint>").alias("fixed"))

    def run(batches):
        for b in batches:
            texts = []
            for page, main, fixed in zip(b.column(2), b.column(3), b.column(4)):
                texts.append(main_text(page.as_py(), main.as_py(), frozenset(fixed.as_py() or ())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return joined.union(alone).mapInArrow(run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url string, text string")
