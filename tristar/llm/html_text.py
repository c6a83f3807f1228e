"""HTML extraction: equivalence-class template deduction over the pages of a host.

A *token* of a page is an element with its path of element names and classes (its two tags). Its
*occurrence vector* lists how often it occurs on each page of the host. Tokens with the
same vector form an equivalence class; a class that occurs on at least half of the host's
pages with text belongs to the template. Only valid classes count (all members on as many pages,
equally often), and a token only where the one above it belongs to a valid class: so the classes
nest, and what stands between a token's two tags is its slot. The classes that
occur once on a page, up to ``ODD`` odd pages, are the skeleton; the main slot is that of
the deepest skeleton container that holds nearly all of
a page's text outside menus, headers, footers, sidebars, notices, adverts, forms and comments,
on the average page. A container that is only named like one of those, but holds a heading or an
article and ``WRAPPER`` of the text, is the main slot all the same.

In the main slot, slots of the template whose text is the same on nearly all of their pages are
template text, whatever their name, and are dropped, and so are blocks with a class and lists
whose text, changing or not, stands in links (``LINKS``); paragraphs and headings without a
class are not.

Vectors are never gathered. A token's vector is identified by the sum over pages of a hash of
(page, count), together with its page and occurrence counts, so one aggregation with
map-side combining finds all classes of all hosts, and a host with a third of all pages
is no hot group. The template is at most a few rows per token and host; pages meet it in a join on
the host, which Spark broadcasts when the template is small and splits when a host is hot.
Paths are 64-bit hashes and each element's sums go up once, when it closes: the work on a page is linear
in its length, also where elements nest 100,000 deep.

Defined results: null and empty html give an empty text; a page whose url has no host is
treated with the others of that kind; repeated pages are each returned; extra columns are not read.
Unclosed and stray tags are tolerated (a new paragraph, list item, row or cell closes an
open one). A page without its host's main slot falls back to its article or main element,
then to the body.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.session import write_stage

SHARE = 0.9      # share of a page's text that the main slot must hold
WRAPPER = 0.75   # the same of a container with a name of furniture, of all text
ODD = 0.3        # pages of a host that may lack a skeleton token
SAME = 0.9       # pages of a token that must agree in its text
LEAST = 3        # pages from which on equal text is template text
LINKS = 0.9      # share of a block's text that stands in links if it is a menu
UNIT = 10_000

# Element names by their role in HTML, and words that name page furniture in
# class, id and role attributes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg textarea title".split())
FURNITURE = set("nav header footer aside form menu dialog button select head "
                "script style noscript template iframe svg textarea title".split())
CONTAINER = set("html body main article section div td".split())
BLOCK = set("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
            "tbody tfoot tr td th blockquote pre figure figcaption address br hr nav header "
            "footer aside form fieldset details summary caption center".split())
LIST = set("ul ol dl table".split())
BARRIER = CONTAINER | LIST   # no open paragraph, item, row or cell is looked for above these
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NAMED = set("ad ads advert advertisement advertising sponsor sponsored promo promotion banner "
            "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
            "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
            "signup login share sharing social comment comments reply replies disqus related "
            "recommended widget pagination pager toolbar skip copyright".split())

_TAG = re.compile(r"<(?:!--(?P<c>.*?)(?:-->|\Z)|(?P<e>/?)(?P<n>[A-Za-z][A-Za-z0-9:-]*)"
                  r"(?P<a>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|/?[A-Za-z!?][^>]*>)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_END = {n: re.compile(rf"</{n}\b[^>]*>?", re.I) for n in RAW}


class Node:
    """An open element. ``path`` identifies the labels (name and classes) from the root down to it;
    ``size``, ``links``, ``sum`` and ``head`` gather what stands in it until it closes."""
    __slots__ = ("name", "label", "up", "path", "depth", "own", "kind", "main", "linked",
                 "size", "links", "sum", "head", "slot")

    def __init__(self, up: Node | None, name: str, attrs: str):
        label, words = name, set()
        if attrs:
            found = sorted((k.lower(), (a or b or c).lower()) for k, a, b, c in _ATTR.findall(attrs))
            words = {w for _, v in found for w in _WORD.findall(v)}
            names = [re.sub(r"[\d/]+", "0", v) for k, v in found if k == "class"]
            label += "." + ".".join(sorted(names[0].split())) if names and names[0] else ""
        self.name, self.label, self.up = name, label, up
        self.path = _path(up.path if up else 0, label)
        self.depth = up.depth + 1 if up else 1
        self.own = name in FURNITURE or (name not in ("html", "body", "article", "main")
                                         and bool(words & NAMED))
        # Kind: 0 outside furniture, 1 in furniture by a word only, 2 in furniture by element.
        self.kind = max(up.kind if up else 0, 2 if name in FURNITURE else int(self.own))
        self.main = name in ("article", "main") or bool(up and up.main)
        self.linked = name == "a" or bool(up and up.linked)
        self.size = self.links = self.sum = 0
        self.head = self.slot = False


def _path(up: int, label: str) -> int:
    raw = up.to_bytes(8, "little", signed=True) + label.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def path_of(labels: str) -> int:
    """The path of labels such as ``html/body/div.post``."""
    at = 0
    for label in labels.split("/"):
        at = _path(at, label)
    return at


def events(page: str):
    """(what, innermost element or None, text) in page order, where what is open, close, break or
    text. Every element is opened and closed once and found by name, so the work is linear in
    the page however deep its elements nest."""
    stack: list[Node] = []
    where: dict[str, list[int]] = {}   # name -> places of its open elements in the stack

    def nearest(names) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=-1)

    def close(depth: int):
        while len(stack) > depth:
            node = stack.pop()
            where[node.name].pop()
            yield "close", node, ""

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            yield "text", stack[-1] if stack else None, page[at:end]
        if not m:
            break
        at = m.end()
        name = (m["n"] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            yield "break", None, ""
        if m["e"]:
            if where.get(name):
                yield from close(where[name][-1])
            continue
        if name in SELF_CLOSING:
            open_one = nearest(SELF_CLOSING[name])
            if open_one >= 0 and open_one >= nearest(BARRIER):
                yield from close(open_one)
        if name in VOID:
            continue
        node = Node(stack[-1] if stack else None, name, m["a"] or "")
        where.setdefault(name, []).append(len(stack))
        stack.append(node)
        yield "open", node, ""
        if (m["a"] or "").rstrip().endswith("/"):
            yield from close(len(stack) - 1)
        elif name in RAW:
            raw_end = _END[name].search(page, at)
            at = raw_end.end() if raw_end else n
            yield from close(len(stack) - 1)
    yield from close(0)


def tokens(page: str) -> tuple[dict[int, list], int, int]:
    """Path -> [occurrences, characters of text under it outside furniture within it, checksum of
    all its text, kind, whether an h1, article or main stands in it, characters in links, path
    above, depth, label]; then the characters of the page outside furniture and outside
    furniture by element. An element's sums go to the one above it when it closes."""
    seen: dict[int, list] = {}
    plain = whole = 0
    for what, node, text in events(page):
        if what == "close":
            mine = seen.get(node.path)
            if mine is None:
                mine = seen[node.path] = [0, 0, 0, 0, False, 0, node.up.path if node.up else 0,
                                          node.depth, node.label]
            mine[0] += 1
            mine[1] += node.size
            mine[3] = max(mine[3], node.kind)
            mine[4] |= node.head
            mine[5] += node.links
            if node.sum:
                mine[2] = zlib.crc32(node.sum.to_bytes(4, "little"), mine[2])
            if node.up:
                up = node.up
                up.head |= node.head or node.name in ("h1", "article", "main")
                if not node.own:
                    up.size += node.size
                    up.links += node.links
                if node.sum:
                    up.sum = zlib.crc32(node.sum.to_bytes(4, "little"), up.sum) or 1
        elif what == "text" and node:
            words = text.split()
            if not words:
                continue
            size = sum(map(len, words))
            plain += size * (node.kind == 0)
            whole += size * (node.kind < 2)
            node.size += size
            node.links += size * node.linked
            node.sum = zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass"), node.sum) or 1
    return seen, plain, whole


def extract(page: str, main: int | None, drop=frozenset()) -> str:
    """Blocks of the main slot without template text (or of the fallback), one per line."""
    found: dict[str, list[str]] = {"slot": [], "article": [], "body": []}
    now: dict[str, list[str]] = {k: [] for k in found}

    def flush() -> None:
        for k, parts in now.items():
            if parts:
                block = " ".join(html.unescape("".join(parts)).split())
                if block:
                    found[k].append(block)
                parts.clear()

    for what, node, text in events(page):
        if what == "break":
            flush()
        elif what == "open":
            # In the main slot, outside furniture and template text.
            node.slot = main is not None and (node.path == main or bool(
                node.up and node.up.slot and not node.own and node.path not in drop))
        elif what == "text":
            if node and node.slot:
                now["slot"].append(text)
            if node and node.kind:
                continue
            now["body"].append(text)
            if node and node.main:
                now["article"].append(text)
    flush()
    return "\n".join(found["slot"] or found["article"] or found["body"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def _may_be_template_text(label: str) -> bool:
    """Blocks with a class, and containers and lists: not plain paragraphs and headings."""
    name, _, classes = label.partition(".")
    return name in BLOCK and (bool(classes) or name in CONTAINER or name in LIST)


def deduce_template(pages: DataFrame) -> DataFrame:
    """Template tokens of every host: (host, path, up, depth, label, class, pages, times, share,
    links, same, kind, head, host_pages). ``class`` is equal for tokens with equal occurrence
    vectors, ``share`` sums the token's share of each page's text, ``links`` the share of it that
    stands in links, ``same`` counts pages that agree in its text (null if that is not asked).
    Pages without text do not count."""
    def rows(batches):
        for b in batches:
            out = []
            for host, key, page in zip(b.column("host").to_pylist(), b.column("key").to_pylist(),
                                       b.column("html")):
                seen, plain, whole = tokens(page.as_py() or "")
                if not whole:
                    continue
                out.append((host, key, 0, 0, 0, "", 1, 0, 0, None, 0, False))
                for p, (n, c, sum_, kind, head, link, up, depth, label) in seen.items():
                    total = max(whole if kind else plain, 1)
                    out.append((host, key, p, up, depth, label, n, UNIT * c // total, UNIT * link // total,
                                sum_ if sum_ and _may_be_template_text(label) else None, kind, head))
            cols = list(zip(*out)) or [()] * 12
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(),
                    pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()))],
                names=["host", "key", "path", "up", "depth", "label", "n", "share", "links", "text",
                       "kind", "head"])

    counted = (pages.select(host_of(F.col("url")).alias("host"),
                            F.xxhash64("page_id", "url").alias("key"), "html")
               .mapInArrow(rows, "host string, key long, path long, up long, depth int, label string, "
                                 "n long, share long, links long, text long, kind int, head boolean"))
    texts = counted.groupBy("host", "path", "text").agg(
        F.count("*").alias("pages"), F.sum("n").alias("times"), F.sum("share").alias("share"),
        F.sum("links").alias("links"), F.max("kind").alias("kind"), F.max("head").alias("head"),
        F.max(F.struct("up", "depth", "label")).alias("at"),
        F.sum(F.xxhash64("key", "n").cast("decimal(38,0)")).alias("vector"))
    token = texts.groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.sum("share").alias("share"),
        F.sum("links").alias("links"), F.max("kind").alias("kind"), F.max("head").alias("head"),
        F.max("at").alias("at"),
        F.max(F.when(F.col("text").isNotNull(), F.col("pages"))).alias("same"),
        F.sum("vector").cast("decimal(38,0)").alias("vector"))
    token = write_stage(token, "page-tokens")
    whole = token.filter("path = 0").select("host", F.col("pages").alias("host_pages"))
    return (token.join(whole, "host").filter("path != 0 AND 2 * pages >= host_pages")
            .select("host", "path", "at.up", "at.depth", "at.label",
                    F.xxhash64("vector", "pages", "times").alias("class"),
                    "pages", "times", "share", "links", "same", "kind", "head", "host_pages"))


def nest_classes(template: DataFrame) -> DataFrame:
    """The tokens of the valid classes, with ``within``, the class that the token's class is nested
    in at this place (null at the root, equal to ``class`` inside the class itself).

    The tokens of a class stand on the same pages equally often, so a class whose members differ in
    that is none; and a token is nested only if the one above it belongs to the template too."""
    classes = (template.groupBy("host", "class")
               .agg(F.min("pages").alias("p0"), F.max("pages").alias("p1"),
                    F.min("times").alias("t0"), F.max("times").alias("t1"))
               .filter("p0 = p1 AND t0 = t1").select("host", "class"))
    valid = template.join(classes, ["host", "class"])
    above = valid.select("host", F.col("path").alias("up"), F.col("class").alias("within"))
    return valid.join(above, ["host", "up"], "left").filter("up = 0 OR within IS NOT NULL")


def main_slots(template: DataFrame) -> DataFrame:
    """(host, main, drop): the deepest container of the skeleton with nearly all text, and the
    slots of other template tokens in it that hold template text or links only."""
    nested = write_stage(nest_classes(template), "page-template")
    name = F.regexp_extract("label", r"^([a-z0-9:-]+)", 1)
    same = F.coalesce(F.col("same") >= SAME * F.col("pages"), F.lit(False))
    skeleton = nested.filter((F.col("pages") >= (1 - ODD) * F.col("host_pages"))
                             & (F.col("times") <= (1 + ODD) * F.col("pages"))
                             & name.isin(sorted(CONTAINER)))
    wrapper = (F.col("kind") == 1) & F.col("head") & (F.col("share") >= WRAPPER * UNIT * F.col("pages"))
    plain = (F.col("kind") == 0) & (F.col("share") >= SHARE * UNIT * F.col("pages"))
    main = (skeleton.filter(wrapper | plain).groupBy("host")
            .agg(F.max(F.struct("kind", "depth", "path", same.alias("same"))).alias("best"))
            .select("host", F.col("best.path").alias("main"), F.col("best.depth").alias("main_depth"),
                    F.col("best.same").alias("constant")))
    # A menu or advert whose text changes: a block with a class or a list, nearly all links.
    menu = ((F.col("same").isNotNull()) & (F.col("links") >= LINKS * F.col("share"))
            & (F.col("share") > 0) & (F.col("share") <= UNIT // 2 * F.col("pages"))
            & (F.col("label").contains(".") | name.isin(sorted(LIST))) & ~F.col("head"))
    fixed = (nested.filter((same | menu) & (F.col("pages") >= LEAST))
             .join(main.filter("NOT constant"), "host").filter("depth > main_depth")
             .groupBy("host").agg(F.collect_set("path").alias("drop")))
    return main.select("host", "main").join(fixed, "host", "left")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"),
                         F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    main = write_stage(main_slots(deduce_template(pages)), "main-slots")

    def rows(batches):
        for b in batches:
            text = [extract(p.as_py() or "", m.as_py(), frozenset(d.as_py() or ()))
                    for p, m, d in zip(b.column("html"), b.column("main"), b.column("drop"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return (pages.withColumn("host", host_of(F.col("url"))).join(main, "host", "left")
            .select("page_id", "url", "html", "main", "drop")
            .mapInArrow(rows, "page_id long, url string, text string, n_chars long"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
