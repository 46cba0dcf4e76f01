"""Main text of web pages by consensus host paths.

Every page's containers are scored by the share of the page's running text
that they hold, how little of their text is links, and their depth.  A page
votes for the *generalised path* of its best: tags and classes from the body
down, digits replaced.  Spark sums the votes per host and path;
the winning path of a host is where its pages keep the article.  Each page is
then extracted again from the containers at its host's path (a page without
one, or with no text there, from its own best container).

Boilerplate never counts: scripts, styles, menus, headers, footers, sidebars,
and forms and elements that are named for adverts, notices, comments and such,
unless such a one holds most of the page's running text: a wrapper may have
any name, and a form may span the page. What readers wrote is kept only on a
page that has nothing else.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import materialise

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^'">]++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*)>""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# HTML's element classes, and the names that boilerplate goes by.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg".split())
IN_HEAD = RAW | frozenset("meta link base".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
    tfoot th thead tr ul""".split())
CLOSE_P = BLOCKS - frozenset("body caption html legend li dd dt option optgroup tbody td tfoot th thead tr".split())
CONTAINERS = frozenset("article blockquote body center details div fieldset figure main section td".split())
DROPPED = frozenset("""nav footer aside button select input datalist dialog menu object embed canvas audio video applet map head
    optgroup option""".split())
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
            "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
            "tbody": (("tbody", "thead", "tfoot"), ("table",)), "option": (("option",), ("select",))}
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies
    consent gdpr notice notices alert popup modal overlay menu menus nav navbar navigation breadcrumb breadcrumbs sidebar aside
    widget widgets footer header masthead topbar comment comments commentlist respond reply replies disqus share sharing social
    related recommended recommendations newsletter subscribe subscription signup login search toolbar pagination pager skip
    hidden""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
REMARKS = frozenset("comment comments commentlist respond reply replies disqus".split())  # what readers wrote
UNSEEN = frozenset("annotation annotation-xml".split())  # a formula's source beside it
MODIFIERS = frozenset("has no non with without".split())  # "no-sidebar" is no sidebar
CONTENT = frozenset("article articles body content entry main page post story text".split())
MAX_DEPTH = 512  # containers further down belong to the one at this depth


@dataclass
class Container:
    parent: int
    path: str
    depth: int
    content: bool
    first: int
    last: int = -1
    text: int = 0
    links: int = 0


@dataclass
class Page:
    """Blocks of text in page order and the containers that span them."""

    blocks: list = field(default_factory=list)
    containers: list = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)} if raw.strip(" /") else {}


def _names(attrs: dict[str, str]) -> set[str]:
    found = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        words = re.split(r"[^a-z0-9]+", name)
        found.update(w for before, w in zip(["", *words], words) if before not in MODIFIERS)
    return found


def _boilerplate(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is left out, whatever it holds; ``inside`` an article
    or main element a header may hold the title."""
    if tag in DROPPED or tag in RAW or tag in UNSEEN:
        return True
    if tag == "header":
        return not inside
    if tag in ("html", "body", "article", "main") or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))


def _named_so(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is named as boilerplate is; a form is by its tag."""
    if tag == "form":
        return True
    if tag in ("html", "body", "article", "main") or not attrs:
        return False
    found = _names(attrs) & BOILERPLATE
    return bool(found) and not (found == {"header"} and inside)


def _content(tag: str, attrs: dict[str, str]) -> bool:
    return tag in ("article", "main") or attrs.get("role", "").lower() == "main" or bool(_names(attrs) & CONTENT)


def _step(tag: str, attrs: dict[str, str]) -> str:
    """A path's step: the tag and its classes, digits generalised."""
    classes = sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *classes])


@dataclass
class Named:
    """An element that is named as boilerplate is: where it begins, the one
    around it (-1: none), its text and links, and whether it has content inside."""

    at: int
    parent: int
    remarks: bool = False
    text: int = 0
    links: int = 0
    content: bool = False


def read(html: str | None) -> Page:
    """Read a page; broken markup is read as far as it goes.

    All text is read however deep it is nested; equal paths are one string,
    so a page that never closes its elements costs no more than its length.
    """
    page, named = _read(html or "", frozenset())
    wrappers = _wrappers(page, named)
    return _read(html, wrappers)[0] if wrappers else page


def _wrappers(page: Page, named: list[Named]) -> frozenset:
    """Where the named elements begin that hold most of the page's running
    text, not mostly links; unless there is content elsewhere and none inside.
    Readers' comments aren't kept while there is running text outside them: they
    may be far longer than the article, and hold articles of their own."""
    outside = _outside_remarks(page, named)
    for e in reversed(named):
        if e.parent >= 0:
            up = named[e.parent]
            up.text, up.links, up.content = up.text + e.text, up.links + e.links, up.content or e.content
    whole = page.containers[0].text - page.containers[0].links + sum(e.text - e.links for e in named if e.parent < 0)
    # an article element counts however short it is, others that are named as content from a tenth
    article = any(c.text > c.links and re.match(r"(article|main)(\.|$)", c.path.rpartition(">")[2]) for c in page.containers if c.content)
    elsewhere = whole if article else max((c.text - c.links for c in page.containers if c.content), default=0)
    kept = {}
    for i, e in enumerate(named):
        run = e.text - e.links
        if e.remarks and outside:
            continue
        if (2 * run > whole and 2 * e.links <= e.text and (e.parent < 0 or e.parent in kept)
                and (e.content or 10 * elsewhere < run)):
            kept[i] = e.at
    return frozenset(kept.values())


def _outside_remarks(page: Page, named: list[Named]) -> bool:
    """Whether there is running text that isn't among readers' comments: in the
    page or in another named element with content. ``named`` holds its sums already."""
    if page.containers[0].text > page.containers[0].links:
        return True
    own = [e.text - e.links for e in named]
    for i, e in enumerate(named):
        if e.parent >= 0:
            own[e.parent] -= e.text - e.links
    among = []
    for e in named:
        among.append(e.remarks or (e.parent >= 0 and among[e.parent]))
    return any(n > 0 and not a and e.content for n, a, e in zip(own, among, named))


def _read(html: str, wrappers: frozenset) -> tuple[Page, list[Named]]:
    """The page without boilerplate, and its named elements; those that begin
    at ``wrappers`` are read as any other."""
    named = []
    page = Page([], [Container(-1, "body", 0, False, 0)])
    blocks, containers = page.blocks, page.containers
    # open elements: tag, container, whether left out, whether inside an article, the named element that it is left out with
    stack = [("html", 0, False, False, -1)]
    words, links, a_depth = [], 0, 0
    where, paths = defaultdict(list), {}  # positions in the stack by tag; paths by parent's path and step

    def flush():
        nonlocal links
        if words:
            text = " ".join("".join(words).split())
            if text:
                c = containers[stack[-1][1]]
                blocks.append(text)
                c.text += len(text)
                c.links += min(links, len(text))
            words.clear()
            links = 0

    def close(depth):
        nonlocal a_depth
        while len(stack) > depth:
            tag, c, out, _, _ = stack[-1]
            if tag in BLOCKS and not out:
                flush()
            if tag == "a" and a_depth:
                a_depth -= 1
            stack.pop()
            where[tag].pop()
            if stack[-1][1] != c:
                containers[c].last = len(blocks)

    def innermost(tags):
        return max((where[t][-1] for t in tags if where[t]), default=0)

    def add(text):
        nonlocal links
        if text and not stack[-1][2]:
            text = entities.unescape(text)
            words.append(text)
            if a_depth:
                links += len(text.strip())
        elif text and stack[-1][4] >= 0:
            e, n = named[stack[-1][4]], len(text.strip())
            e.text += n
            e.links += n if where["a"] else 0

    at, stop = 0, html.rfind(">") + 1  # no tag begins beyond the last >
    while True:
        m = TOKEN.search(html, at, stop)
        if not m:
            add(html[at:].partition("<!--")[0])
            break
        add(html[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            continue
        if m["end"] or m["end2"]:
            if where[tag]:
                close(where[tag][-1])
            elif tag in BLOCKS and not stack[-1][2]:
                flush()
            continue
        raw = m["attrs"] if m["tag"] else m["attrs2"]
        if tag in RAW:
            if not raw.endswith("/") or tag in ("script", "style", "title", "textarea"):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in VOID:
            if not stack[-1][2]:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    words.append(" ")
            continue
        if tag == "html":
            continue
        if where["head"] and tag not in IN_HEAD and tag != "head":
            close(where["head"][0])
        if tag == "body":
            continue
        if tag in CLOSE_P and innermost(("p",)) > innermost(("td", "th", "table", "button", "object", "caption")):
            close(where["p"][-1])
        if tag in SIBLINGS:
            these, scope = SIBLINGS[tag]
            outer = innermost(scope)
            begun = [where[t][bisect_right(where[t], outer)] for t in these if where[t] and where[t][-1] > outer]
            if begun:
                close(min(begun))
        _, c, out, inside, with_named = stack[-1]
        attrs = _attributes(raw)
        if not out:
            if tag in BLOCKS:
                flush()
            out = _boilerplate(tag, attrs, inside)
            if not out and m.start() not in wrappers and _named_so(tag, attrs, inside):
                out, with_named = True, len(named)
                named.append(Named(m.start(), -1, bool(_names(attrs) & REMARKS)))
            if out:
                words.append(" ")
            elif tag in CONTAINERS and containers[c].depth < MAX_DEPTH:
                up, step = containers[c], _step(tag, attrs)
                path = paths.setdefault((up.path, step), f"{up.path}>{step}")
                containers.append(Container(c, path, up.depth + 1, _content(tag, attrs), len(blocks)))
                c = len(containers) - 1
            if tag == "a":
                a_depth += 1
        elif with_named >= 0:
            if _boilerplate(tag, attrs, inside):
                with_named = -1
            elif _named_so(tag, attrs, inside):
                named.append(Named(m.start(), with_named, bool(_names(attrs) & REMARKS)))
                with_named = len(named) - 1
            elif tag in CONTAINERS and _content(tag, attrs):
                named[with_named].content = True
        where[tag].append(len(stack))
        stack.append((tag, c, out, inside or tag in ("article", "main"), with_named))
    close(1)
    flush()
    for c in containers:
        c.last = len(blocks) if c.last < 0 else c.last
    for c in reversed(containers[1:]):
        containers[c.parent].text += c.text
        containers[c.parent].links += c.links
    return page, named


def scores(page: Page) -> list[float]:
    """Of every container: high if it holds nearly all the page's running
    text and little else, and is as deep as that allows."""
    whole = max(1, page.containers[0].text - page.containers[0].links)
    out = []
    for c in page.containers:
        share = (c.text - c.links) / whole
        pure = (c.text - c.links) / c.text if c.text else 0.0
        out.append(share**2 * (0.5 + 0.5 * pure) * (1 + 0.02 * min(c.depth, 10)) * (1.3 if c.content else 1.0))
    return out


def vote(page: Page) -> str | None:
    """The path whose containers score best together; None without text."""
    by_path: dict[str, float] = {}
    for c, s in zip(page.containers, scores(page)):
        by_path[c.path] = by_path.get(c.path, 0.0) + s
    best = max(by_path, key=lambda p: (by_path[p], p))
    return best if by_path[best] > 0 else None


def extract(page: Page, path: str | None) -> str:
    """The blocks at ``path``, or of the page's own best container."""
    found = [b for c in page.containers if c.path == path for b in page.blocks[c.first:c.last]]
    if not found:
        s = scores(page)
        c = page.containers[max(range(len(s)), key=lambda i: (s[i], -i))]
        found = page.blocks[c.first:c.last]
    return "\n".join(found)


def host(url: Column) -> Column:
    """Lower-case authority of a URL; "" if it has none or is null."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path that wins the votes of all the host's pages."""
    src = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                paths = [vote(read(x)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.string())], ["host", "path"])

    cast = src.mapInArrow(run, "host string, path string").where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))
    return cast.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  broadcast_hosts: int = 50_000) -> DataFrame:
    """One row per row of ``pages``: id, url, text and n_chars (code points).

    Null and empty pages, and pages of menus, forms, links and such only, give "".  A null URL
    belongs to the host "".  Repeated rows vote and are returned as often as
    they occur.  Pages of any length are read whole.  Other columns are not
    read.  Up to ``broadcast_hosts`` hosts their paths are broadcast; beyond,
    Spark joins them by host.
    """
    paths = materialise(host_paths(pages, url_col, html_col), "host-paths")
    if paths.count() <= broadcast_hosts:
        paths = F.broadcast(paths)
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    src = src.join(paths, "host", "left").select("id", "url", "html", "path")
    schema = src.select("id", "url", F.lit("").alias("text")).schema

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                text = [extract(read(x), p) for x, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

    return src.mapInArrow(run, schema).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                                              F.length("text").cast("long").alias("n_chars"))
