"""Main text of HTML pages, with templates of a site found by counting subtrees.

Pass 1 reads every page into blocks and reports the element subtrees that may
be part of a template: containers outside the article, and containers inside
it that are not paragraphs.  Spark counts, per host and subtree hash (tag,
attributes and text), on how many *different* articles of the host the
subtree stands; copies of one article count once.  Subtrees that recur on
``MIN_PAGES`` of them are templates, however many articles the host has.  Pass 2 reads the pages again and leaves out templates,
and boilerplate that its element or class names say (menus, headers, footers,
sidebars, notices, adverts, forms, comments).  A name never takes away what
holds the article or most of the text.

Counting is two aggregates with partial sums, so a host with a third of all
pages is one row per task; page texts are never shuffled unless the list of
pages with templates is larger than a measured bound.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, schema_after, small_side, written

#: A subtree is a template if it stands on at least this many different articles of its host.
MIN_PAGES = 3

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Not shown, or shown only where an element fails; a field of a form (``select``, ``textarea``) is no text of the page.
_RAW = frozenset("script style noscript template iframe textarea title select object canvas noembed noframes xmp".split())
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption summary".split())
_CONTAINER = frozenset(
    "html body main article section div header footer nav aside form fieldset ul ol dl table thead tbody tfoot tr figure "
    "details address menu dialog center hgroup search".split()
)
_BLOCK = _PARAGRAPH | _CONTAINER | {"hr"}
_DROPPED = frozenset("nav header footer aside form fieldset menu dialog head button label search".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
_DROPPED_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert adverts advertisement "
    "banner sponsor sponsored promo cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social comment comments respond discussion replies disqus related recommended pagination pager copyright "
    "skip form search paywall alert topbar bottombar toolbar".split()
)
#: Names of these parts are never names of a wrapper of the text, unless the page has no other text.
_STRONG = frozenset("nav footer aside menu dialog head button label search".split()) | frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer widget ad ads advert adverts advertisement sponsor sponsored cookie cookies "
    "consent gdpr newsletter subscribe subscription signup login share sharing social comment comments respond discussion replies disqus "
    "related recommended pagination pager copyright search".split()
)
#: Words beside boilerplate words in names of boilerplate; a name with any other word (``related-work``) needs content that agrees.
_STRUCTURE = frozenset(
    "list box section area wrapper wrap container block inner outer item items body main top bottom left right post page site bar row col "
    "column link links content element group panel module region zone slot unit text html js open closed form button buttons icon icons "
    "title head heading primary secondary global local sticky fixed mobile desktop small large new more all user reader readers "
    "posts pages articles stories news products videos topics tags categories archive archives read reading also".split()
)
#: Running text itself: never boilerplate by its class or id, nor anything inside it.
_RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote dt dd pre figcaption caption summary math".split())
#: Fields and links whose share tells boilerplate, and characters of other text that such a part may have.
_FIELDS = frozenset("a button input select textarea form label option".split())
_LITTLE = 200
#: Class words of an ``article`` that is a comment or points to another page.
_NO_ARTICLE = frozenset("comment teaser related recommended promo preview".split())
#: Elements whose text does not count in comparing parts of a page.
_NO_TEXT = _RAW | {"a", "button", "label", "option"}
_MAYBE, _WEAK, _SURE, _NEVER = 0.5, 1, 2, 3
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_TAG_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([a-zA-Z][-a-zA-Z0-9_:]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")
_GAP = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "attrs", "children", "parent", "dropped", "digest")  # dropped: 0 or how surely

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []
        self.dropped = 0
        self.digest = b""


def _says_boilerplate(tag: str, attrs: str) -> float:
    """0, or how surely the names say boilerplate: ``_MAYBE`` with other words beside, ``_WEAK`` ones may wrap the text,
    ``_NEVER`` is not shown at all."""
    if tag in _RAW or tag == "head":
        return _NEVER
    found = 0
    if tag in _DROPPED:
        found = _SURE if tag in _STRONG else _WEAK
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return found
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for word in value.split() if tag not in _RUNNING else ():
                parts = _NAME_PART.findall(word)
                if not _DROPPED_NAMES.isdisjoint(parts) and "content" not in parts and "article" not in parts:
                    whole = all(p in _DROPPED_NAMES or p in _STRUCTURE or len(p) < 3 or p.isdigit() for p in parts)
                    found = max(found, _MAYBE if not whole else _WEAK if _STRONG.isdisjoint(parts) else _SURE)
        elif name == "class" and tag == "article" and not _NO_ARTICLE.isdisjoint(value.split()):
            found = max(found, _SURE)
        elif name == "role" and value.strip() in _DROPPED_ROLES:
            found = max(found, _WEAK if value.strip() in ("banner", "form") else _SURE)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return _NEVER
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return _NEVER
    return found


class _Tokens:
    """The next markup of a page from a place on, in time linear in the page, broken tags and quotes too."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.last_end = html.rfind(">")
        self.plain_until = -1  # tags that start before it end at the first ``>``: a quote is open there

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, ``/`` or nothing, tag and attributes (no tag: a comment or declaration); None if only text is left."""
        html = self.html
        while (p := html.find("<", at)) >= 0:
            if html.startswith("<!--", p):
                end = html.find("-->", p + 4)
                return p, len(html) if end < 0 else end + 3, "", "", ""
            if html.startswith(("<!", "<?"), p) and p < self.last_end:
                return p, html.index(">", p) + 1, "", "", ""
            name = _NAME.match(html, p)
            if name and p < self.last_end:
                end = self._tag_end(p, name.end())
                return p, end + 1, name[1], name[2].lower(), html[name.end() : end]
            at = p + 1
        return None

    def _tag_end(self, start: int, at: int) -> int:
        html = self.html
        first = -1
        while start >= self.plain_until:
            stop = _TAG_STOP.search(html, at)
            if stop is None:
                break
            if stop[0] == ">":
                return stop.start()
            at = html.find(stop[0], stop.end()) + 1
            if not at:
                first = stop.start()
                break
        else:
            return html.index(">", at)
        self.plain_until = max(self.plain_until, first if first >= 0 else len(html))
        return html.index(">", start)


def parse(html: str) -> Element:
    """A tree of elements and texts; unclosed and stray tags as browsers close them, nearly."""
    root = node = Element("#root", "", None)
    at, n = 0, len(html)
    unclosed: set[str] = set()  # raw elements without an end tag in the rest of the page
    tokens = _Tokens(html)
    while at < n:
        m = tokens.after(at)
        if not m:
            node.children.append(html[at:])
            break
        start, end, closing, tag, attrs = m
        if start > at:
            node.children.append(html[at:start])
        at = end
        if not tag:
            continue
        if closing:
            up: Element | None = node
            while up is not None and up.tag != tag:
                if tag not in _CONTAINER and up.tag in _CONTAINER:  # an inline or paragraph end does not close its container
                    up = None
                    break
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            elif tag == "p":
                node.children.append(Element("p", "", node))
            continue
        if tag in _VOID:
            node.children.append(Element(tag, attrs, node))
            continue
        if tag in _BLOCK:  # a block ends an open paragraph, with the inline elements in it
            up = node
            while up.parent is not None and up.tag not in _CONTAINER and up.tag not in ("li", "dd", "dt", "td", "th", "blockquote"):
                if up.tag == "p" or up.tag in _PARAGRAPH and tag in _PARAGRAPH:
                    node = up.parent
                    break
                up = up.parent
        if tag in _CLOSES:
            close, stop = _CLOSES[tag]
            up = node
            while up.parent is not None and up.tag not in stop:
                if up.tag in close:
                    node = up.parent
                up = up.parent
        child = Element(tag, attrs, node)
        node.children.append(child)
        if tag in _RAW and not attrs.endswith("/"):
            end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = n
            else:  # ends where its parent does
                unclosed.add(tag)
                node = child
        elif not attrs.endswith("/"):
            node = child
    return root


def _mark(node: Element, inside: bool = False) -> list[Element]:
    """Marks boilerplate by name, without recursion (pages may nest deeply); returns the marked elements that may hold text."""
    found, stack = [], [(node, inside, False)]
    while stack:
        e, inside, running = stack.pop()
        inside = inside or e.tag in ("article", "main")
        for c in e.children:
            if not isinstance(c, str):
                c.dropped = _says_boilerplate(c.tag, c.attrs)
                if running and c.dropped != _NEVER and c.tag not in _DROPPED:  # a part of running text
                    c.dropped = 0
                elif c.dropped == _MAYBE:
                    c.dropped = _WEAK if _looks_boilerplate(c) else 0
                if c.dropped == _WEAK and _has_heading(c) and _heads_text(c, inside):
                    c.dropped = 0
                if not c.dropped:
                    stack.append((c, inside, running or c.tag in _RUNNING))
                elif c.dropped != _NEVER:
                    found.append(c)
    return found


def _looks_boilerplate(e: Element) -> bool:
    """Links or fields and little text beside them; looks no further than ``_LITTLE`` characters of text and a few elements."""
    fields, text, seen, stack = 0, 0, 0, [e]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                text += len(c.strip())
            elif c.tag in _FIELDS:
                fields += 1
            elif c.tag in ("article", "main"):
                return False
            elif c.tag not in _RAW:
                stack.append(c)
        seen += 1
        if text >= _LITTLE or seen > 4 * _LITTLE:
            return False
    return fields > 0


def _heads_text(e: Element, inside: bool) -> bool:
    """A header of the article: by its place, or by its name (``post-header``)."""
    if e.tag == "header":
        return inside
    names = {p for m in _ATTR.finditer(e.attrs) if m[1].lower() in ("class", "id") for p in _NAME_PART.findall((m[2] or m[3] or m[4] or "").lower())}
    return "header" in names and (inside or not names.isdisjoint(("post", "entry", "story")))


def _has_heading(e: Element) -> bool:
    return any(not isinstance(c, str) and (c.tag in ("h1", "h2") or c.tag == "hgroup") for c in e.children)


def _weight(e: Element) -> int:
    """Characters of text under ``e`` outside links, buttons and what is marked surely."""
    n, stack = 0, [e]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                n += len(c.strip())
            elif c.tag not in _NO_TEXT and c.dropped < _SURE:
                stack.append(c)
    return n


def _articles(root: Element, least: int) -> dict[str, list[Element]]:
    """Outermost ``article`` and all ``main`` elements, also those in elements marked less surely than ``least``."""
    found: dict[str, list[Element]] = {"article": [], "main": []}
    stack = [root]
    while stack:
        e = stack.pop()
        if e.tag in found:
            found[e.tag].append(e)
            if e.tag == "article":
                continue
        stack.extend(c for c in reversed(e.children) if not isinstance(c, str) and c.dropped < least)
    if len(found["main"]) > 1:
        mains = {id(e) for e in found["main"]}
        found["main"] = [e for e in found["main"] if not any(id(x) in mains for x in _above(e))]
    return found


def _above(e: Element) -> list[Element]:
    out, up = [], e.parent
    while up is not None:
        out.append(up)
        up = up.parent
    return out


def _linked_heading(e: Element) -> bool:
    """The first heading is a link, as in a teaser of another page."""
    stack: list[tuple[Element, bool]] = [(e, False)]
    while stack:
        x, linked = stack.pop()
        if x.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            texts = [c for c in x.children if not isinstance(c, str) or c.strip()]
            return linked or bool(texts) and all(not isinstance(c, str) and c.tag == "a" for c in texts)
        stack.extend((c, linked or x.tag == "a") for c in reversed(x.children) if not isinstance(c, str) and not c.dropped)
    return False


def _free(root: Element, least: int) -> None:
    """Unmarks elements, marked less surely than ``least``, that hold most of the text under ``root``."""
    some = [e for e in _marked(root) if e.dropped < least]
    inner = list(some)
    while inner:
        new = [c for c in _mark(inner.pop()) if c.dropped < least]
        inner += new
        some += new
    if not some:
        return
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack.extend(c for c in e.children if not isinstance(c, str) and c.dropped < least and c.tag not in _NO_TEXT)
    held: dict[int, int] = {}
    for e in reversed(order):
        held[id(e)] = sum(len(c.strip()) if isinstance(c, str) else held.get(id(c), 0) for c in e.children)
    for e in some:
        if 2 * held.get(id(e), 0) > held[id(root)]:
            e.dropped = 0


def _content_roots(root: Element, marked: list[Element]) -> list[Element]:
    """The articles of a page that are no teasers or comments, else ``main``, else the root."""
    found = _articles(root, _WEAK)
    if marked and _articles(root, _NEVER) != found:
        inner = [e for e in marked if e.dropped == _WEAK]
        while inner:
            inner += [c for c in _mark(inner.pop()) if c.dropped == _WEAK]
        wide = _articles(root, _SURE)
        sure = not (wide["article"] or wide["main"])
        if sure:  # only one that is most of the page
            wide = {k: [e for e in x if not _says_boilerplate(e.tag, e.attrs) and _weight(e) > _weight(root)] for k, x in _articles(root, _NEVER).items()}
        for tag in ("article", "main"):
            if wide[tag]:
                for e in reversed(_above(max(wide[tag], key=_weight))):  # outermost first
                    if e.dropped == _NEVER:
                        break
                    if e.dropped:
                        e.dropped = 0
                        _mark(e)
                break
        found = _articles(root, _WEAK)
    for tag in ("article", "main"):
        if found[tag]:
            own = [e for e in found[tag] if not _linked_heading(e)] if len(found[tag]) > 1 else found[tag]
            roots = own or found[tag]
            for e in roots if marked else ():
                _free(e, _SURE)
            return _heading_before(roots[0]) + roots if tag == "article" else roots
    if marked:
        _free(root, _SURE)
    return [root]


def _heading_before(article: Element) -> list[Element]:
    """The ``h1`` in front of an article without one of its own, in the ``main`` around both."""
    around = _above(article)
    mains = [i for i, e in enumerate(around) if e.tag == "main"]
    if not mains or _first(article, "h1") is not None:
        return []
    inner = article
    for e in around[: mains[0] + 1]:
        for c in e.children:
            if c is inner:
                break
            if not isinstance(c, str) and not c.dropped and (h := _first(c, "h1")) is not None:
                return [h]
        inner = e
    return []


def _first(e: Element, tag: str) -> Element | None:
    stack = [e]
    while stack:
        x = stack.pop()
        if x.tag == tag:
            return x
        stack.extend(c for c in reversed(x.children) if not isinstance(c, str) and not c.dropped)
    return None


def _marked(root: Element) -> list[Element]:
    """Outermost marked elements under ``root`` that may hold text."""
    found, stack = [], [root]
    while stack:
        for c in stack.pop().children:
            if not isinstance(c, str):
                if not c.dropped:
                    stack.append(c)
                elif c.dropped != _NEVER:
                    found.append(c)
    return found


def _hash_subtrees(root: Element) -> None:
    """Digest of tag, attributes, texts and children's digests for every element: each text is hashed once."""
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack.extend(c for c in e.children if not isinstance(c, str))
    for e in reversed(order):
        h = hashlib.blake2b(f"<{e.tag} {_GAP.sub(' ', e.attrs).strip()}>".encode("utf-8", "surrogatepass"), digest_size=8)
        for c in e.children:
            h.update(_GAP.sub(" ", c).strip().encode("utf-8", "surrogatepass") + b"\0" if isinstance(c, str) else c.digest)
        e.digest = h.digest()


def _subtrees(root: Element, contents: list[Element]) -> list[Element]:
    """Containers with text that may be templates: not the content, nor what holds it."""
    above: set[int] = set()
    for content in contents:
        up: Element | None = content
        while up is not None and id(up) not in above:
            above.add(id(up))
            up = up.parent
    out, stack = [], [root]
    while stack:
        e = stack.pop()
        for c in e.children:
            if isinstance(c, str) or c.dropped:
                continue
            if c.tag in _CONTAINER and id(c) not in above and c.tag not in ("html", "body", "article", "main"):
                out.append(c)
            stack.append(c)
    return out


def _blocks(root: Element, templates: frozenset[bytes] | set[bytes]) -> list[str]:
    """Texts of the blocks under ``root`` in page order, white space folded, empty ones left out."""
    out: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        text = _GAP.sub(" ", unescape("".join(piece))).strip()
        piece.clear()
        if text:
            out.append(text)

    stack: list[Element | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            piece.append(x)
        elif x.dropped or x.tag in _RAW:
            continue
        elif x.tag in _BLOCK or x.tag in ("#root", "article", "main"):
            flush()
            if templates and x is not root and x.tag in _CONTAINER and x.digest in templates:
                continue
            stack.append(None)
            stack.extend(reversed(x.children))
        elif x.tag == "br":
            piece.append(" ")
        else:
            stack.extend(reversed(x.children))
    flush()
    return out


def _read(html: str) -> tuple[Element, list[Element]]:
    """The tree of a page and the elements that hold its text."""
    root = parse(html)
    marked = _mark(root)
    contents = _content_roots(root, marked)
    if marked and not any(_blocks(e, frozenset()) for e in contents):  # all text is in what names say is boilerplate
        _free(root, _NEVER)
        contents = [root]
    return root, contents


def main_text(html: str | None, templates: frozenset[bytes] | set[bytes] = frozenset()) -> str:
    """The page's main text; ``templates`` holds digests of subtrees to leave out."""
    if not html:
        return ""
    root, contents = _read(html)
    if templates:
        _hash_subtrees(root)
    return "\n".join(x for e in contents for x in _blocks(e, templates))


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            key, host, digest, article = [], [], [], []
            for k, h, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                if not html:
                    continue
                root, contents = _read(html)
                subtrees = _subtrees(root, contents)
                if not subtrees:
                    continue
                _hash_subtrees(root)
                text = b"".join(e.digest for e in contents) if contents[0] is not root else "\n".join(_blocks(root, set())).encode("utf-8", "surrogatepass")
                own = contents[0].digest if len(contents) == 1 and contents[0] is not root else hashlib.blake2b(text, digest_size=8).digest()
                for d in {e.digest for e in subtrees}:
                    key.append(k)
                    host.append(h)
                    digest.append(int.from_bytes(d, "little", signed=True))
                    article.append(int.from_bytes(own, "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(host, pa.string()), pa.array(digest, pa.int64()), pa.array(article, pa.int64())],
                ["page_key", "host", "digest", "article"],
            )


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = [
                main_text(html, {d.to_bytes(8, "little", signed=True) for d in t or ()})
                for html, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def host_of(url: F.Column) -> F.Column:
    """Host of a URL in lower case, without user, port, path (empty for null or no host)."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def templates(candidates: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, digest`` of subtrees on at least ``min_pages`` different articles of a host."""
    seen = candidates.select("host", "digest", "article").distinct()
    return seen.groupBy("host", "digest").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages).select("host", "digest")


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES
) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    Null or empty html gives an empty text; a null URL belongs to the host
    ``""``; repeated rows give repeated results; other columns are not read.
    Paragraphs, headings and list items are never templates, so passages that
    articles share stay.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
        F.xxhash64(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string")).alias("page_key"),
    )
    found = written(
        arrow_map(
            rows.select("page_key", host_of(F.col("url")).alias("host"), "html"), _candidate_batches, "page_key long, host string, digest long, article long"
        ),
        "subtrees",
    )
    hits = found.join(templates(found, min_pages), ["host", "digest"]).groupBy("page_key").agg(F.collect_set("digest").alias("templates"))
    hits = written(hits, "template-hits")
    marked = rows.join(small_side(hits, limit=100_000), "page_key", "left").select("page_id", "url", "html", "templates")
    return arrow_map(marked, _text_batches, schema_after(rows, "page_id", "url string, text string, n_chars long"))
