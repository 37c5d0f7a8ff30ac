"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of elements with their classes. A
presentation node keeps how often which sequence of child elements was seen, a content node how often
which text. Importance follows from shares, which mean the same on a small and on a large host:

* presentation: 1 - sum(p * p) over the shares of the child sequences; a layout that never changes has 0;
* content: 1 - k / pages of the host for a text seen on k pages; a text on every page has 0;
* a block: GAMMA * content + (1 - GAMMA) * presentation of the element it stands in.

Entropy to the base of the number of pages, as site style trees have it, is no such measure: there a
text with a constant share of the pages loses importance as a host grows.

Blocks below LEAST (where the layout never changes: on eight ninths of the pages) are removed from each
page, unless that would leave nothing of it (pages that are copies of each other). With fewer than PAGES
pages a host tells nothing. Nothing is removed for its importance inside an article, `<main>` or
role=main; a part that only a class or id calls content is no such mark. There, running text stays whatever
its class, and other elements go only by a class or id that says nothing else (`share-box`, not `share-price`). Elements whose tag, role,
class or id says menu, header, footer, sidebar, notice, advert, form, comment and so on have no
importance at all, with all they hold (branches go by these only: importance is that of single blocks
and is not summed up over subtrees); where a page marks its article (or else its main part), what
lies outside has none either; elsewhere lists and blocks that are mostly links have none.

Statistics are partial sums per few megabytes of pages, so a host with a third of all pages is no hot
group; what comes back per host are its unimportant blocks only, and no page has many of those.

Parsing takes time in proportion to the page, however deep or broken its tags are. NULL or empty html gives an
empty text. A url without a host is a host of its own name. Rows are
handled one by one; repeated rows give repeated results. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.arrays import steps
from ledgerloom.llm.common import stored

GAMMA, LEAST, PAGES = 0.9, 0.1, 4
#: What a block is inside of: a part named like content, a marked main part, an article. From MARKED on no block goes for its importance.
NAMED, MARKED, ARTICLE = 1, 2, 3
#: What is counted of a node: pages that have it, its child sequences, its texts.
NODE, SHAPE, TEXT = 0, 1, 2
#: Part of a block's letters inside links from which it counts as links.
LINKS = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that end an open element of the same kind, up to the element that may hold both.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
}
#: Elements before which an open paragraph ends.
ENDS_P = BLOCK - {"br", "body", "head", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "title", "legend", "summary", "figcaption"}
DROPPED = frozenset(
    "script style noscript template svg math canvas iframe object audio video map head title nav footer aside form fieldset button select textarea input datalist "
    "menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status note".split())
#: Elements of running text: inside an article no class or id takes them away.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre q cite em strong b i span a code figure figcaption table tbody thead tfoot tr td th".split())
#: What else a class or id may be made of that says what a part of an article is for.
SHAPES = frozenset("area bar block body bottom box btn button buttons container content group head heading inner item items left link links list main new panel right row section slot small stack top wrap wrapper".split())
#: Words of a class or id that say what an element is for.
WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright disclaimer disqus dropdown footer form gdpr hidden login menu modal nav navbar navigation newsletter notice notices notification offcanvas "
    "overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe teaser toolbar topbar widget widgets".split())
HEADERS = frozenset("header masthead site-header".split())
CONTENT = frozenset("article content main post story entry".split())

_TAG = re.compile(r"""<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
#: The same for pages whose quotes don't match: a tag ends at the next bracket, whatever its quotes. Used after so many such tags.
_PLAIN_TAG = re.compile(r"""<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>()()()""", re.S)
MISMATCHED = 16
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def digest(*parts: object) -> int:
    """A signed 64-bit number."""
    return int.from_bytes(hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Element:
    """An open element; `block` is the place on the stack of the innermost block it is in, itself included."""

    __slots__ = ("tag", "path", "dropped", "inside", "link", "children", "block")

    def __init__(self, tag: str, path: int, dropped: bool, inside: int, link: bool, block: int) -> None:
        self.tag, self.path, self.dropped, self.inside, self.link, self.children, self.block = tag, path, dropped, inside, link, [], block


class Page:
    """Blocks of a page in order: (text, content node, dropped, inside, letters in links), and its presentation nodes (path, child sequence).

    inside: ARTICLE, MARKED, NAMED or 0.
    """

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, int, bool, int, int]] = []
        self.nodes: list[tuple[int, int]] = []
        self.known: dict[tuple, int] = {}
        self.stack = [Element("", 0, False, 0, False, 0)]
        # Where on the stack each tag is open: nothing has to be searched, however deep elements lie.
        self.open_at: defaultdict[str, list[int]] = defaultdict(list)
        self.text: list[str] = []
        self.linked = 0
        self._parse(source)

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                state = self.stack[-1]
                top = self.stack[state.block]
                self.blocks.append((text, top.path, state.dropped, state.inside, self.linked))
            self.text, self.linked = [], 0

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            gone = self.stack.pop()
            self.open_at[gone.tag].pop()
            if gone.tag in BLOCK and not gone.dropped:
                self.nodes.append((gone.path, digest(*gone.children)))

    def _parse(self, source: str) -> None:
        done, size, broken = 0, len(source), 0
        # What follows the last closing bracket holds no tag, only text.
        last = source.rfind(">") + 1
        while done < size:
            found = (_TAG if broken < MISMATCHED else _PLAIN_TAG).search(source, done, last) if done < last else None
            if found is None:
                rest = source.find("<!--", max(done, last))
                self._add(source[done:size if rest < 0 else rest])
                break
            if found.start() > done:
                self._add(source[done:found.start()])
            done = found.end()
            if found.group() == "<!--":
                end = source.find("-->", done)
                done = size if end < 0 else end + 3
                continue
            broken += found.group(5) is not None and bool(found.group(5))
            tag = found.group(2) or found.group(5)
            if not tag:
                continue
            tag = tag.lower()
            if found.group(1) or found.group(4):
                self._close(tag)
                continue
            self._open(tag, found.group(3) if found.group(2) else found.group(6))
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, done)
                done = size if end is None else end.start()
        self._flush()
        self._pop(1)
        if self.blocks:
            self.nodes.append((0, digest(*self.stack[0].children)))

    def _add(self, raw: str) -> None:
        top = self.stack[-1]
        if top.tag in RAW:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if top.link:
            self.linked += len(text)

    def _close(self, tag: str) -> None:
        block, open_at = tag in BLOCK, self.open_at[tag]
        # An inline element ends only inside the block it began in.
        if open_at and (block or open_at[-1] > self.stack[-1].block):
            k = open_at[-1]
            if block or self.stack[k].dropped != self.stack[k - 1].dropped:
                self._flush()
            self._pop(k)
        elif block:
            self._flush()

    def _open(self, tag: str, raw: str) -> None:
        if tag in BLOCK:
            self._flush()
            around = self.stack[-1].block
            if tag in ENDS_P and self.stack[around].tag == "p":
                self._pop(around)
            if tag in SIBLINGS:
                same, holder = (max((self.open_at[t][-1] for t in tags if self.open_at[t]), default=0) for tags in SIBLINGS[tag])
                if same > holder:
                    self._pop(same)
        if tag in VOID:
            return
        above = self.stack[-1]
        named, dropped, header, main = self._kind(tag, raw, above.inside >= MARKED)
        inside = max(above.inside, ARTICLE if tag == "article" else main)
        dropped = above.dropped or dropped or (header and not above.inside)
        if dropped != above.dropped:
            self._flush()
        path = above.path
        if tag in BLOCK:
            path = self._path(above.path, named)
            self.stack[above.block].children.append(named)
        place = len(self.stack)
        self.open_at[tag].append(place)
        self.stack.append(Element(tag, path, dropped, inside, above.link or tag == "a", place if tag in BLOCK else above.block))

    def _path(self, above: int, named: str) -> int:
        found = self.known.get((above, named))
        if found is None:
            found = self.known[above, named] = digest(above, named)
        return found

    def _kind(self, tag: str, raw: str, marked: bool) -> tuple[str, bool, bool, int]:
        """Name of the style, whether the element is no content, is a header, what it says of the main part.

        In a marked main part (`marked`) a class or id counts only if it says nothing else, and not for running text.
        """
        if not raw or raw.isspace():
            return tag, tag in DROPPED, tag == "header", MARKED if tag == "main" else 0
        named, words, dropped = tag, set(), tag in DROPPED
        header, main = tag == "header", MARKED if tag == "main" else 0
        for name, *values in _ATTRIBUTE.findall(raw):
            name, value = name.lower(), entities.unescape("".join(values))
            if name == "class":
                named = f"{tag}.{' '.join(sorted(value.split()))}"
            if name in ("class", "id") and tag not in ("html", "body", "main", "article"):
                for token in value.split() if marked else [value]:
                    parts = {p.lower() for p in _PARTS.findall(token)}
                    if not marked or (tag not in RUNNING and all(p in WORDS or p in SHAPES or p.isdigit() for p in parts)):
                        words |= parts
            elif name == "role":
                roles = set(value.lower().split())
                dropped |= bool(roles & ROLES)
                main = MARKED if "main" in roles else main
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
                dropped = True
        if words:
            if tag in ("div", "section") and words & CONTENT and not words & WORDS:
                main = max(main, NAMED)
            dropped |= bool(words & WORDS)
            header |= bool(words & HEADERS)
        elif tag == "article" and "class" in raw:
            dropped |= bool({p.lower() for p in _PARTS.findall(raw)} & {"comment", "comments", "teaser", "related", "promo", "ad", "advert", "sponsored"})
        return named, dropped, header, main

    def content(self, low: frozenset[int] = frozenset()) -> str:
        """The main text without the blocks whose content nodes are in `low`."""
        kept = [b for b in self.blocks if not b[2]]
        for level in (ARTICLE, NAMED):
            if any(b[3] >= level for b in kept):
                kept = [b for b in kept if b[3] >= level]
                break
        else:
            # Links inside an article are part of it; elsewhere they are menus.
            kept = [b for b in kept if b[4] < LINKS * len(b[0])] or kept
        important = [b for b in kept if b[3] >= MARKED or digest("text", b[1], b[0]) not in low] if low else kept
        return " ".join(b[0] for b in important or kept)


def host(url: Column) -> Column:
    """Host of a url, lower case, without port; the whole url if it has none, empty for NULL."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.when(found != "", found).otherwise(F.coalesce(url, F.lit(""))))


_SEEN = pa.schema([("host", pa.string()), ("node", pa.int64()), ("feature", pa.int64()), ("kind", pa.int32()), ("n", pa.int64())])


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, their child sequences and their unmarked texts, with the number of pages that have them."""
    for part, sources in steps(batches, "html"):
        found: Counter[tuple[str, int, int, int]] = Counter()
        for name, source in zip(part.column("host").to_pylist(), sources, strict=True):
            page = Page(source.decode())
            mine = {(name, path, shape, SHAPE) for path, shape in page.nodes}
            mine.update((name, path, 0, NODE) for path, _ in page.nodes)
            mine.update((name, path, digest("text", path, text), TEXT) for text, path, dropped, inside, _ in page.blocks if not dropped and inside < MARKED)
            found.update(mine)
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, list(found.values())], _SEEN, strict=True)], schema=_SEEN)


def unimportant(pages: DataFrame) -> DataFrame:
    """(host, low): hashes of the content nodes of each host whose importance is below LEAST. pages: host, html."""
    seen = pages.mapInArrow(_seen, "host string, node long, feature long, kind int, n long")
    seen = stored(seen.groupBy("host", "node", "feature", "kind").agg(F.sum("n").alias("n")), "nodes")
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value.cast("double")))
    node = seen.filter(F.col("kind") != TEXT).groupBy("host", "node").agg(
        of(NODE, F.col("n")).alias("m"), (1 - of(SHAPE, F.col("n").cast("double") * F.col("n")) / (of(SHAPE, F.col("n")) * of(SHAPE, F.col("n")))).alias("presentation"))
    texts = seen.filter((F.col("kind") == TEXT) & (F.col("n") > 1)).select("host", "node", "feature", "n")
    unimportant_of = lambda pages_: (1 - F.col("n") / F.col(pages_)) * GAMMA + F.col("presentation") * (1 - GAMMA) < LEAST
    # A node is on no more pages than there are, so what is important among the pages of the node is so on the host.
    near = texts.join(node, ["host", "node"]).filter(unimportant_of("m"))
    hosts = seen.filter((F.col("kind") == NODE) & (F.col("node") == 0)).select("host", F.col("n").alias("pages"))
    low = near.join(hosts.filter(F.col("pages") >= PAGES), "host").filter(unimportant_of("pages"))
    return low.groupBy("host").agg(F.collect_list("feature").alias("low"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sources in steps(batches, "html"):
        lows = part.column("low").to_pylist()
        kept: dict[tuple[int, ...], frozenset[int]] = {}
        out = []
        for low, source in zip(lows, sources, strict=True):
            key = tuple(low or ())
            if key not in kept:
                kept[key] = frozenset(key)
            out.append(Page(source.decode()).content(kept[key]))
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """pages: page_id, url, html. A row per row: page_id, url, text (empty if none), n_chars."""
    named = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    low = stored(unimportant(named.select("host", "html")), "low")
    kinds = {f.name: f.dataType.simpleString() for f in named.schema.fields}
    return named.join(low, "host", "left").select("page_id", "url", "html", "low").mapInArrow(
        _texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
