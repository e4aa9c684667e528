"""Main text of web pages: page furniture by role, site templates by recurring subtrees.

1. A tolerant reader turns a page into a tree.  Elements that are furniture by tag, role
   or class word (menus, headers, footers, sidebars, notices, adverts, forms, comments)
   are left out; where a page marks its article, only that is looked at.  Class words and
   forms are no proof: what wraps the article or most of the text stays (``_settle``), and
   a page is not left without text for their sake.
2. Every remaining element subtree is hashed over tags and text.  Spark counts per host
   the different pages that hold a hash.  Subtrees on ``min_pages`` pages or more that
   make up ``min_share`` of the host's pages are its template.
3. The pages are read again and template subtrees deleted.  A page that would lose all
   its text keeps it: a host of copies is no template.

A host's template is bounded: at most (average subtrees of a page) / ``min_share`` hashes.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

MIN_PAGES, MIN_SHARE = 5, 0.3

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
# Elements that do not separate blocks.
INLINE = set(
    "script style noscript template img input button select textarea iframe object embed svg math audio video map "
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = set(
    "head script style noscript template nav footer aside button select option textarea input iframe object "
    "embed svg math canvas audio video map dialog menu title xmp noembed noframes".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot adbox banner sponsor sponsored "
    "sponsors promo promos promotion cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "newsletter subscribe subscription signup sidebar sidenav widget widgets menu menus nav navbar navigation "
    "breadcrumb breadcrumbs header masthead topbar footer comment comments commentlist respond disqus discussion replies "
    "share sharing social related recommended recommendations login search searchbox pagination pager toolbar".split()
)
# An opening tag of the key ends an open element of the values, up to the given limits.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
_CLOSES |= {"tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"})}
_CLOSES |= {"option": ({"option"}, {"select"})}
_P_ENDS = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/\"'>]+)")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# After these a class tells what an element has or lacks, not what it is.
_STATES = set("no not non has have having with without hide show".split())
# The header of one of these is no page header.
_HEADED = set("post entry article story content section chapter topic question".split())
# How sure an element is furniture: a word among others or a form, a class of such words alone, its tag or role.
MENTIONED, NAMED, CERTAIN = 1, 2, 3


class Node:
    __slots__ = ("tag", "parts", "dropped", "furniture")

    def __init__(self, tag: str, furniture: int = 0):
        self.tag = tag
        self.parts: list[Node | str] = []
        self.furniture = furniture
        self.dropped = furniture > 0


def _names(value: str) -> list[set[str]]:
    """The words of one class: sideBar is sidebar, side and bar; no-sidebar and page--sidebar name neither."""
    found = []
    for piece in re.findall("[A-Za-z]+", value.partition("--")[0]):
        words = [w.lower() for w in _CLASS_WORD.findall(piece)]
        state = next((i for i, w in enumerate(words) if w in _STATES), None)
        if state is not None:
            return [*found, *({w} for w in words[:state])]
        found.append({piece.lower(), *words})
    return found


def _inside_article(places: dict[str, list[int]]) -> bool:
    return bool(places["article"] or places["main"])


def _class_furniture(tag: str, value: str, places: dict[str, list[int]]) -> int:
    """Whether a class or id has words of furniture; an article must be named so by a whole class."""
    most = 0
    for one in value.split():
        names = _names(one)
        hits = [words & WORDS for words in names]
        if any("header" in h for h in hits) and (_inside_article(places) or any(words & _HEADED for words in names)):
            hits = [h - {"header"} for h in hits]
        if names and all(hits):
            most = NAMED
        elif any(hits) and tag != "article":
            most = max(most, MENTIONED)
    return most


def _furniture(tag: str, attributes: str, places: dict[str, list[int]]) -> int:
    if tag in DROPPED or tag == "header" and not _inside_article(places):
        return CERTAIN
    # The label of a control goes with it, also where the form stays.
    if tag == "label" and places["form"]:
        return CERTAIN
    most = MENTIONED if tag == "form" else 0
    if not attributes.strip() or tag in ("html", "body", "main"):
        return most
    for name, double, single, bare, alone in _ATTRIBUTE.findall(attributes):
        name, value = (name or alone).lower(), html.unescape(double or single or bare)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return CERTAIN
        if name == "role" and (role := value.strip().lower()) in ROLES:
            if role != "form":
                return CERTAIN
            most = max(most, MENTIONED)
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return CERTAIN
        if name in ("class", "id"):
            most = max(most, _class_furniture(tag, value, places))
    return most


def _settle(root: Node) -> None:
    """Keeps what was dropped for its class words or as a form but wraps the content of the page.

    That is what wraps (or is) an article or main element, where none stands under fewer such
    names, and what holds more than half of the page's text outside links; the latter not if
    a class names it furniture and an article or main element has other text.
    """
    seen: list[tuple[Node, int, tuple[int, int]]] = []
    own: list[int] = []
    todo = [(root, -1, (0, 0), False)]
    while todo:
        node, parent, rank, link = todo.pop()
        if node.furniture == CERTAIN:
            continue
        if node.furniture:
            rank = (rank[0] + (node.furniture == NAMED), rank[1] + 1)
        link = link or node.tag == "a"
        at = len(seen)
        seen.append((node, parent, rank))
        own.append(0 if link else sum(len(part.strip()) for part in node.parts if isinstance(part, str)))
        todo += [(part, at, rank, link) for part in node.parts if isinstance(part, Node)]
    total, clear = own[:], own[:]  # text of the subtree: all, and without what is dropped in it
    for at in range(len(seen) - 1, 0, -1):
        node, parent, _ = seen[at]
        total[parent] += total[at]
        clear[parent] += 0 if node.dropped else clear[at]
    marked = False
    for tag in ("article", "main"):
        ranks = {at: rank for at, (node, _, rank) in enumerate(seen) if node.tag == tag}
        least = min(ranks.values(), default=None)
        walked = set()
        for at, rank in ranks.items():
            if rank == least:
                marked = marked or clear[at] > 0
                while at >= 0 and at not in walked:
                    walked.add(at)
                    seen[at][0].dropped = False
                    at = seen[at][1]
    for at, (node, _, _) in enumerate(seen):
        if node.dropped and 2 * total[at] > total[0] and not (marked and node.furniture == NAMED):
            node.dropped = False


def parse(page: str | None) -> Node:
    """The tree of a page; anything unclosed, misnested or cut short still gives one."""
    root = Node("")
    unsure = False
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack each tag stands open
    page = (page or "").replace("\0", "")
    at = 0

    def text(end: int) -> None:
        if end > at:
            stack[-1].parts.append(html.unescape(page[at:end]))

    def opened(node: Node) -> None:
        places[node.tag].append(len(stack))
        stack.append(node)

    def closed(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().tag].pop()

    while token := _TOKEN.search(page, at):
        text(token.start())
        at = token.end()
        slash, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag == "br":
                stack[-1].parts.append(Node("br"))
            if places[tag]:
                closed(places[tag][-1])
            continue
        ended, limits = _CLOSES.get(tag, ({"p"} if tag in _P_ENDS else set(), {"table", "button", "td", "th", "caption"}))
        if ended:
            depth = max((places[t][-1] for t in ended if places[t]), default=0)
            if depth and depth >= max((places[t][-1] for t in limits if places[t]), default=0):
                closed(depth)
        node = Node(tag, _furniture(tag, attributes, places))
        unsure = unsure or 0 < node.furniture < CERTAIN
        stack[-1].parts.append(node)
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            end = closing.start() if closing else len(page)
            if not node.dropped:
                node.parts.append(html.unescape(page[at:end]))
            at = end
            if closing:
                opened(node)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            opened(node)
    text(len(page))
    if unsure:
        _settle(root)
    return root


def _has_text(roots: list[Node]) -> bool:
    todo: list[Node | str] = list(roots)
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            if part.strip():
                return True
        elif not part.dropped:
            todo += part.parts
    return False


def _marked(root: Node) -> list[Node]:
    """The article elements that have text, else the main elements, else the page; none without text."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(root, frozenset())]
    while todo:
        node, open_ = todo.pop()
        if node.dropped:
            continue
        if node.tag in found and node.tag not in open_:
            found[node.tag].append(node)
            open_ = open_ | {node.tag}
        todo += [(part, open_) for part in reversed(node.parts) if isinstance(part, Node)]
    return next((roots for roots in (found["article"], found["main"], [root]) if _has_text(roots)), [])


def scope(root: Node) -> list[Node]:
    """Where the content of a page is; without any text, also in what class words or forms had dropped."""
    found = _marked(root)
    if found:
        return found
    todo = [root]
    while todo:
        node = todo.pop()
        node.dropped = node.furniture == CERTAIN
        todo += [part for part in node.parts if isinstance(part, Node)]
    return _marked(root) or [root]


def subtree_hashes(roots: list[Node]) -> dict[int, int]:
    """Hash of each element subtree that has text, by the identity of its node."""
    hashes: dict[int, int] = {}
    todo = [(node, False) for node in roots]
    while todo:
        node, ready = todo.pop()
        if node.dropped:
            continue
        if not ready:
            todo.append((node, True))
            todo += [(part, False) for part in node.parts if isinstance(part, Node)]
            continue
        inner = []
        for part in node.parts:
            if isinstance(part, str):
                inner.append(" ".join(part.split()))
            elif id(part) in hashes:
                inner.append(f"<{part.tag} {hashes[id(part)]:x}>")
        if any(inner):
            value = xxhash.xxh3_64_intdigest("\x00".join([node.tag, *filter(None, inner)]).encode("utf-8", "surrogatepass"))
            hashes[id(node)] = value - (1 << 63)
    return hashes


def text_of(roots: list[Node], hashes: dict[int, int], template: set[int]) -> str:
    """Text in page order: blocks and line breaks separate, white space is one space."""
    pieces: list[str] = []
    todo: list[Node | str] = list(reversed(roots))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            pieces.append(part)
        elif not part.dropped and not (template and hashes.get(id(part)) in template):
            if part.tag in INLINE:
                todo += reversed(part.parts)
            else:
                todo += [" ", *reversed(part.parts), " "]
        elif part.tag not in INLINE:
            pieces.append(" ")
    return " ".join("".join(pieces).split())


def main_text(page: str | None, template: set[int]) -> str:
    roots = scope(parse(page))
    if template:
        kept = text_of(roots, subtree_hashes(roots), template)
        if kept:
            return kept
    return text_of(roots, {}, set())


def host(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, template): the hashes of the subtrees that recur across the pages of each host.

    Copies of a page count once.  Pages without a host belong to no site.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [list(set(subtree_hashes(scope(parse(p))).values())) for p in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["host", "copy", "hashes"])

        return step

    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("copy"), "html").filter("host IS NOT NULL")
    hashed = map_batches(rows, make, "host string, copy long, hashes array<long>")
    single = written(hashed.dropDuplicates(["host", "copy"]), "html-subtrees")
    totals = single.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        single.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    recurring = counts.join(totals, "host").filter(F.col("n") >= min_share * F.col("pages"))
    return recurring.groupBy("host").agg(F.collect_list("hash").alias("template"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``; a null html is empty."""
    found = written(templates(pages, min_pages, min_share), "html-templates")
    # Pages without host or template are kept apart from those that share a host.
    site = F.coalesce(host(F.col("url")), F.concat(F.lit(" "), F.xxhash64("page_id", "html").cast("string")))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), "html", site.alias("host"))
    rows = rows.join(found, "host", "left").select("page_id", "url", "html", "template")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = [main_text(page, set(template or ())) for page, template in both]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

        return step

    return map_batches(rows, make, "page_id long, url string, text string, n_chars long")
