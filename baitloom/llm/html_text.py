"""Main text of HTML pages by tree scoring.

A page is read into a tree of block elements. Each paragraph passes points, for
itself, its length and its commas, to its parent and in part to further
ancestors; a container's points are discounted by its link density. The text is
that of the best container and of the article around it, without what is dense
in links or marked as menu, header, footer, sidebar, notice, advert, form, script, style or
comment. Of several articles in one main element those that are not much smaller stay together.

Element names and hidden attributes decide by themselves what is away. Class names do
not outweigh points: a block with half of the page's points stays, whatever its name; one
of which only a part of the name is of furniture stays if it holds much prose. Reader
comments are away however long, unless nearly all of the page is in them. Blocks of
links before the first paragraph of prose and after the last one are menus, with or
without a name.

A block's text has character references decoded and white space turned into
one space; blocks are joined by one space in page order. A tag that the page's
end cuts off is dropped. Null, empty and tag-only pages give an empty text;
text without any markup is returned whole. Rows are read each for itself, repeated
or not, whole however long; a null page_id stays null. An empty table gives no rows.
Other columns stay as they are, whatever their names; only text and n_chars are
replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import free_name

# Names of HTML elements, by role.
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul head title noscript template button select label legend search".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("nav footer aside form script style textarea title iframe noembed noframes noscript template button select option optgroup head menu dialog object svg math canvas audio video search fieldset label legend input".split())
_PARAGRAPHS = frozenset("p pre blockquote td li dd dt h1 h2 h3 h4 h5 h6 figcaption caption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_LINES = _HEADINGS | frozenset("p pre blockquote figcaption caption".split())
_CLOSES_P = _BLOCK - frozenset(["html", "body", "option", "optgroup", "button", "label", "legend"])
# Class names, ids and roles of what is not the article, and parts that begin or end such a name.
_AWAY = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promotions banner cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "comment comments commentlist comment-list respond disqus reply replies sidebar side-bar aside widget widgets nav navbar navigation sidenav menu menus breadcrumb breadcrumbs pagination pager masthead header footer "
    "site-header page-header main-header top-header share sharing share-buttons social social-links related related-posts related-articles related-links related-content related-stories related-news recommended recommendations newsletter subscribe subscription "
    "signup sign-up login search searchbox search-form toolbar skip-link skiplink copyright contentinfo complementary legal-notice reader-comments form".split()
)
_AWAY_FIRST = frozenset("ad ads advert adsense sponsored promo cookie cookies comment comments disqus sidebar nav navbar menu breadcrumb breadcrumbs footer popup modal newsletter gdpr widget social share".split())
_AWAY_LAST = frozenset("ad ads advert advertisement banner cookies comment comments sidebar nav navbar navigation menu breadcrumb breadcrumbs footer popup modal newsletter widget disqus".split())
# Parts that make a name one of furniture wherever they stand, of reader comments, and first parts that only say how a page is laid out.
_AWAY_PART = frozenset("ad ads adsbygoogle advert adverts advertisement adsense sponsored sponsor promo newsletter subscribe subscription signup cookie cookies consent gdpr notice recommended share sharing popup modal".split())
_TALK = frozenset("comment comments commentlist respond disqus reply replies".split())
_LAYOUT = frozenset("no not non without has have with hide show".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*$""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    away: bool = False
    score: float = 0.0
    text_n: int = 0
    link_n: int = 0
    order: int = 0
    inside: bool = False  # an article or main
    kind: str = ""  # what its class names say it is
    hard: bool = False  # away whatever it holds
    own_n: int = 0
    own_link: int = 0
    points: float = 0.0  # of all in it
    blocks: list[tuple[int, str]] = field(default_factory=list)  # (place, text)
    children: list[Node] = field(default_factory=list)


def _hidden(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element is away by its own name or because it is not shown."""
    if tag in _DROPPED or (tag == "header" and not inside_article):
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _kind(tag: str, attributes: str) -> str:
    """What class names, ids and roles say: talk, furniture (a whole name), maybe (a part of one), or nothing."""
    if not attributes or tag in ("html", "body", "article", "main", "h1"):
        return ""
    kinds = {_named(x) for name, value in _ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id", "role") for x in value.strip("\"'").split()}
    return next((k for k in ("talk", "furniture", "maybe") if k in kinds), "")


@lru_cache(maxsize=4096)
def _named(name: str) -> str:
    name = re.sub(r"(?<=[a-z])(?=[A-Z])|_+", "-", name).strip("-").lower()
    parts = name.split("-")
    if parts[0] in _LAYOUT and len(parts) > 1:
        return ""
    if not _TALK.isdisjoint(parts):
        return "talk"
    if name in _AWAY:
        return "furniture"
    return "maybe" if len(parts) > 1 and (parts[0] in _AWAY_FIRST or parts[-1] in _AWAY_LAST) or not _AWAY_PART.isdisjoint(parts) else ""


def _tree(page: str) -> Node:
    """Block elements of a page; each holds the texts directly in it, by place. Work is in proportion to the page, however deep it nests."""
    root = node = Node("root", None)
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links = place = link_depth = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal links, place
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                place += 1
                node.blocks.append((place, text))
                node.own_n += len(text)
                node.own_link += min(links, len(text))
            parts.clear()
        links = 0

    def close(tag: str) -> None:
        """Ends the innermost open element of this tag, and all in it."""
        nonlocal node
        last = ""
        while last != tag:
            last = node.tag
            opened[last] -= 1
            node = node.parent

    def close_implied(tag: str, stops: frozenset[str]) -> None:
        """Ends an open element of this tag that no stop stands around."""
        x = node
        while opened[tag] and x.tag not in stops and x.parent is not None:
            if x.tag == tag:
                close(tag)
                return
            x = x.parent

    while at < end:
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            parts.append(text)
            links += len(text.strip()) if link_depth else 0
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if not closing:
            if tag in _RAW and not attributes.endswith("/"):
                over = re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
                at = over.end() if over else end
                if tag == "title":
                    flush()
                continue
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                link_depth = 1
            elif tag in _BLOCK or _hides(attributes):
                flush()
                if tag in _CLOSES_P:
                    close_implied("p", _STOPS["p"])
                for other in _CLOSES.get(tag, ()):
                    close_implied(other, _STOPS[other])
                if tag in _VOID or attributes.rstrip().endswith("/"):
                    continue
                hard = node.hard or _hidden(tag, attributes, node.inside)
                place += 1
                node.children.append(Node(tag, node, order=place, inside=node.inside or tag in ("article", "main"), kind=_kind(tag, attributes), hard=hard))
                node = node.children[-1]
                opened[tag] += 1
                link_depth = 0
        elif tag == "a":
            link_depth = 0
        elif opened[tag]:
            flush()
            close(tag)
            link_depth = 0
        elif tag in _BLOCK:
            flush()
    flush()
    return root


# Which open elements a start tag ends, and which elements they are looked for in.
_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "body": ("head",), "main": ("head",), "article": ("head",)}
_STOPS = {
    "p": frozenset("td th article section div body li".split()), "li": frozenset("ul ol menu".split()), "dd": frozenset(["dl"]), "dt": frozenset(["dl"]), "td": frozenset("tr table".split()), "th": frozenset("tr table".split()),
    "tr": frozenset(["table"]), "head": frozenset(),
}


def _hides(attributes: str) -> bool:
    """Whether an inline element is marked as hidden or as not the article, and so must stand apart."""
    return bool(attributes) and ("class" in attributes or "id" in attributes or "hidden" in attributes or "style" in attributes) and (_hidden("span", attributes, True) or bool(_kind("span", attributes)))


def _walk(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        x = todo.pop()
        yield x
        todo += reversed(x.children)


def _link_density(node: Node) -> float:
    return node.link_n / node.text_n if node.text_n else 0.0


def _own_points(x: Node) -> float:
    """Of the texts directly in a block."""
    text = " ".join(t for _, t in x.blocks)
    return (1 + sum(text.count(c) for c in ",،、，") + min(len(text) / 100, 3)) * (1 - x.own_link / x.own_n) if x.blocks else 0.0


def _set_away(root: Node) -> None:
    """Decides what is away: by element, and by name as far as points allow."""
    nodes = list(_walk(root))
    for x in reversed(nodes):  # children before parents
        x.points += 0.0 if x.hard else _own_points(x)
        if x.parent is not None and not x.hard:
            x.parent.points += x.points
    heads = {id(x) for x in nodes if x.tag in ("h1", "article", "main")}
    for x in reversed(nodes):
        if id(x) in heads and x.parent is not None:
            heads.add(id(x.parent))
    whole = root.points
    for x in nodes:
        most = x.points > 0.5 * whole
        named = {"talk": not (id(x) in heads and most) and x.points < 0.9 * whole, "furniture": not most, "maybe": x.points < max(12, 0.1 * whole) and not most}.get(x.kind, False)
        x.away = x.hard or named or (x.parent is not None and x.parent.away)


def _score(root: Node) -> list[Node]:
    """Points of every container that paragraphs stand in."""
    nodes = [x for x in _walk(root) if not x.away]
    for x in nodes:
        x.text_n, x.link_n = x.own_n, x.own_link
    for x in nodes:
        if not x.blocks:
            continue
        points = _own_points(x)
        if x.tag in _PARAGRAPHS:
            over, share = x.parent, 1.0
        else:  # text that stands in a container itself
            over, share = x, 1.0
        while over is not None and share > 0.1:
            over.score += points * share
            over, share = over.parent, share / 2
    for x in reversed(nodes):  # children before parents
        if x.parent is not None:
            x.parent.text_n += x.text_n
            x.parent.link_n += x.link_n
    best = []
    for x in nodes:
        if x.score > 0 and x.tag not in _PARAGRAPHS:
            x.score *= 1 - _link_density(x)
            x.score *= {"article": 3, "main": 2, "html": 0.3, "root": 0.25, "body": 0.5}.get(x.tag, 1)
            best.append(x)
    return best


def main_text(page: str | None) -> str:
    """The article's text of one page."""
    if not page:
        return ""
    root = _tree(page)
    _set_away(root)
    scored = _score(root)
    if not scored:  # a marked wrapper around everything: only element names count then
        for x in list(_walk(root))[1:]:
            x.away = x.tag in _DROPPED or x.tag == "header" or (x.parent is not None and x.parent.away)
        for x in _walk(root):
            x.own_link = 0
        scored = _score(root)
    if not scored:
        return ""
    best = max(scored, key=lambda x: (x.score, -x.order))
    blocks = [b for x in _walk(best) if not x.away for b in x.blocks]
    for x in _around(best):
        blocks += x
    return " ".join(_without_menus(sorted(set(blocks)), root))


def _without_menus(blocks: list[tuple[int, str]], root: Node) -> list[str]:
    """Texts of blocks in page order, but those of links before the first prose and after the last. Prose has 80 letters, or as many as the longest block that is not of links."""
    holder = {place: x for x in _walk(root) for place, _ in x.blocks}
    nodes = [holder[place] for place, _ in blocks]
    dense = [x.own_link / x.own_n for x in nodes]
    bar = min(80, max((len(t) for (_, t), d in zip(blocks, dense, strict=True) if d < 0.25), default=0))
    prose = [i for i, ((_, t), d) in enumerate(zip(blocks, dense, strict=True)) if d < 0.25 and len(t) >= bar]
    if not prose:
        return [t for _, t in blocks]
    return [t for i, (_, t) in enumerate(blocks) if prose[0] <= i <= prose[-1] or dense[i] < 0.5 or nodes[i].tag in _HEADINGS]


def _readable(top: Node) -> list[tuple[int, str]]:
    """Blocks below a node, without what is marked away or is a list, table or container of links."""
    out, todo = [], [top]
    while todo:
        x = todo.pop()
        if not x.away and (_link_density(x) < 0.5 or x.tag in _LINES):
            out += x.blocks
            todo += x.children
    return out


def _within(x: Node | None, outer: Node) -> bool:
    while x is not None and x is not outer:
        x = x.parent
    return x is outer


def _around(best: Node) -> Iterator[list[tuple[int, str]]]:
    """Blocks that belong to the article beside the best container.

    They are those of the article or main around it. Without one, they are those of
    the nearest container that holds more, and headings beside what encloses that.
    """
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    holder = next((x for tag in ("article", "main") for x in above if x.tag == tag), None)
    main = next((x for x in above if x.tag == "main"), None)
    if main is not None and holder is not None and holder is not main:
        others = (y for y in _walk(main) if y.tag == "article" and not y.away and y is not holder and y not in above and not _within(y, holder))
        if any(y.points >= 0.2 * holder.points for y in others):
            holder = main
    x, met = best, False
    while x is not holder and x.parent is not None and x.tag not in ("body", "html"):
        found = [] if met else list(x.parent.blocks)
        for y in x.parent.children:
            if y is not x and (not met or y.tag in _HEADINGS):
                found += _readable(y)
        yield found
        met = holder is None and (met or bool(found))
        x = x.parent
    if best.parent is not None and best is holder:
        for y in best.parent.children:
            same = y.score >= 0.2 * best.score and y.score > 10 and y.tag not in _PARAGRAPHS
            if y is not best and not y.away and (same or (y.tag in ("p", "pre", "blockquote") and y.text_n > 80 and _link_density(y) < 0.25)):
                yield [b for z in _walk(y) if not z.away for b in z.blocks]


def extract_text(pages: DataFrame, *, keep: list[str] | None = None) -> DataFrame:
    """Adds text and n_chars to each page row; columns with these names are replaced."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    read = pages.select(F.col("html").alias(free_name("html", keep)), *keep)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*keep, "text", "n_chars"])

    return read.mapInArrow(extract, T.StructType([*read.schema.fields[1:], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
