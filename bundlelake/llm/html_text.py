"""Main text of web pages by consensus of each host's pages.

Each page's text outside links and page furniture leads to the innermost container of it all. Each
page votes for the path of its best container (tags and classes from the root, digits generalised),
the votes are counted per host, and all pages of the host are extracted again from the containers at
the winning path; a page without it, or of a host whose pages agree on none, uses its own best one.

Elements are furniture by their tag, or by a whole name that says nothing else. What a name or a form
makes furniture is none where it holds the page's text itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted, slices, stored, with_arrow

#: Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math noembed noframes object canvas".split())
FURNITURE = frozenset("head nav header footer aside menu dialog button select label fieldset".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body main article section div td center".split())
NAMED = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table".split())
#: A start tag on the left ends an open element on the right.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
#: Elements that such an ending does not reach across.
SCOPES = frozenset("ul ol dl table div section article main body td th".split())
#: Words of class, id and role names of page furniture, whatever it holds.
READER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies"
    " consent gdpr newsletter subscribe subscription signup login copyright comment comments disqus reply replies"
    " respond".split()
)
#: Words of furniture that layouts also use for what is around an article.
LAYOUT_NAMES = frozenset(
    "banner notice alert popup modal overlay sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead"
    " footer footnav related recommended recommendations share sharing social toolbar widget widgets pagination pager"
    " skip complementary contentinfo search hidden".split()
)
#: Words that leave the meaning of a furniture word beside them as it is.
PLAIN_NAMES = frozenset(
    "site page main top bottom left right primary secondary global box area list item items block bar wrap wrapper"
    " container inner outer section group row panel link links button buttons icons form field text body title thread"
    " post posts article articles story stories news media by this to the us slot unit content".split()
)
#: Words that a paragraph or a heading of an article may carry.
TEXT_NAMES = frozenset("alert notice header related copyright search comment reply sponsor promotion overlay".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|([^<]++)|(<)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"'\u201d\u2019\u00bb)]*(?:\s|$)")

#: A page votes for an inner container although others beside it hold at most this share of the outer one's good
#: text and neither a heading nor a sentence.
SCRAP = 0.02
#: An element that its name or its form makes furniture is none if it holds this share of the page's text, or half of it
#: and an article, a main element or a first heading.
MOST, HALF = 0.9, 0.5


class Element:
    """An open tag: what it is, where it lies, and how much text it holds."""

    __slots__ = ("tag", "label", "parent", "block", "mark", "hard", "soft", "furniture", "title", "in_article", "in_link", "text", "good", "core", "inside")

    def __init__(self, tag: str, label: str, parent: Element | None):
        self.tag, self.label, self.parent = tag, label, parent
        self.hard = self.soft = self.furniture = self.title = self.in_article = self.in_link = self.inside = self.core = False
        self.text = self.good = 0
        if parent is None:
            self.block, self.mark = self, 0
        else:
            self.in_article, self.in_link = parent.in_article, parent.in_link
            whole = tag in BLOCKS
            self.block = self if whole else parent.block
            self.mark = hash((parent.mark, label)) if whole else parent.mark

    @property
    def path(self) -> str:
        """Labels of the blocks from the root."""
        labels, e = [], self.block
        while e.tag:
            labels.append(e.label)
            e = e.parent.block
        return "".join(f"/{x}" for x in reversed(labels))


def _mark(path: str) -> int:
    mark = 0
    for label in path.split("/")[1:]:
        mark = hash((mark, label))
    return mark


def _names(attributes: str) -> tuple[list[str], list[list[str]], bool]:
    """The classes, the words of every whole name, and whether the element is hidden."""
    classes, names, hidden = [], [], False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if name == "class":
            classes = value.split()
        if name in ("class", "id", "role", "data-role"):
            names.extend(_NAME.findall(_CAMEL.sub("-", n).lower()) for n in value.split())
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true") or (
            name == "style" and "display:none" in value.replace(" ", "").lower()
        )
    return classes, names, hidden


def _furniture_words(names: list[list[str]]) -> set[str]:
    """The furniture words of names that say nothing else: ``site-header``, not ``no-sidebar``."""
    found = set()
    for words in names:
        if all(w in READER_NAMES or w in LAYOUT_NAMES or w in PLAIN_NAMES for w in words):
            found.update(w for w in words if w not in PLAIN_NAMES)
    return found


def parse(page: str) -> tuple[list[Element], list[tuple[Element, str | None]]]:
    """All elements in page order, and the page's text pieces with their elements.

    A piece of None ends a block. Tag soup is accepted: missing end tags, stray ones, no root. The
    time grows with the page, however deep it nests.
    """
    root = Element("", "", None)
    elements, pieces, here, at, open_tags = [root], [], root, 0, Counter()

    def close(node: Element) -> Element:
        nonlocal here
        while here is not node:
            open_tags[here.tag] -= 1
            here = here.parent
        open_tags[node.tag] -= 1
        here = node.parent
        return here

    while m := _TOKEN.match(page, at):
        at = m.end()
        if m[4] is not None or m[5] is not None:
            pieces.append((here, html.unescape(m[4] or m[5])))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags[tag] > 0:
                close(_open(here, {tag}))
            if tag in BLOCKS:
                pieces.append((here, None))
            continue
        if tag == "a" and open_tags["a"] > 0 and (node := _open(here, {"a"}, SCOPES)):
            close(node)
        if tag in BLOCKS:
            if tag != "hr" and open_tags["p"] > 0 and (node := _open(here.block, {"p"}, SCOPES)):
                close(node)
            if any(open_tags[t] > 0 for t in ENDS.get(tag, ())) and (node := _open(here.block, ENDS[tag], SCOPES - ENDS[tag])):
                close(node)
            pieces.append((here, None))
        if tag in VOID:
            if tag == "br":
                pieces.append((here, " "))
            continue
        classes, names, hidden = _names(m[3])
        label = ".".join([tag, *sorted(_DIGITS.sub("#", c).replace("/", "|") for c in classes)]) if tag in BLOCKS else tag
        node = Element(tag, label, here)
        node.in_link |= tag == "a"
        node.title = tag in HEADINGS and open_tags["header"] > 0 and _open(here, {"header"}, NAMED) is not None
        words = _furniture_words(names) if tag not in ("html", "body", "main") else set()
        if here.in_article and tag not in CONTAINERS and tag not in LISTS:
            words -= TEXT_NAMES
        if tag == "article":
            words &= READER_NAMES
        node.hard = hidden or tag in FURNITURE or not words.isdisjoint(READER_NAMES)
        node.soft = tag == "form" or bool(words)
        node.core = tag in NAMED or tag == "h1"
        node.in_article |= tag in NAMED
        elements.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if not m[3].rstrip().endswith("/") or tag in BLOCKS or tag == "a":
            here = node
            open_tags[tag] += 1
    _weigh(elements, pieces)
    return elements, pieces


def _weigh(elements: list[Element], pieces: list[tuple[Element, str | None]]) -> None:
    """Decide what is furniture, by names and by the share of the text, and count good text.

    Good text is outside links and furniture.
    """
    for e in elements[1:]:
        e.furniture = e.parent.furniture or e.hard
    counts = [(e, n) for e, piece in pieces if piece and not e.in_link and (n := len(piece.strip()))]
    for e, n in counts:
        if not e.furniture:
            e.text += n
    for e in reversed(elements[1:]):
        e.parent.text += e.text
        if not e.furniture and not e.soft:
            e.parent.core |= e.core
    whole = elements[0].text
    for e in elements[1:]:
        least = HALF if e.core else MOST
        e.furniture = e.parent.furniture or e.hard or (e.soft and e.text < least * whole)
    for e, n in counts:
        if not e.furniture:
            e.good += n
    for e in reversed(elements[1:]):
        e.parent.good += e.good


def _open(node: Element, tags: set[str], until: frozenset[str] = frozenset()) -> Element | None:
    """The innermost open element with one of the tags, within the scope."""
    while node.tag:
        if node.tag in tags:
            return node
        if node.tag in until:
            return None
        node = node.parent
    return None


def best(elements: list[Element], pieces: list[tuple[Element, str | None]], scraps: bool = False) -> Element:
    """The innermost container that leaves none of the page's good text out.

    From the root, a container is left for one inside it only while all its good text lies in
    containers inside it, headings included; with ``scraps``, as pages vote, other containers beside
    the inner one may hold a scrap (``SCRAP``). Where article or main elements hold any, the way
    leads to the container of them all, and text in containers beside does not count.
    """
    root = elements[0]
    inner: dict[Element, list[Element]] = {}
    holding: set[Element] = set()
    outer: dict[Element, Element] = {root: root}
    for e in elements[1:]:
        outer[e] = e if e.tag in CONTAINERS else outer[e.parent]
        if e.tag in CONTAINERS and e.good and not e.furniture:
            inner.setdefault(outer[e.parent], []).append(e)
            if e.tag in NAMED and not e.parent.in_article:
                while e is not None and e not in holding:
                    holding.add(e)
                    e = e.parent
    here = chosen = root
    while nested := inner.get(here):
        if here.good > sum(e.good for e in nested):
            break
        most = max(nested, key=lambda e: e.good)
        if holding and not here.in_article:
            named = [e for e in nested if e in holding]
            if len(named) > 1:
                break
            here = named[0]
        elif most.good == here.good or (
            scraps and not holding and _scraps([e for e in nested if e is not most], here, elements, pieces)
        ):
            here = most
        else:
            break
        if not here.in_article or here.tag in NAMED:
            chosen = here
    return chosen


def _scraps(others: list[Element], outer: Element, elements: list[Element], pieces: list[tuple[Element, str | None]]) -> bool:
    """Whether the containers hold a scrap of the outer one's text, without a heading or a sentence."""
    if sum(e.good for e in others) > SCRAP * outer.good:
        return False
    _mark_inside(elements, others)
    told = (e for e, t in pieces if t and e.inside and not e.furniture and not e.in_link and (_SENTENCE.search(t) or _open(e, HEADINGS)))
    return next(told, None) is None


def _mark_inside(elements: list[Element], chosen: list[Element]) -> None:
    """Set ``inside`` for the chosen elements and all within them."""
    picked = set(chosen)
    for e in elements:
        e.inside = e in picked or (e.parent is not None and e.parent.inside)


def extract(page: str, path: str | None = None) -> str:
    """The page's main text: blocks in order, two line ends between them.

    All elements at the path count; without one, the page's own best container. A header's headings
    count where the header lies inside such an element; other furniture does not.
    """
    elements, pieces = parse(page)
    mark = _mark(path) if path else None
    chosen = [e for e in elements if e.mark == mark and e.block is e and e.good and not e.furniture and e.path == path]
    chosen = chosen or [best(elements, pieces)]
    _mark_inside(elements, chosen)
    shown = {e: e.inside and not e.furniture for e in elements}
    for e in elements[1:]:
        if e.title and e.inside and not e.hard:
            header = _open(e, {"header"})
            up = header.parent
            shown[e] = up.inside and not up.furniture and up.block.tag not in ("", "html", "body")
        elif shown[e.parent] and e.parent.furniture and not e.hard and not e.soft:
            shown[e] = True
    blocks, current = [], []
    for element, piece in pieces:
        if piece is None:
            blocks.append("".join(current))
            current = []
        elif shown[element]:
            current.append(piece)
    blocks.append("".join(current))
    return "\n\n".join(t for b in blocks if (t := _SPACE.sub(" ", b).strip()))


#: Winning paths of up to this many hosts are sent to every task; more are joined by shuffling.
BROADCAST_HOSTS = 100_000


def host_of(url):
    """The host of a URL in lower case; null for none."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        paths, goods = [], []
        for page in batch.column("html").to_pylist():
            found = best(*parse(page), scraps=True)
            paths.append(found.path)
            goods.append(found.good)
        yield pa.record_batch([batch.column("host"), pa.array(paths), pa.array(goods)], names=["host", "path", "good"])


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, path``: the container path that most pages of the host vote for.

    Ties go to the path with more text, then to the greater path; one vote alone decides nothing. Pages
    without a host, an html or any text do not vote.
    """
    voters = pages.select(host_of(quoted(url)).alias("host"), quoted(page).alias("html")).where(
        "host IS NOT NULL AND length(html) > 0"
    )
    return (
        voters.mapInArrow(_votes, "host string, path string, good long").where("good > 0")
        .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
        .groupBy("host").agg(F.max(F.struct("n", "good", "path")).alias("most")).where("most.n > 1")
        .select("host", F.col("most.path").alias("path"))
    )


def main_text(pages: DataFrame, url: str = "url", page: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of every page, from the whole html.

    One row per input row, repeated rows included; a null or empty page has the empty text. A
    column already named as ``into`` is replaced.
    """
    pages = pages.drop(into)
    host, path, body = (own_name(pages, n) for n in ("_host", "_path", "_body"))
    paths = stored(host_paths(pages, url, page), "host-paths").select(F.col("host").alias(host), F.col("path").alias(path))
    if paths.count() <= BROADCAST_HOSTS:
        paths = F.broadcast(paths)
    joined = pages.withColumns({host: host_of(quoted(url)), body: F.coalesce(quoted(page), F.lit(""))}).join(paths, host, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            texts = [
                extract(h, p) if h else ""
                for h, p in zip(batch.column(body).to_pylist(), batch.column(path).to_pylist(), strict=True)
            ]
            yield batch.drop_columns([body, path]).append_column(into, pa.array(texts, pa.string()))

    sent = joined.select(*[quoted(c) for c in pages.columns], body, path)
    return with_arrow(sent, run, [body, path], into, "string")
