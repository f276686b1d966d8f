"""Main text of web pages, with the templates of each site removed.

Every page is parsed into a tree. Each element's subtree has two hashes: one of
all it holds, texts and attributes included, and one of its shape, which is tags,
classes and ids without texts, repeated neighbours once. Both are counted for
each host. A subtree that is on many of a host's pages is part of its template
and is deleted: as it stands, or by its shape, if it lies outside the article,
holds a small share of the pages' text, and is made of links or of no
paragraphs, like a menu whose links differ from page to page. Pages of one text,
be they repeated rows or copies under other URLs, count once.

Then the article is taken (or the body, where a page has none). Tags, roles,
classes and ids that say what an element is (menus, headers, footers, side bars,
notices, adverts, forms, scripts, styles, comments) go too; within articles
classes and ids count for adverts, notices and readers' comments only. ``decided_by`` says whether templates alone would
have given the text, or these rules were needed, as for hosts of few pages.

Within an article plain text blocks (paragraphs, headings, list items and the
like) stay even if they recur, as a passage on several pages is still text, and
so do elements that hold all of it.

Defined results: null html is empty; an unclosed element ends where an element
that cannot be inside it starts, or with its parent; an unclosed comment ends
with the page; every row has its text, copies too; a page without a host has no
template; pages are read in time that grows with their length, whatever is
broken in them; only the columns named are read, whatever else there is. An
empty table has no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferlens.llm.common import join_bounded, staged
from waferlens.llm.url_filter import url_host

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_ENDS = re.compile(r"""[>"']""")
_DIGITS = re.compile(r"\d+")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# What is between their tags is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Text blocks of an article; recurring ones stay.
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption".split()
)
INLINE_TEXT = frozenset(
    "a abbr b bdi bdo br cite code del dfn em i ins kbd mark q s samp small span strong sub sup time"
    " u var wbr".split()
)
# A start tag ends an open element of these, up to the given boundaries.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Text that makes an element more than a menu or a line below the page.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table article main".split())
# What is no text by itself, whatever a site's template is.
NO_TEXT = frozenset(
    "head form script style noscript template iframe object embed applet button select textarea input"
    " label fieldset svg math canvas audio video map title".split()
)
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe object embed applet button"
    " select textarea input label fieldset svg math canvas audio video map dialog menu title".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar"
    " toolbar tablist form".split()
)
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?"
    r"|popup|modal|overlay|newsletter|subscribe|subscription|sidebar|side-bar|menu|nav|navbar|navigation"
    r"|breadcrumbs?|footer|masthead|share|sharing|social|related|recommended|recommendations"
    r"|comments?|comment-list|disqus|replies|login|signup|search|pagination|pager|widget|toolbar"
    r"|hidden|skip-link)(?:$|[\s_-])",
    re.IGNORECASE,
)
# What a text is asked to be without wherever it stands: adverts, notices, readers' comments.
_NAMED_ANYWHERE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|notices?|comments?|comment-list|disqus|replies)(?:$|[\s_-])", re.IGNORECASE
)
_SITE_HEADER = re.compile(r"(?:^|[\s_-])(?:site-header|page-header|topbar|header)(?:$|[\s_-])", re.IGNORECASE)


@dataclass(frozen=True)
class TemplateSettings:
    """A subtree on at least so many pages, and this share of a host's pages, is template."""

    pages: int = 10
    share: float = 0.2
    # A shape that is template holds at most this part of its pages' letters on average.
    part: float = 0.2
    # So many hashes of templates are broadcast; more are joined by shuffle.
    broadcast_hashes: int = 200_000


class Node:
    """An element: its hashes, its letters, those of them in links, and whether it holds prose."""

    __slots__ = ("tag", "marks", "attributes", "children", "hash", "shape", "letters", "linked", "prose")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        self.marks: dict[str, str] | None = None
        self.hash = self.shape = self.letters = self.linked = 0
        self.prose = tag in PROSE

    def mark(self, name: str) -> str:
        if self.marks is None:
            found = _ATTRIBUTE.findall(self.attributes) if self.attributes else ()
            self.marks = {key.lower(): value.strip("\"'") for key, value in found}
        return self.marks.get(name, "")


def hash_of(parts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _seal(node: Node) -> None:
    """Hash a finished element from its tag, attributes, texts and children."""
    parts = [node.tag, node.attributes.strip()]
    shapes = ["\x02", node.tag]
    if node.attributes:
        shapes += (node.mark("class"), _DIGITS.sub("0", node.mark("id")))
    last = None
    for child in node.children:
        if isinstance(child, Node):
            parts.append(f"\x01{child.hash}")
            if child.shape != last:
                last = child.shape
                shapes.append(str(last))
            node.letters += child.letters
            node.linked += child.linked
            node.prose |= child.prose
        elif text := " ".join(child.split()):
            parts.append(text)
            if node.tag not in RAW:
                node.letters += len(text)
    if node.tag == "a":
        node.linked = node.letters
    node.hash, node.shape = hash_of(parts), hash_of(shapes)


class Markup:
    """The tags and comments of a page, found from left to right in linear time.

    What did not lead to an end is remembered: no search is made twice for a
    quote or an end that no later place has, nor from a place in a tag whose
    way on is known to have none.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {mark: page.rfind(mark) for mark in "\"'>"}
        self.endless: set[int] = set()

    def _end_of_tag(self, at: int) -> int:
        """The place of the ``>`` that ends a tag: one outside quotes, else the first one."""
        page, place, passed = self.page, at, []
        while mark := _ENDS.search(page, place):
            start, sign = mark.start(), mark[0]
            if sign == ">":
                return start
            if start in self.endless:
                break
            passed.append(start)
            if self.last[sign] <= start:
                break
            place = page.index(sign, start + 1) + 1
        self.endless.update(passed)
        return page.index(">", at)

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag or comment; None at the end.

        A comment has no name. A ``<`` that begins neither is text.
        """
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("!--", at):
                end = page.find("-->", at + 3)
                return start, end + 3 if end >= 0 else len(page), "", "", ""
            if self.last[">"] < at:
                # Without any end to come only a comment can begin.
                at = page.find("<!--", at)
                if at < 0:
                    return None
                continue
            if page[at] in "!?":
                return start, page.index(">", at) + 1, "", "", ""
            if name := _NAME.match(page, at):
                end = self._end_of_tag(name.end())
                return start, end + 1, name[1], name[2], page[name.end() : end]
        return None

    def raw_end(self, name: str, at: int) -> tuple[int, int] | None:
        """Where the end tag of a raw element begins and ends; None if there is none."""
        found = _raw_end(name).search(self.page, at)
        if found is None or self.last[">"] < found.end():
            return None
        return found.start(), self.page.index(">", found.end()) + 1


@lru_cache(maxsize=64)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE)


class OpenElements:
    """The stack of open elements, and where each tag is open: no end is searched for."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        depth = len(self.stack)
        self.stack.append(node)
        self.depths.setdefault(node.tag, []).append(depth)
        if node.tag in BLOCKS:
            self.blocks.append(depth)

    def close(self, depth: int) -> None:
        """End the element at ``depth`` and all inside it."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            _seal(node)
            if self.stack:
                self.depths[node.tag].pop()
            if node.tag in BLOCKS and self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()

    def innermost(self, tag: str) -> int:
        """The depth of the innermost open element of a tag; 0 if there is none."""
        places = self.depths.get(tag)
        return places[-1] if places else 0

    def make_room(self, name: str) -> None:
        """End what an element of this name cannot be inside of."""
        if name in BLOCKS and self.blocks and self.stack[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])
        if name in CLOSED_BY:
            ended, limits = CLOSED_BY[name]
            depth = max(map(self.innermost, ended))
            if depth > max(map(self.innermost, limits)):
                self.close(depth)


def parse(page: str) -> Node:
    """The tree of a page, in time that grows with its length; texts keep their references."""
    root = Node("html")
    markup, opened = Markup(page), OpenElements(root)
    stack, at = opened.stack, 0
    while token := markup.next(at):
        start, end, slash, name, attributes = token
        if start > at:
            stack[-1].children.append(page[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if slash:
            if depth := opened.innermost(name):
                opened.close(depth)
            continue
        if name == "html":
            continue
        opened.make_room(name)
        node = Node(name, attributes)
        stack[-1].children.append(node)
        if name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            _seal(node)
        elif name in RAW:
            ending = markup.raw_end(name, at)
            text_end, at = ending if ending else (len(page), len(page))
            node.children.append(page[end:text_end])
            _seal(node)
        else:
            opened.push(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    opened.close(0)
    return root


def elements(node: Node, inside: bool = False) -> Iterator[tuple[Node, bool]]:
    """All elements, and whether each lies in an article or main element."""
    waiting = [(node, inside)]
    while waiting:
        now, inside = waiting.pop()
        yield now, inside
        inside = inside or now.tag in ("article", "main")
        waiting.extend((child, inside) for child in now.children if isinstance(child, Node))


WHOLE = frozenset("html body main article head br".split())


def is_text(node: Node) -> bool:
    return node.tag in TEXT_BLOCKS or node.tag in INLINE_TEXT


def may_be_shape(node: Node, inside: bool) -> bool:
    """Whether a recurring shape is enough to delete an element: links, or a few words, outside articles."""
    if inside or node.tag in WHOLE or is_text(node) or not node.letters:
        return False
    return not node.prose or 2 * node.linked >= node.letters


def template_candidates(root: Node) -> dict[int, float]:
    """Hashes of what may be template, with the part of the page's letters under a shape.

    Elements that hold a whole page or its article are none, nor are text
    blocks within it.
    """
    found: dict[int, float] = {}
    whole = max(root.letters, 1)
    for node, inside in elements(root):
        if node.tag in WHOLE or inside and is_text(node):
            continue
        found[node.hash] = 0.0
        if may_be_shape(node, inside):
            found[node.shape] = found.get(node.shape, 0.0) + node.letters / whole
    return found


def dropped(node: Node, inside: bool, by_name: bool = True) -> bool:
    """Whether an element is none of the text by its own account; ``inside`` an article."""
    if node.tag in DROPPED or node.mark("role").lower() in ROLES:
        return True
    # An article's own header has its title; a site's header does not.
    if not inside and node.tag == "header":
        return True
    names = f"{node.mark('class')} {node.mark('id')}"
    if not by_name or names == " ":
        return False
    if inside:
        return bool(_NAMED_ANYWHERE.search(names))
    return bool(_NAMED.search(names) or _SITE_HEADER.search(names))


def articles(root: Node, by_name: bool = True) -> list[Node]:
    """The outermost articles that are not themselves dropped, else the main element."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if node.tag == "article" and not dropped(node, True, by_name):
            found["article"].append(node)
            continue
        if node.tag == "main" or node.mark("role").lower() == "main":
            found["main"].append(node)
        elif node is not root and node.tag != "body" and dropped(node, False, by_name):
            continue
        waiting.extend(child for child in reversed(node.children) if isinstance(child, Node))
    return found["article"] or found["main"]


def wrappers(top: Node, by_name: bool = True) -> set[int]:
    """The ids of the elements that each hold all of an article."""
    found: set[int] = set()
    node = top
    while True:
        inner = [
            child
            for child in node.children
            if (child.strip() if isinstance(child, str) else not dropped(child, True, by_name) and child.tag not in VOID)
        ]
        if len(inner) != 1 or isinstance(inner[0], str):
            return found
        node = inner[0]
        found.add(id(node))


def is_template(node: Node, inside: bool, templates: frozenset[int]) -> bool:
    return node.hash in templates or node.shape in templates and may_be_shape(node, inside)


def blocks_of(
    top: Node, inside: bool, templates: frozenset[int], by_name: bool = True, by_tag: bool = True
) -> list[str]:
    """Texts of the blocks below ``top`` in page order, white space as one blank.

    Without ``by_tag`` only templates go, and what is no text at all.
    """
    blocks: list[str] = []
    open_block: list[str] = []

    def flush() -> None:
        if open_block:
            text = " ".join("".join(open_block).split())
            if text:
                blocks.append(text)
            open_block.clear()

    whole = wrappers(top, by_name) if inside and templates else ()
    # Depth first with a stack of its own, so that no nesting is too deep.
    waiting: list[Node | str | None] = [top]
    while waiting:
        node = waiting.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            open_block.append(html.unescape(node))
        elif node is not top and (
            (dropped(node, inside, by_name) if by_tag else node.tag in NO_TEXT)
            or is_template(node, inside, templates)
            and not (inside and (is_text(node) or id(node) in whole))
        ):
            open_block.append(" ")
        else:
            if node.tag == "br":
                open_block.append(" ")
            block = node.tag in BLOCKS
            if block:
                flush()
                waiting.append(None)
            waiting.extend(reversed(node.children))
    flush()
    return blocks


def main_text(root: Node, templates: frozenset[int] = frozenset()) -> str:
    """The text of the article, or of the whole body where there is none.

    Names of classes are a hint: where all text is inside elements that are
    named like none of it (a wrapper ``with-sidebar``), tags and roles decide.
    """
    for by_name in (True, False):
        tops = articles(root, by_name) or articles(root, False)
        parts = [block for top in tops for block in blocks_of(top, True, templates, by_name)]
        if not tops:
            parts = blocks_of(root, False, templates, by_name)
        if parts:
            break
    return "\n\n".join(parts)


def template_text(root: Node, templates: frozenset[int]) -> str:
    """What is left of a page when its site's templates are deleted, and nothing else."""
    return "\n\n".join(blocks_of(root, False, templates, by_tag=False))


def page_identity(root: Node, page: str) -> int:
    """The same for pages of one text; a page without a text is itself."""
    text = main_text(root) or page
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def site_templates(pages: DataFrame, s: TemplateSettings) -> DataFrame:
    """For each host (``_host``) the hashes of its templates (``_templates``).

    At most as many for a host as its pages have elements on average, over the
    share that a template must reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                hosts, identities, hashes, parts = [], [], [], []
                for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    root = parse(page)
                    own = template_candidates(root)
                    # The page itself counts under a hash that no element has.
                    hosts += [host] * (len(own) + 1)
                    identities += [page_identity(root, page)] * (len(own) + 1)
                    hashes += [None, *own]
                    parts += [0.0, *own.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hosts, pa.string()),
                        pa.array(identities, pa.int64()),
                        pa.array(hashes, pa.int64()),
                        pa.array(parts, pa.float64()),
                    ],
                    names=["_host", "_page", "_hash", "_part"],
                )

    usable = pages.where((F.col("_host") != "") & F.col("_html").isNotNull())
    counted = staged(
        usable.select("_host", "_html")
        .mapInArrow(run, "_host string, _page long, _hash long, _part double")
        .groupBy("_host", "_page", "_hash")
        .agg(F.max("_part").alias("_part"))
        .groupBy("_host", "_hash")
        .agg(F.count(F.lit(1)).alias("_pages"), F.avg("_part").alias("_part"))
        .where(F.col("_hash").isNull() | (F.col("_pages") >= s.pages) & (F.col("_part") <= s.part)),
        "subtrees",
    )
    totals = counted.where(F.col("_hash").isNull()).select("_host", F.col("_pages").alias("_all"))
    return (
        counted.where(F.col("_hash").isNotNull())
        .join(totals, "_host")
        .where(F.col("_pages") >= s.share * F.col("_all"))
        .groupBy("_host")
        .agg(F.collect_list("_hash").alias("_templates"))
    )


def extract(
    pages: DataFrame,
    s: TemplateSettings = TemplateSettings(),
    keep: tuple[str, ...] = ("page_id", "url"),
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """The ``keep`` columns of every page with its ``text``, ``n_chars`` and ``decided_by``."""
    rows = pages.select(
        *(F.col(name).alias(f"_keep{i}") for i, name in enumerate(keep)),
        url_host(F.col(url_column)).alias("_host"),
        F.col(html_column).alias("_html"),
    )
    templates = staged(site_templates(rows, s), "templates")
    hashes = templates.agg(F.sum(F.size("_templates"))).first()[0] or 0
    most = s.broadcast_hashes if hashes <= s.broadcast_hashes else 0
    joined = join_bounded(rows, templates, ["_host"], "left", most)
    kept = [f"_keep{i}" for i in range(len(keep))]
    joined = joined.select(*kept, "_html", "_templates")
    kinds = ", ".join(f"`{n}` {joined.schema[n].dataType.simpleString()}" for n in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, ways = [], []
                for page, own in zip(*(c.to_pylist() for c in batch.columns[-2:]), strict=True):
                    root, templates = parse(page or ""), frozenset(own or ())
                    texts.append(main_text(root, templates))
                    alone = template_text(root, templates) == texts[-1]
                    ways.append("templates" if alone else "rules")
                columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(ways)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-2], *columns], names=[*kept, "text", "n_chars", "decided_by"]
                )

    done = joined.mapInArrow(run, f"{kinds}, text string, n_chars long, decided_by string")
    return done.select(
        *(F.col(name).alias(wanted) for name, wanted in zip(kept, keep, strict=True)),
        "text",
        "n_chars",
        "decided_by",
    )
