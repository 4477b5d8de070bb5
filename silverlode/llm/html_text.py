"""Main text of web pages: templates that recur on a site are removed, then what marks itself as not the article."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.url_rules import url_parts

# A subtree is a template if it stands on so many different pages of its host, and on this share of them.
MIN_PAGES = 5
MIN_SHARE = 0.01
# Single paragraphs, items and rows may repeat as content: only long ones count, on a larger share of the pages.
LONG_PLAIN = 100
MIN_SHARE_PLAIN = 0.25
# So may lists and tables of an article.
MIN_SHARE_LISTS = 0.1

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag ends an open element of these, up to the nearest listed scope.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

# What is never part of an article.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button input select textarea option iframe object embed canvas svg"
    " audio video dialog menu title noembed noframes datalist search".split()
)
# Of these the form alone may wrap a whole page, as may boxes by their names.
NO_TEXT = DROPPED - {"form"}
MARKS = frozenset("article main h1".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsored sponsor promo promotion promoted banner nav navbar navigation menu"
    " topbar header masthead footer sidebar aside widget widgets cookie cookies consent gdpr notice notices notification disclaimer"
    " popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies"
    " share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager toc skip search copyright".split()
)
# Of longer names these decide where they come first or last, unless the name only says whether there is such a part.
STRONG_NAMES = frozenset("ad ads advert adverts comment comments cookie cookies footer nav newsletter sidebar".split())
STATES = frozenset("has no not with without hide show".split())
# A quote opens a value behind an equals sign only; one that never closes is a character like others.
MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
NAME_PART = re.compile(r"[a-z]+")
NAME_WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")


class Node:
    """An element: its children are nodes and texts in page order."""

    __slots__ = ("tag", "attributes", "children", "digest", "size", "wraps")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []
        self.digest = 0
        # Characters of the texts in it without surrounding white space, and whether the page's own text is in it.
        self.size = 0
        self.wraps = False


def parse(page: str) -> Node:
    """The element tree of a page; unclosed and misplaced tags are mended as browsers do in the common cases."""
    root = Node("#root")
    stack = [root]
    at, end = 0, len(page)
    while at < end:
        match = MARKUP.search(page, at)
        if match is None:
            stack[-1].children.append(page[at:])
            break
        if match.start() > at:
            stack[-1].children.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            _close(stack, tag)
            continue
        _imply(stack, tag)
        node = Node(tag, match[3])
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            closing = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            node.children.append(page[at : closing.start() if closing else end])
            at = closing.end() if closing else end
        else:
            stack.append(node)
    _measure(root)
    return root


def _close(stack: list[Node], tag: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        # An end tag of an inline element does not reach over a block.
        if tag not in BLOCKS and stack[depth].tag in BLOCKS and stack[depth].tag != "p":
            return


def _imply(stack: list[Node], tag: str) -> None:
    closed, scopes = IMPLIED.get(tag, ((), ()))
    if tag in CLOSES_PARAGRAPH:
        closed, scopes = ("p",), BLOCKS - {"p"}
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in closed:
            del stack[depth:]
            return
        if stack[depth].tag in scopes:
            return


def _postorder(root: Node) -> list[Node]:
    order, pending = [], [root]
    while pending:
        node = pending.pop()
        order.append(node)
        pending.extend(c for c in node.children if not isinstance(c, str))
    order.reverse()
    return order


def _measure(root: Node) -> None:
    """Sizes of all elements, and which wrap the page's text: more than half of it, and no article, main or h1 is elsewhere."""
    order = _postorder(root)
    marks: dict[int, int] = {}
    for node in order:
        inner = [c for c in node.children if not isinstance(c, str)]
        if node.tag not in NO_TEXT:
            node.size = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(c.size for c in inner)
        # The h1 of a site's own header is not the page's.
        own = node.tag in MARKS or "main" in _roles(node)
        marks[id(node)] = 0 if node.tag in NO_TEXT or node.tag == "header" else own + sum(marks[id(c)] for c in inner)
    for node in order:
        node.wraps = 2 * node.size > root.size and marks[id(node)] == marks[id(root)]


def hash_subtrees(root: Node) -> None:
    """Digest of each subtree from its tag, attributes, texts without surrounding white space, and children."""
    for node in _postorder(root):
        state = xxhash.xxh3_64()
        state.update(f"{node.tag}\x00{node.attributes.strip()}\x00")
        for child in node.children:
            if isinstance(child, str):
                state.update(SPACE.sub(" ", child).strip() + "\x01")
            else:
                state.update(child.digest.to_bytes(8, "little"))
        node.digest = state.intdigest()


def articles(root: Node) -> list[Node]:
    """The outermost article elements or main elements; empty if the page names none.

    Main elements are taken where they hold more text outside of articles than the
    largest article has, as articles are mere cards there.
    """
    found = _outermost(root, lambda n: n.tag == "article")
    mains = _outermost(root, lambda n: n.tag == "main" or "main" in _roles(n))
    if not found:
        return mains
    loose, pending = 0, list(mains)
    while pending:
        node = pending.pop()
        loose += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        pending.extend(c for c in node.children if not isinstance(c, str) and c.tag != "article" and not _unwanted(c, True))
    return mains if loose > max(n.size for n in found) else found


def _outermost(root: Node, wanted: Callable[[Node], bool]) -> list[Node]:
    found, pending = [], [root]
    while pending:
        node = pending.pop()
        if wanted(node):
            found.append(node)
        elif not _unwanted(node, False):
            pending.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return found


# Their repeated text may well be content; the page itself is no part of a page.
PLAIN = HEADINGS | frozenset("p li dt dd td th tr caption pre blockquote figcaption summary".split())
LISTS = frozenset("ul ol dl table".split())
WHOLE = frozenset("html body head".split())


def _may_be_template(node: Node) -> bool:
    if node.tag in PLAIN:
        return node.size >= LONG_PLAIN
    return node.tag in BLOCKS and node.tag not in WHOLE


def _least_share(node: Node, inside: bool) -> float:
    """Share of the pages of a host on which a template of this kind stands at least; ``inside`` an article."""
    if node.tag in PLAIN:
        return MIN_SHARE_PLAIN
    return MIN_SHARE_LISTS if inside and node.tag in LISTS else MIN_SHARE


def containers(root: Node) -> list[tuple[Node, int]]:
    """Subtrees that may be templates, each with the digest of what it is a part of: its article, or else the page.

    These are boxes and long paragraphs or items, inside of articles too, but not the
    articles themselves. One article under different menus counts once.
    """
    boxes: list[tuple[Node, int]] = []
    pending = [(root, root.digest)]
    inner = set(map(id, articles(root)))
    while pending:
        node, whole = pending.pop()
        if id(node) in inner:
            whole = node.digest
        elif _may_be_template(node):
            boxes.append((node, whole))
        pending.extend((c, whole) for c in node.children if not isinstance(c, str))
    return boxes


def _attribute(node: Node, *names: str) -> str:
    if "=" not in node.attributes:
        return ""
    return " ".join(v.strip("\"'") for k, v in ATTRIBUTE.findall(node.attributes) if k.lower() in names).lower()


def _roles(node: Node) -> set[str]:
    return set(_attribute(node, "role").split())


def _unwanted(node: Node, inside: bool) -> bool:
    """True for what marks itself as something else than the article; ``inside`` an article, headers keep their headings."""
    if node.tag in NO_TEXT or node.tag == "header" and not inside or node.tag == "form" and not node.wraps:
        return True
    if node.tag in ("html", "body", "#root", "article", "main") or not node.attributes:
        return False
    words = node.attributes.lower()
    if "hidden" in words and (re.search(r"(^|\s)hidden(\s|=|$)", words) or "aria-hidden=\"true" in words):
        return True
    if node.tag in HEADINGS or node.tag == "p" and not _attribute(node, "class", "id", "role"):
        return False
    if node.wraps:
        return False
    if _roles(node) & DROPPED_ROLES:
        return True
    return any(_dropped_name(t) for t in _attribute(node, "class", "id").split())


def _dropped_name(token: str) -> bool:
    """True for a class or id of listed words only, or with a strong one first or last: ``user-comments``, but not ``no-sidebar``."""
    parts = NAME_PART.findall(token)
    if not parts or not STATES.isdisjoint(parts):
        return False
    words = NAME_WORD.findall(token)
    return DROPPED_NAMES.issuperset(parts) or not STRONG_NAMES.isdisjoint((words[0], words[-1]))


def blocks(root: Node, templates: frozenset[int]) -> list[str]:
    """Texts of the blocks of the article in page order, without templates of the site and unwanted parts."""
    lines: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        line = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if line:
            lines.append(line)

    named = articles(root)
    inner = set(map(id, named))
    for top in named or [root]:
        # (node, inside an article, only headings) to enter; None ends a block.
        pending: list[tuple[Node | str | None, bool, bool]] = [(top, bool(named), False)]
        while pending:
            node, inside, only_headings = pending.pop()
            if node is None:
                flush()
                continue
            if isinstance(node, str):
                if not only_headings:
                    parts.append(node)
                continue
            if node.tag == "br":
                parts.append(" ")
                continue
            if (node.digest in templates and id(node) not in inner) or _unwanted(node, inside):
                if node.tag in BLOCKS:
                    flush()
                continue
            if node.tag in BLOCKS:
                flush()
                pending.append((None, inside, False))
            if node.tag == "header" and inside:
                only_headings = True
            elif node.tag in HEADINGS:
                only_headings = False
            pending.extend((c, inside, only_headings) for c in reversed(node.children))
        flush()
    return lines


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, digests, shares, pages = [], [], [], []
        for row, page in enumerate(batch.column(1).to_pylist()):
            root = parse(page or "")
            hash_subtrees(root)
            found = {(n.digest, _least_share(n, whole != root.digest), whole) for n, whole in containers(root)}
            owner += [row] * len(found)
            digests += [d - 2**63 for d, _, _ in found]
            shares += [s for _, s, _ in found]
            pages += [whole - 2**63 for _, _, whole in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(digests, pa.int64()), pa.array(shares, pa.float64()), pa.array(pages, pa.int64())],
            names=["host", "subtree", "share", "page"],
        )


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Hosts with the digests of the subtrees that recur across many of their different pages.

    Pages that are equal throughout count once, and so do equal articles, so copies of
    a page do not make its parts templates. Pages are counted by distinct digests in two steps, with partial
    sums before each shuffle; a host that owns a third of all pages is spread over
    its subtrees. A host has at most ``parts of a page / min_share`` templates.
    """
    host = url_parts(F.col("url"))[0]
    seen = pages.select(host.alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(
        _subtree_rows, "host string, subtree long, share double, page long"
    )
    counts = seen.distinct().groupBy("host", "subtree", "share").agg(F.count(F.lit(1)).alias("pages"))
    recurring = counts.filter(F.col("pages") >= min_pages)
    sizes = pages.select(host.alias("host"), F.xxhash64("html").alias("page")).distinct()
    sizes = sizes.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    return (
        recurring.join(sizes, "host")
        .filter(F.col("pages") >= F.col("all_pages") * F.greatest("share", F.lit(min_share)))
        .groupBy("host")
        .agg(F.collect_set("subtree").alias("templates"))
    )


def main_text(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Text of each page without the templates of its host.

    A page without host, html or article text gives an empty text; repeated rows
    are extracted each; other columns are left out. Elements that name themselves
    ``article`` or ``main`` bound the text where a page has them; templates go in
    them as well.
    """
    host = url_parts(F.col("url"))[0]
    id_type, url_type = pages.schema["page_id"].dataType, pages.schema["url"].dataType
    schema = T.StructType(
        [
            T.StructField("page_id", id_type),
            T.StructField("url", url_type),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                root = parse(page or "")
                if known:
                    hash_subtrees(root)
                texts.append("\n".join(blocks(root, frozenset(d + 2**63 for d in known or ()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=schema.names,
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host.alias("host"))
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "templates")
    return joined.mapInArrow(extract, schema)
