"""Main text of web pages, by wrappers inferred from the pages of a host.

A page is read as a stream of tags and texts. Its elements nest, so the stream is aligned element
by element: neighbours of one kind become a repeated group, what only some pages have becomes
optional, and texts that differ become slots. Pages of a host are aligned one after the other into
one expression without alternatives, the wrapper, which also sums up how much text each slot
took. Aligning wrappers works like aligning pages, so every task makes one of its own pages per
host, and these few are aligned with each other afterwards: no task sees all pages of a host.

The wrapper then says which element of the host's pages holds the main text: the innermost one with
all text outside menus, headers, adverts and the like. Blocks that all pages of the host share are
no slots and are left out, but for headings inside an article and what follows these.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marlstone.llm.common import col, in_slices, staged

# Elements by how HTML treats them.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var br wbr img svg "
    "math semantics maction menclose merror mfenced mfrac mglyph mi mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr "
    "munder munderover annotation annotation-xml".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open p ends where one of these begins; an open element of the first kind where its like does.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
# What is never main text by element, and what is not by a word of its class, id or
# role, unless the wrapper says that the main text is in it.
NOT_MAIN = frozenset(
    "head nav header footer aside form button select dialog script style textarea title noscript "
    "template iframe svg annotation annotation-xml".split()
)
# Elements of these that are around the main text, or at the head of it, are part of the page's plain
# structure: a form that a server framework puts around a page, the title of an article.
WRAPS_PAGE = frozenset("form header aside footer".split())
HEADS_ARTICLE = "header"
NOT_MAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent footer header masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promoted related reply replies respond share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# A list of children longer than this is written as one group of optional kinds, repeated.
MOST_CHILDREN = 48
LONGEST_PERIOD = 4
# Blocks on all pages of a host, and on so many at least, belong to the template.
FEWEST_PAGES = 3
# Main elements nested deeper are read as if they followed each other; others end where they end.
MOST_DEPTH = 120

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"[0-9]+")


class Element:
    """A tag with what is in it: elements and decoded texts.

    The key of an element that words rule out ends in a space and these words. If it is a block,
    the wrapper can still say that the main text is in it (`named_parts`).
    """

    __slots__ = ("by_word", "children", "key", "main", "name")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.children = name, []
        self.key, self.main, self.by_word = name, name not in NOT_MAIN, False
        words: set[str] = set()
        found = [(a.lower(), b or c or d) for a, b, c, d in ATTRIBUTE.findall(attributes)]
        for kind, value in found:
            if kind == "class" and value.strip():
                self.key = f"{name}.{'.'.join(sorted(value.split()))}"
            words |= not_main_words(value)
        if words and self.main and name not in ("html", "body", "main", "article"):
            self.main, self.by_word = False, name not in INLINE
            self.key = f"{DIGITS.sub('0', self.key)} {'.'.join(sorted(words))}"


def not_main_words(value: str) -> set[str]:
    return {w.lower() for w in NAME_WORD.findall(value)} & NOT_MAIN_WORDS


def parse(page: str) -> Element:
    """The element tree of a page; never fails, however broken the markup is."""
    root = Element("#page")
    stack, at = [root], 0

    def add_text(text: str) -> None:
        if text:
            stack[-1].children.append(html.unescape(text))

    for token in iter_tokens(page):
        start, end, closing, name, attributes = token
        add_text(page[at:start])
        at = end
        if not name:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
            continue
        ends = CLOSES.get(name, set()) | ({"p"} if name in CLOSES_P else set())
        while ends and len(stack) > 1:
            # Inline elements left open inside end with what they are in.
            depth = len(stack) - 1
            while depth > 0 and stack[depth].name in INLINE and stack[depth].name not in ends:
                depth -= 1
            if depth == 0 or stack[depth].name not in ends:
                break
            del stack[depth:]
        element = Element(name, attributes)
        stack[-1].children.append(element)
        if name not in VOID and not attributes.rstrip().endswith("/"):
            if len(stack) < MOST_DEPTH:
                stack.append(element)
            elif not element.main and len(stack) < 2 * MOST_DEPTH:
                element.by_word = False
                stack.append(element)
    add_text(page[at:])
    relieve(root)
    return root


def relieve(root: Element) -> None:
    """Make main what its name rules out, but that the page's main text is in or begins with.

    That is a form with an article or main element or most of the page's text in it, another such
    element with both, and the header of an article.
    """
    order: list[tuple[Element, Element | None, bool]] = []
    todo: list[tuple[Element, Element | None, bool]] = [(root, None, False)]
    while todo:
        element, outer, in_article = todo.pop()
        order.append((element, outer, in_article))
        in_article = in_article or element.name in ("article", "main")
        if element.name == HEADS_ARTICLE and in_article:
            element.main = True
        todo += [(c, element, in_article) for c in element.children if isinstance(c, Element)]
    if not any(e.name in WRAPS_PAGE and not e.main for e, _, _ in order):
        return
    size: dict[int, int] = {}
    holds: set[int] = set()
    for element, outer, _ in reversed(order):
        own = size.get(id(element), 0)
        if element.main or element.by_word or element.name in WRAPS_PAGE:
            own += sum(len(c.strip()) for c in element.children if isinstance(c, str))
        else:
            own = 0
        size[id(element)] = own
        if outer is not None:
            size[id(outer)] = size.get(id(outer), 0) + own
            if element.name in ("article", "main") or id(element) in holds:
                holds.add(id(outer))
    for element, _, _ in order:
        if element.name in WRAPS_PAGE and not element.main:
            most = 2 * size[id(element)] > size[id(root)]
            wraps = id(element) in holds
            element.main = wraps or most if element.name == "form" else wraps and most


def iter_tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags and comments in order; what raw elements hold is skipped up to their end tag."""
    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            return
        name = (found[2] or "").lower()
        yield found.start(), found.end(), bool(found[1]), name, found[3] or ""
        at = found.end()
        if name in RAW and not found[1] and not (found[3] or "").rstrip().endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            close = (end.start(), end.end()) if end else (len(page), len(page))
            yield close[0], close[1], True, name, ""
            at = close[1]


# A wrapper node is [key, count, text, slot, children, open]: how it may occur ("1", "?", "+", "*"),
# the characters below it that no element rules out by its name, the text all pages share (None for
# a slot), its children, and how many of the characters are from pages without a plain article.
# Groups of several repeated kinds have the key "()". The root of a host also has how many pages
# have text, and the blocks all of these share: by digest, their characters and what is around them.


def skeleton(element: Element, main: bool = True, is_open: bool | None = None) -> list:
    main = main and (element.main or element.by_word)
    if is_open is None:
        is_open = not has_plain_article(element)
    children = []
    for child in block_children(element):
        if isinstance(child, str):
            text = SPACE.sub(" ", child).strip()
            if text:
                size = len(text) if main else 0
                children.append(["#", "1", size, text, [], size if is_open else 0])
        else:
            children.append(skeleton(child, main, is_open))
    children = fold(children)
    sizes = [sum(c[k] for c in children) for k in (2, 5)]
    return [element.key, "1", sizes[0], None, children, sizes[1]]


def page_wrapper(page: str) -> list:
    """The wrapper of one page."""
    root = parse(page)
    shared = {digest(p.text, p.outer): [len(p.text), p.outer] for p in parts(root)}
    return [*skeleton(root), 1 if shared else 0, shared]


def digest(text: str, outer: tuple[str, ...]) -> str:
    data = "\0".join((text, *outer)).encode("utf-8", "surrogatepass")
    return hashlib.blake2b(data, digest_size=8).hexdigest()


def join_wrappers(a: list, b: list) -> list:
    """One wrapper for two of different pages."""
    if not a[6] or not b[6]:
        shared = a[7] or b[7]
    else:
        shared = {key: kept for key, kept in a[7].items() if key in b[7]}
    return [*align(a, b), a[6] + b[6], shared]


def has_plain_article(element: Element) -> bool:
    """Whether an article or main element with text stands where nothing rules it out."""
    todo = [element]
    while todo:
        node = todo.pop()
        if node.name in ("article", "main") and not not_main_words(node.key):
            if any(not part.outer for part in parts(node)):
                return True
        todo += [c for c in node.children if isinstance(c, Element) and c.main]
    return False


def block_children(element: Element) -> Iterator[str | Element]:
    """Children with inline elements dissolved, but for those that are not main text."""
    for child in element.children:
        if isinstance(child, Element) and child.name in INLINE and child.main:
            yield from block_children(child)
        else:
            yield child


def fold(nodes: list) -> list:
    """Repeats written as groups: neighbours of one kind first, then longer periods."""
    out: list = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            out[-1] = repeated(align(out[-1], node))
        else:
            out.append(node)
    for period in range(2, LONGEST_PERIOD + 1):
        at = 0
        while at + 2 * period <= len(out):
            first, second = out[at : at + period], out[at + period : at + 2 * period]
            if [n[0] for n in first] != [n[0] for n in second]:
                at += 1
                continue
            group = group_of([align(a, b) for a, b in zip(first, second)])
            following = out[at + 2 * period :]
            while [n[0] for n in following[:period]] == [n[0] for n in group[4]]:
                group = group_of([align(a, b) for a, b in zip(group[4], following)])
                following = following[period:]
            out[at:] = [group, *following]
            at += 1
    if len(out) > MOST_CHILDREN:
        out = [generalised(out)]
    return out


def group_of(nodes: list) -> list:
    return ["()", "+", sum(n[2] for n in nodes), None, nodes, sum(n[5] for n in nodes)]


def generalised(nodes: list) -> list:
    kinds: dict[str, list] = {}
    for node in flattened(nodes):
        met = kinds.get(node[0])
        kinds[node[0]] = node if met is None else repeated(align(met, node))
    return group_of([optional(n) for n in kinds.values()])


def flattened(nodes: list) -> Iterator[list]:
    """Nodes with groups dissolved; what is in a group may come again with it."""
    for node in nodes:
        if node[0] == "()":
            yield from map(repeated, flattened(node[4]))
        else:
            yield node


def repeated(node: list) -> list:
    return [node[0], "*" if node[1] in "?*" else "+", *node[2:]]


def optional(node: list) -> list:
    return [node[0], "*" if node[1] in "+*" else "?", *node[2:]]


def align(a: list, b: list) -> list:
    """One node for two of the same key."""
    count = {"1": "1", "+": "+"}.get(a[1] if a[1] == b[1] else "", None)
    if count is None:
        skip, many = a[1] in "?*" or b[1] in "?*", a[1] in "+*" or b[1] in "+*"
        count = "*" if skip and many else "?" if skip else "+" if many else "1"
    slot = a[3] if a[3] == b[3] else None
    return [a[0], count, a[2] + b[2], slot, align_lists(a[4], b[4]), a[5] + b[5]]


def align_lists(a: list, b: list) -> list:
    """Children aligned on their longest common run of keys; the others become optional."""
    if [n[0] for n in a] == [n[0] for n in b]:
        return [align(x, y) for x, y in zip(a, b)]
    long = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            long[i][j] = max(
                long[i + 1][j], long[i][j + 1],
                long[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else 0,
            )
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0] and long[i][j] == long[i + 1][j + 1] + 1:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif long[i + 1][j] >= long[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    return fold([*out, *map(optional, a[i:]), *map(optional, b[j:])])


def named_parts(wrapper: list) -> frozenset[str]:
    """Keys of elements that a word rules out, but that hold the main text of the host.

    On pages without a plain article, these are what holds most of the text, and what is around an
    article or main element, the fewest such elements first. Parts inside are judged by themselves.
    """
    held: dict[str, int] = {}
    around: set[frozenset[str]] = set()

    def look(node: list, outer: frozenset[str]) -> None:
        key = node[0]
        if " " in key and key.split(" ")[0].split(".")[0] not in INLINE and key not in outer:
            held[key] = held.get(key, 0) + node[5]
            outer = outer | {key}
        if key.split(".")[0] in ("article", "main") and node[5] and not not_main_words(key):
            around.add(outer)
        for child in node[4]:
            look(child, outer)

    look(wrapper, frozenset())
    least = min(map(len, around), default=0)
    wraps = {key for outer in around if len(outer) == least for key in outer}
    return frozenset(wraps | {key for key, size in held.items() if 2 * size > wrapper[5]})


def main_size(node: list, named: frozenset[str]) -> int:
    """The characters of main text below a node."""
    if " " in node[0] and node[0] not in named:
        return 0
    return sum(main_size(n, named) for n in node[4]) if node[4] else node[2]


def main_path(wrapper: list) -> list[str]:
    """The keys from the root to the element that holds the main text."""
    path, node, named = [], wrapper, named_parts(wrapper)
    while True:
        inside = [n for n in flattened(node[4]) if n[0] != "#"]
        best = max(inside, key=lambda n: main_size(n, named), default=None)
        # A key met twice does not tell which of the elements is meant.
        if best is None or best[1] in "+*" or sum(n[0] == best[0] for n in inside) > 1:
            return path
        # Siblings with main text would be lost further down.
        size = main_size(best, named)
        if size < main_size(node, named) or not size:
            return path
        if all(n[0] == "#" for n in flattened(best[4])):
            return path  # a block by itself; its headings stand beside it
        path.append(best[0])
        node = best


def fixed_blocks(wrapper: list, named: frozenset[str]) -> frozenset[str]:
    """Digests of main text blocks that all pages of the host share, and are no slots.

    None if they make up most of the text: then the pages are copies of each other.
    """
    found = {key: size for key, (size, outer) in wrapper[7].items() if named.issuperset(outer)}
    if wrapper[6] < FEWEST_PAGES:
        return frozenset()
    if 2 * wrapper[6] * sum(found.values()) > main_size(wrapper, named):
        return frozenset()
    return frozenset(found)


def reading(wrapper: list) -> tuple[list[str], frozenset[str], frozenset[str]]:
    """What `main_text` takes from the wrapper."""
    named = named_parts(wrapper)
    return main_path(wrapper), named, fixed_blocks(wrapper, named)


def main_text(
    page: str, path: list[str], named: frozenset[str], fixed: frozenset[str] = frozenset()
) -> str:
    """The blocks below the path, or as far as the page goes along with it.

    Fixed ones are left out, but for headings between other blocks, and what comes right after a
    heading: all articles of a host may have a summary, or one author. A page that has nothing
    else keeps its fixed blocks.
    """
    node, outer = parse(page), ()
    for key in path:
        inside = [c for c in block_children(node) if isinstance(c, Element) and c.key == key]
        if len(inside) != 1:
            break
        outer = (*outer, node.key) if node.by_word else outer
        node = inside[0]
    found = [part for part in parts(node, outer) if named.issuperset(part.outer)]
    own = [n for n, part in enumerate(found) if digest(part.text, part.outer) not in fixed]
    if own and len(own) < len(found):
        between = range(own[0] + 1, own[-1])
        own += [n for n in between if found[n].heading or found[n - 1].heading]
        found = [found[n] for n in sorted(set(own))]
    return "\n\n".join(part.text for part in found)


class Part(NamedTuple):
    """A block of text, the keys of what is around it that words rule out, and whether it is a heading."""

    text: str
    outer: tuple[str, ...]
    heading: bool


def parts(element: Element, outer: tuple[str, ...] = ()) -> Iterator[Part]:
    """The blocks in page order, white space made one space, empty ones left out.

    The keys around a block come after `outer`.
    """
    open_block: list[str] = []
    heading = element.name in HEADINGS
    # Walked with a stack of its own, as markup can nest deeper than calls.
    todo: list = [element]
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            open_block.append(child)
            continue
        if isinstance(child, Element) and child.name in INLINE:
            if child.main:
                todo.extend([" "] if child.name == "br" else reversed(child.children))
            continue
        # A block begins, or one ends and leaves what was around it.
        text = SPACE.sub(" ", "".join(open_block)).strip()
        if text:
            yield Part(text, outer, heading)
        open_block.clear()
        if isinstance(child, tuple):
            outer, heading = child
        elif child.main or child.by_word:
            todo.append((outer, heading))
            outer = (*outer, child.key) if child.by_word else outer
            heading = heading or child.name in HEADINGS
            todo.extend(reversed(child.children))


def host_of(url: Column) -> Column:
    """The host in lower case, without port; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)
    return F.lower(host)


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host and wrapper (JSON), one row per host, from all its pages.

    Null and empty pages count as pages without text; pages without a host share the host ''. A page
    that is there twice is aligned twice, which changes no key. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = pages.select(
        host_of(col(url_col)).alias("host"), F.coalesce(col(html_col), F.lit("")).alias("html")
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, list] = {}
        for batch in in_slices(batches, "html"):
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                node = page_wrapper(page)
                own[host] = join_wrappers(own[host], node) if host in own else node
        yield from _rows(own)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, list] = {}
        for batch in batches:
            for host, text in zip(batch["host"].to_pylist(), batch["wrapper"].to_pylist()):
                node = json.loads(text)
                own[host] = join_wrappers(own[host], node) if host in own else node
        yield from _rows(own)

    schema = "host string, wrapper string"
    made = staged(rows.mapInArrow(partial, schema), "page-wrappers")
    # One row per host and task, in a set order so that a repeated run aligns alike. Written, so that
    # Spark knows the size when it plans the join with the pages.
    dealt = made.repartition("host").sortWithinPartitions("host", "wrapper")
    return staged(dealt.mapInArrow(whole, schema), "host-wrappers")


def _rows(wrappers: dict[str, list]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(wrappers), pa.string()),
            pa.array([json.dumps(w) for w in wrappers.values()], pa.string()),
        ],
        names=["host", "wrapper"],
    )


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, host, text.

    Blocks of the main text in page order, joined by two line ends; white space inside a block is
    one space. Blocks that all pages of a host share are left out where it has three pages with text
    or more, unless they are most of its main text, or all of the page's; headings between other
    blocks stay, and the block after a heading. A null or empty page has an empty text; pages without a host are
    aligned with each other. Repeated pages are extracted alike. Other columns are ignored; an empty table gives an
    empty result.
    """
    wrappers = infer_wrappers(pages, url_col, html_col)
    rows = pages.select(
        col(id_col).alias("page_id"),
        col(url_col).alias("url"),
        host_of(col(url_col)).alias("host"),
        F.coalesce(col(html_col), F.lit("")).alias("html"),
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, tuple] = {}
        for batch in in_slices(batches, "html"):
            texts = []
            for page, wrapper in zip(batch["html"].to_pylist(), batch["wrapper"].to_pylist()):
                if wrapper not in read:
                    read[wrapper] = reading(json.loads(wrapper))
                texts.append(main_text(page, *read[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], batch["host"], pa.array(texts, pa.string())],
                names=["page_id", "url", "host", "text"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.join(wrappers, "host").mapInArrow(
        extract, f"page_id {kind}, url string, host string, text string"
    )
