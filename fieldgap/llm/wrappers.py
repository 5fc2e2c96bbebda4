"""Main text by wrappers: union-free regular expressions inferred from pages of one host.

A page is a stream of tokens: tags (with class, id and role) and texts. Inside a page, equal
neighbouring groups of a parent are folded into repeated groups. The first page's stream is the
wrapper; every further page is aligned with it. Where texts differ the wrapper gets a text slot;
where tags differ, what only one side has becomes an optional group, and a group that continues the
one before it becomes a repeated group. The result has no alternatives.

The wrapper says which subtrees every page has, which are optional or repeated and how much text and
link text their slots hold over all pages. Subtrees whose tags, roles or class names stand for menus,
headers, footers, notices, adverts, forms or comments are left out. The article is the subtree marked as such, or,
where pages mark none, the subtree whose slots hold the most text outside links. Pages are then
matched with the wrapper and the text of the article's blocks is read. Elements inside the article that
the wrapper met with one and the same content on at least `TELLING` different pages are the template's and
are left out, whatever their names, unless they hold most of the host's text. Numbers in ids, page numbers
in classes and all names of html and body are no part of a sign, since they differ from page to page.

Pages of a host are dealt to groups of about `GROUP` by a hash, each with a wrapper of its own, so a host
with a third of all pages is many tasks and a task holds one group. All pages are read whole.

Defined cases: null or empty html gives empty text; a page that is alone on its host is its own
wrapper; broken markup ends open elements where their parent ends; nesting may be of any depth, since all
walks keep stacks of their own; hosts are compared lower-cased; an empty table gives none.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches, written
from fieldgap.llm.url_rules import host_of

#: Pages that one wrapper is inferred from.
GROUP = 64
#: Different pages on which an element has the same content before it counts as the template's.
TELLING = 8

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre section table ul li dd dt tr td th".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Elements that an end tag of something outside them does not end.
SCOPE = frozenset(["article", "main", "section", "div", "td", "th", "table", "body", "html"])
DROPPED_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe svg math button select option textarea input dialog menu "
    "head title object embed audio video canvas map".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored promo promotion nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar banner cookie cookies consent gdpr "
    "notice notices popup modal overlay alert subscribe subscription newsletter signup login share sharing social related "
    "recommended comment comments commentlist reply replies disqus respond form search pagination pager toolbar skip".split()
)
ARTICLE_NAMES = frozenset("article post entry story content main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
NAME = re.compile("[a-z0-9]+")


@dataclass
class Node:
    """An element, or a text where `tag` is empty."""

    tag: str
    names: tuple[str, ...] = ()
    role: str = ""
    children: list[Node] = field(default_factory=list)
    text: str = ""
    #: Stands for all that is inside; set where the page's wrapper is made.
    whole: int = 0

    @property
    def sign(self) -> tuple:
        return (self.tag, self.names, self.role)


def parse(page: str) -> Node:
    """The page's tree; ends that markup leaves out are put where their parent ends."""
    root = Node("")
    stack, at, size = [root], 0, len(page)
    # For each open element the innermost one, from it outwards, that is not inline.
    blocks = [""]

    def put_text(raw: str) -> None:
        if raw:
            stack[-1].children.append(Node("", text=raw))

    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            put_text(page[at:])
            break
        put_text(page[at : found.start()])
        at = found.end()
        closing, tag, rest = found.group(1), found.group(2), found.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:], blocks[depth:]
                    break
                if stack[depth].tag in SCOPE and tag not in SCOPE:
                    break
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(blocks[-1], ()):
            while stack.pop().tag in INLINE:
                pass
            del blocks[len(stack) :]
        node = Node(tag, *attributes(tag, rest))
        stack[-1].children.append(node)
        if tag in RAW and not rest.rstrip().endswith("/"):
            end = re.compile(f"</{tag}(?=[\\s>/])[^>]*>?", re.IGNORECASE).search(page, at)
            if tag in ("textarea", "title"):
                node.children.append(Node("", text=page[at : end.start() if end else size]))
            at = end.end() if end else size
        elif tag not in VOID:
            stack.append(node)
            blocks.append(blocks[-1] if tag in INLINE else tag)
    return root


def attributes(tag: str, raw: str) -> tuple[tuple[str, ...], str]:
    """Names from class and id, without what numbers a page, and the role."""
    names, role = [], ""
    for key, a, b, c in ATTRIBUTE.findall(raw) if raw else ():
        value, key = (a or b or c).lower(), key.lower()
        if key == "role":
            role = value.strip()
        elif key in ("hidden", "aria-hidden"):
            if value != "false" and (key == "hidden" or value == "true"):
                names.append("hidden")
        elif tag not in ("html", "body"):
            # Short numbers in classes tell columns of a layout apart.
            least = 1 if key == "id" or tag in ("article", "main") else 3
            names += [n for n in NAME.findall(value) if not (n.isdigit() and len(n) >= least)]
    return tuple(names), role


def dropped(node: Node, inside: bool) -> bool:
    """Whether an element stands for something that is not main text."""
    if node.tag in DROPPED_TAGS or node.role in DROPPED_ROLES or "hidden" in node.names:
        return True
    if node.tag == "header" and not inside:
        return True
    if node.tag in ("article", "main", "body", "html"):
        return False
    names = DROPPED_NAMES - {"header", "banner", "related", "form", "aside", "alert"} if inside else DROPPED_NAMES
    return any(n in names for n in node.names) and not (inside and node.tag in ("h1", "h2", "h3", "p", "b", "i", "em", "strong"))


# Wrappers


@dataclass
class Part:
    """A subtree of the wrapper.

    `pages` counts pages that have it; it is optional where its parent has more. `times` is 1, or more
    where it repeats. `text` and `linked` are the characters its slots held, in links or not, `constant`
    the one text all pages had; `whole` stands for the one content of an element that all pages had.
    """

    sign: tuple
    children: list[Part] = field(default_factory=list)
    pages: int = 1
    repeated: bool = False
    text: int = 0
    linked: int = 0
    constant: str | None = None
    whole: int | None = None


def done(walk: Generator) -> object:
    """The result of a walk that yields the walks it waits for: a stack on the heap, so depth has no bound."""
    stack, result = [walk], None
    while stack:
        try:
            stack.append(stack[-1].send(result))
            result = None
        except StopIteration as end:
            stack.pop()
            result = end.value
    return result


def folding(parts: list[Part]) -> Generator:
    """Make equal neighbours, and equal neighbouring groups of up to three, one repeated group."""
    for width in (1, 2, 3):
        out: list[Part] = []
        for part in parts:
            out.append(part)
            while len(out) >= 2 * width and all(out[-1 - i].sign == out[-1 - i - width].sign for i in range(width)):
                last = out[-width:]
                del out[-width:]
                for kept, again in zip(out[-width:], last, strict=True):
                    merged = yield aligning(kept, again, same_page=True)
                    kept.children, kept.text, kept.linked = merged.children, merged.text, merged.linked
                    kept.constant, kept.whole, kept.repeated = merged.constant, merged.whole, True
        parts = out
    return parts


def wrapper_of(node: Node, in_link: bool = False) -> Part:
    """The wrapper of one page."""
    return done(wrapping(node, in_link))


def wrapping(node: Node, in_link: bool) -> Generator:
    if not node.tag and node.text:
        words = node.text.split()
        n, node.whole = len(words), hash(tuple(words))
        return Part(("#text", (), ""), text=0 if in_link else n, linked=n if in_link else 0, constant=node.text, whole=node.whole)
    children, inside = [], [node.sign]
    for c in node.children:
        if c.tag or c.text.strip():
            children.append((yield wrapping(c, in_link or c.tag == "a")))
            inside.append(c.whole)
    node.whole = hash(tuple(inside))
    return Part(node.sign, (yield folding(children)) if len(children) > 1 else children, whole=node.whole)


def align(a: Part, b: Part) -> Part:
    """The wrapper of two: equal signs meet, what only one has is optional, differing texts are slots."""
    return done(aligning(a, b))


def aligning(a: Part, b: Part, same_page: bool = False) -> Generator:
    pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    joined = Part(a.sign, [], pages, a.repeated or b.repeated, a.text + b.text, a.linked + b.linked)
    joined.constant = a.constant if a.constant == b.constant else None
    joined.whole = a.whole if a.whole == b.whole else None
    left, right = [c.sign for c in a.children], [c.sign for c in b.children]
    if left == right:
        for x, y in zip(a.children, b.children, strict=True):
            joined.children.append((yield aligning(x, y, same_page)))
        return joined
    i = j = 0
    merged: list[Part] = []
    for x, y, n in SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks():
        merged += a.children[i:x] + b.children[j:y]
        for p, q in zip(a.children[x : x + n], b.children[y : y + n], strict=True):
            merged.append((yield aligning(p, q, same_page)))
        i, j = x + n, y + n
    joined.children = yield folding(merged)
    return joined


def inner_texts(wrapper: Part) -> dict[int, tuple[int, int]]:
    """Words outside and inside links of every part, by the part's identity."""
    order = [wrapper]
    for part in order:
        order.extend(part.children)
    found: dict[int, tuple[int, int]] = {}
    for part in reversed(order):
        below = [found[id(c)] for c in part.children]
        found[id(part)] = (part.text + sum(t for t, _ in below), part.linked + sum(k for _, k in below))
    return found


def as_node(sign: tuple) -> Node:
    return Node(*sign)


def article_path(wrapper: Part) -> list[tuple]:
    """Signs from the root to the part that is the article; empty for the whole page."""
    words = inner_texts(wrapper)
    # Paths are (depth, sign, path above), so that deep ones share what they have in common.
    best_mark, marked = (0, 0), None
    stack = [(c, None) for c in reversed(wrapper.children)]
    while stack:
        part, above = stack.pop()
        if part.sign[0] == "#text" or dropped(as_node(part.sign), False):
            continue
        depth = above[0] + 1 if above else 1
        here = (depth, part.sign, above)
        rank = 3 if part.sign[0] == "article" else 2 if part.sign[0] == "main" or part.sign[2] in ("main", "article") else 0
        rank = rank or (1 if part.sign[0] in ("div", "section") and ARTICLE_NAMES & set(part.sign[1]) else 0)
        if rank and (marked is None or (rank * 10**9 + words[id(part)][0], -depth) > best_mark):
            best_mark, marked = (rank * 10**9 + words[id(part)][0], -depth), here
        stack += [(c, here) for c in reversed(part.children)]
    if marked:
        signs = []
        while marked:
            signs.append(marked[1])
            marked = marked[2]
        return signs[::-1]
    path, here = [], wrapper
    while True:
        rated = []
        for c in here.children:
            if c.sign[0] != "#text" and not dropped(as_node(c.sign), False):
                text, linked = words[id(c)]
                rated.append((text - linked, c))
        best = max(rated, key=lambda r: r[0], default=(0, None))
        own = sum(words[id(c)][0] for c in here.children)
        # Go down while one block holds nearly all text; several blocks of text are the article's own.
        if best[1] is None or best[1].sign[0] not in ("html", "body", "div", "section", "table", "tbody", "tr", "td", "center") or best[0] < 0.7 * own:
            return path
        path.append(best[1].sign)
        here = best[1]


def regions(root: Node, path: list[tuple]) -> list[Node]:
    """Elements of a page on the wrapper's path; a page that leaves it yields what it marks itself."""
    found = [root]
    for sign in path:
        below = [c for n in found for c in n.children if c.sign == sign]
        if not below:
            return []
        found = below
    return found


# Text


def parts_at(wrapper: Part, path: list[tuple]) -> list[Part]:
    """The wrapper's parts on a path."""
    found = [wrapper]
    for sign in path:
        found = [c for p in found for c in p.children if c.sign == sign]
    return found


def of_template(part: Part) -> bool:
    """Whether an element had one content on enough pages; inline ones belong to a sentence."""
    return part.whole is not None and part.pages >= TELLING and part.sign[0] != "#text" and part.sign[0] not in INLINE


def block_texts(region: Node, parts: list[Part]) -> list[str]:
    """Texts of blocks in page order: references decoded, white space made one, nothing else changed.

    Elements that `parts`, the wrapper's view of the region, know as the template's are left out.
    """
    blocks: list[list[str]] = [[]]

    # Open elements: what is left of their children, whether their end ends a block, and their parts.
    stack = [(iter(region.children), False, parts)]
    while stack:
        c = next(stack[-1][0], None)
        if c is None:
            if stack.pop()[1]:
                blocks.append([])
        elif not c.tag:
            blocks[-1].append(c.text)
        elif c.tag in VOID:
            if c.tag in ("br", "wbr", "img"):
                blocks[-1].append(" " if c.tag == "br" else "")
            else:
                blocks.append([])
        elif not dropped(c, True):
            below = [q for p in stack[-1][2] for q in p.children if q.sign == c.sign]
            if any(q.whole == c.whole and of_template(q) for q in below):
                blocks.append([])
                continue
            if c.tag not in INLINE:
                blocks.append([])
            stack.append((iter(c.children), c.tag not in INLINE, below))
    texts = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return [t for t in texts if t]


def main_texts(pages: list[str | None]) -> list[str]:
    """Main texts of pages of one host."""
    # Equal pages are one: they tell nothing about the template.
    parsed = {p: parse(p) for p in dict.fromkeys(pages) if p}
    wrapper: Part | None = None
    for tree in parsed.values():
        own = wrapper_of(tree)
        wrapper = own if wrapper is None else align(wrapper, own)
    if wrapper is None:
        return ["" for _ in pages]
    path = article_path(wrapper)
    places = {}
    for p, tree in parsed.items():
        found = regions(tree, path)
        own_path = path if found else article_path(wrapper_of(tree))
        places[p] = (found or regions(tree, own_path), parts_at(wrapper, own_path))

    def read(cut: bool) -> dict[str, str]:
        return {p: "\n".join(t for r in found for t in block_texts(r, parts if cut else [])) for p, (found, parts) in places.items()}

    texts = read(True)
    below = list(parts_at(wrapper, path))
    for part in below:
        below.extend(part.children)
    if any(map(of_template, below)):
        uncut = read(False)
        # Where most of the text is the same everywhere, the pages are copies, not a template with contents.
        if 2 * sum(len(t) for t in texts.values()) < sum(len(t) for t in uncut.values()):
            texts = uncut
    return [texts[p] if p else "" for p in pages]


def main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", group: int = GROUP
) -> DataFrame:
    """(id, url, text), one row per row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of (host, part): a wrapper is inferred from each run, at most twice `group`."""
        held: list[tuple] = []

        def read() -> pa.RecordBatch:
            texts = main_texts([r[4] for r in held])
            done = pa.RecordBatch.from_arrays(
                [pa.array([r[2] for r in held], pa.int64()), pa.array([r[3] for r in held], pa.string()), pa.array(texts, pa.string())],
                ["id", "url", "text"],
            )
            held.clear()
            return done

        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (held[-1][:2] != row[:2] or len(held) >= 2 * group):
                    yield read()
                held.append(row)
        if held:
            yield read()

    keyed = pages.select(
        host_of(F.col(url_column)).alias("host"),
        F.col(id_column).cast("long").alias("id"),
        F.col(url_column).alias("url"),
        F.col(html_column).alias("html"),
    )
    large = (
        keyed.groupBy("host").count().where(F.col("count") > group)
        .select("host", F.ceil(F.col("count") / group).alias("parts"))
    )
    # Written first: where few hosts are large, their list is broadcast and pages are shuffled once.
    dealt = keyed.join(written(large, "large-hosts"), "host", "left").select(
        "host", F.pmod(F.xxhash64("id", "url"), F.coalesce("parts", F.lit(1))).alias("part"), "id", "url", "html"
    )
    return bounded_batches(
        dealt.repartition("host", "part").sortWithinPartitions("host", "part", "id", "url")
    ).mapInArrow(batches, "id long, url string, text string")
