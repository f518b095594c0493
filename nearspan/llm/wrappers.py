"""Main text of web pages by union-free wrappers of their hosts.

A page is a stream of tags and texts.  Pages of a host share a template, so their streams are aligned
into one regular expression without unions: tags, text slots, optional groups and repeated groups.  A
mismatch is resolved in this order:

1. a text against another text becomes a text slot;
2. a run of one or several labels that repeats the run before it becomes a repeated group;
3. what only one side has becomes optional.

Wrappers are merged like pages, so the pages of a host are aligned in parallel, first within a task and
then in a tree over tasks; a wrapper is as long as its host's template, however many pages the host has.

A text slot keeps what its texts have in common over the host's pages: whether they are all the same, how
long they are, how much of them are links, and a sketch of the pages that have it.  A block is template if
its slots hold the same text on ``SUPPORT`` different pages, or if its text is links.  A page is matched to
the wrapper, and each of its texts goes by the verdict on its slot, by the elements and names around it, and
by the main regions of that page.  Where these would leave less than ``LEAST_SHARE`` of the page's text,
they decide nothing.  ``article`` and ``main`` are kept whole but for boilerplate by name.  References are
decoded, blank runs become one space, and blocks are joined by a newline.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.common import settle, whole
from nearspan.operators.sizing import broadcast_if_small

# Fixed values of HTML: elements without content, elements whose content is no markup, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section summary table tbody td tfoot th thead tr ul xmp br".split()
)
# What the parts around an article are called, as elements, roles, classes and ids.
AWAY_TAGS = frozenset("nav header footer aside button select menu dialog head input label fieldset".split()) | RAW
MAIN_TAGS = frozenset("article main".split())
AWAY_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent"
    " disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices"
    " pagination pager popup promo promoted promotion related replies reply respond share sharing sidebar signup"
    " social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
MAIN_NAMES = frozenset("article articlebody content entry main maincontent post postbody story".split())
# Words that name no part of their own: "sidebar-left" is a sidebar, "no-sidebar" and "has-comments" are not.
PLAIN_NAMES = frozenset(
    "area bar block bottom box button buttons col column container form global group holder inner item items left link"
    " links list outer page panel primary right row secondary section site text top wrap wrapper".split()
)
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")
# Where a raw element without an end tag ends.
_RAW_END = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK | {'head', 'html'}))})(?![A-Za-z0-9:-])", re.I)
_BLANKS = re.compile(r"\s+")
TEXT = "#"
GROUP = "*"
FAN = 64
# Labels of the longest repeated run, different pages that show a text to be constant, and shares of text.
PERIOD = 4
SUPPORT = 3
LINK_SHARE = 0.8
LEAST_SHARE = 0.25
# Blocks that are judged by their slots; headings, cells and the like go with the block that they are in.
JUDGED = frozenset("div section p ul ol dl table center details address".split())
# Containers that stand side by side keep a place each, unless more than RUN of one label do.
PLACED = frozenset("div section ul ol dl table center details address form".split())
RUN = 8
# Elements nested deeper become neighbours; no text is lost.
DEEPEST = 150


@lru_cache(maxsize=1 << 16)
def _label(tag: str, attributes: str) -> str:
    """A start tag with what matters of its attributes, numbers left out."""
    if not attributes.strip():
        return tag
    kept = []
    for m in _ATTRIBUTE.finditer(attributes):
        value, name = _split_camel(m[2] or m[3] or m[4] or ""), m[1].lower()
        if name in ("class", "id"):
            value = " ".join("-".join(_NAME.findall(whole_name)) for whole_name in value.split())
            kept.append(f"{name}={' '.join(value.split())}")
        else:
            kept.append(f"{name}={' '.join(_NAME.findall(value))}")
    return f"{tag} {' '.join(sorted(kept))}".strip()


def _split_camel(value: str) -> str:
    return re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()


def tokens(page: str) -> tuple[list[str], list[str]]:
    """The labels of a page's tokens, and beside each text token its characters.

    End tags are ``/tag``.  Comments and the content of scripts and the like are dropped, up to the next
    block if their end tag is missing; a ``<`` that starts no markup is text, as is all in an ``xmp``.
    """
    labels: list[str] = []
    texts: list[str] = []

    def text(part: str) -> None:
        if part:
            if labels and labels[-1] == TEXT:
                texts[-1] += part
            else:
                labels.append(TEXT)
                texts.append(part)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() < at:
            continue
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            labels.append("/" + tag)
            texts.append("")
            continue
        labels.append(_label(tag, m[3]))
        texts.append("")
        if tag in RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            block = None if close else _RAW_END.search(page, at)
            at = close.end() if close else block.start() if block else len(page)
        elif tag == "xmp" and (close := re.compile(r"</xmp\s*>", re.I).search(page, at)):
            text(page[at : close.start()].replace("&", "&amp;"))
            at = close.start()
    text(page[at:])
    return labels, texts


# What a start tag closes: the element before it, up to the container that holds both.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HOLDS = frozenset("article main body html section div aside nav header footer form table td th ul ol li dl".split())
PARTS = frozenset("article main body html".split())


class Node:
    """An element of a page or of a wrapper, a text (label ``#``), or a group of labels (label ``*...``).

    A text slot has the digest of its text (None if texts differ), its characters, those of them in links,
    and the least digests of the pages that have it.  ``sources`` and ``slot`` tie a page to a wrapper.
    """

    __slots__ = ("label", "tag", "children", "text", "repeated", "optional", "digest", "chars", "links", "pages", "sources", "slot", "template")

    def __init__(self, label: str, text: str = "") -> None:
        self.label, self.tag, self.text = label, _tag(label), text
        self.children: list[Node] = []
        self.repeated = self.optional = self.template = False
        self.digest: int | None = None
        self.chars = self.links = 0
        self.pages: list[int] = []
        self.sources: list[Node] = []
        self.slot: Node | None = None


@lru_cache(maxsize=1 << 16)
def _tag(label: str) -> str:
    return label.partition(" ")[0]


def tree(page: str) -> Node:
    """The page's tokens, nested; elements that lack an end are closed where their neighbours show it."""
    root = Node("")
    stack = [root]

    def close(tags: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in tags:
                del stack[depth:]
                return
            if tag in walls:
                return

    for label, text in zip(*tokens(page)):
        if label == TEXT:
            stack[-1].children.append(Node(TEXT, text))
        elif label[0] == "/":
            tag = label[1:]
            walls = PARTS if tag in HOLDS else HOLDS if tag in BLOCK else BLOCK
            close({tag}, () if tag in PARTS else walls - {tag})
        else:
            tag = label.partition(" ")[0]
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in BLOCK and tag != "br":
                close({"p"}, HOLDS)
            node = Node(label)
            stack[-1].children.append(node)
            if tag not in VOID and tag not in RAW and len(stack) < DEEPEST:
                stack.append(node)
    return root


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=6).digest(), "little")


def page_digest(node: Node) -> int:
    """A digest of all texts of a page."""
    parts: list[str] = []

    def walk(node: Node) -> None:
        if node.label == TEXT:
            parts.extend(node.text.split())
        for child in node.children:
            walk(child)

    walk(node)
    return digest(" ".join(parts))


def fold(node: Node, page: int = 0, linked: bool = False, keep: bool = False) -> Node:
    """The element as a wrapper: runs that repeat become a repeated group, texts become slots.

    With ``keep`` the parts of the wrapper know the nodes that they come from.
    """
    out = Node(node.label)
    out.sources = [node] if keep else []
    linked = linked or node.tag == "a"
    for child in node.children:
        if child.label == TEXT:
            text = " ".join(child.text.split())
            if not text:
                continue
            part = Node(TEXT)
            part.digest, part.chars, part.links, part.pages = digest(text), len(text), len(text) * linked, [page]
            part.sources = [child] if keep else []
        else:
            part = fold(child, page, linked, keep)
        _append(out.children, part)
    out.children = _grouped(_bounded(out.children))
    return out


def _bounded(parts: list[Node]) -> list[Node]:
    """The parts with every run of more than ``RUN`` of one label as one repeated group."""
    if len(parts) <= RUN:
        return parts
    out: list[Node] = []
    for label, run in groupby(parts, key=lambda p: p.label):
        run = list(run)
        if len(run) > RUN:
            first = run[0]
            for part in run[1:]:
                first = _merged(first, part)
            first.repeated = True
            run = [first]
        out += run
    return out


def _append(parts: list[Node], part: Node) -> None:
    if parts and parts[-1].label == part.label and part.tag not in PLACED:
        last = _merged(parts[-1], part)
        last.repeated = last.repeated or part.label != TEXT
    else:
        parts.append(part)


def _group(parts: list[Node]) -> Node:
    group = Node(GROUP + "|".join(p.label for p in parts))
    group.children = parts
    return group


def _grouped(parts: list[Node]) -> list[Node]:
    """The parts with every run of several labels that repeats at once as one repeated group."""
    labels = [p.label for p in parts]
    if len(set(labels)) > len(labels) - 2:
        # A run of several labels stands twice only if two labels do.
        return parts
    out, at = [], 0
    while at < len(parts):
        for n in range(2, PERIOD + 1):
            run = labels[at : at + n]
            if at + 2 * n <= len(parts) and len(set(run)) > 1 and run == labels[at + n : at + 2 * n]:
                group = _group(parts[at : at + n])
                at += n
                while labels[at : at + n] == [c.label for c in group.children]:
                    group = _merged(group, _group(parts[at : at + n]))
                    at += n
                group.repeated = True
                out.append(group)
                break
        else:
            out.append(parts[at])
            at += 1
    return out


def _regrouped(parts: list[Node], groups: dict[str, list[str]]) -> list[Node]:
    """The parts with every run that has the labels of one of the groups as that group."""
    out: list[Node] = []
    at = 0
    while at < len(parts):
        for labels in groups.values():
            if [p.label for p in parts[at : at + len(labels)]] == labels:
                _append(out, _group(parts[at : at + len(labels)]))
                at += len(labels)
                break
        else:
            _append(out, parts[at])
            at += 1
    return out


def _groups(parts: list[Node]) -> dict[str, list[str]]:
    found = {p.label: [c.label for c in p.children] for p in parts if p.label.startswith(GROUP)}
    return dict(sorted(found.items(), key=lambda g: (-len(g[1]), g[0])))


def _traits(node: Node) -> set:
    """The labels in a node and its texts that are the same on all pages."""
    found, rest = set(), [node]
    while rest:
        at = rest.pop()
        found.add(at.label if at.digest is None else at.digest)
        rest += at.children
    return found


def _pairs(a: list[Node], b: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Both lists in one order; what matches by a heaviest common subsequence of the labels is paired.

    Of equally many pairs those with most texts and labels in common are preferred, then those with parts
    of ``b`` that are not optional.
    """
    n, m = len(a), len(b)
    doubled = len({x.label for x in a}) < n or len({x.label for x in b}) < m
    left, right = ([_traits(x) for x in side] if doubled else [] for side in (a, b))

    def weight(i: int, j: int) -> int:
        return 1_000_000 + 2 * (len(left[i] & right[j]) if doubled else 0) + (not b[j].optional)

    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1])
            if a[i].label == b[j].label:
                best[i][j] = max(best[i][j], best[i + 1][j + 1] + weight(i, j))
    i = j = 0
    while i < n or j < m:
        both = i < n and j < m and a[i].label == b[j].label
        if both and best[i][j] == best[i + 1][j + 1] + weight(i, j):
            yield a[i], b[j]
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            yield a[i], None
            i += 1
        else:
            yield None, b[j]
            j += 1


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """One list of both: what matches is merged, what only one side has becomes optional."""
    if [x.label for x in a] == [x.label for x in b]:
        return [_merged(x, y) for x, y in zip(a, b)]
    groups = _groups(a + b)
    if groups:
        a, b = _regrouped(a, groups), _regrouped(b, groups)
    out: list[Node] = []
    for x, y in _pairs(a, b):
        if x is not None and y is not None:
            part = _merged(x, y)
        else:
            part = x if x is not None else y
            part.optional = True
        _append(out, part)
    return _bounded(out)


def _merged(a: Node, b: Node) -> Node:
    a.children = align(a.children, b.children)
    a.repeated, a.optional = a.repeated or b.repeated, a.optional or b.optional
    a.sources += b.sources
    if a.label == TEXT:
        a.digest = a.digest if a.digest == b.digest else None
        a.chars, a.links = a.chars + b.chars, a.links + b.links
        if a.pages != b.pages:
            a.pages = sorted({*a.pages, *b.pages})[:SUPPORT]
    return a


def pack(node: Node) -> list:
    packed = [node.label, int(node.repeated) + 2 * int(node.optional), [pack(c) for c in node.children]]
    return [*packed, node.digest, node.chars, node.links, node.pages] if node.label == TEXT else packed


def unpack(packed: list) -> Node:
    node = Node(packed[0])
    node.repeated, node.optional = bool(packed[1] & 1), bool(packed[1] & 2)
    node.children = [unpack(c) for c in packed[2]]
    if node.label == TEXT:
        node.digest, node.chars, node.links, node.pages = packed[3:]
    return node


def _names(label: str) -> tuple[set[str], set[str], str]:
    names, roles, rest = set(), set(), ""
    for part in re.findall(r"([a-z-]+)=([^=]*)(?= [a-z-]+=|$)", label.partition(" ")[2]):
        if part[0] in ("class", "id"):
            names |= set(part[1].split())
        elif part[0] == "role":
            roles |= set(part[1].split())
        else:
            rest += f" {part[0]}={part[1]}"
    return names, roles, rest


def _away_name(name: str) -> bool:
    """Whether a class or id as a whole names what stands around an article."""
    words = set(name.split("-"))
    if "header" in words and words & MAIN_NAMES:
        return False
    return bool(words & AWAY_NAMES) and words <= AWAY_NAMES | MAIN_NAMES | PLAIN_NAMES


def _region(label: str) -> bool:
    """Whether an element is a main region by its tag or role."""
    return label.partition(" ")[0] in MAIN_TAGS or (" role=" in label and "main" in _names(label)[1])


def kind(label: str) -> int:
    """1 for the begin of a main region, -1 for boilerplate, -2 for what only a name or a form makes so, else 0."""
    tag = label.partition(" ")[0]
    names, roles, rest = _names(label) if " " in label else (set(), set(), "")
    hidden = " hidden=" in rest or "aria-hidden=true" in rest or "display none" in rest
    if tag in AWAY_TAGS or hidden or roles & AWAY_ROLES:
        return -1
    if _region(label):
        return 1
    if tag in ("body", "html"):
        return 0
    away = [name for name in names if _away_name(name)]
    if tag == "form" or away:
        return -2
    return int(any(MAIN_NAMES & set(name.split("-")) for name in names))


def _judge(node: Node) -> tuple[int, int, bool]:
    """Marks the template's blocks; characters, those in links, and whether all texts are constant."""
    if node.label == TEXT:
        return node.chars, node.links, node.digest is not None and len(node.pages) >= SUPPORT
    below = [_judge(child) for child in node.children]
    chars, links = sum(b[0] for b in below), sum(b[1] for b in below)
    constant = all(b[2] for b in below)
    if chars and node.tag in JUDGED:
        node.template = constant or (node.tag != "p" and links >= LINK_SHARE * chars)
    return chars, links, constant


def _match(part: Node, slot: Node) -> None:
    """Ties the nodes of a page's folded part to the slots of the wrapper's."""
    for node in part.sources:
        node.slot = slot
    parts = part.children
    if [p.label for p in parts] == [s.label for s in slot.children]:
        for pair in zip(parts, slot.children):
            _match(*pair)
        return
    groups = _groups(slot.children)
    for x, y in _pairs(_regrouped(parts, groups) if groups else parts, slot.children):
        if x is not None and y is not None:
            _match(x, y)


class Wrapper:
    """A host's wrapper with every slot judged."""

    def __init__(self, root: Node) -> None:
        self.root = root
        self.kinds: dict[str, int] = {}
        _judge(root)

    def kind(self, label: str) -> int:
        if label not in self.kinds:
            self.kinds[label] = kind(label)
        return self.kinds[label]

    def extract(self, page: str) -> str:
        """The text of a page's main slots."""
        root = tree(page)
        _match(fold(root, keep=True), self.root)
        # Texts and, as None, the borders of blocks; beside a text if it is in a main region, if it is template, and
        # its characters without blanks.
        stream: list[tuple[str, bool, bool, int] | None] = []
        inner: dict[int, tuple[int, bool]] = {}

        def weigh(node: Node, free: bool, region: bool) -> tuple[int, int, bool]:
            """Characters of no template, those of them in regions that no name takes away, and if there is a region."""
            size, shown, found = 0, 0, False
            for child in node.children:
                if child.label == TEXT:
                    n = child.chars = len("".join(child.text.split()))
                    size, shown = size + n, shown + n * (free and region)
                    continue
                sort = self.kind(child.label)
                if sort == -1 or (child.tag == "noscript" and not region):
                    continue
                own = _region(child.label)
                if child.slot is not None and child.slot.template and not (region or own):
                    continue
                below = weigh(child, free and sort != -2, region or own)
                if sort == -2:
                    inner[id(child)] = below[0], below[2]
                size, shown, found = size + below[0], shown + below[1], found or below[2] or (own and below[0] > 0)
            return size, shown, found

        size, shown, _ = weigh(root, True, False)
        clear = shown > 0 and shown >= LEAST_SHARE * size

        def sorted_as(child: Node, main: bool) -> int:
            """The kind of an element; a name takes away no region, and not most of a page without a clear one."""
            if child.tag == "noscript" and not main:
                return -1
            sort = self.kind(child.label)
            if sort == -2 and not clear:
                n, found = inner.get(id(child), (0, False))
                return 0 if found or 2 * n > size else sort
            return sort

        def walk(node: Node, main: bool, template: bool, held: bool) -> None:
            for child in node.children:
                if child.label == TEXT:
                    stream.append((child.text, main, template, child.chars or len("".join(child.text.split()))))
                    continue
                sort = sorted_as(child, main)
                block = child.tag in BLOCK
                if block:
                    stream.append(None)
                if sort >= 0:
                    whole_region = held or _region(child.label)
                    judged = child.slot is not None and child.slot.template
                    walk(child, main or sort == 1, not whole_region and (template or judged), whole_region)
                if block:
                    stream.append(None)

        walk(root, False, False, False)

        def chars(texts) -> int:
            return sum(t[3] for t in texts)

        texts = [t for t in stream if t is not None]
        content = [t for t in texts if not t[2]]
        by_slot = chars(content) >= LEAST_SHARE * chars(texts)
        inside = [t for t in (content if by_slot else texts) if t[1]]
        n_inside = chars(inside)
        by_region = n_inside > 0 and n_inside >= LEAST_SHARE * chars(content if by_slot else texts)
        blocks: list[str] = []
        parts: list[str] = []
        for item in [*stream, None]:
            if item is not None:
                if (item[1] or not by_region) and not (item[2] and by_slot):
                    parts.append(item[0])
                continue
            line = _BLANKS.sub(" ", entities.unescape("".join(parts))).strip()
            if line:
                blocks.append(line)
            parts.clear()
        return "\n".join(blocks)


def _merge_rows(rows: Iterator[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, Node] = {}
    for host, packed in rows:
        node = unpack(json.loads(packed))
        out[host] = _merged(out[host], node) if host in out else node
    return {host: json.dumps(pack(node)) for host, node in out.items()}


def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` of ``host, html``; a wrapper is JSON.

    A task folds its pages into one wrapper per host; equal pages are aligned once.  The tasks'
    wrappers of a host are then merged in groups of about ``FAN``, level by level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}
        seen: set[int] = set()
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                mark = hash((host, page))
                if mark not in seen:
                    seen.add(mark)
                    root = tree(page)
                    node = fold(root, page_digest(root))
                    held[host] = _merged(held[host], node) if host in held else node
        packed = [json.dumps(pack(node)) for node in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(packed, pa.string())], ["host", "wrapper"])

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("host").to_pylist(), table.column("wrapper").to_pylist()))
        merged = _merge_rows(iter(rows))
        return pa.table([pa.array(list(merged), pa.string()), pa.array(list(merged.values()), pa.string())], ["host", "wrapper"])

    wrappers = settle(pages.select("host", "html").mapInArrow(run, "host string, wrapper string"), "wrappers")
    while True:
        most = wrappers.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return wrappers
        groups = -(-most // FAN)
        salted = wrappers.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(groups)))
        wrappers = settle(salted.groupBy("host", "part").applyInArrow(merge, "host string, wrapper string"), "wrappers")


def main_texts(pages: DataFrame) -> DataFrame:
    """Every row with ``main_text``, the main text of its ``html``, by the wrapper of the host of its ``url``.

    Pages without a url or a host in it share one wrapper.  A null or empty page has an empty text.
    Repeated rows give repeated rows.  A column ``main_text`` is replaced; ``_host`` and ``_wrapper``
    are reserved.
    """
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.drop("main_text").withColumn("_host", F.coalesce(host, F.lit("")))
    wrappers = infer(rows.select(F.col("_host").alias("host"), whole("html").alias("html")))
    wrappers = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    joined = rows.join(broadcast_if_small(wrappers), "_host", "left")

    @F.arrow_udf("string")
    def extract(html: pa.Array, packed: pa.Array) -> pa.Array:
        known: dict[str, Wrapper] = {}
        out = []
        for page, text in zip(html.to_pylist(), packed.to_pylist()):
            if text not in known:
                known[text] = Wrapper(unpack(json.loads(text)))
            out.append(known[text].extract(page))
        return pa.array(out, pa.string())

    return joined.withColumn("main_text", extract(whole("html"), "_wrapper")).drop("_host", "_wrapper")


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = main_texts(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))
