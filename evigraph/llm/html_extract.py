"""Main text of web pages by inferred wrappers (operator 7).

The wrapper of a host is a union-free regular expression over the block structure of its pages: elements, text slots,
optional and repeated groups. Within a page, adjacent siblings of one label and squares of siblings become repeated
groups. Pages of a host, all of them, are then aligned one after another: texts that differ become slots, items
without a counterpart become optional. A list of siblings with more than WIDE items becomes one repeated group of its
distinct items, each optional, so a wrapper grows with the labels of a host and not with its pages. Wrappers of pages are aligned in
groups of about FAN, chosen and ordered by a digest of the wrappers, until a host has one: what comes of a host depends on
its pages only, not on how they are partitioned.

The wrapper tells a host's content from its own texts. The content element is the deepest one that still holds nine
tenths of the text in slots; alternatives that exclude each other on pages (templates) each give one; an ``article`` or
``main`` around it, or a parent with the heading, is taken in its place. Texts that stay equal on more than half of a
host's pages, three at least, are the host's own: they go from the content if they are at most a fifth of it.

A page's text is that of its host's content element, the heaviest that it has, without elements that by tag, role, class or id hold no
article text (see ``part``); an element named after what is in it (``has-sidebar``) that holds the page's content stays (see
``prune``). A page without a host is its own host. If a page has no content element, its
article, main or body is taken. A null or empty page gives an empty text. Quotes that never close do not hide the end
of a tag. Elements over DEPTH deep count as part of the one they are in. Repeated rows are read one by one.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from difflib import SequenceMatcher

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from .arrow import bounded_batches, column, released, with_computed
from .storage import written

#: Wrappers that one group aligns, about.
FAN = 64
#: Siblings of a wrapper's element, beyond which they are one repeated group of distinct items.
WIDE = 48
DEPTH = 100
#: Wrapper text that may be broadcast, in characters; more is joined by a shuffle.
BROADCAST_CHARS = 16 << 20

# Fixed lists of the markup language and of common names of page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = set("script style noscript template iframe svg math object canvas audio video head title textarea".split())
DROPPED = RAW | set("nav header footer aside form button select option menu dialog fieldset input".split())
CONTENT = ("article", "main")
_PART_WORDS = (
    r"(?:nav|navbar|navigation|menu|sidebar|side-bar|aside|footer|header|masthead|banner|ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|cookie|cookies|consent|notice|notices|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|breadcrumb|breadcrumbs|pagination|pager|comment|comments|respond|disqus|widget|toolbar|copyright|skip)"
)
#: A class or id that is such a word, and one that has it among others (``has-sidebar``, ``content-header``).
PARTS, AMONG = re.compile(rf"(?:^|\s){_PART_WORDS}(?:$|\s)", re.I), re.compile(rf"(?:^|[\s_-]){_PART_WORDS}(?:$|[\s_-])", re.I)
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
TEXTUAL = set("p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 pre blockquote table thead tbody tfoot tr td th figure figcaption br".split())
HEADINGS = ("h1", "h2")
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SIBLING_BARS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<(?:/?[a-zA-Z][^>]*)\Z|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


def tokens(page: str):
    """(kind, name, attributes or text) of a page: kind is open, close or text; raw elements hold no text."""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        close, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if name is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                yield "text", "", m[0]
            continue
        name = name.lower()
        if close:
            yield "close", name, ""
            continue
        yield "open", name, rest
        if name in RAW and name not in ("head", "svg", "math") and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            at = end.start() if end else n


#: What an element may be: content, a part by its name, or by a class among other words; or a part whatever is in it.
PLAIN, AMONGST, NAMED, HARD = range(4)


def part(name: str, attributes: str, within: bool) -> int:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form, script or comment list: by its tag or role (HARD),
    or by its class or id, which also containers have that are named after what is in them. The header of an article (``within``) is
    no part."""
    if name in DROPPED and not (name == "header" and within):
        return HARD
    if not attributes or name in ("html", "body", *CONTENT):
        return PLAIN
    found = PLAIN
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in ROLES:
            return HARD
        if key in ("class", "id"):
            found = max(found, NAMED if PARTS.search(value) else AMONGST if AMONG.search(value) else PLAIN)
    return found


def label(name: str, attributes: str) -> str:
    """An element's name with its first class or id; numbers in it are all alike."""
    for key, value in _ATTRIBUTE.findall(attributes or ""):
        first = value.strip("\"'").split()
        if key.lower() in ("class", "id") and first:
            return f"{name}.{re.sub(r'[0-9]+', '#', first[0]).replace('/', '')}"
    return name


class Node:
    """A block element: its label, what it may be (see ``part``) and, in order, its blocks of text and the elements in it."""

    __slots__ = ("label", "items", "part")

    def __init__(self, label: str, part: int = PLAIN):
        self.label, self.part = label, part
        self.items: list[Node | str] = []


class Tree:
    """Builds the blocks of a page; missing end tags are implied as browsers do."""

    def __init__(self):
        self.root = Node("")
        self.names: list[str] = []
        self.nodes = [self.root]  # with each open element, the node that its text belongs to
        self.flags: list[bool] = []
        self.parts = 0
        self.text: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            self.nodes[-1].items.append(text)

    def _pop_to(self, size: int) -> None:
        if any(name not in INLINE for name in self.names[size:]):
            self.flush()
        while len(self.names) > size:
            self.names.pop()
            self.nodes.pop()
            self.parts -= self.flags.pop()

    def _close_within(self, name: str, bars: set[str]) -> None:
        for k in range(len(self.names) - 1, -1, -1):
            if self.names[k] == name:
                return self._pop_to(k)
            if self.names[k] in bars:
                return None
        return None

    def open(self, name: str, attributes: str) -> None:
        block = name not in INLINE
        if block:
            self.flush()
        if name in CLOSES_P:
            self._close_within("p", {"article", "main", "section", "div", "td", "th", "li", "body", "blockquote"})
        for other in SIBLINGS.get(name, ()):
            self._close_within(other, SIBLING_BARS[name])
        if name in VOID or attributes.endswith("/") and name in ("svg", "math"):
            return
        kind = part(name, attributes, any(x in CONTENT for x in self.names))
        # An inline element has no blocks of its own to weigh.
        hard = kind == HARD or kind != PLAIN and not block
        node = self.nodes[-1]
        if block and not hard and not self.parts and len(self.names) < DEPTH:
            node = Node(label(name, attributes), kind)
            self.nodes[-1].items.append(node)
        self.names.append(name)
        self.nodes.append(node)
        self.flags.append(hard)
        self.parts += hard

    def close(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        self._close_within(name, set())


def parsed(page: str) -> Node:
    """The blocks of a page."""
    tree = Tree()
    for kind, name, rest in tokens(page):
        if kind == "open":
            tree.open(name, rest)
        elif kind == "close":
            tree.close(name)
        elif not tree.parts:
            tree.text.append(entities.unescape(rest))
    tree.flush()
    prune(tree.root)
    return tree.root


def prune(root: Node) -> None:
    """Take out the elements that are parts by class or id, but for containers of the page's content.

    If the page has text in an article or main, a container is what holds at least half of it (what is in a part within the article doesn't
    count). Else it is an element whose class has the word among others, with at least half of the page's text outside deeper parts.
    """
    inside: dict[int, tuple[int, int]] = {}  # characters of each part outside deeper parts, and those in articles in it

    def weigh(node: Node, article: bool) -> tuple[int, int, int]:
        """Characters outside parts, in articles outside parts within them, and of all."""
        article = article or node.label.split(".")[0] in CONTENT
        own = held = every = 0
        for x in node.items:
            if isinstance(x, str):
                own, every, held = own + len(x), every + len(x), held + len(x) * article
            else:
                a, b, c = weigh(x, article)
                every += c
                if x.part == PLAIN:
                    own, held = own + a, held + b
                elif not article:
                    held += b
        if node.part != PLAIN:
            inside[id(node)] = own, 0 if article else held
        return own, held, every

    _, articles, total = weigh(root, False)

    def kept(node: Node) -> bool:
        own, held = inside[id(node)]
        return 2 * held >= articles if articles else node.part == AMONGST and 2 * own >= total

    def cut(node: Node) -> None:
        node.items = [x for x in node.items if isinstance(x, str) or x.part == PLAIN or kept(x)]
        for x in node.items:
            if not isinstance(x, str):
                cut(x)

    cut(root)


# Items of a wrapper are lists: [TEXT, optional, repeated, pages, digest or None for a slot, characters],
# [ELEMENT, optional, repeated, pages, label, items] and [GROUP or ANY, optional, repeated, pages, None, items].
# An ANY is a repeated group of distinct items, each optional.
TEXT, ELEMENT, GROUP, ANY = range(4)
KIND, OPTIONAL, REPEATED, PAGES, NAME, INSIDE = range(6)


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def items_of(node: Node) -> list[list]:
    """The items of a page's element; elements without text are left out."""
    out = []
    for x in node.items:
        if isinstance(x, str):
            out.append([TEXT, 0, 0, 1, digest(x), len(x)])
        elif inside := items_of(x):
            out.append([ELEMENT, 0, 0, 1, x.label, inside])
    return folded(out)


def key(item: list):
    """What two items must share to be aligned."""
    if item[KIND] == GROUP:
        return GROUP, tuple(map(key, item[INSIDE]))
    return item[KIND], item[NAME] if item[KIND] == ELEMENT else None


def joined(x: list, y: list, pages: bool) -> list:
    """One item in place of two with the same key, of two sets of pages or (``pages`` false) of one page."""
    number = x[PAGES] + y[PAGES] if pages else max(x[PAGES], y[PAGES])
    if x[KIND] == TEXT:
        return [TEXT, x[OPTIONAL] | y[OPTIONAL], x[REPEATED] | y[REPEATED], number, x[NAME] if x[NAME] == y[NAME] else None, x[INSIDE] + y[INSIDE]]
    return [x[KIND], x[OPTIONAL] | y[OPTIONAL], x[REPEATED] | y[REPEATED], number, x[NAME], aligned(x[INSIDE], y[INSIDE], pages)]


def optional(item: list) -> list:
    return [item[KIND], 1, *item[REPEATED:]]


_SQUARE = re.compile(r"(..+?)\1+", re.S)


def folded(items: list[list], pages: bool = False) -> list[list]:
    """Repeated siblings as repeated groups."""
    out: list[list] = []
    for x in items:
        if out and key(out[-1]) == key(x):
            y = joined(out[-1], x, False)
            y[REPEATED] = 1
            out[-1] = y
        else:
            out.append(x)
    if len(out) > WIDE:
        return [anything(out, pages)]
    while len(out) > 3:
        names: dict = {}
        found = _SQUARE.search("".join(chr(256 + names.setdefault(key(x), len(names))) for x in out))
        if not found:
            break
        size, (a, b) = len(found[1]), found.span()
        body = out[a : a + size]
        for k in range(a + size, b, size):
            body = [joined(x, y, False) for x, y in zip(body, out[k : k + size])]
        out[a:b] = [[GROUP, 0, 1, max(x[PAGES] for x in body), None, body]]
    return out


def anything(items: list[list], pages: bool) -> list:
    """A repeated group of the distinct items of a list, its groups opened."""
    found: dict = {}
    waiting = list(reversed(items))
    while waiting:
        x = waiting.pop()
        if x[KIND] in (GROUP, ANY):
            waiting.extend(reversed(x[INSIDE]))
        else:
            found[key(x)] = joined(found[key(x)], x, pages) if key(x) in found else optional(x)
    return [ANY, 0, 1, max((x[PAGES] for x in found.values()), default=1), None, list(found.values())]


def aligned(left: list[list], right: list[list], pages: bool = True) -> list[list]:
    """The items of both lists: differing texts become slots, items without a counterpart optional."""
    if any(len(x) == 1 and x[0][KIND] == ANY for x in (left, right)):
        return [anything([*left, *right], pages)]
    a, b = list(map(key, left)), list(map(key, right))
    if a == b:
        return [joined(x, y, pages) for x, y in zip(left, right)]
    out = []
    for what, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if what == "equal":
            out.extend(joined(x, y, pages) for x, y in zip(left[i:j], right[k:m]))
        else:
            out.extend(map(optional, [*left[i:j], *right[k:m]]))
    return folded(out, pages)


def wrapper_of(page: str) -> list:
    """The wrapper of one page."""
    return [ELEMENT, 0, 0, 1, "", items_of(parsed(page))]


def summary(wrapper: list) -> dict:
    """What extraction needs of a wrapper: the paths of its content elements, heaviest first, and the host's own texts
    as path and digest."""
    total = wrapper[PAGES]
    own: list[tuple[str, str]] = []
    weight: dict[str, int] = {}
    number: dict[str, int] = {}
    inside: dict[str, list[str]] = {}

    def weigh(items: list[list], path: str) -> int:
        found = 0
        for x in items:
            if x[KIND] == TEXT:
                if x[NAME] is not None and x[PAGES] >= 3 and 2 * x[PAGES] > total:
                    own.append((path, x[NAME]))
                else:
                    found += x[INSIDE]
            elif x[KIND] == ELEMENT:
                below = f"{path}/{x[NAME]}"
                if below not in inside.setdefault(path, []):
                    inside[path].append(below)
                number[below] = number.get(below, 0) + x[PAGES]
                found += weigh(x[INSIDE], below)
            else:
                found += weigh(x[INSIDE], path)
        weight[path] = weight.get(path, 0) + found
        return found

    weigh(wrapper[INSIDE], "")
    number[""] = total
    found: dict[str, int] = {}

    def name(path: str) -> str:
        return path.rsplit("/", 1)[-1].split(".")[0]

    def heading(path: str) -> bool:
        return any(name(x) in HEADINGS or heading(x) for x in inside.get(path, ()))

    def settle(path: str) -> None:
        up = path
        while up and name(up) not in CONTENT:
            up = up.rpartition("/")[0]
        if up:
            path = up
        elif path and not heading(path) and any(name(x) in HEADINGS for x in inside[path.rpartition("/")[0]]):
            path = path.rpartition("/")[0]
        found[path] = max(found.get(path, 0), weight[path])

    def descend(path: str) -> None:
        below = sorted((x for x in inside.get(path, ()) if name(x) not in TEXTUAL), key=lambda x: (-weight[x], x))
        taken, held, pages = [], 0, 0
        for x in below:
            if 10 * held >= 9 * weight[path]:
                break
            taken, held, pages = [*taken, x], held + weight[x], pages + number[x]
        if taken and held and 10 * held >= 9 * weight[path] and (len(taken) == 1 or 10 * pages <= 11 * number[path]):
            for x in taken:
                descend(x)
        else:
            settle(path)

    descend("")
    return {"content": sorted(found, key=lambda x: (-found[x], x)), "own": sorted(set(own))}


def main_text(page: str | None, host: dict | None) -> str:
    """The main text of a whole page."""
    if not page:
        return ""
    root = parsed(page)
    if host is None:
        host = summary([ELEMENT, 0, 0, 1, "", items_of(root)])
    paths: dict[str, list[tuple[str, Node]]] = {}
    marked: dict[str, list[tuple[str, Node]]] = {}
    waiting = [("", root)]
    while waiting:
        path, node = waiting.pop()
        paths.setdefault(path, []).append((path, node))
        marked.setdefault(path.rsplit("/", 1)[-1].split(".")[0], []).append((path, node))
        waiting.extend((f"{path}/{x.label}", x) for x in reversed(node.items) if isinstance(x, Node))
    chosen = next((paths[c] for c in host["content"] if c in paths), None) or next((marked[c] for c in CONTENT if c in marked), [("", root)])
    own = {tuple(x) for x in host["own"]}
    blocks, rest, reached = [], [], set()
    for path, node in chosen:
        waiting = [] if id(node) in reached else [(path, node)]
        while waiting:
            path, x = waiting.pop()
            if isinstance(x, str):
                blocks.append(x)
                if not own or (path, digest(x)) not in own:
                    rest.append(x)
                continue
            reached.add(id(x))
            waiting.extend((path if isinstance(y, str) else f"{path}/{y.label}", y) for y in reversed(x.items))
    if 5 * sum(map(len, rest)) >= 4 * sum(map(len, blocks)):
        blocks = rest
    return " ".join(blocks)


def host_of(url: str = "url"):
    """The host of a URL column, in lower case; null if there is none."""
    found = F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


WRAPPERS = "host string, id long, wrapper string"


def _grouped(wrappers) -> list | None:
    """The wrapper of several, in order."""
    found = None
    for x in wrappers:
        found = x if found is None else joined(found, x, True)
    return found


def wrappers(pages: DataFrame, fan: int = FAN) -> DataFrame:
    """host and wrapper (JSON) of each host, aligned over all its pages."""

    def infer(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [json.dumps(wrapper_of(page), separators=(",", ":")) for page in column(batch, "html").to_pylist()]
            ids = [int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little", signed=True) for t in texts]
            yield pa.RecordBatch.from_arrays([column(batch, "host"), pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["host", "id", "wrapper"])
        released(pa)

    def merge(group):
        import pandas as pd

        found = _grouped(map(json.loads, group.sort_values(["id", "wrapper"])["wrapper"]))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "id": [int(group["salt"].iloc[0])], "wrapper": [json.dumps(found, separators=(",", ":"))]})

    known = pages.select(host_of().alias("host"), "html").filter("host is not null and html != ''")
    parts = written(bounded_batches(known).mapInArrow(infer, WRAPPERS), "wrappers")
    while True:
        counts = parts.groupBy("host").agg(F.count("*").alias("n"))
        if counts.filter("n > 1").isEmpty():
            return parts.select("host", "wrapper")
        salted = parts.join(counts, "host").withColumn("salt", F.pmod(F.xxhash64("id", "wrapper"), F.ceil(F.col("n") / fan)))
        parts = written(salted.groupBy("host", "salt").applyInPandas(merge, WRAPPERS), "wrappers")


FIELDS = [StructField("text", StringType()), StructField("n_chars", LongType())]


def extracted(pages: DataFrame, fan: int = FAN) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def sum_up():
        import pyarrow as pa

        return lambda batch: [pa.array([json.dumps(summary(json.loads(w))) for w in column(batch, "wrapper").to_pylist()], pa.string())]

    inferred = written(with_computed(wrappers(pages, fan), [StructField("summary", StringType())], sum_up, keep=["host"], text="wrapper"), "summaries")
    chars = inferred.agg(F.sum(F.length("summary") + F.length("host"))).first()[0] or 0
    placed = pages.select("page_id", "url", "html", host_of().alias("host"))
    joined_pages = placed.join(F.broadcast(inferred) if chars <= BROADCAST_CHARS else inferred, "host", "left")

    def make():
        import functools

        import pyarrow as pa

        loaded = functools.lru_cache(4096)(json.loads)

        def compute(batch):
            rows = zip(column(batch, "html").to_pylist(), column(batch, "summary").to_pylist())
            texts = [main_text(page, loaded(w) if w else None) for page, w in rows]
            return [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

        return compute

    return with_computed(joined_pages, FIELDS, make, keep=["page_id", "url", "summary"], text="html").drop("summary")
