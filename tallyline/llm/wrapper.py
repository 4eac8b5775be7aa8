"""Main text of web pages by wrappers: union-free regular expressions over tags.

A page is a stream of tags and texts. Same-host streams are aligned one after another
into one expression: tags that both have are kept and their contents aligned in turn;
at a mismatch the next place where either stream goes on with the other's tag is looked
up, and what lies before it becomes optional; a tag that follows itself becomes a
repeated group; texts that differ become a slot, texts that agree stay constant. No
alternatives arise, so a wrapper is as large as the host's structure, not as its pages.

Which pages are aligned: a page proposes its container, the innermost box that holds
``DESCEND`` of the prose of the one above (prose is text outside links and outside boxes
marked as something else). The name of a tag decides one thing only: of the boxes on
that way, one that is an ``article`` or ``main`` is preferred. Pages of a host with the
same proposal share a wrapper, so templates that a host mixes stay apart.

What a wrapper decides. The proposals of a host are ranked by the prose of all pages that
made them, all of them, and a page's text is taken from the best container that it has: a page with a
long advert and a short article follows the others. In the container, a text that is
the same at its path on ``CONSTANT_PAGES`` pages or more and on the share
``CONSTANT_SHARE`` of the wrapper's is a notice, unless such texts are more than
``CONSTANT_MASS`` of the container (then the pages are copies of each other). A box marked by
its kind (nav, aside, form ...) or by a word of its class, id or role is left out where it
holds less than ``LAYOUT`` of the container's text on the host, else it is layout. Paragraphs,
headings, quotes and list items are never left out for a word. Texts in a run of one tag are one
slot, so of those only such as all agree on are notices. A page's first heading
(h1) before its container belongs to it, if the container has none and the wrapper no constant there.

Pages of one shape merge exactly and in any order; differing shapes are dealt into salts by
their own hash and aligned in a fixed order, by (host, proposal, salt), then by (host,
proposal). So the text is the same for every partitioning, and a host with a third of all
pages never gathers in one task: it adds a row for each task and shape.

Defined results: a null or empty page has an empty text; a null url is a host of its own;
repeated rows are pages each, with the same text; markup that is cut off or badly nested is closed where the
page ends; comments, scripts and styles are never text; tables without rows give none; a page of any length is
taken whole; kept columns may have any name. A page with no prose outside marked boxes has the text of the largest of them, and
one of links alone the text of its body.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, fresh_name, materialize, release, text_batches

CONSTANT_PAGES, CONSTANT_SHARE, CONSTANT_MASS = 3, 0.5, 0.25
#: Share of a box's prose that a box in it must hold to be the container in its place.
DESCEND = 0.75
#: Share of a container's text from which a marked box in it is layout; and of a page's from which all prose is looked for in marked boxes.
LAYOUT, MARKED = 0.5, 0.8
#: Least share of a page's prose that a container which others propose must hold of it.
LEAST = 0.1
#: Elements nested deeper belong to their ancestor of this depth.
DEPTH = 150
SALTS = 64
#: Bytes of rules, as counted, up to which every task gets them all; beyond, each page is joined to those of the boxes that it has.
BROADCAST_BYTES = 8 << 20
#: A container that more than one in so many boxes of pages are is dealt out by ``SALTS``.
HEAVY = 1024

#: Fixed lists of HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol menu dl table select body html".split())
#: Elements that are never text; and elements and words of class, id or role that mark a box as something else than the article.
NEVER = frozenset("head title script style noscript template button select textarea iframe object svg canvas math audio video map".split())
MARKED_KINDS = frozenset("nav footer aside form menu dialog".split())
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices alert gdpr comment comments comentarios disqus respond replies reply "
    "sidebar side aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs toolbar footer foot header masthead topbar login signup signin register newsletter subscribe subscription search form "
    "share sharing social related recommended recommendations popup modal overlay pagination pager copyright legal disclaimer skip hidden complementary contentinfo search dialog".split()
)
MAIN = frozenset(("article", "main"))
#: Elements that are text as they stand, whatever their class; they are no containers either.
FLOW = frozenset("p li h1 h2 h3 h4 h5 h6 blockquote pre dt dd tr td th caption figcaption".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I) for tag in RAW}


def marks(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """A tag with the first word of its class (or id, role), whether it is never text, and whether it is marked."""
    never, marked, names = tag in NEVER, tag in MARKED_KINDS, {}
    if attributes and not attributes.isspace() and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                never = True
            elif name in ("class", "id", "role"):
                found = _WORDS.findall(value)
                if found:
                    names.setdefault(name, found[0])
                marked = marked or (tag not in MAIN and tag not in FLOW and not BOILERPLATE.isdisjoint(found))
    word = next((names[k] for k in ("class", "id", "role") if k in names), None)
    return (f"{tag}.{word}" if word else tag), never, marked


class Text(str):
    """A block's text; ``links`` of its characters stand in links."""

    links = 0


class Node:
    """An element: its label, tag, whether it is marked, its items (nodes and texts), and the prose in it."""

    __slots__ = ("items", "label", "marked", "prose", "tag")

    def __init__(self, label: str, tag: str, marked: bool):
        self.label, self.tag, self.marked, self.items, self.prose = label, tag, marked, [], 0


def parse(html: str) -> Node:
    """The page as nested nodes. Texts of inline elements belong to the block around them."""
    root = Node("", "", False)
    stack = [(root, False)]  # with whether it is left out
    text: list[str] = []
    at = deep = anchors = links = 0

    def add(found: str):
        nonlocal links
        text.append(found)
        links += len(found) * bool(anchors)

    def flush():
        nonlocal links
        if text:
            whole = Text(" ".join("".join(text).split()))
            whole.links = min(links, len(whole))
            text.clear()
            links = 0
            if whole and not stack[-1][1]:
                stack[-1][0].items.append(whole)

    def close(tags, scopes=frozenset()):
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k][0].tag
            if tag in tags:
                del stack[k:]
                return
            if tag in scopes:
                return

    size = len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if found is None:
            add(unescape(html[at:]))
            break
        if found.start() > at:
            add(unescape(html[at : found.start()]))
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                anchors = 0 if found[1] else 1
            if tag == "wbr" or found[1] or not marks(tag, found[3])[1]:
                continue
        if tag == "br":
            text.append(" ")
            continue
        flush()
        if found[1]:
            if deep:
                deep -= 1
                continue
            close((tag,), frozenset(("body", "html")) if tag not in ("body", "html") else frozenset())
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            at = _RAW_END[tag].search(html, at).end()
            continue
        if tag in CLOSES_P:
            close(("p",), frozenset(("button", "table", "article", "section", "div", "li", "td", "body", "html")))
        if tag in SIBLINGS:
            close(SIBLINGS[tag], SCOPES)
        if len(stack) > DEPTH:
            deep += 1
            continue
        label, never, marked = marks(tag, found[3])
        if tag == "header" and not any(above.tag in MAIN for above, _ in stack):
            marked = True  # a page's header; an article's own has its title
        node = Node(("!" if marked else "") + label, tag, marked)
        off = never or stack[-1][1]
        if not off:
            stack[-1][0].items.append(node)
        if not found[3].rstrip().endswith("/") or tag in ("p", "div"):
            stack.append((node, off))
    flush()
    return root


def container(root: Node) -> tuple[str, int]:
    """The path of the box that a page proposes as its article's, and how much prose the page has."""
    lifted: set[int] = set()  # marked nodes that hold nearly all prose

    def measure(node: Node) -> int:
        """Prose outside marked boxes."""
        node.prose = sum(len(x) - x.links if isinstance(x, Text) else measure(x) for x in node.items)
        return 0 if node.marked and id(node) not in lifted else node.prose

    def tops(node: Node) -> Iterator[Node]:
        for x in node.items:
            if isinstance(x, Node):
                if x.marked and id(x) not in lifted:
                    yield x
                else:
                    yield from tops(x)

    while True:
        open_ = measure(root)
        boxes = [*tops(root)]
        if not boxes or open_ and open_ >= (1 - MARKED) * (open_ + sum(x.prose for x in boxes)) or _has_main(root, lifted):
            break
        holding = [x for x in boxes if x.tag in MAIN or _has_main(x, lifted)] or boxes
        best = max(holding, key=lambda x: x.prose)
        if not best.prose:
            break
        lifted.add(id(best))
    path, here, chain = "", root, [("", "")]
    while True:
        inner = [x for x in here.items if isinstance(x, Node) and x.tag not in FLOW and (not x.marked or id(x) in lifted)]
        best = max(inner, key=lambda x: x.prose, default=None)
        if best is None or not best.prose or best.prose < DESCEND * here.prose:
            break
        here, path = best, f"{path}>{best.label}"
        chain.append((path, best.tag))
    named = [p for p, tag in chain if tag in MAIN]
    return (named or [path])[-1], root.prose


def _has_main(node: Node, lifted: set[int]) -> bool:
    """Whether there is an article with prose outside marked boxes."""
    return any(isinstance(x, Node) and (not x.marked or id(x) in lifted) and (x.tag in MAIN and x.prose > 0 or _has_main(x, lifted)) for x in node.items)


# ----------------------------------------------------------------- expressions
# ["t", label, items] a tag, ["s", hash or None, pages, chars] a text, ["o", item] optional, ["r", item] repeated


def expression(node: Node) -> list:
    """The items of one page's node as an expression."""
    return _folded([["s", zlib.crc32(x.encode()), 1, len(x)] if isinstance(x, Text) else ["t", x.label, expression(x)] for x in node.items])


def _name(item: list) -> str:
    while item[0] in "or":
        item = item[1]
    return item[1] if item[0] == "t" else "#"


def _folded(items: list) -> list:
    """Runs of a tag made repeated groups, runs of texts one slot."""
    out: list = []
    for item in items:
        if out and _name(out[-1]) == _name(item):
            merged = join(out[-1], item, False)
            out[-1] = merged if _name(item) == "#" or merged[0] == "r" else ["r", merged]
        else:
            out.append(item)
    return out


def join(a: list, b: list, pages: bool = True) -> list:
    """Two items of one name as one; ``pages``: they come from different pages."""
    kinds = set()
    for side in (a, b):
        while side[0] in "or":
            kinds.add(side[0])
            side = side[1]
    while a[0] in "or":
        a = a[1]
    while b[0] in "or":
        b = b[1]
    if a[0] == "s":
        same = a[1] if a[1] == b[1] else None
        out: list = ["s", same, a[2] + b[2] if pages else max(a[2], b[2]), a[3] + b[3]]
    else:
        out = ["t", a[1], align(a[2], b[2], pages)]
    for kind in "ro":
        if kind in kinds:
            out = [kind, out]
    return out


def _optional(item: list) -> list:
    return item if item[0] == "o" else ["o", item]


def align(a: list, b: list, pages: bool = True) -> list:
    """The union-free expression of both lists of items; time and memory grow with their length."""
    names_a, names_b = [*map(_name, a)], [*map(_name, b)]
    if names_a == names_b:
        return [join(x, y, pages) for x, y in zip(a, b, strict=True)]
    places: tuple[dict, dict] = {}, {}
    for names, at in zip((names_a, names_b), places, strict=True):
        for k, name in enumerate(names):
            at.setdefault(name, []).append(k)

    def ahead(side: int, name: str, start: int) -> int:
        """How far on a side the next ``name`` is, or more than any place is."""
        at = places[side].get(name, ())
        k = bisect_left(at, start)
        return at[k] - start if k < len(at) else 1 << 60

    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if names_a[i] == names_b[j]:
            out.append(join(a[i], b[j], pages))
            i, j = i + 1, j + 1
            continue
        skip_a, skip_b = ahead(0, names_b[j], i), ahead(1, names_a[i], j)
        if min(skip_a, skip_b) == 1 << 60:  # neither goes on: both are optional
            skip_a = skip_b = 1
        elif skip_a <= skip_b:
            skip_b = 0
        else:
            skip_a = 0
        out += map(_optional, a[i : i + skip_a] + b[j : j + skip_b])
        i, j = i + skip_a, j + skip_b
    out += map(_optional, a[i:] + b[j:])
    return _folded(out)


def pattern(items: list, texts: bool = True) -> str:
    """An expression in the usual notation; without ``texts`` its shape alone."""
    out = []
    for item in items:
        if item[0] == "o":
            out.append(f"({pattern([item[1]], texts)})?")
        elif item[0] == "r":
            out.append(f"({pattern([item[1]], texts)})+")
        elif item[0] == "s":
            out.append("#TEXT" if item[1] is None or not texts else f"'{item[1]:08x}'")
        else:
            out.append(f"<{item[1]}>{pattern(item[2], texts)}</{item[1].split('.')[0]}>")
    return "".join(out)


def rules(items: list, path: str, pages: int) -> dict:
    """What the wrapper of ``pages`` says of the container at ``path``: texts that are notices and marked boxes that are left out."""
    least = max(CONSTANT_PAGES, CONSTANT_SHARE * pages)
    mass: dict[str, int] = {}  # of the container and the marked boxes in it
    constants: dict[tuple[str, int], int] = {}

    def walk(items: list, own: str, inside: bool, boxes: tuple[str, ...]) -> None:
        for item in items:
            while item[0] in "or":
                item = item[1]
            if item[0] == "t":
                below = f"{own}>{item[1]}"
                walk(item[2], below, inside or below == path, (*boxes, below) if inside and item[1].startswith("!") else boxes)
                continue
            if inside:
                for box in (path, *boxes):
                    mass[box] = mass.get(box, 0) + item[3]
            if item[1] is not None and item[2] >= least and (inside or own.rpartition(">")[2].split(".")[0] == "h1"):
                key = own, item[1]
                constants[key] = constants.get(key, 0) + (item[3] if inside else 0)

    walk(items, "", path == "", ())
    whole = mass.get(path, 0)
    copies = sum(constants.values()) > CONSTANT_MASS * whole
    layout = [box for box, chars in mass.items() if box != path and chars >= LAYOUT * whole]
    return {"constants": [] if copies else sorted(map(list, constants)), "layout": sorted(layout)}


def extract(root: Node, path: str, rule: dict) -> str:
    """The blocks of a page's container in page order."""
    layout, constants = set(rule["layout"]), {tuple(x) for x in rule["constants"]}
    out: list[str] = []
    title: list[str] = []
    found: list[str] = []

    def walk(node: Node, own: str, inside: bool, boxed: bool) -> None:
        for x in node.items:
            if isinstance(x, Text):
                if inside and (own, zlib.crc32(x.encode())) not in constants:
                    out.append(x)
                    if node.tag == "h1":
                        found.append(x)
                elif not inside and not boxed and not out and node.tag == "h1" and (own, zlib.crc32(x.encode())) not in constants:
                    title.append(x)
                continue
            below = f"{own}>{x.label}"
            if inside and x.marked and below not in layout and x.tag != "header":
                continue
            walk(x, below, inside or below == path, boxed or x.marked)

    walk(root, "", path == "", False)
    return " ".join(out if found or not out else title[:1] + out)


def boxes(root: Node) -> tuple[str, list[str]]:
    """The path that a page proposes, and those of its boxes that may be its container: its own, and such as hold a share of its prose."""
    own, whole = container(root)
    has: dict[str, int] = {}

    def look(node: Node, path: str) -> None:
        has[path] = has.get(path, 0) + node.prose
        for x in node.items:
            if isinstance(x, Node) and x.tag not in FLOW:  # no page proposes what is in those
                look(x, f"{path}>{x.label}")

    look(root, "")
    return own, [p for p, prose in has.items() if prose and (p == own or prose >= LEAST * whole)]


def text_of(root: Node, containers: dict[str, tuple[int, dict]]) -> str:
    """A page's text by the containers of its host (support and rule by path), or those of them that are boxes of the page."""
    own, found = boxes(root)
    for path in sorted((p for p in found if p in containers), key=lambda p: (-containers[p][0], p)):
        if text := extract(root, path, containers[path][1]):
            return text
    for path in (own, ""):
        if text := extract(root, path, rules(expression(root), path, 1)):
            return text
    return ""


# ----------------------------------------------------------------- Spark


def host_of(url: str = "url"):
    """The host of a url, lower-cased, without port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


#: Shapes of pages that a task holds before it hands them on.
HELD = 4096
_SHAPES = pa.schema([("host", pa.string()), ("path", pa.string()), ("salt", pa.int32()), ("shape", pa.binary()), ("wrapper", pa.string()), ("pages", pa.int64()), ("prose", pa.int64())])
_SHAPES_SQL = "host string, path string, salt int, shape binary, wrapper string, pages long, prose long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_SHAPES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SHAPES, strict=True)], schema=_SHAPES)


def infer(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, path, wrapper, pages, prose): for each container that pages of a host propose, their wrapper as JSON, their number and prose."""
    chosen = pages.select(host_of(url).alias("host"), blank(html).alias("html"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages of one shape as one expression each."""
        release("wrapper")
        held: dict[tuple, list] = {}

        def rows() -> pa.RecordBatch:
            out = _rows([(host, path, int.from_bytes(shape[:4], "little") % SALTS, shape, json.dumps(items), n, prose) for (host, path, shape), (items, n, prose) in held.items()])
            held.clear()
            return out

        for batch in text_batches(batches, "html"):
            for host, value in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if not value:
                    continue
                root = parse(value)
                path, prose = container(root)
                items = expression(root)
                key = host, path, hashlib.blake2b(pattern(items, False).encode(), digest_size=16).digest()
                known = held.get(key)
                held[key] = [items, 1, prose] if known is None else [align(known[0], items), known[1] + 1, known[2] + prose]
            if len(held) >= HELD:
                yield rows()
        yield rows()

    def merge(by_salt: bool):
        """Rows of a key, which follow each other, aligned; those of one shape first, so that no order of theirs matters."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key = shape = wrapper = same = None
            n = prose = 0

            def added(wrapper, same):
                return same if wrapper is None else wrapper if same is None else align(wrapper, same)

            for batch in batches:
                out = []
                for host, path, salt, digest, own, pages, mass in zip(*(batch.column(f.name).to_pylist() for f in _SHAPES), strict=True):
                    items, now = json.loads(own), (host, path, salt if by_salt else 0)
                    if now != key:
                        if key is not None:
                            out.append((*key, b"", json.dumps(added(wrapper, same)), n, prose))
                        key, shape, wrapper, same, n, prose = now, digest, None, items, 0, 0
                    elif by_salt and digest == shape:
                        same = align(same, items)
                    else:
                        wrapper, same, shape = added(wrapper, same), items, digest
                    n, prose = n + pages, prose + mass
                yield _rows(out)
            if key is not None:
                yield _rows([(*key, b"", json.dumps(added(wrapper, same)), n, prose)])

        return run

    salted = chosen.mapInArrow(fold, _SHAPES_SQL).repartition("host", "path", "salt").sortWithinPartitions("host", "path", "salt", "shape").mapInArrow(merge(True), _SHAPES_SQL)
    return salted.repartition("host", "path").sortWithinPartitions("host", "path", "salt").mapInArrow(merge(False), _SHAPES_SQL).select("host", "path", "wrapper", "pages", "prose")


def host_rules(wrappers: DataFrame) -> DataFrame:
    """(host, path, prose, rule): what the wrapper of every container says, as JSON."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps(rules(json.loads(w), p, n)) for w, p, n in zip(*(batch.column(k).to_pylist() for k in ("wrapper", "path", "pages")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"), batch.column("prose"), pa.array(made, pa.string())], names=["host", "path", "prose", "rule"])

    return wrappers.mapInArrow(read, "host string, path string, prose long, rule string")


def page_rules(pages: DataFrame, ruled: DataFrame) -> DataFrame:
    """(host, page, rules): of ``pages`` (host, page, html) the rules of the containers among their boxes, as JSON."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("wrapper")
        for batch in text_batches(batches, "html"):
            rows = [(host, page, path) for host, page, value in zip(*(batch.column(k).to_pylist() for k in ("host", "page", "html")), strict=True) if value for path in boxes(parse(value))[1]]
            hosts, ids, paths = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(ids, pa.binary()), pa.array(paths, pa.string())], names=["host", "page", "path"])

    key = ["host", "path"]
    found = materialize(pages.mapInArrow(read, "host string, page binary, path string").distinct(), "boxes")
    heavy = F.broadcast(found.groupBy(key).count().where(F.col("count") * HEAVY > found.count()).select(*key, F.lit(SALTS).alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    dealt = found.join(heavy, key, "left").withColumn("salt", F.pmod(F.xxhash64("page"), salts).cast("int"))
    spread = ruled.join(heavy, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = dealt.join(spread.drop("salts"), [*key, "salt"])
    return met.groupBy("host", "page").agg(F.to_json(F.sort_array(F.collect_list(F.struct("path", "prose", "rule")))).alias("rules"))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text`` of every page; a kept column named text is returned as ``page_text``."""
    ruled = materialize(host_rules(materialize(infer(pages, html, url), "wrappers")), "wrapper-rules")
    names = [f"page_{k}" if k == "text" else k for k in keep]
    here = fresh_name(names)
    chosen = pages.select(*(F.col(k).alias(n) for k, n in zip(keep, names, strict=True)), host_of(url).alias(f"{here}host"), blank(html).alias(here))
    size = ruled.agg(F.sum(F.length("host") + F.length("path") + F.length("rule") + 64)).first()[0] or 0
    held: dict[str, list] | None = None
    if size <= BROADCAST_BYTES:
        held = {}
        for r in ruled.toLocalIterator():
            held.setdefault(r.host, []).append({"path": r.path, "prose": r.prose, "rule": r.rule})
        joined = chosen.withColumn(f"{here}rules", F.lit(None).cast("string"))
    else:
        key = f"{here}host", f"{here}page"
        chosen = chosen.withColumn(key[1], F.unhex(F.sha2(here, 256)))
        joined = chosen.join(page_rules(chosen.select(*key, here).toDF("host", "page", "html"), ruled).toDF(*key, f"{here}rules"), list(key), "left")
    joined = joined.select(*names, here, f"{here}host", f"{here}rules")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("wrapper")
        known: dict[str | None, dict] = {}  # by host, or by the rules of a page
        for batch in text_batches(batches, here):
            texts = []
            for value, host, found in zip(*(batch.column(f"{here}{c}").to_pylist() for c in ("", "host", "rules")), strict=True):
                if not value:
                    texts.append("")
                    continue
                own = found if held is None else host
                if own not in known:
                    if len(known) > 1000:
                        known.clear()
                    rows = json.loads(found or "[]") if held is None else held.get(host, [])
                    known[own] = {r["path"]: (r["prose"], json.loads(r["rule"])) for r in rows}
                texts.append(text_of(parse(value), known[own]))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(names))), pa.array(texts, pa.string())], names=[*names, "text"])

    return joined.mapInArrow(run, ", ".join([*fields, "text string"]))
