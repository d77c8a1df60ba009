"""Operator 7, HTML extraction by wrapper induction.

Pages of one host are filled from one template.  A few of a host's pages, as unlike one another as
can be had, are parsed into trees and aligned with the first of them by simple tree matching.  Nodes
that recur with the same text in all of them are template, nodes whose text varies are slots.  The
host's wrapper is the path from the root down to the smallest node that holds nearly all varying
text that is no chrome, and the block texts below it that never vary.  A page's content is what its
node at this path holds, less chrome and those constants.

Menus, adverts and footers vary from page to page as well, so alignment alone cannot tell them from
content: elements that by tag, role, class or id are chrome (fixed lists below) are never
content.  A class or id counts if it consists of chrome words.  One that only holds such a word says
so of the page's frame; inside the content (a wrapper's node, an article or main element) a class needs
two reference pages that have the element there, and an id says nothing.  Ids of headings, and single
words in names of headings and sections, never count: they are slugs of their text.
A page of a host with no other page, or without a node at the path, is read by its own
article, main or body element.

Reference pages: REFERENCES a host at most, chosen among all its pages by hash, each sharing less than
half of its blocks with every earlier one, so that copies never stand for a host that has other pages.
They propose the path and the blocks that two of them share.  All pages of the host decide which of
these are constant: CONSTANT_SHARE of its unlike pages hold them, three at least.  Pages are alike
here if their longest block that is not proposed is the same.  Only hashes and counts are shuffled,
counts after aggregation.

Defined results: null or empty html gives an empty text; a null url, or one without host, has no
wrapper; malformed markup is closed as browsers would, roughly; repeated rows are treated alike;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored

REFERENCES = 6
#: A constant block is held by so many of a host's unlike pages, in per cent.
CONSTANT_SHARE = 90
#: Wrappers of all hosts travel by broadcast up to this many characters, by a join beyond.
BROADCAST_CHARS = 8_000_000

# Names in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCKS - frozenset(("body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt", "summary", "figcaption"))
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPE = frozenset("ul ol dl table article section div main body html nav aside footer header form blockquote td th select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg canvas button select input textarea dialog menu object audio video".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
CHROME_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal newsletter subscribe subscription comment comments disqus respond replies share sharing social related recommended login signup search pagination pager skip".split()
)
# attributes as a browser reads them: a name may hold quotes, a value is quoted only if it begins with a quote, and then ends with the next or the page
VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s"'>][^\s>]*+)"""
NAME = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{NAME}(?:\s*+=\s*+{VALUE}?+)?+)*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(rf"({NAME})(?:\s*+=\s*+({VALUE})?+)?+")
READ = re.compile(r"class|id|role", re.IGNORECASE)
WORDS = re.compile(r"[a-z0-9]+")
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    __slots__ = ("by_word", "chrome", "children", "classes", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.children: list[Node | str] = []
        self.classes = ""
        self.chrome = tag in CHROME_TAGS
        self.by_word = ""  # what holds a chrome word among others: "class" or "id"
        if attributes and READ.search(attributes):
            seen = set()
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), (value.strip(value[0]) if value[:1] in ("'", '"') else value).lower()
                if name not in ("class", "id", "role") or not value or name in seen:
                    continue  # of several of a name the first counts
                seen.add(name)
                if name == "role":
                    self.chrome |= value in CHROME_ROLES
                else:
                    if name == "class":
                        self.classes = value
                    if tag in ("body", "html", "article", "main") or (tag in HEADINGS and name == "id"):
                        continue
                    for words in map(WORDS.findall, value.split() if name == "class" else (value,)):
                        if words and CHROME_WORDS.issuperset(words):
                            self.chrome = True
                        elif not CHROME_WORDS.isdisjoint(words) and tag not in HEADINGS and tag != "section" and self.by_word != "class":
                            self.by_word = name

    def mark(self) -> str:
        return f"{self.tag}.{self.classes}" if self.classes else self.tag


def parse(page: str) -> Node:
    """The page's tree; text stands in it decoded."""
    root = Node("#root")
    stack = [root]
    at, n = 0, len(page)

    def text(a: int, z: int) -> None:
        if a < z:
            stack[-1].children.append(entities.unescape(page[a:z]))

    def close(names: tuple[str, ...], scope: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in SAME:
            close(SAME[tag], SCOPE - frozenset(SAME[tag]))
        if tag in CLOSES_P:
            close(("p",), SCOPE)
        if tag == "head" or (tag == "body" and stack[-1].tag == "head"):
            close(("head",), frozenset(("html",)))
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>", re.IGNORECASE).search(page, at)
            stop = end.start() if end else n
            if tag in ("title", "textarea"):
                node.children.append(entities.unescape(page[at:stop]))
            at = end.end() if end else n
            continue
        stack.append(node)
    return root


def blocks(node: Node, marks: frozenset[str] | None = None) -> list[str]:
    """Texts of the node's blocks in page order, without chrome; white space is one space.

    Of elements that a single word calls chrome, content has to keep all but those of ``marks``.
    """
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            t = " ".join("".join(run).split())
            run.clear()
            if t:
                out.append(t)

    # an explicit stack: nesting may be deeper than Python's
    work: list = [node]
    while work:
        x = work.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif not x.chrome and x.tag != "title" and not (x.by_word and (marks is None or (x.by_word == "class" and x.mark() in marks))):
            if x.tag in BLOCKS:
                flush()
                work.append(None)
            work.extend(reversed(x.children))
    flush()
    return out


def find(root: Node, tags: tuple[str, ...]) -> Node | None:
    """The first node of one of the tags, that is no chrome."""
    work = [root]
    while work:
        x = work.pop()
        if x.tag in tags:
            return x
        work.extend(c for c in reversed(x.children) if not isinstance(c, str) and not c.chrome and not c.by_word)
    return None


def own_blocks(root: Node, marks: frozenset[str] = frozenset()) -> list[str]:
    """Blocks of what a page says of itself; a body is frame and content in one."""
    node = own_root(root)
    return blocks(node, marks if node.tag in ("article", "main") else None)


def own_root(root: Node) -> Node:
    """What a page says of itself: its article, main or body element."""
    return find(root, ("article",)) or find(root, ("main",)) or without_header(find(root, ("body",)) or root)


def without_header(node: Node) -> Node:
    """A body without its page header."""
    out = Node(node.tag)
    out.children = [c for c in node.children if isinstance(c, str) or c.tag != "header"]
    return out


def follow(root: Node, path: list[str]) -> Node | None:
    """The node at a path of marks; of equal marks the first."""
    node = root
    for mark in path:
        node = next((c for c in node.children if not isinstance(c, str) and c.mark() == mark), None)
        if node is None:
            return None
    return node


def inner(node: Node) -> list[Node]:
    """Child elements that are no chrome."""
    return [c for c in node.children if not isinstance(c, str) and not c.chrome and not c.by_word]


def bottom_up(root: Node) -> list[Node]:
    """The tree's elements that are no chrome, children before their parents."""
    out, work = [], [root]
    while work:
        x = work.pop()
        out.append(x)
        work.extend(inner(x))
    return out[::-1]


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: size of a largest order-keeping match of two trees, and its pairs.

    Sizes depend on marks alone, so they are found once for each two shapes of subtrees.
    """
    numbers: dict[tuple[str, tuple[int, ...]], int] = {}
    shape: dict[int, int] = {}
    for root in (a, b):
        for x in bottom_up(root):
            shape[id(x)] = numbers.setdefault((x.mark(), tuple(shape[id(c)] for c in inner(x))), len(numbers))
    marks, below = [k[0] for k in numbers], [k[1] for k in numbers]
    sizes: dict[tuple[int, int], int] = {}

    def align(s: int, t: int, pairs: bool = False) -> tuple[int, list[tuple[int, int]]]:
        """Size for the children of two shapes, and which of them go together; memory for a row and two bits a cell."""
        if not below[s] or not below[t]:
            return 0, []
        xs, at = np.unique(below[s], return_inverse=True)
        ys, to = np.unique(below[t], return_inverse=True)
        gain = np.array([[sizes.get((x, y), 0) for y in ys.tolist()] for x in xs.tolist()], np.int64)
        row = np.zeros(len(to) + 1, np.int64)
        ups, lefts = [], []
        for i in at.tolist():
            new = np.zeros_like(row)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + gain[i][to]), out=new[1:])
            if pairs:
                ups.append(np.packbits(new == row))
                lefts.append(np.packbits(new[1:] == new[:-1]))
            row = new
        found, i, j = [], len(at), len(to)
        while pairs and i and j:
            if ups[i - 1][j >> 3] >> (7 - (j & 7)) & 1:
                i -= 1
            elif lefts[i - 1][(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i, j))
        return int(row[-1]), found

    if a.mark() != b.mark():
        return 0, []
    # explicit stacks: nesting may be deeper than Python's
    todo = [(shape[id(a)], shape[id(b)])]
    while todo:
        s, t = todo[-1]
        need = [] if (s, t) in sizes else [(x, y) for x in set(below[s]) for y in set(below[t]) if marks[x] == marks[y] and (x, y) not in sizes]
        if need:
            todo += need
        else:
            todo.pop()
            if (s, t) not in sizes:
                sizes[s, t] = align(s, t)[0] + 1
    found, work = [], [(a, b)]
    while work:
        x, y = work.pop()
        found.append((x, y))
        left, right = inner(x), inner(y)
        work += [(left[i], right[j]) for i, j in align(shape[id(x)], shape[id(y)], True)[1]]
    return sizes[shape[id(a)], shape[id(b)]], found


def unlike(pages: list[str]) -> list[Node]:
    """Trees of pages that share less than half of their blocks with every earlier one."""
    out: list[Node] = []
    seen: list[set[str]] = []
    for page in pages:
        tree = parse(page)
        own = set(own_blocks(tree))
        if own and all(2 * len(own & s) < min(len(own), len(s)) for s in seen):
            out.append(tree)
            seen.append(own)
    return out


def backed(pages: list[str], path: list[str]) -> list[str]:
    """Marks of elements below the path that a word of their class calls chrome, in two unlike pages."""
    held: Counter[str] = Counter()
    for tree in unlike(pages):
        found, work = set(), [follow(tree, path)]
        while work:
            x = work.pop()
            if x and not x.chrome:
                if x.by_word == "class":
                    found.add(x.mark())
                work.extend(c for c in x.children if not isinstance(c, str))
        held.update(found)
    return sorted(m for m, n in held.items() if n > 1)


def induce(pages: list[str], holders: int | None = None) -> tuple[list[str], list[str]] | None:
    """The wrapper of pages of one host: (path to the content, constant blocks below it).

    Constant are the blocks that all unlike pages hold, three at least, or else ``holders`` of them.
    """
    trees = unlike(pages)
    if len(trees) < 2:
        return None
    first, rest = trees[0], trees[1:]
    varying: dict[int, int] = {}
    for other in rest:
        for a, b in match(first, other)[1]:
            own_a, own_b = (" ".join(" ".join(c for c in x.children if isinstance(c, str)).split()) for x in (a, b))
            if own_a and own_a != own_b:
                varying[id(a)] = max(varying.get(id(a), 0), len(own_a))

    weight: dict[int, int] = {}
    for x in bottom_up(first):
        weight[id(x)] = varying.get(id(x), 0) + sum(weight[id(c)] for c in inner(x))

    # what of the content has no partner in shorter pages varies too: descend by all text, led by slots
    path, node, total = [], first, weight[id(first)]
    if not total:
        return None
    while True:
        children = [(weight.get(id(c), 0), c) for c in node.children if not isinstance(c, str) and c.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6")]
        w, best = max(children, key=lambda x: x[0], default=(0, None))
        if best is None or w < 0.9 * total or sum(c.mark() == best.mark() for _, c in children) > 1:
            break
        path.append(best.mark())
        node = best
    if not path or path[-1] in ("html", "body"):
        return None
    constant: list[str] = []
    if holders or len(trees) >= 3:
        marks = frozenset(backed(pages, path))
        held = Counter(b for t in trees if (n := follow(t, path)) for b in set(blocks(n, marks)))
        constant = sorted(b for b, n in held.items() if n >= (holders or len(trees)))
    return path, constant


def extract(page: str | None, path: list[str] | None = None, constant: frozenset[str] = frozenset(), marks: frozenset[str] = frozenset()) -> str:
    """The main text of a page."""
    if not page:
        return ""
    root = parse(page)
    node = follow(root, path) if path else None
    return "\n\n".join(b for b in (blocks(node, marks) if node else own_blocks(root, marks)) if b not in constant)


def references(pages: DataFrame) -> DataFrame:
    """host, hash and html of each host's reference pages; ``pages`` has host and html.

    Greedy in the order of hashes over all pages: a round takes each host's first page and drops what
    is like it.
    """

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of the distinct blocks of each page that has any."""
        for batch in batches(it):
            own = [sorted({xxhash.xxh3_64_intdigest(b) >> 1 for b in own_blocks(parse(page))}) for page in batch.column("html").to_pylist()]
            out = pa.RecordBatch.from_arrays([batch.column("host"), batch.column("hash"), pa.array(own, pa.list_(pa.int64()))], ["host", "hash", "blocks"])
            yield out.filter(pa.array([bool(x) for x in own], pa.bool_()))

    rows = pages.where("host IS NOT NULL AND html <> ''").select("host", F.xxhash64("html").alias("hash"), "html")
    sketches = stored(rows.mapInArrow(sketch, "host string, hash long, blocks array<long>"), "sketches")
    left, chosen = sketches, None
    for _ in range(REFERENCES):
        first = left.groupBy("host").agg(F.min("hash").alias("hash"))
        first = stored(first.join(sketches, ["host", "hash"]).groupBy("host", "hash").agg(F.first("blocks").alias("first")), "references")
        if first.isEmpty():
            break
        chosen = first if chosen is None else chosen.unionByName(first)
        left = left.join(first.drop("hash"), "host").where("2 * size(array_intersect(blocks, first)) < least(size(blocks), size(first))").drop("first")
    return rows.join((first if chosen is None else chosen).select("host", "hash"), ["host", "hash"]).dropDuplicates(["host", "hash"])


def with_wrappers(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` and the wrapper of each one's host, by broadcast or join."""
    chars = known.agg(F.sum(F.length("host") + F.length("wrapper"))).first()[0] or 0
    return rows.join(F.broadcast(known) if chars <= BROADCAST_CHARS else known, "host", "left")


def wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) of every host with unlike pages; ``pages`` has host and html."""

    def solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, found = [], []
        last, held = None, []

        def close() -> None:
            wrapper = induce(held, 2)
            if wrapper:
                hosts.append(last)
                found.append(json.dumps((*wrapper, backed(held, wrapper[0]))))

        for batch in batches(it):
            for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):  # rows come by hash
                if host != last:
                    if len(held) > 1:
                        close()
                    last, held = host, []
                held.append(page)
        if len(held) > 1:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.string())], ["host", "wrapper"])

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A page's longest block of its own, and the numbers of the proposed blocks it holds (-1 for itself)."""
        for batch in batches(it):
            hosts, keys, at = [], [], []
            for host, page, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper")), strict=True):
                path, proposed, marks = json.loads(wrapper)
                node = follow(parse(page), path)
                held = set(blocks(node, frozenset(marks))) if node else set()
                own = held.difference(proposed)
                if own:
                    hosts.append(host)
                    keys.append(xxhash.xxh3_64_intdigest(max(own, key=lambda b: (len(b), b))) >> 1)
                    at.append([-1, *(i for i, b in enumerate(proposed) if b in held)])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(at, pa.list_(pa.int32()))], ["host", "key", "at"])

    def decide(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = []
            for wrapper, counts in zip(batch.column("wrapper").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                path, proposed, marks = json.loads(wrapper)
                n = {c["i"]: c["n"] for c in counts or ()}
                total = n.get(-1, 0)
                found.append(json.dumps((path, [b for i, b in enumerate(proposed) if total >= 3 and 100 * n.get(i, 0) >= CONSTANT_SHARE * total], marks)))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string())], ["host", "wrapper"])

    few = references(pages)
    proposals = stored(few.repartition("host").sortWithinPartitions("host", "hash").mapInArrow(solve, "host string, wrapper string"), "proposals")
    held = with_wrappers(pages.where("html <> ''").select("host", "html"), proposals).where("wrapper IS NOT NULL")
    counted = held.mapInArrow(count, "host string, key long, at array<int>").select("host", "key", F.explode("at").alias("i")).distinct().groupBy("host", "i").agg(F.count("*").alias("n"))
    counts = counted.groupBy("host").agg(F.collect_list(F.struct("i", "n")).alias("counts"))
    return proposals.join(counts, "host", "left").select("host", "wrapper", "counts").mapInArrow(decide, "host string, wrapper string")


def main_texts(pages: DataFrame) -> DataFrame:
    """A row for each page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", F.lower(F.nullif(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"), "html")
    joined = with_wrappers(rows, stored(wrappers(rows), "wrappers"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, tuple[list[str], frozenset[str], frozenset[str]]] = {}
        for batch in batches(it):
            texts = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if wrapper is None:
                    texts.append(extract(page, None))
                    continue
                if wrapper not in read:
                    if len(read) > 10_000:
                        read.clear()
                    path, constant, marks = json.loads(wrapper)
                    read[wrapper] = (path, frozenset(constant), frozenset(marks))
                texts.append(extract(page, *read[wrapper]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
