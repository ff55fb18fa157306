"""HTML extraction by wrapper induction: the pages of a host are aligned to find template and content.

Each page becomes a small tree of block elements with their own text. Its layout is the tree with runs
of like siblings made one. Two different pages of every layout of a host, or of the host where a layout
has one page alone, are its references: a page is aligned with them by simple tree matching, the order
keeping matching of two trees that pairs the most nodes of one label, level by level. A text that the
alignment pairs with an equal one is constant, one paired with another text or none is a slot. So that
every page of a host has a say, and not the references alone, a constant text is template only if most
of the other pages with its place (the labels from the root) have the same text there equally often.

A slot's role comes from the template nodes around it: navigation, headers, footers, asides, forms,
adverts, notices and comments, by element, ARIA role, class or id, are not content. The content is what
varies within the page's main region: its articles, or its main element without articles that hold
less of the varying text than the rest of it; else the least subtree that holds most of the varying
text. Within a region, text that only one other page shares stays, and all of it where template would
be the greater part: such pages are copies. Without other pages, or if nothing varies, the roles alone
decide.

Matching two lists of n and m siblings takes n * m steps, in rows of numpy, after equal heads and tails
are set aside; subtrees of one shape are matched once. Nothing recurses, so nesting may be of any depth,
and markup is read in one pass, whatever is left unclosed.

Scale: pages are parsed once, to a table of their trees. Texts travel as two hashes to where they are
counted, once for equal pages; a host's row has its constant texts, of each place fewer than twice what a page has there, and a
layout's row two trees of hashes. Pages meet their rows in inner equi-joins, so that a hot host is split
by adaptive execution.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

MOST = 0.6

# HTML's void elements, elements without content text, blocks, and names of what isn't an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math canvas object audio video textarea select option datalist head title button".split())
SKIPPED = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead comment comments disqus respond share sharing social related newsletter subscribe popup modal overlay widget pagination pager toolbar skip".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}

_OPEN = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/>=])([^\s=\"'>/]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"[a-z]+")


def _role(tag: str, attributes: str, inside_article: bool) -> tuple[str, bool]:
    """(class names, whether the element isn't content)."""
    aside = tag in SKIPPED or tag == "header" and not inside_article
    if "=" not in attributes:
        return "", aside
    found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    names = found.get("class", "")
    if tag not in ("html", "body", "article", "main"):
        words = set(_NAME.findall(f"{names} {found.get('id', '')}".lower()))
        if words & NAMES or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true":
            aside = True
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) or "display:none" in found.get("style", "").replace(" ", ""):
        aside = True
    return names, aside


class Tree:
    """Nodes in order, each with its parent's number (-1: the root), label and text (None: an element)."""

    def __init__(self, parents: Iterable[int] = (), labels: Iterable[str] = (), texts: Iterable[str | None] = ()) -> None:
        self.parents, self.labels, self.texts = list(parents), list(labels), list(texts)
        self.tags = [x.partition(".")[0] for x in self.labels]
        self.asides = [False] * len(self.tags)

    def add(self, parent: int, tag: str, label: str, text: str | None = None, aside: bool = False) -> int:
        for column, x in ((self.tags, tag), (self.labels, label), (self.parents, parent), (self.texts, text), (self.asides, aside)):
            column.append(x)
        return len(self.tags) - 1


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the ">" of a tag stands whose name ends at ``at``: not within a quoted value, unless the quote is never closed; -1 without any."""
    i = at
    while m := _STOP.search(page, i):
        if m[0] == ">":
            return m.start()
        quote = m[0][-1]
        if m.end() > last[quote]:
            break
        i = page.index(quote, m.end()) + 1
    return page.find(">", at)


def parse(page: str | None) -> Tree:
    """A page's tree of block elements and texts ("#" nodes, one per block's run of inline content, white space made one); raw elements and comments are gone."""
    tree = Tree()
    stack = [tree.add(-1, "#root", "#root")]
    open_: Counter = Counter()
    landmarks = 0  # open articles and mains
    run: list[str] = []

    def close_run() -> None:
        if run:
            if text := " ".join("".join(run).split()):
                tree.add(stack[-1], "#", "#", text)
            run.clear()

    def pop(until: int) -> None:
        nonlocal landmarks
        close_run()
        for k in stack[until:]:
            open_[tree.tags[k]] -= 1
            landmarks -= tree.tags[k] in ("article", "main")
        del stack[until:]

    page = page or ""
    last = {q: page.rfind(q) for q in "\"'"}
    at, end = 0, len(page)
    while at < end:
        less = page.find("<", at)
        if less < 0:
            run.append(html.unescape(page[at:]))
            break
        if less > at:
            run.append(html.unescape(page[at:less]))
        if page.startswith("<!--", less):
            at = page.find("-->", less + 4)
            at = at + 3 if at >= 0 else end
            continue
        if page.startswith("<![CDATA[", less):
            at = page.find("]]>", less)
            at = at + 3 if at >= 0 else end
            continue
        if page.startswith(("<!", "<?"), less):
            at = page.find(">", less)
            at = at + 1 if at >= 0 else end
            continue
        m = _OPEN.match(page, less + 1)
        if not m:
            run.append("<")
            at = less + 1
            continue
        close = _tag_end(page, m.end(), last)
        if close < 0:
            break  # a tag that never ends takes the rest of the page with it
        tag, attributes, at = m[2].lower(), page[m.end() : close], close + 1
        if tag in RAW:
            if not m[1] and not attributes.endswith("/"):
                over = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                at = over.end() if over else end
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in BLOCKS:
            if tag == "img":
                run.append(" ")
            continue
        close_run()
        if m[1]:
            if open_[tag]:
                pop(next(k for k in range(len(stack) - 1, 0, -1) if tree.tags[stack[k]] == tag))
            continue
        # A block ends an open paragraph; items, rows and cells end their like.
        if tree.tags[stack[-1]] == "p":
            pop(len(stack) - 1)
        if any(open_[x] for x in CLOSES.get(tag, ())):
            for k in range(len(stack) - 1, 0, -1):
                if tree.tags[stack[k]] in STOPS.get(tag, ()):
                    break
                if tree.tags[stack[k]] in CLOSES[tag]:
                    pop(k)
        if tag == "hr":
            continue
        names, aside = _role(tag, attributes, landmarks > 0)
        stack.append(tree.add(stack[-1], tag, f"{tag}.{names}" if names else tag, aside=aside))
        open_[tag] += 1
        landmarks += tag in ("article", "main")
    close_run()
    return tree


def kept(tree: Tree) -> Tree:
    """The tree without what isn't content by its role, and without empty blocks."""
    n = len(tree.tags)
    gone, full = list(tree.asides), [x is not None for x in tree.texts]
    for i in range(1, n):
        gone[i] = gone[i] or gone[tree.parents[i]]
    for i in range(n - 1, 0, -1):
        full[i] = full[i] and not gone[i]
        full[tree.parents[i]] |= full[i]
    out, place = Tree(), [0] * n
    for i in range(n):
        if i == 0 or full[i]:
            place[i] = out.add(place[tree.parents[i]] if i else -1, tree.tags[i], tree.labels[i], tree.texts[i])
    return out


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 11


class Shape:
    """A tree of hashes for alignment: parents, labels and texts (0: an element) by node."""

    def __init__(self, parents: list[int], labels: list[int], texts: list[int]):
        self.parents, self.labels, self.texts = parents, labels, texts
        n = len(parents)
        self.children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            self.children[parents[i]].append(i)
        self.form, self.whole, self.size = [0] * n, [0] * n, [1] * n  # equal numbers: equal but for texts; equal at all
        for i in range(n - 1, -1, -1):
            self.form[i] = hash((labels[i], *(self.form[c] for c in self.children[i])))
            self.whole[i] = hash((labels[i], texts[i], *(self.whole[c] for c in self.children[i])))
            if i:
                self.size[parents[i]] += self.size[i]

    def layout(self) -> int:
        """The tree with runs of like siblings made one."""
        form = [0] * len(self.parents)
        for i in range(len(form) - 1, -1, -1):
            inner: list[int] = []
            for c in self.children[i]:
                if not inner or inner[-1] != form[c]:
                    inner.append(form[c])
            form[i] = hash((self.labels[i], *inner))
        return form[0]


def shape_of(tree: Tree) -> Shape:
    known: dict[str, int] = {}
    labels = [known[x] if x in known else known.setdefault(x, hash_of(x)) for x in tree.labels]
    return Shape(tree.parents, labels, [0 if t is None else hash_of(t) | 1 for t in tree.texts])


def _matched(n: int, m: int, weights: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """The order keeping matching of two lists of the greatest weight, given rows of weights; pairs of weight 0 are none."""
    best = np.zeros(m + 1, np.int64)
    steps: list[np.ndarray] = []  # of each row, packed: a cell's best stands in the row before; or in the cell before
    for i in range(n):
        w = weights(i)
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(best[1:], np.where(w > 0, best[:-1] + w, 0)))])
        steps.append(np.stack([np.packbits(row == best), np.packbits(np.concatenate([[True], row[1:] == row[:-1]]))]))
        best = row
    pairs, i, j = [], n, m
    while i and j:
        up, left = (steps[i - 1][k][j >> 3] >> (7 - (j & 7)) & 1 for k in (0, 1))
        if up:
            i -= 1
        elif left:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


class Alignment:
    """Simple tree matching of two trees. A pair of nodes weighs the pairs that the best matching below it has; equal subtrees weigh as much again, so that equal texts meet."""

    def __init__(self, a: Shape, b: Shape):
        self.a, self.b = a, b
        self.known: dict[tuple[int, int], int] = {}

    def _weights(self, xs: list[int], ys: list[int], ask: list[tuple[int, int]]) -> Callable[[int], np.ndarray]:
        """Rows of weights of pairs of children; pairs whose forms aren't known yet are asked for."""
        a, b = self.a, self.b
        first_x, first_y = {a.form[x]: x for x in xs}, {b.form[y]: y for y in ys}
        table = np.zeros((len(first_x), len(first_y)), np.int64)
        for i, (f, x) in enumerate(first_x.items()):
            for j, (g, y) in enumerate(first_y.items()):
                if a.labels[x] == b.labels[y]:
                    if f == g:
                        table[i, j] = a.size[x]
                    elif (f, g) in self.known:
                        table[i, j] = self.known[f, g]
                    else:
                        ask.append((x, y))
        place_x, place_y = ({f: i for i, f in enumerate(first)} for first in (first_x, first_y))
        at_y, whole_y = np.array([place_y[b.form[y]] for y in ys]), np.array([b.whole[y] for y in ys])

        def row(i: int) -> np.ndarray:
            w = table[place_x[a.form[xs[i]]]][at_y]
            return 2 * w + w * (whole_y == a.whole[xs[i]])

        return row

    def _weigh(self, x: int, y: int) -> None:
        """Makes the weight of a pair of forms known, those below it first."""
        todo = [(x, y)]
        while todo:
            x, y = todo[-1]
            xs, ys = self.a.children[x], self.b.children[y]
            ask: list[tuple[int, int]] = []
            if (self.a.form[x], self.b.form[y]) not in self.known:
                row = self._weights(xs, ys, ask)
                if ask:
                    todo += ask
                    continue
                self.known[self.a.form[x], self.b.form[y]] = 1 + sum(int(row(i)[j]) // 2 for i, j in (_matched(len(xs), len(ys), row) if ys else ()))
            todo.pop()

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Pairs of nodes, from the roots down."""
        a, b = self.a, self.b
        todo = [(0, 0)] if a.labels[0] == b.labels[0] else []
        while todo:
            x, y = todo.pop()
            yield x, y
            xs, ys = a.children[x], b.children[y]
            head = 0
            while head < min(len(xs), len(ys)) and a.whole[xs[head]] == b.whole[ys[head]]:
                head += 1
            tail = 0
            while tail < min(len(xs), len(ys)) - head and a.whole[xs[-1 - tail]] == b.whole[ys[-1 - tail]]:
                tail += 1
            todo += zip(xs[:head], ys[:head], strict=True)
            todo += zip(xs[len(xs) - tail :], ys[len(ys) - tail :], strict=True)
            xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
            if xs and ys:
                ask: list[tuple[int, int]] = []
                self._weights(xs, ys, ask)
                for u, v in ask:
                    self._weigh(u, v)
                todo += [(xs[i], ys[j]) for i, j in _matched(len(xs), len(ys), self._weights(xs, ys, []))]


def marks(tree: Tree) -> list[tuple[int, int, int]]:
    """(text node, place, key) in order: the place is the labels from the root; the key has the text and how often it stands at that place, too."""
    import xxhash

    paths = [0] * len(tree.tags)
    for i in range(1, len(paths)):
        paths[i] = xxhash.xxh3_64_intdigest(tree.labels[i].encode("utf-8", "surrogatepass"), paths[tree.parents[i]]) >> 11 if tree.texts[i] is None else paths[tree.parents[i]]
    leaves = [i for i, t in enumerate(tree.texts) if t is not None]
    times = Counter((paths[i], tree.texts[i]) for i in leaves)
    return [(i, paths[i], hash_of(f"{paths[i]}\0{times[paths[i], tree.texts[i]]}\0{tree.texts[i]}")) for i in leaves]


def own_of(marked: list[tuple[int, int, int]]) -> int:
    """A page's number: pages with equal texts at equal places share it."""
    import xxhash

    return xxhash.xxh3_64_intdigest(b"".join(k.to_bytes(8) for _, _, k in marked)) >> 1


def constant(tree: Tree, references: Iterable[Shape]) -> set[int]:
    """Text nodes that the alignment with a reference pairs with an equal text."""
    shape, out = shape_of(tree), set()
    for other in references:
        out |= {x for x, y in Alignment(shape, other).pairs() if shape.texts[x] and shape.texts[x] == other.texts[y]}
    return out


def extract(page: str | None, many: Collection[int] = (), two: Collection[int] = (), references: Iterable[tuple[int, Shape]] = ()) -> str:
    """The main text of a page, given the keys of its host's constant texts (see ``constants``) and its references, each with its number."""
    return content(kept(parse(page)), many, two, references)


def content(tree: Tree, many: Collection[int], two: Collection[int], references: Iterable[tuple[int, Shape]]) -> str:
    """The main text of a tree that ``kept`` gave."""
    marked = marks(tree)
    if not marked:
        return ""
    keys = {i: k for i, _, k in marked}
    counted = {i for i, k in keys.items() if k in many or k in two}
    own = own_of(marked)
    template = counted & constant(tree, [s for number, s in references if number != own][:2]) if counted else set()
    leaves = [i for i, _, _ in marked]
    varying = [i for i in leaves if i not in template] or leaves
    size = lambda nodes: sum(len(tree.texts[i]) for i in nodes if i in chosen)
    chosen = set(varying)
    within = {tag: [False] * len(tree.tags) for tag in ("article", "main")}
    for i in range(1, len(tree.tags)):
        for tag, inner in within.items():
            inner[i] = inner[tree.parents[i]] or tree.tags[i] == tag
    articles, mains = ([i for i in leaves if within[tag][i]] for tag in ("article", "main"))
    inside = set(articles)
    region = None if mains and not articles else _region(tree, chosen - inside)
    # Articles beside a larger story are teasers.
    rest = [i for i in (mains or region or []) if i not in inside]
    if articles and size(rest) <= size(articles):
        rest = articles
    elif not rest:
        return " ".join(tree.texts[i] for i in varying)
    # Two pages that agree are small evidence against a region's text; and where most of it is on most pages, they are copies, not template.
    left = [i for i in rest if i not in template or keys[i] not in many]
    if 2 * sum(len(tree.texts[i]) for i in left) < sum(len(tree.texts[i]) for i in rest):
        left = rest
    return " ".join(tree.texts[i] for i in left)


def _region(tree: Tree, chosen: set[int]) -> list[int] | None:
    """The texts of the least subtree that holds most of the chosen ones; None if that is the page itself."""
    n = len(tree.tags)
    sizes = [len(tree.texts[i]) if i in chosen else 0 for i in range(n)]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        sizes[tree.parents[i]] += sizes[i]
        children[tree.parents[i]].append(i)
    at = 0
    while True:
        inner = max(reversed(children[at]), key=sizes.__getitem__, default=None)
        if inner is None or tree.tags[inner] in ("#", "p") or not sizes[inner] or sizes[inner] < MOST * sizes[0]:
            break
        at = inner
    if tree.tags[at] in ("html", "body", "#root"):
        return None
    under = [False] * n
    under[at] = True
    for i in range(at + 1, n):
        under[i] = under[tree.parents[i]]
    return [i for i in range(at, n) if under[i] and tree.texts[i] is not None]


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def read(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, html) -> (page_id, url, host, own, layout, places, keys, tree, shape) for each row; the tree is what ``Tree`` takes, the shape what ``Shape`` takes."""

    def one(page: str | None) -> tuple:
        tree = kept(parse(page))
        marked, shape = marks(tree), shape_of(tree)
        pairs = sorted({(p, k) for _, p, k in marked} | {(p, -1) for _, p, _ in marked})
        return own_of(marked), shape.layout(), [p for p, _ in pairs], [k for _, k in pairs], *({c: getattr(x, c) for c in ("parents", "labels", "texts")} for x in (tree, shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints, longs, strings = (pa.list_(t()) for t in (pa.int32, pa.int64, pa.string))
        types = (pa.int64(), pa.int64(), longs, longs, *(pa.struct([("parents", ints), ("labels", t), ("texts", t)]) for t in (strings, longs)))
        for batch in batches:
            for part in (batch.slice(i, 32) for i in range(0, batch.num_rows, 32)):
                rows = [one(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "host")), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=["page_id", "url", "host", "own", "layout", "places", "keys", "tree", "shape"])

    kinds = dict(pages.dtypes)
    struct = lambda t: f"struct<parents: array<int>, labels: array<{t}>, texts: array<{t}>>"
    return pages.select("page_id", "url", "host", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, own long, layout long, places array<long>, keys array<long>, tree {struct('string')}, shape {struct('long')}")


def constants(rows: DataFrame) -> DataFrame:
    """(host, many, two) of what ``read`` gives: keys of the texts that stand, equal, on most of the host's other pages with their place; on three different pages or more, or on two."""
    rows = rows.where("host != '' and size(keys) > 0").select("host", "own", "places", "keys").dropDuplicates(["host", "own"])
    each = rows.select("host", F.explode(F.arrays_zip("places", "keys")).alias("x")).select("host", F.col("x.places").alias("place"), F.col("x.keys").alias("key"))
    counts = cut(each.groupBy("host", "place", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    # Key -1 stands for the place itself.
    of = counts.where("key = -1").select("host", "place", F.col("c").alias("n"))
    most = counts.where("key != -1").join(of, ["host", "place"]).where("2 * (c - 1) > n - 1")
    return most.groupBy("host").agg(*(F.collect_set(F.when(F.col("c") > 2 if many else F.col("c") == 2, F.col("key"))).alias("many" if many else "two") for many in (True, False)))


def references(rows: DataFrame) -> DataFrame:
    """(host, layout, refs): of each layout the pages with the least and the greatest number; of the host those too, for layouts with one page."""
    page = F.struct("own", "shape")
    of = cut(rows.where("host != '' and size(keys) > 0").groupBy("host", "layout").agg(F.min(page).alias("a"), F.max(page).alias("b")))
    host = of.groupBy("host").agg(F.min("a").alias("c"), F.max("b").alias("d"))
    alone = F.col("a.own") == F.col("b.own")
    return of.join(host, "host").select("host", "layout", F.when(alone, F.array("c", "d")).otherwise(F.array("a", "b")).alias("refs"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row.

    Nulls: null html is empty and gives an empty text; a null url has no host, so that roles alone
    decide; a null page_id is an id like others. Markup without text gives an empty text. Pages are
    read whole. Repeated rows repeat; pages with equal texts at equal places count as one. An empty
    table gives no rows. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    kind = dict(pages.dtypes)["page_id"]
    rows = cut(read(pages.select("page_id", F.col("url").cast("string").alias("url"), "html", host_of(F.col("url")).alias("host"))))
    found = cut(constants(rows)).withColumnRenamed("host", "h")
    # Pages of hosts without constant texts have nothing to align for.
    shown = cut(references(rows).join(found.select("h"), F.col("host") == F.col("h"), "left_semi")).withColumnsRenamed({"host": "r", "layout": "l"})
    some, out = rows.where("host != ''"), ["page_id", "url", "tree", "many", "two", "refs"]
    joined = some.join(found, some["host"] == found["h"], "left").join(shown, (some["host"] == shown["r"]) & (some["layout"] == shown["l"]), "left").select(*out)
    joined = joined.unionByName(rows.where("host = ''").select("page_id", "url", "tree"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 32) for i in range(0, batch.num_rows, 32)):
                texts = [content(Tree(**tree), set(many or ()), set(two or ()), ((r["own"], Shape(**r["shape"])) for r in refs or ())) for tree, many, two, refs in zip(*(part.column(c).to_pylist() for c in out[2:]), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
