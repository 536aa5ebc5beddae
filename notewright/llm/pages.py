"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded over the whole tree."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 400  # pages the trees are fitted on, at most
SAMPLE_CHARS = 20_000  # longest page used for fitting
COPIES = 6  # changed copies of each of them
BUILT_PAGES = 100  # pages made up for fitting where none names its article

# Element names by role, and attribute tokens that name content or what surrounds it.
_SKIPPED = set("script style head title noscript template svg iframe object canvas select textarea button".split())
_IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template head".split())
_NOT_NESTED = {"button", "select"}  # one that starts ends the one that is open
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_INLINE = set(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSES_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": set()}
_AROUND_TAGS = set("nav footer aside form header menu dialog".split())
_MAIN_TAGS = set("article main".split())
_AROUND = (
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus footer form header login masthead menu meta modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget"
).split()
_MAIN = "article body content entry main page post story text".split()
_HEADINGS = {f"h{k}" for k in range(1, 7)}
_TEXT_BLOCKS = _HEADINGS | set("p li td th dt dd figcaption caption pre blockquote summary legend".split())
_TABLE = set("table thead tbody tfoot tr td th caption".split())
_REMARKS = set("comment comments discussion discussions reply replies respond response responses thread conversation leave readers".split())
_TOKEN = re.compile(r"[a-z]+")
_SKIPPED_END = re.compile(rf"</({'|'.join(sorted(_SKIPPED))})(?=[\s/>])", re.I)


@dataclass
class Node:
    """An element; ``parts`` are its texts and elements in page order. Plain inline elements are merged into their parent."""

    tag: str
    tokens: list[str] = field(default_factory=list)
    parts: list = field(default_factory=list)

    def children(self) -> list[Node]:
        return [part for part in self.parts if isinstance(part, Node)]


def _built(node: Node) -> tuple[str, ...] | None:
    """How an element is built, if from text and blocks or several blocks: its name, and its runs of text and blocks in order."""
    parts = [node.tag]
    for part in node.parts:
        name = part.tag if isinstance(part, Node) and part.tag not in _INLINE else "#"
        if (name != "#" or parts[-1] != "#") and not (isinstance(part, str) and part.isspace()):
            parts.append(name)
    return tuple(parts) if len(parts) > 2 and node.tag not in _TABLE else None


class _Builder(HTMLParser):
    """Builds the tree. A skipped element ends with its end tag, or without one where it cannot go on: the head at what cannot

    stand in it, others where an element around them closes, and those that never get an end tag at the next block.
    """

    def __init__(self, ends: Counter[str]):
        super().__init__(convert_charrefs=True)
        self.ends = ends  # end tags of skipped elements still to come
        self.root = Node("#root")
        self.open: list[tuple[str, Node]] = [("#root", self.root)]  # names as opened, and where text goes
        self.skipping: list[str] = []  # the skipped element, and what is open in it

    def _close(self, names: set[str], until: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in names:
                del self.open[at:]
                return
            if self.open[at][0] in until:
                return

    def _ends_skipped(self, tag: str) -> bool:
        """Whether the start of an element ends the skipped one that is open."""
        first = self.skipping[0]
        if first == "head":
            return tag == "body" or (tag not in _IN_HEAD and not any(name in _SKIPPED for name in self.skipping[1:]))
        if tag == first and first in _NOT_NESTED:
            return True
        return self.ends[first] <= 0 and (tag in _CLOSES_P or tag == "body")

    def handle_starttag(self, tag, attrs):
        if self.skipping and self._ends_skipped(tag):
            self.skipping.clear()
        if self.skipping:
            if tag not in _VOID and (tag not in _SKIPPED or self.ends[tag] > 0):
                self.skipping.append(tag)
            return
        if tag in _VOID:
            self.open[-1][1].parts.append(" ")
            return
        if tag in _SKIPPED:
            self.skipping.append(tag)
            return
        if tag in _CLOSES_P:
            self._close({"p"}, {"article", "body", "div", "section", "td", "li", "blockquote", "main", "aside", "button"})
        if tag in _CLOSES_SAME:
            self._close({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}, _CLOSES_SAME[tag])
        named = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role"))
        tokens = _TOKEN.findall(named)
        if tag in _INLINE and not tokens and tag != "a":
            self.open.append((tag, self.open[-1][1]))
            return
        node = Node(tag, tokens)
        self.open[-1][1].parts.append(node)
        self.open.append((tag, node))

    def handle_startendtag(self, tag, attrs):
        if tag not in _SKIPPED:
            self.handle_starttag(tag, attrs)
            if tag not in _VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.ends[tag] -= 1
        if self.skipping:
            at = len(self.skipping) - 1
            while at >= 0 and self.skipping[at] != tag:
                at -= 1
            if at >= 0:
                del self.skipping[at:]
                return
            if tag in _INLINE or not any(name == tag for name, _ in self.open):
                return
            self.skipping.clear()
        if tag == "p" and not any(name == "p" for name, _ in self.open):
            self.open[-1][1].parts.append(Node("p"))
        else:
            self._close({tag}, set() if tag not in _INLINE else {"p", "div", "td", "li", "article", "section", "body"})

    def handle_data(self, data):
        if not self.skipping:
            self.open[-1][1].parts.append(data)


def parse(html: str) -> Node:
    builder = _Builder(Counter(name.lower() for name in _SKIPPED_END.findall(html)))
    builder.feed(html)
    builder.close()
    return builder.root


@dataclass
class Flat:
    """The nodes of a tree in page order with their parents' positions."""

    nodes: list[Node]
    parent: np.ndarray

    def tied(self) -> np.ndarray:
        """Inline elements that go with what they stand in: all but links, and links in a block of text or beside text."""
        own = [any(isinstance(p, str) and not p.isspace() for p in n.parts) for n in self.nodes]
        tied = np.zeros(len(self.nodes), bool)
        for at in range(1, len(self.nodes)):
            up = self.parent[at]
            if self.nodes[at].tag in _INLINE:
                tied[at] = self.nodes[at].tag != "a" or tied[up] or own[up] or self.nodes[up].tag in _TEXT_BLOCKS
        return tied

    def alike(self) -> list[list[int]]:
        """Groups of siblings that are built alike from several elements, as readers' comments are; rows of tables are none."""
        groups: dict[tuple, list[int]] = {}
        for at in range(1, len(self.nodes)):
            built = _built(self.nodes[at])
            if built:
                groups.setdefault((int(self.parent[at]), built), []).append(at)
        return [group for group in groups.values() if len(group) > 1]

    @staticmethod
    def of(root: Node) -> Flat:
        nodes, parents, stack = [], [], [(root, -1)]
        while stack:
            node, above = stack.pop()
            at = len(nodes)
            nodes.append(node)
            parents.append(above)
            stack += [(child, at) for child in reversed(node.children())]
        return Flat(nodes, np.array(parents))


def _up(values: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Sums over subtrees; children come after their parents."""
    total = values.astype(np.float64).copy()
    for at in range(len(parent) - 1, 0, -1):
        total[parent[at]] += total[at]
    return total


def node_features(flat: Flat) -> np.ndarray:
    """A row for each node: size and density of its subtree, links, punctuation, tags, attribute tokens, depth and siblings."""
    nodes, parent = flat.nodes, flat.parent
    own_text = [" ".join("".join(p for p in n.parts if isinstance(p, str)).split()) for n in nodes]
    own = np.array([len(t) for t in own_text], np.float64)
    marks = np.array([sum(map(t.count, ".,;:!?")) for t in own_text], np.float64)
    size, stops, elements = _up(own, parent), _up(marks, parent), _up(np.ones(len(nodes)), parent)
    links = _up(np.array([len(t) if n.tag == "a" else 0 for n, t in zip(nodes, own_text, strict=True)]), parent)
    controls = _up(np.array([n.tag in ("form", "input", "label", "fieldset") for n in nodes]), parent)
    around = np.array([sum(t in _AROUND for t in n.tokens) for n in nodes], np.float64)
    main = np.array([sum(t in _MAIN for t in n.tokens) for n in nodes], np.float64)
    around_tag = np.array([n.tag in _AROUND_TAGS for n in nodes], np.float64)
    main_tag = np.array([n.tag in _MAIN_TAGS for n in nodes], np.float64)
    depth, index = np.zeros(len(nodes)), np.zeros(len(nodes))
    above = {name: np.zeros(len(nodes)) for name in ("around", "main", "around_tag", "main_tag")}
    number, same = np.zeros(len(nodes)), np.zeros(len(nodes))
    tags: list[dict[str, int]] = [{} for _ in nodes]
    for at in range(1, len(nodes)):
        up = parent[at]
        depth[at], index[at] = depth[up] + 1, number[up]
        number[up] += 1
        tags[up][nodes[at].tag] = tags[up].get(nodes[at].tag, 0) + 1
        for name, own_values in (("around", around), ("main", main), ("around_tag", around_tag), ("main_tag", main_tag)):
            above[name][at] = above[name][up] + own_values[up]
    # Records: siblings that are built alike from several elements, as reader comments are.
    built = [_built(n) for n in nodes]
    alike: list[dict[tuple, int]] = [{} for _ in nodes]
    opening, passed = np.zeros(len(nodes)), [""] * len(nodes)
    for at in range(len(nodes) - 1, 0, -1):
        up = parent[at]
        if built[at]:
            alike[up][built[at]] = alike[up].get(built[at], 0) + 1
        passed[at] = (own_text[at] or passed[at])[:60]
        passed[up] = passed[at] or passed[up]  # the first text of a subtree, as children are met from the last one on
        opening[at] = any(t in _REMARKS for t in _TOKEN.findall(passed[at].lower()))
    records = np.array([max(a.values(), default=0) for a in alike], np.float64)
    record = np.zeros(len(nodes))
    record[1:] = [alike[p].get(b, 0) for p, b in zip(parent[1:], built[1:], strict=True)]
    within = np.zeros(len(nodes))
    for at in range(1, len(nodes)):
        within[at] = max(within[parent[at]], record[at], opening[at] * 10)
    table = np.array([n.tag in _TABLE for n in nodes], np.float64)
    before, after = np.zeros(len(nodes)), np.zeros(len(nodes))  # sizes of the neighbouring siblings
    last: list[int] = [-1] * len(nodes)
    for at in range(1, len(nodes)):
        other = last[parent[at]]
        if other >= 0:
            before[at], after[other] = size[other], size[at]
        last[parent[at]] = at
    up = np.maximum(parent, 0)
    same[1:] = [tags[p][n.tag] for p, n in zip(parent[1:], nodes[1:], strict=True)]
    siblings = np.maximum(number[up], 1)
    return np.column_stack(
        [
            np.log1p(own),
            np.log1p(size),
            np.log1p(elements),
            size / elements,
            links / (size + 1),
            links[up] / (size[up] + 1),
            stops / (size + 1),
            controls,
            depth,
            index / siblings,
            siblings,
            same / siblings,
            size / (size[up] + 1),
            (size[up] - size) / siblings,
            size / (size[0] + 1),
            around,
            main,
            around_tag,
            main_tag,
            *above.values(),
            [n.tag in _HEADINGS for n in nodes],
            [n.tag == "p" for n in nodes],
            [n.tag in ("li", "td", "th") for n in nodes],
            [n.tag == "a" for n in nodes],
            np.minimum(records, 10),
            np.minimum(record, 10),
            within,
            opening,
            table,
            [t.endswith((".", "!", "?")) for t in own_text],
            np.log1p(before),
            np.log1p(after),
        ]
    ).astype(np.float32)


@dataclass
class Trees:
    """Boosted trees of equal depth: the split of node k of a tree is at k, its halves at 2k + 1 and 2k + 2."""

    start: float
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaves.shape[1]))
        rows = np.arange(len(x))
        for split, limit, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, split[at]] > limit[at])
            out += leaf[at - (2**depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Trees:
    """Second-order boosting of the logistic loss on features cut at quantiles; each level splits where the gain is largest."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    codes = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    share = float(np.clip(y.mean(), 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    odds = np.full(len(y), start)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first = 2**level - 1
            best = np.full(2**level, 1e-6)
            split_code = np.full(2**level, bins)
            chosen = np.zeros(2**level, np.int64)
            for k, code in enumerate(codes):
                key = (at - first) * bins + code
                g = np.bincount(key, gradient, 2**level * bins).reshape(-1, bins).cumsum(axis=1)
                h = np.bincount(key, weight, 2**level * bins).reshape(-1, bins).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                top = gain.argmax(axis=1)
                value = gain[np.arange(len(top)), top]
                better = (value > best) & (top < len(cuts[k]))
                best, split_code, chosen = (
                    np.where(better, value, best),
                    np.where(better, top, split_code),
                    np.where(better, k, chosen),
                )
            for j in range(2**level):
                if split_code[j] < bins:
                    feature[first + j], limit[first + j] = chosen[j], cuts[chosen[j]][split_code[j]]
            at = 2 * at + 1 + (codes[chosen[at - first], np.arange(len(y))] > split_code[at - first])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, gradient, 2**depth) / (np.bincount(leaf, weight, 2**depth) + 1)
        odds += value[leaf]
        trees.append((feature, limit, value))
    return Trees(start, *(np.array(part) for part in zip(*trees, strict=True)))


def decode(
    log_odds: np.ndarray, parent: np.ndarray, tied: np.ndarray | None = None, alike: list[list[int]] | None = None
) -> np.ndarray:
    """Which nodes to keep so that the sum of kept log odds is largest and no kept node has a dropped ancestor.

    From the leaves up, a subtree is worth its root's log odds and what its children are worth
    where that is positive; from the root down, a child is kept if its parent is and it is
    worth something. The root is kept. A tied node goes with its parent, and its own odds do not count. Siblings that
    are ``alike`` are kept or dropped together, by what they are worth on average.
    """
    worth = np.array(log_odds, np.float64)
    worth[0] = 1
    if tied is not None:
        worth[tied] = 0
    together = {min(group): group for group in alike or []}
    held = {at for group in together.values() for at in group}
    for at in range(len(parent) - 1, 0, -1):
        if at in together:  # the others come behind it in page order, so their worth is known
            worth[together[at]] = worth[together[at]].mean()
            worth[parent[at]] += max(0.0, worth[at]) * len(together[at])
        elif at not in held and worth[at] > 0:
            worth[parent[at]] += worth[at]
    kept = np.ones(len(parent), bool)
    for at in range(1, len(parent)):
        kept[at] = kept[parent[at]] and (worth[at] > 0 or tied is not None and bool(tied[at]))
    return kept


def block_text(flat: Flat, kept: np.ndarray) -> str:
    """The kept texts: white space within a block as one space, trimmed, non-empty blocks joined by line breaks."""
    blocks, current = [], []
    at = {id(node): k for k, node in enumerate(flat.nodes)}
    stack: list = [iter(flat.nodes[0].parts)]
    breaks = [True]
    while stack:
        for part in stack[-1]:
            if isinstance(part, str):
                current.append(part)
                continue
            if part.tag not in _INLINE:
                blocks.append("".join(current))
                current = []
            if kept[at[id(part)]]:
                stack.append(iter(part.parts))
                breaks.append(part.tag not in _INLINE)
                break
        else:
            stack.pop()
            if breaks.pop():
                blocks.append("".join(current))
                current = []
    return "\n".join(block for block in (" ".join(b.split()) for b in blocks) if block)


def _weak_labels(flat: Flat) -> np.ndarray | None:
    """1 for nodes of the page's article or main element and above it, 0 for what surrounds it; None without such an element."""
    nodes, parent = flat.nodes, flat.parent
    inside = np.zeros(len(nodes), bool)
    for at, node in enumerate(nodes):
        around = node.tag in _AROUND_TAGS or "#around" in node.tokens or any(t in _AROUND for t in node.tokens)
        is_main = node.tag in _MAIN_TAGS or "#main" in node.tokens
        inside[at] = not around and (is_main or (at > 0 and inside[parent[at]]))
    return (_up(inside, parent) > 0).astype(np.float64) if inside.any() else None


class _Variations:
    """Changed copies of pages for fitting: other names for the article, blocks of other kinds in it, other surroundings."""

    def __init__(self, lines: list[str], seed: int = 5):
        self.draw = random.Random(seed)
        self.lines = lines
        self.words = [w for line in lines for w in line.split()] or ["word"]

    def _line(self) -> str:
        return self.draw.choice(self.lines)

    def _few(self, most: int = 3) -> str:
        return " ".join(self.draw.choices(self.words, k=self.draw.randint(1, most)))

    def _block(self) -> Node:
        """A block as articles have them."""
        draw = self.draw
        short = draw.random() < 0.5

        def text() -> str:
            return self._few() if short else self._line()

        kind = draw.choice(["table", "ul", "ol", "dl", "pre", "figure", "blockquote", "p", "p", "p", "p", "section", "h3", "details"])
        if kind == "table":
            rows = [Node("tr", [], [Node(draw.choice(["td", "td", "th"]), [], [text()]) for _ in range(draw.choice([2, 3]))]) for _ in range(draw.randint(2, 6))]
            return Node("table", [], [Node("tbody", [], rows)] if draw.random() < 0.5 else rows)
        if kind in ("ul", "ol"):
            return Node(kind, [], [Node("li", [], [Node("a", [], [text()]) if draw.random() < 0.2 else text()]) for _ in range(draw.randint(2, 7))])
        if kind == "dl":
            return Node("dl", [], [Node(tag, [], [self._few() if tag == "dt" else text()]) for _ in range(draw.randint(1, 4)) for tag in ("dt", "dd")])
        if kind == "figure":
            return Node("figure", [], [" ", Node("figcaption", [], [text()])])
        if kind == "blockquote":
            return Node("blockquote", [], [Node("p", [], [self._line()])] if draw.random() < 0.5 else [self._line()])
        if kind == "section":
            return Node("section", [], [Node("h2", [], [self._few(5)]), *(Node("p", [], [self._line()]) for _ in range(draw.randint(1, 3)))])
        if kind == "p":  # a sentence with links
            parts: list = [self._few(6) + " "] if draw.random() < 0.7 else []
            for _ in range(draw.randint(1, 3)):
                parts += [Node("a", [], [self._few()]), " " + self._few(draw.choice([1, 4, 12])) + " "]
            return Node("p", [], [*parts, draw.choice([".", "", self._line()])])
        return Node(kind, [], [text()])

    def _remarks(self) -> Node:
        """Comments of readers, a repeated author and text, under names that say nothing."""
        draw = self.draw
        name, tag = draw.choice([[], ["list"], ["c", "list"], ["discussion"], ["items"], ["box"]]), draw.choice(["div", "li", "article", "section"])
        author, when = draw.choice(["b", "span", "div", "p", "h4"]), draw.choice(["time", "span", "div"])
        short, dated = draw.random() < 0.5, draw.random() < 0.5

        def one() -> Node:
            parts = [Node(author, draw.choice([[], ["who"], ["name"]]), [self._few(2)])]
            if dated:
                parts.append(Node(when, [], [f"{draw.randint(1, 28)} {self._few(1)} {draw.randint(1, 12)}:{draw.randint(10, 59)}"]))
            return Node(tag, ["#around"], [*parts, Node("p", [], [self._few(12) if short else self._line()])])

        heads = [Node(draw.choice(["h2", "h3", "div"]), [], [draw.choice(["Comments", "Discussion", f"{draw.randint(2, 40)} replies", "Readers said", self._few()])])]
        items = [one() for _ in range(draw.randint(2, 8))]
        return Node(draw.choice(["div", "section", "ul"]), [*name, "#around"], [*(heads if draw.random() < 0.6 else []), *items])

    def _around(self) -> Node:
        draw = self.draw
        if draw.random() < 0.35:
            return self._remarks()
        tag = draw.choice(["p", "div", "li"])
        inner = [Node(tag, [], [Node("a", [], [self._few()]) if draw.random() < 0.4 else self._line()]) for _ in range(draw.randint(1, 4))]
        if draw.random() < 0.7:
            return Node(draw.choice(["div", "section", "ul", "p"]), [draw.choice(_AROUND)], inner)
        return Node(draw.choice(sorted(_AROUND_TAGS)), [], inner)

    def page(self) -> Node:
        """A page of its own, for tables whose pages name no article."""
        draw = self.draw
        article = Node("main", [], [Node("h1", [], [self._few(6)]), *(Node("p", [], [self._line()]) for _ in range(draw.randint(1, 8)))])
        menu = Node("nav", [], [Node("ul", [], [Node("li", [], [Node("a", [], [self._few(2)])]) for _ in range(draw.randint(2, 6))])])
        return Node("#root", [], [Node("body", [], [menu, article, Node("footer", [], [Node("p", [], [self._few(8)])])])])

    def copy(self, root: Node) -> Node:
        """A page with its article under another name, and drawn blocks and surroundings in places of their own."""
        draw = self.draw
        found: list[Node] = [Node("#top")]
        todo = [(root, found[0])]
        while todo:  # deep pages are copied without recursion
            node, into = todo.pop()
            tag, tokens = node.tag, list(node.tokens)
            if tag in _MAIN_TAGS:
                tag = draw.choice(["div", "section", "article", "main"])
                tokens = [*tokens, *draw.choice([[], [draw.choice(_MAIN)]]), "#main"]
            out = Node(tag, tokens, list(node.parts))
            if into.tag == "#top":
                into.parts.append(out)
            else:
                into.parts[next(k for k, p in enumerate(into.parts) if p is node)] = out
            todo += [(child, out) for child in out.children()]
            found.append(out)
        for out in found[1:]:
            if "#main" in out.tokens:
                for _ in range(draw.randrange(5)):
                    out.parts.insert(draw.randrange(len(out.parts) + 1), self._block())
                if draw.random() < 0.3:  # a plain box around what the article holds
                    out.parts = [Node("div", draw.choice([[], ["content"], ["text"], ["wrap"]]), out.parts)]
            if "#main" in out.tokens or out.tag == "body":
                for _ in range(draw.randrange(3)):
                    out.parts.insert(draw.choice([0, len(out.parts), draw.randrange(len(out.parts) + 1)]), self._around())
        return found[1]


def fit(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS
) -> Trees | None:
    """Trees from a bounded sample: the first ``sample_pages`` by hash of the id, of pages of ``sample_chars`` at most.

    Labels come from the pages' own article and main elements. Each page is also seen in changed copies, in which those elements
    have other names, hold tables, lists, definitions, code, figures and links, and stand among other surroundings, readers' comments
    under plain names included, so that no single tag decides. Where no page has such an element, pages built from the texts
    stand in. None if there is no page.
    """
    mark = F.xxhash64(id_col, html_col)
    usable = pages.filter(F.length(html_col).between(1, sample_chars))
    chosen = usable.select(mark.alias("mark")).orderBy("mark").limit(sample_pages)  # only marks are sorted and gathered
    found = usable.select(mark.alias("mark"), F.col(html_col).alias("html")).join(F.broadcast(chosen), "mark", "left_semi")
    rows = sorted(found.dropDuplicates(["mark"]).collect())
    if not rows:
        return None
    roots = [parse(row.html) for row in rows]
    texts = [block_text(f, np.ones(len(f.nodes), bool)) for f in map(Flat.of, roots)]
    made = _Variations([line for text in texts for line in text.split("\n")[:20] if line] or ["text"])
    if all(_weak_labels(Flat.of(root)) is None for root in roots):
        roots = [made.page() for _ in range(BUILT_PAGES)]
    x, y = [], []
    for root in roots:
        for tree in (root, *(made.copy(root) for _ in range(COPIES))):
            flat = Flat.of(tree)
            labels = _weak_labels(flat)
            if labels is not None:
                free = ~flat.tied()
                x.append(node_features(flat)[free])
                y.append(labels[free])
    return fit_trees(np.vstack(x), np.concatenate(y))


def main_texts(pages: list[str], trees: Trees | None) -> list[str]:
    """The main text of each page; without trees, all of its text. The trees see the nodes of all pages at once."""
    flats = [Flat.of(parse(html)) for html in pages]
    if trees is None or not flats:
        return [block_text(flat, np.ones(len(flat.nodes), bool)) for flat in flats]
    odds = trees.log_odds(np.vstack([node_features(flat) for flat in flats]))
    ends = np.cumsum([len(flat.nodes) for flat in flats])
    return [block_text(f, decode(part, f.parent, f.tied(), f.alike())) for f, part in zip(flats, np.split(odds, ends[:-1]), strict=True)]


def _grouped(pages: list[str]) -> Iterator[list[str]]:
    """Runs of pages of about a megabyte, a longer page by itself."""
    group, size = [], 0
    for html in pages:
        if group and size + len(html) > 1 << 20:
            yield group
            group, size = [], 0
        group.append(html)
        size += len(html)
    if group:
        yield group


def extract(pages: DataFrame, trees: Trees | None, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` without the html, with the main text of each: never null, empty if there is none.

    Character references are decoded, white space inside a block is one space, blocks are in page order, one a line. Null and empty
    pages give an empty text; without trees, which only an empty sample gives, a page's whole text is returned; repeated rows each get theirs; a table without rows stays
    empty; a column named like the new one is replaced.
    """
    others = [name for name in pages.columns if name not in (html_col, into)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*others).schema), f"`{into}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [html or "" for html in batch.column(len(others)).to_pylist()]
            texts = [text for group in _grouped(sources) for text in main_texts(group, trees)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], [*others, into])

    return pages.select(*others, html_col).mapInArrow(run, schema)
