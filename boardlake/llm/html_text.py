"""HTML extraction: a tree-structured graphical model over DOM nodes, trained here from labelled pages.

Each page is parsed to its DOM tree. Every node has a hidden state, content or not: a unary potential from its features
(tag, words in its class and id, links, text length) and a potential for each edge from the parent's state to its own.
Sum-product messages go up from the leaves and down from the root, for all pages of a batch at once, level by level, and
give each node its content marginal. A text belongs to the main text if the marginal of its node is 0.5 or more. Text nodes
that stand loose in a block are joined with it.

The potentials are trained by gradient steps on the exact likelihood of labelled trees (`labelled_pages` makes them by
rule: articles in several kinds of mark-up among menus, headers, footers, sidebars, notices, adverts, forms and comments).

Script, style and other unseen elements have no text. White space inside a block, `<br>` included, becomes one blank; the
blocks are trimmed and joined by a line feed.

Defined results: a null or empty html, or one without text, gives the empty text. Broken mark-up is read as browsers do in
the common cases: unclosed elements end with their parent, a `<` that opens no tag is text. Repeated rows and null ids are
extracted like any other, other columns are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template textarea title iframe svg math object select option datalist canvas audio video head".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul center".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
#: An open element of the first kind ends where one of the second begins.
ENDS = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "option": {"option"}}
ENDED_BY = {name: [k for k, ends in ENDS.items() if name in ends] for name in BLOCKS | set(ENDS)}
#: Elements below this depth hang from their ancestor at it, the limit of common browsers; no text is lost.
MAX_DEPTH = 512
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.DOTALL)
NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)

#: Words in class, id or role that speak for or against content, by theme.
THEMES = {
    "menu": "nav menu navbar breadcrumb breadcrumbs topbar toc pagination pager tabs navigation skip", "head": "header masthead banner logo branding hero top", "foot": "footer copyright colophon bottom legal imprint contentinfo",
    "side": "sidebar aside widget rail related recommended recommend popular trending more teaser teasers links blogroll tags complementary", "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense adbox banner-ad outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall", "form": "form search login comment-form input", "talk": "comment comments reply replies disqus discussion respond responses thread",
    "share": "share sharing social tools toolbar actions buttons follow", "main": "content main article post entry story body text maincontent articlebody page hentry prose",
    "byline": "meta byline date author caption credit",
}
THEME_OF = {w: k for k, words in enumerate(THEMES.values()) for w in words.split()}
TAGS = "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre figure figcaption nav header footer aside form button label fieldset a b i em strong span small code center address details summary #text".split()
TAG_OF = {t: i for i, t in enumerate(TAGS)}
N_TAGS, N_THEMES = len(TAGS) + 1, len(THEMES)
#: Features: tag, themes, link share in four steps, text length in five, parent's tag, a constant.
LINK_AT, SIZE_AT = N_TAGS + N_THEMES, N_TAGS + N_THEMES + 4
PARENT_AT = SIZE_AT + 5
N_FEATURES = PARENT_AT + N_TAGS + 1
#: An edge has a table of potentials for each group of child tags: sectioning, text, inline.
EDGE_KINDS = 3
STRUCTURE = frozenset("nav header footer aside form div section main article body ul ol table button fieldset details".split())


class Tree:
    """The nodes of one page in document order: parent, tag, themes, own text; text nodes are nodes."""

    __slots__ = ("parent", "tag", "named", "text")

    def __init__(self):
        self.parent, self.tag, self.named, self.text = [], [], [], []

    def add(self, parent: int, tag: str, named: str = "", text: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.named.append(named)
        self.text.append(text)
        return len(self.parent) - 1


class OpenElements:
    """The stack of open elements, with the places of each name, so that closing one never searches the stack."""

    def __init__(self, root: int):
        self.names, self.nodes, self.hidden = ["html"], [root], 0
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of block elements
        self.walls: list[int] = []  # of those that no implied end tag crosses

    def top(self) -> int:
        """Where the next node hangs: the innermost open element, or at the greatest depth its ancestor there, as in browsers."""
        return self.nodes[min(len(self.nodes), MAX_DEPTH) - 1]

    def last(self, name: str) -> int:
        found = self.places.get(name)
        return found[-1] if found else 0

    def push(self, name: str, node: int) -> None:
        at = len(self.names)
        self.names.append(name), self.nodes.append(node)
        self.places.setdefault(name, []).append(at)
        if name in BLOCKS:
            self.blocks.append(at)
            if name != "p":
                self.walls.append(at)
        self.hidden += name in UNSEEN

    def close(self, at: int) -> None:
        """Ends the element at this place and all inside."""
        while len(self.names) > at:
            name = self.names.pop()
            self.nodes.pop(), self.places[name].pop()
            self.hidden -= name in UNSEEN
            if name in BLOCKS:
                self.blocks.pop()
                if name != "p":
                    self.walls.pop()

    def end_tag(self, name: str) -> None:
        at = self.last(name)
        if at and not (name in INLINE and self.blocks and self.blocks[-1] > at):
            self.close(at)

    def implied_end(self, name: str) -> None:
        """Ends what may not hold an element of this name."""
        at = max(map(self.last, ENDED_BY.get(name, ())), default=0)
        if at and at >= (self.walls[-1] if self.walls else 0):
            self.close(at)


def parse(page: str) -> Tree:
    """The DOM tree of a page, with text nodes (tag "#text") and one "br" node for each line break, in time linear in its length."""
    tree = Tree()
    stack = OpenElements(root := tree.add(-1, "html"))
    at, n = 0, len(page)

    def put(raw: str) -> None:
        if raw and not stack.hidden:
            tree.add(stack.top(), "#text", "", entities.unescape(raw) if "&" in raw else raw)

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        attributes = m[3] or m[6] or ""
        if m[1] or m[4]:
            stack.end_tag(name)
            continue
        if name in ("html", "body"):
            if name == "body" and not stack.last("body"):
                stack.close(1)
                stack.push("body", tree.add(root, "body", themed(attributes)))
            continue
        stack.implied_end(name)
        if name in VOID:
            if name in ("br", "hr") and not stack.hidden:
                tree.add(stack.top(), name)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if attributes.endswith("/") and name not in BLOCKS and name not in INLINE:
            continue
        stack.push(name, stack.top() if stack.hidden else tree.add(stack.top(), name, themed(attributes)))
    return tree


def themed(attributes: str | None) -> str:
    """The class, id and role words of a start tag, and "hidden" where it is not shown."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return ""
    return " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower()


def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all nodes of all trees: parent (-1 for roots), depth, edge kind, and (node, feature) pairs."""
    parents, edges, nodes, feats = [], [], [], []
    base = 0
    text_size, link_size, tags = [], [], []
    for t in trees:
        n = len(t.parent)
        size, linked = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            if t.tag[i] == "#text":
                size[i] = len(t.text[i].strip())
            elif t.tag[i] == "a":
                linked[i] = size[i]
            p = t.parent[i]
            if p >= 0:
                size[p] += size[i]
                linked[p] += linked[i]
        text_size += size
        link_size += linked
        for i in range(n):
            tag = TAG_OF.get(t.tag[i], N_TAGS - 1)
            tags.append(tag)
            parents.append(t.parent[i] + base if t.parent[i] >= 0 else -1)
            edges.append(0 if t.tag[i] in STRUCTURE else 2 if t.tag[i] == "#text" or t.tag[i] in INLINE else 1)
            if t.named[i]:
                for w in set(re.split(r"[^a-z]+|(?<=[a-z])-", t.named[i])):
                    k = THEME_OF.get(w)
                    if k is not None:
                        nodes.append(base + i)
                        feats.append(N_TAGS + k)
        base += n
    parent, tag = np.array(parents, np.int64), np.array(tags, np.int64)
    size, linked = np.array(text_size, np.float64), np.array(link_size, np.float64)
    share = linked / np.maximum(size, 1)
    every = np.arange(len(parent))
    above = np.where(parent >= 0, tag[np.maximum(parent, 0)], N_TAGS - 1)
    node = np.concatenate([every, every, every, every, every, np.array(nodes, np.int64)])
    feat = np.concatenate([tag, LINK_AT + np.digitize(share, [0.05, 0.4, 0.8]), SIZE_AT + np.digitize(size, [1, 20, 80, 300]), PARENT_AT + above, np.full(len(parent), N_FEATURES - 1), np.array(feats, np.int64)])
    depth = np.zeros(len(parent), np.int64)
    for i in range(len(parent)):
        if parents[i] >= 0:
            depth[i] = depth[parents[i]] + 1
    return parent, depth, np.array(edges, np.int64), node, feat


def marginals(parent, depth, edge, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of content for each node, and for each edge the 2 x 2 posterior (row: parent's state), by sum-product.

    unary: log potential of content over that of none; pair[kind, parent's state, own state]: log potentials.
    """
    n, levels = len(parent), int(depth.max(initial=0))
    order = np.argsort(depth, kind="stable")
    cut = np.searchsorted(depth[order], np.arange(levels + 2))
    up = unary.copy()  # log-odds of a node from itself and all below
    sent = np.zeros((n, 2))  # message of a node to its parent, for the parent's two states
    for d in range(levels, 0, -1):
        i = order[cut[d] : cut[d + 1]]
        both = np.stack([np.zeros(len(i)), up[i]], 1)[:, None, :] + pair[edge[i]]
        sent[i] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        np.add.at(up, parent[i], sent[i, 1] - sent[i, 0])
    full = up.copy()  # with what comes from above
    joint = np.zeros((n, 2, 2))
    for d in range(1, levels + 1):
        i = order[cut[d] : cut[d + 1]]
        p = parent[i]
        rest = full[p] - (sent[i, 1] - sent[i, 0])  # the parent without this child
        both = np.stack([np.zeros(len(i)), rest], 1)[:, :, None] + pair[edge[i]]
        down = np.logaddexp(both[:, 0, :], both[:, 1, :])
        full[i] = up[i] + down[:, 1] - down[:, 0]
        whole = both + np.stack([np.zeros(len(i)), up[i]], 1)[:, None, :]
        whole -= whole.max((1, 2), keepdims=True)
        joint[i] = np.exp(whole) / np.exp(whole).sum((1, 2), keepdims=True)
    return full, joint


def fit(pages: list[str], labels: list[list[int]], epochs: int = 150, rate: float = 0.3, decay: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Unary weights and edge potentials that make the labelled trees likely: observed less expected counts, by Adam."""
    parent, depth, edge, node, feat = features([parse(p) for p in pages])
    y = np.concatenate([np.array(x, np.float64) for x in labels])
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((EDGE_KINDS, 2, 2))
    np.add.at(seen, (edge[child], y[parent[child]].astype(int), y[child].astype(int)), 1)
    w, pair = np.zeros(N_FEATURES), np.zeros((EDGE_KINDS, 2, 2))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, pair)]
    for step in range(1, epochs + 1):
        full, joint = marginals(parent, depth, edge, np.bincount(node, w[feat], len(y)), pair)
        off = y - 1 / (1 + np.exp(-np.clip(full, -60, 60)))
        expected = np.zeros_like(pair)
        np.add.at(expected, edge[child], joint[child])
        grads = (np.bincount(feat, off[node], N_FEATURES) / len(y) - decay * w / 10, (seen - expected) / len(y) - decay * pair / 10)
        for (m, v), g, at in zip(state, grads, (w, pair), strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            at += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, pair


def assemble(tree: Tree, keep: np.ndarray) -> str:
    """The kept text nodes as blocks."""
    out: list[str] = []
    last_block = -1
    tag, parent = tree.tag, tree.parent
    block_of = [0] * len(tag)
    open_block = [0] * len(tag)  # how many blocks were opened or closed before the node
    edge = 0
    path: list[int] = []
    pieces: list[str] = []
    for i in range(len(tag)):
        while path and path[-1] != parent[i]:
            gone = path.pop()
            edge += tag[gone] in BLOCKS
        path.append(i)
        if tag[i] in BLOCKS:
            edge += 1
        block_of[i], open_block[i] = edge, edge
        piece = tree.text[i] if tag[i] == "#text" else " " if tag[i] == "br" else ""
        if not piece or tag[i] == "#text" and not keep[i]:
            continue
        if edge != last_block:
            out.append("".join(pieces))
            pieces, last_block = [], edge
        pieces.append(piece)
    out.append("".join(pieces))
    blocks = [" ".join(b.split()) for b in out]
    return "\n".join(b for b in blocks if b)


def extract(pages: list[str | None], w: np.ndarray, pair: np.ndarray) -> list[str]:
    trees = [parse(p or "") for p in pages]
    parent, depth, edge, node, feat = features(trees)
    full, _ = marginals(parent, depth, edge, np.bincount(node, w[feat], len(parent)), pair)
    out, at = [], 0
    for t in trees:
        out.append(assemble(t, full[at : at + len(t.parent)] >= 0))
        at += len(t.parent)
    return out


def labelled_pages(n: int = 600, seed: int = 3) -> tuple[list[str], list[list[int]]]:
    """Pages made by rule, with the label of every node of their tree (1: content)."""
    rng, mark = random.Random(seed), "\x01"
    word = lambda: "".join(rng.choice("the of ing ation er re on an ble sion ka lo mi tu pre con ver sta".split()) for _ in range(rng.randint(1, 3)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda a, b: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(rng.randint(a, b)))
    named = lambda theme: rng.choice(['class="{}"', 'id="{}"', 'class="x-{} wide"']).format(rng.choice(THEMES[theme].split()))

    def content(text: str) -> str:
        return text.replace("<", f"<{mark}").replace(f"<{mark}/", "</")

    def paragraph() -> str:
        t = words(3, 9) if rng.random() < 0.25 else words(12, 90)
        if rng.random() < 0.3:
            t += f' <a href="/{word()}">{words(1, 4)}</a> {words(1, 20)}'
        if rng.random() < 0.2:
            t = f"<{(b := rng.choice(['b', 'em', 'strong', 'i', 'span']))}>{words(1, 8)}</{b}> {t}"
        return f"<p>{t}</p>" if rng.random() < 0.9 else f"<p><b>{t}<br>"

    def body() -> str:
        if rng.random() < 0.12:
            return paragraph()
        parts = [f"<h1>{words(2, 10)}</h1>"] if rng.random() < 0.8 else []
        if rng.random() < 0.2:  # hardly any text
            return "".join(parts + [rng.choice([f"<p>{words(1, 6)}</p>", f"<p><b>{words(1, 5)}.<br>"]) for _ in range(rng.randint(1, 3))])
        if rng.random() < 0.12:  # lists of very short lines, verses and the like
            line = words(1, 12)
            parts += [f"<p>{line if rng.random() < 0.5 else words(1, 8)}</p>" for _ in range(rng.randint(15, 90))]
        for _ in range(rng.randint(1, 9)):
            x = rng.random()
            parts.append(paragraph() if x < 0.72 else f"<h2>{words(2, 7)}</h2>" if x < 0.8 else "<ul>" + "".join(f"<li>{words(3, 25)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>" if x < 0.86 else f"<blockquote><p>{words(8, 40)}</p></blockquote>" if x < 0.91 else f"<pre><code>{words(5, 20)}</code></pre>" if x < 0.94 else f"<table><tr><th>{word()}</th><td>{words(1, 5)}</td></tr><tr><td>{word()}</td><td>{words(2, 9)}</td></tr></table>" if x < 0.97 else f"<div>{words(8, 50)}</div>")
        return "".join(parts)

    def talk() -> str:
        return "".join(f'<div {named("talk")}><b>{word()}</b><p>{words(4, 40)}</p></div>' if rng.random() < 0.6 else f"<p>{words(4, 40)}</p>" for _ in range(rng.randint(1, 4)))

    def around() -> list[str]:
        all_of = [
            lambda: f"<nav><ul>{links(2, 8)}</ul></nav>", lambda: f"<div {named('menu')}><ul>{links(2, 8)}</ul></div>", lambda: f"<header><div>{words(1, 6)}</div><p>{words(2, 9)}</p></header>", lambda: f"<div {named('head')}><h2>{words(1, 4)}</h2></div>",
            lambda: f"<aside><h3>{words(1, 3)}</h3><p>{words(4, 40)}</p></aside>", lambda: f"<div {named('side')}><h3>{words(1, 3)}</h3><ul>{links(2, 7)}</ul></div>", lambda: f"<div {named('side')}><p>{words(6, 50)}</p></div>", lambda: f"<div {named('ad')}>{words(3, 40)}</div>", lambda: f"<div {named('ad')}><p>{words(3, 30)}</p></div>",
            lambda: f"<div {named('notice')}><p>{words(6, 40)}</p><button>{word()}</button></div>", lambda: f"<form {named('form')}><label>{words(1, 3)}</label><input type=text><button>{word()}</button></form>", lambda: f"<form><p>{words(2, 12)}</p><button>{word()}</button></form>", lambda: f"<div {named('share')}>{words(1, 4)} <a href=/>{word()}</a></div>",
            lambda: f"<section {named('talk')}><h3>{words(1, 2)}</h3>{talk()}</section>", lambda: f"<div {named('talk')}>{talk()}</div>", lambda: f"<ol {named('talk')}><li><p>{words(4, 40)}</p></li></ol>",
        ]
        return [rng.choice(all_of)() for _ in range(rng.randint(0, 3))]

    pages, labels = [], []
    for _ in range(n):
        inner = content(body())
        if rng.random() < 0.3:  # something foreign inside the article
            cut = inner.find(f"<{mark}p>", len(inner) // 2)
            inner = inner if cut < 0 else inner[:cut] + rng.choice(around() or [""]) + inner[cut:]
        open_tag, close = rng.choice([("article", "article"), ("article", "article"), ("main", "main"), (f"div {named('main')}", "div"), (f"section {named('main')}", "section"), ("div", "div")])
        core = f"<{mark}{open_tag}>{inner}</{close}>"
        if rng.random() < 0.3:
            core = f"<{mark}main>{core}{''.join(around())}</main>"
        elif rng.random() < 0.3:
            core = f"<div class=wrap>{core}{''.join(around())}</div>"
        foot = rng.choice([f"<footer>&copy; {words(2, 14)}</footer>", f"<footer><p>{words(2, 20)}</p><ul>{links(1, 4)}</ul></footer>", f"<div {named('foot')}><p>{words(2, 20)}</p></div>", ""])
        inside = f"{''.join(around())}{core}{''.join(around())}{foot}"
        if rng.random() < 0.1:  # a fragment, often without anything around the article
            page = rng.choice([inside, core])
        else:
            page = f"<html><head><title>{words(2, 5)}</title></head><body>{inside}</body></html>"
        labels.append(labels_of(page, mark))
        pages.append(page.replace(mark, ""))
    return pages, labels


def labels_of(page: str, mark: str) -> list[int]:
    """Labels in the order of parse's nodes; content elements have the mark after their "<". It is moved to their role, where parse keeps it."""
    tree = parse(re.sub(rf"<{mark}([a-zA-Z0-9]+)", rf'<\1 role="{mark}content{mark}"', page))
    out: list[int] = []
    for i in range(len(tree.parent)):
        inherits = tree.tag[i] in ("#text", "br", "hr")
        out.append(out[tree.parent[i]] if inherits else int(f"{mark}content{mark}" in tree.named[i]))
    return out


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the columns text and n_chars (code points); columns of these names are replaced."""
    w, pair = fit(*labelled_pages())

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for rows in batches:
            values = rows.tolist()
            yield pd.Series([t for lo in range(0, len(values), 100) for t in extract(values[lo : lo + 100], w, pair)])

    import pandas as pd

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return pages.withColumn("text", F.pandas_udf(run, "string")(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
