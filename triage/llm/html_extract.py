"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every block of text is a node with a hidden label, content or not. A node's
own potential is a sum of learned weights of its features (tag, words of class and id, amount of
text, share of links, its own words if it is short, the heading before it); a table of learned
potentials connects each child with its parent. One pass of sum-product messages from the leaves up
and one down gives every node's exact marginal; text blocks whose marginal is 0.5 or more are the
main text. Both passes run for all pages of a slice at once, one tree level at a time.

Training climbs the exact likelihood of fully labelled trees: observed less expected counts, the
expected ones from the same messages. Labelled pages come from two sources: pages of the table
whose own markup names the article (``article``, ``main``, ``itemprop=articleBody``; a bounded
sample, also with names and classes masked, so that amounts of text are learned), and composed
layouts (``layout``) in which content, menus, headers, sidebars, notices, adverts, forms and reader
comments are marked.

Pages are parsed by one forward scan, linear in the page, forgiving unclosed and stray tags.
Rules: scripts, styles, titles, drop-downs and the like hold no text; an inline tag doesn't end a
block, ``br`` is white space; a table cell or list entry is a block of its own.

Edge cases: a null or empty html gives an empty text; so does a page whose blocks all look like
boilerplate. Repeated rows give repeated results; columns other than page_id, url and html are left
out. Without a page that names its article, the composed layouts alone train the model; a page
longer than ``MAX_CHARS`` is no training page, but is extracted whole like any other.
"""

from __future__ import annotations

import html as entities
import random
import re
import sys
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import thin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
SAMPLE = 200        # pages of the table that train the model, at most
MAX_CHARS = 32_768  # code points of a training page, at most
LAYOUTS = 800      # composed pages that train the model
STEPS, RATE, DECAY = 150, 0.2, 1e-4

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())  # no markup inside, no text
SILENT = frozenset("head noscript template svg math select datalist button canvas object audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base link meta title script style noscript template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 summary legend".split())
# an opening tag of the first group closes an open one of the second, up to the third
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
}
TOKEN = re.compile(r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z))""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z-]*+)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
END = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
GROUP = {"body": 0, **dict.fromkeys(("div", "section", "main", "article", "td", "center"), 1),
         **dict.fromkeys(("ul", "ol", "nav", "menu", "dl", "table", "tbody", "tr"), 2),
         **dict.fromkeys(("aside", "footer", "header", "form", "fieldset"), 3)}
N_GROUPS = 6  # the four above, other elements, text


@dataclass
class Tree:
    """A page's nodes in page order; ``text`` is None for elements."""

    parent: list = field(default_factory=list)
    tag: list = field(default_factory=list)
    names: list = field(default_factory=list)  # words of class, id, role and the like
    text: list = field(default_factory=list)
    links: list = field(default_factory=list)  # code points inside links
    label: list = field(default_factory=list)

    def add(self, parent, tag, names, text, links, label):
        for column, value in zip((self.parent, self.tag, self.names, self.text, self.links, self.label),
                                 (parent, tag, names, text, links, label)):
            column.append(value)
        return len(self.parent) - 1


def attributes(raw: str) -> dict:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if "=" in raw or raw.strip(" /") else {}


def names_of(attrs: dict) -> tuple:
    out = {w.lower() for k in ("class", "id", "role", "itemprop") if k in attrs for w in PART.findall(attrs[k])}
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        out.add("!hidden")
    return tuple(sorted(out))


def marked(tag: str, attrs: dict):
    """Label that a mark in the page itself gives an element: 1, 0 or None (as its parent)."""
    if "data-content" in attrs:
        return int(attrs["data-content"] == "1")
    role = attrs.get("role", "")
    if tag in ("article", "main") or role == "main" or attrs.get("itemprop") == "articleBody":
        return 1
    if tag in ("nav", "footer", "aside", "form") or role in ("navigation", "banner", "contentinfo", "complementary", "search"):
        return 0
    return None


def parse(page: str) -> Tree:
    tree = Tree()
    stack = [(tree.add(-1, "body", (), None, 0, 0), "body", 0)]  # (node or None, tag, label); the body is always there
    open_ = {"body": 1}
    silent = 0
    buffer, linked, in_link = [], 0, False
    at, n = 0, len(page)

    def block():
        nonlocal buffer, linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                node = next(x for x, *_ in reversed(stack) if x is not None)
                tree.add(node, "#text", (), text, min(linked, len(text)), stack[-1][2])
            buffer, linked = [], 0

    def take(text):
        nonlocal linked
        if not silent and text:
            text = entities.unescape(text) if "&" in text else text
            buffer.append(text)
            if in_link:
                linked += len(text)

    def pop():
        nonlocal silent, in_link
        _, tag, _ = stack.pop()
        open_[tag] -= 1
        silent -= tag in SILENT
        if tag in BLOCKS:
            in_link = False

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at:m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", m.end() - 2)  # "<!-->" is a whole comment
            at = end + 3 if end >= 0 else n
            continue
        if m[2]:
            end = page.find(">", at)
            at = end + 1 if end >= 0 else n
            continue
        tag = m[4].lower()
        if m[3]:
            if tag == "a":
                in_link = False
            elif tag == "br":
                take(" ")
            elif open_.get(tag) and len(stack) > 1 and tag != "body":
                if tag in BLOCKS:
                    block()
                while len(stack) > 1 and stack[-1][1] != tag:
                    pop()
                if len(stack) > 1:
                    pop()
            elif tag == "p":
                block()
            continue
        if open_.get("head") and tag not in IN_HEAD:
            while open_["head"]:
                pop()
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            take(" ")
            continue
        if tag in ("br", "hr", "img", "input", "wbr"):
            if tag == "hr":
                block()
            elif tag != "wbr":
                take(" ")
            continue
        if tag == "body":
            attrs = attributes(m[5])
            tree.names[0], tree.label[0] = names_of(attrs), marked(tag, attrs) or 0
            stack[0] = (0, "body", tree.label[0])
        if tag in VOID or tag in ("html", "body"):
            continue
        if tag == "a":
            in_link = True
            continue
        if tag in SILENT:
            if not m[5].endswith("/"):
                stack.append((None, tag, stack[-1][2]))
                open_[tag] = open_.get(tag, 0) + 1
                silent += 1
            continue
        if tag not in BLOCKS:
            continue
        block()
        while open_.get("p"):  # a block ends an open paragraph; nothing but silent elements is inside
            pop()
        if tag in CLOSES:
            shut, scope = CLOSES[tag]
            while len(stack) > 1 and any(open_.get(x) for x in shut) and stack[-1][1] not in scope:
                inner = stack[-1][1]
                if inner not in shut and inner not in ("p", "tr") and inner in BLOCKS:
                    break
                pop()
        attrs = attributes(m[5])
        own = marked(tag, attrs)
        label = stack[-1][2] if own is None else own
        node = next(x for x, *_ in reversed(stack) if x is not None)
        stack.append((tree.add(node, tag, names_of(attrs), None, 0, label), tag, label))
        open_[tag] = open_.get(tag, 0) + 1
    block()
    return tree


# ---------------------------------------------------------------- features

def _bucket(name: str) -> int:
    return crc32(name.encode()) & (BUCKETS - 1)


def _share(part: int, whole: int) -> int:
    return 0 if part == 0 else 1 + min(4 * part // max(whole, 1), 4)


def features(tree: Tree, masked: bool = False) -> list[list[str]]:
    """Feature names of every node; ``masked``: as if all block elements were divs without classes."""
    n = len(tree.parent)
    words, chars, links, texts = [0] * n, [0] * n, [0] * n, [0] * n
    lead = [""] * n  # first text inside
    tag = [("div" if masked and t in BLOCKS and t not in ("body", "p", "ul", "ol", "li") and t not in HEADINGS else t) for t in tree.tag]
    for i in range(n - 1, -1, -1):
        text = tree.text[i]
        if text is not None:
            words[i], chars[i], links[i], texts[i], lead[i] = text.count(" ") + 1, len(text), tree.links[i], 1, text
        p = tree.parent[i]
        if p >= 0:
            words[p] += words[i]
            chars[p] += chars[i]
            links[p] += links[i]
            texts[p] += texts[i]
            lead[p] = lead[i] or lead[p]
    total = max(words[0], 1)
    heading: dict = {}
    out, depth = [], [0] * n
    for i in range(n):
        p = tree.parent[i]
        depth[i] = depth[p] + 1 if p >= 0 else 0
        size, share = words[i].bit_length(), _share(links[i], chars[i])
        up = tag[p] if p >= 0 else ""
        f = [f"t {tag[i]}", f"{up}>{tag[i]}", f"l {share}", f"w {min(size, 9)} {share > 2}", f"h {heading.get(p, '')}"]
        if tree.text[i] is None:
            f += [f"part {10 * words[i] // total} {share > 2}", f"each {(words[i] // max(texts[i], 1)).bit_length()}", f"depth {min(depth[i], 6)}"]
            if not masked:
                f += [f"c {x}" for x in tree.names[i]]
            if texts[i] and lead[i].count(" ") < 4:
                f += [f"lead {x.lower()}" for x in lead[i].split()]
            if tag[i] in HEADINGS and texts[i]:
                heading[p] = " ".join(PART.findall(lead[i])[:2]).lower() if len(lead[i]) < 40 else ""
        else:
            f.append(f"end {bool(END.search(tree.text[i][-4:]))} {min(size, 4)}")
            if words[i] < 5:
                f += [f"s {x.lower()}" for x in tree.text[i].split()]
        out.append(f)
    return out


@dataclass
class Forest:
    """Many trees as arrays; nodes are sorted by depth, so a level is a slice."""

    parent: np.ndarray
    edge: np.ndarray     # kind of edge to the parent
    ids: np.ndarray      # feature buckets of all nodes, node by node
    node: np.ndarray     # the node of each feature
    levels: list         # (from, to) of depth 1, 2, ...
    place: np.ndarray    # place of the i-th node in page order


def forest(trees: list[Tree], masked: list[bool]) -> Forest:
    parent, depth, group, ids, counts, base = [], [], [], [], [], 0
    for tree, mask in zip(trees, masked):
        d = []
        for i, p in enumerate(tree.parent):
            d.append(0 if p < 0 else d[p] + 1)
            group.append(5 if tree.text[i] is not None else 1 if mask and tree.tag[i] in GROUP and GROUP[tree.tag[i]] == 3 else GROUP.get(tree.tag[i], 4))
        parent.extend(p + base if p >= 0 else -1 for p in tree.parent)
        depth.extend(d)
        for f in features(tree, mask):
            ids.extend(map(_bucket, f))
            counts.append(len(f))
        base += len(d)
    parent, depth, group = np.array(parent, dtype=np.int64), np.array(depth), np.array(group)
    order = np.argsort(depth, kind="stable")
    place = np.empty(base, dtype=np.int64)
    place[order] = np.arange(base)
    cuts = np.searchsorted(depth[order], np.arange(1, (depth.max() if base else 0) + 2))
    up = parent[order]
    new = np.where(up >= 0, place[up], -1)
    edge = np.where(up >= 0, group[up], 0) * N_GROUPS + group[order]
    return Forest(new, edge, np.array(ids, dtype=np.int64), place[np.repeat(np.arange(base), counts)],
                  [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])], place)


# ---------------------------------------------------------------- sum-product

@dataclass
class Model:
    weight: np.ndarray  # of each feature bucket
    edge: np.ndarray    # (edge kind, parent label, child label)


def messages(f: Forest, model: Model):
    """(log odds of each node's marginal, joint marginals of (parent, child) for each node)."""
    own = np.bincount(f.node, model.weight[f.ids], minlength=len(f.parent))
    e = model.edge[f.edge]
    up = np.zeros(len(own))  # message of each node to its parent, as log odds
    for a, b in reversed(f.levels):
        s = own[a:b]
        up[a:b] = np.logaddexp(e[a:b, 1, 0], e[a:b, 1, 1] + s) - np.logaddexp(e[a:b, 0, 0], e[a:b, 0, 1] + s)
        own += np.bincount(f.parent[a:b], up[a:b], minlength=len(own)) if b - a > len(own) // 8 else 0
        if b - a <= len(own) // 8:
            np.add.at(own, f.parent[a:b], up[a:b])
    belief, without = own.copy(), np.zeros(len(own))
    for a, b in f.levels:
        rest = without[a:b] = belief[f.parent[a:b]] - up[a:b]  # the parent's belief without this child
        belief[a:b] += np.logaddexp(e[a:b, 0, 1], e[a:b, 1, 1] + rest) - np.logaddexp(e[a:b, 0, 0], e[a:b, 1, 0] + rest)
    joint = e + without[:, None, None] * np.array([[0.0], [1.0]]) + own[:, None, None] * np.array([[0.0, 1.0]])
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    return belief, joint / joint.sum(axis=(1, 2), keepdims=True)


def train(trees: list[Tree], masked: list[bool]) -> Model:
    """Climb the mean log likelihood of labelled trees by adaptive steps."""
    model = Model(np.zeros(BUCKETS), np.zeros((N_GROUPS * N_GROUPS, 2, 2)))
    f = forest(trees, masked)
    y = np.zeros(len(f.parent), dtype=np.int64)
    y[f.place] = np.concatenate([np.array(t.label, dtype=np.int64) for t in trees])
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros_like(model.edge)
    np.add.at(seen, (f.edge[child], y[f.parent[child]], y[child]), 1.0)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.weight, model.edge)]
    n = max(len(trees), 1)
    for step in range(1, STEPS + 1):
        belief, joint = messages(f, model)
        gap = y - 1 / (1 + np.exp(-belief))
        expected = np.zeros_like(seen)
        np.add.at(expected, f.edge[child], joint[child])
        for x, g, (m, v) in zip((model.weight, model.edge), (np.bincount(f.ids, gap[f.node], minlength=BUCKETS) / n, (seen - expected) / n), state):
            g = g - DECAY * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def content(trees: list[Tree], model: Model) -> list[np.ndarray]:
    """Marginal probability of content of every node, tree by tree."""
    f = forest(trees, [False] * len(trees))
    belief, _ = messages(f, model)
    p = 1 / (1 + np.exp(-np.clip(belief, -500, 500)))[f.place]
    return np.split(p, np.cumsum([len(t.parent) for t in trees])[:-1]) if trees else []


def main_text(tree: Tree, marginal: np.ndarray) -> str:
    return "\n\n".join(t for t, p in zip(tree.text, marginal) if t is not None and p >= 0.5)


# ---------------------------------------------------------------- labelled layouts

# what stands in pages, as (tag, class); composed at random
CONTENT = [("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "post-content"),
           ("div", "entry-content"), ("div", "article-body"), ("div", "story"), ("section", "article"), ("div", "main-text"),
           ("div", "post"), ("td", "body"), ("section", ""), ("div", ""), ("div", "page-content"), ("div", "story-body"), ("div", "text"),
           ("div", "blog-post"), ("section", "news-article"), ("div", "article-content"), ("body", ""), ("body", "")]
JUNK = {
    "menu": [("nav", ""), ("ul", "menu"), ("div", "navigation"), ("div", "topnav"), ("div", "breadcrumb"), ("nav", "navbar"), ("div", "pagination")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header"), ("div", "top-bar"), ("div", "branding")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "site-footer"), ("footer", "footer"), ("div", "copyright"), ("div", "colophon")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("aside", "sidebar"), ("div", "related-posts"), ("div", "trending"), ("section", "recommended")],
    "notice": [("div", "notice"), ("div", "cookie-banner"), ("div", "consent"), ("div", "alert"), ("section", "gdpr"), ("div", "popup modal"), ("div", "disclaimer"), ("p", "notice")],
    "advert": [("div", "ad"), ("div", "advert"), ("div", "ads"), ("div", "ad-slot banner"), ("div", "sponsored"), ("div", "promo"), ("section", "advertisement"), ("aside", "ad"), ("p", "ad")],
    "form": [("form", ""), ("div", "newsletter"), ("form", "search"), ("div", "subscribe signup"), ("form", "login"), ("form", "contact")],
    "share": [("div", "share"), ("ul", "social"), ("div", "tags"), ("div", "meta byline"), ("div", "author-bio")],
    "comments": [("section", "comments"), ("div", "comments"), ("div", "comment"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "comments-area"), ("div", "replies"),
                 ("div", "disqus"), ("div", "discussion"), ("div", "reader-comments"), ("section", "responses")],
}
HEAD_WORDS = {"comments": ["Comments", "3 Comments", "Leave a reply", "Reader comments", "Discussion", "Responses"],
              "sidebar": ["Related", "Related articles", "Most read", "Trending", "Popular posts", "Archive"],
              "form": ["Subscribe", "Newsletter", "Search", "Log in", "Contact us"], "advert": ["Advertisement", "Sponsored", "Ad"],
              "notice": ["Cookies", "Notice", "Privacy"], "share": ["Share this", "Follow us", "Tags"]}
SYLLABLES = "ra te lo mi su ven dar kol est ing pra tor lin mas ged un".split()


def layout(seed: int) -> str:
    """A composed page; content is marked ``data-content``. The same seed gives the same page."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))
    sentence = lambda n: (" ".join(word() for _ in range(n))).capitalize() + r.choice([".", ".", ".", "!", "?", ""])
    prose = lambda: " ".join(sentence(r.randint(1, 18)) for _ in range(r.choice([1, 1, 2, 4, 8])))
    link = lambda n=1: f'<a href="/{word()}">{" ".join(word() for _ in range(n))}</a>'
    paragraph = lambda: r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>"]).format(prose())

    def attrs(cls):
        return f' {r.choice(["class", "class", "id"])}="{cls}"' if cls else ""

    def junk(kind):
        tag, cls = r.choice(JUNK[kind])
        named = cls or tag not in ("div", "section")
        if kind in ("menu", "share"):
            inner = "".join(f"<li>{link(r.randint(1, 2))}</li>" for _ in range(r.randint(2, 8)))
            inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>" if r.random() < 0.7 else " | ".join(link() for _ in range(r.randint(2, 6)))
        elif kind == "comments":
            wrap = "li" if tag == "ol" else r.choice(["div", "article", "p", "div"])
            inner = "".join(f'<{wrap} class="{r.choice(["comment", "comment", "reply", ""])}">{prose() if wrap == "p" else paragraph()}</{wrap}>'
                            for _ in range(r.randint(1, 5)))
        elif kind == "form":
            inner = f"<label>{word()}</label><input><p>{sentence(r.randint(2, 8))}</p><button>{word()}</button>"
        elif kind == "header":
            inner = r.choice([link(2), f"<h1>{link(2)}</h1>", f"<h1>{sentence(3)}</h1>{junk('menu')}", f"<h1>{word()}</h1><p>{sentence(4)}</p>", f"<div>{sentence(4)}</div>", f"<p>{sentence(5)}</p><ul><li>{link()}</li><li>{link()}</li></ul>"])
        elif kind == "footer":
            inner = r.choice([f"&copy; {word()} &middot; {sentence(6)}", f"<p>&copy; 2024 {word()}</p><ul><li>{link()}</li></ul>", f"<p>{prose()}</p>"])
        elif kind == "sidebar":
            inner = r.choice([f"<ul>{''.join(f'<li>{link(3)}</li>' for _ in range(4))}</ul>", paragraph(), f"<p>{sentence(9)}</p>{link(4)}"])
        else:
            inner = r.choice([sentence(r.randint(2, 14)), f"<p>{prose()}</p>", f"{sentence(6)} {link()}"])
            inner = re.sub("</?p>", "", inner) if tag == "p" else inner
        if kind in HEAD_WORDS and tag not in ("ul", "ol", "p") and (not named or r.random() < 0.5):
            inner = f"<h{r.randint(2, 4)}>{r.choice(HEAD_WORDS[kind])}</h3>" + inner
        return f'<{tag}{attrs(cls)} data-content="0">{inner}</{tag}>'

    def piece():
        kind = r.random()
        if kind < 0.08:
            return f"<ul>{''.join(f'<li>{sentence(r.randint(1, 9))}</li>' for _ in range(3))}</ul>"
        if kind < 0.16:
            return f"<h{r.randint(2, 4)}>{sentence(r.randint(1, 6))}</h2>"
        if kind < 0.2:
            return f"<blockquote><p>{prose()}</p></blockquote>"
        if kind < 0.23:
            return f"<table><tr><th>{word()}<td>{word()}<tr><td>{word()}<td>{sentence(3)}</table>"
        if kind < 0.26:
            return f"<pre>{prose()}</pre>"
        if kind < 0.29:
            return f"<figure><img><figcaption>{sentence(5)}</figcaption></figure>"
        if kind < 0.34:
            return f"<p>{sentence(5)} {link(2)} {sentence(4)}</p>"
        return paragraph()

    tag, cls = r.choice(CONTENT)
    body = [piece() for _ in range(r.choice([1, 2, 3, 5, 8, 14]))]
    title = f"<h1>{sentence(r.randint(1, 8))}</h1>"
    for kind in ("advert", "share", "form", "sidebar", "comments", "notice"):
        if r.random() < (0.3 if kind == "comments" else 0.2):
            body.insert(len(body) if kind in ("comments", "form") else r.randint(0, len(body)), junk(kind))
    if r.random() < 0.8:
        body.insert(0, f"<header>{title}</header>" if r.random() < 0.2 else title)
    main = f'<{tag}{attrs(cls)} data-content="1">{"".join(body)}</{tag}>'
    before = [junk(k) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.5]
    after = [junk(k) for k in ("share", "comments", "sidebar", "advert", "form", "notice", "footer") if r.random() < 0.4]
    r.shuffle(before)
    if tag == "body":  # no container of its own
        return f'<html><head><title>{word()}</title></head><body data-content="1">{"".join(before + body + after)}</body></html>'
    if tag == "td":
        main = f"<table><tr><td>{junk('menu')}</td>{main}</tr></table>"
    if r.random() < 0.4:
        k = r.randint(0, len(after))
        main, after = f'<div{attrs(r.choice(["", "wrapper", "container", "page", "row"]))}>{main}{"".join(after[:k])}</div>', after[k:]
    return f"<html><head><title>{word()}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


# ---------------------------------------------------------------- Spark

def fit(pages: DataFrame | None, sample: int = SAMPLE, layouts: int = LAYOUTS) -> Model:
    """Train on ``layouts`` composed pages and at most ``sample`` pages that name their article.

    These are picked by their smallest hashes (first the hashes alone, then their pages) and are at
    most ``MAX_CHARS`` long, which bounds what comes to the driver.
    """
    trees = [parse(layout(i)) for i in range(layouts)]
    masked = [i % 4 == 3 for i in range(layouts)]
    if pages is not None:
        named = pages.filter(F.length("html") <= MAX_CHARS).filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
        named = named.select("html", F.xxhash64("page_id", "html").alias("pick"))
        last = named.select("pick").distinct().orderBy("pick").limit(sample).agg(F.max("pick")).first()[0]
        picked = named.filter(F.col("pick") <= last).dropDuplicates(["pick"]).collect() if last is not None else []
        for row in sorted(picked, key=lambda r: r.pick):
            tree = parse(row.html)
            trees += [tree, tree]
            masked += [False, True]
    return train(trees, masked)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches):
        for b in thin(batches, 64):
            trees = [parse(x or "") for x in b.column(2).to_pylist()]
            texts = [main_text(t, p) for t, p in zip(trees, content(trees, model))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
