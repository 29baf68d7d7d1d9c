"""Main text of web pages: boosted trees over DOM-node features, decoded top-down so that choices agree."""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.boosting import Trees, fit_trees
from shelfcast.llm.common import arrow_schema, bounded_sample, ship

# Elements by their role in HTML.
BLOCKS = frozenset(
    "html body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption form fieldset legend address details summary dialog hr center hgroup menu search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title textarea select option button iframe svg canvas object audio video math datalist noframes".split()
)
RAW = frozenset("script style textarea title iframe noframes".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "caption", "thead", "tbody", "tfoot", "tr", "li", "dt", "dd", "legend", "summary", "figcaption"}
# A start tag closes an open element of its own family, up to the family's container.
FAMILIES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Words of class, id, role and label attributes that tell what an element is for.
TOKENS = (
    "nav navigation menu breadcrumb breadcrumbs header masthead topbar footer colophon copyright sidebar aside widget rail "
    "ad ads advert advertisement sponsored sponsor promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "comment comments reply replies respond discussion thread disqus form login signup subscribe newsletter search share sharing social "
    "related recommended more popular trending tags pagination pager meta byline toolbar skip main content article post entry story body "
    "text prose page wrapper container column blog news document complementary contentinfo dialog status region"
).split()
TOKEN_PLACE = {t: i for i, t in enumerate(TOKENS)}
TAGS = "article section nav aside header footer main div p h1 h2 h3 ul ol li dl table td blockquote pre figure figcaption form body details dialog".split()
TAG_PLACE = {t: i for i, t in enumerate(TAGS)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """Block elements in page order; element 0 stands for the document. Texts of inline elements belong to the
    block around them: `texts` are (block, text, characters in links, links) in page order, cut at every block's edge."""

    tags: list[str] = field(default_factory=lambda: ["html"])
    parents: list[int] = field(default_factory=lambda: [-1])
    tokens: list[tuple[int, ...]] = field(default_factory=lambda: [()])
    images: list[int] = field(default_factory=lambda: [0])
    inputs: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, str, int, int]] = field(default_factory=list)
    marks: list[str] = field(default_factory=lambda: [""])  # data-truth attributes, in training pages


def _tokens(rest: str) -> tuple[int, ...]:
    found = set()
    for _, value in _ATTRIBUTE.findall(rest):
        for word in _PART.findall(value):
            place = TOKEN_PLACE.get(word.lower())
            if place is not None:
                found.add(place)
    return tuple(sorted(found))


def parse(source: str, truth: bool = False) -> Page:
    """The page as blocks. Lenient like a browser: unknown, unclosed and misplaced tags do no harm."""
    page = Page()
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements with the block they stand for or lie in
    open_names: dict[str, int] = {"html": 1}
    pieces: list[str] = []
    link_chars = links = in_link = dropping = 0
    at = 0

    def flush() -> None:
        nonlocal link_chars, links
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                page.texts.append((stack[-1][1], text, link_chars, links))
            pieces.clear()
        link_chars = links = 0

    def pop() -> None:
        nonlocal in_link, dropping
        name, block = stack[-1]
        if name in BLOCKS:
            flush()
        stack.pop()
        open_names[name] -= 1
        if name == "a":
            in_link -= 1
        if name in DROPPED:
            dropping -= 1

    def close(names: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in limits:
                return

    n = len(source)
    for found in _TOKEN.finditer(source):
        start = found.start()
        if start < at:
            continue
        if start > at and not dropping:
            text = source[at:start]
            pieces.append(text)
            if in_link:
                link_chars += len(text)
        at = found.end()
        name = found["name"] or found["name2"]
        if name is None:
            continue
        name = name.lower()
        rest = found["rest"] or found["rest2"] or ""
        if found["end"] or found["end2"]:
            if name == "br":
                pieces.append(" ")
            elif name != "html" and open_names.get(name):
                close({name}, set())
            continue
        if name == "html":
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name == "img":
            page.images[stack[-1][1]] += 1
        if name in ("input", "select", "textarea", "button"):
            page.inputs[stack[-1][1]] += 1
        if name in BLOCKS:
            if name in CLOSES_P and open_names.get("p"):
                close({"p"}, {"td", "th", "table", "button", "object"})
            if name in FAMILIES:
                close(*FAMILIES[name])
            flush()
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}", re.I).search(source, at)
            at = end.start() if end else n
        if rest.endswith("/") and name in ("svg", "math"):
            continue
        block = stack[-1][1]
        if name in BLOCKS and not dropping:
            block = len(page.tags)
            page.tags.append(name)
            page.parents.append(stack[-1][1])
            page.tokens.append(_tokens(rest) if "=" in rest else ())
            page.images.append(0)
            page.inputs.append(0)
            if truth:
                mark = re.search(r'data-truth="(\w)"', rest)
                page.marks.append(mark[1] if mark else page.marks[stack[-1][1]])
        stack.append((name, block))
        open_names[name] = open_names.get(name, 0) + 1
        if name == "a":
            in_link += 1
            links += 1
        if name in DROPPED:
            dropping += 1
            if name == "head":  # an unclosed head ends where the body starts
                dropping -= 1
                stack[-1] = ("head-element", block)
                open_names["head-element"] = open_names.get("head-element", 0) + 1
    if at < n and not dropping:
        pieces.append(source[at:])
    flush()
    return page


# Features -----------------------------------------------------------------------------------------

_NUMBERS = 26
N_FEATURES = _NUMBERS + len(TAGS) + 2 * len(TOKENS)


def node_features(page: Page) -> np.ndarray:
    """One row per block: own and subtree text, density, links, marks of prose, depth, siblings, share of the page, tag,
    attribute words of its own and, counted, of its ancestors."""
    n = len(page.tags)
    parents = page.parents
    own, own_link, own_links, stops, pieces = ([0] * n for _ in range(5))
    for block, text, link_chars, links in page.texts:
        own[block] += len(text)
        own_link[block] += min(link_chars, len(text))
        own_links[block] += links
        stops[block] += text.count(".") + text.count(",")
        pieces[block] += 1
    chars, link, n_links, stop, tags, paragraphs, long_ones, children, images, inputs = (
        own[:], own_link[:], own_links[:], stops[:], [1] * n, [0] * n, [0] * n, [0] * n, page.images[:], page.inputs[:],
    )
    depth, index = [0] * n, [0] * n
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        index[i] = children[p]
        children[p] += 1
    same, most_child = [0] * n, [0] * n
    by_parent: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        key = (parents[i], page.tags[i])
        by_parent[key] = by_parent.get(key, 0) + 1
    for i in range(n - 1, 0, -1):
        p = parents[i]
        if page.tags[i] == "p" and own[i]:
            paragraphs[i] += 1
        if own[i] >= 80:
            long_ones[i] += 1
        for totals in (chars, link, n_links, stop, tags, paragraphs, long_ones, images, inputs):
            totals[p] += totals[i]
        most_child[p] = max(most_child[p], chars[i])
        same[i] = by_parent[(p, page.tags[i])]
    out = np.zeros((n, N_FEATURES), np.float32)
    total = max(1, chars[0])
    before = np.zeros(n)
    running, k = 0, 0
    # Share of the page's text that comes before each block.
    firsts = [None] * n
    for block, text, *_ in page.texts:
        b = block
        while b >= 0 and firsts[b] is None:
            firsts[b] = running
            b = parents[b]
        running += len(text)
    for i in range(n):
        before[i] = (firsts[i] if firsts[i] is not None else running) / total
    a = np.array
    own_, chars_, link_, tags_ = a(own, float), a(chars, float), a(link, float), a(tags, float)
    parent = a([0] + parents[1:])
    numbers = [
        np.log1p(own_), np.log1p(chars_), chars_ / tags_, link_ / np.maximum(1, chars_), a(own_link) / np.maximum(1, own_),
        np.log1p(a(n_links)), a(stop) / np.maximum(1, chars_), a(stops) / np.maximum(1, own_), np.log1p(tags_), np.log1p(a(paragraphs)),
        np.log1p(a(long_ones)), a(children), a(images), a(inputs), a(depth), a(index), a(children)[parent], a(same) / np.maximum(1, a(children)[parent]),
        chars_ / total, before, chars_ / np.maximum(1, chars_[parent]), a(most_child) / np.maximum(1, chars_),
        link_[parent] / np.maximum(1, chars_[parent]), (chars_ / tags_)[parent], np.log1p(chars_[parent]), np.log1p(total) * np.ones(n),
    ]
    out[:, :_NUMBERS] = np.stack(numbers, axis=1)
    above = _NUMBERS + len(TAGS) + len(TOKENS)
    for i in range(n):
        tag = TAG_PLACE.get(page.tags[i])
        if tag is not None:
            out[i, _NUMBERS + tag] = 1
        for t in page.tokens[i]:
            out[i, _NUMBERS + len(TAGS) + t] = 1
        if i:
            p = parents[i]
            out[i, above:] = out[p, above:]
            for t in page.tokens[p]:
                out[i, above + t] += 1
    return out


# Log-odds against the best start at which a page still counts as having main text.
FAINT = 2.0

# Decoding -------------------------------------------------------------------------------------------


def decode(page: Page, enter: np.ndarray, stay: np.ndarray) -> list[bool]:
    """Which blocks are main text, given each block's log-odds of being it, if the block above is not (`enter`) and if
    it is (`stay`).

    Main text starts at a block below others that are not, and goes on downwards until a block does not stay; below
    that one there is none. So no choice contradicts one above it. The labelling with the largest
    likelihood of all these is found from the leaves up, then read off from the top. If that has no main text at
    all, the start that costs least is taken, where it costs no more than FAINT.
    """
    n = len(page.tags)
    yes_enter, no_enter = (-np.logaddexp(0, x) for x in (-enter, enter))
    yes_stay, no_stay = (-np.logaddexp(0, x) for x in (-stay, stay))
    outside, inside = [0.0] * n, [0.0] * n  # best likelihood of what is below a block
    starts, stays = [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        without, with_ = no_enter[i] + outside[i], yes_enter[i] + inside[i]
        starts[i] = bool(with_ > without)
        outside[p] += max(without, with_)
        stays[i] = bool(yes_stay[i] + inside[i] > no_stay[i])
        inside[p] += max(yes_stay[i] + inside[i], no_stay[i])
    gains = np.array([yes_enter[i] + inside[i] - no_enter[i] - outside[i] for i in range(n)])
    if gains.max() <= 0 and gains.max() >= -FAINT:
        best = int(gains.argmax())
        starts[best] = True
    state = ["above"] * n
    if starts[0] or yes_enter[0] + inside[0] > no_enter[0] + outside[0]:
        state[0] = "main"
    for i in range(1, n):
        over = state[page.parents[i]]
        if over == "main":
            state[i] = "main" if stays[i] else "clutter"
        elif over == "above":
            state[i] = "main" if starts[i] else "above"
        else:
            state[i] = "clutter"
    return [s == "main" for s in state]


def main_text(page: Page, chosen: list[bool]) -> str:
    return "\n".join(text for block, text, *_ in page.texts if chosen[block])


# Training -------------------------------------------------------------------------------------------

# Bounds of the training: pages of the table that lend their words, and made-up layouts around them.
SAMPLE_PAGES, SAMPLE_BYTES, LAYOUTS = 300, 64 << 10, 900


def layouts(paragraphs: list[str], count: int, seed: int) -> Iterator[str]:
    """Pages with known main text (data-truth="1") and clutter ("0"), in varied and partly plain markup."""
    r = random.Random(seed)
    words = [w for p in paragraphs[:400] for w in p.split()[:40]] or ["word"]

    def some(low: int, high: int) -> str:
        return html.escape(" ".join(r.choices(words, k=r.randint(low, high))))

    def para() -> str:
        return html.escape(r.choice(paragraphs)) if paragraphs and r.random() < 0.8 else some(8, 120)

    def named(names: str) -> str:
        """Attributes with one of the names, dressed up; sometimes none."""
        if r.random() < 0.12:
            return ""
        name = r.choice(names.split())
        extra = r.choice(["", "", "site-", "js-", "x-", "block "])
        tail = r.choice(["", "", "-1", "-wrap", "-box", "-area", "s", " c7"])
        key = r.choice(["class", "class", "class", "id"])
        return f' {key}="{extra}{name}{tail}"'

    def links(k: int, low: int = 1, high: int = 3) -> str:
        items = [f'<a href="/{i}">{some(low, high)}</a>' for i in range(k)]
        style = r.randrange(3)
        if style == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if style == 1 else " ").join(items)

    def tag(names: str, attributes: str, inner: str, truth: int) -> str:
        name = r.choice(names.split())
        return f'<{name}{attributes} data-truth="{truth}">{inner}</{name}>'

    def comments() -> str:
        out = []
        for _ in range(r.randint(1, 6)):
            who = r.choice([f"<b>{some(1, 2)}</b> ", f"<span class=\"author\">{some(1, 2)}</span> <time>{r.randint(1, 28)} May</time>", ""])
            said = r.choice([f"<p>{some(3, 60)}</p>", some(3, 60), f"<p>{some(3, 30)}</p><p>{some(3, 40)}</p>"])
            out.append(tag("div li article section", named("comment reply comment-body message"), who + said, 0))
        body = "".join(out)
        if r.random() < 0.5:
            body = f"<h{(k := r.randint(2, 4))}>{r.choice([some(1, 3), 'Comments', '3 replies'])}</h{k}>" + body
        if r.random() < 0.3:
            body += f"<form><p>{some(2, 6)}</p><textarea></textarea><button>{some(1, 2)}</button></form>"
        return tag("section div ol ul", named("comments comment-list discussion responses replies disqus thread"), body, 0)

    def clutter(kind: str) -> str:
        if kind == "nav":
            return tag("nav nav div ul", named("nav menu navigation navbar topnav main-nav"), links(r.randint(3, 12)), 0)
        if kind == "header":
            inner = r.choice([f"<h1>{some(1, 4)}</h1>", f"<div class=\"logo\">{some(1, 3)}</div>", f"<p>{some(2, 12)}</p>"])
            return tag("header header div", named("header masthead top banner site-header"), inner + (links(r.randint(2, 6)) if r.random() < 0.5 else ""), 0)
        if kind == "footer":
            inner = r.choice([f"&copy; {some(2, 12)}", f"<p>&copy; 2020 {some(2, 30)}</p>", f"<p>{some(3, 40)}</p>" + links(4), links(5)])
            return tag("footer footer div", named("footer colophon site-footer bottom copyright"), inner, 0)
        if kind == "sidebar":
            parts = [f"<h3>{some(1, 4)}</h3>" + r.choice([links(r.randint(2, 8), 2, 9), f"<p>{some(5, 60)}</p>"]) for _ in range(r.randint(1, 4))]
            return tag("aside aside div", named("sidebar widget rail secondary side-bar complementary"), "".join(parts), 0)
        if kind == "ad":
            return tag("div div aside section p", named("ad ads advert advertisement sponsored promo banner sponsor"), r.choice([some(3, 25), f"<p>{some(3, 40)}</p>", f"<a href=\"/x\">{some(3, 12)}</a>"]), 0)
        if kind == "notice":
            return tag("div div section dialog aside p", named("cookie notice consent alert gdpr popup cookie-notice banner modal"), r.choice([some(5, 50), f"<p>{some(5, 60)}</p><button>{some(1, 2)}</button>"]), 0)
        if kind == "form":
            inner = f"<label>{some(1, 4)}</label><input name=\"a\"><p>{some(2, 20)}</p><button>{some(1, 2)}</button>"
            return r.choice([f'<form{named("newsletter search login subscribe signup")} data-truth="0">{inner}</form>', tag("div section", named("newsletter search login subscribe"), f"<form>{inner}</form>", 0)])
        if kind == "related":
            cards = "".join(f"<div><h4><a href=\"/{i}\">{some(2, 8)}</a></h4><p>{some(3, 25)}</p></div>" for i in range(r.randint(2, 5)))
            return tag("section div aside", named("related recommended more popular trending"), f"<h3>{some(1, 3)}</h3>" + r.choice([cards, links(5, 3, 9)]), 0)
        if kind == "share":
            return tag("div ul p", named("share social sharing tags meta toolbar"), links(r.randint(2, 6)), 0)
        if kind == "crumbs":
            return tag("div nav ol ul", named("breadcrumb breadcrumbs pager pagination"), links(r.randint(2, 5)), 0)
        return comments()

    def inside() -> str:
        p = r.random()
        if p < 0.58:
            text = para()
            if r.random() < 0.2:
                cut = text.split(" ")
                k = r.randrange(len(cut))
                cut[k] = r.choice(["<b>{}</b>", "<a href='/l'>{}</a>", "<em>{}</em>", "<b>{}<br>"]).format(cut[k])
                text = " ".join(cut)
            return r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>"]).format(text)
        if p < 0.67:
            return f"<h{(k := r.randint(2, 4))}>{some(1, 9)}</h{k}>"
        if p < 0.74:
            return "<ul>" + "".join(f"<li>{some(2, 30)}</li>" for _ in range(r.randint(2, 6))) + "</ul>"
        if p < 0.78:
            return f"<blockquote>{r.choice([para(), '<p>' + para() + '</p>'])}</blockquote>"
        if p < 0.81:
            return f"<figure><img src='/i.png'><figcaption>{some(3, 15)}</figcaption></figure>"
        if p < 0.84:
            return "<table>" + "".join(f"<tr><td>{some(1, 6)}</td><td>{some(1, 6)}</td></tr>" for _ in range(r.randint(2, 5))) + "</table>"
        if p < 0.86:
            return f"<pre>{some(3, 30)}</pre>"
        return clutter(r.choice(["ad", "ad", "share", "related", "form", "notice", "sidebar", "nav", "footer", "header"]))

    for _ in range(count):
        body = "".join(inside() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 25])))
        if r.random() < 0.7:
            heading = f"<h1>{some(1, 12)}</h1>"
            if r.random() < 0.2:
                heading = f"<header>{heading}</header>"
            body = heading + body
        if r.random() < 0.15:
            body += comments()
        if r.random() < 0.2:
            inner = r.choice(["div", "section"])
            body = f"<{inner}>{body}</{inner}>"
        kind = r.random()
        if kind < 0.45:
            main = f'<article{named("post entry article story hentry") if r.random() < 0.6 else ""} data-truth="1">{body}</article>'
        elif kind < 0.6:
            main = f'<main{named("content main page") if r.random() < 0.5 else ""} data-truth="1">{body}</main>'
        elif kind < 0.95:
            main = tag("div div section", named("content main post entry article story article-body post-content entry-content text page body prose"), body, 1)
        else:
            main = f'<div data-truth="1">{body}</div>'
        if r.random() < 0.3:
            main = f'<main data-truth="0">{main}</main>' if "<main" not in main else f'<div class="container" data-truth="0">{main}</div>'
        top = [clutter(k) for k in r.sample(["nav", "header", "ad", "notice", "crumbs", "sidebar", "form", "share"], r.randint(0, 4))]
        low = [clutter(k) for k in r.sample(["footer", "sidebar", "ad", "notice", "related", "comments", "form", "share", "nav"], r.randint(0, 5))]
        if r.random() < 0.6 and not any("<footer" in x for x in low):
            low.append(clutter("footer"))
        if r.random() < 0.3 and low:
            main = f'<div{named("container wrapper row columns layout")} data-truth="0">{main}{low.pop(0)}</div>'
        whole = "".join([*top, main, *low])
        if r.random() < 0.3:
            whole = f'<div{named("wrapper container page site app")} data-truth="0">{whole}</div>'
        yield f'<html><head><title>{some(1, 8)}</title></head><body data-truth="0">{whole}</body></html>'


def loose_paragraphs(pages: list[str]) -> list[str]:
    """Longer runs of text of real pages, which lend the layouts the table's own words."""
    return [text[:3000] for source in pages for _, text, link, _ in parse(source).texts if len(text) > 60 and link < len(text) / 2]


def fit_extractor(pages: list[str], seed: int = 3) -> tuple[Trees, Trees]:
    """Two sets of boosted trees, for blocks below others and below main text (see `decode`), trained on layouts with
    the pages' words. Pages have no labels, so none are used; with no pages, layouts speak filler words."""
    rows, labels, below = [], [], []
    for source in layouts(loose_paragraphs(pages), LAYOUTS, seed):
        page = parse(source, truth=True)
        rows.append(node_features(page))
        main = [m == "1" for m in page.marks]
        labels.extend(main)
        below.extend(p >= 0 and main[p] for p in page.parents)
    x, y, inner = np.concatenate(rows), np.array(labels, int), np.array(below)
    return fit_trees(x[~inner], y[~inner], seed=seed), fit_trees(x[inner], y[inner], seed=seed)


RESULT = "page_id long, url string, text string, n_chars long"


def _extracted(shared):
    schema = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter, stay = (Trees(*x) for x in shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            pages = [parse(x or "") for x in batch.column("html").to_pylist()]
            features = [node_features(p) for p in pages]
            x = np.concatenate(features)
            ends = np.cumsum([len(f) for f in features])[:-1]
            margins = zip(np.split(enter.margin(x), ends), np.split(stay.margin(x), ends), strict=True)
            texts = [main_text(p, decode(p, *m)) for p, m in zip(pages, margins, strict=True)]
            counts = pa.array([len(t) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield work(batch.slice(at, 64))

    return run


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars (code points).

    The text is that of the blocks decoded as main text, one line each, with character references decoded and
    white space turned into single spaces; `br` counts as white space. Scripts, styles, comments, form controls and
    embedded media never count. Null or empty html, and pages where nothing looks like main text, give an
    empty text. Repeated rows and ids are rows of their own; other columns are not read. An empty table gives an
    empty one. The trees are trained on a bounded sample (SAMPLE_PAGES of at most SAMPLE_BYTES each, by hash).
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    sample = bounded_sample(rows.filter(F.octet_length("html") <= SAMPLE_BYTES), ["page_id", "url", "html"], SAMPLE_PAGES)
    trees = fit_extractor([r["html"] for r in sample.select("html").collect()])
    shared = spark.sparkContext.broadcast([t.parts() for t in trees])
    return rows.mapInArrow(_extracted(shared), RESULT)
