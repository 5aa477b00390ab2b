"""Main text of HTML pages by boosted trees over DOM nodes.

A page is parsed into block elements and text runs (the inline text between
two block boundaries). Boosted trees give every node the log-odds of being
part of the article, from its tag and its parent's, attribute tokens of its
own and of its ancestors, depth, subtree size, text and link density, and
statistics of its siblings. Decoding is hierarchical: the best set of nodes
that is closed towards the root is found from the leaves up (a subtree stays
if the sum of its best part is positive), so no run is kept inside an
element that is dropped, nor an element without any run.

The trees are fitted here. Their pages are composed from the words of a
bounded sample of the table (about ``max_pages`` pages of at most
``max_chars`` characters, picked by a hash of the id): articles between
menus, headers, sidebars, notices, adverts, forms, comments and footers,
under many tags, class names and orders, with closing tags left out at
random. The label of a run is known as it is written. Nothing but that sample
reaches the driver.

Extraction reads whole pages. Text runs are joined by a line feed in page
order; character references are decoded, white space in a run becomes one
space. Defined cases: null and empty HTML give an empty text; markup cut off
at the end, unclosed and stray tags are read as browsers read them, roughly;
text without any markup is one run.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from billetic.llm import gbt

# Elements by what they are in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math".split())
INLINE = frozenset("""
    a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike
    strong sub sup time tt u var wbr nobr br img input
""".split())
KINDS = {name: k for k, names in enumerate((
    "article main", "div section center", "nav menu", "header", "footer", "aside",
    "form button select option optgroup fieldset label legend dialog", "ul ol dl", "li dt dd", "p",
    "h1 h2 h3 h4 h5 h6", "blockquote pre figure figcaption details summary address hgroup",
    "table thead tbody tfoot tr td th caption", "body html head")) for name in names.split()}
RUN, OTHER = 14, 15
N_KINDS = 16
# an open element of the second set is closed by a start tag of the first, up to the third
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN_GROUPS = [re.compile(p) for p in (
    r"^(nav|navbar|navigation|menu|menubar|breadcrumbs?|toc|pagination|pager|tabs?)$",
    r"^(header|masthead|topbar|banner|logo|branding)$",
    r"^(footer|foot|copyright|colophon|legal|imprint|contentinfo|bottom)$",
    r"^(sidebar|aside|side|rail|widgets?|complementary|secondary)$",
    r"^(ads?|advert|adverts|advertisement|adsense|sponsor|sponsored|promo|promotion|teaser|banner)$",
    r"^(cookies?|consent|notice|notices|gdpr|alert|popup|modal|overlay|message|warning|privacy)$",
    r"^(comments?|reply|replies|respond|disqus|discussion|reader|readers|feedback)$",
    r"^(share|sharing|social|follow|related|recommended|more|tags|meta|byline|author|rating)$",
    r"^(form|newsletter|subscribe|signup|login|search|contact|poll|survey)$",
    r"^(article|post|entry|story|content|text|main|body|page|blog|news|prose)$",
)]
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"\b(class|id|role|aria-label|itemprop|data-keep)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))",
                   re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
N_FEATURES = 2 * N_KINDS + 2 * len(TOKEN_GROUPS) + 22


class Page:
    """The nodes of a page in order, parents first. Node 0 is the root."""

    def __init__(self, source: str):
        self.parent, self.kind, self.groups, self.keep = [-1], [KINDS["body"]], [0], [None]
        self.text: list[str | None] = [None]
        self.links = [0]
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._open: dict[str, list[int]] = {}       # depths of the open tags of each name
        self._endless: set[str] = set()             # raw tags without a further end
        self._run: list[str] = []
        self._link = self._linked = 0
        self._parse(source)
        self._flush()

    def _node(self, kind: int, groups: int = 0, text: str | None = None, links: int = 0, keep=None) -> int:
        self.parent.append(self._stack[-1][1])
        self.kind.append(kind)
        self.groups.append(groups)
        self.text.append(text)
        self.links.append(links)
        self.keep.append(keep)
        return len(self.parent) - 1

    def _say(self, part: str) -> None:
        self._run.append(part)
        if self._link:
            self._linked += len(part)

    def _flush(self) -> None:
        if self._run:
            raw = "".join(self._run)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                self._node(RUN, 0, text, min(self._linked, len(text)))
            self._run = []
        self._linked = 0

    def _pop(self, names, upto=frozenset()) -> None:
        """Close the innermost of the open tags ``names``, unless one of
        ``upto`` is further in. Time follows the tags that are closed."""
        at = max((d[-1] for n in names if (d := self._open.get(n))), default=0)
        if at and all(not (d := self._open.get(n)) or d[-1] <= at for n in upto):
            while len(self._stack) > at:
                self._open[self._stack.pop()[0]].pop()

    def _parse(self, source: str) -> None:
        at = 0
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self._say(source[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if name in INLINE:
                if name == "br":
                    self._say(" ")
                elif name == "a":
                    self._link = 0 if m[1] else 1
                continue
            self._flush()
            self._link = 0
            if m[1]:
                self._pop({name})
                continue
            if name in RAW:
                if not m[3].rstrip().endswith("/") and name not in self._endless:
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(source, at)
                    if end:
                        at = end.end()
                    elif name in ("script", "style", "title", "textarea"):
                        at = len(source)
                    else:
                        self._endless.add(name)     # what follows is the page's
                continue
            if name in VOID:
                continue
            self._pop({"p"}, {"body", "td", "th", "table", "div", "section", "article", "main", "li", "blockquote"})
            if name in CLOSES:
                self._pop(*CLOSES[name])
            groups, keep = _attributes(m[3])
            self._open.setdefault(name, []).append(len(self._stack))
            self._stack.append((name, self._node(KINDS.get(name, OTHER), groups, keep=keep)))
        if at < len(source):
            self._say(source[at:])


def _attributes(raw: str) -> tuple[int, str | None]:
    groups, keep = 0, None
    if "=" in raw:
        for m in _ATTR.finditer(raw):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "data-keep":
                keep = value
                continue
            for word in _WORDS.findall(value):
                for k, pattern in enumerate(TOKEN_GROUPS):
                    if pattern.match(word.lower()):
                        groups |= 1 << k
    return groups, keep


def features(page: Page) -> np.ndarray:
    """One row of features per node."""
    parent, kind = np.array(page.parent), np.array(page.kind)
    n = len(parent)
    groups = np.array(page.groups)
    own = np.array([len(t) if t else 0 for t in page.text], float)
    links = np.array(page.links, float)
    stops = np.array([t.count(". ") + t.count(", ") + t.endswith((".", "!", "?", "…", '."')) if t else 0
                      for t in page.text], float)
    depth, above, size = np.zeros(n), np.zeros(n, np.int64), np.ones(n)
    chars, linked, marks, runs = own.copy(), links.copy(), stops.copy(), (kind == RUN).astype(float)
    up_kinds = np.zeros(n, np.int64)
    up = page.parent
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
        above[i] = above[up[i]] | groups[up[i]]
        up_kinds[i] = up_kinds[up[i]] | (1 << page.kind[up[i]])
    for i in range(n - 1, 0, -1):
        p = up[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
        runs[p] += runs[i]
        size[p] += size[i]
    up = np.maximum(parent, 0)
    order = np.arange(n)
    n_sib = np.bincount(up[1:], minlength=n)[up].astype(float)
    sib_chars = np.bincount(up[1:], chars[1:], n)[up] - chars
    first = np.full(n, n)
    np.minimum.at(first, up[1:], order[1:])
    rank = np.zeros(n)
    by = np.argsort(up[1:], kind="stable") + 1
    rank[by] = np.arange(len(by)) - np.searchsorted(up[by], up[by], "left")
    same = np.zeros(n)
    pair = up * N_KINDS + kind
    uniq, inv, count = np.unique(pair[1:], return_inverse=True, return_counts=True)
    same[1:] = count[inv]
    prev, nxt = np.zeros(n), np.zeros(n)
    if len(by) > 1:
        near = up[by[1:]] == up[by[:-1]]
        prev[by[1:][near]] = chars[by[:-1][near]]
        nxt[by[:-1][near]] = chars[by[1:][near]]
    safe = np.maximum(chars, 1)
    level = np.log1p(chars)
    cols = [
        depth, level, np.log1p(size), np.log1p(runs), level - np.log1p(size), linked / safe, marks / safe * 100,
        chars / np.maximum(runs, 1), n_sib, rank / np.maximum(n_sib, 1), same / np.maximum(n_sib, 1),
        np.log1p(sib_chars / np.maximum(n_sib - 1, 1)), chars / np.maximum(chars[up], 1), chars / max(chars[0], 1),
        np.log1p(prev), np.log1p(nxt), np.log1p(chars[up]), linked[up] / np.maximum(chars[up], 1),
        marks[up] / np.maximum(chars[up], 1) * 100, order / n,
        np.array([1.0 if t and ("©" in t or "(c)" in t) else 0.0 for t in page.text]), (marks == 0) * 1.0]
    hot = np.zeros((n, N_KINDS))
    hot[order, kind] = 1
    ups = (up_kinds[:, None] >> np.arange(N_KINDS)) & 1
    token = np.arange(len(TOKEN_GROUPS))
    return np.concatenate([hot, ups, (groups[:, None] >> token) & 1, (above[:, None] >> token) & 1,
                           np.stack(cols, 1)], 1)


def decode(parent: list[int], is_run: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The kept nodes: the set closed towards the root with the largest sum
    of log-odds in which every element has a kept run below."""
    n = len(scores)
    value, below = scores.astype(float).copy(), np.zeros(n)
    top, top_child = np.full(n, -np.inf), np.zeros(n, np.int64)
    for i in range(n - 1, 0, -1):
        if not is_run[i]:
            # without a child worth keeping an element can stand on its best one
            value[i] += below[i] if below[i] > 0 else top[i]
        p = parent[i]
        below[p] += max(value[i], 0.0)
        if value[i] > top[p]:
            top[p], top_child[p] = value[i], i
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        p = parent[i]
        kept[i] = kept[p] and (value[i] > 0 or p > 0 and below[p] <= 0 and top_child[p] == i)
    return kept


def extract(model: gbt.Trees, sources: list[str | None], at_once: int = 20_000) -> list[str]:
    """The main text of each page."""
    out, pages, nodes = [], [], 0

    def finish():
        xs = [features(p) for p in pages]
        scores = np.clip(model.scores(np.concatenate(xs)), -6, 6) if xs else []
        at = 0
        for p in pages:
            n = len(p.parent)
            kept = decode(p.parent, np.array(p.kind) == RUN, scores[at:at + n])
            at += n
            out.append("\n".join(t for t, k in zip(p.text, kept, strict=True) if t and k))

    for source in sources:
        pages.append(Page(source or ""))
        nodes += len(pages[-1].parent)
        if nodes >= at_once:
            finish()
            pages, nodes = [], 0
    finish()
    return out


# -- the pages that the trees learn from --------------------------------------

class Composer:
    """Random pages out of given words. Elements of the article carry
    ``data-keep="1"`` (others inherit or are dropped)."""

    def __init__(self, words: list[str], seed: int = 11):
        self.words = words or "the of and to in is that for it was".split()
        self.rng = np.random.default_rng(seed)

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def say(self, lo: int, hi: int) -> str:
        n = int(np.exp(self.rng.uniform(np.log(lo), np.log(hi + 1))))
        at = self.rng.integers(len(self.words), size=max(n, 1))
        text = " ".join(self.words[i] for i in at)
        return entities.escape(text[:1].upper() + text[1:] + self.pick(".", ".", ".", "!", "?"), quote=False)

    def label(self, lo=1, hi=3) -> str:
        return self.say(lo, hi).rstrip(".!?")

    def wrap(self, tag: str, inner: str, names: tuple = (), keep: str | None = None, close: float = 1.0) -> str:
        attr = ""
        if names and self.chance(0.85):
            attr = f' {self.pick("class", "class", "id")}="{self.pick(*names)}{self.pick("", "", "-box", " wide", "-1")}"'
        if keep is not None:
            attr += f' data-keep="{keep}"'
        return f"<{tag}{attr}>{inner}" + (f"</{tag}>" if self.chance(close) else "")

    def links(self, lo: int, hi: int) -> str:
        n = int(self.rng.integers(lo, hi + 1))
        items = [f'<a href="/x">{self.label()}</a>' for _ in range(n)]
        if self.chance(0.7):
            return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>"
        return self.pick(" | ", " ", "").join(items)

    def menu(self) -> str:
        return self.wrap(self.pick("nav", "nav", "div", "ul"), self.links(2, 9), ("menu", "nav", "navbar", "topnav"))

    def head(self) -> str:
        inner = self.wrap(self.pick("h1", "div", "p"), self.label(1, 5)) + (self.links(2, 6) if self.chance(.5) else "")
        return self.wrap(self.pick("header", "header", "div"), inner, ("header", "masthead", "site-header", "logo"))

    def foot(self) -> str:
        inner = self.pick("&copy; ", "(c) ", "", "&copy; ") + self.label(1, 4) + self.pick(" &middot; ", " ") + self.say(2, 14)
        if self.chance(.4):
            inner = self.wrap("p", inner) + self.links(2, 6)
        return self.wrap(self.pick("footer", "footer", "div"), inner, ("footer", "site-footer", "copyright"))

    def advert(self) -> str:
        inner = self.say(2, 25)
        if self.chance(.4):
            inner = self.wrap("p", f'<a href="/ad">{inner}</a>' if self.chance(.5) else inner)
        return self.wrap(self.pick("div", "div", "aside", "section"), inner, ("ad", "ads", "advert", "sponsored", "promo"))

    def notice(self) -> str:
        inner = self.wrap(self.pick("p", "div", "span"), self.say(4, 30)) + self.pick("", "<button>OK</button>")
        return self.wrap(self.pick("div", "section", "aside", "dialog"), inner,
                         ("cookie", "notice", "cookie-consent", "alert", "gdpr", "popup"))

    def side(self) -> str:
        parts = [self.wrap("h3", self.label()) + (self.links(2, 7) if self.chance(.6) else self.wrap("p", self.say(4, 40)))
                 for _ in range(int(self.rng.integers(1, 4)))]
        return self.wrap(self.pick("aside", "aside", "div"), "".join(parts), ("sidebar", "widget", "related", "side"))

    def form(self) -> str:
        inner = f"<label>{self.label()}</label><input name=q>" + self.wrap("p", self.say(3, 20)) + "<button>Go</button>"
        return self.wrap("form", inner, ("newsletter", "search", "subscribe", "contact"))

    def comments(self) -> str:
        one = lambda: self.wrap(self.pick("div", "li", "article"),
                                (self.wrap(self.pick("b", "h4", "span"), self.label()) if self.chance(.5) else "")
                                + self.wrap("p", self.say(3, 60)), ("comment", "comment-body", "reply"))
        inner = (self.wrap("h3", self.label()) if self.chance(.6) else "") + "".join(
            one() for _ in range(int(self.rng.integers(1, 7))))
        return self.wrap(self.pick("section", "div", "div", "ul", "aside"), inner, ("comments", "comment-list", "discussion"))

    def share(self) -> str:
        return self.wrap(self.pick("div", "ul", "p"), self.links(2, 5), ("share", "social", "related", "tags"))

    def article(self) -> str:
        close, parts = self.pick(1.0, 1.0, 0.5, 0.0), []
        title = self.label(3, 14)
        if self.chance(.9):
            parts.append(self.wrap(self.pick("h1", "h1", "h2"), title, keep="1"))
        if self.chance(.3):
            parts.append(self.wrap("p", f"<b>{title} {self.say(2, 30)}<br>", keep="1", close=0))
        for _ in range(int(np.exp(self.rng.uniform(0, 3.4)))):
            roll = self.rng.random()
            if roll < .72:
                text = self.say(1, 400) if self.chance(.5) else self.say(15, 120)
                if self.chance(.2):
                    text += f' <a href="/y">{self.label(1, 6)}</a> ' + self.say(3, 40)
                if self.chance(.1):
                    text = f"<b>{self.say(1, 10)}<br>" + text
                parts.append(self.wrap("p", text, keep="1", close=close))
            elif roll < .78:
                parts.append(self.wrap(self.pick("h2", "h3"), self.label(1, 9), keep="1"))
            elif roll < .82:
                items = "".join(self.wrap("li", self.say(2, 25)) for _ in range(int(self.rng.integers(2, 7))))
                parts.append(self.wrap(self.pick("ul", "ol"), items, keep="1"))
            elif roll < .84:
                parts.append(self.wrap("blockquote", self.wrap("p", self.say(5, 60)), keep="1"))
            elif roll < .86:
                rows = "".join("<tr>" + "".join(f"<td>{self.label()}</td>" for _ in range(3)) + "</tr>" for _ in range(3))
                parts.append(f'<table data-keep="1">{rows}</table>')
            else:
                parts.append(self.pick(self.advert, self.share, self.form, self.notice, self.side)())
        names = ("article", "post", "content", "entry-content", "story", "main-text")
        body = self.wrap(self.pick("article", "article", "main", "div", "section"), "".join(parts), names)
        return body if self.chance(.6) else self.wrap(self.pick("main", "div"), body, ("main", "page", "content", "wrapper"))

    def page(self) -> str:
        before = [f() for f in (self.head, self.menu, self.advert, self.notice, self.side, self.form) if self.chance(.45)]
        after = [f() for f in (self.comments, self.side, self.advert, self.share, self.form, self.notice, self.foot)
                 if self.chance(.45)]
        if self.chance(.3):
            self.rng.shuffle(before)
        if self.chance(.5):
            after.append(self.foot())
        inner = "".join([*before, self.article(), *after])
        if self.chance(.2):
            inner = self.wrap("div", inner, ("page", "wrapper", "container"))
        end = self.pick("</body></html>", "", "</body></html>")
        return (f"<!DOCTYPE html><html><head><title>{self.label()}</title><script>x('</p>')</script></head>"
                f"<body>{inner}{end}")


def labelled(page: Page) -> np.ndarray:
    """1 for the runs under the nearest element marked as kept, and for the
    elements with such runs. Marks don't reach over dropped elements: these
    have no mark and stand beside the marked ones."""
    n, runs = len(page.parent), np.zeros(len(page.parent))
    mark = np.zeros(n, bool)
    for i in range(1, n):
        mark[i] = page.keep[i] == "1" or mark[page.parent[i]]
        if page.kind[i] == RUN:
            runs[i] = mark[i]
    for i in range(n - 1, 0, -1):
        runs[page.parent[i]] = max(runs[page.parent[i]], runs[i])
    return runs


def fit(words: list[str], n_pages: int = 400, seed: int = 11, n_trees: int = 40) -> gbt.Trees:
    composer = Composer(words, seed)
    pages = [Page(composer.page()) for _ in range(n_pages)]
    return gbt.fit(np.concatenate([features(p) for p in pages]), np.concatenate([labelled(p) for p in pages]),
                   n_trees=n_trees)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 200,
          max_chars: int = 50_000, max_words: int = 20_000, **options) -> gbt.Trees:
    """Fit on pages composed from the words of a bounded sample."""
    total = pages.count()
    if not total:
        return fit([], **options)
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) / 1_000_000 < min(1.0, max_pages / total)
    sample = pages.filter(part & (F.length(html_col) <= max_chars)).select(
        F.col(id_col).alias("i"), F.regexp_replace(html_col, r"<[^>]*>|&[#\w]*;?", " ").alias("t")).limit(
        4 * max_pages).collect()
    words = [w for r in sorted(sample, key=lambda r: (r["i"] is None, r["i"], r["t"])) for w in r["t"].split()]
    step = max(1, len(words) // max_words)
    return fit([w.strip(".,!?") for w in words[::step] if w.strip(".,!?")], **options)


def main_text(html: Column | str, model: gbt.Trees) -> Column:
    @pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series(extract(model, sources.tolist()), dtype=object)

    return of(html)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  **options) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""
    model = train(pages, id_col, html_col, **options)
    found = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         main_text(html_col, model).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
