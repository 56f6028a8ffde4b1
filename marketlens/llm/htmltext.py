"""Main text of web pages by tree scoring: paragraphs pass points to their ancestors and the best container is kept."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import slices

# Elements by what they are in HTML, and words of class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea xmp noembed noframes svg math".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("head title nav footer aside button select option datalist dialog menu object canvas audio video map".split())
ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar toolbar".split())
UNWANTED = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion
    nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead comment comments commentlist disqus respond reply replies
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations widget pagination pager toolbar skip""".split())
#: Unwanted names that are ordinary words too: below an article they don't count for an element that holds prose.
WEAK = frozenset("related recommended recommendations share sharing social reply skip widget header promotion".split())
WANTED = frozenset("article body content entry hentry main page post story text blog".split())
#: Names of an article itself, not of the layout around it: lists of links below them are its own.
OWN = WANTED - frozenset("body content main page blog".split())
TAG_POINTS = {"article": 25, "main": 15, "div": 5, "section": 3, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3, "ul": -3, "dl": -3,
              "dd": -3, "dt": -3, "li": -3, "form": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5}
CONTAINERS = frozenset("article main div section td body html blockquote center table tbody tr pre figure details".split())
#: A start tag of the one ends an open one of the others.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("table td th ul ol dl html body article section div main".split())
#: Where a list, table or select begins, above which no open item is ended.
HOLDERS = frozenset("ul ol dl table select".split())
ITEMS = frozenset(CLOSES) | HOLDERS

_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*/?)>|(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>?)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Start tags that end an open svg or math, and elements of theirs that may hold such tags.
_BREAK = re.compile(rf"<(?:{'|'.join(sorted(BLOCK - {'summary', 'caption', 'dir'}))}|body|br|img|span|b|i|em|strong|code|u|s|sub|sup|small)(?=[\s/>])", re.I)
_HOLDS_HTML = re.compile(r"<(?:foreignobject|desc|title|annotation-xml|mi|mo|mn|ms|mtext)(?=[\s/>])", re.I)
MIN_PARAGRAPH, SIBLING_SHARE, LINK_LIST = 25, 0.2, 0.6
#: Unlinked characters of a well named element beside which a badly named one is left out even if it holds most of the text.
MIN_ARTICLE = 100
#: Prose: so many unlinked characters at least, and at most this share of link text.
MIN_PROSE, PROSE_LINKS = 140, 0.25


class _Tree:
    """Elements of a page in page order, each after its parent, and the text fragments between them."""

    def __init__(self, page: str, by_name: bool) -> None:
        self.parent, self.tag, self.weight, self.drop, self.block = [-1], ["html"], [0], [False], [0]
        self.named, self.good, self.own, self.form = [False], [False], [False], [False]
        self.weak, self.inside = [False], [False]
        self.fragments: list[tuple[int, str, bool, int]] = []  # (block element, text, in a link, element); block -1: a break
        self.stack, self.unclosed, self.closes = [0], set(), {}
        # how many of each tag are open, and the depths of open paragraphs and their scopes, and of items and their holders
        self.open, self.scopes, self.items = Counter(["html"]), [0], []
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                self.text(page[at:])
                break
            if lt > at:
                self.text(page[at:lt])
            m = _TAG.match(page, lt)
            if not m:  # a "<" that begins no tag is text
                self.text("<")
                at = lt + 1
                continue
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self.end(name)
                continue
            attributes = m[3] or m[6] or ""
            if name in RAW:
                if name not in ("svg", "math"):
                    close = self.close(page, name, at)
                    at = close.end() if close else size
                elif not attributes.endswith("/"):
                    at = self.foreign_end(page, name, at)
                continue
            self.start(name, attributes)
        self.drop_named(by_name)

    def close(self, page: str, name: str, at: int) -> re.Match | None:
        """The next end tag, looked for once however many start tags come before it."""
        found = self.closes.get(name)
        if found is None or found.start() < at:
            found = self.closes[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
        return found

    def foreign_end(self, page: str, name: str, at: int) -> int:
        """Where an svg or math element ends: behind its end tag, or before an HTML tag that can't be in it; one with neither is the tag alone."""
        close = None if name in self.unclosed else self.close(page, name, at)
        if close:
            found = _BREAK.search(page, at, close.start())
            return found.start() if found and not _HOLDS_HTML.search(page, at, found.start()) else close.end()
        self.unclosed.add(name)
        found = None if "" in self.unclosed else _BREAK.search(page, at)
        if not found:
            self.unclosed.add("")
        return found.start() if found else at

    def drop_named(self, by_name: bool) -> None:
        """Drops forms and, if asked for, elements with unwanted names, but not those around a main element, an article or most of the page's unlinked text.

        Most of the text doesn't save an element if an article or well named element beside it holds some. Below an article, names
        that are ordinary words too don't count for prose.
        """
        n = len(self.tag)
        linked = [0] * n
        if by_name:
            self.named = [a or b for a, b in zip(self.named, self.form, strict=True)]
        else:
            self.named = self.form
        if not any(self.named):
            return
        own, holds, bad, last = [0] * n, [False] * n, [False] * n, list(range(n))
        for b, text, link, e in self.fragments:
            if b >= 0:
                (linked if link else own)[e] += len(text.strip())
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            own[up] += own[i]
            linked[up] += linked[i]
            last[up] = max(last[up], last[i])
            holds[i] = holds[i] or self.good[i] and self.tag[i] in ("article", "main") and not self.drop[i]
            holds[up] = holds[up] or holds[i]
            if self.weak[i] and self.inside[i] and own[i] >= MIN_PROSE and linked[i] <= PROSE_LINKS * (own[i] + linked[i]):
                self.named[i] = self.form[i]
        for i in range(1, n):
            bad[i] = bad[self.parent[i]] or self.named[i] and not holds[i]
        good = [i for i in range(1, n) if self.good[i] and not self.drop[i] and not bad[i] and own[i] >= MIN_ARTICLE]
        for i in range(1, n):
            if self.drop[self.parent[i]]:
                self.drop[i] = True
            elif self.named[i] and not holds[i]:
                self.drop[i] = 2 * own[i] <= own[0] or any(g < i > last[g] or g > last[i] for g in good)
                if not self.drop[i]:  # what holds most of the text mustn't lose to a trifle for its name
                    self.weight[i] += 25
        self.fragments = [f for f in self.fragments if f[0] < 0 or not self.drop[f[3]]]

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if not self.drop[top]:
            self.fragments.append((self.block[top], html.unescape(raw) if "&" in raw else raw, self.open["a"] > 0, top))

    def pop(self, depth: int) -> None:
        for n in self.stack[depth:]:
            self.open[self.tag[n]] -= 1
            if self.tag[n] in BLOCK:
                self.fragments.append((-1, "", False, -1))
        del self.stack[depth:]
        for marks in (self.scopes, self.items):
            while marks and marks[-1] >= depth:
                marks.pop()

    def top(self, marks: list[int]) -> str:
        return self.tag[self.stack[marks[-1]]] if marks else ""

    def end(self, name: str) -> None:
        """Ends the nearest open element of the name, if there is one; a paragraph only within its scope."""
        if name == "p":
            if self.top(self.scopes) == "p":
                self.pop(self.scopes[-1])
        elif self.open[name] > (name == "html"):
            depth = len(self.stack) - 1
            while self.tag[self.stack[depth]] != name:  # all that is passed is ended
                depth -= 1
            if depth:
                self.pop(depth)

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.fragments.append((-1, "", False, -1))
        if name in VOID or name in ("html", "body") and not attributes:
            if name in BLOCK:
                self.fragments.append((-1, "", False, -1))
            return
        if name in BLOCK:
            if self.top(self.scopes) == "p":
                self.pop(self.scopes[-1])
            self.fragments.append((-1, "", False, -1))
        # between two holders there is one open item of a kind at most
        for depth in reversed(self.items) if name in CLOSES else ():
            tag = self.tag[self.stack[depth]]
            if tag in CLOSES[name]:
                self.pop(depth)
                if name != "tr" or tag == "tr":
                    break
            elif tag in HOLDERS:
                break
        up, weight, named, other, good, own = self.stack[-1], 0, False, False, name in ("article", "main"), name in ("article", "main")
        drop = self.drop[up] or name in DROPPED
        inside = self.open["article"] + self.open["main"] > 0
        if name == "header" and not inside:
            drop = True
        form, weak = name == "form", False
        if "=" in attributes and not drop:
            a = {k.lower(): x or y or z for k, x, y, z in _ATTRIBUTE.findall(attributes)}
            names = {w.lower() for w in _NAMES.findall(f"{a.get('class', '')} {a.get('id', '')}")}
            if names & WANTED:
                weight += 25
            if names & UNWANTED and name not in ("html", "body"):
                weight -= 25
                named = not names & WANTED and name not in ("article", "main")
                weak = named and not names & UNWANTED - WEAK
            if names & (WANTED | UNWANTED) and name not in ("html", "body", "main"):
                each = [{x.lower() for x in _NAMES.findall(w)} for w in f"{a.get('class', '')} {a.get('id', '')}".split()]
                pure = [x for x in each if x & WANTED and not x & UNWANTED]
                good = bool(pure) or good and not names & UNWANTED
                own = own or any(x & OWN for x in pure)
                other = not own and bool(names & UNWANTED - {"header"})
            form = form or a.get("role", "").lower() == "form"
            drop = drop or a.get("role", "").lower() in ROLES or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style", "")))
        if "hidden" in attributes and re.search(r"(?:^|\s)hidden(?:$|[\s=])", attributes):
            drop = True
        n = len(self.tag)
        self.parent.append(up)
        self.tag.append(name)
        self.weight.append(weight)
        self.drop.append(drop)
        self.named.append(named)
        self.good.append(good)
        self.own.append(own or self.own[up] and not other)
        self.block.append(n if name in BLOCK else self.block[up])
        self.form.append(form)
        self.weak.append(weak)
        self.inside.append(inside)
        self.open[name] += 1
        if name == "p" or name in SCOPE:
            self.scopes.append(len(self.stack))
        if name in ITEMS:
            self.items.append(len(self.stack))
        self.stack.append(n)


def _best_text(page: str, by_name: bool) -> str:
    tree = _Tree(page, by_name)
    n = len(tree.tag)
    length, linked, commas = [0] * n, [0] * n, [0] * n
    for b, text, link, _ in tree.fragments:
        if b >= 0 and (size := len(text.strip())):
            length[b] += size
            linked[b] += size * link
            commas[b] += text.count(",")
    points = [0.0] * n
    scored = [False] * n
    for i in range(n):
        if not length[i]:
            continue
        own = length[i] - linked[i]
        p = (1 + commas[i] if own >= MIN_PARAGRAPH else 0) + min(own / 100, 3)
        at, level = i if tree.tag[i] in CONTAINERS else tree.parent[i], 0
        while at >= 0 and level < 6:
            points[at] += p / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[at] = True
            at, level = tree.parent[at], level + 1
    total, links = length[:], linked[:]
    for i in range(n - 1, 0, -1):
        total[tree.parent[i]] += total[i]
        links[tree.parent[i]] += links[i]
    density = [links[i] / total[i] if total[i] else 0.0 for i in range(n)]
    score = [(points[i] + TAG_POINTS.get(tree.tag[i], 0) + tree.weight[i]) * (1 - density[i]) if scored[i] else float("-inf") for i in range(n)]
    places = [i for i in range(n) if scored[i] and tree.tag[i] in CONTAINERS and not tree.drop[i]]
    if not places:
        return ""
    best = max(places, key=lambda i: (score[i], -i))
    keep = [False] * n
    keep[best] = True
    if best:
        for i in range(1, n):
            if tree.parent[i] == tree.parent[best] and i != best and total[i] and not tree.drop[i]:
                plain = tree.tag[i] == "p" and (density[i] < 0.25 if total[i] > 80 else density[i] == 0)
                keep[i] = plain or score[i] >= max(10, SIBLING_SHARE * score[best])
    lists = [False] * n
    for i in range(1, n):
        lists[i] = lists[tree.parent[i]] or i != best and tree.tag[i] in ("ul", "ol", "div", "section", "table") and density[i] > LINK_LIST and not keep[i] and not tree.own[i]
        keep[i] = keep[i] or keep[tree.parent[i]]
    blocks, now = [], []
    for b, text, _, _ in tree.fragments:
        if b < 0:
            if now:
                blocks.append(" ".join("".join(now).split()))
                now = []
        elif keep[b] and not lists[b]:
            now.append(text)
    if now:
        blocks.append(" ".join("".join(now).split()))
    return " ".join(x for x in blocks if x)


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by a space.

    Menus, headers, footers, asides, forms and the like are left out by element, role and class or id names. An unwanted name only lowers the
    score of an element that also has a wanted one, or holds an article or a main element, and doesn't count for one with most of the page's
    unlinked text, nor, if it is an ordinary word too, for prose below an article. A form around an article or most of the text is kept. Each paragraph
    gives a point, one for each comma, and up to three for its length, without its link text, to the container above it, half to the next
    and ever less further up; a container's points are discounted by its share of link text. The best container is kept with
    siblings that score a fifth of it or are plain paragraphs, without lists of links other than an article's own. If names ruled out all text, they count only as points.
    """
    if not page:
        return ""
    return _best_text(page, True) or _best_text(page, False)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    A null or empty html, or one without text, gives an empty text; null ids and urls stay; rows with equal ids are returned each; an empty
    table gives an empty result; other columns aren't read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"page_id {kind[0]}, url {kind[1]}, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
