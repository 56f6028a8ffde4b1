"""Main text against a plain scorer over explicit trees, and odd pages."""

import random
import time

import pytest

from marketlens.llm import htmltext as ht

PROSE = "body text, with words and commas, in a long line of prose that goes on. " * 5


class Node:
    def __init__(self, tag, classes=(), kids=(), parent=None):
        self.tag, self.classes, self.kids, self.parent = tag, list(classes), list(kids), parent

    def html(self):
        inner = "".join(k if isinstance(k, str) else k.html() for k in self.kids)
        return f'<{self.tag}{f" class={chr(34)}{chr(32).join(self.classes)}{chr(34)}" if self.classes else ""}>{inner}</{self.tag}>'

    def up(self):
        n = self.parent
        while n:
            yield n
            n = n.parent

    def walk(self):
        yield self
        for k in self.kids:
            if isinstance(k, Node):
                yield from k.walk()

    def words(self):
        return {w.lower() for c in self.classes for w in ht._NAMES.findall(c)}

    def texts(self):
        """(text, element) below, in page order."""
        for k in self.kids:
            if isinstance(k, str):
                yield k, self
            else:
                yield from k.texts()


def linked(n):
    return n.tag == "a" or any(u.tag == "a" for u in n.up())


def block(n):
    while n.tag not in ht.BLOCK:
        n = n.parent
    return n


def slow_text(root, by_name):
    nodes = list(root.walk())
    article = {n: any(u.tag in ("article", "main") for u in n.up()) for n in nodes}

    def dropped_tag(n):
        return n.tag in ht.DROPPED or n.tag == "header" and not article[n]

    drop = {n: any(dropped_tag(x) for x in (n, *n.up())) for n in nodes}
    weight, named, good, own_kind, other = {}, {}, {}, {}, {}
    for n in nodes:
        w = set() if drop[n] else n.words()
        plain = n.tag in ("article", "main")
        weight[n] = 25 * bool(w & ht.WANTED) - 25 * bool(w & ht.UNWANTED)
        named[n] = by_name and bool(w & ht.UNWANTED) and not w & ht.WANTED and not plain or n.tag == "form"
        each = [{x.lower() for x in ht._NAMES.findall(c)} for c in ([] if drop[n] else n.classes)]
        pure = [x for x in each if x & ht.WANTED and not x & ht.UNWANTED]
        counts = w & (ht.WANTED | ht.UNWANTED) and n.tag != "main"
        good[n] = (bool(pure) or plain and not w & ht.UNWANTED) if counts else plain
        mine = plain or counts and any(x & ht.OWN for x in pure)
        other[n] = counts and not mine and bool(w & ht.UNWANTED - {"header"})
        own_kind[n] = mine or n is not root and own_kind[n.parent] and not other[n]
    alive = [(t, e) for t, e in root.texts() if not drop[e]]

    def size(n, link):
        return sum(len(t.strip()) for t, e in alive if linked(e) == link and (e is n or n in e.up()))

    own = {n: size(n, False) for n in nodes}
    for n in nodes:
        w = n.words()
        if named[n] and n.tag != "form" and article[n] and not w & ht.UNWANTED - ht.WEAK and own[n] >= ht.MIN_PROSE:
            named[n] = size(n, True) > ht.PROSE_LINKS * (own[n] + size(n, True))
    if any(named.values()):
        holds = {n: any(x.tag in ("article", "main") and good[x] and not drop[x] for x in n.walk()) for n in nodes}
        bad = {n: any(named[x] and not holds[x] for x in (n, *n.up())) for n in nodes}
        chosen = [n for n in nodes if n is not root and good[n] and not drop[n] and not bad[n] and own[n] >= ht.MIN_ARTICLE]
        whole = own[root]
        for n in nodes:
            if n is root:
                continue
            if drop[n.parent]:
                drop[n] = True
            elif named[n] and not holds[n]:
                drop[n] = 2 * own[n] <= whole or any(g is not n and n not in g.up() and g not in n.up() for g in chosen)
                if not drop[n]:
                    weight[n] += 25
    alive = [(t, e) for t, e in alive if not drop[e]]
    points = {}
    for n in nodes:
        here = [(t, e) for t, e in alive if block(e) is n and t.strip()]
        if not here:
            continue
        plain = sum(len(t.strip()) for t, e in here if not linked(e))
        p = (1 + sum(t.count(",") for t, _ in here) if plain >= ht.MIN_PARAGRAPH else 0) + min(plain / 100, 3)
        line = [n, *n.up()]
        for level, at in enumerate((line if n.tag in ht.CONTAINERS else line[1:])[:6]):
            points[at] = points.get(at, 0.0) + p / (1, 2, 6, 9, 12, 15)[level]

    def total(n, only_links=False):
        return sum(len(t.strip()) for t, e in alive if (block(e) is n or n in block(e).up()) and (linked(e) or not only_links))

    density = {n: total(n, True) / total(n) if total(n) else 0.0 for n in nodes}
    score = {n: (points[n] + ht.TAG_POINTS.get(n.tag, 0) + weight[n]) * (1 - density[n]) for n in points}
    places = [n for n in nodes if n in points and n.tag in ht.CONTAINERS and not drop[n]]
    if not places:
        return ""
    best = max(places, key=lambda n: score[n])
    kept = {best}
    if best is not root:
        for n in best.parent.kids:
            if isinstance(n, Node) and n is not best and total(n) and not drop[n]:
                plain = n.tag == "p" and (density[n] < 0.25 if total(n) > 80 else density[n] == 0)
                if plain or score.get(n, float("-inf")) >= max(10, ht.SIBLING_SHARE * score[best]):
                    kept.add(n)

    def shown(e):
        line = [block(e), *block(e).up()]
        lists = any(n is not best and n not in kept and n.tag in ("ul", "ol", "div", "section", "table") and density[n] > ht.LINK_LIST and not own_kind[n]
                    for n in line)
        return any(n in kept for n in line) and not lists

    out, now = [], []

    def visit(n):
        for k in n.kids:
            if isinstance(k, str):
                if not drop[n] and shown(n):
                    now.append(k)
            else:
                if k.tag in ht.BLOCK:
                    out.append("".join(now))
                    now.clear()
                visit(k)
                if k.tag in ht.BLOCK:
                    out.append("".join(now))
                    now.clear()

    visit(root)
    out.append("".join(now))
    return " ".join(x for x in (" ".join(b.split()) for b in out) if x)


def grown(rng, tags):
    words = "content post-body related-work share sidebar comments text alert reply widget x y main-nav story".split()

    def text():
        return " ".join(rng.choice(["word", "and,", "longer", "text."]) for _ in range(rng.choice([1, 3, 8, 40])))

    def node(parent, depth):
        n = Node(rng.choice(tags), rng.sample(words, rng.choice([0, 0, 0, 1, 2])), parent=parent)
        if n.tag == "p" or depth > 3:
            n.tag = "p" if n.tag != "ul" else "blockquote"
            n.kids = [text(), Node("a", kids=[text()], parent=n), " " + text()] if rng.random() < 0.4 else [text()]
            for k in n.kids:
                if isinstance(k, Node):
                    k.parent = n
            return n
        for _ in range(rng.randint(1, 4)):
            n.kids += [node(n, depth + 1)] if rng.random() < 0.8 else [" " + text() + " "]
        return n

    root = Node("html")
    root.kids = [node(root, 0) for _ in range(rng.randint(1, 5))]
    return root


@pytest.mark.parametrize("tags", [["div", "section", "p", "p", "blockquote"], ["div", "section", "p", "p", "form", "aside", "article", "header", "ul"]])
def test_pages_equal_the_plain_scorer(tags):
    rng = random.Random(4)
    texts = 0
    for _ in range(400):
        root = grown(rng, tags)
        page = "<body>" + "".join(k if isinstance(k, str) else k.html() for k in root.kids) + "</body>"
        want = slow_text(root, True) or slow_text(root, False)
        assert ht.main_text(page) == want, page
        texts += len(want) > 200
    assert texts > 100


def test_a_form_around_the_page_is_no_form_to_drop():
    assert ht.main_text(f'<form id="aspnet"><div class="page"><p>{PROSE}</p></div></form>') == PROSE.strip()
    assert ht.main_text(f'<form><article><p>{PROSE}</p></article><footer>foot</footer></form>') == PROSE.strip()
    assert ht.main_text(f'<div><p>{PROSE}</p></div><form><label>Your mail</label><p>Subscribe to all of our news, offers and more of it.</p></form>') == PROSE.strip()


def test_ordinary_words_as_names_below_an_article_keep_prose():
    page = '<article><p>{0}</p><div class="related-work"><p>Earlier work. {0}</p></div><div class="share"><a href="x">share</a></div><div class="comments"><p>{0}</p></div></article>'
    assert ht.main_text(page.format(PROSE)) == f"{PROSE.strip()} Earlier work. {PROSE.strip()}"


@pytest.mark.parametrize("page", [
    "<i>" * 130_000 + "</b>" * 130_000, "<header>" * 120_000, "<blockquote>" * 80_000, "<i>" * 40_000 + "<li></li>" * 40_000, "<svg><div>" * 50_000 + "</svg>",
    "<p><div>" + "<i>" * 40_000 + "</p>" * 40_000, "<table>" + "<tr><td>" * 60_000, '<a "' * 100_000, "<" * 500_000, "<form>" * 100_000 + "text " * 50,
    "<b><i><p>" * 60_000, '<div class="content">' * 20_000 + '<div class="share">y</div>' * 20_000, "<script>" * 100_000, "<!--" * 200_000],
    ids=lambda p: p[:12])
def test_malformed_pages_take_time_in_proportion(page):
    began = time.process_time()
    ht.main_text(page)
    assert time.process_time() - began < 15  # quadratic work on these takes minutes
